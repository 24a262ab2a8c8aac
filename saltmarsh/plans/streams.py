"""Queries over streams and sources."""

from __future__ import annotations


from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..streaming import resume
from . import fixtures as T

QUERIES, ORACLE_SQL = {}, {}


def _events_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = spark.read.parquet(f"{sf_dir}/events.parquet").schema
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).option("pathGlobFilter", "events*").parquet(sf_dir)


def r02_stream_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events read as a stream, upserted by user."""
    from ..storage import scratch

    table, checkpoint = scratch(spark, "upsert"), scratch(spark, "upsert-checkpoint")
    stream = _events_stream(spark, sf_dir).select("user_id", "event_id", "event_type", "value")
    resume.upsert_stream(stream, table, checkpoint, "user_id", "event_id").awaitTermination()
    return resume.current(spark, table, "user_id", "event_id")


QUERIES["r02_stream_upsert"] = r02_stream_upsert
ORACLE_SQL["r02_stream_upsert"] = "SELECT user_id, event_id, event_type, value FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) = 1"


def r05_retryable(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users whose last event is a failure, to be tried again."""
    log = T.table(spark, sf_dir, "events").select(F.col("user_id").cast("string").alias("user"), F.col("event_id").alias("seq"), F.when(F.col("event_id") % 3 == 0, "failed").otherwise("ok").alias("status"))
    return resume.retryable(log, "user").select("user", "seq")


QUERIES["r05_retryable"] = r05_retryable
ORACLE_SQL["r05_retryable"] = "SELECT CAST(user_id AS VARCHAR) AS user, event_id AS seq FROM (SELECT * FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) = 1) WHERE event_id % 3 = 0"

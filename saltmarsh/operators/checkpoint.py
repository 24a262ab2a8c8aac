"""Append-only logs, resuming and upgrading."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import present


def read_log(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """JSON lines; blank and malformed ones are skipped."""
    return spark.read.schema(schema).option("mode", "DROPMALFORMED").json(path)


def log_key(*columns: str) -> Column:
    """The first of the columns that is not blank."""
    return F.coalesce(*[present(F.trim(c)) for c in columns])


def last_wins(log: DataFrame, key: Column, order: str = "seq") -> DataFrame:
    """The last record of each key; records without one are left out. Combined before the shuffle."""
    names = log.columns
    return log.filter(key.isNotNull()).groupBy(key.alias("_key")).agg(F.max_by(F.struct(*names), order).alias("r")).select("r.*")


def resume(papers: DataFrame, done: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """Finished and pending papers by key."""
    keys = done.select(key).filter(F.col(key).isNotNull()).distinct()
    return papers.join(keys, key, "left_semi"), papers.join(keys, key, "left_anti")


def still_valid() -> Column:
    """Whether a log record (log_*) fits its paper: source (paper_only and paper+metadata alike), format, chunks."""
    kind = lambda c: F.when(F.col(c) == "paper+metadata", "paper_only").otherwise(F.col(c))
    return (kind("source") == kind("log_source")) & F.col("source_format").eqNullSafe(F.col("log_source_format")) & (F.col("num_chunks") == F.col("log_num_chunks"))


def resume_valid(papers: DataFrame, log: DataFrame, key: str = "paper_id") -> DataFrame:
    """Papers with `done`: whether a log record of theirs is still valid."""
    own = log.select(key, *[F.col(c).alias(f"log_{c}") for c in ("source", "source_format", "num_chunks")])
    return papers.join(own, key, "left").withColumn("done", F.coalesce(still_valid(), F.lit(False))).drop("log_source", "log_source_format", "log_num_chunks")


def assign_hosts(papers: DataFrame, hosts: list[str], seq: str = "seq") -> DataFrame:
    """Hosts in turn by number; repeated hosts count once."""
    once = list(dict.fromkeys(hosts))
    return papers.withColumn("host", F.element_at(F.array(*[F.lit(h) for h in once]), (F.pmod(F.col(seq), F.lit(len(once))) + 1).cast("int")))

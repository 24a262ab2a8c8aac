"""Logs and caches that grow: the same operators on streams.

The source of truth is a keyed table of Parquet folders, one a batch of the stream; a reader takes the
last record of each key. A batch writes its own folder by number, so a batch run again replaces itself.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.checkpoint import last_wins, log_key


def upsert_stream(stream: DataFrame, table: str, checkpoint: str, key: str, order: str, available_now: bool = True) -> StreamingQuery:
    """Appends each batch's last record of a key below `table`."""

    def write(batch: DataFrame, number: int) -> None:
        last_wins(batch, F.col(key), order).write.mode("overwrite").parquet(f"{table}/batch={number}")

    writer = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def current(spark: SparkSession, table: str, key: str, order: str) -> DataFrame:
    """The last record of each key of all batches so far."""
    return last_wins(spark.read.parquet(table).drop("batch"), F.col(key), order)


def retryable(log: DataFrame, *keys: str) -> DataFrame:
    """Keys whose last record failed, to be tried again."""
    return last_wins(log, log_key(*keys)).filter("status <> 'ok'")


def deduplicated(stream: DataFrame, key: str, time: str, delay: str) -> DataFrame:
    """First record of a key within the watermark (an extension over the source system)."""
    return stream.withWatermark(time, delay).dropDuplicatesWithinWatermark([key])

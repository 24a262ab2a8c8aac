"""Intermediate tables in the folder that driver and executors share."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in spark.checkpoint.dir; a local folder is used only where that is unset and all run on one machine."""
    folder = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        folder = f"file://{tempfile.mkdtemp(prefix='saltmarsh-')}"
        spark.conf.set("spark.checkpoint.dir", folder)
    return f"{folder.rstrip('/')}/saltmarsh/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """`df` written as Parquet into the shared folder and read again: computed once, and kept when executors are lost."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Rows that a broadcast side may have.
BROADCAST_ROWS = 1_000_000


def if_small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """A stored table with a broadcast hint where its counted rows are within the bound, else unhinted (AQE joins it by shuffle)."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


#: Bytes a core of a table that is read in fewer splits than there are cores, however it is laid out.
SPREAD_BYTES = 64 << 20


def spread(df: DataFrame, key: str) -> DataFrame:
    """`df` dealt out over all cores by `key` where its files are too small to give each core a split; else as it is.

    A small table is often one row group, which is one task however many cores there are. Tables of more than
    `SPREAD_BYTES` a core are not shuffled.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return df.repartition(cores, key) if size <= cores * SPREAD_BYTES else df

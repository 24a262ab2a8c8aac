"""The cache of chunked papers, and what is told about it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BUCKETS = 64


def read_cache_files(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """file_name and the record of each JSON file that holds one object, whatever else is in the folder.

    Order by file_name for the order of the files; files that are no JSON object are left out, `unreadable` has them.
    """
    return _files(spark, path).filter("_good").select("file_name", F.from_json("value", schema).alias("_r")).select("file_name", "_r.*")


def unreadable(spark: SparkSession, path: str) -> DataFrame:
    """file, warning of the JSON files that hold no object."""
    return _files(spark, path).filter("NOT _good").select(F.col("file_name").alias("file"), F.lit("parse_failed:no JSON object").alias("warning"))


def _files(spark: SparkSession, path: str) -> DataFrame:
    rows = spark.read.option("pathGlobFilter", "*.json").text(path, wholetext=True)
    kind = F.schema_of_variant(F.try_parse_json("value"))
    return rows.select(F.element_at(F.split(F.input_file_name(), "/"), -1).alias("file_name"), "value", F.coalesce(kind.startswith("OBJECT"), F.lit(False)).alias("_good"))


def with_cached(papers: DataFrame, cache: DataFrame, key: str = "paper_id") -> DataFrame:
    """`papers` with `cached`, the record of the cache under their key, null where there is none."""
    return papers.join(cache.select(key, F.struct(*[c for c in cache.columns if c != key]).alias("cached")), key, "left")


def write_cache(records: DataFrame, path: str, key: str = "paper_id") -> None:
    """Records as Parquet in a fixed number of folders by the hash of their key, so that one key's record is found in one of them."""
    records.withColumn("bucket", F.pmod(F.xxhash64(key), F.lit(BUCKETS))).write.mode("overwrite").partitionBy("bucket").parquet(path)


def read_cache(spark: SparkSession, path: str) -> DataFrame:
    """The records that `write_cache` wrote."""
    return spark.read.parquet(path).drop("bucket")


def manifest(records: DataFrame, warnings: DataFrame, chunks_dir: str) -> DataFrame:
    """One row: papers_cached, warnings, chunks_dir."""
    n = records.agg(F.count(F.lit(1)).alias("papers_cached"))
    w = warnings.agg(F.count(F.lit(1)).alias("warnings"))
    return n.crossJoin(F.broadcast(w)).withColumn("chunks_dir", F.lit(chunks_dir))  # one row by one row


def write_lines(rows: DataFrame, path: str) -> None:
    """Warnings, a manifest or a summary as JSON lines."""
    rows.write.mode("overwrite").json(path)

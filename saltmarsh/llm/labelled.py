"""Bounded samples of labelled documents for fitting."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import held_out, stored, text_or_empty

SEED = 7


def label_counts(labels: DataFrame, label: str) -> dict[int, int]:
    """Documents of each label that may be learned from."""
    return {int(r[0]): r[1] for r in usable(labels, label).groupBy("label").count().collect()}


def usable(labels: DataFrame, label: str) -> DataFrame:
    """doc_id, label (0 or 1) of the documents outside the held-out fold; ids with contradicting labels are left out."""
    own = labels.filter(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out("doc_id"))
    return own.groupBy("doc_id").agg(F.min(label).cast("int").alias("label"), F.max(label).cast("int").alias("most")).filter("label = most").drop("most")


def training_rows(docs: DataFrame, labels: DataFrame, label: str, per_class: dict[int, int], max_bytes: int) -> DataFrame:
    """label, body of a sample: for each label the `per_class` documents whose hashed ids are smallest, texts of up to `max_bytes` bytes."""
    able = usable(labels, label).withColumn("_order", F.xxhash64(F.lit(SEED), "doc_id"))
    picks: list[DataFrame] = [able.filter(F.col("label") == k).orderBy("_order", "doc_id").limit(n) for k, n in per_class.items()]
    sample = picks[0]
    for more in picks[1:]:
        sample = sample.unionByName(more)
    sample = stored(sample.select(F.col("doc_id").alias("_id"), "label"), "labelled")
    body: Column = text_or_empty("text")
    return docs.select("doc_id", body.alias("body")).filter(F.octet_length("body") <= max_bytes).join(F.broadcast(sample), F.col("doc_id") == F.col("_id")).select("_id", "label", "body")

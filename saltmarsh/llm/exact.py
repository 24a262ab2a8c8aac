"""Exact deduplication by progressive refinement.

Rows are grouped by byte length, those of lengths that recur by a hash of their first bytes, and only
what still collides has its whole text hashed (SHA-256). The two coarse steps run over two narrow
columns of each row, so that whole contents are read for the groups that survive both only. The surviving groups
are broadcast to the texts while they are few, else joined by shuffle.

Nulls: a null text counts as empty, a null id is the smallest. Texts are equal when identical byte
for byte. Of equal texts the row with the largest id stays; where that row is repeated, exactly one
of the copies stays. Empty texts are equal to each other. An empty table gives an empty result.
Row tags come from the position in the input's partitions; an input that is not a plain file scan, so might yield its rows in
another order when it is read again, is stored first.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import BROADCAST_ROWS, if_small, stored, stored_so_far, sweep, text_or_empty

PREFIX_BYTES = 256


def _coarse(text: Column) -> Column:
    """Byte length and prefix hash in one long."""
    return F.xxhash64(F.octet_length(text), F.substring(F.encode(text, "UTF-8"), 1, PREFIX_BYTES))


def surviving_groups(docs: DataFrame, text: str = "text") -> DataFrame:
    """The coarse keys (`_coarse`) that two rows or more share after grouping by length, then by prefix hash."""
    body = text_or_empty(text)
    narrow = stored(docs.select(F.octet_length(body).alias("_length"), _coarse(body).alias("_coarse")), "exact-narrow")
    lengths = stored(narrow.groupBy("_length").count().filter("count > 1").select("_length"), "exact-lengths")
    again = narrow.join(if_small(lengths), "_length", "left_semi")
    return stored(again.groupBy("_coarse").count().filter("count > 1").select("_coarse"), "exact-groups")


def steady(docs: DataFrame) -> DataFrame:
    """`docs` if its plan is a file scan without an exchange, so that each reading yields the same rows in the same order; else a stored copy."""
    plan = docs._jdf.queryExecution().executedPlan().toString()
    scan = re.search(r"FileScan|BatchScan", plan) and not re.search(r"Exchange|AdaptiveSparkPlan|ExistingRDD|InMemoryTableScan|MapIn|Python|Pandas|ArrowEval|\bSample", plan)
    return docs if scan else stored(docs, "steady")


def tagged(docs: DataFrame, tag: str) -> DataFrame:
    """`docs` (a `steady` input) with a number that tells its rows apart, the same at each reading."""
    return docs.withColumn(tag, F.monotonically_increasing_id())


def exact_groups(docs: DataFrame, id_column: str = "doc_id", text: str = "text", hash_all: bool = False, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """One row per row of `docs`: doc_id, row_tag, keep_id, group_size, kept, text_sha256.

    text_sha256 is null where a coarse step already told the text apart from all others, unless
    `hash_all` asks for the digest of those as well (computed in the same reading of the text).
    """
    spark, body = docs.sparkSession, text_or_empty(text)
    since, docs = stored_so_far(spark), steady(docs)
    groups = surviving_groups(docs, text)
    rows = tagged(docs, "row_tag").select(F.col(id_column).alias("doc_id"), "row_tag", body.alias("_body"))
    rows = rows.withColumn("_coarse", _coarse(F.col("_body"))).join(if_small(groups.withColumn("_again", F.lit(True)), broadcast_rows), "_coarse", "left")
    again = F.col("_again").isNotNull()
    digest = F.sha2(F.col("_body"), 256)
    rows = stored(rows.select("doc_id", "row_tag", again.alias("_again"), (digest if hash_all else F.when(again, digest)).alias("text_sha256")), "exact-rows")
    best = rows.filter("_again").groupBy("text_sha256").agg(F.max(F.struct("doc_id", "row_tag")).alias("_best"), F.count(F.lit(1)).alias("_n"))
    best = stored(best.filter("_n > 1").select(F.col("text_sha256").alias("_key"), "_best", "_n"), "exact-best")
    sweep(spark, since, rows, best)
    # rows told apart earlier get keys of their own, else all of them would meet at null
    key = F.when(F.col("_again"), F.col("text_sha256")).otherwise(F.concat(F.lit("row "), F.col("row_tag").cast("string")))
    out = rows.withColumn("_row_key", key).join(if_small(best), F.col("_row_key") == F.col("_key"), "left")
    kept = F.col("_best").isNull() | (F.col("_best.row_tag") == F.col("row_tag"))
    keep_id = F.when(F.col("_best").isNull(), F.col("doc_id")).otherwise(F.col("_best.doc_id"))
    return out.select("doc_id", "row_tag", keep_id.alias("keep_id"), F.coalesce("_n", F.lit(1)).cast("long").alias("group_size"), kept.alias("kept"), "text_sha256")


def without_tags(docs: DataFrame, dropped: DataFrame, tag: str = "row_tag") -> DataFrame:
    """The rows of `docs` whose tag is not among `dropped` (a stored column of tags)."""
    own = "_own_row_tag"
    left = tagged(docs, own)
    return left.join(if_small(dropped.select(F.col(tag).alias("_dropped_tag"))), F.col(own) == F.col("_dropped_tag"), "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])


def exact_dedup(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """`docs` with one row of each group of equal texts, its columns unchanged."""
    docs = steady(docs)
    since = stored_so_far(docs.sparkSession)
    dropped = stored(exact_groups(docs, id_column, text).filter("NOT kept").select("row_tag"), "exact-dropped")
    sweep(docs.sparkSession, since, dropped)
    return without_tags(docs, dropped)

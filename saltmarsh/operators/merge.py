"""Deduplicating and merging records of one paper from several sources.

One aggregation by key does it: every field's rule is a minimum or maximum by an ordering, so no record meets
another in a fold and Spark combines before the shuffle. `seq` is the order of arrival.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as X
from ..functions.values import ABSTRACT_PRIORITY


def paper_key(title_prefix: int | None = None) -> Column:
    """doi:…, else title:…, else one key a record (A01); `title_prefix` cuts titles as the source system does."""
    doi, title = X.normal_doi("doi"), X.normal_title("title")
    title = title if title_prefix is None else F.substring(title, 1, title_prefix)
    return F.coalesce(F.concat(F.lit("doi:"), doi), F.concat(F.lit("title:"), title), F.concat(F.lit("record:"), F.col("seq").cast("string")))


def source_priority(c: str = "source_api") -> Column:
    pairs = [x for k, v in ABSTRACT_PRIORITY.items() for x in (F.lit(k), F.lit(v))]
    return F.coalesce(F.element_at(F.create_map(*pairs), F.col(c)), F.lit(0))


def _first(c: str, ok: Column | None = None) -> Column:
    """First value in order of arrival where `ok`."""
    keep = F.col(c).isNotNull() if ok is None else ok
    return F.min_by(c, F.when(keep, F.col("seq")))


def merge_fields() -> list[Column]:
    """The aggregates of A02 to A09."""
    text = lambda c: F.coalesce(F.col(c), F.lit("")) != ""
    order = F.struct(source_priority().alias("p"), (-F.col("seq")).alias("s"))
    longest = F.struct(F.size(F.coalesce("authors", F.array().cast("array<string>"))).alias("n"), (-F.col("seq")).alias("s"))
    return [
        F.min("seq").alias("seq"),
        _first("doi", text("doi")).alias("doi"),
        F.min_by(F.struct("title"), "seq").getField("title").alias("title"),
        F.max_by("abstract", F.when(text("abstract"), order)).alias("abstract"),
        _first("year", F.coalesce("year", F.lit(0)) != 0).alias("year"),
        F.min_by("keywords", "seq").alias("_first_keywords"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list(F.coalesce("keywords", F.array().cast("array<string>")))))).alias("_all_keywords"),
        F.max_by("authors", longest).alias("authors"),
        _first("journal", text("journal")).alias("journal"),
        F.max("citation_count").alias("citation_count"),
        _first("open_access").alias("open_access"),
        _first("pmid", text("pmid")).alias("pmid"),
        F.array_sort(F.collect_set(F.when(text("source_api"), F.col("source_api")))).alias("source_apis"),
        F.count(F.lit(1)).alias("n_records"),
    ]


def deduplicate(papers: DataFrame, compat: bool = False) -> DataFrame:
    """Unique papers with merged fields and n_records; `compat` keeps only the last of papers whose titles share 80 characters (A10)."""
    merged = papers.withColumn("_key", paper_key()).groupBy("_key").agg(*merge_fields())
    keywords = F.when(F.col("n_records") > 1, F.filter("_all_keywords", lambda x: x.isNotNull())).otherwise(F.col("_first_keywords"))
    merged = merged.withColumn("keywords", keywords).drop("_first_keywords", "_all_keywords")
    if compat:
        cut = F.when(F.col("_key").startswith("title:"), F.substring("_key", 1, len("title:") + 80)).otherwise(F.col("_key"))
        names = merged.columns
        merged = merged.groupBy(cut.alias("_cut")).agg(F.max_by(F.struct(*names), "seq").alias("row")).select("row.*")
    return merged.drop("_key")


def coverage(papers: DataFrame) -> DataFrame:
    """How many papers have an abstract or DOI, and in per cent."""
    n = F.count(F.lit(1))
    has = lambda c: F.count_if(F.coalesce(F.col(c), F.lit("")) != "")
    share = lambda c: F.round(100.0 * has(c) / F.greatest(n, F.lit(1)), 1)
    return papers.agg(n.alias("papers"), has("abstract").alias("with_abstract"), has("doi").alias("with_doi"), share("abstract").alias("pct_abstract"), share("doi").alias("pct_doi"))


def source_stats(harvest: DataFrame) -> DataFrame:
    """Per source: tasks that went well, that failed, and papers (A12); rows are (source, status, papers)."""
    return harvest.groupBy("source").agg(F.count_if(F.col("status") == "ok").alias("ok"), F.count_if(F.col("status") != "ok").alias("fail"), F.coalesce(F.sum("papers"), F.lit(0)).alias("papers"))

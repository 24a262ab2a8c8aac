"""Compounds that a language model read out of chunks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as X
from ..functions.values import COMPOUNDS_PATTERN, EXCLUDED_COMPOUNDS, NOT_FOUND

FIELDS = ("smiles", "formula", "structural_info", "role")


def parsed_items(answer: str = "answer") -> Column:
    """Array of variants: the objects of {compounds}, {items} or a bare list, or of a compounds object within other text."""
    whole = F.try_parse_json(F.col(answer))
    rescue = F.try_parse_json(F.nullif(F.regexp_extract(F.coalesce(F.col(answer), F.lit("")), COMPOUNDS_PATTERN, 1), F.lit("")))
    tried = F.coalesce(whole, rescue)
    lists = [F.try_variant_get(tried, path, "array<variant>") for path in ("$.compounds", "$.items", "$")]
    items = F.coalesce(*lists, F.array().cast("array<variant>"))
    return F.filter(items, lambda v: F.schema_of_variant(v).startswith("OBJECT"))


def compounds(answers: DataFrame, keys: list[str], answer: str = "answer") -> DataFrame:
    """One row per compound read: keys, item_no, compound_name, smiles, formula, structural_info, role, evidence (N03); excluded names are left out."""
    rows = answers.select(*keys, F.posexplode(parsed_items(answer)).alias("item_no", "v"))
    got = lambda f: X.present(X.strip(F.try_variant_get("v", f"$.{f}", "string")))
    name = F.coalesce(got("compound_name"), got("name"))
    out = rows.select(*keys, "item_no", name.alias("compound_name"), *[F.coalesce(got(f), F.lit(NOT_FOUND)).alias(f) for f in FIELDS], F.coalesce(got("evidence"), F.lit("")).alias("evidence"))
    return out.filter(F.col("compound_name").isNotNull() & ~is_excluded("compound_name"))


def is_excluded(name: str) -> Column:
    return F.lower(F.trim(F.col(name))).isin(EXCLUDED_COMPOUNDS)


def merge_compounds(items: DataFrame, paper: str = "paper_id", order: tuple[str, ...] = ("chunk_no", "item_no")) -> DataFrame:
    """Per paper and name (case apart): first spelling, first value found of each field, evidence and chunks in order without repeats."""
    seq = F.struct(*order)
    first = lambda c: F.coalesce(F.min_by(c, F.when(F.col(c) != NOT_FOUND, seq)), F.lit(NOT_FOUND)).alias(c)
    listed = lambda c: F.array_distinct(F.transform(F.array_sort(F.collect_list(F.when(F.coalesce(F.col(c), F.lit("")) != "", F.struct(*order, F.col(c).alias("_v"))))), lambda x: x["_v"]))
    key = F.lower(F.trim("compound_name"))
    return items.groupBy(paper, key.alias("name_key")).agg(F.min_by("compound_name", seq).alias("compound_name"), *[first(c) for c in FIELDS], listed("evidence").alias("evidence"), listed("chunk_id").alias("source_chunk_ids"), F.count(F.lit(1)).alias("mentions"))


def extraction_records(merged: DataFrame, papers: DataFrame, paper: str = "paper_id") -> DataFrame:
    """Papers with their compounds as one array sorted by name, and their number."""
    fields = [c for c in merged.columns if c not in (paper, "name_key", "mentions")]
    listed = merged.groupBy(paper).agg(F.transform(F.array_sort(F.collect_list(F.struct(F.lower("compound_name").alias("_o"), F.struct(*fields).alias("c")))), lambda x: x["c"]).alias("compounds"))
    return papers.join(listed, paper, "left").withColumn("num_compounds", F.coalesce(F.size("compounds"), F.lit(0)))


def extraction_totals(merged: DataFrame, paper: str = "paper_id") -> DataFrame:
    """Papers with a compound, and compounds."""
    return merged.agg(F.countDistinct(paper).alias("papers_with_compounds"), F.count(F.lit(1)).alias("compounds"))


def mentions(records: DataFrame) -> DataFrame:
    """One row per compound of extraction records."""
    c = records.select("*", F.posexplode("compounds").alias("item_no", "c"))
    paper = [X.or_not_found(f).alias(f) for f in ("paper_id", "doi", "title", "year", "source", "source_format", "source_filepath")]
    rows = c.select("seq", "item_no", *paper, X.strip("c.compound_name").alias("compound_name"), X.or_not_found(F.col("c.smiles")).alias("paper_smiles"), X.or_not_found(F.col("c.formula")).alias("paper_formula"), X.or_not_found(F.col("c.structural_info")).alias("paper_structural_info"))
    return rows.filter(F.coalesce("compound_name", F.lit("")) != "")

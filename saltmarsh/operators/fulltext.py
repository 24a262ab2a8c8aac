"""Grading extracted documents and choosing among attempts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as X
from ..functions.values import LOCATOR_PRIORITY, MISSING
from ..storage import stored


def classify(docs: DataFrame) -> DataFrame:
    """title, abstract, full_text cleaned, with language, is_english, label and extraction_status.

    Each step stands once in the plan, so a filter on a label does not write the whole grading out again; filters on
    other columns belong before this.
    """
    out = docs.withColumns({c: X.once(X.clean_or_missing(c)) for c in ("title", "abstract", "full_text")})
    guess = X.clean_or_missing(X.strip(F.substring(F.substring_index("full_text", "\n", 1), 1, 300)))
    out = out.withColumn("title", X.once(F.when((F.col("title") == MISSING) & (F.col("abstract") == MISSING) & (F.col("full_text") != MISSING), guess).otherwise(F.col("title"))))
    out = out.withColumns({"_none": X.non_article("full_text", "title", "abstract"), "label": X.raw_label("title", "abstract", "full_text")})
    full = F.col("label").isin("complete_full_text", "partial_full_text")
    # points lower full texts only
    out = out.withColumn("_points", X.once(F.when(full & ~F.col("_none"), X.penalty("full_text", "abstract", alone=False)).otherwise(0)))
    label = F.when((F.col("_points") >= 2) & (F.col("label") == "complete_full_text"), "partial_full_text").otherwise(F.col("label"))
    less = F.when(F.col("abstract") != MISSING, "abstract_only").otherwise("title_only")
    label = F.when((F.col("_points") >= 3) & full, less).otherwise(label)
    out = out.withColumns({"language": X.once(X.language(F.concat_ws("\n", "title", "abstract", "full_text"))), "label": X.once(F.when(F.col("_none"), "non_article").otherwise(label))})
    status = F.when(F.col("label").isin("non_article", "metadata_only", "title_only"), "failed").when(F.col("label") == "complete_full_text", "ok").otherwise("partial")
    return out.withColumns({"extraction_status": status, "is_english": F.col("language") == "en"}).drop("_points", "_none")


def label_breakdown(docs: DataFrame, column: str = "label") -> DataFrame:
    """Documents by label (or language), most first."""
    return docs.groupBy(column).agg(F.count(F.lit(1)).alias("documents")).orderBy(F.desc("documents"), column)


def full_text_only(docs: DataFrame) -> DataFrame:
    """Complete and partial texts."""
    return docs.filter(F.col("label").isin("partial_full_text", "complete_full_text"))


def _longest(c: str) -> Column:
    """Longest value that is there; of equals the earliest attempt."""
    v = F.trim(F.coalesce(F.col(c), F.lit("")))
    return F.coalesce(F.max_by(v, F.when((v != "") & (v != MISSING), F.struct(F.length(v).alias("n"), (-F.col("attempt")).alias("a")))), F.lit(MISSING))


def best_candidate(candidates: DataFrame, key: str = "doi", english_first: bool = True) -> DataFrame:
    """Per key the best attempt: English before others if asked for, then the label's rank, then the earliest; title and abstract are the longest of all attempts (A19, A20, F12). Candidates need no full_text."""
    order = F.struct((F.col("is_english") & F.lit(english_first)).cast("int").alias("e"), X.label_rank("label").alias("r"), (-F.col("attempt")).alias("a"))
    fields = [f for f in ("attempt", "source_format", "language", "label", "extraction_status", "is_english", "full_text") if f != "full_text" or f in candidates.columns]
    best = candidates.groupBy(key).agg(F.max_by(F.struct(*fields), order).alias("b"), _longest("title").alias("title"), _longest("abstract").alias("abstract"), F.count(F.lit(1)).alias("attempts"))
    return best.select(key, "title", "abstract", "attempts", *[F.col(f"b.{f}").alias(f) for f in fields])


def staged_fallback(papers: DataFrame, attempts: list[tuple[str, callable]], key: str = "doi") -> DataFrame:
    """Attempts in order, each only for papers whose best label so far is no full text.

    `attempts`: (name, function of a DataFrame of papers to their classified extractions keyed by `key`); what each gives
    is stored, as the later ones ask for it again.
    """
    left, found = papers, []
    for i, (name, attempt) in enumerate(attempts):
        got = stored(attempt(left).withColumns({"attempt": F.lit(i), "source_format": F.lit(name)}), "attempt")
        found.append(got)
        left = left.join(full_text_only(got).select(key).distinct(), key, "left_anti")
    return best_candidate(reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), found), key)


def first_location(candidates: DataFrame, key: str = "doi", wanted: str | None = None) -> DataFrame:
    """The location of the most preferred locator that found one, of a format if asked for."""
    rank = F.array_position(F.array(*[F.lit(x) for x in LOCATOR_PRIORITY]), F.col("source"))
    rows = candidates.filter(F.col("url").isNotNull() & (rank > 0))
    rows = rows if wanted is None else rows.filter(F.col("format") == wanted)
    return rows.groupBy(key).agg(F.min_by(F.struct("url", "format", "source"), F.struct(rank, "url")).alias("l")).select(key, "l.url", "l.format", "l.source")


def labelled_text() -> Column:
    """A document as a labelled text file."""
    head = [("DOI", F.col("doi")), ("YEAR", F.coalesce(X.present(F.trim(F.col("year").cast("string"))), F.lit("unknown"))), ("SOURCE_URL", F.coalesce(X.present("source_url"), F.lit(MISSING))), ("SOURCE_FORMAT", F.coalesce(X.present("source_format"), F.lit("unknown"))), ("LANGUAGE", F.col("language")), ("LABEL", F.col("label")), ("EXTRACTION_STATUS", F.col("extraction_status"))]
    lines = [F.concat(F.lit(f"### {k}: "), v) for k, v in head]
    for k, c in (("TITLE", "title"), ("ABSTRACT", "abstract"), ("FULL_TEXT", "full_text")):
        lines += [F.lit(""), F.lit(f"### {k}"), X.clean_or_missing(c)]
    return F.concat_ws("\n", *lines, F.lit(""))


def with_fallback_url(papers: DataFrame, hits: DataFrame, resolved: DataFrame, wanted: str = "pdf", key: str = "doi") -> DataFrame:
    """`papers` with url, format and source of a locator's hit of a format, else of the address resolved earlier if it has that format.

    hits and resolved: key, url, format, source; of several resolved addresses of a key the last (by `seq`) counts.
    """
    hit = hits.filter(F.col("format") == wanted).select(key, F.struct("url", "format", "source").alias("_hit"))
    last = resolved.groupBy(key).agg(F.max_by(F.struct("url", "format", F.coalesce("source", F.lit(f"resolved_{wanted}")).alias("source")), "seq").alias("_old"))
    last = last.filter((F.col("_old.format") == wanted) & (F.coalesce("_old.url", F.lit("")) != ""))
    out = papers.join(hit, key, "left").join(last, key, "left").withColumn("_l", F.coalesce("_hit", "_old"))
    return out.select(*papers.columns, *[F.col(f"_l.{c}").alias(c) for c in ("url", "format", "source")])


def text_summary(papers: DataFrame, resolved: DataFrame, texts: DataFrame) -> DataFrame:
    """kind, name, n: papers, addresses resolved, texts saved, then texts by label and by language."""
    one = lambda df, name, where=None: df.agg((F.count(F.lit(1)) if where is None else F.count_if(where)).alias("n")).select(F.lit("total").alias("kind"), F.lit(name).alias("name"), "n")
    by = lambda c: texts.groupBy(F.coalesce(c, F.lit("unknown")).alias("name")).agg(F.count(F.lit(1)).alias("n")).select(F.lit(c).alias("kind"), "name", "n")
    totals = one(papers, "total_papers").unionByName(one(resolved, "urls_resolved", F.col("resolved"))).unionByName(one(texts, "final_txt_saved", F.coalesce("output_filepath", F.lit("")) != ""))
    return totals.unionByName(by("label")).unionByName(by("language"))


def first_papers(papers: DataFrame, n: int, seq: str = "seq") -> DataFrame:
    """The first n papers by `seq` for a validation run, all with 0."""
    return papers.orderBy(seq).limit(n) if n > 0 else papers

"""BibTeX entries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .text import present


def escaped(c: Column | str) -> Column:
    """Backslashes and braces escaped, single blanks."""
    t = F.coalesce((F.col(c) if isinstance(c, str) else c).cast("string"), F.lit(""))
    for x in ("\\", "{", "}"):
        t = F.replace(t, F.lit(x), F.lit("\\" + x))
    return F.trim(F.regexp_replace(t, r"(?U)\s+", " "))


def entry_key_text(c: Column) -> Column:
    """Letters and digits only, at most 60."""
    return F.coalesce(present(F.substring(F.regexp_replace(c, "[^A-Za-z0-9]+", ""), 1, 60)), F.lit("entry"))


def entry_key(index: str = "position") -> Column:
    """From the DOI, else from first author, year, first word of the title and number."""
    doi = present(F.trim("doi"))
    author = F.coalesce(F.element_at(F.split(F.trim(F.try_element_at("authors", F.lit(1))), r"\s+"), -1), F.lit("unknown"))
    word = F.coalesce(present(F.element_at(F.split(F.trim("title"), r"\s+"), 1)), F.lit("untitled"))
    year = F.when(F.coalesce("year", F.lit(0)) != 0, F.col("year").cast("string")).otherwise("nd")
    return entry_key_text(F.coalesce(doi, F.concat(author, year, word, F.col(index).cast("string"))))


def listed(c: str, by: str) -> Column:
    """Values that are not blank, escaped and joined."""
    return F.coalesce(F.array_join(F.transform(F.filter(c, lambda x: F.trim(F.coalesce(x, F.lit(""))) != ""), escaped), by), F.lit(""))


def entry(index: str = "position") -> Column:
    """A whole entry (P11, X28); fields without a value are left out."""
    plain = lambda c: F.col(c).cast("string")
    year = F.trim(F.col("year").cast("string"))
    fields = [("title", escaped("title")), ("author", listed("authors", " and ")), ("journal", escaped("journal")), ("year", year), ("doi", escaped("doi")), ("pmid", escaped("pmid")), ("abstract", escaped("abstract")), ("keywords", listed("keywords", "; ")), ("citation_count", plain("citation_count")), ("open_access", plain("open_access")), ("source_apis", listed("source_apis", ", ")), ("relevance_score", plain("relevance_score")), ("relevance_reason", escaped("relevance_reason")), ("score_confidence", escaped("score_confidence"))]
    kind = F.when(F.coalesce("journal", F.lit("")) != "", "article").otherwise("misc")
    head = F.concat(F.lit("@"), kind, F.lit("{"), entry_key(index), F.lit(","))
    return F.concat_ws("\n", head, *[F.when(F.coalesce(v, F.lit("")) != "", F.concat(F.lit(f"  {k} = {{"), v, F.lit("},"))) for k, v in fields], F.lit("}"))


def unique_papers(papers: DataFrame) -> DataFrame:
    """First paper of each DOI or title (case apart); those with neither stay."""
    key = F.lower(F.trim(F.coalesce(present(F.trim("doi")), F.col("title"), F.lit(""))))
    own = F.when(key == "", F.concat(F.lit("\x00"), F.col("seq").cast("string"))).otherwise(key)
    names = papers.columns
    return papers.groupBy(own.alias("_key")).agg(F.min_by(F.struct(*names), "seq").alias("r")).select("r.*")

"""A search intent in each source's query language, as column expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MUST, ANY = "must_contain", "any_of"


def _joined(c: Column | str, form: Callable[[Column], Column], by: str) -> Column:
    return F.array_join(F.transform(c, form), by)


def _with_any(must: Column, any_part: Column) -> Column:
    """`must AND (any)`, or `must` where nothing is optional."""
    return F.when(F.size(ANY) > 0, F.concat(must, F.lit(" AND ("), any_part, F.lit(")"))).otherwise(must)


def plain(most: int = 3) -> Column:
    """Words in a row."""
    return F.array_join(F.concat(F.col(MUST), F.slice(ANY, 1, most)), " ")


def quoted(c: str, by: str) -> Column:
    """Quoted terms joined by a word."""
    return _joined(c, lambda t: F.concat(F.lit('"'), t, F.lit('"')), by)


def crossref() -> Column:
    """JSON of query and query.bibliographic."""
    return F.to_json(F.struct(F.array_join(MUST, " ").alias("query"), F.when(F.size(ANY) > 0, F.array_join(F.slice(ANY, 1, 3), " ")).alias("query.bibliographic")))


def pubmed() -> Column:
    """Booleans with field tags."""
    form = lambda t: F.concat(F.lit('"'), t, F.lit('"[Title/Abstract]'))
    return _with_any(_joined(MUST, form, " AND "), _joined(ANY, form, " OR "))


def europe_pmc() -> Column:
    """Lucene booleans over title and abstract."""
    both = lambda t: F.concat(F.lit('TITLE:"'), t, F.lit('" OR ABSTRACT:"'), t, F.lit('"'))
    return _with_any(_joined(MUST, lambda t: F.concat(F.lit("("), both(t), F.lit(")")), " AND "), _joined(ANY, both, " OR "))


def lens() -> Column:
    """JSON body of a boolean query."""
    phrase = lambda t: F.struct(F.struct(t.alias("title_abstract_keyword")).alias("match_phrase"))
    some = F.size(ANY) > 0
    query = F.struct(F.transform(MUST, phrase).alias("must"), F.when(some, F.transform(ANY, phrase)).alias("should"), F.when(some, F.lit(1)).alias("minimum_should_match"))
    return F.to_json(F.struct(F.struct(query.alias("bool")).alias("query")))


def dimensions() -> Column:
    """A DSL query."""
    return F.concat(F.lit("search publications for "), _joined(F.concat(F.col(MUST), F.col(ANY)), lambda t: F.concat(F.lit('"'), t, F.lit('"')), " "), F.lit(" return publications [doi+title+abstract+year+keywords+journal+authors] limit 1000"))


#: Source to query.
TRANSLATORS: dict[str, Callable[[], Column]] = {"openalex": lambda: plain(3), "semantic_scholar": lambda: plain(2), "crossref": crossref, "pubmed": pubmed, "europe_pmc": europe_pmc, "core": lambda: plain(2), "lens": lens, "dimensions": dimensions}


def query_plan(intents: DataFrame, sources: list[str] | None = None) -> DataFrame:
    """source, id, query of each pair, without any call."""
    names = list(TRANSLATORS) if sources is None else [s for s in sources if s in TRANSLATORS]
    pairs = F.explode(F.array(*[F.struct(F.lit(s).alias("source"), TRANSLATORS[s]().alias("query")) for s in names]))
    return intents.select("id", pairs.alias("p")).select("p.source", "id", "p.query")


def unknown_sources(asked: list[str]) -> list[str]:
    """Names that are no source."""
    return [s for s in asked if s not in TRANSLATORS]

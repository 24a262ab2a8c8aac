"""Payloads of the seven sources as rows of raw papers.

Each mapper is a select over the JSON of one record (column `payload`), or XML for PubMed; absent parts are null.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as X

COLUMNS = ("doi", "title", "abstract", "year", "keywords", "authors", "journal", "citation_count", "open_access", "pmid")

# The parts of each source's records that are read
SCHEMAS = {
    "openalex": "doi string, title string, abstract_inverted_index map<string,array<int>>, publication_year int, keywords array<struct<display_name:string>>, concepts array<struct<display_name:string,score:double>>, authorships array<struct<author:struct<display_name:string>>>, primary_location struct<source:struct<display_name:string>>, cited_by_count bigint, open_access struct<is_oa:boolean>",
    "semantic_scholar": "externalIds struct<DOI:string,PubMed:string>, title string, abstract string, year int, s2FieldsOfStudy array<struct<category:string>>, authors array<struct<name:string>>, citationCount bigint",
    "crossref": "DOI string, title array<string>, abstract string, published struct<`date-parts`:array<array<int>>>, `published-print` struct<`date-parts`:array<array<int>>>, `published-online` struct<`date-parts`:array<array<int>>>, subject array<string>, author array<struct<given:string,family:string>>, `container-title` array<string>, `is-referenced-by-count` bigint",
    "europe_pmc": "doi string, title string, abstractText string, pubYear string, keywordList struct<keyword:array<string>>, authorString string, journalTitle string, citedByCount bigint, isOpenAccess string, pmid string",
    "core": "identifiers array<string>, title string, abstract string, yearPublished int, fieldOfStudy array<string>, authors array<struct<name:string>>, journal struct<title:string>, citationCount bigint",
    "lens": "external_ids array<struct<type:string,value:string>>, doi string, title string, abstract string, year_published int, keywords array<string>, authors array<struct<first_name:string,last_name:string>>, source struct<title:string>, scholarly_citations_count bigint",
}


def inverted_index(c: Column | str) -> Column:
    """Words of a text with their positions, made within the row: sorted pairs are cut where the word changes."""

    def cut(pairs: Column) -> Column:
        new = lambda i: F.when(i == 0, True).otherwise(F.get(pairs, i)["w"] != F.get(pairs, i - 1)["w"])
        return X.let(F.filter(F.sequence(F.lit(0), F.size(pairs) - 1), new), lambda begins: F.map_from_entries(F.transform(begins, lambda b, k: one(pairs, b, F.coalesce(F.get(begins, k + 1), F.size(pairs))))))

    def one(pairs: Column, begin: Column, end: Column) -> Column:
        return F.struct(F.get(pairs, begin)["w"].alias("w"), F.transform(F.slice(pairs, begin + 1, end - begin), lambda p: p["p"]).alias("at"))

    pairs = F.transform(F.split(c, " "), lambda w, i: F.struct(w.alias("w"), i.alias("p")))
    return X.let(F.sort_array(pairs), cut)


def inverted_text(c: Column | str) -> Column:
    """Words of an inverted index in order of position, then of word (P03); null for none."""
    m = F.col(c) if isinstance(c, str) else c
    pairs = F.flatten(F.transform(F.map_entries(m), lambda e: F.transform(e["value"], lambda p: F.struct(p.alias("p"), e["key"].alias("w")))))
    return F.when(F.size(m) > 0, F.array_join(F.transform(F.sort_array(pairs), lambda x: x["w"]), " "))


def _filled(c: Column) -> Column:
    return F.coalesce(F.filter(c, lambda x: F.coalesce(x, F.lit("")) != ""), F.array().cast("array<string>"))


def _names(c: Column, first: str, last: str) -> Column:
    whole = F.transform(c, lambda a: F.trim(F.concat(F.coalesce(a[first], F.lit("")), F.lit(" "), F.coalesce(a[last], F.lit("")))))
    return F.coalesce(whole, F.array().cast("array<string>"))


def _or_empty(c: Column) -> Column:
    return F.coalesce(c, F.array().cast("array<string>"))


def _row(doi: Column, title: Column, abstract: Column, year: Column, keywords: Column, authors: Column, journal: Column | None, cited: Column | None, is_open: Column | None, pmid: Column | None) -> list[Column]:
    kinds = {"journal": "string", "citation_count": "bigint", "open_access": "boolean", "pmid": "string"}
    given = dict(zip(COLUMNS, (doi, title, abstract, year, keywords, authors, journal, cited, is_open, pmid), strict=True))
    return [(F.lit(None).cast(kinds[k]) if v is None else v).alias(k) for k, v in given.items()]


def _openalex(g: Callable[[str], Column]) -> list[Column]:
    words = F.concat(_or_empty(F.transform(g("keywords"), lambda k: k["display_name"])), _or_empty(F.transform(F.filter(g("concepts"), lambda c: c["score"] > 0.3), lambda c: c["display_name"])))
    authors = _filled(F.transform(g("authorships"), lambda a: a["author"]["display_name"]))
    return _row(X.present(F.replace(g("doi"), F.lit("https://doi.org/"), F.lit(""))), g("title"), inverted_text(g("abstract_inverted_index")), g("publication_year"), F.array_distinct(_filled(words)), authors, g("primary_location.source.display_name"), g("cited_by_count"), g("open_access.is_oa"), None)


def _semantic_scholar(g: Callable[[str], Column]) -> list[Column]:
    return _row(g("externalIds.DOI"), g("title"), g("abstract"), g("year"), _filled(F.transform(g("s2FieldsOfStudy"), lambda f: f["category"])), _or_empty(F.transform(g("authors"), lambda a: F.coalesce(a["name"], F.lit("")))), None, g("citationCount"), None, g("externalIds.PubMed"))


def _crossref(g: Callable[[str], Column]) -> list[Column]:
    parts = F.coalesce(*[g(f"{k}.`date-parts`") for k in ("published", "`published-print`", "`published-online`")])
    return _row(g("DOI"), F.try_element_at(g("title"), F.lit(1)), X.without_tags(g("abstract")), F.nullif(F.try_element_at(F.try_element_at(parts, F.lit(1)), F.lit(1)), F.lit(0)), _filled(g("subject")), _names(g("author"), "given", "family"), F.try_element_at(g("`container-title`"), F.lit(1)), g("`is-referenced-by-count`"), None, None)


def _europe_pmc(g: Callable[[str], Column]) -> list[Column]:
    authors = _filled(F.transform(F.split(F.coalesce(g("authorString"), F.lit("")), ","), lambda a: F.trim(a)))
    return _row(g("doi"), g("title"), g("abstractText"), X.year_of(g("pubYear")), _or_empty(g("keywordList.keyword")), authors, g("journalTitle"), g("citedByCount"), F.coalesce(g("isOpenAccess") == "Y", F.lit(False)), g("pmid"))


def _core(g: Callable[[str], Column]) -> list[Column]:
    doi = F.replace(F.try_element_at(F.filter(g("identifiers"), lambda i: i.contains("doi.org")), F.lit(1)), F.lit("https://doi.org/"), F.lit(""))
    return _row(doi, g("title"), g("abstract"), g("yearPublished"), _or_empty(g("fieldOfStudy")), _or_empty(F.transform(g("authors"), lambda a: F.coalesce(a["name"], F.lit("")))), g("journal.title"), g("citationCount"), None, None)


def _lens(g: Callable[[str], Column]) -> list[Column]:
    doi = F.coalesce(X.present(F.try_element_at(F.filter(g("external_ids"), lambda e: e["type"] == "doi"), F.lit(1))["value"]), g("doi"))
    return _row(doi, g("title"), g("abstract"), g("year_published"), _or_empty(g("keywords")), _filled(_names(g("authors"), "first_name", "last_name")), g("source.title"), g("scholarly_citations_count"), None, None)


MAPPERS = {"openalex": _openalex, "semantic_scholar": _semantic_scholar, "crossref": _crossref, "europe_pmc": _europe_pmc, "core": _core, "lens": _lens}


def _pubmed(payload: str) -> list[Column]:
    """From the XML of one PubmedArticle."""
    path = lambda p: F.xpath(payload, F.lit(p))
    one = lambda p: X.present(F.xpath_string(payload, F.lit(p)))
    fore, last = path("//Author/ForeName/text()"), path("//Author/LastName/text()")
    # authors may lack one of the names: each is read by its place
    n = F.xpath_int(payload, F.lit("count(//Author)"))
    names = F.when(F.size(fore) == F.size(last), F.transform(F.arrays_zip(fore.alias("f"), last.alias("l")), lambda a: F.trim(F.concat_ws(" ", a["f"], a["l"])))).otherwise(last)
    authors = F.when(n > 0, _filled(names)).otherwise(F.array().cast("array<string>"))
    return _row(one("(//ArticleId[@IdType='doi'])[1]"), one("(//ArticleTitle)[1]"), X.present(F.trim(F.array_join(path("//AbstractText/text()"), " "))), X.year_of(one("(//PubDate/Year)[1]")), _or_empty(path("//MeshHeading/DescriptorName/text()")), authors, one("(//Journal/Title)[1]"), None, None, one("(//PMID)[1]"))


def raw_papers(records: DataFrame, source: str, payload: str = "payload") -> DataFrame:
    """The other columns of `records` with those of a raw paper and source_api."""
    rest = [c for c in records.columns if c != payload]
    if source == "pubmed":
        return records.select(*rest, *_pubmed(payload), F.lit(source).alias("source_api"))
    read = records.withColumn("_r", F.from_json(payload, SCHEMAS[source]))
    return read.select(*rest, *MAPPERS[source](lambda p: F.col(f"_r.{p}")), F.lit(source).alias("source_api"))

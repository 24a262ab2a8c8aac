"""Where a paper's full text is, out of the answers of six locators (S35 to S41, S52 to S54), as column expressions.

Each takes the locator's JSON answer and gives a struct (url, format, source), null where it found none.
`operators.fulltext.first_location` then takes the most preferred.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import present

# The parts of each answer that are read
SCHEMAS = {
    "pmc_xml": "pmcid string",
    "epmc_xml": "pmcid string, fullTextUrlList struct<fullTextUrl:array<struct<url:string,documentStyle:string,availabilityCode:string>>>",
    "unpaywall": "oa_locations array<struct<url_for_pdf:string,url_for_landing_page:string,url:string>>",
    "semantic_scholar": "openAccessPdf struct<url:string>",
    "core": "downloadUrl string",
    "crossref_link": "message struct<link:array<struct<URL:string,`content-type`:string>>,resource:struct<primary:struct<URL:string>>>",
}
PMC = "https://www.ebi.ac.uk/europepmc/webservices/rest/{id}/fullTextXML"


def _found(url: Column, fmt: str | Column, source: str) -> Column:
    return F.when(present(url).isNotNull(), F.struct(url.alias("url"), (F.lit(fmt) if isinstance(fmt, str) else fmt).alias("format"), F.lit(source).alias("source")))


def _first(c: Column, field: str, ok: Callable[[Column], Column]) -> Column:
    return F.try_element_at(F.filter(F.transform(c, lambda x: x[field]), lambda u: u.isNotNull() & (u != "") & ok(u)), F.lit(1))


def _pmcid(c: Column) -> Column:
    number = F.regexp_replace(F.upper(F.trim(c)), "^PMC", "")
    return F.when(number != "", F.concat(F.lit("PMC"), number))


def _xml_of(pmcid: Column) -> Column:
    head, _, tail = PMC.partition("{id}")
    return F.when(pmcid.isNotNull(), F.concat(F.lit(head), pmcid, F.lit(tail)))


def _pmc(g: Callable[[str], Column]) -> Column:
    return _found(_xml_of(_pmcid(g("pmcid"))), "xml", "pmc_xml")


def _epmc(g: Callable[[str], Column]) -> Column:
    urls = F.filter(g("fullTextUrlList.fullTextUrl"), lambda u: u["availabilityCode"].isin("OA", "F"))
    of = lambda style: F.try_element_at(F.filter(urls, lambda u: F.lower(u["documentStyle"]) == style), F.lit(1))["url"]
    return F.coalesce(_found(of("xml"), "xml", "epmc_xml"), _found(_xml_of(_pmcid(g("pmcid"))), "xml", "epmc_xml"), _found(of("pdf"), "pdf", "epmc_xml"))


def _unpaywall(g: Callable[[str], Column]) -> Column:
    places = g("oa_locations")
    xml = _first(places, "url", lambda u: F.lower(u).contains("pmc") & F.lower(u).contains("xml"))
    return F.coalesce(_found(xml, "xml", "unpaywall"), _found(_first(places, "url_for_pdf", lambda u: F.lit(True)), "pdf", "unpaywall"), _found(_first(places, "url_for_landing_page", lambda u: F.lit(True)), "html", "unpaywall"))


def _crossref(g: Callable[[str], Column]) -> Column:
    def kind(x: Column) -> Column:
        declared, url = F.lower(F.coalesce(x["content-type"], F.lit(""))), F.lower(x["URL"])
        blank = declared.isin("", "unspecified")
        return F.when(declared.contains("xml") | (blank & url.contains("xml")), "xml").when(declared.contains("pdf") | (blank & url.contains("pdf")), "pdf").when(declared.contains("html"), "html")

    links = g("message.link")
    of = lambda f: _found(F.try_element_at(F.filter(links, lambda x: kind(x) == f), F.lit(1))["URL"], f, "crossref_link")
    return F.coalesce(of("xml"), of("pdf"), of("html"), _found(g("message.resource.primary.URL"), "html", "crossref_link"))


LOCATORS = {
    "pmc_xml": _pmc,
    "epmc_xml": _epmc,
    "unpaywall": _unpaywall,
    "semantic_scholar": lambda g: _found(g("openAccessPdf.url"), "pdf", "semantic_scholar"),
    "core": lambda g: _found(g("downloadUrl"), "pdf", "core"),
    "crossref_link": _crossref,
}


def locations(answers: DataFrame, key: str = "doi") -> DataFrame:
    """key, url, format, source of rows (key, locator, answer); answers without a location are left out."""
    found = F.coalesce(*[F.when(F.col("locator") == n, f(lambda p, n=n: F.col(f"_{n}.{p}"))) for n, f in LOCATORS.items()])
    read = answers.withColumns({f"_{n}": F.when(F.col("locator") == n, F.from_json("answer", s)) for n, s in SCHEMAS.items()})
    return read.select(key, found.alias("l")).filter("l IS NOT NULL").select(key, "l.*")


def publisher_urls(doi: Column, links: Column) -> Column:
    """The DOI's own address and the publisher's links, without repeats, in order."""
    return F.array_distinct(F.filter(F.concat(F.array(F.concat(F.lit("https://doi.org/"), doi)), F.coalesce(links, F.array().cast("array<string>"))), lambda u: u.isNotNull()))


def metadata_only_json(body: Column) -> Column:
    """JSON that describes a paper but has no text."""
    keys = F.json_object_keys(body)
    return F.coalesce(F.arrays_overlap(keys, F.array(*[F.lit(k) for k in ("DOI", "doi", "publisher", "ISSN")])) & ~F.arrays_overlap(keys, F.array(*[F.lit(k) for k in ("full_text", "fullText", "body", "sections")])), F.lit(False))

"""Queries over single column rules, payloads and sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as X
from ..functions import values as V
from ..operators import analysis, embedding, filtering, fulltext
from ..sources import locators, payloads
from . import fixtures as T
from .documents import sql_clean, sql_strip

S = SparkSession
QUERIES, ORACLE_SQL = {}, {}


def query(sql: str | None = None):
    """Registers a function under its name, with its SQL."""

    def add(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


_BODY = "CASE doc_id % 4 WHEN 0 THEN substr(text, 1, 90) WHEN 1 THEN concat('<html>', text) WHEN 2 THEN concat(text, ' Access Denied') ELSE concat('%PDF-1.4 ', text) END"


@query(f"SELECT doc_id, strlen(b) < 120 OR " + " OR ".join(f"contains(lower(substr(b, 1, 5000)), '{m}')" for m in V.ERROR_MARKERS) + f" AS error_body, contains(lower(substr(b, 1, 300)), '<html') AS html, CASE WHEN starts_with(lower(ltrim(substr(b, 1, 300))), '%pdf') THEN 'pdf' WHEN contains(lower(substr(b, 1, 300)), '<html') THEN 'html' END AS format FROM (SELECT doc_id, {_BODY} AS b FROM documents)")
def f14_error_bodies(spark: S, sf_dir: str) -> DataFrame:
    """Error pages, HTML and formats by content."""
    b = F.expr(_BODY)
    return T.table(spark, sf_dir, "documents").select("doc_id", X.error_body(b).alias("error_body"), F.lower(F.substring(b, 1, 300)).contains("<html").alias("html"), X.content_format(b).alias("format"))


@query("SELECT page_id, regexp_replace(regexp_replace(html, '<[^>]+>', '', 'g'), '^\\s+|\\s+$', '', 'g') AS plain FROM pages")
def x37_without_tags(spark: S, sf_dir: str) -> DataFrame:
    """Pages without tags."""
    return T.table(spark, sf_dir, "pages").select("page_id", X.without_tags("html").alias("plain"))


_YEAR = "CASE o_orderkey % 4 WHEN 0 THEN CAST(o_custkey AS STRING) WHEN 1 THEN concat(CAST(o_custkey AS STRING), 'x') WHEN 2 THEN '' END"


@query(f"SELECT o_orderkey, CASE WHEN regexp_full_match({_YEAR}, '[0-9]+') THEN CAST({_YEAR} AS INT) END AS year FROM orders")
def x38_years(spark: S, sf_dir: str) -> DataFrame:
    """Years written in digits."""
    return T.table(spark, sf_dir, "orders").select("o_orderkey", X.year_of(F.expr(_YEAR)).alias("year"))


@query("SELECT event_id, CASE WHEN CAST(value AS INT) <= 5 THEN 'red' ELSE 'green' END AS colour FROM (SELECT event_id, floor(value) AS value FROM events)")
def x39_score_colours(spark: S, sf_dir: str) -> DataFrame:
    """Plot colours of scores."""
    return T.table(spark, sf_dir, "events").select("event_id", X.score_colour(F.floor("value")).alias("colour"))


_CONTROL = "concat(p_name, chr(7), p_brand, chr(0), chr(9), '!')"


@query(f"SELECT p_partkey, regexp_replace({_CONTROL}, '[\\x00-\\x08\\x0b\\x0c\\x0e-\\x1f\\x7f]', '', 'g') AS csv_value, coalesce(nullif(trim(CASE WHEN p_size % 3 = 0 THEN ' ' ELSE p_name END), ''), 'NOT FOUND') AS safe FROM part")
def x31_csv_values(spark: S, sf_dir: str) -> DataFrame:
    """Values for CSV, and sentinels."""
    return T.table(spark, sf_dir, "part").select("p_partkey", X.without_control(F.expr(_CONTROL)).alias("csv_value"), X.or_not_found(F.expr("CASE WHEN p_size % 3 = 0 THEN ' ' ELSE p_name END")).alias("safe"))


_URL = "CASE c_custkey % 3 WHEN 0 THEN concat('https://doi.org/10.1/', CAST(c_custkey AS STRING), '?x=1') WHEN 1 THEN concat('doi:10.1/', CAST(c_custkey AS STRING)) ELSE concat(' 10.1/', CAST(c_custkey AS STRING)) END"


@query("SELECT c_custkey, concat('10.1/', CAST(c_custkey AS VARCHAR)) AS doi FROM customer")
def x33_doi_of_url(spark: S, sf_dir: str) -> DataFrame:
    """DOIs of addresses."""
    return T.table(spark, sf_dir, "customer").select("c_custkey", X.doi_of_url(F.expr(_URL)).alias("doi"))


_CLEAN_T = "coalesce(nullif({c}, ''), 'N/A')"


@query(f"SELECT doc_id, '### DOI: 10.1/' || doc_id || chr(10) || '### YEAR: ' || CASE WHEN doc_id % 2 = 0 THEN '2001' ELSE 'unknown' END || chr(10) || '### SOURCE_URL: N/A' || chr(10) || '### SOURCE_FORMAT: xml' || chr(10) || '### LANGUAGE: en' || chr(10) || '### LABEL: l' || chr(10) || '### EXTRACTION_STATUS: ok' || chr(10) || chr(10) || '### TITLE' || chr(10) || 'N/A' || chr(10) || chr(10) || '### ABSTRACT' || chr(10) || 'A b' || chr(10) || chr(10) || '### FULL_TEXT' || chr(10) || {_CLEAN_T.format(c=sql_clean('text'))} || chr(10) AS content FROM documents")
def k08_labelled_texts(spark: S, sf_dir: str) -> DataFrame:
    """Labelled text files."""
    docs = T.table(spark, sf_dir, "documents").select("doc_id", F.concat(F.lit("10.1/"), F.col("doc_id").cast("string")).alias("doi"), F.when(F.col("doc_id") % 2 == 0, "2001").alias("year"), F.lit("").alias("source_url"), F.lit("xml").alias("source_format"), F.lit("en").alias("language"), F.lit("l").alias("label"), F.lit("ok").alias("extraction_status"), F.lit(None).cast("string").alias("title"), F.lit("A  b ").alias("abstract"), F.col("text").alias("full_text"))
    return docs.select("doc_id", fulltext.labelled_text().alias("content"))


@query(f"SELECT doc_id, '10.1/' || doc_id AS doi, substr(text, 1, 30) AS title, CAST(2000 + doc_id % 9 AS INT) AS year, lang || '|' || source AS keywords, 'A' || doc_id AS authors, CASE WHEN doc_id % 2 = 0 THEN 'J' END AS journal, n_chars AS citation_count, doc_id % 3 = 0 AS open_access FROM documents")
def p01_openalex_payloads(spark: S, sf_dir: str) -> DataFrame:
    """Records of one source as raw papers, out of their JSON."""
    name = lambda c: F.struct(F.col(c).cast("string").alias("display_name"))
    concept = lambda c, s: F.struct(F.col(c).cast("string").alias("display_name"), F.lit(s).alias("score"))
    key = F.col("doc_id").cast("string")
    record = F.struct(F.concat(F.lit("https://doi.org/10.1/"), key).alias("doi"), F.substring("text", 1, 30).alias("title"), (2000 + F.col("doc_id") % 9).alias("publication_year"), F.array(name("lang")).alias("keywords"), F.array(concept("source", 0.9), concept("lang", 0.8), concept("n_chars", 0.1)).alias("concepts"), F.array(F.struct(F.struct(F.concat(F.lit("A"), key).alias("display_name")).alias("author"))).alias("authorships"), F.when(F.col("doc_id") % 2 == 0, F.struct(F.struct(F.lit("J").alias("display_name")).alias("source"))).alias("primary_location"), F.col("n_chars").alias("cited_by_count"), F.struct((F.col("doc_id") % 3 == 0).alias("is_oa")).alias("open_access"))
    docs = T.table(spark, sf_dir, "documents").withColumn("n_chars", F.col("n_chars"))
    rows = payloads.raw_papers(docs.select("doc_id", F.to_json(record).alias("payload")), "openalex")
    return rows.select("doc_id", "doi", "title", "year", F.array_join("keywords", "|").alias("keywords"), F.array_join("authors", "|").alias("authors"), "journal", "citation_count", "open_access")


@query("SELECT CAST(c_custkey AS VARCHAR) AS doi, CASE c_custkey % 3 WHEN 0 THEN 'https://www.ebi.ac.uk/europepmc/webservices/rest/PMC' || c_custkey || '/fullTextXML' WHEN 1 THEN 'http://x/' || c_custkey || '.pdf' END AS url, CASE c_custkey % 3 WHEN 0 THEN 'xml' WHEN 1 THEN 'pdf' END AS format, CASE c_custkey % 3 WHEN 0 THEN 'pmc_xml' WHEN 1 THEN 'semantic_scholar' END AS source FROM customer WHERE c_custkey % 3 <> 2")
def s35_locations(spark: S, sf_dir: str) -> DataFrame:
    """Locations read out of locators' answers."""
    k = F.col("c_custkey").cast("string")
    answer = F.when(F.col("c_custkey") % 3 == 0, F.concat(F.lit('{"pmcid": "'), k, F.lit('"}'))).when(F.col("c_custkey") % 3 == 1, F.concat(F.lit('{"openAccessPdf": {"url": "http://x/'), k, F.lit('.pdf"}}'))).otherwise("{}")
    locator = F.when(F.col("c_custkey") % 3 == 0, "pmc_xml").when(F.col("c_custkey") % 3 == 1, "semantic_scholar").otherwise("core")
    return locators.locations(T.table(spark, sf_dir, "customer").select(k.alias("doi"), locator.alias("locator"), answer.alias("answer")))


_TYPE = "coalesce(nullif(lower(trim(type)), ''), 'other')"


@query(f"WITH r AS (SELECT name, {_TYPE} AS type FROM ({T.RESULTS_SQL})) SELECT name, type, 'other' AS plot_family FROM r WHERE type = 'other' UNION ALL SELECT name, type, type FROM r WHERE type IN ('phenolic', 'aminic')")
def u02_tagged_union(spark: S, sf_dir: str) -> DataFrame:
    """Priority and other rows split and joined with their plot family."""
    rows = T.results(spark, sf_dir).select("name", F.coalesce(X.present(F.lower(F.trim("type"))), F.lit("other")).alias("type"))
    priority, other = filtering.split(rows)
    return analysis.tagged_union(other, priority)


@query(f"WITH p AS (SELECT {sql_strip('lower(title)')} AS t, seq FROM ({T.RAW_PAPERS_SQL})) SELECT seq, regexp_replace(t, '\\s+', ' ', 'g') AS collapsed FROM p")
def x23_collapsed_titles(spark: S, sf_dir: str) -> DataFrame:
    """Titles in lower case with single blanks."""
    return T.raw_papers(spark, sf_dir).select("seq", X.collapsed("title").alias("collapsed"))


@query()
def c09_tsne(spark: S, sf_dir: str) -> DataFrame:
    """t-SNE of the nation-sized set of label centres of the embeddings."""
    rows = T.table(spark, sf_dir, "embeddings").select("label", F.posexplode("embedding").alias("i", "x")).groupBy("label", "i").agg(F.avg("x").alias("x"))
    centres = rows.groupBy("label").agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "x"))), lambda s: s["x"]).alias("embedding"))
    return embedding.tsne(centres, rounds=200).select("label", F.round("tsne_1", 3).alias("tsne_1"), F.round("tsne_2", 3).alias("tsne_2"))

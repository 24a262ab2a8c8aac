"""Queries over stages between systems: lookups, calls, caches, summaries, files written and read again, payloads."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as X
from ..operators import analysis, calls, fulltext
from ..schemas import RAW_PAPER
from ..sources import cache, files, names, payloads
from ..storage import scratch
from . import fixtures as T
from .compounds import _STRUCTURES
from .documents import _CLASSIFIED, _classified, _locations, _LOCATION_SQL

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


def name_service(kind: str, value: str) -> dict | None:
    """A stand-in for a name service: answers follow from the length of what is asked."""
    n = len(value)
    if kind == "properties":
        cid = int(value)
        return None if cid % 7 == 0 else {"PropertyTable": {"Properties": [{"Title": f"Title {cid}", "SMILES": "C" * (cid % 5 + 1), "IUPACName": ""}]}}
    if kind == "suggest":
        return {"dictionary_terms": {"compound": [f"{value}s"]}}
    return {"IdentifierList": {"CID": [n, n + 100]}} if n % 3 == (1 if kind == "name" else 2) else None


_CID = "CASE WHEN n % 3 = 0 THEN NULL WHEN n % 7 <> 0 THEN n WHEN (n + 100) % 7 <> 0 THEN n + 100 END"


@query(f"WITH p AS (SELECT DISTINCT p_name, CAST(length(p_name) AS BIGINT) AS n FROM part), r AS (SELECT *, {_CID} AS c FROM p) SELECT p_name AS input_name, CASE WHEN c IS NULL THEN 'not_found' ELSE 'resolved' END AS lookup_status, CASE WHEN c IS NULL THEN 'none' WHEN n % 3 = 1 THEN 'exact' ELSE 'synonym' END AS strategy, coalesce(CAST(c AS VARCHAR), 'NOT FOUND') AS cid, coalesce('Title ' || c, 'NOT FOUND') AS resolved_name, coalesce(repeat('C', CAST(c % 5 + 1 AS INT)), 'NOT FOUND') AS pubchem_canonical_smiles FROM r")
def s44_lookup_names(spark: S, sf_dir: str) -> DataFrame:
    """Names looked up at a service, strategy by strategy."""
    asked = T.table(spark, sf_dir, "part").select(F.col("p_name").alias("input_name")).distinct().withColumn("normalized_name", X.name_key("input_name"))
    found = names.lookup_names(asked, name_service, 0.0, tasks=4, sleep=lambda s: None)
    return found.select("input_name", "lookup_status", "strategy", "cid", "resolved_name", "pubchem_canonical_smiles")


def flaky_model(prompt: str) -> str | None:
    """A stand-in for a model that fails for prompts of some lengths."""
    if len(prompt) % 5 == 0:
        raise OSError("no answer")
    return None if len(prompt) % 5 == 1 else "{}"


_TEMPLATE = 'Answer as {{"compounds": []}} for: {text} End.'


@query("""WITH p AS (SELECT 'Answer as {"compounds": []} for: ' || o_orderpriority || o_custkey || ' End.' AS prompt FROM orders) SELECT count(*) AS chunks, count(*) FILTER (WHERE length(prompt) % 5 > 1) AS successes, count(*) FILTER (WHERE length(prompt) % 5 <= 1) AS failures, sum(CASE WHEN length(prompt) % 5 > 1 THEN 1 ELSE 3 END) AS attempts FROM p""")
def a22_call_stats(spark: S, sf_dir: str) -> DataFrame:
    """Prompts, calls with retries, and their counts."""
    rows = T.table(spark, sf_dir, "orders").select(F.concat("o_orderpriority", F.col("o_custkey").cast("string")).alias("chunk_text"))
    called = calls.with_calls(calls.with_extraction_prompt(rows, _TEMPLATE), flaky_model, sleep=lambda s: None)
    return calls.call_stats(called).select("chunks", "successes", "failures").crossJoin(F.broadcast(called.agg(F.sum("attempts").alias("attempts"))))  # one row by one row


@query("SELECT count(*) AS papers_cached, (SELECT count(*) FROM nation) AS warnings, 'chunks' AS chunks_dir FROM customer")
def k12_chunk_manifest(spark: S, sf_dir: str) -> DataFrame:
    """A chunk cache written and read again, and its manifest."""
    records = T.table(spark, sf_dir, "customer").select(F.col("c_custkey").cast("string").alias("paper_id"), F.col("c_name").alias("text"))
    path = scratch(spark, "chunk-cache")
    cache.write_cache(records, path)
    warnings = T.table(spark, sf_dir, "nation").select(F.col("n_name").alias("file"), F.lit("parse_failed:x").alias("warning"))
    return cache.manifest(cache.read_cache(spark, path), warnings, "chunks")


@query("SELECT c_custkey AS paper_id, CASE WHEN c_custkey % 2 = 0 THEN c_name END AS cached_text FROM customer")
def s32_cached_records(spark: S, sf_dir: str) -> DataFrame:
    """Papers with their cached record, where there is one."""
    c = T.table(spark, sf_dir, "customer")
    own = cache.with_cached(c.select(F.col("c_custkey").alias("paper_id")), c.filter("c_custkey % 2 = 0").select(F.col("c_custkey").alias("paper_id"), F.col("c_name").alias("text")))
    return own.select("paper_id", F.col("cached.text").alias("cached_text"))


@query("SELECT 'n' || n_nationkey || '.json' AS file_name, CAST(n_nationkey AS BIGINT) AS paper_no, n_name AS title FROM nation WHERE n_nationkey % 3 <> 0")
def s31_cache_files(spark: S, sf_dir: str) -> DataFrame:
    """One JSON file a record, broken ones left out."""
    n = T.table(spark, sf_dir, "nation")
    folder = scratch(spark, "cache-files")
    good = F.to_json(F.struct(F.col("n_nationkey").cast("bigint").alias("paper_no"), F.col("n_name").alias("title")))
    rows = n.select(F.concat(F.lit("n"), F.col("n_nationkey").cast("string"), F.lit(".json")).alias("f"), F.when(F.col("n_nationkey") % 3 == 0, F.lit('{"broken')).otherwise(good).alias("v")).collect()  # 25 rows
    fs = spark._jvm.org.apache.hadoop.fs.Path(folder).getFileSystem(spark._jsc.hadoopConfiguration())
    for r in rows:
        out = fs.create(spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/{r.f}"), True)
        out.write(bytearray(r.v.encode()))
        out.close()
    return cache.read_cache_files(spark, folder, "paper_no bigint, title string")


_ONE = f"SELECT doi, url, format, source FROM ({_LOCATION_SQL}) WHERE url IS NOT NULL"


@query(f"WITH l AS ({_ONE}), h AS (SELECT doi, arg_min({{'u': url, 's': source}}, url) AS h FROM l WHERE format = 'pdf' AND source IN ('unpaywall', 'core') GROUP BY 1), r AS (SELECT doi, arg_max({{'u': url, 'f': format, 's': source}}, url) AS r FROM l GROUP BY 1), p AS (SELECT CAST(o_orderkey AS VARCHAR) AS doi FROM orders) SELECT p.doi, CASE WHEN h.h IS NOT NULL THEN h.h.u WHEN r.r.f = 'pdf' THEN r.r.u END AS url, CASE WHEN h.h IS NOT NULL THEN h.h.s WHEN r.r.f = 'pdf' THEN r.r.s END AS source FROM p LEFT JOIN h USING (doi) LEFT JOIN r USING (doi)")
def j11_fallback_urls(spark: S, sf_dir: str) -> DataFrame:
    """A locator's PDF, else the address resolved earlier if it is one."""
    rows = _locations(spark, sf_dir).filter("url IS NOT NULL")
    hits = rows.filter("format = 'pdf' AND source IN ('unpaywall', 'core')").groupBy("doi").agg(F.min_by(F.struct("url", "format", "source"), "url").alias("l")).select("doi", "l.*")
    papers = T.table(spark, sf_dir, "orders").select(F.col("o_orderkey").cast("string").alias("doi"))
    return fulltext.with_fallback_url(papers, hits, rows.withColumn("seq", F.col("url"))).select("doi", "url", "source")


_OUT = "CASE WHEN label IN ('complete_full_text', 'partial_full_text') THEN doi END"


@query(f"WITH {_CLASSIFIED}, t AS (SELECT *, {_OUT} AS output_filepath FROM classified WHERE attempt = 1) SELECT 'total' AS kind, 'total_papers' AS name, (SELECT count(*) FROM documents) AS n UNION ALL SELECT 'total', 'urls_resolved', (SELECT count(*) FROM documents WHERE doc_id % 3 = 0) UNION ALL SELECT 'total', 'final_txt_saved', (SELECT count(output_filepath) FROM t) UNION ALL SELECT 'label', label, count(*) FROM t GROUP BY ALL UNION ALL SELECT 'language', language, count(*) FROM t GROUP BY ALL")
def k10_text_summary(spark: S, sf_dir: str) -> DataFrame:
    """The summary of a full-text run, written and read again."""
    texts = _classified(spark, sf_dir, 1).drop("title", "abstract", "full_text").withColumn("output_filepath", F.expr(_OUT))
    docs = T.table(spark, sf_dir, "documents").select("doc_id", (F.col("doc_id") % 3 == 0).alias("resolved"))
    out, path = fulltext.text_summary(docs, docs, texts), scratch(spark, "text-summary")
    cache.write_lines(out, path)
    return spark.read.schema(out.schema).json(path)


_TYPED = f"WITH {_STRUCTURES}, r AS ({T.RESULTS_SQL}), own AS (SELECT CAST(r.name AS VARCHAR) AS name, coalesce(nullif(lower(trim(r.type)), ''), 'other') AS type, s.smiles AS canonical_smiles, s.heavy_atoms FROM r JOIN structures s ON r.smiles = s.u), first AS (SELECT canonical_smiles, min(type || '/' || name) AS k, min(heavy_atoms) AS heavy_atoms FROM own GROUP BY 1)"


def _typed(spark: S, sf_dir: str) -> DataFrame:
    rows = T.results(spark, sf_dir).select("name", F.coalesce(X.present(F.lower(F.trim("type"))), F.lit("other")).alias("type"), "smiles").filter("smiles NOT IN ('', 'NOT FOUND')")
    return rows.withColumn("seq", F.concat_ws("/", "type", "name"))


@query(f"{_TYPED} SELECT canonical_smiles, k AS seq, heavy_atoms FROM first")
def a33_unique_structures(spark: S, sf_dir: str) -> DataFrame:
    """Valid structures, the first row of each."""
    return analysis.unique_structures(_typed(spark, sf_dir)).select("canonical_smiles", "seq", "heavy_atoms")


@query(f"{_TYPED}, t AS (SELECT *, split_part(k, '/', 1) AS type FROM first) SELECT (SELECT count(*) FROM t) AS priority_rows, (SELECT max(heavy_atoms) FROM t) AS max_heavy_atoms_priority, (SELECT count(*) FROM t WHERE type = 'other') AS other_rows, coalesce((SELECT max(heavy_atoms) FROM t WHERE type = 'other'), 0) AS max_heavy_atoms_other, (SELECT string_agg(type || '=' || n, ';' ORDER BY type) FROM (SELECT type, count(*) AS n FROM t GROUP BY 1)) AS priority_type_counts")
def a34_dataset_stats(spark: S, sf_dir: str) -> DataFrame:
    """Counts of a data set of structures."""
    rows = analysis.unique_structures(_typed(spark, sf_dir))
    out = analysis.dataset_stats(rows, rows.filter("type = 'other'"))
    return out.withColumn("priority_type_counts", F.array_join(F.transform(F.map_entries("priority_type_counts"), lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string"))), ";"))


_SCORED = "SELECT event_id, CASE WHEN event_id % 3 = 0 THEN ' ' ELSE event_type END AS abstract, CASE event_id % 4 WHEN 0 THEN 'n/a' WHEN 1 THEN NULL ELSE CAST(event_id % 11 AS VARCHAR) || '.7' END AS relevance_score FROM events"


@query(f"SELECT CAST(floor(CAST(relevance_score AS DOUBLE)) AS INT) AS relevance_score, count(*) AS papers FROM ({_SCORED}) WHERE trim(abstract) <> '' AND try_cast(relevance_score AS DOUBLE) IS NOT NULL GROUP BY 1")
def a37_score_counts(spark: S, sf_dir: str) -> DataFrame:
    """Papers with an abstract by score."""
    rows = T.table(spark, sf_dir, "events").select(F.expr(_SCORED.split(" FROM")[0].split("event_id, ", 1)[1].split(" AS abstract, ")[0]).alias("abstract"), F.expr("CASE event_id % 4 WHEN 0 THEN 'n/a' WHEN 1 THEN NULL ELSE concat(CAST(event_id % 11 AS STRING), '.7') END").alias("relevance_score"), F.lit("").alias("doi"), F.lit("").alias("title"))
    return analysis.score_counts(analysis.papers_with_abstracts(rows))


@query("SELECT doc_id AS seq, lang FROM documents ORDER BY doc_id LIMIT 50")
def f19_first_papers(spark: S, sf_dir: str) -> DataFrame:
    """The first papers for a validation run."""
    return fulltext.first_papers(T.table(spark, sf_dir, "documents").select(F.col("doc_id").alias("seq"), "lang"), 50)


@query("SELECT p_partkey, p_name || '!' AS name, coalesce(CASE WHEN p_size % 2 = 0 THEN p_brand END, '') AS brand FROM part")
def p14_without_nul(spark: S, sf_dir: str) -> DataFrame:
    """Text columns without NUL characters."""
    rows = T.table(spark, sf_dir, "part").select("p_partkey", F.expr("concat(p_name, chr(0), '!')").alias("name"), F.expr("CASE WHEN p_size % 2 = 0 THEN p_brand END").alias("brand"))
    return analysis.without_nul(rows)


@query("SELECT c_custkey AS seq, concat('10.1/', CAST(c_custkey AS VARCHAR)) AS doi, c_name AS title, 'crossref' AS source_api FROM customer")
def k01_enveloped_papers(spark: S, sf_dir: str) -> DataFrame:
    """Papers written with an envelope and read again."""
    rows = T.table(spark, sf_dir, "customer").select(F.col("c_custkey").cast("bigint").alias("seq"), F.concat(F.lit("10.1/"), F.col("c_custkey").cast("string")).alias("doi"), F.col("c_name").alias("title"), F.lit("crossref").alias("source_api"))
    path = scratch(spark, "papers")
    files.write_enveloped(rows, path, {"total": "all"})
    return spark.read.schema(RAW_PAPER).json(f"{path}/papers").select("seq", "doi", "title", "source_api")


@query("SELECT p_partkey, p_name || chr(10) || '\"' || p_brand || '\", x' AS name FROM part")
def k14_csv_results(spark: S, sf_dir: str) -> DataFrame:
    """Results written as CSV and read again, quotes and line ends included."""
    rows = T.table(spark, sf_dir, "part").select("p_partkey", F.expr("concat(p_name, chr(7), chr(10), '\"', p_brand, '\", x')").alias("name"))
    path = scratch(spark, "results-csv")
    files.write_csv(rows, path)
    return files.read_csv(spark, path).select(F.col("p_partkey").cast("bigint").alias("p_partkey"), "name")


@query("SELECT n_nationkey AS k, 'first' AS run FROM nation UNION ALL SELECT r_regionkey, 'second' FROM region")
def k02_appended_log(spark: S, sf_dir: str) -> DataFrame:
    """A log appended to and read again."""
    path = scratch(spark, "log")
    files.append_log(T.table(spark, sf_dir, "nation").select(F.col("n_nationkey").cast("bigint").alias("k"), F.lit("first").alias("run")), path)
    files.append_log(T.table(spark, sf_dir, "region").select(F.col("r_regionkey").cast("bigint").alias("k"), F.lit("second").alias("run")), path)
    return spark.read.schema("k bigint, run string").json(path)


_P = "SELECT doc_id, '10.1/' || doc_id AS doi, {title} AS title, CAST(2000 + doc_id % 9 AS INT) AS year, {keywords} AS keywords, {authors} AS authors, {journal} AS journal, {cited} AS citation_count FROM documents"


def _shown(rows: DataFrame) -> DataFrame:
    return rows.select("doc_id", "doi", "title", "year", F.array_join("keywords", "|").alias("keywords"), F.array_join("authors", "|").alias("authors"), "journal", "citation_count")


def _key() -> Column:
    return F.col("doc_id").cast("string")


def _doi() -> Column:
    return F.concat(F.lit("10.1/"), _key())


def _title() -> Column:
    return F.concat(F.lit("T "), _key())


def _year() -> Column:
    return (2000 + F.col("doc_id") % 9).cast("int")


def _mapped(spark: S, sf_dir: str, source: str, *parts) -> DataFrame:
    docs = T.table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "n_chars")
    record = F.to_json(F.struct(*[v.alias(k) for k, v in parts]))
    return _shown(payloads.raw_papers(docs.select("doc_id", record.alias("payload")), source))


_SQL_TITLE = "'T ' || doc_id"


@query(_P.format(title=_SQL_TITLE, keywords="lang", authors="'A' || doc_id", journal="CAST(NULL AS VARCHAR)", cited="n_chars"))
def s02_semantic_scholar_payloads(spark: S, sf_dir: str) -> DataFrame:
    """Records of one source as raw papers."""
    return _mapped(spark, sf_dir, "semantic_scholar", ("externalIds", F.struct(_doi().alias("DOI"))), ("title", _title()), ("year", _year()), ("s2FieldsOfStudy", F.array(F.struct(F.col("lang").alias("category")))), ("authors", F.array(F.struct(F.concat(F.lit("A"), _key()).alias("name")))), ("citationCount", F.col("n_chars")))


@query(_P.format(title=_SQL_TITLE, keywords="lang", authors="'G F' || doc_id", journal="'J'", cited="n_chars"))
def s03_crossref_payloads(spark: S, sf_dir: str) -> DataFrame:
    """Records of one source as raw papers."""
    return _mapped(spark, sf_dir, "crossref", ("DOI", _doi()), ("title", F.array(_title())), ("published", F.struct(F.array(F.array(_year(), F.lit(1))).alias("date-parts"))), ("subject", F.array("lang")), ("author", F.array(F.struct(F.lit("G").alias("given"), F.concat(F.lit("F"), _key()).alias("family")))), ("container-title", F.array(F.lit("J"))), ("is-referenced-by-count", F.col("n_chars")))


@query(_P.format(title=_SQL_TITLE, keywords="lang", authors="'A' || doc_id || '|B C'", journal="'J'", cited="n_chars"))
def s05_europe_pmc_payloads(spark: S, sf_dir: str) -> DataFrame:
    """Records of one source as raw papers."""
    return _mapped(spark, sf_dir, "europe_pmc", ("doi", _doi()), ("title", _title()), ("pubYear", _year().cast("string")), ("keywordList", F.struct(F.array("lang").alias("keyword"))), ("authorString", F.concat(F.lit("A"), _key(), F.lit(", B C"))), ("journalTitle", F.lit("J")), ("citedByCount", F.col("n_chars")), ("isOpenAccess", F.lit("Y")))


@query(_P.format(title=_SQL_TITLE, keywords="lang", authors="'A' || doc_id", journal="'J'", cited="n_chars"))
def s06_core_payloads(spark: S, sf_dir: str) -> DataFrame:
    """Records of one source as raw papers."""
    return _mapped(spark, sf_dir, "core", ("identifiers", F.array(F.lit("oai:1"), F.concat(F.lit("https://doi.org/"), _doi()))), ("title", _title()), ("yearPublished", _year()), ("fieldOfStudy", F.array("lang")), ("authors", F.array(F.struct(F.concat(F.lit("A"), _key()).alias("name")))), ("journal", F.struct(F.lit("J").alias("title"))), ("citationCount", F.col("n_chars")))


@query(_P.format(title=_SQL_TITLE, keywords="lang", authors="'G F' || doc_id", journal="'J'", cited="n_chars"))
def s07_lens_payloads(spark: S, sf_dir: str) -> DataFrame:
    """Records of one source as raw papers."""
    return _mapped(spark, sf_dir, "lens", ("external_ids", F.array(F.struct(F.lit("doi").alias("type"), _doi().alias("value")))), ("title", _title()), ("year_published", _year()), ("keywords", F.array("lang")), ("authors", F.array(F.struct(F.lit("G").alias("first_name"), F.concat(F.lit("F"), _key()).alias("last_name")))), ("source", F.struct(F.lit("J").alias("title"))), ("scholarly_citations_count", F.col("n_chars")))


@query(_P.format(title=_SQL_TITLE, keywords="lang", authors="'G F' || doc_id", journal="'J'", cited="CAST(NULL AS BIGINT)"))
def s04_pubmed_payloads(spark: S, sf_dir: str) -> DataFrame:
    """Records of one source as raw papers, out of XML."""
    docs = T.table(spark, sf_dir, "documents").select("doc_id", "lang")
    parts = [F.lit("<PubmedArticle><PMID>1</PMID><ArticleTitle>"), _title(), F.lit("</ArticleTitle><Journal><Title>J</Title></Journal><PubDate><Year>"), _year().cast("string"), F.lit("</Year></PubDate><AuthorList><Author><LastName>F"), _key(), F.lit("</LastName><ForeName>G</ForeName></Author></AuthorList><MeshHeading><DescriptorName>"), F.col("lang"), F.lit("</DescriptorName></MeshHeading><ArticleId IdType='doi'>"), _doi(), F.lit("</ArticleId></PubmedArticle>")]
    return _shown(payloads.raw_papers(docs.select("doc_id", F.concat(*parts).alias("payload")), "pubmed"))

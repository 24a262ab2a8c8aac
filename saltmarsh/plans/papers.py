"""Queries over papers: merging, translation, scores, resuming, BibTeX."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import bibtex, translate
from ..functions.domain_values import INTENTS
from ..functions.values import ABSTRACT_PRIORITY, SCORE_THRESHOLD
from ..operators import checkpoint, merge, resolve, scoring
from ..functions import text as X
from . import fixtures as T

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


NORMAL_DOI = "nullif(regexp_replace(regexp_replace(regexp_replace(regexp_replace(lower(doi), '^\\s+|\\s+$', '', 'g'), '^https://doi\\.org/', ''), '^http://doi\\.org/', ''), '^doi:', ''), '')"
NORMAL_TITLE = "CASE WHEN length({t}) > 10 THEN {t} END".format(t="trim(regexp_replace(regexp_replace(lower(strip_accents(title)), '[^a-z0-9 ]', '', 'g'), ' +', ' ', 'g'))")
_PRIORITY = "CASE source_api " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in ABSTRACT_PRIORITY.items()) + " ELSE 0 END"
MERGED = f"""
raw AS ({T.RAW_PAPERS_SQL}),
keyed AS (SELECT *, {NORMAL_DOI} AS nd, {NORMAL_TITLE} AS nt, {_PRIORITY} AS prio FROM raw),
merged AS (SELECT coalesce('doi:' || nd, 'title:' || nt, 'record:' || seq) AS k, min(seq) AS seq,
    arg_min(doi, seq) FILTER (WHERE doi <> '') AS doi, arg_min(coalesce(title, ''), seq) AS title,
    arg_max(abstract, prio * 1000000000000 - seq) FILTER (WHERE abstract <> '') AS abstract,
    arg_min(year, seq) FILTER (WHERE year <> 0) AS year,
    CASE WHEN count(*) > 1 THEN list_sort(list_distinct(flatten(list(keywords)))) ELSE arg_min(keywords, seq) END AS keywords,
    arg_max(authors, len(authors) * 1000000000000 - seq) AS authors,
    arg_min(journal, seq) FILTER (WHERE journal <> '') AS journal, max(citation_count) AS citation_count,
    arg_min(open_access, seq) FILTER (WHERE open_access IS NOT NULL) AS open_access,
    arg_min(pmid, seq) FILTER (WHERE pmid <> '') AS pmid, list_sort(list_distinct(list(source_api))) AS source_apis,
    count(*) AS n_records FROM keyed GROUP BY 1)
"""
_FLAT = ("keywords", "authors", "source_apis")


def _flat(df: DataFrame) -> DataFrame:
    return df.withColumns({c: F.array_join(c, "|") for c in _FLAT if c in df.columns})


_MERGED_COLUMNS = "seq, doi, title, abstract, year, array_to_string(keywords, '|') AS keywords, array_to_string(authors, '|') AS authors, journal, citation_count, open_access, pmid, array_to_string(source_apis, '|') AS source_apis, n_records"


@query(f"WITH {MERGED} SELECT {_MERGED_COLUMNS} FROM merged")
def a01_deduplicate_papers(spark: S, sf_dir: str) -> DataFrame:
    """Papers merged by DOI or title."""
    return _flat(merge.deduplicate(T.raw_papers(spark, sf_dir)))


@query(f"WITH {MERGED}, cut AS (SELECT CASE WHEN k LIKE 'title:%' THEN substr(k, 1, 86) ELSE k END AS c, * FROM merged) SELECT {_MERGED_COLUMNS} FROM cut QUALIFY row_number() OVER (PARTITION BY c ORDER BY seq DESC) = 1")
def a10_deduplicate_compat(spark: S, sf_dir: str) -> DataFrame:
    """The same, with titles of one 80-character prefix overwriting each other (A10)."""
    return _flat(merge.deduplicate(T.raw_papers(spark, sf_dir), compat=True))


@query(f"WITH {MERGED} SELECT count(*) AS papers, count(*) FILTER (WHERE abstract <> '') AS with_abstract, count(*) FILTER (WHERE doi <> '') AS with_doi, round(100.0 * count(*) FILTER (WHERE abstract <> '') / greatest(count(*), 1), 1) AS pct_abstract, round(100.0 * count(*) FILTER (WHERE doi <> '') / greatest(count(*), 1), 1) AS pct_doi FROM merged")
def a11_coverage(spark: S, sf_dir: str) -> DataFrame:
    return merge.coverage(merge.deduplicate(T.raw_papers(spark, sf_dir)))


@query(f"WITH raw AS ({T.RAW_PAPERS_SQL}) SELECT source_api AS source, count(*) FILTER (WHERE seq % 10 <> 0) AS ok, count(*) FILTER (WHERE seq % 10 = 0) AS fail, CAST(sum(citation_count) AS BIGINT) AS papers FROM raw GROUP BY 1")
def a12_source_stats(spark: S, sf_dir: str) -> DataFrame:
    rows = T.raw_papers(spark, sf_dir).select(F.col("source_api").alias("source"), F.when(F.col("seq") % 10 == 0, "failed").otherwise("ok").alias("status"), F.col("citation_count").alias("papers"))
    return merge.source_stats(rows)


@query(f"WITH raw AS ({T.RAW_PAPERS_SQL}) SELECT seq, {NORMAL_DOI} AS doi_key, {NORMAL_TITLE} AS title_key FROM raw")
def x01_paper_keys(spark: S, sf_dir: str) -> DataFrame:
    """Normalised DOIs and titles."""
    return T.raw_papers(spark, sf_dir).select("seq", X.normal_doi("doi").alias("doi_key"), X.normal_title("title").alias("title_key"))


def intents(spark: S) -> DataFrame:
    return spark.createDataFrame(INTENTS, "id string, must_contain array<string>, any_of array<string>")


def _list(xs) -> str:
    return "CAST([" + ", ".join("'" + x.replace("'", "''") + "'" for x in xs) + "] AS VARCHAR[])"


_INTENTS = "intents AS (" + " UNION ALL ".join(f"SELECT '{i}' AS id, {_list(m)} AS m, {_list(a)} AS o" for i, m, a in INTENTS) + ")"


def _both(must: str, some: str) -> str:
    return f"{must} || CASE WHEN len(o) > 0 THEN ' AND (' || {some} || ')' ELSE '' END"


def _join(lst: str, form: str, by: str) -> str:
    return f"array_to_string(list_transform({lst}, lambda x: {form}), '{by}')"


_PUBMED = "'\"' || x || '\"[Title/Abstract]'"
_EPMC = "'TITLE:\"' || x || '\" OR ABSTRACT:\"' || x || '\"'"
_PHRASE = "'{\"match_phrase\":{\"title_abstract_keyword\":\"' || x || '\"}}'"
_QUERIES = {
    "openalex": "array_to_string(m || o[1:3], ' ')",
    "semantic_scholar": "array_to_string(m || o[1:2], ' ')",
    "crossref": "'{\"query\":\"' || array_to_string(m, ' ') || '\"' || CASE WHEN len(o) > 0 THEN ',\"query.bibliographic\":\"' || array_to_string(o[1:3], ' ') || '\"' ELSE '' END || '}'",
    "pubmed": _both(_join("m", _PUBMED, " AND "), _join("o", _PUBMED, " OR ")),
    "europe_pmc": _both(_join("m", f"'(' || {_EPMC} || ')'", " AND "), _join("o", _EPMC, " OR ")),
    "core": "array_to_string(m || o[1:2], ' ')",
    "lens": "'{\"query\":{\"bool\":{\"must\":[' || " + _join("m", _PHRASE, ",") + " || ']' || CASE WHEN len(o) > 0 THEN ',\"should\":[' || " + _join("o", _PHRASE, ",") + " || '],\"minimum_should_match\":1' ELSE '' END || '}}}'",
    "dimensions": "'search publications for ' || " + _join("m || o", "'\"' || x || '\"'", " ") + " || ' return publications [doi+title+abstract+year+keywords+journal+authors] limit 1000'",
}


@query(f"WITH {_INTENTS} " + " UNION ALL ".join(f"SELECT '{s}' AS source, id, {q} AS query FROM intents" for s, q in _QUERIES.items()))
def t11_query_plan(spark: S, sf_dir: str) -> DataFrame:
    """All intents in all query languages."""
    return translate.query_plan(intents(spark))


_PARSED = f"""
raw AS (SELECT *, trim(coalesce(answer, '')) AS t FROM ({T.ANSWERS_SQL})),
found AS (SELECT *, regexp_extract(t, '(\\{{[^{{}}]*\\}})', 1) AS j, TRY_CAST(nullif(regexp_extract(t, '\\b([0-9]{{1,2}})\\b', 1), '') AS INT) AS n FROM raw),
read AS (SELECT *, CASE WHEN j <> '' AND json_valid(j) THEN json_extract_string(j, '$.score') END AS s, CASE WHEN j <> '' AND json_valid(j) THEN json_extract_string(j, '$.reason') END AS r FROM found),
numbers AS (SELECT *, CASE WHEN TRY_CAST(s AS DOUBLE) BETWEEN -1e9 AND 1e9 THEN CAST(least(10, greatest(0, trunc(TRY_CAST(s AS DOUBLE)))) AS INT) END AS own, CASE WHEN n <= 10 THEN n END AS bare FROM read),
scored AS (SELECT seq, title, abstract, answer, coalesce(own, bare) AS relevance_score, CASE WHEN own IS NOT NULL THEN coalesce(r, '') WHEN bare IS NOT NULL THEN substr(t, 1, 200) ELSE '' END AS relevance_reason, CASE WHEN coalesce(abstract, '') <> '' THEN 'high' ELSE 'low' END AS score_confidence FROM numbers)
"""


def _scored(spark: S, sf_dir: str) -> DataFrame:
    return scoring.with_scores(T.answers(spark, sf_dir))


@query(f"WITH {_PARSED} SELECT * FROM scored")
def n01_parse_scores(spark: S, sf_dir: str) -> DataFrame:
    """Scores read out of answers."""
    return _scored(spark, sf_dir)


@query(f"WITH {_PARSED} SELECT seq, relevance_score FROM scored WHERE relevance_score >= {SCORE_THRESHOLD}")
def f01_at_threshold(spark: S, sf_dir: str) -> DataFrame:
    return scoring.at_least(_scored(spark, sf_dir)).select("seq", "relevance_score")


@query(f"WITH {_PARSED} SELECT seq, relevance_score FROM scored WHERE trim(abstract) <> '' AND relevance_score IS NOT NULL")
def f03_abstract_and_score(spark: S, sf_dir: str) -> DataFrame:
    return scoring.with_abstract_and_score(_scored(spark, sf_dir)).select("seq", "relevance_score")


@query(f"WITH {_PARSED} SELECT relevance_score AS score, count(*) AS papers FROM scored WHERE relevance_score IS NOT NULL GROUP BY 1")
def a14_score_distribution(spark: S, sf_dir: str) -> DataFrame:
    return scoring.distribution(_scored(spark, sf_dir))


@query(f"WITH {_PARSED} SELECT coalesce(relevance_score, -1) AS score, count(*) AS papers FROM scored GROUP BY 1")
def a15_peek_distribution(spark: S, sf_dir: str) -> DataFrame:
    return scoring.distribution(_scored(spark, sf_dir), missing=-1)


@query(f"WITH {_PARSED} SELECT count(*) AS total, count(relevance_score) AS scored, count(*) - count(relevance_score) AS failed, count(*) FILTER (WHERE relevance_score >= 6) AS above, count(*) FILTER (WHERE relevance_score < 6) AS below FROM scored")
def a16_score_counters(spark: S, sf_dir: str) -> DataFrame:
    return scoring.counters(_scored(spark, sf_dir))


@query(f"WITH {_PARSED} SELECT seq, relevance_score FROM scored ORDER BY relevance_score DESC NULLS LAST, seq LIMIT 20")
def w05_top_papers(spark: S, sf_dir: str) -> DataFrame:
    return scoring.top(_scored(spark, sf_dir)).select("seq", "relevance_score")


@query(f"SELECT seq, 'Title: ' || coalesce(nullif(title, ''), '(no title)') || chr(10) || 'Abstract: ' || coalesce(CASE WHEN length(abstract) > 2000 THEN substr(abstract, 1, 2000) || '…' ELSE nullif(abstract, '') END, '(no abstract available — score based on title only)') AS prompt FROM ({T.RAW_PAPERS_SQL})")
def p05_score_prompts(spark: S, sf_dir: str) -> DataFrame:
    return scoring.with_prompt(T.raw_papers(spark, sf_dir), "Title: {title}\nAbstract: {abstract}").select("seq", "prompt")


@query(f"SELECT seq, title FROM ({T.RAW_PAPERS_SQL}) WHERE trim(coalesce(title, '')) <> '' ORDER BY md5('42:' || seq), seq LIMIT 50")
def w11_seeded_sample(spark: S, sf_dir: str) -> DataFrame:
    """The seeded sample of fifty titles."""
    return scoring.seeded_sample(T.raw_papers(spark, sf_dir)).select("seq", "title")


@query("SELECT user_id, event_id, event_type, value FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) = 1")
def s13_last_record_wins(spark: S, sf_dir: str) -> DataFrame:
    """The log's last record of each key."""
    log = T.table(spark, sf_dir, "events").select("user_id", "event_id", "event_type", "value")
    return checkpoint.last_wins(log, F.col("user_id"), "event_id")


_RESUME = "WITH p AS (SELECT c_custkey AS k FROM customer), d AS (SELECT DISTINCT user_id AS k FROM events WHERE event_type <> 'click')"


@query(f"{_RESUME} SELECT p.k, CASE WHEN d.k IS NULL THEN 'pending' ELSE 'done' END AS status FROM p LEFT JOIN d ON p.k = d.k")
def j02_resume(spark: S, sf_dir: str) -> DataFrame:
    """Finished and pending keys."""
    papers = T.table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("k"))
    done = T.table(spark, sf_dir, "events").filter("event_type <> 'click'").select(F.col("user_id").alias("k"))
    old, new = checkpoint.resume(papers, done, "k")
    return old.withColumn("status", F.lit("done")).unionByName(new.withColumn("status", F.lit("pending")))


_VALID = ("CASE c_custkey % 3 WHEN 0 THEN 'paper+metadata' WHEN 1 THEN 'paper_only' ELSE 'metadata_only' END", "CASE c_custkey % 2 WHEN 0 THEN 'xml' END", "c_custkey % 4")
_LOGGED = ("CASE o_custkey % 5 WHEN 0 THEN 'metadata_only' ELSE 'paper_only' END", "CASE o_custkey % 2 WHEN 0 THEN 'xml' END", "o_custkey % 8")


@query(f"""WITH p AS (SELECT c_custkey AS paper_id, {_VALID[0]} AS source, {_VALID[1]} AS source_format, {_VALID[2]} AS num_chunks FROM customer),
l AS (SELECT DISTINCT o_custkey AS paper_id, {_LOGGED[0]} AS ls, {_LOGGED[1]} AS lf, {_LOGGED[2]} AS ln FROM orders)
SELECT p.*, coalesce(replace(source, '+metadata', '_only') = replace(ls, '+metadata', '_only') AND source_format IS NOT DISTINCT FROM lf AND num_chunks = ln, false) AS done FROM p LEFT JOIN l USING (paper_id)""")
def j05_resume_valid(spark: S, sf_dir: str) -> DataFrame:
    """Papers whose log record still fits."""
    papers = T.table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("paper_id"), *[F.expr(e).alias(c) for e, c in zip(_VALID, ("source", "source_format", "num_chunks"), strict=True)])
    log = T.table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("paper_id"), *[F.expr(e).alias(c) for e, c in zip(_LOGGED, ("source", "source_format", "num_chunks"), strict=True)]).distinct()
    return checkpoint.resume_valid(papers, log)


@query("SELECT o_orderkey AS seq, CASE o_orderkey % 3 WHEN 0 THEN 'a:1' WHEN 1 THEN 'b:1' ELSE 'c:1' END AS host FROM orders")
def j22_assign_hosts(spark: S, sf_dir: str) -> DataFrame:
    """Hosts in turn."""
    rows = T.table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("seq"))
    return checkpoint.assign_hosts(rows, ["a:1", "b:1", "a:1", "c:1"])


_ESC = "trim(regexp_replace(replace(replace(replace(coalesce({c}, ''), '\\', '\\\\'), '{{', '\\{{'), '}}', '\\}}'), '\\s+', ' ', 'g'))"
_BIB = f"""
papers AS ({T.RAW_PAPERS_SQL}),
firsts AS (SELECT * FROM papers QUALIFY row_number() OVER (PARTITION BY lower(trim(coalesce(nullif(trim(doi), ''), title, ''))), CASE WHEN lower(trim(coalesce(nullif(trim(doi), ''), title, ''))) = '' THEN seq END ORDER BY seq) = 1),
placed AS (SELECT *, row_number() OVER (ORDER BY seq) AS position FROM firsts),
keyed AS (SELECT *, coalesce(nullif(substr(regexp_replace(coalesce(nullif(trim(doi), ''), coalesce('Family' || CASE WHEN len(authors) > 0 THEN CAST(seq % 13 AS VARCHAR) END, 'unknown') || coalesce(CAST(nullif(year, 0) AS VARCHAR), 'nd') || coalesce(nullif(regexp_extract(trim(title), '^(\\S+)', 1), ''), 'untitled') || position), '[^A-Za-z0-9]+', '', 'g'), 1, 60), ''), 'entry') AS entry_key FROM placed)
"""
_BIB_FIELDS = [("title", _ESC.format(c="title")), ("author", "array_to_string(authors, ' and ')"), ("journal", "coalesce(journal, '')"), ("year", "CAST(year AS VARCHAR)"), ("doi", _ESC.format(c="doi")), ("pmid", "pmid"), ("abstract", _ESC.format(c="abstract")), ("keywords", "array_to_string(keywords, '; ')"), ("citation_count", "CAST(citation_count AS VARCHAR)"), ("open_access", "CAST(open_access AS VARCHAR)"), ("source_apis", "source_api")]


@query(f"WITH {_BIB} SELECT seq, position, '@' || CASE WHEN coalesce(journal, '') <> '' THEN 'article' ELSE 'misc' END || '{{' || entry_key || ',' || " + " || ".join(f"CASE WHEN coalesce({v}, '') <> '' THEN chr(10) || '  {k} = {{' || {v} || '}},' ELSE '' END" for k, v in _BIB_FIELDS) + " || chr(10) || '}' AS entry FROM keyed")
def p11_bibtex(spark: S, sf_dir: str) -> DataFrame:
    """BibTeX entries of unique papers."""
    papers = T.raw_papers(spark, sf_dir).withColumns({"source_apis": F.array("source_api"), "relevance_score": F.lit(None).cast("int"), "relevance_reason": F.lit(None).cast("string"), "score_confidence": F.lit(None).cast("string")})
    numbered = resolve.numbered(bibtex.unique_papers(papers))
    return numbered.select("seq", F.col("position").cast("long").alias("position"), bibtex.entry().alias("entry"))

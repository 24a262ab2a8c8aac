"""Queries over documents: cleaning, grading, fallback, chunks, metadata, pages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as X
from ..functions import values as V
from ..operators import chunking, fulltext
from ..sources import markup, payloads
from ..storage import spread
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


def sql_strip(c: str) -> str:
    return f"regexp_replace({c}, '^\\s+|\\s+$', '', 'g')"


def sql_clean(c: str) -> str:
    return sql_strip(f"regexp_replace(regexp_replace(replace(replace(coalesce({c}, ''), chr(13), chr(10)), chr(160), ' '), '\\n{{3,}}', chr(10) || chr(10), 'g'), '[ \\t]{{2,}}', ' ', 'g')".replace("{{", "{").replace("}}", "}"))


_DIRTY = "concat('  ', replace(text, '. ', concat('.', chr(13), chr(10), chr(10), chr(10), '   ')), chr(160), ' ')"


@query(f"SELECT doc_id, {sql_clean(_DIRTY)} AS cleaned FROM documents")
def x03_clean_text(spark: S, sf_dir: str) -> DataFrame:
    """Line ends, blank lines and blanks put right."""
    docs = T.table(spark, sf_dir, "documents")
    return docs.select("doc_id", X.clean(F.expr(_DIRTY)).alias("cleaned"))


_STOPS = "[" + ", ".join(f"'{w}'" for w in V.STOP_WORDS) + "]"


def language_ctes(src: str, text: str) -> str:
    """CTE `spoken`: the rows of `src` with their language."""
    return f"""
sampled AS (SELECT *, {sql_strip(text)} AS _t, substr({sql_strip(text)}, 1, 6000) AS _s FROM {src}),
tokens AS (SELECT *, regexp_extract_all(lower(_s), '[a-z]+') AS _k, length(regexp_replace(_s, '[^A-Za-z]', '', 'g')) AS _l FROM sampled),
spoken AS (SELECT *, CASE WHEN length(_t) < 80 OR len(regexp_extract_all(_s, '[A-Za-z]+')) < 40 THEN 'unknown'
    WHEN _l / greatest(length(_s), 1) > 0.60 AND len(list_filter(_k, lambda x: list_contains({_STOPS}, x))) / greatest(len(_k), 1) > 0.04 THEN 'en'
    WHEN _l / greatest(length(_s), 1) < 0.35 THEN 'non-en' ELSE 'unknown' END AS language FROM tokens)"""


@query(f"WITH {language_ctes('documents', 'text')} SELECT doc_id, language FROM spoken")
def x12_language(spark: S, sf_dir: str) -> DataFrame:
    """Language by letters and function words."""
    return T.table(spark, sf_dir, "documents").select("doc_id", X.language("text").alias("language"))


def _markers(c: str, markers: list[str]) -> str:
    return "(" + " + ".join(f"CAST(contains({c}, '{m}') AS INT)" for m in markers) + ")"


_CLASSIFIED = f"""
raw AS ({T.EXTRACTED_SQL}),
safe AS (SELECT doi, attempt, source_format, coalesce(nullif({sql_clean("title")}, ''), 'N/A') AS t0, coalesce(nullif({sql_clean("abstract")}, ''), 'N/A') AS abstract, coalesce(nullif({sql_clean("full_text")}, ''), 'N/A') AS full_text FROM raw),
titled AS (SELECT * EXCLUDE (t0), CASE WHEN t0 = 'N/A' AND abstract = 'N/A' AND full_text <> 'N/A' THEN coalesce(nullif({sql_clean("substr(split_part(full_text, chr(10), 1), 1, 300)")}, ''), 'N/A') ELSE t0 END AS title FROM safe),
joined AS (SELECT *, title || chr(10) || abstract || chr(10) || full_text AS _all, abstract || chr(10) || full_text AS _m FROM titled),
{language_ctes("joined", "_all")},
lined AS (SELECT *, lower(_m) AS _low, list_filter(list_transform(string_split(_m, chr(10)), lambda x: {sql_strip("x")}), lambda x: x <> '') AS _lines FROM spoken),
points AS (SELECT *, CASE WHEN {_markers("_low", V.BOILERPLATE_MARKERS)} >= 2 THEN 2 ELSE 0 END + CASE WHEN len(regexp_extract_all(_m, '{V.MOJIBAKE}')) >= 5 THEN 1 ELSE 0 END
    + CASE WHEN len(_lines) > 0 AND len(list_filter(_lines, lambda x: length(x) <= 3)) / len(_lines) > 0.08 THEN 1 ELSE 0 END
    + CASE WHEN regexp_matches(_low, '(?s)\\bfigure\\s+\\d+\\b.{{0,120}}click here to view figure') THEN 1 ELSE 0 END AS points,
    ({_markers("lower(title || chr(10) || abstract || chr(10) || full_text)", V.NON_ARTICLE_MARKERS)} >= 2 AND length(full_text) < 1800) OR (length(full_text) < 300 AND length(abstract) < 120) AS none,
    CASE WHEN length(full_text) >= 4000 THEN 'complete_full_text' WHEN length(full_text) >= 1200 THEN 'partial_full_text' WHEN length(abstract) >= 120 THEN 'abstract_only' WHEN title <> '' AND title <> 'N/A' THEN 'title_only' ELSE 'metadata_only' END AS l0 FROM lined),
lowered AS (SELECT *, CASE WHEN points >= 2 AND l0 = 'complete_full_text' THEN 'partial_full_text' ELSE l0 END AS l1 FROM points),
labelled AS (SELECT *, CASE WHEN none THEN 'non_article' WHEN points >= 3 AND l1 IN ('complete_full_text', 'partial_full_text') THEN CASE WHEN abstract <> 'N/A' THEN 'abstract_only' ELSE 'title_only' END ELSE l1 END AS label FROM lowered),
classified AS (SELECT doi, attempt, source_format, title, abstract, full_text, language, label, CASE WHEN label IN ('non_article', 'metadata_only', 'title_only') THEN 'failed' WHEN label = 'complete_full_text' THEN 'ok' ELSE 'partial' END AS extraction_status, language = 'en' AS is_english FROM labelled)
"""


def _classified(spark: S, sf_dir: str, attempt: int | None = None) -> DataFrame:
    rows = T.extracted(spark, sf_dir)
    return fulltext.classify(rows if attempt is None else rows.filter(F.col("attempt") == attempt))


@query(f"WITH {_CLASSIFIED} SELECT doi, attempt, title, language, label, extraction_status, is_english FROM classified")
def x15_classify_extractions(spark: S, sf_dir: str) -> DataFrame:
    """Labels of all extraction attempts."""
    return _classified(spark, sf_dir).select("doi", "attempt", "title", "language", "label", "extraction_status", "is_english")


@query(f"WITH {_CLASSIFIED} SELECT label, count(*) AS documents FROM classified GROUP BY 1")
def a18_label_breakdown(spark: S, sf_dir: str) -> DataFrame:
    return fulltext.label_breakdown(_classified(spark, sf_dir))


@query(f"WITH {_CLASSIFIED} SELECT doi, attempt FROM classified WHERE label IN ('partial_full_text', 'complete_full_text')")
def f13_full_text_only(spark: S, sf_dir: str) -> DataFrame:
    return fulltext.full_text_only(_classified(spark, sf_dir)).select("doi", "attempt")


_RANK = "CASE label " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in V.LABEL_RANK.items()) + " ELSE 0 END"
_LONGEST = "coalesce(arg_max(trim({c}), length(trim({c})) * 10 - attempt) FILTER (WHERE trim({c}) NOT IN ('', 'N/A')), 'N/A') AS {c}"
_BEST = f"arg_max({{c}}, CAST(is_english AS INT) * 1000 + {_RANK} * 10 - attempt) AS {{c}}"
_BEST_COLUMNS = ["source_format", "language", "label", "extraction_status", "is_english"]


@query(f"WITH {_CLASSIFIED} SELECT doi, count(*) AS attempts, {_LONGEST.format(c='title')}, {_LONGEST.format(c='abstract')}, arg_max(attempt, CAST(is_english AS INT) * 1000 + {_RANK} * 10 - attempt) AS attempt, " + ", ".join(_BEST.format(c=c) for c in _BEST_COLUMNS) + " FROM classified GROUP BY doi")
def a19_best_candidate(spark: S, sf_dir: str) -> DataFrame:
    """The best attempt of each paper, with the longest fields of all."""
    return fulltext.best_candidate(_classified(spark, sf_dir).drop("full_text"))


@query(f"""WITH {_CLASSIFIED}, a AS (SELECT * FROM classified WHERE attempt = 0),
b AS (SELECT * FROM classified c WHERE attempt = 1 AND NOT EXISTS (SELECT 1 FROM a WHERE a.doi = c.doi AND a.label IN ('partial_full_text', 'complete_full_text'))),
d AS (SELECT * FROM classified c WHERE attempt = 2 AND NOT EXISTS (SELECT 1 FROM (FROM a UNION ALL FROM b) x WHERE x.doi = c.doi AND x.label IN ('partial_full_text', 'complete_full_text'))),
every AS (FROM a UNION ALL FROM b UNION ALL FROM d)
SELECT doi, count(*) AS attempts, arg_max(source_format, CAST(is_english AS INT) * 1000 + {_RANK} * 10 - attempt) AS source_format, arg_max(label, CAST(is_english AS INT) * 1000 + {_RANK} * 10 - attempt) AS label FROM every GROUP BY doi""")
def j21_staged_fallback(spark: S, sf_dir: str) -> DataFrame:
    """HTML, then XML, then PDF, each for papers without a full text so far."""
    papers = T.extracted(spark, sf_dir).select("doi").distinct()
    steps = [(f, lambda left, i=i: _classified(spark, sf_dir, i).drop("attempt", "source_format", "full_text").join(left.select("doi"), "doi", "left_semi")) for i, f in enumerate(("html", "xml", "pdf"))]
    return fulltext.staged_fallback(papers, steps).select("doi", "attempts", "source_format", "label")


_LOCATIONS = ["pmc_xml", "epmc_xml", "unpaywall", "semantic_scholar", "core", "crossref_link"]
_LOC = "element_at({l}, CAST((l_orderkey + l_linenumber) % 6 + 1 AS INT))"
_LOCATION_SQL = f"SELECT CAST(l_orderkey AS STRING) AS doi, [{', '.join(repr(x) for x in _LOCATIONS)}][CAST((l_orderkey + l_linenumber) % 6 + 1 AS INT)] AS source, CASE WHEN l_linenumber % 3 = 0 THEN NULL ELSE concat('https://x/', CAST(l_orderkey AS STRING), '/', CAST(l_linenumber AS STRING)) END AS url, CASE l_linenumber % 2 WHEN 0 THEN 'xml' ELSE 'pdf' END AS format FROM lineitem"


def _locations(spark: S, sf_dir: str) -> DataFrame:
    t = spread(T.table(spark, sf_dir, "lineitem"), "l_orderkey").select("l_orderkey", "l_linenumber")
    source = _LOC.format(l=f"array({', '.join(repr(x) for x in _LOCATIONS)})")
    return t.select(F.expr("CAST(l_orderkey AS STRING)").alias("doi"), F.expr(source).alias("source"), F.expr("CASE WHEN l_linenumber % 3 = 0 THEN NULL ELSE concat('https://x/', CAST(l_orderkey AS STRING), '/', CAST(l_linenumber AS STRING)) END").alias("url"), F.expr("CASE l_linenumber % 2 WHEN 0 THEN 'xml' ELSE 'pdf' END").alias("format"))


_FIRST = f"SELECT doi, url, format, source FROM ({_LOCATION_SQL}) WHERE url IS NOT NULL {{w}} QUALIFY row_number() OVER (PARTITION BY doi ORDER BY list_position([{', '.join(repr(x) for x in _LOCATIONS)}], source), url) = 1"


@query(_FIRST.format(w=""))
def j18_first_location(spark: S, sf_dir: str) -> DataFrame:
    """The location of the most preferred locator."""
    return fulltext.first_location(_locations(spark, sf_dir))


@query(_FIRST.format(w="AND format = 'xml'"))
def j19_first_xml_location(spark: S, sf_dir: str) -> DataFrame:
    """The same for one format."""
    return fulltext.first_location(_locations(spark, sf_dir), wanted="xml")


_STEM = "regexp_replace(file_stem, '^(\\d{4}|unknown)_', '')"
_FILE_DOI = f"regexp_replace({_STEM}, '^(.*?)__', '\\1/')"


@query(f"SELECT file_no, {_FILE_DOI} AS doi, nullif(nullif(regexp_extract(file_stem, '^(\\d{{4}}|unknown)_', 1), 'unknown'), '') AS year, lower(regexp_replace(regexp_replace({_FILE_DOI}, '[^A-Za-z0-9]+', '_', 'g'), '^_+|_+$', '', 'g')) AS slug, coalesce(nullif(regexp_extract(file_stem, '^(\\d{{4}}|unknown)_', 1), 'unknown'), 'unknown') || '_' || substr(regexp_replace(replace({_FILE_DOI}, '/', '__'), '[<>:\"/\\\\|?*]', '_', 'g'), 1, 200) || '.xml' AS file_name FROM ({T.FILES_SQL})")
def x07_file_names(spark: S, sf_dir: str) -> DataFrame:
    """DOI, year and slug of file names, and the name of a DOI."""
    f = T.files(spark, sf_dir)
    doi, year = X.filename_doi("file_stem"), X.filename_year("file_stem")
    return f.select("file_no", doi.alias("doi"), year.alias("year"), X.slug(doi).alias("slug"), X.doi_filename(doi, F.lit("xml"), year).alias("file_name"))


_ND = "nullif(regexp_replace(lower(trim({c})), '^https://doi\\.org/', ''), '')"
_SLUG = "lower(regexp_replace(regexp_replace({c}, '[^A-Za-z0-9]+', '_', 'g'), '^_+|_+$', '', 'g'))"
_MATCH = f"f AS (SELECT *, {_FILE_DOI} AS fd, nullif(nullif(regexp_extract(file_stem, '^(\\d{{4}}|unknown)_', 1), 'unknown'), '') AS fy FROM ({T.FILES_SQL})), m AS (SELECT *, {_ND.format(c='doi')} AS nd FROM ({T.METADATA_SQL})), md AS (SELECT *, nd AS k FROM m QUALIFY row_number() OVER (PARTITION BY nd ORDER BY seq DESC) = 1), ms AS (SELECT *, {_SLUG.format(c='nd')} AS k FROM m QUALIFY row_number() OVER (PARTITION BY {_SLUG.format(c='nd')} ORDER BY seq DESC) = 1)"


@query(f"WITH {_MATCH} SELECT f.file_no, coalesce(CASE WHEN md.k IS NOT NULL THEN nullif(md.doi, '') WHEN ms.k IS NOT NULL THEN nullif(ms.doi, '') END, fd) AS doi, coalesce(CAST(CASE WHEN md.k IS NOT NULL THEN md.year ELSE ms.year END AS VARCHAR), fy) AS year, nullif(CASE WHEN md.k IS NOT NULL THEN md.title ELSE ms.title END, '') AS title, nullif(CASE WHEN md.k IS NOT NULL THEN md.abstract ELSE ms.abstract END, '') AS abstract, md.k IS NOT NULL OR ms.k IS NOT NULL AS metadata_found FROM f LEFT JOIN md ON md.k = {_ND.format(c='fd')} LEFT JOIN ms ON ms.k = {_SLUG.format(c='fd')}")
def j07_match_metadata(spark: S, sf_dir: str) -> DataFrame:
    """Files with their metadata by DOI, else slug."""
    out = chunking.match_metadata(T.files(spark, sf_dir), T.metadata(spark, sf_dir))
    return out.select("file_no", "doi", "year", "title", "abstract", "metadata_found")


@query(f"WITH {_MATCH} SELECT m.doi, m.title, {sql_clean('m.abstract')} AS text, 'metadata_only' AS source FROM m WHERE NOT EXISTS (SELECT 1 FROM f WHERE {_ND.format(c='fd')} = m.nd) AND {sql_clean('m.abstract')} <> ''")
def j08_metadata_only(spark: S, sf_dir: str) -> DataFrame:
    """Abstracts of papers without a file."""
    return chunking.metadata_only(T.metadata(spark, sf_dir), T.files(spark, sf_dir)).select("doi", "title", "text", "source")


_CACHE = ("CASE WHEN c_custkey % 2 = 0 THEN 'metadata_only' ELSE 'paper_only' END", "CASE WHEN c_custkey % 3 = 0 THEN '' ELSE concat('old ', c_name) END")
_NEW = ("CASE WHEN k % 3 = 0 THEN 'metadata_only' ELSE 'paper+metadata' END", "concat('new ', CAST(k AS STRING))")


@query(f"""WITH c AS (SELECT c_custkey AS paper_id, {_CACHE[0]} AS source, {_CACHE[1]} AS title FROM customer), n AS (SELECT k AS paper_id, {_NEW[0]} AS source, {_NEW[1]} AS title FROM (SELECT DISTINCT o_custkey + 100 AS k FROM orders))
SELECT coalesce(c.paper_id, n.paper_id) AS paper_id, CASE WHEN c.paper_id IS NULL OR (c.source = 'metadata_only' AND n.source <> 'metadata_only') THEN n.source ELSE coalesce(nullif(c.source, ''), n.source) END AS source, CASE WHEN c.paper_id IS NULL OR (c.source = 'metadata_only' AND n.source <> 'metadata_only') THEN n.title ELSE coalesce(nullif(c.title, ''), n.title) END AS title FROM c FULL JOIN n ON c.paper_id = n.paper_id""")
def j09_upgrade_cache(spark: S, sf_dir: str) -> DataFrame:
    """A cache met by new records."""
    c = T.table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("paper_id"), F.expr(_CACHE[0]).alias("source"), F.expr(_CACHE[1]).alias("title"))
    n = T.table(spark, sf_dir, "orders").select((F.col("o_custkey") + 100).alias("k")).distinct().select(F.col("k").alias("paper_id"), F.expr(_NEW[0]).alias("source"), F.expr(_NEW[1]).alias("title"))
    return chunking.upgrade_cache(c, n)


_A, _B = sql_clean("substr(text, 1, 200)"), sql_clean("CASE WHEN doc_id % 2 = 0 THEN text ELSE substr(text, 400) END")


@query(f"SELECT doc_id, CASE WHEN a = '' THEN b WHEN b = '' THEN a WHEN contains(substr(b, 1, 1200), substr(a, 1, 120)) THEN b ELSE a || chr(10) || chr(10) || b END AS merged FROM (SELECT doc_id, {_A} AS a, {_B} AS b FROM documents)")
def x10_merge_texts(spark: S, sf_dir: str) -> DataFrame:
    """Abstract and body as one text."""
    docs = T.table(spark, sf_dir, "documents")
    return docs.select("doc_id", X.merged_text(F.expr("substr(text, 1, 200)"), F.expr("CASE WHEN doc_id % 2 = 0 THEN text ELSE substr(text, 400) END")).alias("merged"))


def chunk_sql(most: int, overlap: int) -> str:
    """Chunks by a recursive query: the end of each is found in the reversed tail."""
    begin = "CASE WHEN e < n THEN e - {o} ELSE n END".format(o=overlap)
    blank = "(CASE WHEN strpos(reverse(substr(text, greatest(s, h - 500) + 1, h - greatest(s, h - 500))), chr(10) || chr(10)) > 0 THEN h - strpos(reverse(substr(text, greatest(s, h - 500) + 1, h - greatest(s, h - 500))), chr(10) || chr(10)) - 1 ELSE -1 END)"
    stop = "(CASE WHEN strpos(reverse(substr(text, greatest(s, h - 300) + 1, h - greatest(s, h - 300))), ' .') > 0 THEN h - strpos(reverse(substr(text, greatest(s, h - 300) + 1, h - greatest(s, h - 300))), ' .') - 1 ELSE -1 END)"
    end = f"CASE WHEN h >= n THEN h WHEN {blank} > s THEN {blank} WHEN {stop} > s THEN {stop} + 1 ELSE h END"
    return f"""WITH RECURSIVE d AS (SELECT doc_id, text, length(text) AS n FROM documents),
first AS (SELECT doc_id, text, n, 0 AS s, least({most}, n) AS h FROM d),
walk AS (SELECT doc_id, text, n, s, {end} AS e FROM first
  UNION ALL SELECT doc_id, text, n, s, {end} AS e FROM (SELECT doc_id, text, n, {begin} AS s, least({begin} + {most}, n) AS h FROM walk WHERE e < n AND n > {most}))
SELECT doc_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY s) AS INT) AS chunk_no, CAST(s AS INT) AS char_start, CAST(e AS INT) AS char_end, CASE WHEN n <= {most} THEN text ELSE {sql_strip('substr(text, s + 1, e - s)')} END AS chunk_text FROM walk WHERE n <= {most} OR {sql_strip('substr(text, s + 1, e - s)')} <> ''"""


@query(chunk_sql(2000, 200))
def x11_chunks(spark: S, sf_dir: str) -> DataFrame:
    """Overlapping chunks of all documents."""
    docs = spread(T.table(spark, sf_dir, "documents"), "doc_id").select("doc_id", "text")
    return chunking.chunks(docs, 2000, 200, "doc_id").drop("chunk_id")


@query()
def s27_pages(spark: S, sf_dir: str) -> DataFrame:
    """Title, abstract and text of raw pages."""
    pages = spread(T.table(spark, sf_dir, "pages"), "page_id").select("page_id", F.concat(F.lit("p"), F.col("page_id").cast("string"), F.lit(".html")).alias("path"), F.encode("html", "UTF-8").alias("content"))
    return markup.extracted(pages, "page_id").select("page_id", "format", "title", "abstract", "full_text")


@query("SELECT doc_id, array_to_string(string_split(text, ' '), ' ') AS abstract FROM documents")
def p03_inverted_index(spark: S, sf_dir: str) -> DataFrame:
    """Texts rebuilt from their inverted indexes."""
    docs = spread(T.table(spark, sf_dir, "documents").select("doc_id", "text"), "doc_id").select("doc_id", payloads.inverted_index("text").alias("i"))
    return docs.select("doc_id", payloads.inverted_text("i").alias("abstract"))

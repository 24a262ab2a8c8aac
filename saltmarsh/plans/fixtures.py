"""The domain's relations derived from the driver's tables: the same rule for Spark and, as SQL, for DuckDB."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.values import SOURCES
from ..storage import spread


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _case(number: str, values: list[str]) -> str:
    return f"CASE {number} " + " ".join(f"WHEN {i} THEN {v}" for i, v in enumerate(values)) + " END"


_NUMBER = "CAST(CAST((doc_id - doc_id % 5) / 5 AS BIGINT) AS STRING)"
_TITLE = "split_part(text, chr(10), 1)"
#: Columns of raw_papers that both engines read alike.
_PAPER = {
    "seq": "doc_id",
    "doi": f"CASE WHEN doc_id % 3 = 0 THEN NULL ELSE {_case('doc_id % 4', [f'''concat('https://doi.org/10.1000/', {_NUMBER})''', f'''concat('HTTP://DOI.ORG/10.1000/', {_NUMBER})''', f'''concat(' doi:10.1000/', {_NUMBER})''', f'''concat('10.1000/', {_NUMBER})'''])} END",
    "title": _TITLE,
    "abstract": f"nullif(substr(text, length({_TITLE}) + 2), '')",
    "year": "CASE WHEN doc_id % 11 = 0 THEN NULL ELSE CAST(1990 + doc_id % 35 AS INT) END",
    "journal": "CASE WHEN doc_id % 5 = 0 THEN NULL ELSE concat('Journal ', CAST(doc_id % 9 AS STRING)) END",
    "citation_count": "n_chars",
    "open_access": "CASE doc_id % 3 WHEN 0 THEN NULL WHEN 1 THEN true ELSE false END",
    "pmid": "CASE WHEN doc_id % 6 = 0 THEN CAST(doc_id AS STRING) END",
    "source_api": _case("doc_id % 7", [f"'{s}'" for s in SOURCES]),
}
RAW_PAPERS_SQL = "SELECT " + ", ".join(f"{v} AS {k}" for k, v in _PAPER.items()) + ", [lang, source] AS keywords, list_transform(range(doc_id % 4), lambda i: concat('Given', CAST(i AS STRING), ' Family', CAST(doc_id % 13 AS STRING))) AS authors FROM documents"


def raw_papers(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spread(table(spark, sf_dir, "documents"), "doc_id")
    authors = "CASE WHEN doc_id % 4 = 0 THEN array() ELSE transform(sequence(0L, doc_id % 4 - 1), i -> concat('Given', CAST(i AS STRING), ' Family', CAST(doc_id % 13 AS STRING))) END"
    return docs.select(*[F.expr(v).alias(k) for k, v in _PAPER.items()], F.array("lang", "source").alias("keywords"), F.expr(authors).cast("array<string>").alias("authors"))


_K = "regexp_extract(props, '([0-9]+)', 1)"
_ANSWER = _case("event_id % 8", [f"""concat('{{"score": ', {_K}, ', "reason": "fits"}}')""", f"""concat('Sure: {{"score": "', {_K}, '.6", "reason": "near"}} ok')""", f"concat('I would say ', {_K})", _K, """'{"reason": "no score"} 7 of 10'""", "''", """'{"score": -3, "reason": "low"}'""", "'no number at all'"])
ANSWERS_SQL = f"SELECT event_id AS seq, {_ANSWER} AS answer, CASE WHEN event_id % 3 = 0 THEN '' ELSE event_type END AS abstract, concat('Paper ', CAST(event_id AS STRING)) AS title FROM events"


def answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw answers of a scoring model."""
    return spread(table(spark, sf_dir, "events"), "event_id").select(F.col("event_id").alias("seq"), F.expr(_ANSWER).alias("answer"), F.expr("CASE WHEN event_id % 3 = 0 THEN '' ELSE event_type END").alias("abstract"), F.expr("concat('Paper ', CAST(event_id AS STRING))").alias("title"))


#: Three attempts a document: other lengths, other titles.
_ATTEMPT_TEXT = "CASE a WHEN 0 THEN substr(text, 1, 1000) WHEN 1 THEN text ELSE concat(text, chr(10), 'Click here to view figure. Article metrics. ', text) END"
_ATTEMPT = {
    "doi": "concat('10.1000/', CAST(doc_id AS STRING))",
    "attempt": "CAST(a AS INT)",
    "source_format": _case("a", ["'html'", "'xml'", "'pdf'"]),
    "title": f"CASE WHEN (doc_id + a) % 4 = 0 THEN '' ELSE {_TITLE} END",
    "abstract": "CASE WHEN (doc_id + a) % 3 = 0 THEN substr(text, 20, 40 + 60 * CAST(a AS INT)) ELSE '' END",
    "full_text": f"CASE WHEN (doc_id + a) % 5 = 0 THEN '' ELSE {_ATTEMPT_TEXT} END",
}
EXTRACTED_SQL = "SELECT " + ", ".join(f"{v} AS {k}" for k, v in _ATTEMPT.items()) + " FROM documents, (SELECT unnest([0, 1, 2]) AS a)"


def extracted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three extraction attempts per document."""
    docs = spread(table(spark, sf_dir, "documents"), "doc_id").select("*", F.explode(F.array(F.lit(0), F.lit(1), F.lit(2))).alias("a"))
    return docs.select(*[F.expr(v).alias(k) for k, v in _ATTEMPT.items()])


_COMPOUND_ANSWER = _case("l_linenumber % 4", ["""concat('{"compounds": [{"compound_name": "', p_name, '", "smiles": "', sm, '", "role": "aminic antioxidant", "evidence": "inhibits oxidation ', CAST(l_linenumber AS STRING), '"}, {"compound_name": "Vitamin E"}, 7]}')""", """concat('{"items": [{"name": " ', upper(p_name), ' ", "formula": "', p_type, '", "evidence": ""}]}')""", """concat('[{"compound_name": "', p_name, '", "structural_info": "', p_brand, '"}, "x"]')""", """'nothing found'"""])
_SMILES = _case("p_size % 5", ["'c1ccc(Nc2ccccc2)cc1'", "'NOT FOUND'", "'Oc1ccccc1'", "'C1=CC=C(C=C1)NC2=CC=CC=C2'", "''"])
COMPOUND_ANSWERS_SQL = f"SELECT CAST(l_orderkey AS STRING) AS paper_id, CAST(l_linenumber AS BIGINT) * 1000000000 + l_partkey * 1000 + l_suppkey % 1000 AS chunk_no, concat(CAST(l_orderkey AS STRING), ':chunk-', CAST(l_linenumber AS STRING)) AS chunk_id, {_COMPOUND_ANSWER} AS answer FROM (SELECT *, {_SMILES} AS sm FROM lineitem JOIN part ON l_partkey = p_partkey)"


def compound_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw answers of an extracting model, one per chunk (line item)."""
    rows = spread(table(spark, sf_dir, "lineitem"), "l_orderkey").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").join(table(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey"))
    return rows.withColumn("sm", F.expr(_SMILES)).select(F.expr("CAST(l_orderkey AS STRING)").alias("paper_id"), F.expr("CAST(l_linenumber AS BIGINT) * 1000000000 + l_partkey * 1000 + l_suppkey % 1000").alias("chunk_no"), F.expr("concat(CAST(l_orderkey AS STRING), ':chunk-', CAST(l_linenumber AS STRING))").alias("chunk_id"), F.expr(_COMPOUND_ANSWER).alias("answer"))


_MENTION = {
    "seq": "((l_orderkey * 10 + l_linenumber) * 1000000 + l_partkey) * 10000 + l_suppkey",
    "paper_id": "CAST(l_orderkey AS STRING)",
    "doi": "CASE WHEN l_orderkey % 4 = 0 THEN 'NOT FOUND' ELSE concat('10.1000/', CAST(CAST((l_orderkey - l_orderkey % 3) / 3 AS BIGINT) AS STRING)) END",
    "title": "concat('Title ', CAST(l_orderkey AS STRING))",
    "compound_name": "CASE l_linenumber % 3 WHEN 0 THEN p_name WHEN 1 THEN upper(p_name) ELSE concat(' ', p_name, ' β') END",
    "paper_smiles": _SMILES.replace("''", "'NOT FOUND'"),
    "role": "CASE l_linenumber % 2 WHEN 0 THEN 'Aminic antioxidant' ELSE p_type END",
    "evidence": "CASE WHEN l_quantity > 25 THEN concat('inhibits the oxidation of ', p_type) ELSE p_brand END",
}
MENTIONS_SQL = "SELECT " + ", ".join(f"{v} AS {k}" for k, v in _MENTION.items()) + " FROM lineitem JOIN part ON l_partkey = p_partkey"


def mentions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mentions of compounds (line items of parts)."""
    rows = spread(table(spark, sf_dir, "lineitem"), "l_orderkey").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity").join(table(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey"))
    return rows.select(*[F.expr(v).alias(k) for k, v in _MENTION.items()])


NAMES_SQL = "SELECT min(p_partkey) AS cid, p_name AS name, p_name AS resolved_name, 'c1ccc(Nc2ccccc2)cc1' AS pubchem_canonical_smiles, 'NOT FOUND' AS pubchem_isomeric_smiles, upper(p_name) AS iupac_name FROM part WHERE length(p_name) % 3 <> 0 GROUP BY p_name"


def name_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Identifiers of some names."""
    rows = table(spark, sf_dir, "part").filter("length(p_name) % 3 <> 0").groupBy("p_name").agg(F.min("p_partkey").alias("cid"))
    return rows.select("cid", F.col("p_name").alias("name"), F.col("p_name").alias("resolved_name"), F.lit("c1ccc(Nc2ccccc2)cc1").alias("pubchem_canonical_smiles"), F.lit("NOT FOUND").alias("pubchem_isomeric_smiles"), F.upper("p_name").alias("iupac_name"))


#: Two families of file names over orders, metadata over customers.
FILES_SQL = "SELECT o_orderkey AS file_no, concat(CASE WHEN o_orderkey % 3 = 0 THEN 'unknown' ELSE '2020' END, '_10.1000__', CASE WHEN o_orderkey % 2 = 0 THEN 'A.' ELSE 'a_' END, CAST(o_custkey AS STRING)) AS file_stem FROM orders"
METADATA_SQL = "SELECT c_custkey AS seq, concat('https://doi.org/10.1000/a.', CAST(c_custkey AS STRING)) AS doi, c_name AS title, CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE CAST(2000 + c_custkey % 20 AS INT) END AS year, CASE WHEN c_custkey % 2 = 0 THEN c_mktsegment ELSE '' END AS abstract FROM customer WHERE c_custkey % 5 <> 0"


def files(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = table(spark, sf_dir, "orders")
    return t.select(F.col("o_orderkey").alias("file_no"), F.expr("concat(CASE WHEN o_orderkey % 3 = 0 THEN 'unknown' ELSE '2020' END, '_10.1000__', CASE WHEN o_orderkey % 2 = 0 THEN 'A.' ELSE 'a_' END, CAST(o_custkey AS STRING))").alias("file_stem"))


def metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = table(spark, sf_dir, "customer").filter("c_custkey % 5 <> 0")
    return t.select(F.col("c_custkey").alias("seq"), F.expr("concat('https://doi.org/10.1000/a.', CAST(c_custkey AS STRING))").alias("doi"), F.col("c_name").alias("title"), F.expr("CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE CAST(2000 + c_custkey % 20 AS INT) END").alias("year"), F.expr("CASE WHEN c_custkey % 2 = 0 THEN c_mktsegment ELSE '' END").alias("abstract"))


RESULTS_SQL = f"SELECT CAST(p_partkey % 40 AS STRING) AS cid, p_name AS name, {_SMILES} AS smiles, CASE p_size % 4 WHEN 0 THEN ' Phenolic' WHEN 1 THEN 'aminic' WHEN 2 THEN '' ELSE 'other' END AS type, p_size AS heavy_atoms, p_retailprice AS weight FROM part"


def results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Classified structures as a result table has them."""
    t = table(spark, sf_dir, "part")
    return t.select(F.expr("CAST(p_partkey % 40 AS STRING)").alias("cid"), F.col("p_name").alias("name"), F.expr(_SMILES).alias("smiles"), F.expr("CASE p_size % 4 WHEN 0 THEN ' Phenolic' WHEN 1 THEN 'aminic' WHEN 2 THEN '' ELSE 'other' END").alias("type"), F.col("p_size").alias("heavy_atoms"), F.col("p_retailprice").alias("weight"))

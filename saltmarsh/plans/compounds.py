"""Queries over compounds: extraction, resolution, structures, curation, summaries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.ml.feature import PCA
from pyspark.ml.functions import array_to_vector, vector_to_array

from ..functions import chem
from ..functions import text as X
from ..functions import values as V
from ..functions.domain_values import CURATION_RULES, EXCLUSION_REASONS
from ..operators import analysis, extraction, filtering, resolve
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


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


_EXCLUDED = "(" + ", ".join(q(x) for x in V.EXCLUDED_COMPOUNDS) + ")"
_GOT = "nullif(trim(json_extract_string(v, '$.{f}')), '')"
_ITEMS = f"""
raw AS ({T.COMPOUND_ANSWERS_SQL}),
lists AS (SELECT *, CASE WHEN NOT json_valid(answer) THEN NULL WHEN json_type(answer, '$.compounds') = 'ARRAY' THEN json_extract(answer, '$.compounds[*]') WHEN json_type(answer, '$.items') = 'ARRAY' THEN json_extract(answer, '$.items[*]') WHEN json_type(answer) = 'ARRAY' THEN json_extract(answer, '$[*]') END AS l FROM raw),
items AS (SELECT paper_id, chunk_no, chunk_id, unnest(list_filter(l, lambda x: json_type(x) = 'OBJECT')) AS v, generate_subscripts(list_filter(l, lambda x: json_type(x) = 'OBJECT'), 1) - 1 AS item_no FROM lists),
compounds AS (SELECT paper_id, chunk_no, chunk_id, CAST(item_no AS INT) AS item_no, coalesce({_GOT.format(f='compound_name')}, {_GOT.format(f='name')}) AS compound_name, """ + ", ".join(f"coalesce({_GOT.format(f=f)}, 'NOT FOUND') AS {f}" for f in extraction.FIELDS) + f""", coalesce({_GOT.format(f='evidence')}, '') AS evidence FROM items),
kept AS (SELECT * FROM compounds WHERE compound_name IS NOT NULL AND lower(compound_name) NOT IN {_EXCLUDED})
"""


def _compounds(spark: S, sf_dir: str) -> DataFrame:
    return extraction.compounds(T.compound_answers(spark, sf_dir), ["paper_id", "chunk_no", "chunk_id"])


@query(f"WITH {_ITEMS} SELECT * FROM kept")
def n02_parse_compounds(spark: S, sf_dir: str) -> DataFrame:
    """Compounds read out of answers."""
    return _compounds(spark, sf_dir)


_FOLD = ", ".join(f"coalesce(arg_min({f}, chunk_no * 10 + item_no) FILTER (WHERE {f} <> 'NOT FOUND'), 'NOT FOUND') AS {f}" for f in extraction.FIELDS)
_ONCE = "array_to_string(list_transform(list_sort(list_transform(list_distinct(list({c}) FILTER (WHERE {c} <> '')), lambda x: {{'p': list_position(list({c} ORDER BY chunk_no, item_no) FILTER (WHERE {c} <> ''), x), 'v': x}})), lambda x: x.v), '|')"
_MERGED = f"SELECT paper_id, lower(trim(compound_name)) AS name_key, arg_min(compound_name, chunk_no * 10 + item_no) AS compound_name, {_FOLD}, list(evidence ORDER BY chunk_no, item_no) FILTER (WHERE evidence <> '') AS e, list(chunk_id ORDER BY chunk_no, item_no) AS ids, count(*) AS mentions FROM kept GROUP BY 1, 2"
_UNIQUE = "coalesce(array_to_string(list_filter({c}, lambda x, i: list_position({c}, x) = i), '|'), '')"


@query(f"WITH {_ITEMS}, m AS ({_MERGED}) SELECT paper_id, name_key, compound_name, {', '.join(extraction.FIELDS)}, {_UNIQUE.format(c='e')} AS evidence, {_UNIQUE.format(c='ids')} AS source_chunk_ids, mentions FROM m")
def a21_merge_compounds(spark: S, sf_dir: str) -> DataFrame:
    """Compounds merged per paper."""
    out = extraction.merge_compounds(_compounds(spark, sf_dir))
    return out.withColumns({c: F.array_join(c, "|") for c in ("evidence", "source_chunk_ids")})


@query(f"WITH {_ITEMS}, m AS (SELECT DISTINCT paper_id, lower(trim(compound_name)) FROM kept) SELECT count(DISTINCT paper_id) AS papers_with_compounds, count(*) AS compounds FROM m")
def a23_extraction_totals(spark: S, sf_dir: str) -> DataFrame:
    return extraction.extraction_totals(extraction.merge_compounds(_compounds(spark, sf_dir)))


_CLEAN = "trim(regexp_replace(regexp_replace(strip_accents(replace(trim({c}), 'β', 'beta')), '[^\\x20-\\x7E]', '', 'g'), ' +', ' ', 'g'))"
_KEY = f"lower({_CLEAN})".format(c="compound_name")
_ABBR = "CASE k " + " ".join(f"WHEN {q(k)} THEN {q(v.lower())}" for k, v in V.ABBREVIATIONS.items()) + " END"
_RESOLVED = f"""
mentions AS (SELECT *, {_KEY} AS k FROM ({T.MENTIONS_SQL})),
names AS (SELECT k AS normalized_name, arg_min(compound_name, seq) AS input_name, {_ABBR} AS long_name FROM mentions WHERE k <> '' GROUP BY k),
dim AS (SELECT *, {f"lower({_CLEAN})".format(c="name")} AS nk FROM ({T.NAMES_SQL})),
syn AS (SELECT {f"lower({_CLEAN})".format(c="concat(name, ' β')")} AS sk, cid FROM dim WHERE cid % 2 = 0),
hits AS (SELECT normalized_name, cid, 0 AS s FROM names JOIN dim ON nk = normalized_name UNION ALL SELECT normalized_name, cid, 1 FROM names JOIN dim ON nk = long_name UNION ALL SELECT normalized_name, cid, 2 FROM names JOIN syn ON sk = normalized_name),
best AS (SELECT * FROM hits QUALIFY row_number() OVER (PARTITION BY normalized_name ORDER BY s, cid) = 1),
resolved AS (SELECT n.input_name, n.normalized_name, CASE WHEN b.cid IS NULL THEN 'not_found' ELSE 'resolved' END AS lookup_status, coalesce(CASE b.s WHEN 0 THEN 'exact' WHEN 1 THEN 'abbreviation' WHEN 2 THEN 'synonym' END, 'none') AS strategy, coalesce(CAST(b.cid AS VARCHAR), 'NOT FOUND') AS cid, """ + ", ".join(f"coalesce(d.{p}, 'NOT FOUND') AS {p}" for p in resolve.PROPERTIES) + """ FROM names n LEFT JOIN best b USING (normalized_name) LEFT JOIN dim d ON d.cid = b.cid),
joined AS (SELECT m.*, m.k AS normalized_name, coalesce(r.lookup_status, 'not_found') AS lookup_status, coalesce(r.strategy, 'none') AS strategy, coalesce(r.cid, 'NOT FOUND') AS cid, """ + ", ".join(f"coalesce(r.{p}, 'NOT FOUND') AS {p}" for p in resolve.PROPERTIES) + """ FROM mentions m LEFT JOIN resolved r ON r.normalized_name = m.k)
"""


def _resolved(spark: S, sf_dir: str, keys: DataFrame | None = None) -> DataFrame:
    dim = T.name_dimension(spark, sf_dir)
    synonyms = dim.filter("cid % 2 = 0").select(X.name_key(F.concat("name", F.lit(" β"))).alias("name_key"), "cid")
    return resolve.resolve_names(resolve.unique_names(resolve.spellings(T.mentions(spark, sf_dir)) if keys is None else keys), dim, synonyms)


def _joined(spark: S, sf_dir: str) -> DataFrame:
    mentions = T.mentions(spark, sf_dir)
    keys = resolve.spellings(mentions)
    return resolve.with_resolution(mentions, _resolved(spark, sf_dir, keys), keys)


@query(f"WITH {_RESOLVED} SELECT * FROM resolved")
def j20_resolve_names(spark: S, sf_dir: str) -> DataFrame:
    """Distinct names resolved by the cascade."""
    return _resolved(spark, sf_dir)


@query(f"WITH {_RESOLVED} SELECT " + ", ".join(f"arg_min({c}, seq) AS {c}" for c in ("cid", "lookup_status", "strategy", *resolve.PROPERTIES)) + ", coalesce(nullif(array_to_string(list_sort(list_distinct(list(paper_smiles) FILTER (WHERE paper_smiles <> 'NOT FOUND'))), '; '), ''), 'NOT FOUND') AS paper_smiles, array_to_string(list_sort(list_distinct(list(compound_name))), '; ') AS aliases, count(DISTINCT paper_id || '|' || doi) AS paper_count, count(*) AS mention_count FROM joined GROUP BY CASE WHEN cid <> 'NOT FOUND' THEN 'cid:' || cid ELSE 'name:' || normalized_name END")
def a25_master_rows(spark: S, sf_dir: str) -> DataFrame:
    """One row per identifier or unresolved name."""
    return resolve.master_rows(_joined(spark, sf_dir))


_LINK = ", ".join(resolve.LINK_KEY)


@query(f"WITH {_RESOLVED} SELECT {_LINK}, min(seq) AS seq FROM joined GROUP BY ALL")
def a26_link_rows(spark: S, sf_dir: str) -> DataFrame:
    """Links without repeats."""
    return resolve.link_rows(_joined(spark, sf_dir)).select(*resolve.LINK_KEY, "seq")


@query(f"WITH {_RESOLVED} SELECT count(*) AS mentions, count(DISTINCT normalized_name) AS unique_names, count(DISTINCT normalized_name) FILTER (WHERE lookup_status = 'resolved') AS resolved_names, count(DISTINCT cid) FILTER (WHERE lookup_status = 'resolved') AS unique_cids FROM joined")
def a27_resolution_summary(spark: S, sf_dir: str) -> DataFrame:
    return resolve.summary(_joined(spark, sf_dir))


@query("SELECT count(DISTINCT p_name) AS min_calls, count(DISTINCT p_name) * 15 AS rough_max_calls FROM part")
def a28_call_estimate(spark: S, sf_dir: str) -> DataFrame:
    return resolve.call_estimate(T.table(spark, sf_dir, "part").select("p_name").distinct())


@query()
def x20_similar_names(spark: S, sf_dir: str) -> DataFrame:
    """Names of parts similar to the first word of theirs with another's ending."""
    names = T.table(spark, sf_dir, "part").select("p_name").distinct()
    return names.select("p_name", resolve.names_similar("p_name", F.reverse("p_name")).alias("reversed_similar"), resolve.names_similar("p_name", F.concat("p_name", F.lit(" acid"))).alias("extended_similar"))


@query()
def j17_best_title(spark: S, sf_dir: str) -> DataFrame:
    """Best match of stated titles, those of every fiftieth part in another spelling, among the titles of all parts."""
    titles = T.table(spark, sf_dir, "part").select(F.col("p_partkey").alias("seq"), F.concat_ws(" ", "p_name", "p_type", "p_brand").alias("title"))
    asked = titles.filter("seq % 50 = 0").select(F.col("seq").alias("query_id"), F.concat(F.upper("title"), F.lit("  revised")).alias("title"))
    return resolve.best_title(asked, titles)


_FOUND = "nullif(nullif(trim({c}), ''), 'NOT FOUND')"


@query(f"WITH {_RESOLVED} SELECT seq, coalesce({_FOUND.format(c='paper_smiles')}, {_FOUND.format(c='pubchem_canonical_smiles')}, 'NOT FOUND') AS smiles_used, CASE WHEN {_FOUND.format(c='paper_smiles')} IS NOT NULL THEN 'paper' WHEN {_FOUND.format(c='pubchem_canonical_smiles')} IS NOT NULL THEN 'pubchem' ELSE 'none' END AS smiles_source FROM joined")
def c01_choose_smiles(spark: S, sf_dir: str) -> DataFrame:
    used, source = filtering.chosen_smiles()
    return _joined(spark, sf_dir).select("seq", used.alias("smiles_used"), source.alias("smiles_source"))


# what the parser says of the fixture's structures, by hand: two spellings of diphenylamine, and phenol
_KNOWN = [(a, *chem.SmallBackend().parse(a)) for a in ("c1ccc(Nc2ccccc2)cc1", "C1=CC=C(C=C1)NC2=CC=CC=C2", "Oc1ccccc1")]
_STRUCTURES = "structures AS (" + " UNION ALL ".join(f"SELECT {q(s)} AS u, {q(c)} AS smiles, {h} AS heavy_atoms, {q({'phenolic': 'phenolic', 'aminic_nh': 'aminic'}.get(f, 'other'))} AS type" for s, c, h, f in _KNOWN) + ")"
_ROWS = f"""{_RESOLVED}, {_STRUCTURES},
rows AS (SELECT seq, cid, coalesce({_FOUND.format(c='resolved_name')}, {_FOUND.format(c='compound_name')}, {_FOUND.format(c='iupac_name')}, 'NOT FOUND') AS name, coalesce({_FOUND.format(c='paper_smiles')}, {_FOUND.format(c='pubchem_canonical_smiles')}, 'NOT FOUND') AS u FROM joined),
typed AS (SELECT seq, cid, name, coalesce(s.smiles, 'NOT FOUND') AS smiles, coalesce(s.type, 'other') AS type, s.heavy_atoms FROM rows LEFT JOIN structures s USING (u)),
once AS (SELECT CASE WHEN smiles = 'NOT FOUND' THEN 'missing::' || lower(name) || '::' || cid ELSE smiles END AS k, cid, name, smiles, type, min(seq) AS seq, min(heavy_atoms) AS heavy_atoms FROM typed GROUP BY 1, 2, 3, 4, 5),
listed AS (SELECT k, list({{'seq': seq, 'cid': cid, 'name': name, 'smiles': smiles, 'type': type, 'heavy_atoms': heavy_atoms}} ORDER BY seq) AS l FROM once GROUP BY k),
folded AS (SELECT list_reduce(l, lambda o, n: CASE WHEN (n.type <> 'other' AND o.type = 'other') OR (n.name <> 'NOT FOUND' AND (o.name = 'NOT FOUND' OR length(n.name) > length(o.name))) OR (o.cid = 'NOT FOUND' AND n.cid <> 'NOT FOUND') THEN n ELSE o END) AS r FROM listed)"""


@query(f"WITH {_ROWS} SELECT r.cid AS cid, r.name AS name, r.smiles AS smiles, r.type AS type, r.heavy_atoms AS heavy_atoms FROM folded")
def a29_fold_structures(spark: S, sf_dir: str) -> DataFrame:
    """One row a structure by the ordered fold."""
    return filtering.fold_structures(filtering.structure_rows(_joined(spark, sf_dir)))


@query(f"WITH {_ROWS} SELECT r.type AS type, count(*) AS rows, coalesce(max(r.heavy_atoms), 0) AS max_heavy_atoms FROM folded GROUP BY 1")
def a31_type_counts(spark: S, sf_dir: str) -> DataFrame:
    """Structures by type."""
    return filtering.type_counts(filtering.fold_structures(filtering.structure_rows(_joined(spark, sf_dir))))


_RESULTS = f"r AS ({T.RESULTS_SQL})"
_SM = "CASE WHEN upper(trim(smiles)) = 'NOT FOUND' THEN '' ELSE trim(smiles) END"
_TYPE = "coalesce(nullif(lower(trim(type)), ''), 'other')"


@query(f"WITH {_RESULTS}, k AS (SELECT {_TYPE} AS t, count(*) AS n FROM r GROUP BY 1) SELECT 'part' AS \"table\", count(*) AS rows, count(DISTINCT nullif(trim(cid), '')) AS unique_cids, count(DISTINCT nullif(trim(name), '')) AS unique_names, count(DISTINCT nullif({_SM}, '')) AS unique_smiles, count(*) FILTER (WHERE {_SM} <> '') AS valid_rows, count(*) FILTER (WHERE {_SM} = '') AS missing_rows, (SELECT string_agg(t || '=' || n, ';' ORDER BY t) FROM k) AS type_counts FROM r")
def a32_file_summary(spark: S, sf_dir: str) -> DataFrame:
    """Summary of a result table."""
    out = analysis.file_summary(T.results(spark, sf_dir), "part")
    return out.withColumn("type_counts", F.array_join(F.transform(F.map_entries("type_counts"), lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string"))), ";"))


@query(f"WITH {_RESULTS}, c AS (SELECT unnest([0, 1, 2, 3]) AS ord, unnest(['phenolic', 'aminic', 'other', 'absent']) AS type) SELECT CAST(c.ord AS INT) AS ord, c.type AS type, count(r.name) AS n FROM c LEFT JOIN r ON {_TYPE.replace('type', 'r.type')} = c.type GROUP BY ALL")
def a35_category_counts(spark: S, sf_dir: str) -> DataFrame:
    """Counts of categories in order, zeros too."""
    rows = T.results(spark, sf_dir).withColumn("type", F.coalesce(X.present(F.lower(F.trim("type"))), F.lit("other")))
    return analysis.category_counts(rows, "type", ["phenolic", "aminic", "other", "absent"])


@query(f"WITH {_RESULTS} SELECT {_TYPE} AS type, CAST(floor(heavy_atoms / 2) * 2 AS BIGINT) AS bin, count(*) AS n FROM r GROUP BY 1, 2")
def a36_histogram(spark: S, sf_dir: str) -> DataFrame:
    """Heavy atoms in bins of two by type."""
    rows = T.results(spark, sf_dir).withColumn("type", F.coalesce(X.present(F.lower(F.trim("type"))), F.lit("other")))
    return analysis.histogram(rows, "heavy_atoms", "type")


_OUT1 = "SELECT l_orderkey, l_linenumber, l_extendedprice AS a, l_quantity * l_quantity * l_quantity AS b FROM lineitem"


@query(f"WITH z AS ({_OUT1}), m AS (SELECT avg(a) AS u, stddev_samp(a) AS s FROM z), y AS (SELECT z.* FROM z, m WHERE a BETWEEN u - 1.5 * s AND u + 1.5 * s), k AS (SELECT avg(b) AS u, stddev_samp(b) AS s FROM y) SELECT l_orderkey, l_linenumber FROM y, k WHERE b BETWEEN u - 1.5 * s AND u + 1.5 * s")
def f09_without_outliers(spark: S, sf_dir: str) -> DataFrame:
    """Rows within bounds of one column, then of another over the rest."""
    rows = T.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_extendedprice").alias("a"), (F.col("l_quantity") * F.col("l_quantity") * F.col("l_quantity")).alias("b"))
    return analysis.without_outliers(rows, ["a", "b"], 1.5).select("l_orderkey", "l_linenumber")


#: Names for curation: of rules and of exclusions, with others between.
_NAMED = ["DODPA", "Diphenylamine", "N-Phenyl-α-naphthylamine", "PANA", "DPPD", "Phenothiazine", "ADPA", "Alkylated diphenylamine", "p-aminophenol", "aminic antioxidant", "BHT", "Vitamin E", "zddp", "MoS2 nanoparticle", "rosmarinic acid", "something else"]
_NAME = "CASE l_partkey % 16 " + " ".join(f"WHEN {i} THEN {q(n)}" for i, n in enumerate(_NAMED)) + " END"


def _curation_mentions(spark: S, sf_dir: str) -> DataFrame:
    t = spread(T.table(spark, sf_dir, "lineitem"), "l_orderkey").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity")
    pick = lambda e, c: F.expr(e).alias(c)
    return t.select(pick(T._MENTION["seq"], "seq"), pick("concat('p_', CAST(l_orderkey AS STRING), '_', CAST(l_linenumber AS STRING))", "paper_id"), pick(T._MENTION["doi"], "doi"), pick("concat('Title ', CAST(l_orderkey AS STRING))", "title"), F.expr(_NAME).alias("compound_name"), pick("CASE l_linenumber % 2 WHEN 0 THEN 'an Aminic antioxidant' ELSE 'solvent' END", "role"), pick("CASE WHEN l_quantity > 25 THEN concat('It inhibits the oxidation, ', CAST(l_quantity AS INT)) ELSE 'seen' END", "evidence"))


def _pattern(p: str) -> str:
    return q(f"(?i){p}")


_NORM = "replace(trim(regexp_replace(regexp_replace(lower({c}), '[‐‑‒–—−]', '-', 'g'), '\\s+', ' ', 'g')), 'α', 'alpha')"
_N = _NORM.format(c="compound_name")
_FIRST_RULE = "CASE " + " ".join(f"WHEN {' OR '.join(f'regexp_matches(n, {_pattern(p)})' for p in r[4])} THEN {i}" for i, r in enumerate(CURATION_RULES)) + " END"
_FIRST_REASON = "CASE " + " ".join(f"WHEN regexp_matches(compound_name, {_pattern(p)}) THEN {q(r)}" for p, r in EXCLUSION_REASONS) + f" ELSE {q(V.DEFAULT_EXCLUSION)} END"
_RULES = "rules AS (" + " UNION ALL ".join(f"SELECT {i} AS ord, {q(r[0])} AS candidate_id, {q(r[1])} AS canonical_name, {q(r[2])} AS scope, {q(r[3])} AS subclass, {q(r[5])} AS smiles, {q(r[6])} AS identity_note" for i, r in enumerate(CURATION_RULES)) + ")"
_AUDIT = f"""
raw AS (SELECT {T._MENTION["seq"]} AS seq, concat('p_', CAST(l_orderkey AS STRING), '_', CAST(l_linenumber AS STRING)) AS paper_id, {T._MENTION["doi"]} AS doi, concat('Title ', CAST(l_orderkey AS STRING)) AS title, {_NAME} AS compound_name, CASE l_linenumber % 2 WHEN 0 THEN 'an Aminic antioxidant' ELSE 'solvent' END AS role, CASE WHEN l_quantity > 25 THEN concat('It inhibits the oxidation, ', CAST(CAST(l_quantity AS INT) AS STRING)) ELSE 'seen' END AS evidence FROM lineitem),
own AS (SELECT *, {_N} AS n FROM raw WHERE regexp_matches(role, {_pattern(V.ROLE_PATTERN)})),
ruled AS (SELECT compound_name, n, {_FIRST_RULE} AS ord, {_FIRST_REASON} AS reason FROM (SELECT DISTINCT compound_name, n FROM own)),
{_RULES},
audit AS (SELECT seq, paper_id, CASE WHEN lower(doi) NOT IN ('', 'not found') THEN 'doi:' || lower(doi) ELSE 'id:' || regexp_replace(lower(paper_id), '_\\d+$', '') END AS work_key, doi, title, o.compound_name, o.n AS normalized_name, role AS llm_role, evidence, regexp_matches(evidence, {_pattern(V.EVIDENCE_PATTERN)}) AS direct_evidence_keyword, coalesce(scope, 'excluded') AS decision, coalesce(candidate_id, '') AS candidate_id, coalesce(canonical_name, '') AS canonical_name, coalesce(identity_note, reason) AS decision_note FROM own o JOIN ruled USING (compound_name) LEFT JOIN rules USING (ord))
"""


def _audit(spark: S, sf_dir: str) -> DataFrame:
    return analysis.audit(_curation_mentions(spark, sf_dir))


@query(f"WITH {_AUDIT} SELECT * FROM audit")
def j13_curation_audit(spark: S, sf_dir: str) -> DataFrame:
    """Mentions with the first rule they match, or the reason against."""
    return _audit(spark, sf_dir)


@query(f"""WITH {_AUDIT}, g AS (SELECT candidate_id, count(*) AS n_mentions, count(DISTINCT paper_id) AS n_extraction_records, count(DISTINCT work_key) AS n_deduplicated_works, count(*) FILTER (WHERE direct_evidence_keyword) AS n_direct_evidence_mentions, array_to_string(list_transform(list_sort(list_distinct(list({{'k': normalized_name, 'v': compound_name}}))), lambda x: x.v), ' | ') AS aliases, coalesce(array_to_string(list_sort(list_distinct(list(doi) FILTER (WHERE lower(doi) NOT IN ('', 'not found')))), ' | '), '') AS dois, arg_min({{'p': paper_id, 't': title, 'e': evidence}}, {{'d': NOT direct_evidence_keyword, 'n': -length(evidence), 's': seq}}) AS b FROM audit WHERE candidate_id <> '' GROUP BY 1)
SELECT candidate_id, canonical_name, scope, subclass, CASE WHEN scope NOT IN ('core_specific', 'adjacent_specific') THEN 'family_or_product_no_unique_structure' WHEN n_deduplicated_works >= 2 AND n_direct_evidence_mentions > 0 THEN 'high' WHEN n_direct_evidence_mentions > 0 THEN 'moderate' ELSE 'low' END AS confidence, smiles, n_mentions, n_extraction_records, n_deduplicated_works, n_direct_evidence_mentions, aliases, dois, b.p AS representative_paper_id, b.t AS representative_title, b.e AS representative_evidence, identity_note AS curation_note FROM rules JOIN g USING (candidate_id)""")
def a38_candidates(spark: S, sf_dir: str) -> DataFrame:
    """Curated candidates."""
    return analysis.candidates(_audit(spark, sf_dir))


@query(f"WITH {_AUDIT} SELECT normalized_name, decision_note AS reason, arg_min(compound_name, seq) AS example, count(*) AS mentions, count(DISTINCT work_key) AS works FROM audit WHERE candidate_id = '' GROUP BY 1, 2")
def a40_excluded_summary(spark: S, sf_dir: str) -> DataFrame:
    return analysis.excluded_summary(_audit(spark, sf_dir))


@query(f"WITH {_AUDIT} SELECT decision, count(*) AS mentions, count(DISTINCT work_key) AS works, count(DISTINCT nullif(candidate_id, '')) AS candidates FROM audit GROUP BY 1")
def a41_curation_counters(spark: S, sf_dir: str) -> DataFrame:
    return analysis.curation_counters(_audit(spark, sf_dir))


_OLD, _NEW = "SELECT p_name AS smiles, p_name AS name FROM part WHERE p_size < 30", "SELECT p_name AS smiles, upper(p_name) AS name FROM part WHERE p_size > 25 AND p_partkey % 3 = 0"
_COMPARED = f"WITH o AS (SELECT smiles, min(name) AS old_name FROM ({_OLD}) GROUP BY 1), n AS (SELECT smiles, min(name) AS new_name FROM ({_NEW}) GROUP BY 1), c AS (SELECT coalesce(o.smiles, n.smiles) AS smiles, old_name, new_name, CASE WHEN n.smiles IS NULL THEN 'previous_only' WHEN o.smiles IS NULL THEN 'new_only' ELSE 'shared' END AS status FROM o FULL JOIN n ON o.smiles = n.smiles)"


def _old_new(spark: S, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    t = T.table(spark, sf_dir, "part")
    return t.filter("p_size < 30").select(F.col("p_name").alias("smiles"), F.col("p_name").alias("name")), t.filter("p_size > 25 AND p_partkey % 3 = 0").select(F.col("p_name").alias("smiles"), F.upper("p_name").alias("name"))


@query(f"{_COMPARED} SELECT * FROM c")
def j16_compare_results(spark: S, sf_dir: str) -> DataFrame:
    """Two results by structure."""
    return analysis.compare(*_old_new(spark, sf_dir))


@query(f"{_COMPARED} SELECT status, count(*) AS n FROM c GROUP BY 1")
def u04_overlap(spark: S, sf_dir: str) -> DataFrame:
    """How many are shared."""
    return analysis.overlap(*_old_new(spark, sf_dir))


@query()
def c07_fingerprints(spark: S, sf_dir: str) -> DataFrame:
    """Circular fingerprints of distinct structures."""
    rows = T.results(spark, sf_dir).select(X.found_or_empty("smiles").alias("smiles")).filter("smiles <> ''").distinct()
    p = rows.withColumn("p", chem.parsed("smiles"))
    return p.select("smiles", F.coalesce("p.canonical_smiles", F.lit("")).alias("canonical_smiles"), F.coalesce("p.heavy_atoms", F.lit(0)).alias("heavy_atoms"), F.size(chem.fingerprints("smiles")).alias("n_bits"))


@query()
def c08_pca(spark: S, sf_dir: str) -> DataFrame:
    """Two principal components of the embeddings."""
    rows = T.table(spark, sf_dir, "embeddings").select("vec_id", array_to_vector("embedding").alias("v"))
    model = PCA(k=2, inputCol="v", outputCol="p").fit(rows)
    p = vector_to_array("p")
    return model.transform(rows).select("vec_id", F.round(p[0], 6).alias("pca_1"), F.round(p[1], 6).alias("pca_2"))

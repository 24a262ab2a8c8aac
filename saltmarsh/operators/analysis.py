"""Summaries, curation and comparison of results."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import chem
from ..functions import text as X
from ..functions.domain_values import CURATION_RULES, EXCLUSION_REASONS
from ..functions.values import DEFAULT_EXCLUSION, EVIDENCE_PATTERN, ROLE_PATTERN
from ..storage import if_small, stored

RULE_FIELDS = ("candidate_id", "canonical_name", "scope", "subclass", "smiles", "identity_note")


def file_summary(rows: DataFrame, name: str) -> DataFrame:
    """Rows, distinct identifiers, valid and missing structures, and counts by type of a result table."""
    s = X.found_or_empty("smiles")
    value = lambda c: F.countDistinct(X.present(F.trim(F.col(c)))).alias(f"unique_{c}s")
    kinds = rows.groupBy(F.coalesce(X.present(F.lower(F.trim("type"))), F.lit("other")).alias("type")).agg(F.count(F.lit(1)).alias("n"))
    listed = kinds.agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("type", "n")))).alias("type_counts"))
    base = rows.agg(F.count(F.lit(1)).alias("rows"), value("cid"), value("name"), F.countDistinct(X.present(s)).alias("unique_smiles"), F.count_if(s != "").alias("valid_rows"), F.count_if(s == "").alias("missing_rows"))
    return base.crossJoin(F.broadcast(listed)).select(F.lit(name).alias("table"), "*")  # one row by one row


def category_counts(rows: DataFrame, column: str, categories: list[str]) -> DataFrame:
    """Rows of each category in the order given, zero where there are none."""
    spark = rows.sparkSession
    order = spark.createDataFrame(list(enumerate(categories)), f"ord int, {column} string")
    n = rows.filter(F.col(column).isin(categories)).groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    return F.broadcast(order).join(n, column, "left").select("ord", column, F.coalesce("n", F.lit(0)).alias("n")).orderBy("ord")


def histogram(rows: DataFrame, value: str, by: str, width: int = 2) -> DataFrame:
    """Rows by group and bin of a width from 0."""
    low = (F.floor(F.col(value) / width) * width).cast("long")
    return rows.filter(F.col(value).isNotNull()).groupBy(by, low.alias("bin")).agg(F.count(F.lit(1)).alias("n"))


def without_outliers(rows: DataFrame, columns: list[str], sigmas: float = 3.0) -> DataFrame:
    """Rows within so many standard deviations, one column after another over what is left."""
    for c in columns:
        m = rows.agg(F.avg(c).alias("_m"), F.stddev_samp(c).alias("_s"))
        rows = rows.crossJoin(F.broadcast(m)).filter(F.col("_s").isNull() | F.col(c).between(F.col("_m") - sigmas * F.col("_s"), F.col("_m") + sigmas * F.col("_s"))).drop("_m", "_s")
    return rows


def rule_number(name: Column) -> Column:
    """Number (from 0) of the first curation rule of which a pattern is found in the curation name."""
    return F.coalesce(*[F.when(name.rlike("(?i)" + "|".join(f"(?:{p})" for p in r[4])), F.lit(i)) for i, r in enumerate(CURATION_RULES)])


def exclusion_reason(name: str = "compound_name") -> Column:
    """Why a name is no candidate."""
    c = F.coalesce(F.col(name), F.lit(""))
    return F.coalesce(*[F.when(c.rlike(f"(?i){p}"), F.lit(r)) for p, r in EXCLUSION_REASONS], F.lit(DEFAULT_EXCLUSION))


def rules_table(spark) -> DataFrame:
    """Curation rules: ord and RULE_FIELDS (C11)."""
    return spark.createDataFrame([(i, r[0], r[1], r[2], r[3], r[5], r[6]) for i, r in enumerate(CURATION_RULES)], "ord int, candidate_id string, canonical_name string, scope string, subclass string, smiles string, identity_note string")


def audit(mentions: DataFrame) -> DataFrame:
    """Mentions of a role of interest with the rule they match, or why none.

    Rules run over the distinct names only, which are stored, and are joined back.
    """
    own = mentions.filter(F.coalesce("role", F.lit("")).rlike(f"(?i){ROLE_PATTERN}"))
    nul = lambda c: F.replace(F.coalesce(F.col(c), F.lit("")), F.lit("\x00"), F.lit(""))
    own = own.withColumns({c: nul(c) for c in ("paper_id", "doi", "title", "compound_name", "evidence", "role")})
    names = own.select("compound_name").distinct().withColumns({"normalized_name": X.once(X.curation_name("compound_name"))})
    names = names.withColumns({"ord": X.once(rule_number(F.col("normalized_name"))), "reason": X.once(exclusion_reason())})
    ruled = stored(names.join(F.broadcast(rules_table(mentions.sparkSession)), "ord", "left"), "ruled-names")
    out = own.join(if_small(ruled), "compound_name")
    return out.select("seq", "paper_id", X.work_key("doi", "paper_id").alias("work_key"), "doi", "title", "compound_name", "normalized_name", F.col("role").alias("llm_role"), "evidence", F.col("evidence").rlike(f"(?i){EVIDENCE_PATTERN}").alias("direct_evidence_keyword"), F.coalesce("scope", F.lit("excluded")).alias("decision"), F.coalesce("candidate_id", F.lit("")).alias("candidate_id"), F.coalesce("canonical_name", F.lit("")).alias("canonical_name"), F.coalesce("identity_note", "reason").alias("decision_note"))


def confidence() -> Column:
    """high, moderate or low for specific scopes."""
    works, direct = F.col("n_deduplicated_works"), F.col("n_direct_evidence_mentions")
    return F.when(~F.col("scope").isin("core_specific", "adjacent_specific"), "family_or_product_no_unique_structure").when((works >= 2) & (direct > 0), "high").when(direct > 0, "moderate").otherwise("low")


def joined_values(rows: DataFrame, key: str, value: str, by: str = " | ") -> DataFrame:
    """key and its distinct values in order as one string: ranges of values are joined each by itself, then the strings of ranges, so no group's values are gathered."""
    ranged = rows.select(key, value).distinct().repartitionByRange(key, value).withColumn("_range", F.spark_partition_id())
    parts = ranged.groupBy(key, "_range").agg(F.array_join(F.sort_array(F.collect_list(value)), by).alias("_s"))
    listed = F.sort_array(F.collect_list(F.struct("_range", "_s")))
    return parts.groupBy(key).agg(F.array_join(F.transform(listed, lambda x: x["_s"]), by).alias(value))


def candidates(audited: DataFrame) -> DataFrame:
    """One row per matched rule with counts, aliases, works and a representative mention.

    Few rules match many mentions: each figure is a hash aggregate of its own, and no group is sorted or gathered.
    """
    own, key = audited.filter("candidate_id <> ''"), "candidate_id"
    names = own.groupBy(key, "normalized_name", "compound_name", (~F.col("direct_evidence_keyword")).alias("d"), (-F.length("evidence")).alias("n")).agg(F.count(F.lit(1)).alias("m"), F.min("seq").alias("seq"))
    names = stored(names, "candidate-names")
    alias = F.array_join(F.transform(F.array_sort(F.collect_set(F.struct(F.col("normalized_name").alias("k"), F.col("compound_name").alias("v")))), lambda x: x["v"]), " | ")
    first = F.min(F.struct("d", "n", "seq"))
    g = names.groupBy(key).agg(F.sum("m").alias("n_mentions"), F.sum(F.when(~F.col("d"), F.col("m")).otherwise(0)).alias("n_direct_evidence_mentions"), alias.alias("aliases"), first.alias("first"))
    different = lambda c, name: own.select(key, c).filter(F.col(c).isNotNull()).distinct().groupBy(key).agg(F.count(F.lit(1)).alias(name))
    listed = joined_values(own.filter((F.col("doi") != "") & (X.curation_name("doi") != "not found")), key, "doi")
    # the mention itself, looked up by its place
    chosen = own.join(F.broadcast(g.select(key, F.col("first.seq").alias("seq"))), [key, "seq"])
    order = F.struct((~F.col("direct_evidence_keyword")).alias("d"), (-F.length("evidence")).alias("n"))
    best = chosen.groupBy(key).agg(F.min_by(F.struct("paper_id", "title", "evidence"), order).alias("b"))
    out = F.broadcast(rules_table(audited.sparkSession)).join(g, key)
    for more in (different("paper_id", "n_extraction_records"), different("work_key", "n_deduplicated_works"), listed.withColumnRenamed("doi", "dois"), best):
        out = out.join(more, key, "left")  # one row a rule
    counts = ("n_extraction_records", "n_deduplicated_works")
    out = out.withColumns({**{c: F.coalesce(c, F.lit(0)) for c in counts}, "dois": F.coalesce("dois", F.lit(""))}).withColumn("confidence", confidence())
    return out.select("candidate_id", "canonical_name", "scope", "subclass", "confidence", "smiles", "n_mentions", "n_extraction_records", "n_deduplicated_works", "n_direct_evidence_mentions", "aliases", "dois", F.col("b.paper_id").alias("representative_paper_id"), F.col("b.title").alias("representative_title"), F.col("b.evidence").alias("representative_evidence"), F.col("identity_note").alias("curation_note")).orderBy("scope", F.lower("canonical_name"))


def with_structures(rows: DataFrame, smiles: str = "smiles") -> DataFrame:
    """canonical_smiles and structure_status."""
    p = rows.withColumn("_p", chem.parsed(smiles))
    given, good = F.coalesce(F.col(smiles), F.lit("")) != "", F.col("_p.canonical_smiles").isNotNull()
    status = F.when(~given, "not_applicable_or_unresolved").when(good, "manually_curated_validated").otherwise("invalid_manual_smiles")
    return p.withColumns({"canonical_smiles": F.coalesce("_p.canonical_smiles", smiles, F.lit("")), "structure_status": status}).drop("_p")


def excluded_summary(audited: DataFrame) -> DataFrame:
    """Names that match no rule, by reason, most mentions first."""
    g = audited.filter("candidate_id = ''").groupBy("normalized_name", F.col("decision_note").alias("reason"))
    out = g.agg(F.min_by("compound_name", "seq").alias("example"), F.count(F.lit(1)).alias("mentions"), F.countDistinct("work_key").alias("works"))
    return out.orderBy(F.desc("mentions"), "normalized_name")


def curation_counters(audited: DataFrame) -> DataFrame:
    """Mentions, works and decisions."""
    return audited.groupBy("decision").agg(F.count(F.lit(1)).alias("mentions"), F.countDistinct("work_key").alias("works"), F.countDistinct(X.present("candidate_id")).alias("candidates"))


def compare(old: DataFrame, new: DataFrame, key: str = "smiles", names: tuple[str, str] = ("previous_only", "new_only")) -> DataFrame:
    """Keys of two results as shared, in the old only, or in the new only, with either's name."""
    one = lambda df, c: df.filter(F.coalesce(F.col(key), F.lit("")) != "").groupBy(key).agg(F.min("name").alias(c))
    both = one(old, "old_name").join(one(new, "new_name"), key, "full_outer")
    return both.withColumn("status", F.when(F.col("new_name").isNull(), names[0]).when(F.col("old_name").isNull(), names[1]).otherwise("shared"))


def overlap(old: DataFrame, new: DataFrame, key: str = "smiles") -> DataFrame:
    """How many keys are in both, and in one only."""
    return compare(old, new, key).groupBy("status").agg(F.count(F.lit(1)).alias("n"))


def tagged_union(other: DataFrame, priority: DataFrame) -> DataFrame:
    """Both with their plot family."""
    return other.withColumn("plot_family", F.lit("other")).unionByName(priority.withColumn("plot_family", F.col("type")))


def unique_structures(rows: DataFrame, smiles: str = "smiles", seq: str = "seq") -> DataFrame:
    """Rows with a valid structure, the first (by `seq`) of each canonical one, with canonical_smiles and heavy_atoms."""
    parsed = chem.parsed_once(rows, smiles).select(smiles, "canonical_smiles", "heavy_atoms")
    own = rows.drop("canonical_smiles", "heavy_atoms").join(if_small(parsed.filter(F.coalesce("canonical_smiles", F.lit("")) != "")), smiles)
    rest = [c for c in own.columns if c != "canonical_smiles"]
    return own.groupBy("canonical_smiles").agg(F.min_by(F.struct(*rest), seq).alias("_r")).select("_r.*", "canonical_smiles")


def dataset_stats(priority: DataFrame, other: DataFrame) -> DataFrame:
    """One row: rows of both, types of the first in order, and largest heavy-atom counts."""
    kinds = priority.groupBy("type").agg(F.count(F.lit(1)).alias("n")).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("type", "n")))).alias("priority_type_counts"))
    most = lambda c: F.coalesce(F.max("heavy_atoms"), F.lit(0)).alias(c)
    p = priority.agg(F.count(F.lit(1)).alias("priority_rows"), most("max_heavy_atoms_priority"))
    o = other.agg(F.count(F.lit(1)).alias("other_rows"), most("max_heavy_atoms_other"))
    return p.crossJoin(F.broadcast(o)).crossJoin(F.broadcast(kinds))  # one row each


def papers_with_abstracts(papers: DataFrame, most: int = 0, seed: int = 42) -> DataFrame:
    """Papers with an abstract and a numeric score, the score as an integer (S56); with `most`, a seeded sample of so many."""
    score = F.col("relevance_score").cast("string").try_cast("double")
    rows = papers.filter(F.trim(F.coalesce("abstract", F.lit(""))) != "").withColumn("relevance_score", score.cast("int")).filter("relevance_score IS NOT NULL")
    return rows if most <= 0 else rows.orderBy(F.xxhash64(F.lit(seed), "doi", "title")).limit(most)


def score_counts(papers: DataFrame) -> DataFrame:
    """Papers by score."""
    return papers.groupBy("relevance_score").agg(F.count(F.lit(1)).alias("papers")).orderBy("relevance_score")


def without_nul(rows: DataFrame) -> DataFrame:
    """Text columns without NUL characters, null as empty."""
    return rows.withColumns({c: F.replace(F.coalesce(F.col(f"`{c}`"), F.lit("")), F.lit("\x00"), F.lit("")) for c, t in rows.dtypes if t == "string"})

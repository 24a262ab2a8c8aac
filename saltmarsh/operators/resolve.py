"""Names to identifiers, and the tables of master and link rows."""

from __future__ import annotations

from collections.abc import Iterator
from difflib import SequenceMatcher

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import DoubleType

from ..functions import text as X
from ..functions.values import ABBREVIATIONS, NAME_SIMILARITY, NOT_FOUND, TITLE_SIMILARITY
from ..storage import if_small, spread, stored

PROPERTIES = ("resolved_name", "pubchem_canonical_smiles", "pubchem_isomeric_smiles", "iupac_name")
STRATEGIES = ("exact", "abbreviation", "synonym", "autocomplete")


@pandas_udf(DoubleType())
def matching_ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    """Ratcliff-Obershelp similarity, which has no built-in form."""
    return pd.Series([None if x is None or y is None else SequenceMatcher(None, x, y).ratio() for x, y in zip(a, b, strict=True)], dtype="float64")


def names_similar(query: Column | str, candidate: Column | str, threshold: float = NAME_SIMILARITY) -> Column:
    """Equal, one within the other, or alike by ratio."""
    q, c = X.compare_key(query), X.compare_key(candidate)
    within = (q == c) | c.contains(q) | q.contains(c)
    return (q != "") & (c != "") & (within | (matching_ratio(q, c) >= threshold))


def name_keys(mentions: DataFrame) -> DataFrame:
    """compound_name, normalized_name, seq (the first) of each distinct spelling: keys are made once a spelling, whatever is asked of them."""
    return mentions.groupBy("compound_name").agg(F.min("seq").alias("seq")).withColumn("normalized_name", X.once(X.name_key("compound_name")))


def spellings(mentions: DataFrame) -> DataFrame:
    """`name_keys`, stored; they stand for the mentions in `unique_names`, so that these are read once for their names."""
    return stored(name_keys(mentions), "spellings")


def unique_names(mentions: DataFrame) -> DataFrame:
    """normalized_name, input_name (the first spelling)."""
    return name_keys(mentions).filter("normalized_name <> ''").groupBy("normalized_name").agg(F.min_by("compound_name", "seq").alias("input_name"))


def resolve_names(names: DataFrame, dimension: DataFrame, synonyms: DataFrame | None = None, suggestions: DataFrame | None = None) -> DataFrame:
    """The cascade exact, abbreviation, synonym, autocomplete over lookup tables (J20); only distinct names take part.

    dimension: cid, name and the PROPERTIES; synonyms: name_key, cid; suggestions: name_key, suggestion (in
    order of `rank`), looked up by exact name and kept if similar to the input. Within a strategy the least
    `cid_rank` (or cid) wins.
    """
    props = dimension.select(F.col("cid").cast("string").alias("cid"), *PROPERTIES)
    exact = dimension.select(X.name_key("name").alias("_k"), F.col("cid").cast("string").alias("cid"))
    abbreviation = F.element_at(F.create_map(*[x for k, v in ABBREVIATIONS.items() for x in (F.lit(k), F.lit(v))]), F.col("normalized_name"))
    asked = names.withColumns({"_clean": X.clean_name("input_name"), "_long": X.name_key(F.coalesce(abbreviation, F.lit("")))})
    n = asked.filter("_clean <> ''").select("input_name", "normalized_name", "_long")
    hits = [n.join(exact, F.col("normalized_name") == F.col("_k")).select("normalized_name", "cid", F.lit(0).alias("_s"))]
    hits.append(n.filter("_long <> ''").join(exact, F.col("_long") == F.col("_k")).select("normalized_name", "cid", F.lit(1).alias("_s")))
    if synonyms is not None:
        hits.append(n.join(synonyms.select(F.col("name_key").alias("_k"), F.col("cid").cast("string").alias("cid")), F.col("normalized_name") == F.col("_k")).select("normalized_name", "cid", F.lit(2).alias("_s")))
    if suggestions is not None:
        s = suggestions.select(F.col("name_key").alias("_n"), X.name_key("suggestion").alias("_k"))
        near = n.filter(~X.risky_name("input_name")).join(s, F.col("normalized_name") == F.col("_n")).join(exact, "_k")
        near = near.join(props.select("cid", "resolved_name"), "cid").filter(names_similar("input_name", "resolved_name"))
        hits.append(near.select("normalized_name", "cid", F.lit(3).alias("_s")))
    every = hits[0]
    for h in hits[1:]:
        every = every.unionByName(h)
    number = F.col("cid").try_cast("bigint")
    best = every.join(props.select("cid"), "cid", "left_semi").groupBy("normalized_name").agg(F.min_by(F.struct("_s", "cid"), F.struct("_s", number.alias("n"), "cid")).alias("b")).select("normalized_name", "b._s", "b.cid")
    out = asked.select("input_name", "normalized_name", "_clean").join(best, "normalized_name", "left").join(props, "cid", "left")
    found = F.col("_s").isNotNull()
    strategy = F.when(found, F.element_at(F.array(*[F.lit(x) for x in STRATEGIES]), F.col("_s") + 1))
    status = F.when(found, "resolved").when(F.col("_clean") == "", "invalid_name").otherwise("not_found")
    absent = lambda c: F.coalesce(F.col(c), F.lit(NOT_FOUND)).alias(c)
    return out.select("input_name", "normalized_name", status.alias("lookup_status"), F.coalesce(strategy, F.lit("none")).alias("strategy"), absent("cid"), *[absent(p) for p in PROPERTIES])


def with_resolution(mentions: DataFrame, resolved: DataFrame, keys: DataFrame | None = None) -> DataFrame:
    """Mentions with their name's resolution; unresolved ones with the sentinels (J10). keys: the `spellings` of the mentions, if made before."""
    keys = (name_keys(mentions) if keys is None else keys).drop("seq")
    defaults = {"cid": NOT_FOUND, "lookup_status": "not_found", "strategy": "none", **dict.fromkeys(PROPERTIES, NOT_FOUND)}
    named = keys.join(resolved.select("normalized_name", *defaults), "normalized_name", "left").fillna(defaults)
    return mentions.join(if_small(stored(named, "named")), "compound_name")


def master_rows(joined: DataFrame) -> DataFrame:
    """One row per identifier, or per name where there is none."""
    key = F.when(F.col("cid") != NOT_FOUND, F.concat(F.lit("cid:"), "cid")).otherwise(F.concat(F.lit("name:"), "normalized_name"))
    rows = joined.withColumn("_key", key)
    named = ["cid", "lookup_status", "strategy", *PROPERTIES]
    # few names have many mentions: hash aggregates make rows of names of them before anything is ordered
    names = rows.groupBy("_key", *named, "compound_name", "paper_smiles").agg(F.min("seq").alias("seq"), F.count(F.lit(1)).alias("n"))
    # nearly all papers differ: dealt out first, as a table of them before the shuffle would only fill memory
    papers = rows.select("_key", F.concat_ws("|", "paper_id", "doi").alias("_paper")).repartition("_key", "_paper").distinct().groupBy("_key").agg(F.count(F.lit(1)).alias("paper_count"))
    smiles = F.array_join(F.array_sort(F.collect_set(F.when(F.col("paper_smiles") != NOT_FOUND, F.col("paper_smiles")))), "; ")
    out = names.groupBy("_key").agg(
        *[F.min_by(c, "seq").alias(c) for c in named],
        F.coalesce(X.present(smiles), F.lit(NOT_FOUND)).alias("paper_smiles"),
        F.array_join(F.array_sort(F.collect_set("compound_name")), "; ").alias("aliases"), F.sum("n").alias("mention_count"),
    )
    columns = [*named, "paper_smiles", "aliases", "paper_count", "mention_count"]
    return out.join(papers, "_key").select(*columns).orderBy(F.col("cid") == NOT_FOUND, "cid", "resolved_name")


LINK_KEY = ("paper_id", "doi", "compound_name", "cid", "paper_smiles", "pubchem_canonical_smiles")


def link_rows(joined: DataFrame) -> DataFrame:
    """Mentions without repeats of six columns, the first kept."""
    rest = [c for c in joined.columns if c not in LINK_KEY]
    return joined.groupBy(*LINK_KEY).agg(F.min_by(F.struct(*rest), "seq").alias("r")).select(*LINK_KEY, "r.*")


def summary(joined: DataFrame) -> DataFrame:
    """Counts of a run."""
    ok = F.col("lookup_status") == "resolved"
    return joined.agg(F.count(F.lit(1)).alias("mentions"), F.countDistinct("normalized_name").alias("unique_names"), F.countDistinct(F.when(ok, F.col("normalized_name"))).alias("resolved_names"), F.countDistinct(F.when(ok, F.col("cid"))).alias("unique_cids"))


def call_estimate(pending: DataFrame, most_cids: int = 10) -> DataFrame:
    """Least and roughly most lookups for the names left."""
    n = F.count(F.lit(1))
    return pending.agg(n.alias("min_calls"), (n * (5 + most_cids)).alias("rough_max_calls"))


def letter_counts(texts: list[str]) -> np.ndarray:
    """How often each text has the characters of each of 64 classes (their code's remainder), up to 255."""
    out = np.zeros((len(texts), 64), dtype=np.uint8)
    for i, t in enumerate(texts):
        codes = np.frombuffer(t.encode("utf-32-le", "surrogatepass"), dtype=np.uint32) % 64
        out[i] = np.minimum(np.bincount(codes, minlength=64), 255)
    return out


def ratio_bounds(q: str, own: np.ndarray, lengths: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """What the ratios of a text with others can be at most: all characters in common matched. Counts that were cut make no bound (1)."""
    common = np.minimum(counts, own).sum(axis=1, dtype=np.int64)
    both = lengths + len(q)
    return np.where((both == 0) | (own.max(initial=0) == 255) | (counts.max(axis=1, initial=0) == 255), 1.0, 2.0 * common / np.maximum(both, 1))


def best_of(batches: Iterator[pa.RecordBatch], asked: list[tuple[str, float]], first: bool) -> Iterator[pa.RecordBatch]:
    """q, similarity, seq, title: for each of `asked` (text, the ratio to reach) the most similar of the titles t, the first of equals.

    With `first` only the likeliest title of each batch is compared: a ratio that the best one reaches.
    """
    best: dict[str, tuple[float, int, str]] = {}
    own = letter_counts([q for q, _ in asked])
    for whole in batches:
        for begin in range(0, whole.num_rows, 2048):
            batch = whole.slice(begin, 2048).to_pydict()
            texts, seqs, titles = batch["t"], batch["seq"], batch["title"]
            lengths, counts = np.array([len(t) for t in texts]), letter_counts(texts)
            for k, (q, floor) in enumerate(asked):
                bounds = ratio_bounds(q, own[k], lengths, counts)
                at = [int(bounds.argmax())] if first else np.flatnonzero(bounds >= max(floor, best[q][0] if q in best else 0.0))
                if not len(at):
                    continue
                matcher = SequenceMatcher()
                matcher.set_seq2(q)
                for i in at if first else at[np.argsort(-bounds[at], kind="stable")].tolist():
                    least = max(floor, best[q][0] if q in best else 0.0)
                    if bounds[i] < least:
                        break
                    matcher.set_seq1(texts[i])
                    if matcher.quick_ratio() >= least:
                        r = matcher.ratio()
                        if r >= least and (q not in best or (r, -seqs[i]) > (best[q][0], -best[q][1])):
                            best[q] = (r, seqs[i], titles[i])
    rows = [(q, *v) for q, v in best.items()]
    types = [("q", pa.string()), ("similarity", pa.float64()), ("seq", pa.int64()), ("title", pa.string())]
    yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, (_, t) in enumerate(types)], names=[n for n, _ in types])


def best_title(queries: DataFrame, titles: DataFrame, least: float = TITLE_SIMILARITY, block: int = 2000) -> DataFrame:
    """For each stated query title the most similar of all titles, the first of equals.

    Every different query meets every different title: titles that are equal when collapsed have one ratio, so the first
    stands for them. The different queries are a stated set: they are collected and compared in blocks. A first pass
    finds a ratio that each one's best title reaches, so the second computes ratios only where the characters
    in common allow as much. A task keeps one best match a query.
    """
    kept = titles.select("seq", X.collapsed("title").alias("t"), "title").groupBy("t").agg(F.min(F.struct("seq", "title")).alias("f"))
    rows = spread(stored(kept.select("t", F.col("f.seq").cast("bigint").alias("seq"), "f.title"), "titles"), "seq")
    own = queries.select("query_id", X.collapsed("title").alias("q"))
    asked = sorted(r.q for r in own.select("q").distinct().collect())
    schema = "q string, similarity double, seq bigint, title string"
    found = titles.sparkSession.createDataFrame([], schema)
    for begin in range(0, len(asked), block):
        part = [(q, least) for q in asked[begin : begin + block]]
        reached = rows.mapInArrow(lambda batches, part=part: best_of(batches, part, True), schema).groupBy("q").agg(F.max("similarity").alias("r"))
        floors = {r.q: r.r for r in reached.collect()}
        part = [(q, floors.get(q, least)) for q, _ in part]
        found = found.unionByName(rows.mapInArrow(lambda batches, part=part: best_of(batches, part, False), schema))
    best = found.groupBy("q").agg(F.max_by(F.struct("similarity", "seq", "title"), F.struct("similarity", -F.col("seq"))).alias("b"))
    return own.join(best, "q").select("query_id", "b.*")


def numbered(rows: DataFrame, seq: str = "seq", column: str = "position") -> DataFrame:
    """1-based positions in order of `seq` without one global sort partition: counts of ranges before each range, plus ranks within.

    The rows are stored with the number of their range, as a second plan of the ranges need not draw the same bounds.
    """
    ranged = stored(rows.repartitionByRange(seq).withColumn("_part", F.spark_partition_id()), "numbered")
    counts = ranged.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    before = counts.withColumn("_before", F.coalesce(F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).select("_part", "_before")
    place = F.row_number().over(Window.partitionBy("_part").orderBy(seq))
    # one row a range: bounded by the number of shuffle partitions
    return ranged.join(F.broadcast(before), "_part").withColumn(column, F.col("_before") + place).drop("_part", "_before")

"""Near-duplicate documents: ProbMinHash sketches, banding, verification, components.

Each distinct five-word shingle of a text, weighted 1 + ln(its count), is a Poisson process of that
rate in time, shared by all texts: its arrivals fall on random registers, and a register keeps the
shingle that came first. Two registers agree with the probability Jaccard similarity of the weighted
shingle sets. A text's processes are followed only to the time by which all registers have been hit
(early termination): later arrivals cannot change a register.

Registers are banded by four. In each bucket all texts are linked to one leader, the text with most company in its
buckets, and each link is verified on the whole texts (Jaccard of the shingle sets, 0.8 or more). That joins what is
plainly alike. A link that fails leaves texts of one bucket in several components, and their texts may still be
similar to each other. They are compared by how they differ from their leader, not by what they have in common with it:

- With a(v) shingles in only one of v and the leader, and s(v) shingles, v and w are similar exactly if their
  differences share c = (a(v) + a(w) - (s(v) + s(w)) / 9) / 2 shingles or more. Copies of one text share next to none.
- Where c is 0 or less both are similar to the text with the largest s / 9 - a, which is therefore met by all of these.
- Else v and w share one of the a(v) - c + 1 rarest shingles of v's difference (a prefix filter, with rarity counted among
  the leader's texts). The prefixes are cut for each class of s / 9 - a apart, so that c is known closely, and
  only pairs of two components whose places leave room for c are verified.
- Texts far from the leader (below 0.5) have no short difference from it and meet by the rarest of all their shingles,
  which is the same rule with an empty leader. By the triangle inequality of the Jaccard distance a text
  similar to one of 0.5 or more has itself 0.3 or more, so differences are kept down to that.

So no bucket is capped, none is listed pair by pair, and no similar pair of a bucket ends in two classes.

Nulls: a null text counts as empty and an empty text is like no other, each such row its own class;
null ids are allowed (a class then is named by its smallest id that is not null, if it has one).
Equal texts are collapsed before banding, so repeated rows and thousands of copies cost one sketch each
and no links. Very long texts are hashed whole. An empty table gives an empty result. An input that is not a
plain file scan is stored first, as row tags need the same order at each reading.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import chunks, if_small, is_small, ship_package, stored, stored_so_far, sweep, text_or_empty
from .exact import steady, tagged, without_tags
from .graph import components
from .shingles import mixed, shingle_hashes, word_hashes

REGISTERS, BAND_ROWS, SIMILAR = 64, 4, 0.8
#: Members that meet a copy of their leader's text in one task.
PER_LEADER = 256
#: Similarity to its leader below which a text is compared by its own shingles.
FAR = 0.5
#: Classes of texts of one leader for each unit of the inverse hyperbolic sine of their gain.
CLASSES = 8
#: Shingles of differences that a worker holds before it hands them on.
HELD = 1 << 20
#: Bytes of text that are sketched at a time.
CHUNK_BYTES = 2 << 20


def _fraction(x: np.ndarray) -> np.ndarray:
    """Numbers in (0, 1] of 64-bit hashes."""
    return ((x >> np.uint64(11)).astype(np.float64) + 1.0) * 2.0**-53


def weighted(shingles: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingles text by text: their text, hash and weight 1 + ln(count)."""
    text = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
    order = np.lexsort((shingles, text))
    s, t = shingles[order], text[order]
    new = np.ones(len(s), bool)
    new[1:] = (s[1:] != s[:-1]) | (t[1:] != t[:-1])
    first = np.flatnonzero(new)
    return t[first], s[first], 1.0 + np.log(np.diff(np.concatenate((first, [len(s)]))))


def sketches(text: np.ndarray, shingle: np.ndarray, weight: np.ndarray, n_texts: int, registers: int = REGISTERS, slack: float = 2.0) -> np.ndarray:
    """n_texts x registers: the shingle that arrives first at each register (0 where a text has no shingle)."""
    out = np.zeros((n_texts, registers), np.uint64)
    total = np.bincount(text, weight, n_texts)
    open_text = total > 0
    horizon = np.divide(registers * (np.log(registers) + slack), total, out=np.zeros(n_texts), where=open_text)
    while open_text.any():
        use = open_text[text]
        at, s, w = text[use], shingle[use], weight[use]
        time, number, found = np.zeros(len(s)), 0, []
        while len(s):
            draw = mixed(s, 2 * number + 1)
            time = time - np.log(_fraction(draw)) / w
            early = time <= horizon[at]
            at, s, w, time = at[early], s[early], w[early], time[early]
            found.append((at * registers + (mixed(s, 2 * number + 2) % np.uint64(registers)).astype(np.int64), time, s))
            number += 1
        cell, time, s = (np.concatenate(x) for x in zip(*found, strict=True))
        order = np.lexsort((s, time, cell))
        cell, s = cell[order], s[order]
        first = np.ones(len(cell), bool)
        first[1:] = cell[1:] != cell[:-1]
        hit = np.zeros(n_texts * registers, bool)
        hit[cell[first]] = True
        full = hit.reshape(n_texts, registers).all(axis=1)
        flat = np.zeros(n_texts * registers, np.uint64)
        flat[cell[first]] = s[first]
        done = open_text & full
        out[done] = flat.reshape(n_texts, registers)[done]
        open_text &= ~full
        horizon *= 2
    return out


def estimate(a: np.ndarray, b: np.ndarray) -> float:
    """The share of registers that agree: an unbiased estimate of the probability Jaccard similarity."""
    return float((a == b).mean())


def band_keys(sketch: np.ndarray, rows: int = BAND_ROWS) -> np.ndarray:
    """A 64-bit key for each text and band."""
    n, m = sketch.shape
    parts = sketch.reshape(n, m // rows, rows)
    key = np.broadcast_to(np.arange(1, m // rows + 1, dtype=np.uint64), (n, m // rows))
    for j in range(rows):
        key = mixed(key ^ parts[:, :, j], j)
    return key


def sketch_table(docs: DataFrame, id_column: str = "doc_id", text: str = "text", registers: int = REGISTERS, rows: int = BAND_ROWS) -> DataFrame:
    """row_tag, doc_id, text_key (MD5 of the text), bands (array of longs; null for a text without words)."""
    rows_in = tagged(docs, "row_tag").select("row_tag", F.col(id_column).alias("doc_id"), F.unhex(F.md5(text_or_empty(text))).alias("text_key"), text_or_empty(text).alias("body"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, "body", CHUNK_BYTES):
                hashed = shingle_hashes(*word_hashes(part.column("body")))
                n = part.num_rows
                keys = band_keys(sketches(*weighted(*hashed), n, registers), rows).view(np.int64)
                lists = pa.ListArray.from_arrays(pa.array(np.arange(0, keys.size + 1, keys.shape[1], dtype=np.int32)), pa.array(keys.ravel()))
                empty = pa.array(np.diff(hashed[1]) == 0)
                yield pa.RecordBatch.from_arrays([part.column("row_tag"), part.column("doc_id"), part.column("text_key"), pa.compute.if_else(empty, pa.scalar(None, lists.type), lists)], ["row_tag", "doc_id", "text_key", "bands"])

    id_type = docs.schema[id_column].dataType.simpleString()
    return rows_in.mapInArrow(run, f"row_tag long, doc_id {id_type}, text_key binary, bands array<long>")


def leader_pairs(edges: DataFrame, texts: DataFrame, key_type: str = "binary") -> DataFrame:
    """Rows (u, part, v, body) for a streaming comparison: in each (u, part) the leader's own text comes first, with v null.

    edges: (u, v) of text keys, further columns are carried along (null beside the leader); texts: (text_key, body), one row a key.
    A leader with many members is dealt out over parts of about `PER_LEADER` members, each with one copy of its text.
    """
    more = [(f.name, f.dataType) for f in edges.schema if f.name not in ("u", "v")]
    parts = stored(edges.groupBy("u").agg(F.ceil(F.count(F.lit(1)) / PER_LEADER).cast("int").alias("parts")), "leaders")
    members = edges.join(if_small(parts), "u").withColumn("part", F.pmod(F.xxhash64("v"), F.col("parts")).cast("int"))
    # bare pairs are narrow: while they are few the texts are not shuffled to meet them
    few = (lambda df: df) if more else (lambda df, small=is_small(edges): F.broadcast(df) if small else df)
    members = texts.join(few(members), F.col("v") == F.col("text_key")).select("u", "part", "v", "body", *[c for c, _ in more])
    own = [F.lit(None).cast(t).alias(c) for c, t in more]
    leaders = texts.join(few(parts), F.col("u") == F.col("text_key")).select("u", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.lit(None).cast(key_type).alias("v"), "body", *own)
    return leaders.unionByName(members).repartition("u", "part").sortWithinPartitions("u", "part", F.col("v").asc_nulls_first())


def verified(edges: DataFrame, texts: DataFrame, down_to: float = 2.0) -> DataFrame:
    """edges (u, v) with both sizes in shingles, the similarity of the whole texts, and the shingles of only one of them (null below the similarity `down_to`)."""
    names = ["u", "v", "size_u", "size_v", "similarity", "difference"]
    kinds = [pa.binary(), pa.binary(), pa.int64(), pa.int64(), pa.float64()]

    def rows(out: list[tuple], found: list[np.ndarray | None]) -> pa.RecordBatch:
        ends = np.cumsum([0] + [0 if x is None else len(x) for x in found]).astype(np.int32)
        flat = np.concatenate([np.zeros(0, np.uint64)] + [x for x in found if x is not None])
        lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(flat.view(np.int64)), mask=pa.array([x is None for x in found]))
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)] + [lists], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        leader, own = None, None
        for batch in batches:
            for part in chunks(batch, "body", CHUNK_BYTES):
                text, shingle, _ = weighted(*shingle_hashes(*word_hashes(part.column("body"))))
                cuts = np.searchsorted(text, np.arange(part.num_rows + 1))
                out, found, held = [], [], 0
                for i, (u, v) in enumerate(zip(part.column("u").to_pylist(), part.column("v").to_pylist(), strict=True)):
                    mine = shingle[cuts[i] : cuts[i + 1]]
                    if v is None:
                        leader, own = u, mine
                        continue
                    assert leader == u
                    apart = np.setxor1d(own, mine, assume_unique=True)
                    total = len(own) + len(mine)
                    alike = (total - len(apart)) / max(1, total + len(apart))
                    out.append((u, v, len(own), len(mine), alike))
                    found.append(apart if alike >= down_to else None)
                    held += len(apart) if alike >= down_to else 0
                    if held > HELD:
                        yield rows(out, found)
                        out, found, held = [], [], 0
                if out:
                    yield rows(out, found)

    return leader_pairs(edges, texts).mapInArrow(run, "u binary, v binary, size_u long, size_v long, similarity double, difference array<long>")


def shingle_table(texts: DataFrame) -> DataFrame:
    """text_key and all distinct shingles of texts (text_key, body)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, "body", CHUNK_BYTES):
                text, shingle, _ = weighted(*shingle_hashes(*word_hashes(part.column("body"))))
                cuts = np.searchsorted(text, np.arange(part.num_rows + 1)).astype(np.int32)
                yield pa.RecordBatch.from_arrays([part.column("text_key"), pa.ListArray.from_arrays(pa.array(cuts), pa.array(shingle.view(np.int64)))], ["text_key", "difference"])

    return texts.select("text_key", "body").mapInArrow(run, "text_key binary, difference array<long>")


def _pair(a: str, b: str) -> list[Column]:
    return [F.least(a, b).alias("u"), F.greatest(a, b).alias("v")]


def _mixed(rows: DataFrame, keys: list[str]) -> DataFrame:
    """The keys at which texts of several components meet."""
    return rows.groupBy(*keys).agg(F.min("label").alias("low"), F.max("label").alias("high")).filter("low < high").select(*keys)


def crossings(rows: DataFrame, similar: float = SIMILAR) -> DataFrame:
    """Pairs (u, v) of texts of one leader and two components that may be similar, none that are similar left out.

    rows: leader, scale (what counts as a small difference from it), text_key, label (component), size, difference; stored.
    """
    ratio, slight = (1 - similar) / (1 + similar), 1e-6
    texts = rows.select("leader", "scale", "text_key", "label", "size", F.size("difference").alias("apart"))
    texts = texts.withColumn("gain", F.col("size") * ratio - F.col("apart")).withColumn("kind", F.floor(F.asinh(F.col("gain") / F.col("scale")) * CLASSES))
    texts = stored(texts, "near-gains")
    best = texts.groupBy("leader").agg(F.max_by(F.struct("text_key", "gain", "label"), F.struct("gain", "text_key")).alias("best"))
    star = texts.join(if_small(stored(best, "near-best")), "leader").filter((F.col("gain") + F.col("best.gain") >= -slight) & (F.col("label") != F.col("best.label")))
    star = star.select(F.col("best.text_key").alias("u"), F.col("text_key").alias("v"))
    # the places up to which a text's prefix for each class of its leader's texts goes
    kinds = stored(texts.groupBy("leader", F.col("kind").alias("with")).agg(F.min("label").alias("_low"), F.max("label").alias("_high")), "near-kinds")
    least = -(F.col("gain") + F.col("scale") * F.sinh((F.col("with") + 1) / CLASSES)) / 2
    last = F.col("apart") - F.greatest(F.ceil(least - slight), F.lit(1)) + 1
    cut = texts.join(if_small(kinds), "leader").filter("_low <> label OR _high <> label").withColumn("last", last).filter("last >= 1").drop("_low", "_high", "scale")
    items = rows.select("leader", "text_key", "label", F.explode("difference").alias("item"))
    often = items.groupBy("leader", "item").agg(F.count(F.lit(1)).alias("texts"), F.min("label").alias("low"), F.max("label").alias("high"))
    place = F.row_number().over(Window.partitionBy("leader", "text_key").orderBy("texts", "item"))
    placed = items.drop("label").join(often, ["leader", "item"]).withColumn("place", place).filter("low < high").drop("texts", "low", "high")
    ends = placed.join(cut, ["leader", "text_key"]).filter("place <= last")
    ends = ends.select("leader", "item", F.least("kind", "with").alias("lower"), F.greatest("kind", "with").alias("upper"), "kind", "text_key", "label", "size", "apart", "place")
    ends = stored(ends, "near-prefixes")
    meet = ["leader", "item", "lower", "upper"]
    ends = ends.join(if_small(stored(_mixed(ends, meet), "near-mixed")), meet, "left_semi")
    other = ends.filter("kind = upper").select(*meet, *[F.col(c).alias(f"_{c}") for c in ("text_key", "label", "size", "apart", "place")])
    need = (F.col("apart") + F.col("_apart") - (F.col("size") + F.col("_size")) * ratio) / 2
    room = 1 + F.least(F.col("apart") - F.col("place"), F.col("_apart") - F.col("_place"))
    may = (need <= room + slight) & (F.least("size", "_size") >= F.greatest("size", "_size") * similar - slight)
    one_way = (F.col("lower") < F.col("upper")) | (F.col("text_key") < F.col("_text_key"))
    met = ends.filter("kind = lower").join(other, meet).filter((F.col("label") != F.col("_label")) & one_way & may)
    return star.select(*_pair("u", "v")).unionByName(met.select(*_pair("text_key", "_text_key"))).distinct()


def near_links(sketch: DataFrame, docs: DataFrame, text: str = "text", similar: float = SIMILAR) -> DataFrame:
    """Verified links (u, v) between distinct texts, by text key, that make the classes; sketch: the stored `sketch_table` of docs."""
    distinct = sketch.filter("bands IS NOT NULL").groupBy("text_key").agg(F.min_by("bands", "row_tag").alias("bands"), F.min("row_tag").alias("row_tag"))
    rows = distinct.select("text_key", "row_tag", F.posexplode("bands").alias("band", "key")).select("text_key", "row_tag", F.xxhash64("band", "key").alias("bucket"))
    rows = stored(rows, "near-bands")
    several = rows.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    met = stored(rows.join(several, "bucket"), "near-members")
    tags = stored(met.groupBy("text_key").agg(F.min("row_tag").alias("_tag"), F.sum("n").alias("company")), "near-tags")
    own = tagged(docs, "_own_tag").select("_own_tag", text_or_empty(text).alias("body"))
    texts = stored(own.join(if_small(tags), F.col("_own_tag") == F.col("_tag")).select("text_key", "body"), "near-texts")
    typical = F.max_by("text_key", F.struct("company", "text_key")).alias("u")
    leaders = met.join(if_small(tags.select("text_key", "company")), "text_key").groupBy("bucket").agg(typical)
    edges = stored(met.join(leaders, "bucket").filter("text_key <> u").select("u", F.col("text_key").alias("v")).distinct(), "near-edges")
    near = FAR - (1 - similar)
    known = stored(verified(edges, texts, near).withColumn("ok", F.col("similarity") >= similar), "near-verified")
    linked = known.filter("ok").select("u", "v")
    if not known.filter("NOT ok").isEmpty():
        labels = stored(components(linked), "near-joined").withColumnRenamed("node", "text_key")
        close = known.filter(F.col("similarity") >= near).select(F.col("u").alias("leader"), F.greatest(F.col("size_u") * (1 - similar), F.lit(1.0)).alias("scale"), F.col("v").alias("text_key"), F.col("size_v").alias("size"), "difference")
        distant = stored(known.filter(F.col("similarity") < FAR).select(F.col("v").alias("text_key")).distinct(), "near-distant")
        whole = shingle_table(texts.join(if_small(distant), "text_key", "left_semi")).select(F.lit(b"").alias("leader"), F.lit(1.0).alias("scale"), "text_key", F.size("difference").cast("long").alias("size"), "difference")
        every = stored(close.unionByName(whole).join(if_small(labels), "text_key", "left").withColumn("label", F.coalesce("label", "text_key")), "near-differences")
        every = stored(every.join(if_small(stored(_mixed(every, ["leader"]), "near-leaders")), "leader", "left_semi"), "near-compared")
        more = stored(crossings(every, similar).join(known.select(*_pair("u", "v")), ["u", "v"], "left_anti"), "near-crossings")
        linked = linked.unionByName(verified(more, texts).filter(F.col("similarity") >= similar).select("u", "v"))
    return linked.select(*_pair("u", "v")).distinct()


def near_groups(docs: DataFrame, id_column: str = "doc_id", text: str = "text", similar: float = SIMILAR) -> DataFrame:
    """One row per row of `docs`: doc_id, row_tag, class_id (smallest id of its near-duplicate class), class_size (rows), n_links (verified links of its text), kept (one row a class)."""
    spark = docs.sparkSession
    ship_package(spark)
    since, docs = stored_so_far(spark), steady(docs)
    sketch = stored(sketch_table(docs, id_column, text), "near-sketch")
    links = stored(near_links(sketch, docs, text, similar), "near-links")
    labels = stored(components(links), "near-labels")
    degree = links.select("u").union(links.select("v")).groupBy("u").agg(F.count(F.lit(1)).alias("n_links"))
    nodes = stored(labels.join(degree, labels.node == degree.u).select(F.col("node").alias("text_key"), F.col("label").alias("component"), "n_links"), "near-nodes")
    own = F.concat(F.lit("row ").cast("binary"), F.col("row_tag").cast("string").cast("binary"))
    rows = sketch.join(if_small(nodes), "text_key", "left")
    key = F.when(F.col("bands").isNull(), own).otherwise(F.coalesce("component", "text_key"))
    rows = stored(rows.select("doc_id", "row_tag", key.alias("component"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links")), "near-rows")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row_tag"))
    groups = rows.groupBy("component").agg(first.alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    groups = stored(groups.select("component", "first", "n"), "near-groups")
    sweep(spark, since, rows, groups)
    out = rows.join(if_small(groups), "component", "left")
    alone = F.col("n").isNull()
    return out.select("doc_id", "row_tag", F.when(alone, F.col("doc_id")).otherwise(F.col("first.doc_id")).alias("class_id"), F.coalesce("n", F.lit(1)).cast("long").alias("class_size"), "n_links", (alone | (F.col("first.row_tag") == F.col("row_tag"))).alias("kept"))


def near_dedup(docs: DataFrame, id_column: str = "doc_id", text: str = "text", similar: float = SIMILAR) -> DataFrame:
    """`docs` with one row of each near-duplicate class, its columns unchanged."""
    docs = steady(docs)
    since = stored_so_far(docs.sparkSession)
    dropped = stored(near_groups(docs, id_column, text, similar).filter("NOT kept").select("row_tag"), "near-dropped")
    sweep(docs.sparkSession, since, dropped)
    return without_tags(docs, dropped)


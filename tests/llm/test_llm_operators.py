"""Training-data operators: brute-force versions, round trips, and odd inputs (nulls, empty and long texts, ties, repeats, empty tables, clashing names)."""

import base64
import hashlib
import itertools
import json
import random
import struct
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from saltmarsh.llm import exact, graph, media, mixing, near, passages, quality, shingles, simple8b, spiece, tokenfile, toxicity, warc

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def make_words(rng, n):
    return [rng.choice("ka lo mi ne pu ra so ti ve zu".split()) + rng.choice("ba de fi go hu".split()) + str(rng.randrange(30)) for _ in range(n)]


def odd_rows():
    """Nulls everywhere, empty and long texts, ties and repeated rows."""
    rng = random.Random(5)
    base = make_words(rng, 120)
    edited = [*base[:60], "changed", *base[61:]]
    long_text = " ".join(make_words(rng, 30000))
    rows = [(1, " ".join(base)), (2, " ".join(base)), (3, " ".join(edited)), (3, " ".join(edited)), (4, ""), (5, None), (None, None), (None, " ".join(base)), (6, long_text), (7, "one two"), (8, "one two"), (9, "Ünï cödé\n\ttext ▁ mark   x"), (10, " \n ")]
    sources = ["b", "a", None, "b", "a", None, "b"]
    return [(d, t, None if i % 3 else "en", sources[i % 7], None) for i, (d, t) in enumerate(rows)]


@pytest.fixture(scope="module")
def docs(spark, tmp_path_factory):
    """The odd rows as a file scan."""
    path = str(tmp_path_factory.mktemp("docs") / "documents.parquet")
    spark.createDataFrame(odd_rows(), DOCS).repartition(3).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="module")
def no_docs(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("none") / "documents.parquet")
    spark.createDataFrame([], DOCS).write.parquet(path)
    return spark.read.parquet(path)


def clashing(docs):
    """Columns named like those that operators make for themselves."""
    return docs.withColumns({c: F.lit("x") for c in ("size", "copies", "row_tag", "score", "body", "once", "target", "_own_row_tag2")})


# --- 1 mixing


def targets_by_hand(sizes):
    """The excess reshared round by round."""
    names = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight = {s: i % 3 + 1 for i, s in enumerate(names)}
    total, fixed = sum(sizes.values()), {}
    while True:
        free = [s for s in names if s not in fixed]
        rest, w = total - sum(fixed.values()), sum(weight[s] for s in free)
        over = [s for s in free if weight[s] * rest / w > 3 * sizes[s] + 1e-9] if w else []
        if not over:
            return {s: fixed.get(s, weight[s] * rest / w if s in free else 0) for s in names}
        fixed |= {s: 3 * sizes[s] for s in over}


def test_targets(spark):
    rng = random.Random(1)
    for n in (1, 2, 5, 12):
        sizes = {f"s{i}": rng.choice([0, 1, 5, 50, 1000]) for i in range(n)} | {None: 7}
        df = spark.createDataFrame(list(sizes.items()), "source string, size long")
        got = {r.source: r.target for r in mixing.source_targets(df).collect()}
        want = targets_by_hand(sizes)
        assert got.keys() == want.keys() and all(got[k] == pytest.approx(want[k]) for k in want)


def test_mix(spark, docs, no_docs):
    got = mixing.mix_counts(docs, keep=("doc_id", "source")).collect()
    assert len(got) == len(odd_rows()) and all(r.copies <= 3 for r in got)
    assert sorted(map(str, got)) == sorted(map(str, mixing.mix_counts(docs, keep=("doc_id", "source")).collect()))
    wide = clashing(docs)
    mixed = mixing.mix(wide)
    assert mixed.columns == wide.columns
    assert mixed.count() == sum(r.copies for r in got)
    assert mixing.mix(no_docs).count() == 0
    many = spark.createDataFrame([(i, "w " * 10, "en", f"s{i % 4}", 1) for i in range(4000)], DOCS)
    per = mixing.mix_counts(many).groupBy("source").agg(F.sum(F.col("size") * F.col("copies")).alias("taken"), F.first("target").alias("target")).collect()
    assert all(abs(r.taken - r.target) < 0.1 * r.target for r in per)


# --- 7 exact


@pytest.mark.parametrize("rows", [1_000_000, 0])
def test_exact(docs, no_docs, rows):
    got = exact.exact_groups(docs, hash_all=True, broadcast_rows=rows).collect()
    want = defaultdict(list)
    for d, t, *_ in odd_rows():
        want[hashlib.sha256((t or "").encode()).hexdigest()].append(d)
    assert Counter(r.text_sha256 for r in got) == {k: len(v) for k, v in want.items()}
    for r in got:
        ids = want[r.text_sha256]
        assert r.group_size == len(ids) and r.keep_id == max((x for x in ids if x is not None), default=None)
    assert sum(r.kept for r in got) == len(want)
    assert exact.exact_groups(no_docs, broadcast_rows=rows).count() == 0


def test_exact_keeps_columns(docs):
    wide = clashing(docs)
    kept = exact.exact_dedup(wide)
    assert kept.columns == wide.columns and kept.count() == len({t or "" for _, t, *_ in odd_rows()})


# --- 8 near


def shingle_sets(texts):
    out = {}
    for i, t in texts.items():
        w = [x for x in t.replace("\n", " ").replace("\t", " ").split(" ") if x]
        out[i] = {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()
    return out


def test_sketch_estimates_similarity():
    rng = random.Random(2)
    a = make_words(rng, 600)
    b = a[:500] + make_words(rng, 100)
    h, s = shingles.shingle_hashes(*shingles.word_hashes(pa.array([" ".join(a), " ".join(b), "x", ""])))
    sk = near.sketches(*near.weighted(h, s), 4, registers=512)
    true = len(np.intersect1d(h[s[0] : s[1]], h[s[1] : s[2]])) / len(np.union1d(h[s[0] : s[1]], h[s[1] : s[2]]))
    assert abs(near.estimate(sk[0], sk[1]) - true) < 0.08
    assert (sk[2] != 0).all() and (sk[3] == 0).all()


def test_sketch_is_that_of_full_processes():
    """Early termination changes nothing: the same registers as with every arrival up to a late time."""
    h, s = shingles.shingle_hashes(*shingles.word_hashes(pa.array(["a b c d e f g h a b c d e f"])))
    t, x, w = near.weighted(h, s)
    assert (near.sketches(t, x, w, 1) == near.sketches(t, x, w, 1, slack=60.0)).all()


def near_corpus():
    rng, rows = random.Random(9), []
    for g in range(12):
        base = make_words(rng, 150)
        for _ in range(rng.randrange(1, 6)):
            w = list(base)
            for _ in range(rng.randrange(0, 4)):
                w[rng.randrange(len(w))] = f"new{rng.randrange(999)}"
            rows.append(" ".join(w))
    common = make_words(rng, 70)
    rows += [" ".join(common + make_words(rng, 60)) for _ in range(30)]  # alike, but less than enough
    rows += [rows[0], rows[0], "short", "short", ""]
    return list(enumerate(rows))


def test_near_against_all_pairs(spark, tmp_path):
    rows = near_corpus()
    spark.createDataFrame([(i, t, None, None, None) for i, t in rows], DOCS).repartition(3).write.parquet(str(tmp_path / "d"))
    got = {r.doc_id: r.class_id for r in near.near_groups(spark.read.parquet(str(tmp_path / "d"))).collect()}
    assert got == classes_by_hand(shingle_sets(dict(rows)))[0]


def classes_by_hand(sets):
    """The smallest id of each text's component over all pairs of similarity 0.8 or more, and the number of such pairs."""
    parent, pairs = {i: i for i in sets}, 0

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in itertools.combinations(sorted(sets), 2):
        if sets[a] and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]):
            pairs += 1
            x, y = sorted((root(a), root(b)))
            parent[y] = x
    return {i: root(i) for i in sets}, pairs


def straddling(seed):
    """Large groups whose similarities lie on both sides of 0.8, chains that slide away from their beginning, and two groups with half their words in common."""
    rng, texts = random.Random(seed), []
    for _ in range(3):
        base = make_words(rng, 200)
        for _ in range(80):
            w = list(base)
            for k in rng.sample(range(200), rng.randrange(2, 6)):
                w[k] = f"new{rng.randrange(10**6)}"
            texts.append(" ".join(w))
    words = make_words(rng, 400)
    texts += [" ".join(words[k : k + 160]) for k in range(0, 240, 8)]
    half = make_words(rng, 100)
    for _ in range(2):
        base = half + make_words(rng, 100)
        for _ in range(50):
            w = list(base)
            for k in rng.sample(range(200), rng.randrange(1, 6)):
                w[k] = f"new{rng.randrange(10**6)}"
            texts.append(" ".join(w))
    return texts


@pytest.mark.parametrize("seed", [1, 2])
def test_near_large_groups(spark, tmp_path, seed):
    texts = straddling(seed)
    spark.createDataFrame([(i, t, None, None, None) for i, t in enumerate(texts)], DOCS).repartition(3).write.parquet(str(tmp_path / "d"))
    want, pairs = classes_by_hand(shingle_sets(dict(enumerate(texts))))
    assert pairs > 500 and len(set(want.values())) > 20
    assert {r.doc_id: r.class_id for r in near.near_groups(spark.read.parquet(str(tmp_path / "d"))).collect()} == want


@pytest.mark.parametrize("empty_leader", [False, True])
def test_crossings_against_all_pairs(spark, tmp_path, empty_leader):
    """Every similar pair of two components is among the crossings, or both meet the text of most gain."""
    texts = straddling(3)[:170]
    h, s = shingles.shingle_hashes(*shingles.word_hashes(pa.array(texts)))
    sets = [np.unique(h[s[i] : s[i + 1]]) for i in range(len(texts))]
    rows = []
    for group, first in ((range(0, 80), 0), (range(80, 160), 80)):
        leader = np.zeros(0, np.uint64) if empty_leader else sets[first]
        key = b"" if empty_leader else f"{first:04}".encode()
        for i in group:
            if i != first or empty_leader:
                rows.append((bytearray(key), 1.0 if empty_leader else 39.0, bytearray(f"{i:04}".encode()), bytearray(f"{i:04}".encode()), len(sets[i]), np.setxor1d(leader, sets[i]).view(np.int64).tolist()))
    spark.createDataFrame(rows, "leader binary, scale double, text_key binary, label binary, size long, difference array<long>").write.parquet(str(tmp_path / "rows"))
    got = {(int(r.u), int(r.v)) for r in near.crossings(spark.read.parquet(str(tmp_path / "rows"))).collect()}
    own = [int(r[2]) for r in rows]
    alike = {(a, b) for a, b in itertools.combinations(own, 2) if shingles.jaccard(sets[a], sets[b]) >= 0.8}
    linked, parent = got & alike, {i: i for i in own}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in linked:
        parent[root(b)] = root(a)
    assert alike and all(root(a) == root(b) for a, b in alike)
    assert len(got) < 0.5 * len(own) ** 2 / 2


def test_near_star(spark, tmp_path):
    """Copies that are like their original but not like each other, some of it linked before they meet it."""
    rng, texts = random.Random(21), []
    for n in (120, 100):
        base = make_words(rng, 304)
        texts.append(" ".join(base))
        for _ in range(n):
            w = list(base)
            for k in rng.sample(range(2, 302, 6), 6):
                w[k] = f"new{rng.randrange(10**6)}"
            texts.append(" ".join(w))
    spark.createDataFrame([(i, t, None, None, None) for i, t in enumerate(texts)], DOCS).repartition(3).write.parquet(str(tmp_path / "d"))
    sets = shingle_sets(dict(enumerate(texts)))
    alike = [(a, b) for a, b in itertools.combinations(sets, 2) if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])]
    assert len({b for a, b in alike if a == 0}) == 120 and len({b for a, b in alike if a == 121}) == 100
    assert len(alike) < 0.2 * 220 * 219 / 2  # most copies are alike to the original only
    got = {r.doc_id: r.class_id for r in near.near_groups(spark.read.parquet(str(tmp_path / "d"))).collect()}
    assert got == {i: 0 if i <= 120 else 121 for i in range(222)}


def test_near_odd_rows(docs, no_docs):
    got = near.near_groups(docs).collect()
    assert len(got) == len(odd_rows())
    classes = defaultdict(list)
    for r in got:
        classes[r.class_id].append(r)
    assert sum(r.kept for r in got) == len(odd_rows()) - 4 - 1  # base x4 rows + edited x2 in one class of six; "one two" in one of two... each empty text alone
    assert near.near_groups(no_docs).count() == 0
    wide = clashing(docs)
    assert near.near_dedup(wide).columns == wide.columns


# --- 6 passages


def windows_by_hand(v, least):
    out = []

    def split(a, b):
        if b - a < least:
            return
        low = min(v[a:b])
        hits = [i for i in range(a, b) if v[i] == low]
        c = hits[len(hits) // 2]
        out.append((a, c, b))
        split(a, c)
        split(c + 1, b)

    split(0, len(v))
    return sorted(out)


def test_compact_windows():
    rng = np.random.default_rng(4)
    for n, high in ((0, 9), (5, 9), (300, 1 << 60), (300, 3), (1000, 2)):
        v = rng.integers(0, high, n).astype(np.uint64)
        got = passages.compact_windows(v, np.array([0, n]), 10)
        assert sorted(zip(*(x.tolist() for x in got), strict=True)) == windows_by_hand(v.tolist(), 10)


def test_passages(spark, tmp_path):
    rng = random.Random(7)
    shared, short = make_words(rng, 80), make_words(rng, 20)
    texts = [make_words(rng, 100) + shared + make_words(rng, 50), make_words(rng, 30) + shared + make_words(rng, 90), make_words(rng, 60) + short + make_words(rng, 60), short + make_words(rng, 200), make_words(rng, 150), ["same"] * 500, []]
    texts += [texts[4]]
    rows = [(i, " ".join(t), None, None, None) for i, t in enumerate(texts)] + [(None, None, None, None, None)]
    spark.createDataFrame(rows, DOCS).coalesce(1).write.parquet(str(tmp_path / "d"))
    got = passages.passage_links(spark.read.parquet(str(tmp_path / "d"))).collect()
    pairs = {frozenset((r.doc_id, r.other_id)): r for r in got}
    assert set(pairs) == {frozenset((0, 1)), frozenset((4, 7))}
    r = pairs[frozenset((0, 1))]
    span = (r.start_word, r.end_word) if r.doc_id == 0 else (r.other_start, r.other_end)
    assert span == (100, 180)


def test_passage_variants(spark, tmp_path):
    """One passage with two edits in each text: every text that shares it with another has a span over it."""
    rng = random.Random(3)
    base, texts = make_words(rng, 100), []
    for i in range(32):
        p = list(base)
        for k in rng.sample(range(6, 94, 6), 2 if i else 0):
            p[k] = f"new{rng.randrange(10**6)}"
        texts.append(make_words(rng, 40) + p + make_words(rng, 40))
    order = texts[1:20] + texts[:1] + texts[20:]
    spark.createDataFrame([(i, " ".join(t), None, None, None) for i, t in enumerate(order)], DOCS).coalesce(1).write.parquet(str(tmp_path / "d"))
    sets = shingle_sets({i: " ".join(t[40:140]) for i, t in enumerate(order)})
    alike = {i for a, b in itertools.combinations(sets, 2) if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]) for i in (a, b)}
    assert len(alike) == 32
    spans = [s for r in passages.passage_links(spark.read.parquet(str(tmp_path / "d"))).collect() for s in ((r.doc_id, r.start_word, r.end_word), (r.other_id, r.other_start, r.other_end))]
    assert {d for d, b, e in spans if min(e, 140) - max(b, 40) >= 50} == alike


def windows_alike(texts, least=46):
    """By brute force: for each text the places of least passages that are similar to one of another text."""
    tokens = []
    for t in texts:
        h, _ = shingles.shingle_hashes(*shingles.word_hashes(pa.array([" ".join(t)])))
        tokens.append(h)
    out = defaultdict(set)
    for a, b in itertools.combinations(range(len(texts)), 2):
        places = [np.flatnonzero(np.isin(x, y)) for x, y in ((tokens[a], tokens[b]), (tokens[b], tokens[a]))]
        if min(map(len, places)) < 0.8 * least:
            continue
        for p in range(0, len(tokens[a]) - least + 1, 4):
            own = np.unique(tokens[a][p : p + least])
            for q in range(0, len(tokens[b]) - least + 1, 4):
                if shingles.jaccard(own, np.unique(tokens[b][q : q + least])) >= 0.8:
                    out[a].add(p)
                    out[b].add(q)
    return out


def test_passages_recall(spark, tmp_path):
    """Variants of long and short passages among other words, and a line below the least length in every text: nine tenths of what brute force finds lies in spans."""
    rng, texts = random.Random(12), []
    line = make_words(rng, 30)
    for size, copies, edits in ((70, 40, 3), (120, 40, 8), (52, 20, 1)):
        base = make_words(rng, size)
        for _ in range(copies):
            w = list(base)
            for k in rng.sample(range(size), rng.randrange(edits + 1)):
                w[k] = f"new{rng.randrange(10**6)}"
            texts.append(make_words(rng, 20) + w + make_words(rng, 20) + line + make_words(rng, 15))
    rng.shuffle(texts)
    spark.createDataFrame([(i, " ".join(t), None, None, None) for i, t in enumerate(texts)], DOCS).repartition(3).write.parquet(str(tmp_path / "d"))
    spans = defaultdict(list)
    for r in passages.passage_links(spark.read.parquet(str(tmp_path / "d"))).collect():
        spans[r.doc_id].append((r.start_word, r.end_word))
        spans[r.other_id].append((r.other_start, r.other_end))
    want = windows_alike(texts)
    places = [(i, p + 23) for i, found in want.items() for p in found]
    hit = sum(any(x <= m < y for x, y in spans[i]) for i, m in places)
    assert len(want) > 80 and hit >= 0.9 * len(places)
    assert sum(i in spans for i in want) >= 0.98 * len(want)


@pytest.mark.parametrize("block, size", [(25, 60), (40, 80), (60, 60)])
def test_spans_beside_another_shared_block(block, size):
    """A passage with an edit next to a block that is shared too but lies elsewhere in the other text."""
    rng = random.Random(block)
    b, p = make_words(rng, block), make_words(rng, size)
    edited = [*p[: size // 2], "changed", *p[size // 2 + 1 :]]
    one = make_words(rng, 30) + b + p + make_words(rng, 40)
    for two, at in ((edited + make_words(rng, 70) + b, 0), (make_words(rng, 50) + b + make_words(rng, 90) + edited, 140 + block)):
        tokens, starts = shingles.shingle_hashes(*shingles.word_hashes(pa.array([" ".join(one), " ".join(two)])))
        u, v = tokens[: starts[1]], tokens[starts[1] :]
        for x, y, swap in ((u, v, False), (v, u, True)):
            got = passages.shared_spans(x, y)
            spans = [(c, d, a, b, j) if swap else (a, b, c, d, j) for a, b, c, d, j in got]
            assert any(abs(s[0] - 30 - block) <= 4 and abs(s[1] - 30 - block - size + 4) <= 4 and abs(s[2] - at) <= 4 and abs(s[3] - at - size + 4) <= 4 for s in spans), spans
            assert all(j >= 0.8 and shingles.jaccard(np.unique(u[a:b]), np.unique(v[c:d])) == pytest.approx(j) for a, b, c, d, j in spans)


def test_spans_against_all_windows():
    """Edits all along a passage: each window that is similar to one of the other text has its middle in a span of this pair."""
    rng, n_windows = random.Random(21), 0
    for size, edits, pairs in ((70, 1, 25), (100, 2, 25), (200, 5, 10)):
        base = make_words(rng, size)
        for _ in range(pairs):
            texts = []
            for _ in range(2):
                w = list(base)
                for k in rng.sample(range(size), edits):
                    w[k] = f"new{rng.randrange(10**6)}"
                texts.append(make_words(rng, 15) + w + make_words(rng, 15))
            tokens, starts = shingles.shingle_hashes(*shingles.word_hashes(pa.array([" ".join(t) for t in texts])))
            u, v = tokens[: starts[1]], tokens[starts[1] :]
            got = passages.shared_spans(u, v)
            assert all(j >= 0.8 and shingles.jaccard(np.unique(u[a:b]), np.unique(v[c:d])) == pytest.approx(j) for a, b, c, d, j in got)
            for side, found in windows_alike(texts).items():
                n_windows += len(found)
                assert all(any(s[2 * side] <= p + 23 < s[2 * side + 1] for s in got) for p in found)
    assert n_windows > 300


def test_passage_classes_against_all_pairs(spark, tmp_path):
    """Variants of variants, and a common core with ends of its own, in texts that share a line: each pair with a span of its own is joined by links."""
    rng, texts = random.Random(5), []
    line, core = make_words(rng, 30), make_words(rng, 38)

    def add(words, edits):
        w = list(words)
        for k in rng.sample(range(len(w)), edits):
            w[k] = f"new{rng.randrange(10**6)}"
        texts.append(make_words(rng, rng.randrange(10, 40)) + w + make_words(rng, rng.randrange(10, 40)) + line + make_words(rng, 15))
        return w

    for size, edits in ((60, 3), (52, 3), (90, 5)):
        base = make_words(rng, size)
        for _ in range(10):
            one = add(base, edits)
            for _ in range(4):
                add(one, rng.randrange(2))
    for _ in range(20):
        end = make_words(rng, 14)
        for _ in range(3):
            add(core + end, rng.randrange(2))
    for _ in range(40):
        add(base[:51], 1)
    rng.shuffle(texts)
    tokens, starts = shingles.shingle_hashes(*shingles.word_hashes(pa.array([" ".join(t) for t in texts])))
    want = [(a, b) for a, b in itertools.combinations(range(len(texts)), 2) if passages.shared_spans(tokens[starts[a] : starts[a + 1]], tokens[starts[b] : starts[b + 1]])]
    spark.createDataFrame([(i, " ".join(t), None, None, None) for i, t in enumerate(texts)], DOCS).repartition(3).write.parquet(str(tmp_path / "d"))
    label = list(range(len(texts)))
    for r in passages.passage_links(spark.read.parquet(str(tmp_path / "d"))).collect():
        a, b = label[r.doc_id], label[r.other_id]
        label = [a if x == b else x for x in label]
    assert len(want) > 200 and all(label[a] == label[b] for a, b in want)


def test_windows_beside_a_common_line(spark, tmp_path):
    """Windows of texts that share a line only are left out before pairs are met; those of a passage with an edit in it stay."""
    rng = random.Random(9)
    line, passage = make_words(rng, 26), make_words(rng, 60)
    texts = [make_words(rng, 40) + line + make_words(rng, 40) for _ in range(30)]
    for i in (30, 31):
        texts.append(make_words(rng, 20) + passage[:30] + [f"edit{i}"] + passage[31:] + make_words(rng, 20))
    bodies = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "text_key long, body string")
    every = passages.window_table(bodies.withColumnRenamed("text_key", "row_tag"))
    several = every.groupBy("key").agg(F.count_if("once").cast("int").alias("n")).filter("n > 1")
    kept = graph.stored(passages.kept_windows(every.join(several, "key")), "kept")
    assert len({r.row_tag for r in kept.collect()}) > 10
    assert {r.row_tag for r in passages.supported(kept, bodies).collect()} == {30, 31}


def test_row_minima():
    """Each row of tokens of one text has its least one among those given, and lies in what that one covers."""
    rng = np.random.default_rng(6)
    for sizes in ((40, 3, 0, 5, 30), (2, 2, 2), (0,), (100,)):
        starts = np.concatenate(([0], np.cumsum(sizes)))
        tokens = rng.integers(0, 20, starts[-1]).astype(np.uint64)
        place, begin, end = passages.row_minima(tokens, starts)
        values = shingles.mixed(tokens, 99)
        for a, b in itertools.pairwise(starts.tolist()):
            for i in range(a, b - passages.ROW + 1):
                hit = [p for p, x, y in zip(place.tolist(), begin.tolist(), end.tolist(), strict=True) if x <= i and i + passages.ROW <= y]
                assert hit and any(values[p] == values[i : i + passages.ROW].min() for p in hit)


def test_passage_places_in_long_chains(spark):
    """Places that a chain of 300 spans joins have one label, as those of two shorter ones have theirs; in parts they would meet again."""
    ids = list(range(300))
    random.Random(4).shuffle(ids)
    chains = [ids, [400, 401, 402], [500, 501]]
    rows = [(a, b, 0, 60, 5, 65, 1.0) if a % 2 else (a, b, 0, 60, 0, 60, 1.0) for c in chains for a, b in itertools.pairwise(c)]
    spans = spark.createDataFrame(rows, "u long, v long, u_start long, u_end long, v_start long, v_end long, similarity double")
    labels = defaultdict(set)
    for r in passages.passage_classes(spans).collect():
        labels[r.row_tag].add(r.label)
    found = [{x for i in c for x in labels[i]} for c in chains]
    assert len(labels) == 305 and list(map(len, found)) == [1, 1, 1] and len(set.union(*found)) == 3


def test_components_in_a_task(spark):
    """One task's labels are those of the joins, on both sides of the bound."""
    rng = random.Random(8)
    edges = graph.stored(spark.createDataFrame([(rng.randrange(300), rng.randrange(300)) for _ in range(200)], "u long, v long"), "edges")
    want = {(r.node, r.label) for r in graph.components(edges).collect()}
    for most in (10, 1000):
        assert {(r.node, r.label) for r in graph.components_in_a_task(edges, most=most).collect()} == want
    assert graph.components_in_a_task(graph.stored(edges.filter("u < 0"), "edges")).isEmpty()


def test_passages_of_nothing(no_docs):
    assert passages.passage_links(no_docs).count() == 0


# --- 10 token files


@pytest.mark.parametrize("n", [0, 1, 255, 256, 257, 5000])
@pytest.mark.parametrize("high", [1, 2, 100, 50000, 1 << 40, 1 << 63])
def test_simple8b(n, high):
    v = np.random.default_rng(n).integers(0, high, n).astype(np.uint64)
    words, offsets = simple8b.pack(v)
    assert (simple8b.unpack(words, offsets, n) == v).all()
    assert len(offsets) == -(-n // simple8b.BLOCK) + 1


def test_token_files(docs, no_docs):
    P = pytest.importorskip("public_tokenizers")
    from tokenizers import Tokenizer

    path = P.path("word_bpe_49k.json")
    t, start = Tokenizer.from_file(path), 0
    got = sorted(tokenfile.token_digest(docs, path).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in got] == sorted((r[0] for r in odd_rows()), key=lambda d: (d is not None, d))
    want = Counter()
    for d, text, *_ in odd_rows():
        ids = [*t.encode(text or "", add_special_tokens=False).ids, 1]
        want[d, len(ids), zlib.crc32(struct.pack(f"<{len(ids)}I", *ids))] += 1
    assert Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in got) == want
    for r in got:
        assert r.start == start
        start += r.n_tokens
    assert tokenfile.token_digest(no_docs, path).count() == 0


def test_words_are_the_librarys():
    P = pytest.importorskip("public_tokenizers")
    texts = ["It's, 'S IT'S don't!!", "İstanbul ΣΑΣ. ﬁn été", "<|endoftext|> a\x1cb \xa0 c", "x" * 3000, "", None, "12 3a b4."]
    w = tokenfile.WordIds(P.path("word_bpe_49k.json"))
    ids, cuts = w.of(pa.array(texts))
    for i, e in enumerate(w.tokenizer.encode_batch([t or "" for t in texts], add_special_tokens=False)):
        assert ids[cuts[i] : cuts[i + 1]].tolist() == e.ids
    assert w.by_word


def test_words_with_punctuation_behind_are_looked_up_in_parts():
    """Any letters before any punctuation give the library's ids, and only the letters and the punctuation by themselves are kept."""
    P = pytest.importorskip("public_tokenizers")
    rng, w = random.Random(6), tokenfile.WordIds(P.path("word_bpe_49k.json"))
    stems = ["word", "Word", "WORD", "été", "ÉTÉ", "straße", "don't", "a1", "İx", "ΟΔΟΣ", "e\u0301", "ﬁn", "ª", "日本", "", "x.y", "\u01c5"]
    ends = ["", ",", ".", "!!", "'", "')", "&&&", '."', "…", "\u0301", "._"]
    words = [a + b for a in stems for b in ends]
    for _ in range(3):
        texts = [" ".join(rng.choices(words, k=40)) for _ in range(60)]
        ids, cuts = w.of(pa.array(texts))
        for i, e in enumerate(w.tokenizer.encode_batch(texts, add_special_tokens=False)):
            assert ids[cuts[i] : cuts[i + 1]].tolist() == e.ids
    assert {"word", "été", ",", "&&&"} <= set(w.known) and not {"word,", "été&&&", "WORD.", "straße!!"} & set(w.known)


@pytest.mark.parametrize("change", ["normalizer", "pre_tokenizer"])
def test_other_tokenizers_encode_whole_texts(tmp_path, change):
    P = pytest.importorskip("public_tokenizers")
    with open(P.path("word_bpe_49k.json"), encoding="utf-8") as f:
        settings = json.load(f)
    if change == "normalizer":
        settings["normalizer"] = {"type": "NFC"}
    else:
        settings["pre_tokenizer"]["pretokenizers"][0]["pattern"] = {"Regex": "[^,]+"}
    (tmp_path / "other.json").write_text(json.dumps(settings), encoding="utf-8")
    texts = ["It's a TEST, of two words", "", None, "a  b\tc"]
    w = tokenfile.WordIds(str(tmp_path / "other.json"))
    ids, cuts = w.of(pa.array(texts))
    assert not w.by_word
    for i, e in enumerate(w.tokenizer.encode_batch([t or "" for t in texts], add_special_tokens=False)):
        assert ids[cuts[i] : cuts[i + 1]].tolist() == e.ids


# --- 5 WARC


def test_warc(spark, tmp_path):
    rows = [(1, "http://a/x", "<p>é</p>"), (2, None, "<p>é</p>"), (3, "u", ""), (4, "u", None), (4, "u", None), (None, "u", "<p>é</p>"), (5, "u v\n", "z" * 300_000)]
    spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1).write.parquet(str(tmp_path / "p"))
    pages = spark.read.parquet(str(tmp_path / "p"))
    folder = f"file://{tmp_path}/w"
    manifest = warc.write_warc(pages, folder, roll_bytes=400)
    got = warc.read_warc(spark, manifest, payload=True).collect()
    want = Counter((d, len((h or "").encode()), base64.b32encode(hashlib.sha1((h or "").encode()).digest()).decode()) for d, _, h in rows)
    assert Counter((r.page_id, r.payload_bytes, r.payload_digest) for r in got) == want
    assert {(r.page_id, r.refers_to) for r in got if r.record_type == "revisit"} == {(2, 1), (None, 1), (4, 3)}
    assert sum(r.record_type == "revisit" for r in got) == 4
    files = sorted((tmp_path / "w").glob("*.warc.gz"))
    assert len(files) > 1 and not list((tmp_path / "w").glob("*.tmp")) and (tmp_path / "w" / "MANIFEST.tsv").exists()
    before = [f.read_bytes() for f in files]
    warc.write_warc(pages, folder, roll_bytes=400)
    assert before == [f.read_bytes() for f in files]
    assert warc.read_warc(spark, warc.write_warc(pages.limit(0), f"{folder}0")).count() == 0
    least = warc.read_warc(spark, warc.write_warc(pages, f"{folder}1", least_bytes=1)).collect()
    assert sum(r.record_type == "revisit" for r in least) == 2


# --- 2 media


def test_media(docs, no_docs):
    got = media.media_digest(media.media_column(docs)).collect()
    want = Counter()
    for d, t, *_ in odd_rows():
        b = media.text_payload(t)
        want[d, len((t or "").encode()), len(b), hashlib.sha256(b).hexdigest(), zlib.crc32(b[-16:])] += 1
    assert Counter((r.doc_id, r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) for r in got) == want
    assert media.media_digest(media.media_column(no_docs)).count() == 0
    table = media.packet_table(media.media_column(docs)).collect()
    assert sum(r.byte_size for r in table) == sum(r.payload_bytes for r in got) and all(r.codec == "A_PCM/INT/LIT" for r in table)


def test_lacings_and_unknown_sizes():
    frames = [b"a" * 300, b"b" * 20, b"c" * 260, b"d" * 5]
    body = b"".join(frames)
    xiph = bytes([3, 255, 45, 20, 255, 5]) + body
    ebml = bytes([3]) + b"\x41\x2c" + b"\x5e\xe7" + b"\x60\xef" + body
    element = media.element
    blocks = b"".join(element(media.SIMPLE_BLOCK, b"\x81\x00\x02" + flag + data) for flag, data in ((b"\x82", xiph), (b"\x86", ebml), (b"\x84", bytes([1]) + b"xxyy"), (b"\x80", b"one")))
    group = element(media.BLOCK_GROUP, element(media.BLOCK, b"\x81\x00\x05\x00" + b"grp") + element(0xFB, b"\x01"))
    cluster = b"\x1f\x43\xb6\x75\x01\xff\xff\xff\xff\xff\xff\xff" + element(media.TIMESTAMP, b"\x0a") + blocks + group
    data = element(media.EBML, b"") + b"\x18\x53\x80\x67\x01\xff\xff\xff\xff\xff\xff\xff" + cluster + cluster
    got = media.packets(data)
    assert [data[p[2] : p[2] + p[3]] for p in got.packets] == (frames + frames + [b"xx", b"yy", b"one", b"grp"]) * 2
    assert [p[5] for p in got.packets[:12]] == ["xiph"] * 4 + ["ebml"] * 4 + ["fixed"] * 2 + ["none"] * 2
    assert [p[1] for p in got.packets[-2:]] == [12, 15] and not got.packets[-1][4] and len(got.clusters) == 2
    with pytest.raises(ValueError):
        media.packets(data[:-1])


def test_damaged_media(spark):
    df = spark.createDataFrame([(1, bytearray(b"\x1a\x45\xdf\xa3\x88")), (2, None)], "doc_id long, media binary")
    got = media.packet_table(df).collect()
    assert [(r.doc_id, r.packet) for r in got] == [(1, None)] and got[0].error


# --- 3 SentencePiece


def all_paths(t, text):
    """Least cost over every segmentation."""
    if not text:
        return 0.0
    costs = [p.cost + all_paths(t, text[len(p.text) :]) for p in t.pieces if p.kind == spiece.NORMAL and text.startswith(p.text)]
    return min([*costs, t.fallback + all_paths(t, text[1:])])


def test_shortest_path_is_the_least_of_all():
    rng = random.Random(3)
    for _ in range(20):
        pieces = [spiece.Piece("<unk>", 0.0, spiece.UNKNOWN)] + [spiece.Piece(w, rng.randrange(1, 30), spiece.NORMAL) for w in {"".join(rng.choice("ab▁") for _ in range(rng.randrange(1, 4))) for _ in range(12)}]
        t = spiece.Transducer(pieces)
        for _ in range(10):
            text = "".join(rng.choice("abc▁") for _ in range(rng.randrange(0, 9)))
            cost, path = t.shortest(text)
            assert cost == all_paths(t, text)
            assert sum(t.fallback if i is None else t.pieces[i].cost for _, _, i in path) == cost


def test_pieces(docs, no_docs):
    P = pytest.importorskip("public_tokenizers")
    import sentencepiece

    path = P.path("piece_bpe_32k.model")
    library = sentencepiece.SentencePieceProcessor(model_file=path)
    got = spiece.with_pieces(docs, path).collect()
    want = Counter((d, tuple(library.encode(t or ""))) for d, t, *_ in odd_rows())
    assert Counter((r.doc_id, tuple(r.ids)) for r in got) == want
    assert sum(not r.lossless for r in got) == 1  # the text with a blank mark of its own
    back = {r.doc_id: r.text for r in spiece.decoded(spiece.with_pieces(docs, path).filter("doc_id = 6"), path).collect()}
    assert back[6] == next(t for d, t, *_ in odd_rows() if d == 6)
    assert spiece.with_pieces(no_docs, path).count() == 0


def test_units_end_before_marks():
    """Marks behind letters are units of their own where no piece joins the two, and the ids stay the library's."""
    P = pytest.importorskip("public_tokenizers")
    sentencepiece = pytest.importorskip("sentencepiece")
    path = P.path("piece_bpe_32k.model")
    own, library, rng = spiece.compile_model(path), sentencepiece.SentencePieceProcessor(model_file=path), random.Random(3)
    assert own.unit.findall("▁word,&&&▁(x.y)▁▁a\t▁é!▁..²._") == ["▁word", ",&&&", "▁(x", ".y", ")", "▁▁a", "\t", "▁é", "!", "▁..²._"]
    parts = ["a", "é", "1", ".", ",", "&&", "(", "…", "—", " ", "  ", "'s", "_", "²", ".com", "e.g.", "\t", '="', '">', "(x)", "日本", "\U0001f600", "---", "tion", "the"]
    for _ in range(2000):
        text = "".join(rng.choices(parts, k=rng.randrange(1, 25)))
        assert "".join(own.unit.findall(own.normalise(text))) == own.normalise(text)
        assert own.encode(text) == library.encode(text)
    joins = spiece.Transducer([spiece.Piece(t, i, 1) for i, t in enumerate(("a.", "a", ".", "b"))])
    assert joins.unit.findall("a..b.a.") == ["a..b", ".a."]


def test_only_path_is_the_shortest():
    """With the acceptor the path found without costs is that of `shortest`; characters without a piece leave it to that."""
    P = pytest.importorskip("public_tokenizers")
    own, rng = spiece.compile_model(P.path("piece_bpe_32k.model")), random.Random(4)
    for _ in range(500):
        text = "▁" + "".join(rng.choices("etaoinshrdluäéß,.-", k=rng.randrange(1, 30)))
        assert own.only_path(text) == [piece for _, _, piece in own.shortest(text)[1]]
    assert own.only_path("▁a\U0001f9ff") is None


# --- 4 and 9 classifiers


def labelled(spark, tmp_path, label):
    rng, docs, labels = random.Random(6), [], []
    for i in range(400):
        bad = i % 4 == 0
        w = make_words(rng, 60)
        if bad:
            w = [f"{x}###" if label == "quality" else x for x in w]
            if label == "toxic":
                for k in range(0, 60, 15):
                    w[k] = rng.choice(["vileword", "nastyterm"])
        docs.append((i, " ".join(w), None, None, None))
        labels.append((i, int(not bad) if label == "quality" else None, int(bad) if label == "toxic" else None))
    docs += [(None, None, None, None, None), (1000, "", None, None, None), (1001, "word " * 20000, None, None, None)]
    spark.createDataFrame(docs, DOCS).write.parquet(str(tmp_path / "d"))
    table = spark.createDataFrame(labels + [(None, 1, 1), (5000, None, None)], "doc_id long, quality int, toxic int")
    return spark.read.parquet(str(tmp_path / "d")), table, {i: i % 4 == 0 for i in range(400)}


@pytest.mark.parametrize("label", ["quality", "toxic"])
def test_classifiers(spark, tmp_path, no_docs, label):
    docs, labels, bad = labelled(spark, tmp_path, label)
    fit, score = (quality.fit_quality, quality.with_quality) if label == "quality" else (toxicity.fit_toxicity, toxicity.with_toxicity)
    model = fit(docs, labels)
    rows = score(docs, model, keep=("doc_id",)).collect()
    assert len(rows) == 403 and all(0 <= r.score <= 1 for r in rows)
    held = [(r.score >= (0.3 if label == "quality" else 0.5), bad[r.doc_id]) for r in rows if r.doc_id in bad and zlib.crc32(str(r.doc_id).encode()) % 5 == 0]
    right = [(p != b) if label == "quality" else (p == b) for p, b in held]
    assert len(held) > 50 and sum(right) >= 0.95 * len(right)
    wide = clashing(docs)
    assert score(wide, model, score="_s").columns == [*wide.columns, "_s"]
    assert score(no_docs, model).count() == 0
    none = fit(docs, labels.filter("doc_id IS NULL"))
    assert score(docs, none).count() == 403


def test_logits_are_the_mean_of_features():
    rng = np.random.default_rng(1)
    model = quality.QualityModel(rng.normal(size=quality.BUCKETS).astype(np.float32), 0.25)
    texts = ["some words some some", "Ünï ###", "", "x" * 5000]
    got = quality.logits(pa.array(texts), model)
    for t, g in zip(texts, got, strict=True):
        b, c = quality.document_features(t)
        assert g == pytest.approx(0.25 + (float((model.weights[b] * c).sum() / c.sum()) if len(b) else 0.0), abs=1e-4)

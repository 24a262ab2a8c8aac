"""Scoring, chunking, extraction, resolution, structures, curation, resuming on small tables."""

import pytest
from pyspark.sql import functions as F

from saltmarsh.functions import bibtex, chem, translate
from saltmarsh.operators import analysis, checkpoint, chunking, extraction, filtering, fulltext, resolve, scoring


def test_scores(spark):
    cases = [('{"score": 7, "reason": "r"}', 7), ('ok {"score": "7.6"} yes', 7), ('{"score": 15}', 10), ('{"score": -3}', 0), ("8", 8), ("score 15", None), ('{"a": {"score": 3}}', 3), ('{"reason": "none"} 4', 4), ("", None), (None, None), ('{"score": "Infinity"}', None)]
    df = spark.createDataFrame([(i, a, "abs") for i, (a, _) in enumerate(cases)], "seq int, answer string, abstract string")
    got = [r.relevance_score for r in scoring.with_scores(df).orderBy("seq").collect()]
    assert got == [s for _, s in cases]
    kept = scoring.at_least(scoring.with_scores(df), 0)
    assert kept.count() == sum(s is not None for _, s in cases)


def test_answers_come_from_a_backend(spark):
    df = spark.createDataFrame([("t", None), (None, "x" * 2001)], "title string, abstract string")
    prompts = scoring.with_prompt(df, "T {title} A {abstract}")
    got = scoring.with_answers(prompts, lambda ps: [p[:4] for p in ps]).collect()
    assert sorted(r.answer for r in got) == ["T (n", "T t "]
    assert prompts.filter("title IS NULL").first().prompt.endswith("x…")


def test_chunks_cover_the_text(spark):
    texts = ["", "short", "word. " * 2000, "a" * 5000, "para one.\n\n" * 700, None]
    df = spark.createDataFrame(list(enumerate(texts)), "paper_id int, text string")
    rows = chunking.chunks(df, 2000, 200).orderBy("paper_id", "chunk_no").collect()
    for i, t in enumerate(texts):
        own, t = [r for r in rows if r.paper_id == i], t or ""
        assert own[0].char_start == 0 and own[-1].char_end == len(t)
        for a, b in zip(own, own[1:]):
            assert b.char_start == a.char_end - 200 and a.char_end - a.char_start <= 2000
            assert t[a.char_start : a.char_end].strip() == a.chunk_text
    with pytest.raises(ValueError):
        chunking.chunks(df, 2000, 1990)


def test_compounds(spark):
    answers = ['{"compounds": [{"compound_name": "DPA", "smiles": ""}, {"compound_name": "Vitamin C"}, 3]}', '{"items": [{"name": " dpa ", "smiles": "C"}]}', '[{"compound_name": "PANA", "evidence": "e"}]', 'Here: {"compounds": [{"compound_name": "X"}]} done', "junk", None]
    df = spark.createDataFrame([("p", i, f"c{i}", a) for i, a in enumerate(answers)], "paper_id string, chunk_no int, chunk_id string, answer string")
    items = extraction.compounds(df, ["paper_id", "chunk_no", "chunk_id"])
    assert sorted(r.compound_name for r in items.collect()) == ["DPA", "PANA", "X", "dpa"]
    merged = {r.name_key: r for r in extraction.merge_compounds(items).collect()}
    assert merged["dpa"].compound_name == "DPA" and merged["dpa"].smiles == "C" and merged["dpa"].source_chunk_ids == ["c0", "c1"]
    records = extraction.extraction_records(extraction.merge_compounds(items), spark.createDataFrame([("p",), ("q",)], "paper_id string")).collect()
    assert {r.paper_id: r.num_compounds for r in records} == {"p": 3, "q": 0}


def test_resolution(spark):
    names = spark.createDataFrame([(0, "BHT"), (1, "Diphenylamine"), (2, "Diphenilamine"), (3, "pan"), (4, "  ")], "seq int, compound_name string")
    dim = spark.createDataFrame([(5, "Butylated Hydroxytoluene"), (7, "diphenylamine"), (6, "diphenylamine")], "cid int, name string")
    dim = dim.withColumns({"resolved_name": F.col("name"), "pubchem_canonical_smiles": F.lit("C"), "pubchem_isomeric_smiles": F.lit("C"), "iupac_name": F.col("name")})
    near = spark.createDataFrame([("diphenilamine", 0, "diphenylamine"), ("pan", 0, "diphenylamine")], "name_key string, rank int, suggestion string")
    got = {r.normalized_name: (r.lookup_status, r.strategy, r.cid) for r in resolve.resolve_names(resolve.unique_names(names), dim, None, near).collect()}
    assert got == {"bht": ("resolved", "abbreviation", "5"), "diphenylamine": ("resolved", "exact", "6"), "diphenilamine": ("resolved", "autocomplete", "6"), "pan": ("not_found", "none", "NOT FOUND")}


def test_best_title(spark):
    titles = spark.createDataFrame([(0, "Oxidation of oils"), (1, "Oxidation of oil"), (2, "Other thing")], "seq bigint, title string")
    asked = spark.createDataFrame([(1, "oxidation  of OIL"), (2, "zzzz")], "query_id int, title string")
    assert [(r.query_id, r.seq) for r in resolve.best_title(asked, titles).collect()] == [(1, 1)]


def test_positions(spark):
    got = resolve.numbered(spark.range(1000).withColumnRenamed("id", "seq").repartition(7)).collect()
    assert all(r.position == r.seq + 1 for r in got)


def test_positions_of_wide_rows(spark, tmp_path):
    """Two readings of the ranges would draw different bounds; written and read back, no row is lost or moved."""
    spark.conf.set("spark.sql.shuffle.partitions", "200")
    try:
        rows = spark.range(200_000).select(F.col("id").alias("seq"), F.repeat(F.md5(F.col("id").cast("string")), 6).alias("wide"))
        resolve.numbered(rows.repartition(16)).write.parquet(str(tmp_path / "numbered"))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    got = spark.read.parquet(str(tmp_path / "numbered"))
    assert got.count() == 200_000 and got.filter("position <> seq + 1").isEmpty()


@pytest.mark.parametrize("a, b", [("OC1=CC=CC=C1", "Oc1ccccc1"), ("C1=CC=C(C=C1)NC2=CC=CC=C2", "c1ccc(Nc2ccccc2)cc1"), ("C1=CC=C2C(=C1)C=CC=C2NC3=CC=CC=C3", "c1ccc2c(c1)cccc2Nc1ccccc1"), ("CCO", "OCC"), ("C1=CNC=C1", "c1cc[nH]c1")])
def test_equal_structures(a, b):
    parse = chem.SmallBackend().parse
    assert parse(a) == parse(b) is not None
    assert parse(parse(a)[0]) == parse(a)


def test_families():
    family = lambda s: (chem.SmallBackend().parse(s) or [0, 0, None])[2]
    assert [family(s) for s in ("Oc1ccccc1", "Nc1ccc(O)cc1", "CN(C)c1ccccc1", "c1ccc2Sc3ccccc3Nc2c1", "CCO", "c1cc[nH]c1", "C(C)(C)(C)(C)C", "c1cc")] == ["phenolic", "phenolic+aminic_nh", "unclassified", "non_chon", "unclassified", "unclassified", None, None]


def test_fold_is_ordered(spark):
    rows = [(0, "NOT FOUND", "a long name", "C", "other"), (1, "5", "short", "C", "other"), (2, "NOT FOUND", "medium na", "C", "other")]
    for order, winner in (((0, 1, 2), "medium na"), ((1, 0, 2), "a long name"), ((1, 2, 0), "a long name")):
        df = spark.createDataFrame([(i, *rows[k][1:], 1) for i, k in enumerate(order)], "seq int, cid string, name string, smiles string, type string, heavy_atoms int")
        assert [r.name for r in filtering.fold_structures(df.repartition(3)).collect()] == [winner]


def test_curation(spark):
    rows = [(1, "p_2", "10.1/x", "t", "DODPA", "aminic", "inhibits oxidation"), (2, "p_3", "NOT FOUND", "t", "dodpa", "Aminic", "none"), (3, "p_3", "", "t", "BHT", "an arylamine", ""), (4, "p", "", "t", "DPA", "solvent", "")]
    df = spark.createDataFrame(rows, "seq int, paper_id string, doi string, title string, compound_name string, role string, evidence string")
    audit = analysis.audit(df)
    assert {(r.seq, r.candidate_id, r.work_key) for r in audit.collect()} == {(1, "AMN001", "doi:10.1/x"), (2, "AMN001", "id:p"), (3, "", "id:p")}
    c = analysis.candidates(audit).collect()
    assert [(r.candidate_id, r.confidence, r.n_deduplicated_works, r.representative_paper_id) for r in c] == [("AMN001", "high", 2, "p_2")]
    assert analysis.excluded_summary(audit).first().reason == "phenolic antioxidant, not aminic"
    assert analysis.candidates(analysis.audit(df.limit(0))).count() == 0


def test_best_attempts(spark):
    df = spark.createDataFrame([("d", 0, "html", "T", "", "x" * 1300), ("d", 1, "xml", "Longer title", "a" * 130, "y" * 1250), ("d", 2, "pdf", "", "", "")], "doi string, attempt int, source_format string, title string, abstract string, full_text string")
    best = fulltext.best_candidate(fulltext.classify(df)).first()
    assert (best.source_format, best.title, best.label) == ("html", "Longer title", "partial_full_text")


def test_log(spark, tmp_path):
    (tmp_path / "log.jsonl").write_text('{"doi": "a", "seq": 1}\n\nbroken\n{"doi": "a", "seq": 3}\n{"doi": "", "seq": 4}\n{"doi": "b", "seq": 2}\n')
    log = checkpoint.read_log(spark, str(tmp_path), "doi string, seq int")
    assert sorted((r.doi, r.seq) for r in checkpoint.last_wins(log, checkpoint.log_key("doi")).collect()) == [("a", 3), ("b", 2)]


def test_bibtex(spark):
    df = spark.createDataFrame([(1, "", "A {b} \\ c", ["Ann Lee", " "], 2001, None, None, None, None, None, None, None, None, None)], "position int, doi string, title string, authors array<string>, year int, journal string, pmid string, abstract string, keywords array<string>, citation_count int, open_access boolean, source_apis array<string>, relevance_score int, relevance_reason string").withColumn("score_confidence", F.lit("low"))
    assert df.select(bibtex.entry()).first()[0] == "@misc{Lee2001A1,\n  title = {A \\{b\\} \\\\ c},\n  author = {Ann Lee},\n  year = {2001},\n  score_confidence = {low},\n}"


def test_translation(spark):
    df = spark.createDataFrame([("i", ["a", "b c"], ["x", "y"]), ("j", ["a"], [])], "id string, must_contain array<string>, any_of array<string>")
    got = {(r.source, r.id): r.query for r in translate.query_plan(df).collect()}
    assert got["pubmed", "i"] == '"a"[Title/Abstract] AND "b c"[Title/Abstract] AND ("x"[Title/Abstract] OR "y"[Title/Abstract])'
    assert got["lens", "j"] == '{"query":{"bool":{"must":[{"match_phrase":{"title_abstract_keyword":"a"}}]}}}'
    assert got["openalex", "j"] == "a"
    assert translate.unknown_sources(["core", "nope"]) == ["nope"]


def test_outliers(spark):
    df = spark.createDataFrame([(float(i % 7), 1.0) for i in range(50)] + [(1000.0, 1.0)], "a double, b double")
    assert analysis.without_outliers(df, ["a", "b"]).count() == 50


def _times(df, word):
    """How often a word stands in the optimized plan, and in a filter of it."""
    lines = df._jdf.queryExecution().optimizedPlan().toString().split("\n")
    return sum(x.count(word) for x in lines), sum(x.count(word) for x in lines if "Filter" in x)


def test_grading_stands_once_under_filters(spark):
    df = spark.createDataFrame([("d", "t", "", "a" * 5000)], "doi string, title string, abstract string, full_text string")
    graded = fulltext.classify(df)
    kept = fulltext.full_text_only(graded)
    assert _times(kept, "article metrics") == (_times(graded.select("label"), "article metrics")[0], 0)
    assert kept.count() == 1


def test_signs_by_hand(spark):
    from saltmarsh.functions import text as X

    words = "the cat and of dog " * 30
    texts = ["", "the", words, words + "1" * 400, words.replace("cat", "Kin"), words.replace("cat", "İn"), "é" * 300 + words, "7 " + words + " 7", ". " * 3000 + words]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    import re

    from saltmarsh.functions.values import STOP_WORDS

    for r in df.select("t", X.language("t").alias("l")).collect():
        t = r.t.strip()
        s, tokens = t[:6000], re.findall("[A-Za-z]+", t[:6000])
        share, stops = sum(map(len, tokens)) / max(len(s), 1), sum(w in STOP_WORDS for w in re.findall("[a-z]+", s.lower()))
        assert r.l == ("unknown" if len(t) < 80 or len(tokens) < 40 else "en" if share > 0.6 and stops / max(len(tokens), 1) > 0.04 else "non-en" if share < 0.35 else "unknown"), r.t[:20]
    long = "a line of text\n" * 20
    cases = [(long + "ab\n" * 2, 1), (long + "ab\n", 0), (long + " ab  c\x85\n\n", 1), (long + "Â " * 5, 1), ("share article metrics " + long, 2), ("share article metrics ab\n" + "\nabc\n", 3), ("figure 1 click here to view figure\n" + long, 1), ("", 0)]
    df = spark.createDataFrame([(t, n) for t, n in cases], "t string, n int")
    for alone in (True, False):
        for r in df.select("t", "n", X.penalty("t", df.t.substr(1, 0), alone).alias("p")).collect():
            assert r.p == (r.n if alone or r.n > 1 or "Â" in r.t or "figure" in r.t else 0), r


def test_rules_do_not_reach_the_mentions(spark):
    rows = [(i, f"p_{i}", f"10.1/{i % 7}" if i % 3 else "NOT FOUND", f"t{i}", "DODPA" if i % 2 else "dodpa", "aminic", "inhibits oxidation" if i % 4 == 0 else "e" * (i % 5)) for i in range(60)]
    df = spark.createDataFrame(rows, "seq int, paper_id string, doi string, title string, compound_name string, role string, evidence string")
    audit = analysis.audit(df)
    assert _times(audit.filter("candidate_id <> ''"), analysis.CURATION_RULES[0][4][0])[0] == 0
    c = analysis.candidates(audit).first()
    assert (c.n_mentions, c.n_extraction_records, c.n_direct_evidence_mentions, c.aliases) == (60, 60, 15, "DODPA | dodpa")
    assert c.dois == " | ".join(sorted({r[2] for r in rows} - {"NOT FOUND"})) and c.n_deduplicated_works == len({r[2] for r in rows} - {"NOT FOUND"}) + 1
    assert (c.representative_paper_id, c.representative_title) == ("p_0", "t0")


def test_values_are_joined_by_ranges(spark):
    rows = [(k, f"v{i * 37 % 500:03d}") for k in "ab" for i in range(400)] * 2 + [("c", "x")]
    got = {r.k: r.v for r in analysis.joined_values(spark.createDataFrame(rows, "k string, v string"), "k", "v").collect()}
    assert got == {k: " | ".join(sorted({v for n, v in rows if n == k})) for k in "abc"}


def test_name_keys_do_not_reach_the_mentions(spark):
    rows = [(i, f"p{i % 4}", "d", ("Bht", "bht ", "BHT", "oil β")[i % 4], ("C", "NOT FOUND")[i % 2]) for i in range(40)]
    mentions = spark.createDataFrame(rows, "seq int, paper_id string, doi string, compound_name string, paper_smiles string")
    assert _times(resolve.unique_names(mentions), "translate")[1] == 0
    dim = spark.createDataFrame([(7, "bht", "bht", "CC", "NOT FOUND", "x")], "cid int, name string, resolved_name string, pubchem_canonical_smiles string, pubchem_isomeric_smiles string, iupac_name string")
    joined = resolve.with_resolution(mentions, resolve.resolve_names(resolve.unique_names(mentions), dim))
    assert _times(joined, "translate")[0] == 0
    got = {r.cid: (r.aliases, r.paper_smiles, r.paper_count, r.mention_count, r.strategy) for r in resolve.master_rows(joined).collect()}
    assert got == {"7": ("BHT; Bht; bht ", "C", 3, 30, "exact"), "NOT FOUND": ("oil β", "NOT FOUND", 1, 10, "none")}


def test_parser_does_not_reach_the_rows(spark):
    rows = spark.createDataFrame([(i, ("c1ccccc1O", "Oc1ccccc1", "bad(")[i % 3]) for i in range(30)], "seq int, smiles string")
    kept = analysis.unique_structures(rows)
    assert _times(kept, "parse(")[0] == 0
    assert [(r.seq, r.heavy_atoms) for r in kept.collect()] == [(0, 7)]


def test_pieces_are_given_back_by_size():
    import pyarrow as pa

    texts = ["word. " * 20_000] * 100 + ["a b " * 1000]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts)), pa.int64()), pa.array(texts)], names=["k", "_body"])
    got = list(chunking.pieces(iter([batch]), 2000, 200, ["k", "n", "id", "a", "b", "t"]))
    assert len(got) > 5 and max(b.column(5).nbytes for b in got) < 2 * chunking.PIECE_BYTES
    rows = [r for b in got for r in zip(*b.to_pydict().values())]
    assert rows == [(k, n + 1, f"{k}:chunk-{n + 1}", a, b, t[a:b].strip()) for k, t in enumerate(texts) for n, (a, b) in enumerate(chunking.cut_points(t, 2000, 200))]


def test_best_title_is_that_of_all_pairs(spark):
    import random
    from difflib import SequenceMatcher

    rng = random.Random(7)
    word = lambda: "".join(rng.choice("abcdeé𝔸") for _ in range(rng.randint(1, 6)))
    titles = [" ".join(word() for _ in range(rng.randint(1, 5))) for _ in range(60)] + ["x" * 300]
    asked = [t.upper() + " b" for t in titles[::4]] + ["x" * 290, "zzz", "  "]
    for q in asked[:5]:
        for t in titles:
            low = resolve.ratio_bounds(q, resolve.letter_counts([q])[0], resolve.np.array([len(t)]), resolve.letter_counts([t]))[0]
            assert low >= SequenceMatcher(None, t, q).ratio()
    rows = [(i, t) for i, t in enumerate(titles * 3)]
    got = resolve.best_title(spark.createDataFrame(list(enumerate(asked)), "query_id int, title string"), spark.createDataFrame(rows, "seq bigint, title string"), block=5)
    want = {}
    for k, q in enumerate(asked):
        ratios = [(SequenceMatcher(None, " ".join(t.lower().split()), " ".join(q.lower().split())).ratio(), -i) for i, t in rows]
        if max(ratios)[0] >= 0.6:
            want[k] = (max(ratios)[0], -max(ratios)[1])
    assert {r.query_id: (r.similarity, r.seq) for r in got.collect()} == want

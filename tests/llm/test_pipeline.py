"""The pipeline's stages on a small corpus, each on its predecessor's rows."""

import random

import corpus_pipeline
from saltmarsh.llm import queries


def test_stages(spark, tmp_path):
    rng = random.Random(8)
    words = lambda n: [rng.choice("alpha beta gamma delta epsilon zeta eta theta".split()) + str(rng.randrange(50)) for _ in range(n)]
    rows, labels = [], []
    for i in range(120):
        w = words(80)
        if i % 5 == 0:
            w = [f"{x}%%%" for x in w]
        rows.append((i, " ".join(w), "en", f"s{i % 3}", 1))
        labels.append((i, int(i % 5 != 0), 0))
    rows += [(200, rows[1][1], "en", "s0", 1), (201, rows[2][1] + " end", "en", "s0", 1)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").coalesce(2).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    assert 4 <= len(corpus_pipeline.STAGES) <= 5
    docs, kept = spark.read.parquet(str(tmp_path / "documents.parquet")), []
    columns = docs.columns
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        docs = stage(spark, docs, str(tmp_path))
        path = str(tmp_path / f"stage{i}")
        docs.write.parquet(path)
        docs = spark.read.parquet(path)
        if i < len(corpus_pipeline.STAGES) - 1:
            assert docs.columns == columns
        kept.append([r.doc_id for r in docs.select("doc_id").collect()])
    good = {i for i in range(120) if i % 5}
    assert set(kept[0]) == good | {200, 201}
    assert 1 not in kept[1] and 200 in kept[1]
    assert set(kept[2]) == set(kept[1]) - {201}
    assert set(kept[3]) <= set(kept[2]) and len(kept[4]) == len(kept[3])
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == len(kept[4])


def test_names():
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 11))
    assert set(queries.ORACLE_SQL) <= set(queries.QUERIES)

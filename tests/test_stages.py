"""Lookups, calls, caches, summaries, settings on small tables."""

import pytest
from pyspark.sql import functions as F

from saltmarsh import settings, storage
from saltmarsh.operators import analysis, calls, fulltext
from saltmarsh.sources import cache, files, harvest, names


def service(kind, value):
    if kind == "name":
        return {"IdentifierList": {"CID": [5, 6]}} if value in ("alpha", "butylated hydroxytoluene", "gammas") else None
    if kind == "complete":
        if value == "broken":
            raise ValueError("not JSON")
        return {"IdentifierList": {"CID": [8]}} if value == "beta thing" else {}
    if kind == "suggest":
        return {"dictionary_terms": {"compound": ["unlike", "gammas"]}}
    return {"PropertyTable": {"Properties": [{"Title": "gammas", "SMILES": "CC"}]}} if value != "5" else None


def test_lookups(spark):
    asked = spark.createDataFrame([("alpha",), ("BHT",), ("beta thing",), ("gamma",), ("broken",), (" ",), (None,)], "input_name string").withColumn("normalized_name", F.lower("input_name"))
    got = {r.input_name: r for r in names.lookup_names(asked, service, 0.0, sleep=lambda s: None).collect()}
    assert {k: (r.lookup_status, r.strategy, r.cid) for k, r in got.items()} == {
        "alpha": ("resolved", "exact", "6"), "BHT": ("resolved", "abbreviation", "6"), "beta thing": ("resolved", "synonym", "8"),
        "gamma": ("resolved", "autocomplete", "6"), "broken": ("not_found", "none", "NOT FOUND"), " ": ("invalid_name", "none", "NOT FOUND"), None: ("invalid_name", "none", "NOT FOUND"),
    }
    assert got["alpha"].api_calls == 3 and got["alpha"].iupac_name == "NOT FOUND" and got["gamma"].pubchem_canonical_smiles == "CC"
    assert names.lookup_names(asked.limit(0), service).count() == 0


def test_calls(spark):
    rows = spark.createDataFrame([("a",), ("fails",), (None,)], "chunk_text string")
    prompted = calls.with_extraction_prompt(rows, 'x {{"y": 1}} {text}!')
    assert [r.prompt for r in prompted.collect()] == ['x {"y": 1} a!', 'x {"y": 1} fails!', 'x {"y": 1} !']
    called = calls.with_calls(rows, lambda p: None if p == "fails" else p.upper(), prompt="chunk_text", sleep=lambda s: None)
    assert [(r.answer, r.succeeded, r.attempts) for r in called.collect()] == [("A", True, 1), (None, False, 3), (None, False, 0)]
    stats = calls.call_stats(called).first()
    assert (stats.chunks, stats.successes, stats.failures) == (3, 1, 2)
    assert calls.call_stats(called.limit(0)).first().avg_seconds_per_chunk == 0.0
    assert calls.extraction_options(8192, False)["num_ctx"] == 8192 and "think" not in calls.extraction_options()


def test_readiness():
    tries = []

    def models(host):
        tries.append(host)
        if host == "down" or len(tries) < 3:
            raise OSError("not up")
        return ["m"]

    now = iter(range(0, 1000, 10))
    assert calls.ready_hosts(["up", "down"], models, 60, 3, clock=lambda: next(now), sleep=lambda s: None) == ["up"]
    pulled = []
    assert calls.ensure_model("h", "m", models, lambda h, m: pulled.append(m)) and not pulled
    assert calls.ensure_model("h", "other", models, lambda h, m: pulled.append(m)) and pulled == ["other"]
    assert not calls.ensure_model("down", "m", models, lambda h, m: None)


def test_cache(spark, tmp_path):
    records = spark.createDataFrame([("p1", "a"), ("p2", None)], "paper_id string, text string")
    cache.write_cache(records, str(tmp_path / "cache"))
    assert sorted(r.paper_id for r in cache.read_cache(spark, str(tmp_path / "cache")).collect()) == ["p1", "p2"]
    got = cache.with_cached(spark.createDataFrame([("p1",), ("p3",)], "paper_id string"), records).collect()
    assert {r.paper_id: r.cached and r.cached.text for r in got} == {"p1": "a", "p3": None}
    (tmp_path / "files").mkdir()
    for name, body in (("b.json", '{"paper_id": "b"}'), ("a.json", '{"paper_id": "a"}'), ("bad.json", "{"), ("list.json", "[1]"), ("other.txt", "{}")):
        (tmp_path / "files" / name).write_text(body)
    folder = str(tmp_path / "files")
    assert [(r.file_name, r.paper_id) for r in cache.read_cache_files(spark, folder, "paper_id string").orderBy("file_name").collect()] == [("a.json", "a"), ("b.json", "b")]
    warnings = cache.unreadable(spark, folder)
    assert sorted(r.file for r in warnings.collect()) == ["bad.json", "list.json"]
    assert cache.manifest(records, warnings, folder).first().asDict() == {"papers_cached": 2, "warnings": 2, "chunks_dir": folder}


def test_papers_of_several_files(spark, tmp_path):
    for name in ("one file", "two"):
        (tmp_path / f"{name}.json").write_text('{"papers": [{"doi": "%s"}, {"doi": "x"}]}' % name)
    got = files.read_papers(spark, str(tmp_path), "doi string").collect()
    assert len(got) == 4 and len({r.seq for r in got}) == 4
    assert [r.doi for r in sorted(got)] == ["one file", "x", "two", "x"]


def test_fallback_url(spark):
    papers = spark.createDataFrame([("a",), ("b",), ("c",), (None,)], "doi string")
    hits = spark.createDataFrame([("a", "h", "pdf", "core"), ("b", "h", "xml", "core")], "doi string, url string, format string, source string")
    old = spark.createDataFrame([("a", "o", "pdf", "x", 1), ("b", "o", "pdf", None, 1), ("c", "o", "pdf", "x", 1), ("c", "n", "html", "x", 2)], "doi string, url string, format string, source string, seq int")
    got = {r.doi: (r.url, r.source) for r in fulltext.with_fallback_url(papers, hits, old).collect()}
    assert got == {"a": ("h", "core"), "b": ("o", "resolved_pdf"), "c": (None, None), None: (None, None)}


def test_unique_structures(spark):
    rows = spark.createDataFrame([(2, "c1ccccc1O"), (1, "Oc1ccccc1"), (3, "bad("), (4, None)], "seq int, smiles string")
    got = analysis.unique_structures(rows).collect()
    assert [(r.seq, r.heavy_atoms) for r in got] == [(1, 7)]


def test_abstract_bearing_papers(spark):
    rows = spark.createDataFrame([("d", "t", "a", "7.9"), ("d", "t", " ", "7"), ("d", "t", "a", "x"), ("d", "t", "a", None)], "doi string, title string, abstract string, relevance_score string")
    assert [r.relevance_score for r in analysis.papers_with_abstracts(rows).collect()] == [7]
    assert analysis.papers_with_abstracts(rows.union(rows), most=1).count() == 1


def test_outputs(spark, tmp_path):
    (tmp_path / "plot_stats.json").write_text("{}")
    assert files.clear_outputs(spark, str(tmp_path), ["plot_stats.json", "embedding_points.csv"]) == ["plot_stats.json"]
    made = []

    def make():
        made.append(1)
        return spark.createDataFrame([(len(made),)], "n int")

    path = str(tmp_path / "stats")
    assert [files.stored_or_made(spark, path, make, refresh=r).first().n for r in (False, False, True)] == [1, 1, 2]


def test_settings():
    s = settings.Settings.of_environment({"LLM_MODEL": "m", "LLM_NUM_CTX": "32768", "LLM_THINK": "off", "CHUNK_CHARS": " "})
    assert (s.llm_model, s.llm_num_ctx, s.llm_think, s.chunk_chars) == ("m", 32768, False, 10_000)
    args = settings.parser().parse_args(["score", "--threshold", "7", "--resume", "--model", "n"])
    assert args.resume and s.with_flags(args).threshold == 7 and s.with_flags(args).llm_model == "n"
    with pytest.raises(SystemExit):
        settings.parser().parse_args(["peek", "--unknown"])


def test_one_task_a_source():
    plan = [{"source": "core", "intent": "a", "query": 1}, {"source": "lens", "intent": "a", "query": 1}, {"source": "core", "intent": "b", "query": 2}]
    reader = harvest.HarvestReader({"plan": __import__("json").dumps(plan), "transport": "x:y"})
    assert [(p.source, [i for i, _ in p.intents]) for p in reader.partitions()] == [("core", ["a", "b"]), ("lens", ["a"])]


def test_spread(spark, tmp_path, monkeypatch):
    spark.range(100).write.parquet(str(tmp_path / "t"))
    rows = spark.read.parquet(str(tmp_path / "t"))
    assert "Repartition" in storage.spread(rows, "id")._jdf.queryExecution().logical().toString()
    monkeypatch.setattr(storage, "SPREAD_BYTES", 0)
    assert storage.spread(rows, "id") is rows

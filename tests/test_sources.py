"""Payloads, markup, locators, harvesting, downloads, files, streams."""

import json

from pyspark.sql import functions as F

from saltmarsh.sources import fetch, files, harvest, locators, markup, payloads
from saltmarsh.streaming import resume


def one(spark, source, payload):
    df = spark.createDataFrame([(payload,)], "payload string")
    return payloads.raw_papers(df, source).first()


def test_openalex(spark):
    r = one(spark, "openalex", json.dumps({"doi": "https://doi.org/10.1/x", "title": "T", "abstract_inverted_index": {"b": [1], "a": [0, 2]}, "publication_year": 2001, "keywords": [{"display_name": "k"}], "concepts": [{"display_name": "c", "score": 0.4}, {"display_name": "d", "score": 0.3}], "authorships": [{"author": {"display_name": "A"}}, {"author": {}}], "open_access": {"is_oa": True}}))
    assert (r.doi, r.abstract, r.keywords, r.authors, r.open_access, r.source_api) == ("10.1/x", "a b a", ["k", "c"], ["A"], True, "openalex")


def test_crossref(spark):
    r = one(spark, "crossref", json.dumps({"DOI": "10.1/x", "title": ["T"], "abstract": "<p>A</p>", "published-print": {"date-parts": [[1999, 2]]}, "author": [{"given": "G", "family": "F"}, {"family": "H"}], "container-title": ["J"], "is-referenced-by-count": 3}))
    assert (r.title, r.abstract, r.year, r.authors, r.journal, r.citation_count) == ("T", "A", 1999, ["G F", "H"], "J", 3)


def test_others(spark):
    assert one(spark, "europe_pmc", json.dumps({"authorString": "A, B,", "pubYear": "20x", "isOpenAccess": "Y"})).asDict()["authors"] == ["A", "B"]
    assert one(spark, "core", json.dumps({"identifiers": ["x", "https://doi.org/10.2/y"]})).doi == "10.2/y"
    assert one(spark, "lens", json.dumps({"external_ids": [{"type": "doi", "value": "10.3/z"}], "authors": [{"first_name": "A", "last_name": "B"}]})).authors == ["A B"]
    assert one(spark, "semantic_scholar", json.dumps({"externalIds": {"DOI": "d", "PubMed": "5"}, "authors": []})).pmid == "5"
    xml = "<PubmedArticle><PMID>7</PMID><ArticleTitle>T</ArticleTitle><AbstractText>a</AbstractText><AbstractText>b</AbstractText><PubDate><Year>2003</Year></PubDate><Author><LastName>L</LastName><ForeName>F</ForeName></Author><Journal><Title>J</Title></Journal><ArticleId IdType='doi'>10.4/w</ArticleId></PubmedArticle>"
    r = one(spark, "pubmed", xml)
    assert (r.doi, r.title, r.abstract, r.year, r.authors, r.journal, r.pmid) == ("10.4/w", "T", "a b", 2003, ["F L"], "J", "7")


def test_markup(spark):
    text = "A sentence of the body. " * 20
    page = f"<html><head><title>No</title><meta name='citation_title' content='Yes'></head><body><nav>menu</nav><article><p>{text}<br>more<script>x()</script></article></body>".encode()
    jats = f"<article><front><article-title>T</article-title><abstract><p>{'a' * 130}</p></abstract></front><body><sec><title>H</title><p>{text}</p></sec></body></article>".encode()
    rows = [("a.html", page), ("b.xml", jats), ("c", b"<?xml version='1.0'?><r><title>G</title><x>" + text.encode() + b"</x>"), ("d.bin", b"?"), ("e.html", b""), ("f.xml", None)]
    got = {r.path: r for r in markup.extracted(spark.createDataFrame(rows, "path string, content binary")).collect()}
    assert got["a.html"].title == "Yes" and "menu" not in got["a.html"].full_text and "x()" not in got["a.html"].full_text
    assert got["b.xml"].full_text.startswith("## H\nA sentence") and got["b.xml"].sections[0].heading == "H"
    assert got["c"].title == "" and got["c"].format == "xml"  # read as an article without its parts
    assert markup.other_xml(rows[2][1])["title"] == "G"
    assert got["d.bin"].error and got["e.html"].error and got["f.xml"].error
    assert markup.extracted(spark.createDataFrame(rows, "path string, content binary"), strict=True).filter("error LIKE 'ValueError%'").count() == 4


def test_locators(spark):
    rows = [("a", "pmc_xml", '{"pmcid": "123"}'), ("b", "unpaywall", json.dumps({"oa_locations": [{"url": "x", "url_for_pdf": "u.pdf"}]})), ("c", "crossref_link", json.dumps({"message": {"link": [{"URL": "u", "content-type": "application/pdf"}, {"URL": "v.xml", "content-type": "unspecified"}]}})), ("d", "core", "{}")]
    got = {r.doi: (r.format, r.source) for r in locators.locations(spark.createDataFrame(rows, "doi string, locator string, answer string")).collect()}
    assert got == {"a": ("xml", "pmc_xml"), "b": ("pdf", "unpaywall"), "c": ("xml", "crossref_link")}


def transport(source, request):
    if source == "lens":
        raise OSError("down")
    n = int(request["cursor"]) if request.get("cursor", "*") != "*" else 0
    return {"results": [{"title": f"t{n}"}], "meta": {"next_cursor": str(n + 1) if n < 2 else None}} if source == "openalex" else {"results": []}


def test_harvest():
    walked = list(harvest.pages("openalex", "q", transport, sleep=lambda s: None))
    assert [p[0]["title"] for p in walked] == ["t0", "t1", "t2"]
    assert list(harvest.pages("core", "q", transport, sleep=lambda s: None)) == []
    reader = harvest.HarvestReader({"plan": json.dumps([{"source": "openalex", "intent": "i", "query": "q"}, {"source": "lens", "intent": "i", "query": "q"}]), "transport": f"{__name__}:transport", "keys": '{"lens": "k"}'})
    rows = [r for p in reader.partitions() for r in reader.read(p)]
    assert [r[5] for r in rows] == ["ok", "ok", "ok", "failed: lens: no answer"]


def test_fetch(spark):
    def fetcher(url):
        if url.endswith("gone"):
            return 404, url, b""
        if url.endswith("small"):
            return 200, url, b"tiny"
        return 200, url, b"%PDF-1.4" + b"x" * 200

    urls = spark.createDataFrame([("a", "http://h/x", "html"), ("b", "http://h/gone", "pdf"), ("c", "http://g/small", "html")], "doi string, url string, format string")
    got = {r.doi: r for r in fetch.fetched(urls, fetcher, delay=0.0, sleep=lambda s: None).collect()}
    assert got["a"].format == "pdf" and got["a"].error is None
    assert got["b"].error == "404" and got["c"].error == "small or error body" and got["c"].content is None


def test_files(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"papers": [{"doi": "x"}, {"doi": "y"}]}')
    (tmp_path / "b.json").write_text('[{"doi": "z"}]')
    assert sorted(r.doi for r in files.read_papers(spark, str(tmp_path / "*.json"), "doi string").collect()) == ["x", "y", "z"]
    rows = spark.createDataFrame([("a\x07b", 1), ('say "x"', 2)], "t string, n int")
    files.write_csv(rows, str(tmp_path / "out"))
    assert sorted(r.t for r in files.read_csv(spark, str(tmp_path / "out")).collect()) == ["ab", 'say "x"']


def test_upserts(spark, tmp_path):
    (tmp_path / "in").mkdir()
    run = lambda: resume.upsert_stream(spark.readStream.schema("k string, seq int, v string").json(str(tmp_path / "in")), str(tmp_path / "t"), str(tmp_path / "c"), "k", "seq").awaitTermination()
    (tmp_path / "in" / "1.json").write_text('{"k": "a", "seq": 1, "v": "old"}\n{"k": "b", "seq": 1, "v": "b"}\n')
    run()
    (tmp_path / "in" / "2.json").write_text('{"k": "a", "seq": 2, "v": "new"}\n')
    run()
    got = resume.current(spark, str(tmp_path / "t"), "k", "seq")
    assert sorted((r.k, r.v) for r in got.collect()) == [("a", "new"), ("b", "b")]
    assert resume.retryable(got.withColumn("status", F.lit("failed")), "k").count() == 2


def test_an_index_is_made_within_its_row(spark):
    texts = ["b a b", "", " ", "a  a ", None, "x", "é ß é z"]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, text string")
    made = df.select("i", payloads.inverted_index("text").alias("m"))
    own = made.select("i", "m", payloads.inverted_text("m").alias("t"))
    assert "Exchange" not in own._jdf.queryExecution().executedPlan().toString()
    for r in own.collect():
        words = None if texts[r.i] is None else texts[r.i].split(" ")
        assert r.t == texts[r.i] and r.m == (words and {w: [k for k, x in enumerate(words) if x == w] for w in words})

"""Merging against a record-by-record merge in Python."""

import random

from saltmarsh import schemas
from saltmarsh.functions.values import ABSTRACT_PRIORITY
from saltmarsh.operators import merge


def by_hand(records):
    out, best = dict(records[0]), records[0]["source_api"]
    for r in records[1:]:
        if r["abstract"] and (not out["abstract"] or ABSTRACT_PRIORITY.get(r["source_api"], 0) > ABSTRACT_PRIORITY.get(best, 0)):
            out["abstract"], best = r["abstract"], r["source_api"]
        for f in ("doi", "year", "journal", "pmid"):
            out[f] = out[f] or r[f]
        out["keywords"] = sorted({k for k in (out["keywords"] or []) + (r["keywords"] or []) if k})
        if len(r["authors"] or []) > len(out["authors"] or []):
            out["authors"] = r["authors"]
        if r["citation_count"] is not None:
            out["citation_count"] = max(out["citation_count"] or 0, r["citation_count"])
        if out["open_access"] is None:
            out["open_access"] = r["open_access"]
    out["source_apis"] = sorted({r["source_api"] for r in records})
    return out


def test_fields_equal_a_sequential_merge(spark):
    rng, rows = random.Random(3), []
    for i in range(400):
        rows.append({"seq": i, "doi": f"10.1/{rng.randrange(90)}", "title": rng.choice([None, "A title long enough", "x"]), "abstract": rng.choice([None, "", "abc", f"text {i}"]), "year": rng.choice([None, 0, 2000 + i % 9]), "keywords": rng.choice([None, [], ["b", "a"], ["c"]]), "authors": [f"a{j}" for j in range(rng.randrange(3))], "journal": rng.choice([None, "", "J"]), "citation_count": rng.choice([None, i]), "open_access": rng.choice([None, True, False]), "pmid": rng.choice([None, str(i)]), "source_api": rng.choice(list(ABSTRACT_PRIORITY))})
    df = spark.createDataFrame([tuple(r.values()) for r in rows], schemas.RAW_PAPER)
    got = {r["doi"]: r.asDict() for r in merge.deduplicate(df.repartition(3)).collect()}
    groups = {}
    for r in rows:
        groups.setdefault(r["doi"], []).append(r)
    assert len(got) == len(groups)
    for doi, records in groups.items():
        want = by_hand(records)
        for f in ("title", "year", "journal", "pmid", "keywords", "authors", "citation_count", "open_access", "source_apis"):
            a, b = got[doi][f], want[f]
            if f in ("year", "journal", "pmid"):
                a, b = a or None, b or None
            assert a == b, (f, doi, a, b)
        assert (got[doi]["abstract"] or None) == (want["abstract"] or None)


def test_title_keys_and_compat(spark):
    long = "a common beginning of a title that goes on for more than eighty characters in all, part "
    rows = [(0, None, long + "one"), (1, None, long + "two"), (2, "10.1/x", long + "one"), (3, None, "short"), (4, None, None)]
    df = spark.createDataFrame([(s, d, t, None, None, None, None, None, None, None, None, "core") for s, d, t in rows], schemas.RAW_PAPER)
    assert merge.deduplicate(df).count() == 5
    assert merge.deduplicate(df, compat=True).count() == 4
    assert merge.deduplicate(df.limit(0)).count() == 0


def test_merging_again_changes_nothing(spark):
    df = spark.createDataFrame([(i, f"10.1/{i % 3}", "A title long enough", None, 2000, ["k"], ["a"], "J", i, True, None, "core") for i in range(9)], schemas.RAW_PAPER)
    once = merge.deduplicate(df)
    again = merge.deduplicate(once.drop("n_records").withColumn("source_api", once.source_apis[0]))
    assert sorted(r.doi for r in once.collect()) == sorted(r.doi for r in again.collect())

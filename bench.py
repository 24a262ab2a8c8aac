"""Headline queries timed at one scale: prints one JSON line."""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import SparkSession

from saltmarsh.plans import catalog

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
HEADLINE = ["a01_deduplicate_papers", "n01_parse_scores", "a14_score_distribution", "x15_classify_extractions", "a19_best_candidate", "j18_first_location", "j07_match_metadata", "x11_chunks", "s27_pages", "n02_parse_compounds", "a21_merge_compounds", "j20_resolve_names", "a25_master_rows", "a26_link_rows", "a29_fold_structures", "j13_curation_audit", "a38_candidates", "a36_histogram", "f09_without_outliers", "s13_last_record_wins", "p11_bibtex", "t11_query_plan"]


def main() -> None:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.driver.memory", "16g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    spark.range(1000).selectExpr("sum(id)").collect()  # starts the executors' code
    took: dict[str, float] = {}
    for name in HEADLINE:
        began = time.time()
        catalog.QUERIES[name](spark, SF_DIR).write.format("noop").mode("overwrite").save()
        took[name] = round(time.time() - began, 3)
    print(json.dumps({"metric": "headline queries", "value": round(sum(took.values()), 3), "unit": "sec", "queries": took, "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf")}))
    spark.stop()


if __name__ == "__main__":
    main()

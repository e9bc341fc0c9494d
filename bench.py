"""Headline queries at ``$BENCH_SF_DIR``: one JSON line with the warm median of each, and the index
build timed once, cold. The value is their sum."""

from __future__ import annotations

import json
import os
import statistics
import time

from catalograph.session import build_session
from workload import load, tables

HEADLINE = (
    "catalog_build", "catalog_enrich", "merge_entities", "collect_in_order", "top_n_per_group",
    "top_k_global", "join_year_tolerance", "join_lookup", "dedup_last_wins", "facet_terms",
    "clean_text", "truncate_words", "analyze_title", "analyze_general_stemmed",
    "search_field", "search_weighted", "search_phrase_boost", "search_faceted", "boolean_terms",
    "result_page", "highlight_fragment", "more_like_this", "more_like_this_batch",
    "autocomplete", "paginate", "page_links", "page_body", "page_details", "review_document")


def run(build, spark, sf_dir: str) -> float:
    """Whole result, no row sent to the driver."""
    start = time.perf_counter()
    build(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeats = int(os.environ.get("BENCH_REPEATS", "2"))
    names = os.environ.get("BENCH_QUERIES", "").split() or HEADLINE
    spark = build_session(f"local[{cpus}]", cpus, os.environ.get("BENCH_MEMORY", "16g"), "bench")
    spark.sparkContext.setLogLevel("ERROR")
    queries, _ = load()
    times: dict[str, float] = {}
    start = time.perf_counter()
    tables.index(spark, sf_dir)
    times["index_build"] = time.perf_counter() - start
    for name in names:
        run(queries[name], spark, sf_dir)
        times[name] = statistics.median(run(queries[name], spark, sf_dir) for _ in range(repeats))
    times = {name: round(seconds, 3) for name, seconds in times.items()}
    print(json.dumps({"metric": "cold_index_build_plus_warm_median_seconds", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": os.path.basename(sf_dir.rstrip("/"))}))
    spark.stop()


if __name__ == "__main__":
    main()

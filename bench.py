"""Times the headline queries and prints one JSON line.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py
"""

from __future__ import annotations

import json
import os
import re
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from emberlog import get_session  # noqa: E402
from emberlog.plans import QUERIES  # noqa: E402

HEADLINE = (
    # search, filters and the export itself
    "export_errors topk search_term search_phrase search_bool search_range search_wildcard search_bare "
    "time_range entity_filters query_time_filters "
    # clauses
    "dsl_match dsl_match_and dsl_match_phrase dsl_bool dsl_bool_should dsl_range dsl_regexp dsl_fuzzy dsl_nested "
    "dsl_has_child dsl_has_parent dsl_percolate dsl_more_like_this dsl_function_score "
    # aggregations, order and samples
    "agg_terms agg_stats agg_cardinality agg_percentiles agg_histogram agg_date_histogram agg_range agg_sub_terms "
    "sort_default scan_limit_large scan_limit_bulk sample_per_index sample_with_total "
    # reshaping, profiling, sinks
    "canonical_coalesce envelope view_otel view_combined normalize_time classify_severity infer_mapping "
    "fields_catalogue inspect entity_mapping sink_json import_array import_bundle stream_search"
).split()


def run(build, spark, sf_dir: str) -> float:
    started = time.perf_counter()
    build(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - started


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = get_session(
        "bench", f"local[{cpus}]", spark__sql__shuffle__partitions=cpus, spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in HEADLINE:
        # The first run loads classes and compiles; the better of the next two counts.
        run(QUERIES[name], spark, sf_dir)
        seconds[name] = round(min(run(QUERIES[name], spark, sf_dir) for _ in range(2)), 4)
    result = {
        "metric": "headline_queries_total",
        "value": round(sum(seconds.values()), 4),
        "unit": "sec",
        "queries": seconds,
        "sf": float(re.sub(r"[^0-9.]", "", Path(sf_dir).name) or 0),
    }
    spark.stop()
    print(json.dumps(result), flush=True)


if __name__ == "__main__":
    main()

"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

    python bench.py [query …]
"""

from __future__ import annotations

import json
import os
import sys
import time

from graphweft.plans import QUERIES
from graphweft.session import build_session

HEADLINE = [
    "c08_top_k", "b05_multi_hop", "b06_shared_variable", "b07_optional_match", "b08_varlen_path", "b11_not_exists_pattern",
    "b27_pattern_comprehension", "c10_unwind", "d03_merge_nodes", "d04_merge_edges", "e05_percentiles", "e07_mode", "e09_quartiles",
    "f11_math", "f16_strfilter", "f24_durations", "g01_pagerank", "g04_label_propagation", "g07_degree_supply", "g11_triangles", "g12_wcc_chain",
    "g13_scc", "g14_single_source", "g20_knn", "h13_knn_l2", "h18_knn_join", "h21_rescore_bit", "h23_ivf_assign", "h24_ivf_search",
    "i01_diff", "i04_patch", "j01_nextval", "k01_change_feed",
]


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(cpus, int(cpus) if cpus.isdigit() else 8, "16g")
    spark.sparkContext.setLogLevel("ERROR")
    QUERIES["c02_return_distinct"](spark, sf).write.format("noop").mode("overwrite").save()  # start the JVM's engine once
    times = {}
    for name in sys.argv[1:] or HEADLINE:
        started = time.perf_counter()
        QUERIES[name](spark, sf).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - started, 3)
    print(json.dumps({"metric": "headline queries, total", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times, "sf": sf.rsplit("sf", 1)[-1]}))
    spark.stop()


if __name__ == "__main__":
    main()

"""Time the headline queries and print one JSON line.

BENCH_SF_DIR names the data folder, BENCH_CPUS the number of local cores. Every
query is run to its last row into the no-op sink; the better of two runs counts.
BENCH_QUERIES (comma-separated, or ``all``) picks other queries.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

from logtide import plans
from logtide.session import build_session

HEADLINE = [
    "media_traffic_minute", "dir_traffic_minute", "pno_traffic_5min",
    "parse_media_log", "parse_access_log", "parse_counter_csv", "reshape_firewall_log", "parse_json_request",
    "attach_userid", "domain_semi_join", "ip_to_company", "offset_range_fetch",
    "check_offset_bounds", "rating_prediction_join", "mean_squared_error",
    "dense_index", "rank_per_user", "top_k_per_key", "global_sort",
    "term_frequency", "idf", "tfidf_vectors", "score_query",
    "als_predict", "rank_all_items", "similar_items", "kmeans_assign_cost", "linear_sgd",
    "hour_keyed_archive", "reconcile_delivery", "stream_media_traffic", "stream_relay",
    "als_evaluate", "recommend_top_n", "kmeans_train", "stream_hourly_table", "csv_line_sink",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    asked = os.environ.get("BENCH_QUERIES", "")
    queries = plans.queries()
    names = list(queries) if asked == "all" else asked.split(",") if asked else HEADLINE
    spark = build_session(
        "bench", f"local[{cpus}]",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__sql__shuffle__partitions=cpus,
        spark__driver__memory="16g",
    )
    spark.sparkContext.setLogLevel("ERROR")

    def run(name: str) -> float:
        began = time.perf_counter()
        queries[name](spark, folder).write.format("noop").mode("overwrite").save()
        spent = time.perf_counter() - began
        spark.catalog.clearCache()
        return spent

    run("media_traffic_minute")
    times = {}
    for name in names:
        times[name] = round(min(run(name), run(name)), 3)
        print(name, times[name], file=sys.stderr, flush=True)
    found = re.search(r"sf([0-9.]+)$", folder)
    print(json.dumps({
        "metric": "headline_queries_total",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(found.group(1)) if found else folder,
    }))


if __name__ == "__main__":
    main()

"""Time the headline queries and print one JSON line.

Reads $BENCH_SF_DIR (default /root/testdata/sf0.1) on local[$BENCH_CPUS].
Every query is computed in full: all rows and columns go to Spark's no-op sink.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from plantflow.plans import catalog  # noqa: E402
from plantflow.session import build_session  # noqa: E402

HEADLINE = [
    "sensor_clean",
    "sensor_ledger",
    "shift_aggregate",
    "asof_history",
    "order_history",
    "event_history_features",
    "feature_table",
    "correlation_matrix",
    "lineitem_summary",
    "tuned_evaluation",
    "sequences",
    "latest_window",
    "stratified_split",
    "linear_contributions",
    "tfidf",
    "page_chunks",
    "retrieve_evidence",
    "dense_search",
    "neutralisation_importance",
    "scenario_table",
    "decision_rules",
    "stream_shift_aggregate",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        spark__ui__enabled="false",
        spark__sql__shuffle__partitions=cpus,
        spark__driver__memory=os.environ.get("BENCH_MEMORY", "16g"),
    )
    spark.sparkContext.setLogLevel("ERROR")
    catalog.QUERIES["timestamp_parse"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    times = {}
    for name in names:
        start = time.perf_counter()
        catalog.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
        print(f"{name} {times[name]}", file=sys.stderr, flush=True)
    result = {
        "metric": "headline_queries_total",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }
    print(json.dumps(result))
    spark.stop()


if __name__ == "__main__":
    main()

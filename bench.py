"""Time the headline queries and print one JSON line.

BENCH_SF_DIR is the folder of the test tables, BENCH_CPUS the number of cores.
Every query is run to its last row into a sink that keeps nothing.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

import registry  # noqa: E402
from tidewatch.session import local_session  # noqa: E402

HEADLINE = [
    "logs_by_table",
    "eda_summary",
    "eda_box_stats",
    "log_features",
    "split_stratified",
    "fct_server_health",
    "synthetic_logs",
    "delivery_enriched",
    "delivery_summary",
    "fct_delivery_by_state",
    "sentiment_by_star",
    "category_join",
    "category_stats",
    "dim_category_sentiment",
    "review_requests",
    "provider_parse",
    "provider_classify",
    "dq_column_tests",
    "dq_contract_report",
    "export_roundtrip",
    "clean_logs",
    "gbt_scorecard",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cores, "bench")
    queries = registry.queries()
    queries["logs_by_table"](spark, folder).collect()  # starts the engine
    seconds = {}
    for name in HEADLINE:
        start = time.perf_counter()
        queries[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    spark.stop()
    scale = folder.rstrip("/").rsplit("sf", 1)[-1]
    result = {
        "metric": "headline queries, total wall time",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": float(scale),
    }
    print(json.dumps(result))


if __name__ == "__main__":
    main()

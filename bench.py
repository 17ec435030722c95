"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line."""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from eddyline.plans.event_queries import QUERIES
from eddyline.plans.stream_queries import STREAM_QUERIES
from eddyline.session import build_session

HEADLINE = [
    "hot_items", "hot_urls", "sliding_count", "domain_traffic", "login_fail",
    "order_timeout_pattern", "order_lifecycle", "order_lifecycle_strict", "tx_match",
    "tx_match_repeated", "login_success_view", "sql_view", "parse_access_log", "parse_traffic_log",
]
RUNS = 3

#: Streams over the whole table, from start to the complete result, once each.
STREAMS = ["stream_domain_traffic", "stream_hot_items", "stream_order_lifecycle"]


def timed(spark, folder: str, name: str) -> float:
    start = time.perf_counter()
    {**QUERIES, **STREAM_QUERIES}[name](spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench", f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "8g"),
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    names = sys.argv[1:] or HEADLINE
    seconds = {}
    for name in names:
        timed(spark, folder, name)
        seconds[name] = round(statistics.median(timed(spark, folder, name) for _ in range(RUNS)), 3)
    streams = {name: round(timed(spark, folder, name), 3) for name in ([] if sys.argv[1:] else STREAMS)}
    scale = os.path.basename(folder.rstrip("/"))
    print(json.dumps({
        "metric": "sum of median query times, batch, after one warm-up",
        "value": round(sum(seconds.values()), 3), "unit": "sec", "queries": seconds, "sf": scale,
        "streams": streams,
    }), flush=True)
    spark.stop()


if __name__ == "__main__":
    main()

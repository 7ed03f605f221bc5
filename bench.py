"""Times the headline queries and prints one JSON line.

``BENCH_SF_DIR`` names the folder of the tables, ``BENCH_CPUS`` the number of
cores. Each query runs once to warm up and then twice; the mean of the two counts.
"""

from __future__ import annotations

import json
import os
import statistics
import time

from strikelens.plans.catalogue import QUERIES
from strikelens.runtime import build_session

HEADLINES = [
    "grouped_incidents",
    "yearly_totals",
    "rule_profile",
    "route_fanout",
    "clean_incidents",
    "canonical_id_sync",
    "multi_code",
    "normalize_summary",
    "latest_by_key",
    "tumbling_last",
    "windowed_last_sum",
    "json_roundtrip",
    "stream_grouped",
    "topn_per_year",
]
REPEATS = 2


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            # the tables have one row group each
            "strikelens.scan.partitions": cpus,
            "spark.ui.enabled": "false",
            "spark.driver.memory": "4g",
            "spark.python.sql.dataFrameDebugging.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")

    def seconds(name: str) -> float:
        start = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    timings = {}
    for name in HEADLINES:
        seconds(name)
        timings[name] = round(statistics.mean(seconds(name) for _ in range(REPEATS)), 3)
    scale = os.path.basename(folder.rstrip("/")).removeprefix("sf")
    total = round(sum(timings.values()), 3)
    print(json.dumps({"metric": "headline_queries_total", "value": total, "unit": "sec", "queries": timings, "sf": scale}))
    spark.stop()


if __name__ == "__main__":
    main()

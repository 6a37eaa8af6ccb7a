"""Time the headline queries; prints one JSON line.

Every query is run to the end with all its columns (noop sink): one warm-up,
then the median of BENCH_RUNS runs (default 3).
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from kilnmark.session import build_session  # noqa: E402
from kilnmark.suite.queries import QUERIES  # noqa: E402

HEADLINE = [
    "segment_averages",
    "segment_averages_cross_midnight",
    "running_avg",
    "running_avg_uneven_slide",
    "running_avg_wide",
    "merge_sensor_lab",
    "merge_latest_wins",
    "current_conditions_wide",
    "unpivot_meters",
    "parse_payload",
    "range_scan_past_24h",
    "batch_past_week",
    "current_row",
    "batch_series",
    "chronological_export",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = os.environ.get("BENCH_QUERIES", "").split(",") if os.environ.get("BENCH_QUERIES") else HEADLINE
    spark = build_session("kilnmark-bench", f"local[{cpus}]", **{
        "spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false", "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")

    def once(name: str) -> float:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    seconds = {}
    for name in names:
        once(name)
        seconds[name] = round(statistics.median(once(name) for _ in range(runs)), 3)
    spark.stop()
    print(json.dumps({
        "metric": "total seconds of the headline queries", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"), "runs": runs}))


if __name__ == "__main__":
    main()

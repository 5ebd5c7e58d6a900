"""Time the headline queries and print one JSON line.

Reads `BENCH_SF_DIR` on `local[BENCH_CPUS]`. Each query is planned and run in full once to warm up
and then `BENCH_RUNS` times; the median counts. Rows go to Spark's no-op sink, so every row and
column is computed. Bytes are those of one run.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from checks.compare import local_session  # noqa: E402
from checks.queries import queries  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "3"))
# After this many seconds queries run once after warming up, so that the line is always printed.
BUDGET = float(os.environ.get("BENCH_BUDGET_SEC", "600"))

HEADLINE = [
    "outage_part", "forecast_scan", "explode_forecast", "cell_features", "spatial_join", "weather_features",
    "outage_6h_qc", "county_thresholds", "outage_vs_weather", "outage_events", "event_coverage", "daily_plan",
    "lead_performance", "correlations", "training_data", "kpi_overview", "train_logistic",
]


def run(spark, name: str) -> float:
    start = time.perf_counter()
    queries()[name](spark, SF_DIR).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def stage_bytes(spark, seen: int) -> tuple[int, dict[str, int]]:
    """Shuffle and spill bytes of the stages since `seen`, from Spark's own status store."""
    gateway = spark.sparkContext._gateway
    store = spark.sparkContext._jsc.sc().statusStore()
    none = gateway.jvm.java.util.ArrayList()
    stages = store.stageList(none, False, False, gateway.new_array(gateway.jvm.double, 0), none)
    total = {"shuffle": 0, "spill": 0}
    last = seen
    for k in range(stages.size()):
        stage = stages.apply(k)
        if stage.stageId() <= seen:
            continue
        last = max(last, stage.stageId())
        total["shuffle"] += stage.shuffleWriteBytes()
        total["spill"] += stage.diskBytesSpilled()
    return last, total


def main() -> None:
    spark = local_session(CPUS, partitions=int(CPUS))
    names = sys.argv[1:] or HEADLINE
    began, seen = time.perf_counter(), -1
    seconds: dict[str, float] = {}
    sizes: dict[str, dict[str, int]] = {}
    for name in names:
        run(spark, name)
        try:
            seen, _ = stage_bytes(spark, seen)
        except Exception:  # noqa: BLE001 - sizes are extra; times are the point
            seen = None
        times = [run(spark, name)]
        if seen is not None:
            seen, sizes[name] = stage_bytes(spark, seen)
        while len(times) < RUNS and time.perf_counter() - began < BUDGET:
            times.append(run(spark, name))
        seconds[name] = round(statistics.median(times), 3)
        print(f"{name:22s} {seconds[name]:7.2f}s {sizes.get(name, '')}", file=sys.stderr, flush=True)
        if seen is not None:
            seen, _ = stage_bytes(spark, seen)
    print(json.dumps({
        "metric": "sum of median query seconds",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
        "bytes": sizes,
    }))


if __name__ == "__main__":
    main()

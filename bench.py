"""Benchmark of the headline queries.

Runs at $BENCH_SF_DIR (default /root/testdata/sf0.1) on local[$BENCH_CPUS] and
prints ONE JSON line: {"metric", "value", "unit", "queries", "sf", ...}.
Each query is fully executed (written to a no-op sink) 1 cold + 3 warm times;
the per-query figure is the median of the warm runs.
"""
from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from ridegrid import fixtures as fx  # noqa: E402
from ridegrid.operators import clean as C  # noqa: E402
from ridegrid.operators import metrics as M  # noqa: E402
from ridegrid.operators import series as S  # noqa: E402
from ridegrid.plans.monthly_job import run_month  # noqa: E402
from ridegrid.session import build_session, scratch_path  # noqa: E402
from ridegrid.sources import lake as L  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
CPUS = os.environ.get("BENCH_CPUS", "8")
WARM = int(os.environ.get("BENCH_RUNS", "3"))


def _run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    spark = build_session(master=f"local[{CPUS}]", shuffle_partitions=int(CPUS))
    raw_lake = scratch_path(spark, "bench-raw")
    L.write_partitioned(C.with_landing_month(fx.trips(spark, SF_DIR), 2024, 1), raw_lake)

    def monthly_job():
        out = scratch_path(spark, "bench-out")
        stats = run_month(spark, raw_lake, f"{out}/clean", f"{out}/demand", 2024, 1)
        _run(stats)

    def q(build):
        return lambda: _run(build())

    cases = {
        "clean_stats": q(lambda: C.clean_stats(fx.trips(spark, SF_DIR), 2024, 1)),
        "demand_filled": q(lambda: fx.demand(spark, SF_DIR)),
        "backfill_demand": q(lambda: S.backfill(fx.trips(spark, SF_DIR))),
        "forecast_metrics_by_location": q(lambda: M.forecast_metrics(
            M.actual_vs_predicted(*(lambda d: (d, fx.predictions_from_demand(d)))(
                fx.demand(spark, SF_DIR))), ["pickup_location_id"])),
        "monthly_job": monthly_job,
    }
    results = {}
    for name, fn in cases.items():
        fn()  # cold run: JIT, file listing caches
        times = []
        for _ in range(WARM):
            t0 = time.perf_counter()
            fn()
            times.append(time.perf_counter() - t0)
        results[name] = round(statistics.median(times), 3)
    m = re.search(r"sf([0-9.]+)", SF_DIR)
    print(json.dumps({
        "metric": "sum_of_median_query_sec",
        "value": round(sum(results.values()), 3),
        "unit": "sec",
        "queries": results,
        "sf": float(m.group(1)) if m else SF_DIR,
        "cpus": int(CPUS),
        "warm_runs": WARM,
    }))
    spark.stop()


if __name__ == "__main__":
    main()

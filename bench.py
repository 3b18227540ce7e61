"""Benchmark the settlement steps.

Runs each headline query over the whole tables at $BENCH_SF_DIR (default
/root/testdata/sf0.1) on local[$BENCH_CPUS], executing the full plan into
Spark's ``noop`` sink (no collect). $BENCH_WARMUP (default 2) warm-up runs
(the JVM needs a few runs to compile the generated code), then the median of
$BENCH_REPS (default 3) timed runs. Prints ONE JSON line: ``queries`` and their
sum; ``spread`` has the fastest and slowest run of each; ``stored_close_sec`` is
the whole close with every stage written once and read back (the way a close is
run), once after one warm-up.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from settlebook.plans import FIXTURE, close_period  # noqa: E402
from settlebook.queries import queries  # noqa: E402
from settlebook.session import build_session  # noqa: E402
from settlebook.sources import DriverTables, StageStore, settlement_inputs  # noqa: E402

HEADLINE = (
    "itemized_net_sales", "history_net_sales", "combined_net_sales", "merge_net_sales", "with_parent",
    "apply_payment_options", "payout_snapshot", "payout_buckets", "charge_snapshot", "charge_buckets",
    "balance", "multi_processor_events",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    reps = int(os.environ.get("BENCH_REPS", "3"))
    warmup = int(os.environ.get("BENCH_WARMUP", "2"))
    only = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]
    spark = build_session(f"local[{cpus}]", int(cpus), app_name="settlebook-bench",
                          extra={"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "16g")})
    qs = queries()
    timings, spread = {}, {}
    for name in only or HEADLINE:
        fn = qs[name]
        runs = []
        for i in range(warmup + reps):
            t0 = time.perf_counter()
            fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
            if i >= warmup:
                runs.append(time.perf_counter() - t0)
        timings[name] = round(statistics.median(runs), 3)
        spread[name] = [round(min(runs), 3), round(max(runs), 3)]
        if os.environ.get("BENCH_VERBOSE"):
            print(name, [round(r, 2) for r in runs], file=sys.stderr)
    stored = None
    if not only:
        x = settlement_inputs(DriverTables(spark, sf_dir))
        for _ in range(2):
            t0 = time.perf_counter()
            close_period(x, FIXTURE, StageStore(spark, tempfile.mkdtemp(prefix="settlebook-bench-")))
            stored = round(time.perf_counter() - t0, 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "settlement_steps_total_warm_median",
        "value": round(sum(timings.values()), 3),
        "unit": "sec",
        "queries": timings,
        "spread": spread,
        "stored_close_sec": stored,
        "sf": float(m.group(1)) if m else sf_dir,
        "cpus": int(cpus),
    }))
    spark.stop()


if __name__ == "__main__":
    main()

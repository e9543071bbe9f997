"""Benchmark of the headline queries.

Runs each query at $BENCH_SF_DIR (default /root/testdata/sf0.1) on
local[$BENCH_CPUS] and prints one JSON line.  Every query is executed in full
with the ``noop`` sink (all rows computed, nothing collected to the driver);
each is run ``$BENCH_REPEAT`` times (default 3) after one warm-up and the best
time is reported.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)
os.environ["PYTHONPATH"] = os.pathsep.join(filter(None, [ROOT, os.environ.get("PYTHONPATH")]))  # for the Python workers

from pairscope.plans import registry  # noqa: E402
from pairscope.session import get_session  # noqa: E402

HEADLINE = [
    "serving_features",        # C1 backfill over every run date (flagship)
    "serving_features_day",    # C1 one daily run
    "training_set",            # C2 pooled over 28 label days
    "training_set_day",        # C2 one label day
    "pre_order_searches",      # J1 fan-out as weights
    "balanced_sample",         # M1 exact-n seeded sample
    "split_counts",            # C3 sample + holdout + split
    "classification_report",   # C4 metrics
    "publish_features",        # K1 write + re-publish + read back
    "tsv_roundtrip",           # K2 + S6
    "history_route_flag",      # J4 + P6
    "gbt_train_score",         # M6 + M8, 2,000 rounds
    "gbt_evaluate",            # M6 + C4 over the whole holdout, 2,000 rounds
]


def run(spark, name: str, sf_dir: str) -> float:
    t0 = time.perf_counter()
    df = registry.QUERIES[name](spark, sf_dir)
    df.write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeat = int(os.environ.get("BENCH_REPEAT", "3"))
    spark = get_session(f"local[{cpus}]", int(cpus), extra={
        "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "16g")})
    spark.sparkContext.setLogLevel("ERROR")
    run(spark, "serving_features_day", sf_dir)  # warm-up: JVM, codegen, file listing
    times = {}
    for name in HEADLINE:
        times[name] = round(min(run(spark, name, sf_dir) for _ in range(repeat)), 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({"metric": "headline_total_time", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": m.group(1) if m else sf_dir,
                      "cpus": int(cpus)}))


if __name__ == "__main__":
    main()

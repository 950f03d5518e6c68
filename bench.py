"""Benchmark: run every registered query over $BENCH_SF_DIR and print one JSON line.

Each query is executed in full through the ``noop`` sink (all partitions
computed, nothing collected to the driver); queries that read sessions
derive them from the event log each time.  ``BENCH_WARMUP`` untimed passes,
then ``BENCH_RUNS`` timed ones, every second one in reverse order so that no
query is always first; a query's figure is its median.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from journey.plans import QUERIES  # noqa: E402
from journey.session import get_spark  # noqa: E402


def run_once(spark, fn, sf_dir: str) -> float:
    t0 = time.perf_counter()
    fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    only = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]
    spark = get_spark(cpus, shuffle_partitions=int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", "8")), app="journey-bench")
    names = only or list(QUERIES)
    failed = {}
    for _ in range(int(os.environ.get("BENCH_WARMUP", "2"))):  # JIT, file listing, Python imports
        for n in names:
            try:
                run_once(spark, QUERIES[n], sf_dir)
            except Exception as e:  # keep benchmarking the others; report the failure
                failed[n] = f"{type(e).__name__}: {str(e)[:200]}"
    took = {n: [] for n in names if n not in failed}
    for i in range(runs):
        for n in reversed(took) if i % 2 else list(took):
            took[n].append(run_once(spark, QUERIES[n], sf_dir))
    per = {n: round(statistics.median(t), 4) for n, t in took.items()}
    sf = Path(sf_dir).name.replace("sf", "")
    out = {
        "metric": "sum_of_median_query_seconds",
        "value": round(sum(per.values()), 4),
        "unit": "sec",
        "queries": per,
        "failed": failed,
        "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
        "cpus": cpus,
        "runs": runs,
        "spark": spark.version,
    }
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()

"""bench.py prints exactly one JSON line with the driver's fields."""

from __future__ import annotations

import json
import os
import subprocess
import sys

from tests.conftest import ROOT, SF0001


def test_bench_prints_one_json_line():
    env = dict(os.environ, BENCH_SF_DIR=SF0001, BENCH_RUNS="1", BENCH_CPUS="2",
               BENCH_QUERIES="q01_overall_funnel,q07_payment_failure_rate")
    out = subprocess.run([sys.executable, str(ROOT / "bench.py")], env=env, capture_output=True, text=True,
                         timeout=600, check=True).stdout
    lines = [ln for ln in out.splitlines() if ln.strip()]
    assert len(lines) == 1
    d = json.loads(lines[0])
    assert d["unit"] == "sec" and d["sf"] == 0.001 and d["failed"] == {}
    assert set(d["queries"]) == {"q01_overall_funnel", "q07_payment_failure_rate"}
    assert d["value"] == round(sum(d["queries"].values()), 4)

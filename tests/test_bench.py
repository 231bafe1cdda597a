"""bench.py prints one JSON line with the driver's fields (own process: it stops its session)."""

from __future__ import annotations

import json
import os
import subprocess
import sys

from .conftest import ROOT, SF_SMALL


def test_bench_prints_one_json_line():
    env = dict(os.environ, BENCH_SF_DIR=SF_SMALL, BENCH_CPUS="2", BENCH_NAIVE="0", BENCH_REPEAT="1")
    out = subprocess.run(
        [sys.executable, os.path.join(ROOT, "bench.py"), "time_interval", "most_related"],
        env=env, capture_output=True, text=True, timeout=600, check=True,
    ).stdout.strip().splitlines()
    assert len(out) == 1
    rec = json.loads(out[0])
    assert rec["unit"] == "sec" and rec["sf"] == 0.001
    assert set(rec["queries"]) == {"time_interval", "most_related"}
    assert abs(rec["value"] - sum(rec["queries"].values())) < 1e-6

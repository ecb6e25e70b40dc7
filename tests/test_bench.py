"""bench.py prints exactly one JSON line with the driver's keys (run in its own process: it stops its session)."""

import json
import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_bench_prints_one_json_line():
    env = dict(os.environ, BENCH_SF_DIR="/root/testdata/sf0.001", BENCH_CPUS="2", BENCH_RUNS="1",
               BENCH_QUERIES="users_count,users_page")
    out = subprocess.run([sys.executable, os.path.join(ROOT, "bench.py")], env=env, capture_output=True, text=True,
                         timeout=600, check=True)
    lines = [x for x in out.stdout.splitlines() if x.strip()]
    assert len(lines) == 1
    result = json.loads(lines[0])
    assert {"metric", "value", "unit", "queries", "sf"} <= set(result)
    assert result["unit"] == "sec" and result["sf"] == 0.001 and set(result["queries"]) == {"users_count", "users_page"}
    assert result["failed"] == [] and result["value"] > 0

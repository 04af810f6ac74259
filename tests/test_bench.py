"""bench.py prints exactly one JSON line with the agreed keys."""

import json
import os
import subprocess
import sys


def test_bench_prints_one_json_line():
    repo = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = dict(os.environ, BENCH_SF_DIR="/root/testdata/sf0.001", BENCH_CPUS="2")
    res = subprocess.run([sys.executable, os.path.join(repo, "bench.py"), "fleet_status", "silent_devices"],
                         capture_output=True, text=True, env=env, timeout=600, cwd="/tmp")
    lines = [ln for ln in res.stdout.splitlines() if ln.strip()]
    assert len(lines) == 1, res.stdout + res.stderr[-2000:]
    out = json.loads(lines[0])
    assert {"metric", "value", "unit", "queries", "sf"} <= set(out)
    assert out["unit"] == "sec" and out["sf"] == 0.001
    assert set(out["queries"]) == {"fleet_status", "silent_devices"}
    assert all(v is not None and v > 0 for v in out["queries"].values())
    assert "errors" not in out

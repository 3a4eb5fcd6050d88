import json
import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_bench_prints_one_json_line():
    env = {**os.environ, "BENCH_SF_DIR": "/root/testdata/sf0.001", "BENCH_CPUS": "2",
           "BENCH_REPEAT": "1"}
    proc = subprocess.run([sys.executable, os.path.join(ROOT, "bench.py")], cwd="/tmp",
                          capture_output=True, text=True, timeout=900, env=env)
    assert proc.returncode == 0, proc.stderr[-2000:]
    lines = [ln for ln in proc.stdout.splitlines() if ln.strip()]
    assert len(lines) == 1
    out = json.loads(lines[0])
    assert out["unit"] == "sec" and out["sf"] == 0.001 and out["metric"]
    assert set(out["queries"]) >= {"event_counts_clean", "reconcile", "run_setup"}
    assert abs(out["value"] - sum(out["queries"].values())) < 1e-3 * len(out["queries"])

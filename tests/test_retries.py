import json
import os
import subprocess
import sys

from tests.fixtures import make_clean_root, make_raw_root

HERE = os.path.dirname(os.path.abspath(__file__))


def test_observed_checks_exact_when_tasks_are_retried(tmp_path):
    base = tmp_path / "land"
    make_raw_root(base)
    make_clean_root(base)
    markers = tmp_path / "failed-attempts"
    markers.mkdir()
    proc = subprocess.run(
        [sys.executable, os.path.join(HERE, "retry_job.py"), str(base), str(tmp_path / "out")],
        capture_output=True, text=True, timeout=600,
        env={**os.environ, "RETRY_MARKERS": str(markers)})
    assert proc.returncode == 0, proc.stderr[-2000:]
    got = json.loads(proc.stdout.strip().splitlines()[-1])
    assert len(list(markers.iterdir())) >= 2      # failures did happen, on both sides
    # Every first attempt emitted a row and died; nothing is counted twice.
    assert got["raw_lines"] == 9
    assert got["results"]["raw/lines_check"] == [9, 9, True]
    assert got["results"]["clean/lines_check"] == [10, 10, True]
    assert got["results"]["clean/json_check"] == [10, 8, False]

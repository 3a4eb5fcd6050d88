"""Per-job wall times from a Spark event log (no UI involved).

Usage: python scripts/job_times.py <event log dir or file> [job-group]
Run the bench with BENCH_EVENT_LOG=<folder> to produce one. Prints each
job's start offset, duration and stage count, then the summed job time and
the span; the gap between the two is driver-side time between jobs.
"""

from __future__ import annotations

import glob
import json
import os
import sys


def _events(path: str):
    files = sorted(glob.glob(os.path.join(path, "**", "*"), recursive=True)) \
        if os.path.isdir(path) else [path]
    for f in files:
        name = os.path.basename(f)
        if os.path.isdir(f) or not name.startswith(("events_", "local-", "app-", "application_")):
            continue
        with open(f, "rb") as fh:
            data = fh.read()
        if f.endswith(".zstd"):
            import zstandard
            data = zstandard.ZstdDecompressor().stream_reader(data).read()
        for line in data.decode("utf-8").splitlines():
            if line.strip():
                yield json.loads(line)


def main() -> None:
    path = sys.argv[1]
    group = sys.argv[2] if len(sys.argv) > 2 else None
    jobs: dict[int, dict] = {}
    for e in _events(path):
        kind = e.get("Event")
        if kind == "SparkListenerJobStart":
            props = e.get("Properties") or {}
            jobs[e["Job ID"]] = {"start": e["Submission Time"], "stages": len(e["Stage Infos"]),
                                 "group": props.get("spark.jobGroup.id"),
                                 "site": props.get("callSite.short")}
        elif kind == "SparkListenerJobEnd" and e["Job ID"] in jobs:
            jobs[e["Job ID"]]["end"] = e["Completion Time"]
    chosen = [(k, v) for k, v in sorted(jobs.items())
              if "end" in v and (group is None or v["group"] == group)]
    if not chosen:
        print("no finished jobs")
        return
    first = chosen[0][1]["start"]
    total = 0
    for job_id, v in chosen:
        took = v["end"] - v["start"]
        total += took
        print(f"{job_id:5d} +{v['start'] - first:7d}ms {took:7d}ms stages={v['stages']} "
              f"{v['group'] or ''} {v['site'] or ''}")
    span = chosen[-1][1]["end"] - first
    print(f"jobs={len(chosen)} job_time={total}ms span={span}ms")


if __name__ == "__main__":
    main()

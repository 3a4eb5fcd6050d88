"""Command-line entry points, for ``spark-submit`` or ``python -m logtally.cli``.

    spark-submit --py-files logtally.zip logtally/cli.py setup \\
        --raw-root s3://bucket/raw/metrics/ --clean-root s3://bucket/nom/clean/ \\
        --output-root s3://bucket/derived/
    python -m logtally.cli landing-check /data/landing

``setup`` runs the whole DAG and prints the consistency rows as JSON; it
exits non-zero on a mismatch when ``--strict`` is given. ``landing-check``
prints one JSON line per refused archive and one with the counts by reason;
``--manifest`` writes the whole manifest as JSON lines, in tasks.
"""

from __future__ import annotations

import argparse
import json
import sys

from logtally.plans.setup import SetupConfig, run_setup
from logtally.session import build_session
from logtally.sources.landing import validate_landing


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="logtally")
    sub = p.add_subparsers(dest="command", required=True)

    s = sub.add_parser("setup", help="build all derived tables, checks and the report")
    s.add_argument("--raw-root", required=True)
    s.add_argument("--clean-root", required=True)
    s.add_argument("--output-root", required=True)
    s.add_argument("--raw-marker", default="metrics/")
    s.add_argument("--clean-marker", default="clean/")
    s.add_argument("--raw-name-path", default="$.clientData.name")
    s.add_argument("--clean-name-path", default="$.name")
    s.add_argument("--recursive", action="store_true")
    s.add_argument("--check", choices=("observe", "rescan"), default="observe")
    s.add_argument("--database")
    s.add_argument("--validate", action="store_true",
                   help="gzip-check every archive first and ingest only the valid ones")
    s.add_argument("--no-report", action="store_true")
    s.add_argument("--strict", action="store_true", help="fail when a check is inconsistent")

    c = sub.add_parser("landing-check", help="gzip integrity manifest of a landing folder")
    c.add_argument("root")
    c.add_argument("--recursive", action="store_true")
    c.add_argument("--glob", default="*.gz")
    c.add_argument("--manifest", help="folder to write the manifest of all archives to")
    return p


def main(argv: list[str] | None = None) -> int:
    args = _parser().parse_args(argv)
    spark = build_session("logtally")
    if args.command == "setup":
        cfg = SetupConfig(
            raw_root=args.raw_root, clean_root=args.clean_root, output_root=args.output_root,
            raw_marker=args.raw_marker, clean_marker=args.clean_marker,
            raw_name_path=args.raw_name_path, clean_name_path=args.clean_name_path,
            recursive=args.recursive, check=args.check, database=args.database,
            validate=args.validate,
            raise_on_mismatch=args.strict)
        try:
            results = run_setup(spark, cfg, report=not args.no_report)
        except AssertionError as exc:
            print(json.dumps({"error": str(exc)}))
            return 1
        print(json.dumps({path: list(row) for path, row in results.items()}))
        return 0
    manifest = validate_landing(spark, args.root, glob=args.glob, recursive=args.recursive).checkpoint()
    if args.manifest:
        manifest.write.mode("overwrite").json(args.manifest)
    for row in manifest.where("NOT isValid").drop("checkedAt").toLocalIterator():
        print(json.dumps(row.asDict()))
    print(json.dumps({"archives": {r["reason"]: r["count"] for r in manifest.groupBy("reason").count().collect()}}))
    return 0


if __name__ == "__main__":
    sys.exit(main())

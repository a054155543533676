"""Command line: run the warehouse load.

    spark-submit --py-files tierforge.zip tierforge/__main__.py --root s3a://bucket/warehouse
    python -m tierforge --root /data/warehouse --master local[8]

Exit status 1 when any task did not succeed.
"""

from __future__ import annotations

import argparse
import json
import os
import sys

if __package__ in (None, ""):            # run as a file (spark-submit tierforge/__main__.py)
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tierforge.plans.workflow import SUCCESS, run_warehouse  # noqa: E402
from tierforge.session import build_session  # noqa: E402


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="tierforge", description="Load the layered sales warehouse.")
    ap.add_argument("--root", required=True, help="warehouse root (bronze/, silver/, gold/, audit/)")
    ap.add_argument("--master", default=None, help="Spark master; omit under spark-submit")
    ap.add_argument("--profile", choices=("local", "cluster"), default="cluster")
    ap.add_argument("--format", dest="fmt", default=None, help="table format (default: parquet, delta if enabled)")
    ap.add_argument("--as-of", default=None, help="date for the future-birthdate rule (default: today)")
    ap.add_argument("--on-failure", choices=("skip", "continue"), default="skip")
    ap.add_argument("--key-method", choices=("ranged", "auto", "global"), default="ranged")
    ap.add_argument("--infer-schemas", action="store_true", help="infer feed schemas instead of declaring them")
    ap.add_argument("--run-id", default=None, help="name of the run; given again, only unfinished tasks are run")
    ap.add_argument("--buckets", type=int, default=None, help="store sales and customers in so many buckets of the customer id")
    args = ap.parse_args(argv)
    spark = build_session(args.master, profile=args.profile)
    records = run_warehouse(spark, args.root, as_of=args.as_of, on_failure=args.on_failure,
                            key_method=args.key_method, fmt=args.fmt, explicit_schemas=not args.infer_schemas,
                            run_id=args.run_id, buckets=args.buckets)
    for r in records:
        print(json.dumps({"task": r.task_name, "status": r.status, "rows": r.rows_processed,
                          "seconds": round(r.duration_seconds, 3), "error": r.error_message}))
    return 0 if all(r.status == SUCCESS for r in records) else 1


if __name__ == "__main__":
    sys.exit(main())

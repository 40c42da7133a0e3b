"""Run one job, or the whole batch: `python -m basket_marts batch --data-dir /data`."""

from __future__ import annotations

import argparse
import os
import sys

from basket_marts.plans import batch
from basket_marts.plans.quality import ContractViolation
from basket_marts.session import build_session
from basket_marts.sinks import to_catalog, to_jdbc, to_parquet

JOBS = ("clean", "marts", "dq", "publish", "benchmark", "batch")


def _arguments(argv: list[str] | None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="basket_marts", description=__doc__)
    parser.add_argument("job", choices=JOBS)
    parser.add_argument("--data-dir", default=os.getenv("DATA_DIR", "data"))
    parser.add_argument("--item-files", type=int, help="exact number of item files in the lake")
    parser.add_argument("--resume", action="store_true", help="skip finished stages of a batch")
    target = parser.add_mutually_exclusive_group()
    target.add_argument("--database", help="publish to catalog tables of this database")
    target.add_argument("--jdbc-url", help="publish to database tables")
    return parser.parse_args(argv)


def main(argv: list[str] | None = None) -> int:
    args = _arguments(argv)
    spark = build_session(f"basket_marts.{args.job}")
    raw, lake = f"{args.data_dir}/raw", f"{args.data_dir}/lake"
    if args.database:
        writer = to_catalog(args.database)
    elif args.jdbc_url:
        writer = to_jdbc(args.jdbc_url)
    else:
        writer = to_parquet(f"{args.data_dir}/published")
    try:
        if args.job == "clean":
            for account in batch.clean_audited(spark, raw, lake, args.item_files):
                print(account)
        elif args.job == "marts":
            print(batch.build_marts(spark, lake))
        elif args.job == "dq":
            for row in batch.check_quality(spark, lake):
                print(row.check_name, "ok")
        elif args.job == "publish":
            print(batch.publish(spark, lake, writer))
        elif args.job == "benchmark":
            batch.run_benchmark(spark, raw, lake, f"{args.data_dir}/metrics")
        else:
            print(batch.run_batch(spark, raw, lake, writer, args.resume))
    except ContractViolation as violation:
        print(violation, file=sys.stderr)
        return 1
    return 0


if __name__ == "__main__":
    sys.exit(main())

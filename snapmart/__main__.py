"""Command line: build the models, run the data tests, print the reports,
take in new game documents.

    python -m snapmart build  --raw-root R --warehouse W [--as-of D] [--pbp-store P]
    python -m snapmart test   --warehouse W          (exit 1 when a test fails)
    python -m snapmart report --warehouse W [name ...]
    python -m snapmart ingest --raw-root R --out P --checkpoint C
    python -m snapmart land   --inbox I --out P

``--master`` picks the Spark master (default: the cluster's, or local[*]
when there is none).
"""

from __future__ import annotations

import argparse
import os
import sys


def _session(args):
    from .session import build_session

    return build_session(master=args.master, app_name=f"snapmart-{args.command}")


def _print_rows(df) -> None:
    """Every row, tab-separated under a header, one partition at a time."""
    print("\t".join(df.columns))
    for row in df.toLocalIterator():
        print("\t".join("NULL" if v is None else str(v) for v in row))


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="snapmart")
    p.add_argument("--master", default=None)
    sub = p.add_subparsers(dest="command", required=True)
    b = sub.add_parser("build", help="build every model into the warehouse")
    b.add_argument("--raw-root", required=True)
    b.add_argument("--warehouse", required=True)
    b.add_argument("--as-of", default=None)
    b.add_argument("--pbp-store", default=None)
    t = sub.add_parser("test", help="run the declared data tests on the built models")
    t.add_argument("--warehouse", required=True)
    t.add_argument("--show-failures", action="store_true",
                   help="print failing rows of each failed test")
    t.add_argument("--rows", type=int, default=20, help="failing rows to print per test (default 20)")
    r = sub.add_parser("report", help="print the reports")
    r.add_argument("--warehouse", required=True)
    r.add_argument("names", nargs="*")
    i = sub.add_parser("ingest", help="take in only new game documents as Parquet")
    i.add_argument("--raw-root", required=True)
    i.add_argument("--out", required=True)
    i.add_argument("--checkpoint", required=True)
    la = sub.add_parser("land", help="append the completed games of an inbox that the store lacks")
    la.add_argument("--inbox", required=True)
    la.add_argument("--out", required=True)
    args = p.parse_args(argv)

    # Under spark-submit the driver starts with a gateway to the cluster's JVM
    # (PYSPARK_GATEWAY_PORT) and keeps its master; a plain run gets local[*].
    if args.master is None and "PYSPARK_GATEWAY_PORT" not in os.environ:
        args.master = "local[*]"
    spark = _session(args)
    from .plans import build as B
    from .plans import reports
    from .plans.quality import SUITE, failures, run_suite

    if args.command == "build":
        models = B.build(spark, args.raw_root, args.warehouse, args.as_of, pbp_store=args.pbp_store)
        for name in B.BUILD_ORDER:
            print(f"{name}: {models[name].count()} rows")
        return 0
    if args.command == "test":
        models = B.load_models(spark, args.warehouse)
        results = run_suite(models).orderBy("model", "test_id")
        rows = results.collect()      # one row per declared test (37)
        failed = [r for r in rows if r.failures]
        by_id = {t.test_id: t for t in SUITE}
        for r in rows:
            status = "FAIL" if r.failures else "PASS"
            print(f"{status} {r.test_id} ({r.failures})")
            if r.failures and args.show_failures:
                failures(by_id[r.test_id], models).show(args.rows, truncate=False)
        print(f"{len(rows) - len(failed)} passed, {len(failed)} failed")
        return 1 if failed else 0
    if args.command == "report":
        models = B.load_models(spark, args.warehouse)
        for name in args.names or list(reports.REPORTS):
            print(f"== {name}")
            _print_rows(reports.run_report(name, models))
        return 0
    if args.command == "ingest":
        from .streaming.incremental import ingest_counts, ingest_new_games

        ingest_new_games(spark, args.raw_root, args.out, args.checkpoint)
        counts = ingest_counts(spark, args.out)
        print(f"store {args.out}: {counts['stored']} documents, {counts['failed']} failed")
        return 0
    if args.command == "land":
        from .sources.landing import land_games

        for name, n in land_games(spark, args.inbox, args.out).items():
            print(f"{name}: {n}")
        return 0
    return 2


if __name__ == "__main__":
    sys.exit(main())

"""Command line: ``spark-submit``-style entry points of the batch and streaming jobs.

    python -m brookmark transform orders 20240301 --root /data
    python -m brookmark maintain --root /data --rewrite
    python -m brookmark query "SELECT status, count(*) FROM lake.orders GROUP BY status" --root /data
    python -m brookmark mirror orders --root /data --servers broker:9092
"""

from __future__ import annotations

import argparse
from datetime import datetime, timezone

from brookmark.plans.adhoc import bounded_query
from brookmark.plans.lakehouse import transform_all, transform_day
from brookmark.plans.layers import mirror_path, publish
from brookmark.plans.upkeep import run_maintenance
from brookmark.session import build_session
from brookmark.sources.changelog import read_cdc
from brookmark.sources.tables import SnapshotTable
from brookmark.specs import CATALOG
from brookmark.streaming.mirror import mirror_of, run_mirror


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="brookmark")
    jobs = parser.add_subparsers(dest="job", required=True)
    transform = jobs.add_parser("transform", help="merge one landed day into the silver tables")
    transform.add_argument("table", choices=[*CATALOG, "all"])
    transform.add_argument("day", nargs="?", help="yyyymmdd, today by default")
    maintain = jobs.add_parser("maintain", help="retention, and compaction with --rewrite")
    maintain.add_argument("--rewrite", action="store_true")
    maintain.add_argument("--days", type=int, default=7)
    maintain.add_argument("--snapshots", nargs="*", default=[], help="folders of snapshot tables, which no job here writes")
    query = jobs.add_parser("query", help="one bounded read-only query")
    query.add_argument("text")
    mirror = jobs.add_parser("mirror", help="keep a mirror of a change-log topic")
    mirror.add_argument("table", choices=list(CATALOG))
    mirror.add_argument("--servers", required=True)
    for job in (transform, maintain, query, mirror):
        job.add_argument("--root", required=True, help="folder of the stored layers")
    return parser


def main(argv: list[str] | None = None) -> None:
    args = _parser().parse_args(argv)
    spark = build_session(f"brookmark-{args.job}")
    root = args.root.rstrip("/")
    if args.job == "transform":
        if args.table == "all":
            print(transform_all(spark, root, args.day))
        else:
            print({args.table: transform_day(spark, root, CATALOG[args.table], args.day)})
    elif args.job == "maintain":
        now = datetime.now(timezone.utc)
        print(run_maintenance(
            spark, root, now, args.rewrite, args.days,
            snapshots=[SnapshotTable(spark, path) for path in args.snapshots],
            mirrors=[mirror_of(spark, mirror_path(root, spec), spec) for spec in CATALOG.values()],
        ))
    elif args.job == "query":
        publish(spark, root)
        answer = bounded_query(spark, args.text)
        answer.rows.show(100, truncate=False)
        if answer.truncated:
            print("(more rows exist)")
    else:
        spec = CATALOG[args.table]
        stream = read_cdc(spark, {"kafka.bootstrap.servers": args.servers}, spec.topic())
        run_mirror(
            stream, spec, mirror_path(root, spec), f"{root}/checkpoints/{spec.name}"
        ).awaitTermination()


if __name__ == "__main__":
    main()

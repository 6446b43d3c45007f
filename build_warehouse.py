"""Build the university warehouse from feeds: one run, bronze to marts.

    spark-submit build_warehouse.py --feeds s3a://raw-data --root s3a://warehouse [--recent-days 1]

Each feed is ``<feeds>/<entity><suffix>``: a file, or a folder of files.
"""

from __future__ import annotations

import argparse
import datetime as dt

from starbuild.plans.university import ENTITIES
from starbuild.plans.warehouse import Warehouse
from starbuild.session import get_session, jdbc_settings


def arguments() -> argparse.Namespace:
    parser = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    parser.add_argument("--feeds", required=True, help="folder holding the feeds")
    parser.add_argument("--root", required=True, help="root folder of the warehouse")
    parser.add_argument("--format", default="csv", choices=("csv", "json", "parquet"))
    parser.add_argument("--suffix", default="", help="file name ending of the feeds, for example .csv")
    parser.add_argument("--entities", nargs="*", default=list(ENTITIES), choices=list(ENTITIES))
    parser.add_argument("--run-at", type=dt.datetime.fromisoformat, default=None, help="run time; default now")
    parser.add_argument("--recent-days", type=int, default=None, help="merge only rows ingested in this window")
    parser.add_argument("--keep-versions", type=int, default=None, help="delete older table versions that are not in use")
    parser.add_argument("--no-gate", action="store_true", help="record failed checks without stopping")
    parser.add_argument("--export", nargs="*", default=[], help="gold tables to copy to the database of DW_HOST and others")
    return parser.parse_args()


def main() -> None:
    args = arguments()
    run_at = args.run_at or dt.datetime.now().replace(microsecond=0)
    warehouse = Warehouse(get_session("build warehouse"), args.root, run_at, gate=not args.no_gate)
    feeds = {name: (f"{args.feeds.rstrip('/')}/{name}{args.suffix}", args.format) for name in args.entities}
    warehouse.run(feeds, recent_days=args.recent_days, keep_versions=args.keep_versions)
    if args.export:
        url, properties = jdbc_settings()
        for table in args.export:
            warehouse.export("gold", table, url, properties)


if __name__ == "__main__":
    main()

"""Command line: run the load and refresh jobs, or the mart quality report.

    python -m atelier load --sources DIR [--format F] --dwh ROOT [--as-of ISO]
    python -m atelier refresh --dwh ROOT [--mode incremental|full]
    python -m atelier quality --dwh ROOT
    python -m atelier retain --dwh ROOT [--keep N] [--min-age-hours H]

``--sources`` holds one parquet table per reference source, named like the
reference (``source1.craft_market_wide``, ...). On a cluster, run it with
``spark-submit`` and set ``spark.checkpoint.dir`` to a shared folder.
"""

from __future__ import annotations

import argparse
import datetime as dt
import json

from atelier.operators.consolidate import (
    EXTERNAL_CUSTOMERS,
    EXTERNAL_ORDERS,
    SOURCE1_WIDE,
    SOURCE2_MASTERS_PRODUCTS,
    SOURCE2_ORDERS_CUSTOMERS,
    SOURCE3_CRAFTSMEN,
    SOURCE3_CUSTOMERS,
    SOURCE3_ORDERS,
)
from atelier.session import get_session
from atelier.sources.readers import read_source

SOURCE_NAMES = [
    SOURCE1_WIDE,
    SOURCE2_MASTERS_PRODUCTS,
    SOURCE2_ORDERS_CUSTOMERS,
    SOURCE3_ORDERS,
    SOURCE3_CRAFTSMEN,
    SOURCE3_CUSTOMERS,
    EXTERNAL_ORDERS,
    EXTERNAL_CUSTOMERS,
]


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="atelier")
    sub = parser.add_subparsers(dest="command", required=True)
    p_load = sub.add_parser("load", help="sources -> star schema")
    p_load.add_argument("--sources", required=True)
    p_load.add_argument("--format", default="parquet", help="reader of the source folders, or 'table' for a catalog database")
    p_load.add_argument("--dwh", required=True)
    p_load.add_argument("--as-of", default=None, help="load time stamp (default: now, UTC)")
    p_refresh = sub.add_parser("refresh", help="star schema -> mart")
    p_refresh.add_argument("--dwh", required=True)
    p_refresh.add_argument("--mode", choices=["incremental", "full"], default="incremental")
    p_refresh.add_argument("--checked", action="store_true", help="leave the mart as it was if rows violate its DDL")
    p_load.add_argument("--on-conflict", choices=["error", "latest"], default="error", help="source rows with one key")
    p_load.add_argument("--only-if-changed", action="store_true", help="leave matched rows without a change as they are")
    p_retain = sub.add_parser("retain", help="remove what no kept version refers to")
    p_retain.add_argument("--dwh", required=True)
    p_retain.add_argument("--keep", type=int, default=2)
    p_retain.add_argument("--min-age-hours", type=float, default=24)
    p_quality = sub.add_parser("quality", help="NOT NULL and grain report on the mart")
    p_quality.add_argument("--dwh", required=True)
    args = parser.parse_args(argv)

    spark = get_session()
    if args.command == "load":
        from atelier.plans.load import Modes, run_load

        as_of = dt.datetime.fromisoformat(args.as_of) if args.as_of else dt.datetime.now(dt.timezone.utc)
        if as_of.tzinfo is None:
            as_of = as_of.replace(tzinfo=dt.timezone.utc)
        sources = {n: read_source(spark, n, args.sources, args.format) for n in SOURCE_NAMES}
        print(json.dumps(run_load(spark, sources, args.dwh, as_of, Modes(args.on_conflict, args.only_if_changed))))
    elif args.command == "refresh":
        from atelier.plans.refresh import refresh_mart

        print(json.dumps(refresh_mart(spark, args.dwh, mode=args.mode, checked=args.checked), default=str))
    elif args.command == "retain":
        from atelier.sources.retention import retain

        print(json.dumps({"removed": retain(spark, args.dwh, args.keep, dt.timedelta(hours=args.min_age_hours))}))
    else:
        from atelier.operators.quality import duplicate_keys, null_violations
        from atelier.plans.refresh import MART_TABLE
        from atelier.schemas import MART, MART_NOT_NULL
        from atelier.sources.tables import read_table

        mart = read_table(spark, f"{args.dwh}/{MART_TABLE}", MART)
        nulls = {r.column_name: r.null_rows for r in null_violations(mart, MART_NOT_NULL).collect()}
        grain = duplicate_keys(mart, ["customer_id", "report_period"]).count()
        ids = duplicate_keys(mart, ["id"]).count()
        print(json.dumps({"null_rows": nulls, "duplicate_grain_keys": grain, "duplicate_ids": ids}))
    return 0


if __name__ == "__main__":
    raise SystemExit(main())

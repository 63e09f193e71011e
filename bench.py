"""Benchmark: the load job and the mart refresh on versioned tables.

Reads the driver tables at $BENCH_SF_DIR (default /root/testdata/sf0.1) on
local[$BENCH_CPUS] and prints one JSON line.

Untimed setup: the eight source tables of the reference are derived from the
driver tables (FIXTURES.md mapping) and written as parquet, like the stored
source tables the reference reads.

Timed (seconds):
- ``load``: consolidate the sources and merge them into an empty star schema
  (every row inserted, surrogate ids assigned);
- ``reload``: the same load again (every row matched and updated);
- ``mart_full``: full refresh of the mart (median of three warm runs);
- ``mart_incr_{1,10,30}pct``: incremental refresh after the orders of 1 / 10 /
  30 % of the customers changed status (the change batch is committed
  untimed);
- ``delta_pruned_query`` / ``mart_literal_query``: two registered queries
  end to end from the driver tables (fixture derivation included).
"""

from __future__ import annotations

import datetime as dt
import json
import os
import statistics
import sys
import tempfile
import time

from pyspark.sql import functions as F

from atelier.operators.upsert import MergeConflict
from atelier.plans.load import commit_orders, run_load
from atelier.plans.refresh import refresh_mart
from atelier.queries import all_queries
from atelier.session import get_session
from atelier.sources import fixtures as fx
from atelier.sources.star import commit_star, read_star
from atelier.sources.tables import current_commit


def _timed(fn):
    t0 = time.perf_counter()
    out = fn()
    return time.perf_counter() - t0, out


def change_batch(spark, dwh: str, percent: int, stamp: dt.datetime) -> None:
    """Commit a new f_order version: orders of ``percent`` % of customers move on a status."""
    fo = read_star(spark, dwh)["f_order"]
    pick = (F.abs(F.xxhash64("customer_id", F.lit(percent))) % 100) < percent
    moved = {
        "created": "in progress",
        "in progress": "delivery",
        "delivery": "done",
        "done": "done",
    }
    status = F.col("order_status")
    nxt = F.coalesce(*[F.when(status == k, F.lit(v)) for k, v in moved.items()], status)
    changed = fo.select(
        "order_id",
        "product_id",
        "craftsman_id",
        "customer_id",
        "order_created_date",
        F.when(pick & (nxt == "done") & F.col("order_completion_date").isNull(),
               F.date_add("order_created_date", 7))
        .otherwise(F.col("order_completion_date"))
        .alias("order_completion_date"),
        F.when(pick, nxt).otherwise(status).alias("order_status"),
        F.when(pick, F.lit(stamp)).otherwise(F.col("load_dttm")).alias("load_dttm"),
    )
    root = f"{dwh}/f_order"
    commit_orders(changed, root, current_commit(spark, root)["max_id"])
    commit_star(spark, dwh, stamp)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    scratch = tempfile.mkdtemp(prefix="atelier-bench-")
    spark = get_session(
        master=f"local[{cpus}]",
        shuffle_partitions=cpus * 2,
        driver_memory=os.environ.get("ATELIER_DRIVER_MEMORY", "16g"),
        extra={"spark.checkpoint.dir": f"{scratch}/checkpoints"}
        if not os.environ.get("SPARK_CHECKPOINT_DIR")
        else {"spark.checkpoint.dir": os.environ["SPARK_CHECKPOINT_DIR"]},
    )
    times: dict[str, float] = {}

    # Untimed: stored source tables, split into several files like real
    # tables (the driver's lineitem is a single row group, which would
    # otherwise make every source scan a single task).
    sources = {}
    for name, df in fx.source_tables(spark, sf_dir).items():
        path = f"{scratch}/sources/{name}"
        df.repartition(cpus).write.parquet(path)
        sources[name] = spark.read.parquet(path)

    dwh = f"{scratch}/dwh"
    t0 = dt.datetime(2024, 1, 1)
    times["load"], _ = _timed(lambda: run_load(spark, sources, dwh, t0))
    try:
        times["reload"], _ = _timed(lambda: run_load(spark, sources, dwh, t0 + dt.timedelta(days=1)))
    except MergeConflict:  # repeated natural keys in small fixtures
        times["reload"] = float("nan")

    refresh_mart(spark, dwh, mode="full")  # warm-up, also seeds the watermark
    runs = [_timed(lambda: refresh_mart(spark, dwh, mode="full"))[0] for _ in range(3)]
    times["mart_full"] = statistics.median(runs)

    stamp = t0 + dt.timedelta(days=30)
    for pct in (1, 10, 30):
        stamp += dt.timedelta(days=1)
        change_batch(spark, dwh, pct, stamp)
        times[f"mart_incr_{pct}pct"], _ = _timed(lambda: refresh_mart(spark, dwh, mode="incremental"))

    queries = all_queries()
    for key, name in (("delta_pruned_query", "delta_pruned"), ("mart_literal_query", "mart_update_literal")):
        times[key], _ = _timed(lambda: queries[name](spark, sf_dir).count())

    total = sum(v for v in times.values() if v == v)
    sf = os.path.basename(sf_dir).replace("sf", "")
    print(
        json.dumps(
            {
                "metric": "load_and_refresh_total",
                "value": round(total, 3),
                "unit": "sec",
                "queries": {k: round(v, 3) for k, v in times.items()},
                "sf": float(sf) if sf.replace(".", "").isdigit() else sf,
                "cpus": cpus,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    sys.exit(main())

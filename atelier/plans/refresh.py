"""Mart refresh job with a high-watermark log and a maintained state.

A full refresh rolls the fact up to the order grain, keeps that as the state table
(laid out by customer bucket) and makes the mart from it. An incremental refresh
doesn't read the fact but for what changed: the state's commit names the star
manifest that it reflects, and the difference of the fact's folder lists between
that manifest and the newest one is the change feed (``operators.maintained``).
Its net change is appended to the state as one small folder, and only the rows of
affected customers are made anew, from their part of the state. After
``MOST_CHANGES`` folders of changes state and mart are written anew, without reading the fact.

Protocol (SURVEY §3.2): read every input at its committed version, compute,
commit the new mart version, then the state, then append the watermark row. The mart is
laid out by customer bucket, and an incremental refresh writes the affected customers'
rows and ids only: the new rows replace the earlier ones when the mart is read. The
feed is relative to what the state reflects, so a crash before the state's
commit makes the next refresh find the same change again, and it
replaces whole customers: repeating is harmless. Of two refreshes at once
one commits, the other raises ``CommitConflict``.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from atelier.operators.delta import DEFAULT_WATERMARK, read_watermark
from atelier.operators.maintained import CUSTOMER_VALUES, PRODUCT_VALUES, STATE, feed_change, order_feed, other_values, standing, state_of, with_orders_of
from atelier.operators.quality import row_checks
from atelier.plans.mart import mart_of_grain, with_known_ids, with_mart_ids_counted
from atelier.schemas import F_ORDER, MART, MART_NOT_NULL, WATERMARK_LOG
from atelier.session import checkpoint_root, materialize, scratch_scope
from atelier.sources.star import as_timestamp, newest_manifest, read_commits, read_star, star_commits  # noqa: F401
from atelier.sources.tables import (
    Prepared,
    append_rows,
    changed_folders,
    commit_version,
    current_commit,
    folders_since,
    newest_stamp,
    partition_value,
    prepare_version,
    publish_version,
    read_paths,
    read_table,
    read_version,
)

MART_TABLE = "customer_report_datamart"
WATERMARK_TABLE = "load_dates_customer_report_datamart"
STATE_TABLE = "customer_report_state"
DIMENSIONS = ("d_craftsman", "d_product", "d_customer")
# Mart and state are laid out by customer bucket so that an incremental refresh
# reads only the buckets of affected customers. Set the count with the
# session setting below so a bucket is a few hundred MB at the target size.
# The count is part of the folder name: a version written with another count
# is never mixed with the new layout (the next refresh rewrites it whole).
MART_BUCKETS_CONF = "spark.atelier.mart.buckets"
DEFAULT_MART_BUCKETS = 16
#: Folders of changes beside the state's buckets, beyond which the state is written anew.
MOST_CHANGES = 8


def mart_buckets(spark: SparkSession) -> int:
    return int(spark.conf.get(MART_BUCKETS_CONF, str(DEFAULT_MART_BUCKETS)))


def mart_partition(buckets: int):
    return (f"customer_bucket_{buckets}", F.pmod(F.xxhash64("customer_id"), F.lit(buckets)))


def next_watermark(commits: dict[str, dict], watermark) -> dt.datetime:
    """C13 (intended): the newest load stamp in the fact and the dimensions, from their commits.

    Everything loaded until then has been taken into account by the refresh that
    uses this value. The old watermark where nothing newer exists (an empty delta, D10).
    """
    newest = [s for c in commits.values() if (s := newest_stamp(c["folders"])) is not None]
    return max([as_timestamp(watermark), *newest])


def completion_marker(spark: SparkSession, result: dict) -> DataFrame:
    """P10: the refresh's closing row, as a one-row frame."""
    return spark.createDataFrame([(result["status"], result["mode"], result["mart_version"])], "status string, mode string, mart_version long")


def feed_folders(old: dict[str, dict], new: dict[str, dict], watermark) -> tuple[list[str], list[str]]:
    """The fact's folders with changed orders, and those with the same orders as they were."""
    added, removed = changed_folders(old["f_order"], new["f_order"])
    return [f["path"] for f in folders_since(added, watermark)], [f["path"] for f in removed]


def refresh_mart(spark: SparkSession, dwh_root: str, mode: str = "incremental", checked: bool = False) -> dict:
    """Refresh the mart; ``mode`` is 'incremental' or 'full'. Without a mart and its state a refresh is full.

    ``checked``: rows that the mart's DDL wouldn't accept (Q1, Q3) make the refresh fail with ``CheckFailed``,
    and the mart stays as it was.
    """
    checks = row_checks(MART_NOT_NULL, MART) if checked else None
    checkpoint_root(spark)
    manifest = newest_manifest(spark, dwh_root)
    if manifest is None:
        raise FileNotFoundError(f"no complete load under {dwh_root}")
    mart_root, log_root, state_root = (f"{dwh_root}/{t}" for t in (MART_TABLE, WATERMARK_TABLE, STATE_TABLE))
    commits = star_commits(spark, dwh_root, manifest["number"])
    mart_commit, log_commit, state_commit = (current_commit(spark, r) for r in (mart_root, log_root, state_root))
    log = read_table(spark, log_root, WATERMARK_LOG) if log_commit else None
    watermark = read_watermark(log, DEFAULT_WATERMARK)
    layout = mart_partition(mart_buckets(spark))
    kept_up = state_commit is not None and mart_commit is not None and state_commit["note"]["layout"] == layout[0]
    full = mode == "full" or not kept_up
    with scratch_scope(spark):
        if full:
            version, state = _full(spark, commits, mart_root, mart_commit, state_root, state_commit, layout, checks)
        else:
            reflected = dt.datetime.fromtimestamp(state_commit["note"]["watermark"] / 1_000_000)
            old = star_commits(spark, dwh_root, state_commit["note"]["manifest"])
            version, state = _incremental(spark, old, commits, reflected, mart_root, mart_commit, state_root, state_commit, layout, checks)
        next_wm = next_watermark(commits, watermark)
        note = {"manifest": manifest["number"], "watermark": round(next_wm.timestamp() * 1_000_000), "layout": layout[0]}
        publish_version(spark, Prepared(state_root, state.version, state.folders, None, note, state.written))
        log_id = (log_commit or {}).get("max_id") or 0
        row = spark.range(1).select(F.lit(log_id + 1).alias("id"), F.lit(next_wm).alias("load_dttm")).coalesce(1)
        append_rows(spark, log_root, row, WATERMARK_LOG, max_id=log_id + 1)
    # P10: the reference ends with SELECT 'increment datamart'.
    return {
        "status": "increment datamart",
        "mode": "full" if full else "incremental",
        "mart_version": version,
        "watermark": next_wm,
        "previous_watermark": watermark,
    }


def _newest(commit: dict | None) -> int:
    return 0 if commit is None else commit["version"]


def _full(spark, commits, mart_root, mart_commit, state_root, state_commit, layout, checks) -> tuple[int, Prepared]:
    star = read_commits(spark, commits)
    state = prepare_version(state_of(star), state_root, STATE, partition=layout, base=None, after=_newest(state_commit))
    grain = read_paths(spark, [f["path"] for f in state.folders], STATE)
    rows, max_id = with_mart_ids_counted(mart_of_grain(grain, star["d_customer"]))
    version = commit_version(
        rows, mart_root, MART, max_id=max_id, partition=layout, base=mart_commit, after=_newest(mart_commit), checks=checks
    )
    return version, state


def _changed_products(old: dict[str, DataFrame], new: dict[str, DataFrame], before: dict, after: dict, watermark) -> DataFrame | None:
    if before["d_product"]["version"] == after["d_product"]["version"]:
        return None
    products = materialize(other_values(old["d_product"], new["d_product"], "product_id", PRODUCT_VALUES, watermark), "products")
    return None if products.isEmpty() else products


def _affected(change: DataFrame, old: dict[str, DataFrame], new: dict[str, DataFrame], before: dict, after: dict, watermark) -> DataFrame:
    """Customers whose orders changed, or whose own columns did."""
    affected = change.select("customer_id")
    if before["d_customer"]["version"] != after["d_customer"]["version"]:
        affected = affected.unionByName(other_values(old["d_customer"], new["d_customer"], "customer_id", CUSTOMER_VALUES, watermark))
    return affected.distinct()


def _in_buckets(folders: list[dict], column: str, buckets: list[str]) -> list[dict]:
    """The folders of these buckets and those of changes."""
    return [f for f in folders if partition_value(f["path"], column) in (None, *buckets)]


def _incremental(spark, before, after, watermark, mart_root, mart_commit, state_root, state_commit, layout, checks) -> tuple[int, Prepared]:
    bucket_col, bucket = layout
    new = read_commits(spark, after, DIMENSIONS)
    changed_tables = tuple(t for t in DIMENSIONS if before[t]["version"] != after[t]["version"])
    old = new | read_commits(spark, before, changed_tables)
    added, removed = (read_paths(spark, paths, F_ORDER) for paths in feed_folders(before, after, watermark))
    products = _changed_products(old, new, before, after, watermark)
    plus, minus = order_feed(added, removed, watermark)
    if products is not None:
        plus, minus = with_orders_of(products, plus, minus, *(read_commits(spark, c, ("f_order",))["f_order"] for c in (before, after)))
    change = feed_change(plus, minus, old, new)
    state = prepare_version(change, state_root, STATE, mode="append", base=state_commit, after=state_commit["version"])
    # The mart may be ahead of the state after a crash; the customers affected then are among these.
    affected = _affected(read_paths(spark, [f["path"] for f in state.written], STATE), old, new, before, after, watermark)
    keys = f"{mart_root}/data-{mart_commit['version'] + 1:08d}-{uuid.uuid4().hex[:8]}-keys"
    affected.write.parquet(keys)
    affected = spark.read.schema(affected.schema).parquet(keys)
    buckets = [str(r[0]) for r in affected.select(bucket).distinct().collect()]  # at most one value per bucket
    rows = read_paths(spark, [f["path"] for f in _in_buckets(state.folders, bucket_col, buckets)], STATE)
    grain = materialize(standing(rows.join(affected, "customer_id", "left_semi")), "grain")
    earlier = read_version(spark, _in_buckets(mart_commit["folders"], bucket_col, buckets), MART)
    renewed, max_id = with_known_ids(
        mart_of_grain(grain, new["d_customer"]), earlier.join(affected, "customer_id", "left_semi"), mart_commit["max_id"]
    )
    mart = prepare_version(
        renewed, mart_root, MART, mode="append", max_id=max_id, base=mart_commit, after=mart_commit["version"], checks=checks
    )
    changed = [f | {"replaces": keys, "by": "customer_id"} for f in mart.written] if buckets else []
    mart.folders[len(mart.folders) - len(mart.written):] = changed
    if sum("replaces" in f for f in mart.folders) > MOST_CHANGES:
        whole = read_version(spark, mart.folders, MART)
        mart = prepare_version(whole, mart_root, MART, max_id=max_id, partition=layout, base=None, after=mart_commit["version"])
    if sum(partition_value(f["path"], bucket_col) is None for f in state.folders) > MOST_CHANGES:
        whole = standing(read_paths(spark, [f["path"] for f in state.folders], STATE))
        state = prepare_version(whole, state_root, STATE, partition=layout, base=None, after=state_commit["version"])
    return publish_version(spark, mart), state

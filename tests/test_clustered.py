"""Merges of tables that lie by natural key: the same rows as the plain merge, no exchange of the target, untouched folders kept."""

from __future__ import annotations

import datetime as dt
import random
from collections import Counter
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from atelier.operators.upsert import MergeConflict, merge_clustered, merge_upsert_counted
from atelier.plans import load
from atelier.plans.refresh import MART_TABLE, refresh_mart
from atelier.schemas import CUSTOMER_KEY, CUSTOMER_SET, D_CUSTOMER, F_ORDER, MART, ORDER_KEY
from atelier.sources import tables
from atelier.sources.clustered import Clustering, clustered_rows
from atelier.sources.star import read_star
from test_recovery import T0, T1, T2, sources, wide_row

BY_KEY = Clustering(tuple(CUSTOMER_KEY), 4)
ATTRS = "customer_name string, customer_email string, customer_address string, customer_birthday date"


def customers(seed, n, spread):
    """Rows of a source: names and emails from a small range, so that keys meet, repeat in the target and are NULL."""
    rnd = random.Random(seed)
    name = lambda: rnd.choice([None, *(f"n{k}" for k in range(spread))])
    return [(name(), name(), rnd.choice([None, "a", "b"]), rnd.choice([None, dt.date(1990, 1, 1), dt.date(1991, 1, 1)])) for _ in range(n)]


def one_a_key(rows):
    held = {}
    for r in rows:
        held.setdefault(r[:2] if None not in r[:2] else object(), r)
    return list(held.values())


def counted(df):
    return Counter(tuple(r) for r in df.collect())


@pytest.mark.parametrize("seed", range(3))
@pytest.mark.parametrize("how", [{}, {"on_conflict": "latest", "latest_by": ["customer_birthday"]}, {"only_if_changed": True}])
def test_the_merge_equals_the_plain_one(spark, workdir, seed, how):
    target = [(k, *r[:1], r[2], r[3], r[1], T0) for k, r in enumerate(customers(seed, 60, 6), 1)]
    target = spark.createDataFrame(target, D_CUSTOMER)
    source = customers(seed + 50, 50, 7)
    source = spark.createDataFrame(source if "on_conflict" in how else one_a_key(source), ATTRS)
    args = (source, CUSTOMER_KEY, CUSTOMER_SET, T1, "customer_id")
    plain, plain_max = merge_upsert_counted(target, *args, base_id=60, **how)
    version = tables.commit_version(target, workdir, D_CUSTOMER, max_id=60, partition=BY_KEY.partition, clustering=BY_KEY)
    commit = tables.commit_of_version(spark, workdir, version)
    assert sum(f["rows"] for f in commit["folders"]) == 60 and BY_KEY.holds(commit["folders"])
    with clustered_rows(spark, commit["folders"], D_CUSTOMER, BY_KEY) as rows:
        merged, max_id = merge_clustered(rows, *args, D_CUSTOMER, 60, BY_KEY.buckets, **how)
        assert max_id == plain_max
        assert counted(merged) == counted(plain)
    merged, max_id = merge_clustered(None, *args, D_CUSTOMER, 0, BY_KEY.buckets, **how)
    assert counted(merged) == counted(merge_upsert_counted(target.limit(0), *args, base_id=0, **how)[0])
    assert spark.sql("SHOW TABLES LIKE 'atelier_*'").count() == 0


def test_two_source_rows_for_one_target_row_are_a_conflict(spark, workdir):
    target = spark.createDataFrame([(1, "n", "a", None, "e", T0)], D_CUSTOMER)
    source = spark.createDataFrame([("n", "e", "b", None), ("n", "e", "c", None)], ATTRS)
    with pytest.raises(MergeConflict):
        merge_clustered(target, source, CUSTOMER_KEY, CUSTOMER_SET, T1, "customer_id", D_CUSTOMER, 1, 4)


def sorted_merge_plan(df):
    """The physical plan where no side is small enough to be broadcast."""
    spark = df.sparkSession
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        return df._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_the_target_has_no_exchange(spark, workdir):
    rows = spark.range(2000).select(
        F.col("id").alias("customer_id"), F.concat(F.lit("n"), "id").alias("customer_name"), F.lit("a").alias("customer_address"),
        F.lit(None).cast("date").alias("customer_birthday"), F.lit("e").alias("customer_email"), F.lit(T0).alias("load_dttm"),
    )
    tables.commit_version(rows, workdir, D_CUSTOMER, max_id=2000, partition=BY_KEY.partition, clustering=BY_KEY)
    folders = tables.current_commit(spark, workdir)["folders"]
    source = rows.limit(10).select("customer_name", "customer_email", F.lit("z").alias("customer_address"), "customer_birthday")
    with clustered_rows(spark, folders, D_CUSTOMER, BY_KEY) as target:
        merged, _ = merge_clustered(target, source, CUSTOMER_KEY, CUSTOMER_SET, T1, "customer_id", D_CUSTOMER, 2000, 4)
        plan = sorted_merge_plan(merged)
        lines = plan.splitlines()
        join = next(k for k, line in enumerate(lines) if "SortMergeJoin" in line and "FullOuter" in line)
        scan = next(k for k, line in enumerate(lines) if k > join and "FileScan" in line)
        assert "Bucketed: true" in lines[scan]  # the left side of the join: the target, as it lies
        assert not [line for line in lines[join:scan] if "Exchange" in line]
        assert merged.where("customer_address = 'z'").count() == 10


def test_untouched_buckets_keep_their_folders(spark, workdir):
    many = [wide_row(k, Decimal(5), customer=f"c{k}", day=1 + k % 20) for k in range(1, 40)]
    load.run_load(spark, sources(spark, many), workdir, T0)
    before = tables.current_commit(spark, f"{workdir}/d_customer")
    load.run_load(spark, sources(spark, [wide_row(7, Decimal(5), customer="c7", day=8)]), workdir, T1)
    after = tables.current_commit(spark, f"{workdir}/d_customer")
    added, removed = tables.changed_folders(before, after)
    assert len(added) == len(removed) == 1 and len(after["folders"]) == len(before["folders"]) > 8
    assert added[0]["rows"] == removed[0]["rows"]
    star = read_star(spark, workdir)["d_customer"]
    assert [r.customer_name for r in star.where(F.col("load_dttm") == F.lit(T1)).collect()] == ["c7"]
    assert star.count() == 39 and star.select("customer_id").distinct().count() == 39


def test_rows_without_a_key_are_added_and_never_read(spark, workdir):
    row = wide_row(1, Decimal(5)) | {"customer_email": None}
    for n, stamp in enumerate((T0, T1, T2), 1):
        load.run_load(spark, sources(spark, [row, wide_row(2, Decimal(5))]), workdir, stamp)
        folders = tables.current_commit(spark, f"{workdir}/d_customer")["folders"]
        assert len([f for f in folders if f["path"].endswith(tables.NULL_PARTITION)]) == n
        assert read_star(spark, workdir)["d_customer"].count() == n + 1


@pytest.mark.parametrize("conf", [load.DIMENSION_BUCKETS_CONF, load.ORDER_BUCKETS_CONF])
def test_another_layout_is_taken_over(spark, workdir, conf):
    many = [wide_row(k, Decimal(5), customer=f"c{k}", day=1 + k % 20) for k in range(1, 20)]
    changed = [r | {"order_status": "closed", "customer_address": "moved"} for r in many[:3]]
    load.run_load(spark, sources(spark, many), workdir, T0)
    try:
        spark.conf.set(conf, "3")
        load.run_load(spark, sources(spark, changed), workdir, T1)
        spark.conf.set(conf, "5")
        load.run_load(spark, sources(spark, many), workdir, T2)
    finally:
        spark.conf.unset(conf)
    star = read_star(spark, workdir)
    assert {n: df.count() for n, df in star.items()} == {"d_craftsman": 1, "d_product": 19, "d_customer": 19, "f_order": 19}
    assert star["f_order"].where(F.col("load_dttm") != F.lit(T2)).count() == 0
    table = "d_customer" if conf == load.DIMENSION_BUCKETS_CONF else "f_order"
    assert {f["buckets"] for f in tables.current_commit(spark, f"{workdir}/{table}")["folders"]} == {5}


def test_bucketed_orders_are_merged_as_plain_ones(spark, workdir):
    first = [wide_row(k, Decimal(5), customer=f"c{k % 7}", day=1 + k % 20) for k in range(1, 60)]
    undated = wide_row(99, Decimal(5)) | {"order_created_date": None, "order_completion_date": None}
    second = [r | {"order_status": "closed"} for r in first[:9]] + [wide_row(k, Decimal(6), customer=f"c{k}", day=3) for k in range(70, 75)] + [undated]
    got = {}
    for buckets in ("0", "4"):
        root = f"{workdir}/{buckets}"
        spark.conf.set(load.ORDER_BUCKETS_CONF, buckets)
        try:
            load.run_load(spark, sources(spark, first + [undated]), root, T0)
            refresh_mart(spark, root)
            load.run_load(spark, sources(spark, second), root, T1)
        finally:
            spark.conf.unset(load.ORDER_BUCKETS_CONF)
        refresh_mart(spark, root)
        mart = tables.read_table(spark, f"{root}/{MART_TABLE}", MART)
        got[buckets] = counted(read_star(spark, root)["f_order"]), counted(mart)
    assert got["0"] == got["4"]
    folders = tables.current_commit(spark, f"{workdir}/4/f_order")["folders"]
    clustering = Clustering(tuple(ORDER_KEY), 4)
    with clustered_rows(spark, folders, F_ORDER, clustering) as rows:
        plan = sorted_merge_plan(rows.groupBy(*ORDER_KEY).count())
        assert "Exchange" not in plan and rows.count() == 66

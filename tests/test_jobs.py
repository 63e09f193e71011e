"""End-to-end jobs on versioned tables: load, full refresh, incremental refresh.

Invariants (SURVEY §5): incremental == full after a change batch; refreshing
twice == once; loading the same sources twice adds no rows.
"""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from atelier.operators.upsert import MergeConflict
from atelier.session import materialize

from atelier.plans.load import commit_orders, run_load
from atelier.plans.refresh import MART_TABLE, WATERMARK_TABLE, read_star, refresh_mart
from atelier.schemas import F_ORDER, MART, MART_BUSINESS_COLS, WATERMARK_LOG
from atelier.sources import fixtures as fx
from atelier.sources.star import commit_star
from atelier.sources.tables import commit_version, current_commit, read_table
from paths import SF_SMALL

T0 = dt.datetime(2024, 1, 1)
T1 = dt.datetime(2024, 2, 1)


def _business(df):
    cols = sorted(MART_BUSINESS_COLS)
    return sorted(tuple(r[c] for c in cols) for r in df.select(*cols).collect())


def test_load_refresh_incremental_equals_full(spark, workdir):
    dwh = f"{workdir}/dwh"
    versions = run_load(spark, fx.source_tables(spark, SF_SMALL), dwh, T0)
    assert versions == {"d_craftsman": 1, "d_product": 1, "d_customer": 1, "f_order": 1}
    star = read_star(spark, dwh)
    n_orders = star["f_order"].count()
    assert n_orders == fx.wide_orders(spark, SF_SMALL).distinct().count()

    first = refresh_mart(spark, dwh, mode="incremental")  # no mart yet: full
    assert first["mart_version"] == 1
    mart1 = read_table(spark, f"{dwh}/{MART_TABLE}", MART)
    assert mart1.count() > 0
    assert mart1.select("id").distinct().count() == mart1.count()

    # A change batch: 10% of orders change status after the watermark.
    fo = read_star(spark, dwh)["f_order"]
    changed = fo.withColumn(
        "order_status",
        F.when(F.col("order_id") % 10 == 0, F.lit("done")).otherwise(F.col("order_status")),
    ).withColumn(
        "load_dttm",
        F.when(F.col("order_id") % 10 == 0, F.lit(dt.datetime(2024, 3, 1))).otherwise(
            F.col("load_dttm")
        ),
    )
    staged = materialize(changed, "changed-orders")
    commit_orders(staged, f"{dwh}/f_order", current_commit(spark, f"{dwh}/f_order")["max_id"])
    commit_star(spark, dwh, dt.datetime(2024, 3, 1))

    incr = refresh_mart(spark, dwh, mode="incremental")
    incremental = read_table(spark, f"{dwh}/{MART_TABLE}", MART)
    log = read_table(spark, f"{dwh}/{WATERMARK_TABLE}", WATERMARK_LOG)
    assert log.count() == 2  # first refresh, then the incremental one
    assert incr["watermark"] >= dt.datetime(2024, 3, 1)

    refresh_mart(spark, dwh, mode="full")
    full = read_table(spark, f"{dwh}/{MART_TABLE}", MART)
    assert _business(incremental) == _business(full)

    # Refreshing again with no change keeps the mart as it is.
    refresh_mart(spark, dwh, mode="incremental")
    again = read_table(spark, f"{dwh}/{MART_TABLE}", MART)
    assert _business(again) == _business(full)

    # sf0.001 repeats some order keys with different statuses: loading the
    # same sources again matches those targets twice, which MERGE refuses.
    with pytest.raises(MergeConflict):
        run_load(spark, fx.source_tables(spark, SF_SMALL), dwh, dt.datetime(2024, 4, 1))
    assert current_commit(spark, f"{dwh}/f_order")["version"] == 2  # nothing committed


def test_load_twice_adds_no_rows(spark, workdir):
    wide = fx.wide_orders(spark, SF_SMALL)
    unique = wide.join(
        wide.groupBy("product_id", "craftsman_id", "customer_id", "order_created_date")
        .count()
        .filter("count = 1")
        .drop("count"),
        ["product_id", "craftsman_id", "customer_id", "order_created_date"],
        "left_semi",
    )
    unique = materialize(unique, "unique-orders")
    sources = {name: unique for name in ["source1.craft_market_wide"]}
    sources.update(_empty_other_sources(spark, unique))
    dwh = f"{workdir}/dwh"
    run_load(spark, sources, dwh, T0)
    first = {n: df.count() for n, df in read_star(spark, dwh).items()}
    run_load(spark, sources, dwh, T1)
    second = read_star(spark, dwh)
    assert {n: df.count() for n, df in second.items()} == first
    assert second["f_order"].filter(F.col("load_dttm") == F.lit(T1)).count() == first["f_order"]


def _empty_other_sources(spark, wide):
    from atelier.sources.fixtures import source_tables  # noqa: F401  (shape reference)

    empty = wide.limit(0)
    return {
        "source2.craft_market_masters_products": empty,
        "source2.craft_market_orders_customers": empty,
        "source3.craft_market_orders": empty,
        "source3.craft_market_craftsmans": empty,
        "source3.craft_market_customers": empty,
        "external_source.craft_products_orders": empty,
        "external_source.customers": empty,
    }


def test_load_rewrites_only_touched_months(spark, workdir):
    wide = fx.wide_orders(spark, SF_SMALL)
    keys = ["product_id", "craftsman_id", "customer_id", "order_created_date"]
    unique = wide.join(
        wide.groupBy(*keys).count().filter("count = 1").drop("count"), keys, "left_semi"
    )
    unique = materialize(unique, "unique-orders")
    dwh = f"{workdir}/dwh"
    run_load(spark, {"source1.craft_market_wide": unique, **_empty_other_sources(spark, unique)}, dwh, T0)
    before = current_commit(spark, f"{dwh}/f_order")
    n_before = read_star(spark, dwh)["f_order"].count()

    month = F.date_format("order_created_date", "yyyy-MM")
    one_month = unique.filter(month == "1995-03").withColumn("order_status", F.lit("done"))
    run_load(spark, {"source1.craft_market_wide": one_month, **_empty_other_sources(spark, unique)}, dwh, T1)
    after = current_commit(spark, f"{dwh}/f_order")

    changed = set(after["paths"]) - set(before["paths"])
    assert [p.rsplit("=", 1)[-1] for p in changed] == ["1995-03"]
    assert len(after["paths"]) == len(before["paths"])
    fo = read_star(spark, dwh)["f_order"]
    assert fo.count() == n_before
    touched = fo.filter(F.date_format("order_created_date", "yyyy-MM") == "1995-03")
    assert touched.filter(F.col("order_status") != "done").count() == 0
    assert touched.filter(F.col("load_dttm") != F.lit(T1)).count() == 0
    assert fo.filter(F.col("load_dttm") == F.lit(T1)).count() == one_month.count()


def test_incremental_refresh_writes_only_affected_customers(spark, workdir):
    from atelier.plans.refresh import mart_buckets, mart_partition
    from atelier.sources.tables import partition_value

    bucket_col = mart_partition(mart_buckets(spark))[0]

    dwh = f"{workdir}/dwh"
    run_load(spark, fx.source_tables(spark, SF_SMALL), dwh, T0)
    refresh_mart(spark, dwh, mode="full")
    before = current_commit(spark, f"{dwh}/{MART_TABLE}")
    full_rows = _business(read_table(spark, f"{dwh}/{MART_TABLE}", MART))
    mart_keys = read_table(spark, f"{dwh}/{MART_TABLE}", MART).select("customer_id", "report_period").collect()

    # One customer's orders are loaded again after the watermark, first as they were, then with another status.
    fo = read_star(spark, dwh)["f_order"]
    one = fo.select(F.min("customer_id")).first()[0]
    hit = F.col("customer_id") == one
    for stamp, status in ((dt.datetime(2024, 5, 1), F.col("order_status")), (dt.datetime(2024, 6, 1), F.lit("delivery"))):
        changed = fo.withColumn("load_dttm", F.when(hit, F.lit(stamp)).otherwise(F.col("load_dttm")))
        changed = changed.withColumn("order_status", F.when(hit, status).otherwise(F.col("order_status")))
        commit_orders(materialize(changed, "one-customer"), f"{dwh}/f_order", current_commit(spark, f"{dwh}/f_order")["max_id"])
        commit_star(spark, dwh, stamp)
        refresh_mart(spark, dwh, mode="incremental")
        after = current_commit(spark, f"{dwh}/{MART_TABLE}")
        if stamp.month == 5:
            assert after["paths"] == before["paths"]  # the same orders: nothing to write
            assert _business(read_table(spark, f"{dwh}/{MART_TABLE}", MART)) == full_rows

    # The buckets stay as they are; the change is one folder of that customer's rows.
    assert after["paths"][:-1] == before["paths"] and all(partition_value(p, bucket_col) for p in before["paths"])
    assert partition_value(after["paths"][-1], bucket_col) is None
    assert after["folders"][-1]["rows"] == sum(r[0] == one for r in mart_keys)
    incremental = _business(read_table(spark, f"{dwh}/{MART_TABLE}", MART))
    refresh_mart(spark, dwh, mode="full")
    assert _business(read_table(spark, f"{dwh}/{MART_TABLE}", MART)) == incremental != full_rows

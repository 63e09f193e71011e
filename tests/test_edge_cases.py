"""Edge cases of FIXTURES.md §4 on tiny hand-made frames."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from atelier.functions.conform import conform
from atelier.functions.dates import month_key
from atelier.operators import delta as delta_ops
from atelier.operators.keys import assign_ids
from atelier.operators.measures import category_counts, craftsman_counts, order_grain
from atelier.operators.quality import duplicate_keys, null_violations
from atelier.operators.ranking import (
    top_category_by_count,
    top_category_literal,
    top_craftsman_one,
    top_craftsman_ties,
)
from atelier.operators.star import order_rows
from atelier.operators.upsert import MergeConflict, merge_upsert, update_from
from atelier.plans.load import fact_key_lookup
from atelier.plans.mart import full_mart, incremental_mart, intended_mart, stored_mart
from atelier.plans.refresh import next_watermark
from atelier.schemas import D_CUSTOMER, MART
from atelier.sources.tables import stamp_literal
from tiny import NEW, OLD, D, order, star


def _mart(spark, orders, **kw):
    rows = intended_mart(star(spark, orders, **kw)).collect()
    return {(r.customer_id, r.report_period): r for r in rows}


# --- merge -------------------------------------------------------------------------
CUST_KEY = ["customer_name", "customer_email"]
CUST_SET = ["customer_address", "customer_birthday"]


def _customers(spark, rows):
    return spark.createDataFrame(rows, D_CUSTOMER)


def _source(spark, rows):
    schema = "customer_name string, customer_address string, customer_birthday date, customer_email string"
    return spark.createDataFrame(rows, schema)


def test_merge_null_key_never_matches(spark):
    target = _customers(spark, [(1, None, "a", D(1990, 1, 1), "e@x", OLD)])
    source = _source(spark, [(None, "b", D(1990, 1, 1), "e@x")])
    out = merge_upsert(target, source, CUST_KEY, CUST_SET, NEW, "customer_id").collect()
    assert sorted((r.customer_id, r.customer_address) for r in out) == [(1, "a"), (2, "b")]


def test_merge_two_sources_for_matched_target_is_error(spark):
    target = _customers(spark, [(1, "n", "a", D(1990, 1, 1), "e@x", OLD)])
    source = _source(spark, [("n", "b", D(1990, 1, 1), "e@x"), ("n", "c", D(1990, 1, 1), "e@x")])
    with pytest.raises(MergeConflict):
        merge_upsert(target, source, CUST_KEY, CUST_SET, NEW, "customer_id")


def test_merge_two_sources_for_unmatched_key_both_inserted(spark):
    target = _customers(spark, [(7, "other", "a", D(1990, 1, 1), "o@x", OLD)])
    source = _source(spark, [("n", "b", D(1990, 1, 1), "e@x"), ("n", "c", D(1990, 1, 1), "e@x")])
    out = merge_upsert(target, source, CUST_KEY, CUST_SET, NEW, "customer_id").collect()
    got = sorted((r.customer_id, r.customer_name, r.customer_address, r.load_dttm) for r in out)
    assert got == [(7, "other", "a", OLD), (8, "n", "b", NEW), (9, "n", "c", NEW)]


def test_merge_updates_matched_and_stamps_even_if_unchanged(spark):
    target = _customers(
        spark,
        [(1, "n", "a", D(1990, 1, 1), "e@x", OLD), (2, "m", "a", D(1990, 1, 1), "m@x", OLD)],
    )
    source = _source(spark, [("n", "a", D(1990, 1, 1), "e@x"), ("m", "z", D(1970, 1, 1), "m@x")])
    out = {r.customer_id: r for r in merge_upsert(target, source, CUST_KEY, CUST_SET, NEW, "customer_id").collect()}
    assert out[1].load_dttm == NEW and out[1].customer_address == "a"
    assert out[2].customer_address == "z" and out[2].customer_birthday == D(1970, 1, 1)
    assert len(out) == 2


def test_insert_columns_matched_by_name(spark):
    df = spark.createDataFrame(
        [("2024-01", 5, 10, "n", "a", "e", D(1990, 1, 1))],
        "report_period string, customer_id long, customer_costs long, customer_name string, "
        "customer_address string, customer_email string, customer_birthday date",
    )
    schema = T.StructType([MART[c] for c in ["customer_id", "customer_name", "customer_costs", "report_period"]])
    row = conform(df, schema).first()
    assert (row.customer_id, row.customer_name, row.customer_costs, row.report_period) == (5, "n", 10, "2024-01")


# --- measures ------------------------------------------------------------------------
def test_null_status_counts_in_total_only(spark):
    m = _mart(spark, [(1, 1, 1, 10, D(2024, 1, 5), None, None), order(2, done_after=2)])
    r = m[(10, "2024-01")]
    assert r.total_order_count == 2
    assert r.count_order_done == 1
    assert r.count_order_not_done == 0
    assert r.count_order_created + r.count_order_in_progress + r.count_order_delivery == 0


def test_median_null_without_completed_orders(spark):
    r = _mart(spark, [order(1), order(2)])[(10, "2024-01")]
    assert r.median_time_order_completed is None


def test_median_interpolates_even_count(spark):
    r = _mart(spark, [order(1, done_after=1), order(2, done_after=2)])[(10, "2024-01")]
    assert r.median_time_order_completed == 1.5


def test_fee_rounds_half_up(spark):
    products = [(1, "p1", "d1", "cat-a", 125, OLD)]
    r = _mart(spark, [order(1)], products=products)[(10, "2024-01")]
    assert r.customer_costs == 125 and r.platform_money == 13


def test_average_rounded_once_half_up(spark):
    products = [(1, "p1", "d1", "cat-a", 1, OLD), (2, "p2", "d2", "cat-b", 0, OLD)]
    orders = [order(1, product=1)] + [order(i, product=2) for i in range(2, 9)]
    r = _mart(spark, orders, products=products)[(10, "2024-01")]
    assert r.avg_order_price == 0.13  # 1 / 8 = 0.125
    stored = stored_mart(full_mart(star(spark, orders, products=products))).first()
    assert stored.avg_order_price == Decimal("0.13")


def test_month_key_is_year_month(spark):
    df = spark.createDataFrame([(D(2024, 3, 9),)], "d date")
    assert df.select(month_key("d").alias("m")).first().m == "2024-03"


# --- ranking --------------------------------------------------------------------------
def _grain(spark, orders, **kw):
    s = star(spark, orders, **kw)
    return order_grain(order_rows(s["f_order"], s["d_craftsman"], s["d_product"]))


def test_craftsman_tie_intended_smallest_literal_all(spark):
    g = _grain(spark, [order(1, craftsman=2), order(2, craftsman=1)])
    assert top_craftsman_one(craftsman_counts(g)).first().top_craftsman_id == 1
    ties = sorted(r.top_craftsman_id for r in top_craftsman_ties(craftsman_counts(g)).collect())
    assert ties == [1, 2]


def test_category_by_count_differs_from_literal_by_name(spark):
    orders = [order(1, product=1), order(2, product=1), order(3, product=2)]
    g = _grain(spark, orders)  # cat-a twice, cat-b once
    keys = ["customer_id", "report_period"]
    assert top_category_by_count(category_counts(g, keys), keys).first().top_product_category == "cat-a"
    assert top_category_literal(category_counts(g, ["customer_id"])).first().top_product_category == "cat-b"


def test_null_category_first_under_desc_literal(spark):
    products = [(1, "p1", "d1", None, 100, OLD), (2, "p2", "d2", "cat-b", 200, OLD)]
    g = _grain(spark, [order(1, product=1), order(2, product=2)], products=products)
    assert top_category_literal(category_counts(g, ["customer_id"])).first().top_product_category is None


# --- delta / incremental ---------------------------------------------------------------
def test_empty_log_gives_default_watermark(spark):
    empty = spark.createDataFrame([], "id long, load_dttm timestamp")
    assert delta_ops.read_watermark(empty) == dt.date(1900, 1, 1)
    assert delta_ops.read_watermark(None) == dt.date(1900, 1, 1)


def test_load_exactly_at_watermark_is_excluded(spark):
    wm = dt.datetime(2023, 6, 1)
    s = star(spark, [(*order(1), wm), (*order(2), dt.datetime(2023, 6, 2))])
    assert sorted(r.customer_id for r in delta_ops.affected_customers(s, wm).collect()) == [10]
    keys = spark.createDataFrame([], "customer_id long, report_period string")
    assert [r.order_id for r in delta_ops.delta_pruned(s, keys, wm).collect()] == [2]


def test_changed_product_price_affects_all_its_buyers(spark):
    wm = dt.datetime(2023, 6, 1)
    products = [(1, "p1", "d1", "cat-a", 100, NEW), (2, "p2", "d2", "cat-b", 200, OLD)]
    s = star(spark, [order(1, customer=10), order(2, customer=11, product=1), order(3, product=2)], products=products)
    assert sorted(r.customer_id for r in delta_ops.affected_customers(s, wm).collect()) == [10, 11]


def test_existing_customer_new_month_is_inserted(spark):
    wm = dt.datetime(2023, 6, 1)
    old_orders = [order(1, created=D(2024, 1, 5))]
    before = full_mart(star(spark, old_orders))
    new_orders = old_orders + [(*order(2, created=D(2024, 2, 5)), NEW)]
    after = incremental_mart(before, star(spark, new_orders), wm)
    periods = sorted((r.id, r.report_period) for r in after.collect())
    assert periods == [(1, "2024-01"), (2, "2024-02")]


def test_empty_delta_keeps_mart_and_watermark(spark):
    wm = dt.datetime(2023, 6, 1)
    s = star(spark, [order(1), order(2, customer=11)])
    before = full_mart(s)
    after = incremental_mart(before, s, wm)
    assert sorted(after.collect()) == sorted(before.collect())
    commits = {name: {"folders": [{"high": stamp_literal(OLD)}, {"high": None}]} for name in s}
    assert next_watermark(commits, wm) == wm
    assert next_watermark({"t": {"folders": [{"high": stamp_literal(NEW)}]}}, wm) == NEW


def test_duplicate_natural_key_in_dimension_multiplies_and_is_reported(spark):
    stage = spark.createDataFrame(
        [(1, D(2024, 1, 1), None, "created", 1, "c1", "a", D(1980, 1, 1), "c1@x",
          1, "p1", "d1", "t", 100, 1, "u", "a", D(1990, 1, 1), "u@x")],
        "order_id long, order_created_date date, order_completion_date date, order_status string, "
        "craftsman_id long, craftsman_name string, craftsman_address string, craftsman_birthday date, "
        "craftsman_email string, product_id long, product_name string, product_description string, "
        "product_type string, product_price long, customer_id long, customer_name string, "
        "customer_address string, customer_birthday date, customer_email string",
    )
    dims = {
        "d_craftsman": spark.createDataFrame([(1, "c1", "c1@x"), (2, "c1", "c1@x")], "craftsman_id long, craftsman_name string, craftsman_email string"),
        "d_customer": spark.createDataFrame([(1, "u", "u@x")], "customer_id long, customer_name string, customer_email string"),
        "d_product": spark.createDataFrame([(1, "p1", "d1", 100)], "product_id long, product_name string, product_description string, product_price long"),
    }
    assert fact_key_lookup(stage, dims).count() == 2
    dups = duplicate_keys(dims["d_craftsman"], ["craftsman_name", "craftsman_email"]).collect()
    assert [(r.craftsman_name, r.rows_per_key) for r in dups] == [("c1", 2)]


def test_update_from_picks_latest_period(spark):
    target = spark.createDataFrame([(1, 10, "2024-01", 5), (2, 10, "2024-02", 6)], "id long, customer_id long, report_period string, v long")
    source = spark.createDataFrame([(10, "2024-01", 50), (10, "2024-03", 70)], "customer_id long, report_period string, v long")
    out = update_from(target, source, ["customer_id"], ["report_period", "v"], pick_by=["report_period"])
    assert sorted(out.collect()) == [(1, 10, "2024-03", 70), (2, 10, "2024-03", 70)]


def test_null_violations_report(spark):
    df = spark.createDataFrame([(1, None), (None, None)], "a long, b string")
    got = {r.column_name: r.null_rows for r in null_violations(df, ["a", "b"]).collect()}
    assert got == {"a": 1, "b": 2}


def test_surrogate_keys_equal_row_number(spark):
    df = spark.range(0, 5000).select(((F.col("id") * 7919) % 5000).alias("k"), (F.col("id") % 3).alias("g"))
    ids = assign_ids(df, ["k"], "sk", base=100, num_partitions=7)
    rows = ids.collect()
    assert sorted(r.sk for r in rows) == list(range(101, 5101))
    assert all(r.sk == 101 + r.k for r in rows)

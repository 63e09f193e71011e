"""What the load's lookups, the mart and the affected customers shuffle, on rows made here."""

from __future__ import annotations

import datetime as dt

import pytest

import __spark_entry__  # noqa: F401
from atelier import queries as Q
from atelier.operators import delta, maintained
from atelier.operators.measures import order_grain
from atelier.operators.star import counted_orders, order_rows
from atelier.plans.load import fact_key_lookup
from atelier.plans.mart import mart_of_grain
from paths import SF_SMALL

DAY = dt.date(2020, 1, 1)
EARLIER, LATER = dt.date(2000, 1, 1), dt.date(2021, 1, 1)


@pytest.fixture
def joined_by_shuffles(spark):
    kept = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield
    for k, v in kept.items():
        spark.conf.set(k, v)


def exchanges(df) -> list[str]:
    """The keys of the plan's hash exchanges, from the last to the first."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [part.split(")")[0] for part in plan.split("Exchange hashpartitioning(")[1:]]


def star_of(spark) -> dict:
    orders = [
        # order_id, product_id, craftsman_id, customer_id, load_dttm
        (1, 1, 1, 1, EARLIER),
        (2, 2, 1, 2, EARLIER),
        (None, 1, 1, 3, LATER),
        (4, 1, 2, 4, EARLIER),
        (5, 1, 1, None, LATER),
        (6, 1, 1, 5, None),
        (7, None, None, 6, EARLIER),
        (7, None, None, 6, EARLIER),
    ]
    rows = [(o, p, c, u, DAY, DAY + dt.timedelta(days=k % 3) if k % 2 else None, "done" if k % 2 else "created", s) for k, (o, p, c, u, s) in enumerate(orders)]
    f_order = spark.createDataFrame(
        rows,
        "order_id long, product_id long, craftsman_id long, customer_id long, order_created_date date, order_completion_date date, "
        "order_status string, load_dttm date",
    )
    customers = [(k, f"n{k}", f"a{k}", DAY, f"e{k}", LATER if k == 6 else EARLIER) for k in range(1, 8)]
    return {
        "f_order": f_order,
        "d_craftsman": spark.createDataFrame([(1, EARLIER), (2, LATER)], "craftsman_id long, load_dttm date"),
        "d_product": spark.createDataFrame(
            [(1, 5, "a", EARLIER), (2, 7, None, LATER), (3, 1, "c", LATER)], "product_id long, product_price long, product_type string, load_dttm date"
        ),
        "d_customer": spark.createDataFrame(
            customers, "customer_id long, customer_name string, customer_address string, customer_birthday date, customer_email string, load_dttm date"
        ),
    }


def test_lookup_resolves_the_widest_key_first(spark, joined_by_shuffles):
    stage = spark.createDataFrame(
        [("c", "ce", "u", "ue", "p", "pd", 5, DAY, DAY, "done"), ("c", "ce", None, "ue", "p", "pd", 5, DAY, DAY, "done")],
        "craftsman_name string, craftsman_email string, customer_name string, customer_email string, product_name string, "
        "product_description string, product_price long, order_created_date date, order_completion_date date, order_status string",
    )
    dims = {
        "d_craftsman": spark.createDataFrame([(1, "c", "ce")], "craftsman_id long, craftsman_name string, craftsman_email string"),
        "d_customer": spark.createDataFrame([(2, "u", "ue")], "customer_id long, customer_name string, customer_email string"),
        "d_product": spark.createDataFrame(
            [(3, "p", "pd", 5), (4, "p", "pd", 5)], "product_id long, product_name string, product_description string, product_price long"
        ),
    }
    found = fact_key_lookup(stage, dims)
    assert sorted(map(tuple, found.select("product_id", "craftsman_id", "customer_id").collect())) == [(3, 1, 2), (4, 1, 2)]
    # The last join is that with craftsmen: by then the products' strings have gone.
    keys = exchanges(found)
    assert keys[0].startswith("craftsman_name") and sum(k.startswith("product_name") for k in keys) == 2


def test_months_are_shuffled_once_by_customer_in_the_mart(spark, joined_by_shuffles):
    star = star_of(spark)
    mart = mart_of_grain(order_grain(order_rows(star["f_order"], star["d_craftsman"], star["d_product"])).localCheckpoint(), star["d_customer"])
    assert len(exchanges(mart)) == 6, exchanges(mart)
    rows = {r["customer_id"]: r for r in mart.collect()}
    assert sorted(rows) == [1, 2, 3, 4, 5]
    assert rows[2]["top_product_category"] is None and rows[2]["customer_address"] == "a2" and rows[4]["top_craftsman_id"] == 2


def test_counted_orders_give_the_same_grain(spark):
    star = star_of(spark)
    plain = order_grain(order_rows(star["f_order"], star["d_craftsman"], star["d_product"]))
    counted = order_grain(order_rows(counted_orders(star["f_order"]), star["d_craftsman"], star["d_product"]))
    assert sorted(map(str, plain.collect())) == sorted(map(str, counted.collect()))
    assert sum(r["n_orders"] for r in counted.collect()) == 5 and sum(r["n_rows"] for r in counted.collect()) == 6


def test_no_order_id_is_shuffled_for_the_state(spark, joined_by_shuffles):
    star = star_of(spark)
    plan = maintained.state_of(star | {"f_order": star["f_order"].repartition(2, "customer_id")})._jdf.queryExecution().optimizedPlan().toString()
    # The ids are looked at below the joins.
    joins = [k for k, line in enumerate(plan.splitlines()) if "Join" in line]
    assert max(joins) < min(k for k, line in enumerate(plan.splitlines()) if "isnotnull(order_id" in line)


def test_affected_customers_shuffle_no_orders_for_their_customers(spark, joined_by_shuffles):
    star = star_of(spark)
    affected = delta.affected_customers(star, DAY)
    flagged = delta.flag_changed_orders(star, DAY).select("customer_id").distinct()
    found = sorted((r[0] for r in affected.collect()), key=str)
    assert found == sorted((r[0] for r in flagged.collect()), key=str) == [2, 3, 4, 6, None]
    assert len(exchanges(affected)) == 6, exchanges(affected)


def test_queries_that_read_the_fact_again_read_it_written(spark):
    for state in Q._states(spark, SF_SMALL):
        assert "lineitem.parquet" not in state["f_order"]._jdf.queryExecution().executedPlan().toString()

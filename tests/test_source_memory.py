"""What a task holds of the rows of the source tables, on tables made here."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from atelier.operators import consolidate as cons
from atelier.sources import fixtures as fx
from test_shuffles import joined_by_shuffles  # noqa: F401

DAY = dt.datetime(1995, 3, 1)


@pytest.fixture
def odd_tables(spark, workdir):
    """Keys that come twice, with equal and with other values, and nulls; every line is in slice 1."""
    made = {
        "supplier": ([(1, "s1", 2), (1, "s1", 2), (1, "s1", None), (5, None, 3), (None, "s", 1)], "s_suppkey long, s_name string, s_nationkey int"),
        "part": (
            [(1, "p", "b", "t", 10.5), (1, "p", "b", "t", 10.75), (2, None, None, "t", None), (2, "p", "b", None, 3.0), (None, "p", "b", "t", 1.0)],
            "p_partkey long, p_name string, p_brand string, p_type string, p_retailprice double",
        ),
        "customer": ([(1, "c1", 1), (2, None, None), (2, "c2", 1)], "c_custkey long, c_name string, c_nationkey int"),
        "orders": ([(1, 1, DAY), (2, 2, None), (2, 2, DAY), (3, None, DAY)], "o_orderkey long, o_custkey long, o_orderdate timestamp"),
        "lineitem": (
            [(o, p, s, "R", "F") for o in (1, 2, 3, None) for p in (1, 2, None) for s in (1, 5, None)] * 2,
            "l_orderkey long, l_partkey long, l_suppkey long, l_returnflag string, l_linestatus string",
        ),
    }
    for name, (rows, schema) in made.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{workdir}/{name}.parquet")
    return workdir


def test_masters_products_are_distinct_with_copies_and_nulls(spark, odd_tables):
    found = fx.source_tables(spark, odd_tables)[cons.SOURCE2_MASTERS_PRODUCTS]
    lines = fx._joined_lines(spark, odd_tables, "part", 1).select(*fx._craftsman_attrs(), *fx._product_attrs())
    expected = lines.distinct().collect()
    assert lines.count() > len(expected) == 3 * 3
    assert found.columns == lines.columns
    assert sorted(map(str, found.collect())) == sorted(map(str, expected))


def test_masters_products_are_held_in_one_sort_that_the_join_uses(spark, odd_tables, joined_by_shuffles):  # noqa: F811
    sources = fx.source_tables(spark, odd_tables)
    joined = cons.join_source2(sources[cons.SOURCE2_MASTERS_PRODUCTS], sources[cons.SOURCE2_ORDERS_CUSTOMERS])
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" not in plan, plan
    sorts = [line.split("Sort [")[1] for line in plan.splitlines() if " Sort [" in line and "product_id" in line]
    assert len(sorts) == 2 and all(s.startswith("product_id") for s in sorts), sorts
    assert joined.agg(F.count(F.lit(1))).first()[0] > 0

"""All registered queries of the core vs their DuckDB oracle on sf0.01."""

from __future__ import annotations

import pytest

import __spark_entry__ as E
from compare import compare, duck
from atelier.oracle import SQL
from paths import SF_ORACLE

@pytest.fixture(scope="module")
def con():
    return duck(SF_ORACLE)


def test_every_query_has_an_oracle():
    from atelier.queries import all_queries

    assert set(all_queries()) == set(SQL) and set(SQL) <= set(E.oracle_sql())


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_oracle(spark, con, name):
    res = compare(E.queries()[name](spark, SF_ORACLE), con, E.oracle_sql()[name])
    assert res["columns_match"], (res["spark_cols"], res["duck_cols"])
    assert res["rows_spark"] == res["rows_duck"]
    assert res["values_match"], (res["only_spark"], res["only_duck"])


def test_entry_runs_on_sf0001(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "id" in df.columns and "report_period" in df.columns


def test_done_plus_not_done_is_total_without_null_status(spark):
    from pyspark.sql import functions as F

    m = E.queries()["customer_month_measures"](spark, "/root/testdata/sf0.001")
    bad = m.filter(
        F.col("count_order_done") + F.col("count_order_not_done") != F.col("total_order_count")
    ).count()
    assert bad == 0
    parts = (
        F.col("count_order_created")
        + F.col("count_order_in_progress")
        + F.col("count_order_delivery")
        + F.col("count_order_done")
    )
    assert m.filter(parts != F.col("total_order_count")).count() == 0

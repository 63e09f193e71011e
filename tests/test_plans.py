"""Plan shape, checked on the executed (adaptive, final) plan after an action."""

from __future__ import annotations

import pytest

import __spark_entry__ as E
from paths import SF_SMALL

PYTHON_NODES = ("BatchEvalPython", "ArrowEvalPython", "PythonUDF", "MapInPandas", "FlatMapGroupsInPandas")


def executed(df) -> str:
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def plans(spark):
    q = E.queries()
    names = [
        "top_craftsman_ties",
        "delta_pruned",
        "mart_full",
        "surrogate_keys",
        "merge_product",
        "diag_global_rank",
        "customer_month_measures",
    ]
    return {n: executed(q[n](spark, SF_SMALL)) for n in names}


def test_no_python_evaluation(plans):
    for name, plan in plans.items():
        assert not any(node in plan for node in PYTHON_NODES), name


def test_ties_need_no_window(plans):
    assert "Window" not in plans["top_craftsman_ties"]


def test_scans_read_only_needed_columns(plans):
    plan = plans["customer_month_measures"]
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint,l_suppkey:bigint" in plan
    for unused in ("l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_shipdate"):
        assert unused not in plan


def test_measures_aggregate_partially_before_shuffle(plans):
    plan = plans["customer_month_measures"]
    assert "partial_count" in plan and "partial_sum" in plan


def test_mart_rollups_read_the_checkpointed_grain(plans):
    # After the grain checkpoint the mart plan no longer scans the driver tables.
    assert "lineitem.parquet" not in plans["mart_full"]


def test_no_key_set_is_gathered_in_one_task(plans):
    for name in ("delta_pruned", "diag_global_rank"):
        assert "SinglePartition" not in plans[name], name


def test_surrogate_keys_use_range_partitioning_not_one_task(plans):
    plan = plans["surrogate_keys"]
    # Ids are numbered from the written, range-partitioned table, with no
    # window at all: offsets come from per-partition counts.
    assert "FileScan parquet" in plan and "_pos" in plan
    assert "Window [" not in plan
    assert "SinglePartition" not in plan


def test_pruned_delta_scans_the_fact_once(spark, workdir):
    from atelier.operators.delta import delta_pruned
    from atelier.sources import fixtures as fx

    star = {}
    for name, df in fx.star_schema(spark, SF_SMALL).items():
        df.write.parquet(f"{workdir}/{name}")
        star[name] = spark.read.parquet(f"{workdir}/{name}")
    fx.existing_mart_keys(star["f_order"]).write.parquet(f"{workdir}/mart_keys")
    keys = spark.read.parquet(f"{workdir}/mart_keys")
    plan = executed(delta_pruned(star, keys, fx.FIXTURE_WATERMARK))
    final = plan.split("== Initial Plan ==")[0]
    assert final.count(f"{workdir}/f_order") == 1


def test_delta_shuffles_the_orders_once_by_product_and_customers_last(spark):
    """Without broadcasts, flags and star join share the orders' places by product, star join and multiplicity those by customer."""
    from atelier.operators import delta
    from atelier.sources import fixtures as fx

    kept = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        star = fx.star_schema(spark, SF_SMALL)
        rows = delta.delta_pruned(star, fx.existing_mart_keys(star["f_order"]), fx.FIXTURE_WATERMARK)
        plan = rows._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in kept.items():
            spark.conf.set(k, v)
    assert plan.count("Exchange hashpartitioning") == 17, plan


def test_stage_rows_are_not_shuffled_by_all_their_columns(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        stage = E.queries()["stage_union_distinct"](spark, SF_SMALL)
        plan = stage._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    keys = [part.split(")")[0] for part in plan.split("Exchange hashpartitioning(")[1:]]
    assert keys and not [k for k in keys if "order_id" in k]
    # Strings made of the given columns are made after the joins that move order rows by part.
    assert not [k for k in keys if "product_name" in k]

"""What stays on disk of a step that has been written, and what the source tables are read from, on tables made here."""

from __future__ import annotations

import datetime as dt
import glob
import time

import pytest
from pyspark.sql import functions as F

import __spark_entry__  # noqa: F401
from atelier import queries as Q
from atelier.operators import consolidate as cons
from atelier.session import SHUFFLE_CLEANUP_CONF, checkpoint_root, freed_shuffles, materialize
from atelier.sources import fixtures as fx
from test_shuffles import joined_by_shuffles  # noqa: F401

DAY = dt.datetime(1995, 3, 1)


def shuffle_files(spark) -> set[str]:
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {name for k in range(files.size()) if (name := files.apply(k).getName()).startswith("shuffle_")}


def left_of(spark, earlier: set[str]) -> set[str]:
    """Shuffle files since ``earlier``; they are removed soon after a command, not in it."""
    for _ in range(50):
        if not (left := shuffle_files(spark) - earlier):
            break
        time.sleep(0.2)
    return left


@pytest.fixture
def four_slices(spark, workdir):
    """Lines of all slices; keys that come twice, with equal and other values, and nulls; lines without an order, supplier, part or customer."""
    made = {
        "supplier": ([(k, f"s{k}", k % 2) for k in range(1, 6)] + [(4, "s4", 0), (6, "s6", None), (6, None, 1), (None, "s", 1)], "s_suppkey long, s_name string, s_nationkey int"),
        "part": (
            [(1, "p", "b", "t", 10.5), (1, "p", "b", "t", 10.75), (1, "q", "b", "t", 3.0), (2, None, None, "t", None), (None, "p", "b", "t", 1.0)],
            "p_partkey long, p_name string, p_brand string, p_type string, p_retailprice double",
        ),
        "customer": ([(1, "c1", 1), (1, "c1", 1), (2, None, None), (2, "c2", 1), (9, "c9", 1)], "c_custkey long, c_name string, c_nationkey int"),
        "orders": ([(1, 1, DAY), (2, 2, None), (2, 2, DAY), (3, None, DAY), (4, 7, DAY)], "o_orderkey long, o_custkey long, o_orderdate timestamp"),
        "lineitem": (
            [(o, p, s, r, "F") for o in (1, 2, 3, 4, 5, None) for p in (1, 2, 3, None) for s in (1, 2, 3, 4, 5, 6, 7, None) for r in ("R", "R", "N")],
            "l_orderkey long, l_partkey long, l_suppkey long, l_returnflag string, l_linestatus string",
        ),
    }
    for name, (rows, schema) in made.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{workdir}/{name}.parquet")
    return workdir


def test_written_steps_leave_no_shuffle_files(spark, joined_by_shuffles):  # noqa: F811
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    numbers, earlier = spark.range(100), shuffle_files(spark)
    counted = numbers.join(numbers.select(F.col("id"), F.lit(1).alias("one")), "id").groupBy((F.col("id") % 7).alias("k")).count()
    kept = spark.conf.get(SHUFFLE_CLEANUP_CONF)
    written = materialize(counted, "counted")
    assert not left_of(spark, earlier)
    assert written.agg(F.sum("count")).first()[0] == 100
    assert spark.conf.get(SHUFFLE_CLEANUP_CONF) == kept


def test_the_setting_comes_back_when_the_last_of_several_writes_ends(spark):
    kept = spark.conf.get(SHUFFLE_CLEANUP_CONF)
    first, second = freed_shuffles(spark), freed_shuffles(spark)
    first.__enter__()
    second.__enter__()
    first.__exit__(None, None, None)
    assert spark.conf.get(SHUFFLE_CLEANUP_CONF) == "true"
    second.__exit__(None, None, None)
    assert spark.conf.get(SHUFFLE_CLEANUP_CONF) == kept


def test_source_tables_are_columns_of_lines_joined_once(spark, four_slices, joined_by_shuffles):  # noqa: F811
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    earlier = shuffle_files(spark)
    sources = fx.source_tables(spark, four_slices)
    assert not left_of(spark, earlier)
    for name, df in sources.items():
        assert "lineitem.parquet" not in df._jdf.queryExecution().executedPlan().toString(), name


def test_source_tables_have_the_rows_of_the_joined_tables(spark, four_slices):
    order, craftsman, product, customer = fx._order_attrs(), fx._craftsman_attrs(), fx._product_attrs(), fx._customer_attrs()
    ids = {k: F.col(c).alias(f"{k}_id") for k, c in (("product", "p_partkey"), ("craftsman", "s_suppkey"), ("customer", "c_custkey"))}
    expected = {
        cons.SOURCE1_WIDE: ([*order, *craftsman, *product, *customer], (0, 1), False),
        cons.SOURCE2_MASTERS_PRODUCTS: ([*craftsman, *product], (1,), True),
        cons.SOURCE2_ORDERS_CUSTOMERS: ([*order, *customer, ids["product"], ids["craftsman"]], (1,), False),
        cons.SOURCE3_ORDERS: ([*order, *product, ids["craftsman"], ids["customer"]], (2,), False),
        cons.SOURCE3_CRAFTSMEN: (craftsman, (2,), True),
        cons.SOURCE3_CUSTOMERS: (customer, (2,), True),
        cons.EXTERNAL_ORDERS: ([*order, *craftsman, *product, ids["customer"]], (3,), False),
        cons.EXTERNAL_CUSTOMERS: (customer, (3,), True),
    }
    found = fx.source_tables(spark, four_slices)
    assert list(found) == list(expected)
    for name, (columns, slices, distinct) in expected.items():
        rows = fx._joined_lines(spark, four_slices, "part", *slices).select(*columns)
        rows = rows.distinct() if distinct else rows
        assert found[name].schema.names == rows.schema.names and [f.dataType for f in found[name].schema] == [f.dataType for f in rows.schema], name
        assert sorted(map(str, found[name].collect())) == sorted(map(str, rows.collect())) != [], name
        alone = fx.source_tables(spark, four_slices, name)
        assert list(alone) == [name] and alone[name].count() == rows.count()


@pytest.fixture
def many_lines(spark, workdir):
    """4,000 lines of 1,000 orders, each key once; 97 suppliers, 89 parts and 83 customers."""
    lines = spark.range(4000)
    tables = {
        "supplier": spark.range(97).selectExpr("id as s_suppkey", "concat('s', id) as s_name", "cast(id % 5 as int) as s_nationkey"),
        "part": spark.range(89).selectExpr(
            "id as p_partkey", "concat('p', id % 9) as p_name", "concat('b', id % 7) as p_brand", "concat('t', id % 11) as p_type", "id * 1.5D as p_retailprice"
        ),
        "customer": spark.range(83).selectExpr("id as c_custkey", "concat('c', id) as c_name", "cast(id % 5 as int) as c_nationkey"),
        "orders": spark.range(1000).selectExpr(
            "id as o_orderkey", "id % 83 as o_custkey", "cast(date_add(date'1996-01-01', cast(id * 2 as int)) as timestamp) as o_orderdate"
        ),
        "lineitem": lines.selectExpr(
            "id % 1000 as l_orderkey", "id % 89 as l_partkey", "(id * 7) % 97 as l_suppkey", "element_at(array('R', 'A', 'N'), cast(1 + id % 3 as int)) as l_returnflag",
            "if(id % 2 = 0, 'F', 'O') as l_linestatus",
        ),
    }
    for name, df in tables.items():
        df.write.parquet(f"{workdir}/{name}.parquet")
    return workdir


def shuffled_bytes(spark, earlier: set[str]) -> int:
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    files = [files.apply(k) for k in range(files.size())]
    return sum(f.length() for f in files if f.getName().startswith("shuffle_") and f.getName().endswith(".data") and f.getName() not in earlier)


def scratch_folders(spark, label: str) -> list[str]:
    return glob.glob(f"{checkpoint_root(spark).removeprefix('file:')}/atelier-{label}-*")


@pytest.mark.parametrize("name", ["merge_order_clustered", "merge_order", "mart_incremental", "fact_key_lookup", "fact_key_lookup_fractional"])
def test_shuffles_of_earlier_steps_have_gone(spark, many_lines, joined_by_shuffles, name):  # noqa: F811
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    earlier, sources = shuffle_files(spark), scratch_folders(spark, "source-lines")
    result = Q.all_queries()[name](spark, many_lines)
    time.sleep(2)
    left = shuffled_bytes(spark, earlier)
    # What is left are the counts of a few collected groups: no shuffle of the lines.
    assert left < 50_000, left
    assert scratch_folders(spark, "source-lines") == sources
    assert name == "mart_incremental" or result.count() == 4000


@pytest.mark.parametrize("name", ["fact_key_lookup", "fact_key_lookup_fractional"])
def test_lookups_read_a_written_stage(spark, many_lines, name):
    files = Q.all_queries()[name](spark, many_lines).inputFiles()
    assert any("atelier-tmp-sources" in f for f in files)
    assert not [f for f in files if "lineitem.parquet" in f or "source-lines" in f]

"""Nothing is lost silently: failing reads, fractional prices, stamps, half-done loads, foreign sessions."""

from __future__ import annotations

import datetime as dt
import subprocess
import sys
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from atelier.functions.conform import exact
from atelier.plans import load
from atelier.plans.refresh import MART_TABLE, completion_marker, refresh_mart
from atelier.schemas import F_ORDER, MART, PRICE, WIDE_COLS
from atelier.sources import fixtures as fx
from atelier.sources import tables
from atelier.sources.readers import SOURCE_COLUMNS, check_source, read_source
from atelier.sources.star import newest_manifest, read_star
from paths import ROOT, SF_SMALL

T0, T1, T2 = (dt.datetime(2024, m, 1) for m in (1, 2, 3))


def wide_row(order_id, price, customer="ann", day=1, status="done"):
    row = {c: f"{c} value" for c in WIDE_COLS}
    row |= {"order_id": order_id, "craftsman_id": 1, "product_id": order_id, "customer_id": 1}
    row |= {c: dt.date(1990, 1, 1) for c in ("craftsman_birthday", "customer_birthday")}
    row |= {"order_created_date": dt.date(2024, 1, day), "order_completion_date": dt.date(2024, 1, day + 3), "order_status": status}
    return row | {"product_name": f"product {order_id}", "product_price": price, "customer_name": customer, "customer_email": f"{customer}@x"}


def sources(spark, rows):
    kinds = fx.wide_orders(spark, SF_SMALL).schema
    for field in kinds:
        if field.name == "product_price":
            field.dataType = PRICE
    wide = spark.createDataFrame([tuple(r[f.name] for f in kinds) for r in rows], kinds)
    names = list(SOURCE_COLUMNS)
    return {names[0]: wide} | {n: wide.limit(0) for n in names[1:]}


def rows_of(*prices, **more):
    return [wide_row(k + 1, Decimal(p), **more) for k, p in enumerate(prices)]


def test_fractional_prices_keep_every_order(spark, workdir):
    load.run_load(spark, sources(spark, rows_of("12.50", "10.00", "7.25")), workdir, T0)
    assert read_star(spark, workdir)["f_order"].count() == 3
    assert {r[0] for r in read_star(spark, workdir)["d_product"].select("product_price").collect()} == {Decimal("12.50"), Decimal("10.00"), Decimal("7.25")}
    result = refresh_mart(spark, workdir)
    mart = tables.read_table(spark, f"{workdir}/{MART_TABLE}", MART).collect()
    assert [(r.customer_costs, r.platform_money, r.total_order_count, r.avg_order_price) for r in mart] == [(30, 3, 3, Decimal("9.92"))]
    assert completion_marker(spark, result).first().status == "increment datamart"


def test_a_key_is_never_rounded(spark):
    df = spark.createDataFrame([(1.25,), (None,), (0.1,)], "product_price double")
    assert [r[0] for r in exact(df, "product_price", PRICE).collect()] == [Decimal("1.25"), None, Decimal("0.10")]
    with pytest.raises(Exception, match="unchanged"):
        exact(spark.createDataFrame([(1.255,)], "product_price double"), "product_price", PRICE).collect()


def test_a_failing_log_read_raises_and_changes_nothing(spark, workdir, monkeypatch):
    load.run_load(spark, sources(spark, rows_of("1.00")), workdir, T0)

    def broken(*_):
        raise OSError("storage timed out")

    monkeypatch.setattr(tables, "path_exists", broken)
    with pytest.raises(OSError):
        tables.current_commit(spark, f"{workdir}/f_order")
    with pytest.raises(OSError):
        load.commit_orders(read_star(spark, workdir)["f_order"], f"{workdir}/f_order", 1)
    monkeypatch.undo()
    assert tables.current_commit(spark, f"{workdir}/f_order")["version"] == 1


def test_a_failing_partition_read_raises_and_changes_nothing(spark, workdir, monkeypatch):
    load.run_load(spark, sources(spark, rows_of("1.00", "2.00")), workdir, T0)

    def broken(*_):
        raise OSError("storage timed out")

    monkeypatch.setattr(tables, "_written_folders", broken)
    with pytest.raises(OSError):
        load.run_load(spark, sources(spark, rows_of("1.00", "3.00")), workdir, T1)
    monkeypatch.undo()
    star = read_star(spark, workdir)
    assert star["f_order"].count() == 2 and star["d_product"].count() == 2  # the last complete load
    load.run_load(spark, sources(spark, rows_of("1.00", "3.00")), workdir, T1)  # the retry
    assert read_star(spark, workdir)["f_order"].count() == 3


def test_an_equal_stamp_is_refused(spark, workdir):
    load.run_load(spark, sources(spark, rows_of("1.00")), workdir, T1)
    for stamp in (T1, T0):
        with pytest.raises(ValueError, match="isn't after"):
            load.run_load(spark, sources(spark, rows_of("1.00", "2.00")), workdir, stamp)
    assert newest_manifest(spark, workdir)["number"] == 1


def test_a_refresh_between_a_loads_commits_misses_nothing(spark, workdir, monkeypatch):
    load.run_load(spark, sources(spark, rows_of("1.00")), workdir, T0)
    refresh_mart(spark, workdir)
    whole = load.load_orders

    def refresh_first(*args):
        refresh_mart(spark, workdir)
        return whole(*args)

    monkeypatch.setattr(load, "load_orders", refresh_first)
    load.run_load(spark, sources(spark, rows_of("1.00", "2.00")), workdir, T1)
    monkeypatch.undo()
    refresh_mart(spark, workdir)
    assert tables.read_table(spark, f"{workdir}/{MART_TABLE}", MART).first().total_order_count == 2


def test_empty_partitioned_commit_has_no_folders(spark, workdir):
    load.commit_orders(spark.createDataFrame([], F_ORDER), f"{workdir}/f_order", 0)
    assert tables.read_table(spark, f"{workdir}/f_order", F_ORDER).count() == 0


def test_create_stage_and_append(spark, workdir):
    root = f"{workdir}/t"
    assert tables.create_table(spark, F_ORDER, root) == 1
    rows = fx.star_schema(spark, SF_SMALL)["f_order"].limit(5)
    assert tables.append_rows(spark, root, rows, F_ORDER) == 2
    assert tables.stage(tables.read_table(spark, root, F_ORDER), "staged_orders").count() == 5
    assert spark.table("staged_orders").filter(F.col("order_id").isNotNull()).count() == 5
    spark.table("staged_orders").unpersist()


def test_source_readers(spark, workdir):
    name = list(SOURCE_COLUMNS)[0]
    frame = sources(spark, rows_of("1.50"))[name]
    frame.write.orc(f"{workdir}/{name}")
    assert read_source(spark, name, workdir, "orc").count() == 1
    with pytest.raises(ValueError, match="product_price"):
        check_source(frame.drop("product_price"), name)
    with pytest.raises(ValueError, match="customer_birthday string"):
        check_source(frame.withColumn("customer_birthday", F.lit("x")), name)


def test_a_foreign_session_keeps_its_settings():
    code = (
        "from pyspark.sql import SparkSession as S\n"
        "S.builder.master('local[3]').config('spark.ui.enabled','false').config('spark.sql.shuffle.partitions','777').getOrCreate()\n"
        "from atelier.session import get_session\n"
        "s = get_session()\n"
        "print('KEPT', s.sparkContext.master, s.conf.get('spark.sql.shuffle.partitions'))\n"
    )
    out = subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True, timeout=120)
    assert "KEPT local[3] 777" in out.stdout


def test_a_cluster_needs_a_shared_folder(spark, monkeypatch):
    from atelier import session

    class Context:
        master = "spark://somewhere:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

        class conf:
            @staticmethod
            def get(key, default=None):
                return default

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.checkpoint_root(Session())

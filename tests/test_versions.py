"""Versions: racing writers, repeated loads, change feeds, maintained state, merge modes, checks and retention."""

from __future__ import annotations

import datetime as dt
import random
from concurrent.futures import ThreadPoolExecutor
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from atelier.operators import maintained, upsert
from atelier.plans import load
from atelier.plans import refresh as refresh_plan
from atelier.plans.mart import full_mart
from atelier.plans.refresh import MART_TABLE, MOST_CHANGES, STATE_TABLE, WATERMARK_TABLE, refresh_mart
from atelier.schemas import D_CUSTOMER, F_ORDER, MART, MART_BUSINESS_COLS, WATERMARK_LOG
from atelier.sources import tables
from atelier.sources.retention import retain
from atelier.sources.star import commit_star, newest_manifest, read_star, star_commits
from test_recovery import rows_of, sources, wide_row

T0, T1, T2 = (dt.datetime(2024, m, 1) for m in (1, 2, 3))


def orders(spark, *rows):
    """Rows (id, product, craftsman, customer, created, status, stamp)."""
    data = [(i, p, c, u, day, None if s != "done" else day + dt.timedelta(days=i % 9), s, at) for i, p, c, u, day, s, at in rows]
    return spark.createDataFrame(data, F_ORDER)


# Racing writers


def test_of_two_overwrites_of_one_version_one_fails(spark, workdir):
    root = f"{workdir}/t"
    tables.create_table(spark, WATERMARK_LOG, root)
    frame = spark.createDataFrame([(1, T0)], WATERMARK_LOG)

    def write(_):
        try:
            return tables.commit_version(frame, root, WATERMARK_LOG, after=1)
        except tables.CommitConflict as error:
            return error

    with ThreadPoolExecutor(4) as pool:
        results = list(pool.map(write, range(4)))
    assert results.count(2) == 1 and sum(isinstance(r, tables.CommitConflict) for r in results) == 3
    assert tables.versions(spark, root) == [1, 2]
    assert tables.read_table(spark, root, WATERMARK_LOG).count() == 1


def test_racing_appends_are_all_kept(spark, workdir):
    root = f"{workdir}/t"
    tables.create_table(spark, WATERMARK_LOG, root)

    def append(k):
        return tables.append_rows(spark, root, spark.createDataFrame([(k, T0)], WATERMARK_LOG), WATERMARK_LOG, max_id=k)

    with ThreadPoolExecutor(6) as pool:
        got = list(pool.map(append, range(1, 7)))
    assert sorted(got) == [2, 3, 4, 5, 6, 7]
    assert {r.id for r in tables.read_table(spark, root, WATERMARK_LOG).collect()} == set(range(1, 7))
    assert tables.current_commit(spark, root)["max_id"] == 6


def test_many_appends_stay_few_folders(spark, workdir, monkeypatch):
    monkeypatch.setattr(tables, "MOST_FOLDERS", 3)
    root = f"{workdir}/t"
    for k in range(8):
        tables.append_rows(spark, root, spark.createDataFrame([(k, T0)], WATERMARK_LOG), WATERMARK_LOG)
    assert len(tables.current_commit(spark, root)["folders"]) <= 4
    assert sorted(r.id for r in tables.read_table(spark, root, WATERMARK_LOG).collect()) == list(range(8))


def test_of_two_loads_at_once_one_counts(spark, workdir):
    load.run_load(spark, sources(spark, rows_of("1.00")), workdir, T0)
    feeds = {T1: sources(spark, rows_of("1.00", "2.00")), T2: sources(spark, rows_of("1.00", "3.00", "4.00"))}

    def run(stamp):
        try:
            return load.run_load(spark, feeds[stamp], workdir, stamp)
        except (tables.CommitConflict, ValueError) as error:
            return error

    with ThreadPoolExecutor(2) as pool:
        results = dict(zip(feeds, pool.map(run, feeds), strict=True))
    won = [stamp for stamp, r in results.items() if isinstance(r, dict)]
    assert len(won) >= 1
    wanted = 2 if won == [T1] else 3 if won == [T2] else 4  # one after the other: both
    assert read_star(spark, workdir)["f_order"].count() == wanted


# Loads that are repeated after a failure


def failing_orders(monkeypatch):
    def broken(*_):
        raise OSError("storage timed out")

    monkeypatch.setattr(load, "load_orders", broken)


def test_a_repeated_load_inserts_a_row_without_a_key_once(spark, workdir, monkeypatch):
    rows = [wide_row(k, Decimal("1.00"), customer=c) | ({"customer_email": None} if c == "ben" else {}) for k, c in ((1, "ann"), (2, "ben"))]
    failing_orders(monkeypatch)
    with pytest.raises(OSError):
        load.run_load(spark, sources(spark, rows), workdir, T0)
    monkeypatch.undo()
    load.run_load(spark, sources(spark, rows), workdir, T0)
    assert sorted(r.customer_name for r in read_star(spark, workdir)["d_customer"].collect()) == ["ann", "ben"]
    ids = [r.customer_id for r in read_star(spark, workdir)["d_customer"].collect()]
    assert sorted(ids) == [1, 2]


def test_a_repeated_load_with_two_rows_of_a_new_key_succeeds(spark, workdir, monkeypatch):
    rows = [wide_row(k, Decimal("1.00")) | {"customer_address": f"address {k}"} for k in (1, 2)]
    load.run_load(spark, sources(spark, [wide_row(9, Decimal("5.00"), customer="zoe")]), workdir, T0)
    failing_orders(monkeypatch)
    with pytest.raises(OSError):
        load.run_load(spark, sources(spark, rows), workdir, T1)
    monkeypatch.undo()
    load.run_load(spark, sources(spark, rows), workdir, T1)
    star = read_star(spark, workdir)
    assert star["d_customer"].count() == 3 and newest_manifest(spark, workdir)["number"] == 2
    # Each order meets both customers of its key, as the join by natural key says.
    assert star["f_order"].count() == 5


# M5 modes


def customers(spark, *rows):
    return spark.createDataFrame([(*r, T0) for r in rows], D_CUSTOMER)


def test_latest_row_counts(spark):
    target = customers(spark, (1, "ann", "old", None, "a@x"), (2, None, "kept", None, "n@x"))
    rows = [("ann", "b", None, "a@x", 1), ("ann", "a", None, "a@x", 2), ("ann", "c", None, "a@x", 2), ("new", "x", None, "n", 1), ("new", "y", None, "n", 0)]
    rows += [(None, "p", None, "n@x", 1), (None, "p", None, "n@x", 2)]
    source = spark.createDataFrame(rows, "customer_name string, customer_address string, customer_birthday date, customer_email string, seen int")
    keys, values = ["customer_name", "customer_email"], ["customer_address", "customer_birthday"]
    for some in (source, source.repartition(5, "seen"), source.orderBy(F.desc("customer_address"))):
        got = upsert.merge_upsert(target, some, keys, values, T1, "customer_id", on_conflict="latest", latest_by=["seen"])
        assert sorted((r.customer_id, r.customer_name or "", r.customer_address) for r in got.collect()) == [
            (1, "ann", "c"), (2, "", "kept"), (3, "new", "x"), (4, "", "p"), (5, "", "p"),
        ]
    with pytest.raises(upsert.MergeConflict):
        upsert.merge_upsert(target, source, keys, values, T1, "customer_id")
    with pytest.raises(ValueError, match="on_conflict"):
        upsert.merge_upsert(target, source, keys, values, T1, "customer_id", on_conflict="any")


def test_unchanged_rows_keep_their_stamp(spark):
    day = dt.date(1990, 1, 1)
    target = customers(spark, (1, "same", "a", None, "e"), (2, "other", "a", day, "e"), (3, "now null", "a", day, "e"), (4, "absent", "a", day, "e"))
    source = spark.createDataFrame(
        [("same", "a", None, "e"), ("other", "b", day, "e"), ("now null", "a", None, "e")],
        "customer_name string, customer_address string, customer_birthday date, customer_email string",
    )
    got = upsert.merge_upsert(
        target, source, ["customer_name", "customer_email"], ["customer_address", "customer_birthday"], T1, "customer_id", only_if_changed=True
    )
    assert {r.customer_id: r.load_dttm for r in got.collect()} == {1: T0, 2: T1, 3: T1, 4: T0}


def test_a_reload_of_the_same_changes_nothing_where_asked(spark, workdir):
    feed = sources(spark, rows_of("1.00", "2.00", "3.00"))
    load.run_load(spark, feed, workdir, T0)
    refresh_mart(spark, workdir)
    load.run_load(spark, feed, workdir, T1, load.Modes(only_if_changed=True))
    star = read_star(spark, workdir)
    assert all(df.filter(F.col("load_dttm") > F.lit(T0)).count() == 0 for df in star.values())
    before, after = (star_commits(spark, workdir, n) for n in (1, 2))
    assert refresh_plan.feed_folders(before, after, T0)[0] == []  # by the stamps in the commits, no folder is read
    assert refresh_mart(spark, workdir)["watermark"] == T0


# P7 and the change feed


def test_folders_carry_their_stamps(spark, workdir):
    root = f"{workdir}/f"
    rows = [(k, 1, 1, k, dt.date(2024, 1 + k % 3, 1), "done", T0 if k % 3 else T2) for k in range(9)]
    load.commit_orders(orders(spark, *rows), root, 9)
    commit = tables.current_commit(spark, root)
    assert {f["path"].rsplit("=")[-1]: f["rows"] for f in commit["folders"]} == {"2024-01": 3, "2024-02": 3, "2024-03": 3}
    since = tables.folders_since(commit["folders"], T1)
    assert [f["path"].rsplit("=")[-1] for f in since] == ["2024-01"]
    assert tables.newest_stamp(commit["folders"]) == T2
    assert tables.folders_since(commit["folders"], dt.date(2024, 3, 1)) == []


def test_the_refresh_reads_only_written_folders(spark, workdir, monkeypatch):
    months = [wide_row(k, Decimal("1.00"), day=k) | {"order_created_date": dt.date(2024, k, 1), "order_completion_date": dt.date(2024, k, 9)} for k in range(1, 10)]
    load.run_load(spark, sources(spark, months), workdir, T0)
    refresh_mart(spark, workdir)
    load.run_load(spark, sources(spark, [months[4] | {"order_status": "delivery"}]), workdir, T1)
    read = []
    whole = refresh_plan.read_paths
    monkeypatch.setattr(refresh_plan, "read_paths", lambda s, paths, schema: (read.extend(paths if schema == F_ORDER else []), whole(s, paths, schema))[1])
    refresh_mart(spark, workdir)
    assert [p.rsplit("=")[-1] for p in read] == ["2024-05", "2024-05"]  # now and before
    mart = tables.read_table(spark, f"{workdir}/{MART_TABLE}", MART)
    assert {r.report_period: r.count_order_delivery for r in mart.collect()} == {f"2024-{k:02d}": int(k == 5) for k in range(1, 10)}


# Maintained state


def random_star(rng, spark, state, stamp):
    """The star after some random changes; ``state`` holds its rows between calls."""
    statuses = ["created", "in progress", "delivery", "done", None]
    for _ in range(rng.randint(1, 12)):
        k = len(state["orders"]) + 1
        state["orders"][k] = [k, rng.randint(1, 6), rng.randint(1, 4), rng.randint(1, 9), dt.date(2024, rng.randint(1, 12), 3), rng.choice(statuses), stamp]
    for k in rng.sample(sorted(state["orders"]), min(len(state["orders"]), rng.randint(0, 6))):
        state["orders"][k][5:] = [rng.choice(statuses), stamp]
    if rng.random() < 0.6:
        p = rng.randint(1, 6)
        state["products"][p] = [p, f"p{p}", "d", rng.choice(["x", "y", "z", None]), Decimal(p) + Decimal("0.25"), stamp]
    if rng.random() < 0.6:
        u = rng.randint(1, 9)
        state["customers"][u] = [u, f"c{u}", f"address {rng.random()}", None, f"c{u}@x", stamp]


def commit_state(spark, dwh, state, stamp):
    from atelier.sources.star import STAR_TABLES

    tables.commit_version(spark.createDataFrame(list(map(tuple, state["products"].values())), STAR_TABLES["d_product"]), f"{dwh}/d_product", STAR_TABLES["d_product"])
    tables.commit_version(spark.createDataFrame(list(map(tuple, state["customers"].values())), D_CUSTOMER), f"{dwh}/d_customer", D_CUSTOMER)
    if not tables.versions(spark, f"{dwh}/d_craftsman"):
        crafts = [(k, f"k{k}", None, None, None, stamp) for k in range(1, 5)]
        tables.commit_version(spark.createDataFrame(crafts, STAR_TABLES["d_craftsman"]), f"{dwh}/d_craftsman", STAR_TABLES["d_craftsman"])
    load.commit_orders(orders(spark, *state["orders"].values()), f"{dwh}/f_order", len(state["orders"]))
    commit_star(spark, dwh, stamp)


def mart_rows(df):
    return sorted(df.select(*MART_BUSINESS_COLS).collect(), key=str)


@pytest.mark.parametrize("seed", [1, 2])
def test_random_changes_refresh_to_the_full_mart(spark, workdir, seed, monkeypatch):
    monkeypatch.setattr(refresh_plan, "MOST_CHANGES", 2)
    rng = random.Random(seed)
    stamp = dt.datetime(2024, 1, 1)
    state = {
        "orders": {},
        "products": {p: [p, f"p{p}", "d", "x", Decimal(p), stamp] for p in range(1, 7)},
        "customers": {u: [u, f"c{u}", "a", None, f"c{u}@x", stamp] for u in range(1, 10)},
    }
    ids = {}
    for step in range(6):
        stamp += dt.timedelta(days=1)
        random_star(rng, spark, state, stamp)
        commit_state(spark, workdir, state, stamp)
        result = refresh_mart(spark, workdir)
        assert result["mode"] == ("incremental" if step else "full") and result["watermark"] == stamp
        mart = tables.read_table(spark, f"{workdir}/{MART_TABLE}", MART).cache()
        wanted = tables.conform(full_mart(read_star(spark, workdir)), MART)
        assert mart_rows(mart) == mart_rows(wanted)
        now = {(r.customer_id, r.report_period): r.id for r in mart.collect()}
        assert len(set(now.values())) == len(now) and all(now[k] == v for k, v in ids.items())
        ids = now
    folders = tables.current_commit(spark, f"{workdir}/{STATE_TABLE}")["folders"]
    assert sum("customer_bucket" not in f["path"] for f in folders) <= 2


def test_a_crash_before_the_states_commit_is_repeated(spark, workdir, monkeypatch):
    load.run_load(spark, sources(spark, rows_of("1.00")), workdir, T0)
    refresh_mart(spark, workdir)
    load.run_load(spark, sources(spark, rows_of("1.00", "2.00")), workdir, T1)

    def broken(*_, **__):
        raise OSError("storage timed out")

    monkeypatch.setattr(refresh_plan, "next_watermark", broken)
    with pytest.raises(OSError):
        refresh_mart(spark, workdir)
    monkeypatch.undo()
    refresh_mart(spark, workdir)
    rows = tables.read_table(spark, f"{workdir}/{MART_TABLE}", MART).collect()
    assert [(r.total_order_count, r.customer_costs) for r in rows] == [(2, 3)]
    assert tables.read_table(spark, f"{workdir}/{WATERMARK_TABLE}", WATERMARK_LOG).count() == 2


def test_counts_that_fall_to_zero_go(spark):
    counts = spark.createDataFrame([(1, 7, 2), (1, 8, 1), (2, 7, 5)], "customer_id long, craftsman_id long, craftsman_count long")
    change = spark.createDataFrame([(1, 7, -2), (1, 9, 1)], counts.schema)
    assert sorted(map(tuple, maintained.maintained_counts(counts, change).collect())) == [(1, 8, 1), (1, 9, 1)]


def test_a_change_writes_the_affected_customers_only(spark, workdir):
    load.run_load(spark, sources(spark, [wide_row(k, Decimal("1.00"), customer=f"c{k}") for k in range(1, 30)]), workdir, T0)
    refresh_mart(spark, workdir)
    load.run_load(spark, sources(spark, [wide_row(5, Decimal("1.00"), customer="c5", status="delivery")]), workdir, T1)
    refresh_mart(spark, workdir)
    mart = tables.current_commit(spark, f"{workdir}/{MART_TABLE}")
    state = tables.current_commit(spark, f"{workdir}/{STATE_TABLE}")
    assert mart["folders"][-1]["rows"] == 1 and state["folders"][-1]["rows"] == 1  # one group with other counts
    assert tables.read_table(spark, f"{workdir}/{MART_TABLE}", MART).count() == 29
    assert MOST_CHANGES >= 1


# Q1-Q4 as a condition of the commit


def test_a_violated_check_leaves_the_old_version(spark, workdir):
    load.run_load(spark, sources(spark, rows_of("1.00")), workdir, T0)
    refresh_mart(spark, workdir)
    rows = [wide_row(2, Decimal("2.00"), customer="ben") | {"customer_address": None}]
    load.run_load(spark, sources(spark, rows), workdir, T1)
    before = tables.current_commit(spark, f"{workdir}/{MART_TABLE}")
    for mode in ("incremental", "full"):
        with pytest.raises(tables.CheckFailed, match="customer_address is null"):
            refresh_mart(spark, workdir, mode=mode, checked=True)
        assert tables.current_commit(spark, f"{workdir}/{MART_TABLE}") == before
    refresh_mart(spark, workdir)
    assert tables.read_table(spark, f"{workdir}/{MART_TABLE}", MART).count() == 2


def test_a_value_beyond_its_type_fails_the_check(spark, workdir):
    from atelier.operators.quality import row_checks

    checks = row_checks([], WATERMARK_LOG)
    frame = spark.createDataFrame([(Decimal(10) ** 25, T0)], "id decimal(38,0), load_dttm timestamp")
    with pytest.raises(Exception, match="CAST_OVERFLOW|id isn't bigint"):
        tables.commit_version(frame, f"{workdir}/t", WATERMARK_LOG, checks=checks)
    assert tables.current_commit(spark, f"{workdir}/t") is None


# Retention


def data_folders(workdir):
    import glob
    import os

    found = glob.glob(f"{workdir}/*/data-*")
    parts = [p for f in found for p in glob.glob(f"{f}/*=*")]
    return {f for f in found if not any(p.startswith(f"{f}{os.sep}") for p in parts)} | set(parts)


def test_only_referenced_folders_stay(spark, workdir, monkeypatch):
    for k, stamp in enumerate((T0, T1, T2), 1):
        load.run_load(spark, sources(spark, rows_of(*["1.00"] * k)), workdir, stamp)
        refresh_mart(spark, workdir)
    failing_orders(monkeypatch)
    with pytest.raises(OSError):
        load.run_load(spark, sources(spark, rows_of("9.00")), workdir, dt.datetime(2024, 5, 1))
    monkeypatch.undo()
    star = {n: sorted(map(str, df.collect())) for n, df in read_star(spark, workdir).items()}
    mart = mart_rows(tables.read_table(spark, f"{workdir}/{MART_TABLE}", MART))
    assert retain(spark, workdir, keep=1) == []  # all too young
    gone = retain(spark, workdir, keep=1, min_age=dt.timedelta(0))
    assert gone
    assert {n: sorted(map(str, df.collect())) for n, df in read_star(spark, workdir).items()} == star
    assert mart_rows(tables.read_table(spark, f"{workdir}/{MART_TABLE}", MART)) == mart
    used = set()
    for table in ("d_craftsman", "d_product", "d_customer", "f_order", MART_TABLE, STATE_TABLE, WATERMARK_TABLE):
        for version in tables.versions(spark, f"{workdir}/{table}"):
            for f in tables.commit_of_version(spark, f"{workdir}/{table}", version)["folders"]:
                used |= {p for p in (f["path"], f.get("replaces")) if p}
    assert data_folders(workdir) == used
    # What stays is enough to go on.
    load.run_load(spark, sources(spark, rows_of("1.00", "1.00", "1.00", "4.00")), workdir, dt.datetime(2024, 6, 1))
    assert refresh_mart(spark, workdir)["mode"] == "incremental"
    assert tables.read_table(spark, f"{workdir}/{MART_TABLE}", MART).first().total_order_count == 4


def test_jobs_leave_no_scratch(spark, workdir):
    import os

    from atelier.session import checkpoint_root

    root = checkpoint_root(spark).removeprefix("file:")
    before = set(os.listdir(root)) if os.path.isdir(root) else set()
    load.run_load(spark, sources(spark, rows_of("1.00")), workdir, T0)
    refresh_mart(spark, workdir)
    assert {n for n in set(os.listdir(root)) - before if n.startswith("atelier-")} == set()

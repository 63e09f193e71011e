"""Registered queries: one callable (spark, sf_dir) -> DataFrame per operator.

Every query reads the driver tables through the fixture mapping
(``atelier.sources.fixtures``) over whole tables, so its work grows with
them. Fractional measures are reported as exact-rounded doubles
(``report_types``); stored tables keep their declared decimal types.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from atelier.functions.conform import report_types
from atelier.functions.measures import fee_rounded
from atelier.operators import consolidate as cons
from atelier.operators import delta as delta_ops
from atelier.operators import diagnostics as diag
from atelier.operators import maintained, quality, upsert
from atelier.operators.keys import assign_ids
from atelier.operators.measures import (
    category_counts,
    craftsman_counts,
    finish_measures,
    month_measures,
    order_grain,
)
from atelier.operators.ranking import (
    top_category_by_count,
    top_category_literal,
    top_craftsman_one,
    top_craftsman_ties,
)
from atelier.operators.star import order_rows
from atelier.plans import load
from atelier.plans import mart as mart_plan
from atelier.schemas import D_CUSTOMER, F_ORDER, MART, MART_BUSINESS_COLS, MART_NOT_NULL, ORDER_KEY, PRICE
from atelier.session import materialize, scratch_dir, scratch_scope
from atelier.sources import changes, tables
from atelier.sources import fixtures as fx
from atelier.sources.clustered import Clustering

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}
CUSTOMER_MONTH = ["customer_id", "report_period"]


def register(name: str) -> Callable[[Query], Query]:
    def deco(fn: Query) -> Query:
        REGISTRY[name] = fn
        return fn

    return deco


def _grain(spark: SparkSession, sf_dir: str) -> DataFrame:
    star = fx.star_schema(spark, sf_dir)
    return order_grain(order_rows(star["f_order"], star["d_craftsman"], star["d_product"]))


# --- C8 / A1-A7 -----------------------------------------------------------------
@register("customer_month_measures")
def q_customer_month_measures(spark: SparkSession, sf_dir: str) -> DataFrame:
    return finish_measures(month_measures(_grain(spark, sf_dir), CUSTOMER_MONTH))


# --- W1-W4 ----------------------------------------------------------------------
@register("top_craftsman_ties")
def q_top_craftsman_ties(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_craftsman_ties(craftsman_counts(_grain(spark, sf_dir)))


@register("top_craftsman_one")
def q_top_craftsman_one(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_craftsman_one(craftsman_counts(_grain(spark, sf_dir)))


@register("top_category_literal")
def q_top_category_literal(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_category_literal(category_counts(_grain(spark, sf_dir), ["customer_id"]))


@register("top_category_by_count")
def q_top_category_by_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = category_counts(_grain(spark, sf_dir), CUSTOMER_MONTH)
    return top_category_by_count(counts, CUSTOMER_MONTH)


# --- C11 / C12 --------------------------------------------------------------------
@register("mart_full")
def q_mart_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report_types(mart_plan.full_mart(fx.star_schema(spark, sf_dir)))


# --- S1, J1-J3, X1, A12 ------------------------------------------------------
def _sources(spark: SparkSession, sf_dir: str, *names: str) -> dict[str, DataFrame]:
    return fx.source_tables(spark, sf_dir, *names)


def _stage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cons.consolidate_sources(_sources(spark, sf_dir))


def _stored_stage(spark: SparkSession, sf_dir: str, columns: list[str]) -> DataFrame:
    """Columns of the stage, written as the load does it: neither what it was made of nor its shuffles stay beside those of later steps."""
    path = scratch_dir(spark, "tmp-sources")
    with scratch_scope(spark):
        return tables.write_stage(_stage(spark, sf_dir).select(*columns), path)


@register("src_wide")
def q_src_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cons.scan_wide(_sources(spark, sf_dir, cons.SOURCE1_WIDE)[cons.SOURCE1_WIDE])


@register("src2_join")
def q_src2_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    src = _sources(spark, sf_dir, cons.SOURCE2_MASTERS_PRODUCTS, cons.SOURCE2_ORDERS_CUSTOMERS)
    return cons.join_source2(src[cons.SOURCE2_MASTERS_PRODUCTS], src[cons.SOURCE2_ORDERS_CUSTOMERS])


@register("src3_join")
def q_src3_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    src = _sources(spark, sf_dir, cons.SOURCE3_ORDERS, cons.SOURCE3_CRAFTSMEN, cons.SOURCE3_CUSTOMERS)
    return cons.join_source3(
        src[cons.SOURCE3_ORDERS], src[cons.SOURCE3_CRAFTSMEN], src[cons.SOURCE3_CUSTOMERS]
    )


@register("src_external_join")
def q_src_external_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    src = _sources(spark, sf_dir, cons.EXTERNAL_ORDERS, cons.EXTERNAL_CUSTOMERS)
    return cons.join_external(src[cons.EXTERNAL_ORDERS], src[cons.EXTERNAL_CUSTOMERS])


@register("stage_union_distinct")
def q_stage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stage(spark, sf_dir)


@register("dim_craftsman_distinct")
def q_dim_craftsman(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cons.dimension_rows(_stage(spark, sf_dir), load.CRAFTSMAN_ATTRS)


@register("dim_product_distinct")
def q_dim_product(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cons.dimension_rows(_stage(spark, sf_dir), load.PRODUCT_ATTRS)


@register("dim_customer_distinct")
def q_dim_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cons.dimension_rows(_stage(spark, sf_dir), load.CUSTOMER_ATTRS)


# --- M1-M5, K1, J4 -------------------------------------------------------------
# A dimension row counts as loaded by an earlier run when its fixture load
# date is on or before PRIOR_LOAD; the merge stamps AS_OF.
PRIOR_LOAD = dt.date(1998, 1, 1)
AS_OF = dt.date(2024, 1, 1)


def _prior(df: DataFrame) -> DataFrame:
    return df.filter(F.col("load_dttm") <= F.lit(PRIOR_LOAD))


def _merge_dim(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    star = fx.star_schema(spark, sf_dir)
    return load.merge_dimension(_prior(star[name]), _stage(spark, sf_dir), name, AS_OF)


@register("merge_craftsman")
def q_merge_craftsman(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _merge_dim(spark, sf_dir, "d_craftsman")


@register("merge_product")
def q_merge_product(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _merge_dim(spark, sf_dir, "d_product")


@register("merge_customer")
def q_merge_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _merge_dim(spark, sf_dir, "d_customer")


@register("fact_key_lookup")
def q_fact_key_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load.fact_key_lookup(_stored_stage(spark, sf_dir, load.LOOKUP_COLS), fx.star_schema(spark, sf_dir))


def _fractional(df: DataFrame) -> DataFrame:
    """The fixture's prices with quarters added by product id, as decimals."""
    return df.withColumn("product_price", (F.col("product_price") + F.col("product_id") % 4 * F.lit(0.25)).cast(PRICE))


@register("merge_product_fractional")
def q_merge_product_fractional(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = _fractional(_prior(fx.star_schema(spark, sf_dir)["d_product"]))
    return report_types(load.merge_dimension(target, _fractional(_stage(spark, sf_dir)), "d_product", AS_OF))


@register("fact_key_lookup_fractional")
def q_fact_key_lookup_fractional(spark: SparkSession, sf_dir: str) -> DataFrame:
    star = fx.star_schema(spark, sf_dir)
    stage = _fractional(_stored_stage(spark, sf_dir, ["product_id", *load.LOOKUP_COLS]))
    return load.fact_key_lookup(stage, dict(star, d_product=_fractional(star["d_product"])))


def _earlier_orders(star: dict[str, DataFrame]) -> DataFrame:
    """Orders created before 1997 were loaded earlier, still in status 'created'."""
    earlier = star["f_order"].filter(F.col("order_created_date") < F.lit(dt.date(1997, 1, 1)))
    return earlier.select(
        "order_id",
        "product_id",
        "craftsman_id",
        "customer_id",
        "order_created_date",
        F.lit(None).cast("date").alias("order_completion_date"),
        F.lit("created").alias("order_status"),
        "load_dttm",
    )


@register("merge_order")
def q_merge_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    star = fx.star_schema(spark, sf_dir)
    return load.merge_orders(_earlier_orders(star), _stored_stage(spark, sf_dir, load.LOOKUP_COLS), star, AS_OF)


@register("merge_conflicts")
def q_merge_conflicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Products keyed with the brand alone as description collide (M5)."""
    brand = F.substring_index(F.col("product_description"), " ", 1).alias("product_description")
    stage = _stage(spark, sf_dir)
    source = stage.select("product_name", brand, "product_type", "product_price").distinct()
    target = fx.star_schema(spark, sf_dir)["d_product"].select(
        "product_name", brand, "product_price"
    )
    return upsert.merge_conflicts(target, source, ["product_name", "product_description", "product_price"])


@register("surrogate_keys")
def q_surrogate_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = cons.dimension_rows(_stage(spark, sf_dir), load.CUSTOMER_ATTRS)
    return assign_ids(
        rows, ["customer_name", "customer_email", "customer_address", "customer_birthday"], "customer_id"
    )


# --- C4-C7, C13 ------------------------------------------------------------------
WATERMARK = fx.FIXTURE_WATERMARK
NOW = dt.datetime(2024, 1, 1)


def _delta_inputs(spark: SparkSession, sf_dir: str):
    star = fx.star_schema(spark, sf_dir)
    return star, fx.existing_mart_keys(star["f_order"])


def _delta(spark: SparkSession, sf_dir: str) -> DataFrame:
    star, keys = _delta_inputs(spark, sf_dir)
    return delta_ops.delta_pruned(star, keys, WATERMARK)


def watermark_log(star: dict[str, DataFrame]) -> DataFrame:
    """A log of earlier monthly refreshes: the day after each order month ends."""
    runs = star["f_order"].select(
        F.add_months(F.trunc("order_created_date", "month"), 1).alias("load_dttm")
    ).distinct()
    return assign_ids(runs, ["load_dttm"], "id")


@register("watermark_read")
def q_watermark_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    return delta_ops.watermark_frame(watermark_log(fx.star_schema(spark, sf_dir)))


@register("delta_literal")
def q_delta_literal(spark: SparkSession, sf_dir: str) -> DataFrame:
    star, keys = _delta_inputs(spark, sf_dir)
    return delta_ops.delta_literal(star, keys, WATERMARK)


@register("delta_pruned")
def q_delta_pruned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _delta(spark, sf_dir)


@register("affected_customers")
def q_affected_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return delta_ops.affected_customers(fx.star_schema(spark, sf_dir), WATERMARK)


@register("existing_delta_customers")
def q_existing_delta_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C7 as written: customer ids of delta rows already in the mart (row count kept)."""
    _, existing = delta_ops.split_new_existing(_delta(spark, sf_dir))
    return existing.groupBy("customer_id").agg(F.sum("mart_row_multiplicity").alias("delta_rows"))


@register("delta_new_customers")
def q_delta_new_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return delta_ops.split_new_existing(_delta(spark, sf_dir))[0]


@register("delta_existing_customers")
def q_delta_existing_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return delta_ops.split_new_existing(_delta(spark, sf_dir))[1]


@register("watermark_advance_literal")
def q_watermark_advance_literal(spark: SparkSession, sf_dir: str) -> DataFrame:
    return delta_ops.advance_watermark_literal(_delta(spark, sf_dir), NOW)


@register("watermark_advance")
def q_watermark_advance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return delta_ops.advance_watermark(_delta(spark, sf_dir), WATERMARK)


# --- C11 literal, U1 -----------------------------------------------------------
@register("mart_insert_literal")
def q_mart_insert_literal(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mart_plan.literal_results(_delta(spark, sf_dir))[0]


@register("mart_update_literal")
def q_mart_update_literal(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mart_plan.literal_results(_delta(spark, sf_dir))[1]


def _old_mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mart before the refresh: right values for the existing keys, ids in period order."""
    star, keys = _delta_inputs(spark, sf_dir)
    rows = mart_plan.intended_mart(star).join(keys, CUSTOMER_MONTH, "left_semi")
    return mart_plan.with_mart_ids(rows)


def _update_literal(spark: SparkSession, sf_dir: str) -> DataFrame:
    old = _old_mart(spark, sf_dir)
    upd = mart_plan.literal_results(_delta(spark, sf_dir))[1]
    return upsert.update_from(old, upd, ["customer_id"], MART_BUSINESS_COLS, pick_by=["report_period", "top_craftsman_id"])


@register("update_from_literal")
def q_update_from_literal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """U1 as written (keyed on customer only); the latest period's row, then the greatest craftsman id's, is applied."""
    return _update_literal(spark, sf_dir)


@register("update_from_by_customer_month")
def q_update_from_by_customer_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    old = _old_mart(spark, sf_dir)
    upd = mart_plan.literal_results(_delta(spark, sf_dir))[1]
    return upsert.update_from(old, upd, CUSTOMER_MONTH, MART_BUSINESS_COLS, pick_by=["top_craftsman_id"])


# --- C12 incremental ---------------------------------------------------------------
def previous_star(star: dict[str, DataFrame], watermark) -> dict[str, DataFrame]:
    """The star schema before the changes after ``watermark``.

    Dimension rows loaded after the watermark get their earlier values back
    (price one lower, address marked old); facts are unchanged.
    """
    changed = F.col("load_dttm") > F.lit(watermark)
    prev = dict(star)
    prev["d_product"] = star["d_product"].withColumn(
        "product_price", F.when(changed, F.col("product_price") - 1).otherwise(F.col("product_price"))
    )
    prev["d_customer"] = star["d_customer"].withColumn(
        "customer_address",
        F.when(changed, F.concat(F.lit("old-"), F.col("customer_address"))).otherwise(
            F.col("customer_address")
        ),
    )
    return prev


def _stored_star(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The star with its fact written once, for queries that read the fact several times."""
    star = fx.star_schema(spark, sf_dir)
    return star | {"f_order": materialize(star["f_order"], "orders")}


@register("mart_incremental")
def q_mart_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Full refresh of the earlier state, then an incremental refresh to now."""
    star = _stored_star(spark, sf_dir)
    before = mart_plan.full_mart(previous_star(star, WATERMARK))
    after = mart_plan.incremental_mart(before, star, WATERMARK)
    return report_types(after.select(*MART_BUSINESS_COLS))


# --- C5, C12, A6, W1, W4 from a change feed and maintained state -----------------------
def _states(spark: SparkSession, sf_dir: str) -> tuple[dict[str, DataFrame], dict[str, DataFrame]]:
    star = _stored_star(spark, sf_dir)
    return changes.star_before(star), changes.star_after(star)


def _feed(before: dict[str, DataFrame], after: dict[str, DataFrame]) -> tuple[DataFrame, DataFrame]:
    """The feed where the load has written the whole fact anew."""
    return maintained.order_feed(after["f_order"], before["f_order"], changes.CHANGED_AFTER)


def _state_change(before: dict[str, DataFrame], after: dict[str, DataFrame]) -> DataFrame:
    products = maintained.other_values(
        before["d_product"], after["d_product"], "product_id", maintained.PRODUCT_VALUES, changes.CHANGED_AFTER
    )
    plus, minus = maintained.with_orders_of(materialize(products, "products"), *_feed(before, after), before["f_order"], after["f_order"])
    return materialize(maintained.feed_change(plus, minus, before, after), "change")


@register("order_change_feed")
def q_order_change_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Changed orders as they are now (1) and as they were (-1)."""
    columns = ["order_id", "customer_id", "craftsman_id", "product_id", "order_created_date", "order_completion_date", "order_status"]
    plus, minus = _feed(*_states(spark, sf_dir))
    return plus.select(F.lit(1).alias("sign"), *columns).unionByName(minus.select(F.lit(-1).alias("sign"), *columns))


@register("state_change")
def q_state_change(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The net change of the order grain, with groups taken back."""
    return _state_change(*_states(spark, sf_dir))


@register("mart_maintained")
def q_mart_maintained(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mart before the load, refreshed from the state and its change; ids included."""
    before, after = _states(spark, sf_dir)
    state = materialize(maintained.state_of(before), "state")
    mart = mart_plan.with_mart_ids(mart_plan.mart_of_grain(state, before["d_customer"]))
    change = _state_change(before, after)
    moved = maintained.other_values(
        before["d_customer"], after["d_customer"], "customer_id", maintained.CUSTOMER_VALUES, changes.CHANGED_AFTER
    )
    affected = materialize(change.select("customer_id").unionByName(moved).distinct(), "affected")
    touched = state.join(affected, "customer_id", "left_semi").unionByName(change)
    grain = materialize(maintained.standing(touched), "grain")
    return report_types(mart_plan.replace_customers(mart, mart_plan.mart_of_grain(grain, after["d_customer"]), affected)[0])


def _maintained_top(spark: SparkSession, sf_dir: str, rank) -> DataFrame:
    before, after = _states(spark, sf_dir)
    counts = materialize(craftsman_counts(maintained.state_of(before)), "counts")
    return maintained.maintained_top(rank(counts), counts, maintained.craftsman_change(_state_change(before, after)), rank)


@register("top_craftsman_maintained_ties")
def q_top_craftsman_maintained_ties(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _maintained_top(spark, sf_dir, top_craftsman_ties)


@register("top_craftsman_maintained_one")
def q_top_craftsman_maintained_one(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _maintained_top(spark, sf_dir, top_craftsman_one)


# --- M5 modes --------------------------------------------------------------------------
@register("merge_customer_latest")
def q_merge_customer_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every customer comes three times, twice with the latest stamp; of these the greatest address, then birthday, counts."""
    rows = cons.dimension_rows(_stage(spark, sf_dir), load.CUSTOMER_ATTRS)
    by_key = F.substring("customer_name", -1, 1).cast("int") % 5
    later = rows.withColumn("customer_address", F.concat(F.lit("new-"), "customer_address"))
    again = later.withColumn("customer_birthday", F.date_add("customer_birthday", by_key - 2))
    source = reduce(DataFrame.unionByName, [df.withColumn("seen", F.lit(k)) for df, k in ((rows, 1), (later, 2), (again, 2))])
    _, id_col, _, key, set_cols = load.DIMENSIONS["d_customer"]
    target = _prior(fx.star_schema(spark, sf_dir)["d_customer"])
    return upsert.merge_upsert(target, source, key, set_cols, AS_OF, id_col, on_conflict="latest", latest_by=["seen"])


@register("merge_customer_if_changed")
def q_merge_customer_if_changed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers loaded before with an older address, without a birthday or as they are; only what differs is stamped."""
    target = _prior(fx.star_schema(spark, sf_dir)["d_customer"])
    target = target.withColumn(
        "customer_address", F.when(F.col("customer_id") % 5 == 0, F.lit("elsewhere")).otherwise(F.col("customer_address"))
    ).withColumn("customer_birthday", F.when(F.col("customer_id") % 7 != 0, F.col("customer_birthday")))
    _, id_col, attrs, key, set_cols = load.DIMENSIONS["d_customer"]
    source = cons.dimension_rows(_stage(spark, sf_dir), attrs)
    return upsert.merge_upsert(target, source, key, set_cols, AS_OF, id_col, only_if_changed=True)


def _stored_dates(spark: SparkSession, root: str, schema: StructType) -> DataFrame:
    """The newest version of a table, with the fixture's dates as load stamps."""
    return tables.read_table(spark, root, schema).withColumn("load_dttm", F.col("load_dttm").cast("date"))


@register("merge_customer_clustered")
def q_merge_customer_clustered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The load's own merge of a stored table that lies by natural key; some customers had another address or no birthday."""
    target = _prior(fx.star_schema(spark, sf_dir)["d_customer"])
    target = target.withColumn(
        "customer_address", F.when(F.col("customer_id") % 5 == 0, F.lit("elsewhere")).otherwise(F.col("customer_address"))
    ).withColumn("customer_birthday", F.when(F.col("customer_id") % 7 != 0, F.col("customer_birthday")))
    _, id_col, _, key, _ = load.DIMENSIONS["d_customer"]
    dwh = scratch_dir(spark, "clustered")
    root, layout = f"{dwh}/d_customer", Clustering(tuple(key), load.DEFAULT_DIMENSION_BUCKETS)
    tables.commit_version(target, root, D_CUSTOMER, id_col=id_col, partition=layout.partition, clustering=layout)
    load.load_dimension(spark, _stage(spark, sf_dir), dwh, "d_customer", AS_OF, tables.current_commit(spark, root))
    return _stored_dates(spark, root, D_CUSTOMER)


@register("merge_order_clustered")
def q_merge_order_clustered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The load's merge into months that lie by the order key; the earlier orders are those of ``merge_order``."""
    star = fx.star_schema(spark, sf_dir)
    root, layout = scratch_dir(spark, "clustered"), Clustering(tuple(ORDER_KEY), load.DEFAULT_DIMENSION_BUCKETS)
    tables.commit_version(
        _earlier_orders(star), root, F_ORDER, id_col="order_id", partition=load.order_partition(), clustering=layout
    )
    base = tables.current_commit(spark, root)
    load.load_orders(spark, _stored_stage(spark, sf_dir, load.LOOKUP_COLS), star, root, AS_OF, base, buckets=layout.buckets)
    return _stored_dates(spark, root, F_ORDER)


# --- A6 / A7 subsets -------------------------------------------------------------
@register("status_counts")
def q_status_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = q_customer_month_measures(spark, sf_dir)
    return m.select(
        *CUSTOMER_MONTH,
        "total_order_count",
        "count_order_created",
        "count_order_in_progress",
        "count_order_delivery",
        "count_order_done",
        "count_order_not_done",
    )


@register("median_completion_days")
def q_median_completion_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    return q_customer_month_measures(spark, sf_dir).select(
        *CUSTOMER_MONTH, "median_time_order_completed"
    )


# --- C14-C17 -------------------------------------------------------------------------
def _view(spark: SparkSession, sf_dir: str) -> DataFrame:
    star, keys = _delta_inputs(spark, sf_dir)
    return diag.orders_view(star, keys)


@register("diag_orders_view")
def q_diag_orders_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _view(spark, sf_dir)


@register("diag_duplicate_customers")
def q_diag_duplicate_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return diag.duplicate_customers(_view(spark, sf_dir))


@register("diag_craftsman_counts")
def q_diag_craftsman_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return diag.craftsman_rows_per_customer(_view(spark, sf_dir))


@register("diag_global_rank")
def q_diag_global_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    return diag.global_craftsman_rank(_delta(spark, sf_dir))


# --- Q1-Q4 -----------------------------------------------------------------------------
@register("quality_nulls")
def q_quality_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    mart = mart_plan.intended_mart(fx.star_schema(spark, sf_dir))
    return quality.null_violations(mart, [c for c in MART_NOT_NULL if c != "id"])


@register("quality_grain")
def q_quality_grain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q4 on the mart after the literal customer-keyed update (D3 breaks the grain)."""
    return quality.duplicate_keys(_update_literal(spark, sf_dir), CUSTOMER_MONTH)


@register("quality_unique_keys")
def q_quality_unique_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q2: natural keys held by several product rows when the description is the brand alone."""
    brand = F.substring_index(F.col("product_description"), " ", 1).alias("product_description")
    products = fx.star_schema(spark, sf_dir)["d_product"].select("product_name", brand, "product_price")
    return quality.duplicate_keys(products, ["product_name", "product_description", "product_price"])


@register("quality_range")
def q_quality_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q3: unconformed measures checked against the mart's declared types."""
    raw = month_measures(_grain(spark, sf_dir), CUSTOMER_MONTH).select(
        "customer_id",
        F.col("spend").alias("customer_costs"),
        fee_rounded("spend").alias("platform_money"),
        F.col("n_orders").alias("total_order_count"),
        F.col("median_days").alias("median_time_order_completed"),
        F.col("n_created").alias("count_order_created"),
        F.col("n_in_progress").alias("count_order_in_progress"),
    )
    return quality.range_violations(raw, MART)


def all_queries() -> dict[str, Query]:
    return dict(REGISTRY)

"""Customer-month measures and the counts behind the top-k choices.

Plan shape
----------
Everything the mart needs is rolled up in two levels:

1. ``order_grain``: one group per (customer, month, craftsman, product type,
   completion days) with order counts, price sums and status counts. It is
   partially aggregated on the map side, so a customer holding a large share
   of all orders is reduced before the shuffle, and the shuffle spreads that
   customer over many tasks by the other grain columns.
2. Three small rollups of that grain: the (customer, month) measures, the
   (customer, craftsman) counts and the (customer, month, type) counts.

The three rollups read the same level-1 subtree, so Spark reuses its shuffle
(``ReusedExchange``): the fact table is scanned and joined once. The exact
median uses ``percentile(value, 0.5, frequency)``, which merges value->count
maps, so it aggregates partially too.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from atelier.functions.measures import avg_cents, cents_to_double, fee_rounded
from atelier.schemas import STATUS_CREATED, STATUS_DELIVERY, STATUS_DONE, STATUS_IN_PROGRESS

GRAIN_KEYS = ["customer_id", "report_period", "craftsman_id", "product_type", "diff_order_date"]


def order_grain(rows: DataFrame, extra_keys: list[str] | None = None) -> DataFrame:
    """Level-1 rollup of order rows (columns as produced by ``star.order_rows``)."""
    status = F.col("order_status")
    keys = GRAIN_KEYS + list(extra_keys or [])
    return rows.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count("order_id").alias("n_orders"),
        F.sum("product_price").alias("price_sum"),
        F.count("craftsman_id").alias("n_craftsman"),
        F.count("product_type").alias("n_type"),
        F.count_if(status == STATUS_CREATED).alias("n_created"),
        F.count_if(status == STATUS_IN_PROGRESS).alias("n_in_progress"),
        F.count_if(status == STATUS_DELIVERY).alias("n_delivery"),
        F.count_if(status == STATUS_DONE).alias("n_done"),
        F.count_if(status != STATUS_DONE).alias("n_not_done"),
    )


def month_measures(grain: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Raw (customer, month) measures from the level-1 grain.

    Columns: spend, n_orders, the median of completion days, status counts.
    """
    keys = keys or ["customer_id", "report_period"]
    return grain.groupBy(*keys).agg(
        F.sum("price_sum").alias("spend"),
        F.sum("n_orders").alias("n_orders"),
        F.percentile(F.col("diff_order_date"), F.lit(0.5), F.col("n_rows")).alias("median_days"),
        F.sum("n_created").alias("n_created"),
        F.sum("n_in_progress").alias("n_in_progress"),
        F.sum("n_delivery").alias("n_delivery"),
        F.sum("n_done").alias("n_done"),
        F.sum("n_not_done").alias("n_not_done"),
    )


def craftsman_counts(grain: DataFrame) -> DataFrame:
    """COUNT(craftsman_id) per (customer, craftsman)."""
    return grain.groupBy("customer_id", "craftsman_id").agg(
        F.sum("n_craftsman").alias("craftsman_count")
    )


def category_counts(grain: DataFrame, keys: list[str]) -> DataFrame:
    """COUNT(product_type) per (keys..., product_type)."""
    return grain.groupBy(*keys, "product_type").agg(
        F.sum("n_type").alias("product_type_count")
    )


def finish_measures(measures: DataFrame, multiplicity: Column | None = None) -> DataFrame:
    """Mart-typed measure columns from raw measures.

    ``multiplicity`` reproduces the reference's literal LEFT JOIN fan-out
    (every order counted once per existing mart row of its customer) without
    materialising the repeated rows: sums and counts scale by it, while the
    average and the median of a uniformly repeated multiset are unchanged.
    """
    m = (multiplicity if multiplicity is not None else F.lit(1)).cast("long")
    spend = F.col("spend") * m
    cents = avg_cents("spend", "n_orders")
    return measures.select(
        *[c for c in measures.columns if c not in _RAW],
        F.round(spend, 0).cast("int").alias("customer_costs"),
        fee_rounded(spend).cast("int").alias("platform_money"),
        (F.col("n_orders") * m).cast("int").alias("total_order_count"),
        cents_to_double(cents).alias("avg_order_price"),
        F.round(F.col("median_days"), 1).alias("median_time_order_completed"),
        (F.col("n_created") * m).cast("int").alias("count_order_created"),
        (F.col("n_in_progress") * m).alias("count_order_in_progress"),
        (F.col("n_delivery") * m).alias("count_order_delivery"),
        (F.col("n_done") * m).alias("count_order_done"),
        (F.col("n_not_done") * m).alias("count_order_not_done"),
    )


_RAW = {
    "spend",
    "n_orders",
    "median_days",
    "n_created",
    "n_in_progress",
    "n_delivery",
    "n_done",
    "n_not_done",
}

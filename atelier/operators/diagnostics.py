"""Diagnostic queries of the draft scripts (C14-C17).

The drafts inspect the denormalised order view, which repeats every order
once per mart row of its customer. These functions give the same answers
from per-customer counts and multiplicities, without producing the repeated
rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from atelier.operators.delta import _star_join, _with_existing
from atelier.operators.keys import assign_ids
from atelier.session import materialize

VIEW_COLS = [
    "customer_id",
    "exist_customer_id",
    "customer_name",
    "customer_address",
    "customer_birthday",
    "customer_email",
    "product_price",
    "product_type",
    "craftsman_id",
    "order_id",
    "mart_row_multiplicity",
]


def orders_view(star: dict[str, DataFrame], mart_keys: DataFrame) -> DataFrame:
    """The denormalised order view, one row per order with its repeat factor."""
    return _with_existing(_star_join(star), mart_keys).select(*VIEW_COLS)


def view_rows_per_customer(view: DataFrame) -> DataFrame:
    """Rows per customer in the repeated view: orders x repeat factor."""
    return view.groupBy("customer_id").agg(
        F.sum("mart_row_multiplicity").alias("view_rows"),
        F.sum(F.when(F.col("craftsman_id").isNotNull(), F.col("mart_row_multiplicity"))).alias(
            "craftsman_rows"
        ),
    )


def duplicate_customers(view: DataFrame) -> DataFrame:
    """C14: customers with more than one row in the joined view."""
    per = view_rows_per_customer(view)
    return per.filter(F.col("view_rows") > 1).select(
        "customer_id", F.col("view_rows").alias("count")
    )


def craftsman_rows_per_customer(view: DataFrame) -> DataFrame:
    """COUNT(craftsman_id) per customer, largest first."""
    per = view_rows_per_customer(view)
    return per.select("customer_id", F.coalesce("craftsman_rows", F.lit(0)).alias("craftsman_rows")).orderBy(
        F.col("craftsman_rows").desc(), "customer_id"
    )


def global_craftsman_rank(delta: DataFrame) -> DataFrame:
    """DENSE_RANK() OVER (ORDER BY craftsman_count DESC), no partition.

    Counts are per (customer, craftsman) over the repeated delta. An
    unpartitioned window would sort every pair in one task; instead the
    distinct count values are numbered in descending order with the
    distributed row numbering (a dense rank over distinct values is their row
    number) and joined back on the count.
    """
    # Written once: the levels, their ranges and the join read it.
    counts = delta.groupBy("customer_id", "craftsman_id").agg(
        F.sum(F.when(F.col("craftsman_id").isNotNull(), F.col("mart_row_multiplicity"))).alias(
            "craftsman_count"
        )
    )
    counts = materialize(counts, "craftsman-counts")
    levels = counts.select("craftsman_count").distinct()
    ranked = assign_ids(
        levels, [F.col("craftsman_count").desc_nulls_last()], "rank_count_craftsman"
    )
    return counts.join(ranked, "craftsman_count").select(
        "customer_id", "craftsman_id", "craftsman_count", "rank_count_craftsman"
    )

"""Top craftsman and top category per customer.

Literal forms keep the reference's semantics: DENSE_RANK = 1 keeps ties, and
the "most popular category" is ranked by the category *name*, descending,
NULL first (PostgreSQL puts NULL first under DESC).

Intended forms return exactly one row per group: the highest count, ties
broken deterministically (smallest craftsman id; greatest category name).
They are plain aggregates (``max_by`` over a unique ordering struct), which
aggregate partially on the map side; no per-customer sort is needed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def top_craftsman_ties(counts: DataFrame) -> DataFrame:
    """All craftsmen at DENSE_RANK 1 by count per customer.

    Rank 1 is the customer's largest count, so the counts are joined with a
    (partially aggregated) maximum per customer. No window gathers a
    customer's craftsmen in one task, however many are tied.
    """
    best = counts.groupBy("customer_id").agg(F.max("craftsman_count").alias("craftsman_count"))
    return counts.join(best, ["customer_id", "craftsman_count"]).select(
        "customer_id", F.col("craftsman_id").alias("top_craftsman_id"), "craftsman_count"
    )


def top_craftsman_one(counts: DataFrame) -> DataFrame:
    """One craftsman per customer: highest count, then smallest id."""
    order = F.struct(F.col("craftsman_count"), -F.col("craftsman_id"))
    return counts.groupBy("customer_id").agg(
        F.max_by("craftsman_id", order).alias("top_craftsman_id")
    )


def top_category_literal(counts: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """W2 as written: DENSE_RANK() OVER (PARTITION BY customer ORDER BY type DESC) = 1.

    Counts are grouped by type, so the types of a customer are distinct and
    rank 1 is one row: NULL if the customer has a NULL type, else the greatest
    name. Computed as an aggregate with that exact meaning.
    """
    keys = keys or ["customer_id"]
    has_null = F.max(F.col("product_type").isNull().cast("int")) > 0
    return counts.groupBy(*keys).agg(
        F.when(has_null, F.lit(None).cast("string"))
        .otherwise(F.max("product_type"))
        .alias("top_product_category")
    )


def top_category_by_count(counts: DataFrame, keys: list[str]) -> DataFrame:
    """Intended W2: the category with the most orders; ties to the greatest name."""
    order = F.struct(F.col("product_type_count"), F.col("product_type"))
    return (
        counts.filter(F.col("product_type").isNotNull())
        .groupBy(*keys)
        .agg(F.max_by("product_type", order).alias("top_product_category"))
    )

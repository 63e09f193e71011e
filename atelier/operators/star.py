"""Star joins over the fact.

``order_rows`` is the order-level input of every mart computation. Of the
four joins in the reference only the product join adds columns the measures
need (price, type). Customer attributes are functionally dependent on
``customer_id`` and are joined after aggregation, one row per customer-month
instead of one per order. The craftsman join only drops orders whose
craftsman is missing, so it is a semi join. Which physical join Spark uses is
left to the planner: with AQE a dimension is broadcast only when its measured
size is under the broadcast threshold, and shuffled otherwise.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from atelier.functions.dates import day_diff, month_key


def order_rows(
    f_order: DataFrame,
    d_craftsman: DataFrame,
    d_product: DataFrame,
    d_customer: DataFrame | None = None,
) -> DataFrame:
    """Order rows with product attributes, month key and completion days.

    Output: order_id, customer_id, craftsman_id, product_id, product_price,
    product_type, order_status, diff_order_date, report_period. With
    ``d_customer`` given, orders of unknown customers are dropped here too
    (otherwise the later customer join drops their groups).
    """
    facts = f_order.select(
        "order_id",
        "customer_id",
        "craftsman_id",
        "product_id",
        "order_status",
        day_diff("order_completion_date", "order_created_date").alias("diff_order_date"),
        month_key("order_created_date").alias("report_period"),
    )
    facts = facts.join(d_craftsman.select("craftsman_id"), "craftsman_id", "left_semi")
    if d_customer is not None:
        facts = facts.join(d_customer.select("customer_id"), "customer_id", "left_semi")
    prods = d_product.select("product_id", "product_price", "product_type")
    return facts.join(prods, "product_id").select(
        "order_id",
        "customer_id",
        "craftsman_id",
        "product_id",
        "product_price",
        "product_type",
        "order_status",
        "diff_order_date",
        "report_period",
    )


def counted_orders(f_order: DataFrame) -> DataFrame:
    """Orders for the grain, which counts order ids: 0 in place of each, so that no id is shuffled with its order."""
    return f_order.withColumn("order_id", F.when(F.col("order_id").isNotNull(), F.lit(0)))


def customer_attributes(d_customer: DataFrame) -> DataFrame:
    return d_customer.select(
        "customer_id", "customer_name", "customer_address", "customer_birthday", "customer_email"
    )

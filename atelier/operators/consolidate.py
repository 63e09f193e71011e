"""Source consolidation.

Four source systems of different shapes become one 19-column staging frame:
source 1 is already wide; source 2 joins masters-products with
orders-customers on (product, craftsman); source 3 joins orders to craftsmen
and customers; the external source joins orders to customers. Columns are
projected by name into one order (``WIDE_COLS``) and the four are combined
with a distinct union (SQL ``UNION``, not ``UNION ALL``): duplicates inside a
source go too, and NULLs compare equal.

Equal rows have one customer, so the distinct needs its rows by customer only.
Sources that end with the join to customers lie so already, and Spark drops
their repartition; the others are shuffled once. The customers of a source are the
hashed side, so no order rows are sorted for that join. Other joins inside a
source are left to the planner (broadcast of the smaller side only under the
measured-size threshold).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame

from atelier.schemas import CRAFTSMAN_COLS, CUSTOMER_COLS, ORDER_COLS, PRODUCT_COLS, WIDE_COLS

SOURCE1_WIDE = "source1.craft_market_wide"
SOURCE2_MASTERS_PRODUCTS = "source2.craft_market_masters_products"
SOURCE2_ORDERS_CUSTOMERS = "source2.craft_market_orders_customers"
SOURCE3_ORDERS = "source3.craft_market_orders"
SOURCE3_CRAFTSMEN = "source3.craft_market_craftsmans"
SOURCE3_CUSTOMERS = "source3.craft_market_customers"
EXTERNAL_ORDERS = "external_source.craft_products_orders"
EXTERNAL_CUSTOMERS = "external_source.customers"


def scan_wide(df: DataFrame) -> DataFrame:
    """The wide source projected to the 19 staging columns."""
    return df.select(*WIDE_COLS)


def join_source2(masters_products: DataFrame, orders_customers: DataFrame) -> DataFrame:
    """Orders-customers JOIN masters-products ON product_id AND craftsman_id."""
    mp = masters_products.select(*CRAFTSMAN_COLS, *[c for c in PRODUCT_COLS])
    oc = orders_customers.select(*ORDER_COLS, *CUSTOMER_COLS, "product_id", "craftsman_id")
    return oc.join(mp, ["product_id", "craftsman_id"]).select(*WIDE_COLS)


def join_source3(orders: DataFrame, craftsmen: DataFrame, customers: DataFrame) -> DataFrame:
    """Orders JOIN craftsmen ON craftsman_id JOIN customers ON customer_id."""
    o = orders.select(*ORDER_COLS, *PRODUCT_COLS, "craftsman_id", "customer_id")
    return (
        o.join(craftsmen.select(*CRAFTSMAN_COLS), "craftsman_id")
        .join(customers.select(*CUSTOMER_COLS).hint("shuffle_hash"), "customer_id")
        .select(*WIDE_COLS)
    )


def join_external(orders: DataFrame, customers: DataFrame) -> DataFrame:
    """External orders JOIN external customers ON customer_id."""
    o = orders.select(*ORDER_COLS, *CRAFTSMAN_COLS, *PRODUCT_COLS, "customer_id")
    return o.join(customers.select(*CUSTOMER_COLS).hint("shuffle_hash"), "customer_id").select(*WIDE_COLS)


def consolidate_sources(sources: dict[str, DataFrame]) -> DataFrame:
    """The distinct union of all four source shapes (``tmp_sources``)."""
    parts = [
        scan_wide(sources[SOURCE1_WIDE]),
        join_source2(sources[SOURCE2_MASTERS_PRODUCTS], sources[SOURCE2_ORDERS_CUSTOMERS]),
        join_source3(
            sources[SOURCE3_ORDERS], sources[SOURCE3_CRAFTSMEN], sources[SOURCE3_CUSTOMERS]
        ),
        join_external(sources[EXTERNAL_ORDERS], sources[EXTERNAL_CUSTOMERS]),
    ]
    return reduce(DataFrame.unionByName, [part.repartition("customer_id") for part in parts]).distinct()


def dimension_rows(stage: DataFrame, columns: list[str]) -> DataFrame:
    """SELECT DISTINCT <dimension attributes> FROM tmp_sources."""
    return stage.select(*columns).distinct()

"""Two states of the fixture star: as it is now, and as it was before a load (FIXTURES.md §2 gives the state now).

The load brought, for some customers, orders that weren't there and later statuses of
others; products another category; customers another address. What it
changed is stamped ``CHANGED_ON``, all else is as old as the fixture says.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed values of the two states.
CHANGED_ON = dt.date(2002, 1, 1)
CHANGED_AFTER = dt.date(2001, 12, 31)
NEW_ORDERS_FROM = dt.date(1998, 3, 1)
EARLIER_TYPE = "EARLIER TYPE"


def _touched():
    return F.col("customer_id") % 40 == 7


def _new_order():
    return _touched() & (F.col("order_created_date") >= F.lit(NEW_ORDERS_FROM))


def _moved_on():
    return _touched() & (F.col("order_id") % 3 == 0)


def _other_type():
    return F.col("product_id") % 97 == 5


def _moved_house():
    return F.col("customer_id") % 50 == 11


def _stamped(df: DataFrame, changed) -> DataFrame:
    return df.withColumn("load_dttm", F.when(changed, F.lit(CHANGED_ON)).otherwise(F.col("load_dttm")))


def star_after(star: dict[str, DataFrame]) -> dict[str, DataFrame]:
    return star | {
        "f_order": _stamped(star["f_order"], _new_order() | _moved_on()),
        "d_product": _stamped(star["d_product"], _other_type()),
        "d_customer": _stamped(star["d_customer"], _moved_house()),
    }


def star_before(star: dict[str, DataFrame]) -> dict[str, DataFrame]:
    orders = star["f_order"].where(~_new_order())
    return star | {
        "f_order": orders.withColumn("order_status", F.when(_moved_on(), F.lit("created")).otherwise(F.col("order_status"))).withColumn(
            "order_completion_date", F.when(~_moved_on(), F.col("order_completion_date"))
        ),
        "d_product": star["d_product"].withColumn("product_type", F.when(_other_type(), F.lit(EARLIER_TYPE)).otherwise(F.col("product_type"))),
        "d_customer": star["d_customer"].withColumn(
            "customer_address", F.when(_moved_house(), F.concat(F.lit("old-"), "customer_address")).otherwise(F.col("customer_address"))
        ),
    }

"""Schemas of the sources, the star schema, the mart and the watermark log.

The mart and watermark schemas follow the reference DDL; the source and
star-schema column lists are reconstructed from how the scripts use them.
"""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Attribute groups of one order row (the 19-column wide shape of the sources)
# Column names must equal the reference's.
# ---------------------------------------------------------------------------
ORDER_COLS = ["order_id", "order_created_date", "order_completion_date", "order_status"]
CRAFTSMAN_COLS = [
    "craftsman_id",
    "craftsman_name",
    "craftsman_address",
    "craftsman_birthday",
    "craftsman_email",
]
PRODUCT_COLS = [
    "product_id",
    "product_name",
    "product_description",
    "product_type",
    "product_price",
]
CUSTOMER_COLS = [
    "customer_id",
    "customer_name",
    "customer_address",
    "customer_birthday",
    "customer_email",
]
WIDE_COLS = ORDER_COLS + CRAFTSMAN_COLS + PRODUCT_COLS + CUSTOMER_COLS

# Natural keys and updated columns of the four merges (fixed values).
CRAFTSMAN_KEY = ["craftsman_name", "craftsman_email"]
CRAFTSMAN_SET = ["craftsman_address", "craftsman_birthday"]
PRODUCT_KEY = ["product_name", "product_description", "product_price"]
PRODUCT_SET = ["product_type"]
CUSTOMER_KEY = ["customer_name", "customer_email"]
CUSTOMER_SET = ["customer_address", "customer_birthday"]
ORDER_KEY = ["product_id", "craftsman_id", "customer_id", "order_created_date"]
ORDER_SET = ["order_completion_date", "order_status"]

# Order statuses named by the mart (fixed values).
STATUS_CREATED = "created"
STATUS_IN_PROGRESS = "in progress"
STATUS_DELIVERY = "delivery"
STATUS_DONE = "done"


def _f(name: str, dtype: T.DataType, nullable: bool = True) -> T.StructField:
    return T.StructField(name, dtype, nullable)


D_CRAFTSMAN = T.StructType(
    [
        _f("craftsman_id", T.LongType(), False),
        _f("craftsman_name", T.StringType()),
        _f("craftsman_address", T.StringType()),
        _f("craftsman_birthday", T.DateType()),
        _f("craftsman_email", T.StringType()),
        _f("load_dttm", T.TimestampType()),
    ]
)
# Prices are part of a natural key, so they are stored as they come, to the cent.
PRICE = T.DecimalType(18, 2)

D_PRODUCT = T.StructType(
    [
        _f("product_id", T.LongType(), False),
        _f("product_name", T.StringType()),
        _f("product_description", T.StringType()),
        _f("product_type", T.StringType()),
        _f("product_price", PRICE),
        _f("load_dttm", T.TimestampType()),
    ]
)
D_CUSTOMER = T.StructType(
    [
        _f("customer_id", T.LongType(), False),
        _f("customer_name", T.StringType()),
        _f("customer_address", T.StringType()),
        _f("customer_birthday", T.DateType()),
        _f("customer_email", T.StringType()),
        _f("load_dttm", T.TimestampType()),
    ]
)
F_ORDER = T.StructType(
    [
        _f("order_id", T.LongType(), False),
        _f("product_id", T.LongType()),
        _f("craftsman_id", T.LongType()),
        _f("customer_id", T.LongType()),
        _f("order_created_date", T.DateType()),
        _f("order_completion_date", T.DateType()),
        _f("order_status", T.StringType()),
        _f("load_dttm", T.TimestampType()),
    ]
)

# Mart table (reference DDL, in its column order). NOT NULL is declared but
# parquet keeps every column nullable; ``atelier.operators.quality`` checks it.
MART = T.StructType(
    [
        _f("id", T.LongType(), False),
        _f("customer_id", T.LongType(), False),
        _f("customer_name", T.StringType(), False),
        _f("customer_address", T.StringType(), False),
        _f("customer_birthday", T.DateType(), False),
        _f("customer_email", T.StringType(), False),
        _f("customer_costs", T.IntegerType(), False),
        _f("platform_money", T.IntegerType(), False),
        _f("total_order_count", T.IntegerType(), True),
        _f("avg_order_price", T.DecimalType(10, 2), False),
        _f("median_time_order_completed", T.DecimalType(10, 1), True),
        _f("top_product_category", T.StringType(), False),
        _f("top_craftsman_id", T.LongType(), False),
        _f("count_order_created", T.IntegerType(), False),
        _f("count_order_in_progress", T.LongType(), False),
        _f("count_order_delivery", T.LongType(), False),
        _f("count_order_done", T.LongType(), False),
        _f("count_order_not_done", T.LongType(), False),
        _f("report_period", T.StringType(), False),
    ]
)
MART_BUSINESS_COLS = [f.name for f in MART.fields if f.name != "id"]
MART_NOT_NULL = [f.name for f in MART.fields if not f.nullable]

WATERMARK_LOG = T.StructType(
    [
        _f("id", T.LongType(), False),
        _f("load_dttm", T.TimestampType(), False),
    ]
)

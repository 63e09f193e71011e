"""The source tables, from folders of any Spark format or from a catalog, with their columns checked."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from atelier.operators import consolidate as cons
from atelier.schemas import CRAFTSMAN_COLS, CUSTOMER_COLS, ORDER_COLS, PRODUCT_COLS, WIDE_COLS

#: The columns that the load reads of each source table.
SOURCE_COLUMNS = {
    cons.SOURCE1_WIDE: WIDE_COLS,
    cons.SOURCE2_MASTERS_PRODUCTS: CRAFTSMAN_COLS + PRODUCT_COLS,
    cons.SOURCE2_ORDERS_CUSTOMERS: [*ORDER_COLS, *CUSTOMER_COLS, "product_id", "craftsman_id"],
    cons.SOURCE3_ORDERS: [*ORDER_COLS, *PRODUCT_COLS, "craftsman_id", "customer_id"],
    cons.SOURCE3_CRAFTSMEN: CRAFTSMAN_COLS,
    cons.SOURCE3_CUSTOMERS: CUSTOMER_COLS,
    cons.EXTERNAL_ORDERS: [*ORDER_COLS, *CRAFTSMAN_COLS, *PRODUCT_COLS, "customer_id"],
    cons.EXTERNAL_CUSTOMERS: CUSTOMER_COLS,
}
DATE_COLUMNS = ("order_created_date", "order_completion_date", "craftsman_birthday", "customer_birthday")


def check_source(df: DataFrame, name: str) -> DataFrame:
    """``df`` if it has the columns that the load reads, with dates as dates; else the error names them."""
    kinds = dict(df.dtypes)
    missing = [c for c in SOURCE_COLUMNS[name] if c not in kinds]
    mistyped = [f"{c} {kinds[c]}" for c in DATE_COLUMNS if kinds.get(c, "date") not in ("date", "timestamp", "timestamp_ntz")]
    if missing or mistyped:
        raise ValueError(f"{name}: missing columns {missing}, not dates {mistyped}")
    return df


def read_source(spark: SparkSession, name: str, location: str, fmt: str = "parquet") -> DataFrame:
    """One source table: ``location`` is a folder, or with ``fmt='table'`` a catalog database."""
    if fmt == "table":
        return check_source(spark.table(f"{location}.{name.replace('.', '_')}"), name)
    options = {"header": "true", "inferSchema": "true"} if fmt == "csv" else {}
    return check_source(spark.read.format(fmt).options(**options).load(f"{location.rstrip('/')}/{name}"), name)

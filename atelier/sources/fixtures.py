"""The reference's inputs, derived from the driver tables (FIXTURES.md §2).

The reference ships no data, so every input it reads is mapped from the
TPC-H-like tables: one order row per lineitem, craftsmen from suppliers,
products from parts, customers from customers. All frames are lazy and are
computed by Spark from the given tables, so their size grows with them.

Source systems are slices of the 19-column wide view by ``order_id % 4``:
source 1 holds slices 0 and 1, source 2 slice 1, source 3 slice 2 and the
external source slice 3. Slice 1 is in two sources, so the distinct union
gives every order back exactly once.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from atelier.schemas import CRAFTSMAN_COLS, CUSTOMER_COLS, ORDER_COLS, PRODUCT_COLS
from atelier.session import freed_shuffles, scratch_dir

# ---------------------------------------------------------------------------
# Fixed values of the fixture mapping (FIXTURES.md §2).
# ---------------------------------------------------------------------------
ORDER_ID_ORDERKEY_FACTOR = 100000
ORDER_ID_PARTKEY_FACTOR = 10000
COMPLETION_DAYS_MODULUS = 60
BIRTHDAY_BASE = date(1950, 1, 1)
CRAFTSMAN_BIRTHDAY_FACTOR = 13
CUSTOMER_BIRTHDAY_FACTOR = 11
BIRTHDAY_SPREAD_DAYS = 18000
DIM_LOAD_BASE = date(1995, 1, 1)
CRAFTSMAN_LOAD_FACTOR = 37
CUSTOMER_LOAD_FACTOR = 53
PRODUCT_LOAD_FACTOR = 71
DIM_LOAD_SPREAD_DAYS = 2400
FIXTURE_WATERMARK = date(2001, 1, 1)
EXISTING_MART_CUSTOMER_MODULUS = 3
SOURCE_SLICES = 4
CRAFTSMAN_ADDRESS_PREFIX = "addr-"
CUSTOMER_ADDRESS_PREFIX = "addr-"
CRAFTSMAN_EMAIL_SUFFIX = "@c.example"
CUSTOMER_EMAIL_SUFFIX = "@x.example"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _days_after(base: date, days: Column) -> Column:
    return F.date_add(F.lit(base), days.cast("int"))


def _order_status() -> Column:
    linestatus_f = F.col("l_linestatus") == "F"
    return (
        F.when(linestatus_f & F.col("l_returnflag").isin("R", "A"), F.lit("done"))
        .when(linestatus_f, F.lit("delivery"))
        .when(F.col("l_returnflag") == "R", F.lit("created"))
        .otherwise(F.lit("in progress"))
    )


def _line_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", _order_status().alias("order_status"))


def _order_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("l_orderkey"), "o_custkey", F.col("o_orderdate").cast("date").alias("order_created_date")
    )


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem JOIN orders, with the columns that the mapping needs."""
    return _line_columns(spark, sf_dir).join(_order_columns(spark, sf_dir), "l_orderkey")


def _order_id() -> Column:
    return (
        F.col("l_orderkey") * ORDER_ID_ORDERKEY_FACTOR + F.col("l_partkey")
    ) * ORDER_ID_PARTKEY_FACTOR + F.col("l_suppkey")


def _order_attrs() -> list[Column]:
    """``ORDER_COLS`` of a line."""
    completion = F.when(
        F.col("order_status") == "done",
        F.date_add("order_created_date", (F.lit(1) + F.col("l_partkey") % COMPLETION_DAYS_MODULUS).cast("int")),
    )
    return [
        _order_id().alias("order_id"),
        F.col("order_created_date"),
        completion.alias("order_completion_date"),
        F.col("order_status"),
    ]


def order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem JOIN orders, mapped to order attributes plus the three ids."""
    return _lines(spark, sf_dir).select(
        *_order_attrs(),
        F.col("l_suppkey").alias("craftsman_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("o_custkey").alias("customer_id"),
    )


def _craftsman_attrs() -> list[Column]:
    """``CRAFTSMAN_COLS`` of a supplier."""
    return [
        F.col("s_suppkey").alias("craftsman_id"),
        F.col("s_name").alias("craftsman_name"),
        F.concat(F.lit(CRAFTSMAN_ADDRESS_PREFIX), F.col("s_nationkey").cast("string")).alias(
            "craftsman_address"
        ),
        _days_after(
            BIRTHDAY_BASE, (F.col("s_suppkey") * CRAFTSMAN_BIRTHDAY_FACTOR) % BIRTHDAY_SPREAD_DAYS
        ).alias("craftsman_birthday"),
        F.concat(F.col("s_name"), F.lit(CRAFTSMAN_EMAIL_SUFFIX)).alias("craftsman_email"),
    ]


def craftsmen(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = table(spark, sf_dir, "supplier")
    return s.select(
        *_craftsman_attrs(),
        _days_after(
            DIM_LOAD_BASE, (F.col("s_suppkey") * CRAFTSMAN_LOAD_FACTOR) % DIM_LOAD_SPREAD_DAYS
        ).alias("load_dttm"),
    )


def _product_price() -> Column:
    return F.floor(F.col("p_retailprice")).cast("long")


def _product_attrs() -> list[Column]:
    """``PRODUCT_COLS`` of a part."""
    return [
        F.col("p_partkey").alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.concat(F.col("p_brand"), F.lit(" "), F.col("p_partkey").cast("string")).alias(
            "product_description"
        ),
        F.col("p_type").alias("product_type"),
        _product_price().alias("product_price"),
    ]


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    return p.select(
        *_product_attrs(),
        _days_after(
            DIM_LOAD_BASE, (F.col("p_partkey") * PRODUCT_LOAD_FACTOR) % DIM_LOAD_SPREAD_DAYS
        ).alias("load_dttm"),
    )


def _customer_attrs() -> list[Column]:
    """``CUSTOMER_COLS`` of a customer."""
    return [
        F.col("c_custkey").alias("customer_id"),
        F.col("c_name").alias("customer_name"),
        F.concat(F.lit(CUSTOMER_ADDRESS_PREFIX), F.col("c_nationkey").cast("string")).alias(
            "customer_address"
        ),
        _days_after(
            BIRTHDAY_BASE, (F.col("c_custkey") * CUSTOMER_BIRTHDAY_FACTOR) % BIRTHDAY_SPREAD_DAYS
        ).alias("customer_birthday"),
        F.concat(F.col("c_name"), F.lit(CUSTOMER_EMAIL_SUFFIX)).alias("customer_email"),
    ]


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    return c.select(
        *_customer_attrs(),
        _days_after(
            DIM_LOAD_BASE, (F.col("c_custkey") * CUSTOMER_LOAD_FACTOR) % DIM_LOAD_SPREAD_DAYS
        ).alias("load_dttm"),
    )


#: Key and given columns of what a line is joined with.
LINE_DIMS = {
    "supplier": ("l_suppkey", ["s_suppkey", "s_name", "s_nationkey"]),
    "part": ("l_partkey", ["p_partkey", "p_name", "p_brand", "p_type", "p_retailprice"]),
    "customer": ("o_custkey", ["c_custkey", "c_name", "c_nationkey"]),
}


def _with_dim(spark: SparkSession, sf_dir: str, rows: DataFrame, name: str, hashed: bool = False) -> DataFrame:
    key, columns = LINE_DIMS[name]
    dim = table(spark, sf_dir, name).select(*[_product_price().alias(c) if c == "p_retailprice" else F.col(c) for c in columns])
    return rows.join(dim.hint("shuffle_hash") if hashed else dim, F.col(key) == F.col(columns[0]))


def _joined_lines(spark: SparkSession, sf_dir: str, last: str, *slices: int) -> DataFrame:
    """Lines with their supplier, part and customer in the given columns (the price whole), in these slices, by default all.

    ``last`` is the table joined last: where Spark shuffles the joins, the rows lie by its key then, and what joins
    them on it needs no other exchange. The mapping is applied to the joined rows, so the exchanges move the few given
    columns instead of the strings and dates made of them. Customers are joined last by hash: of the rows shuffled
    for it only the customers' are held in memory.
    """
    joined = _lines(spark, sf_dir)
    if slices:
        joined = joined.filter((_order_id() % SOURCE_SLICES).isin(*slices))
    for name in sorted(LINE_DIMS, key=lambda d: d == last):
        joined = _with_dim(spark, sf_dir, joined, name, hashed=name == last == "customer")
    return joined


def wide_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 19-column wide row per order (the shape of ``source1``)."""
    return _joined_lines(spark, sf_dir, "customer").select(
        *_order_attrs(), *_craftsman_attrs(), *_product_attrs(), *_customer_attrs()
    )


def _distinct_in_order(df: DataFrame, *first: str) -> DataFrame:
    """``df.distinct()`` for rows that lie by ``first`` already and hardly repeat, sorted by ``first`` within their partitions.

    A distinct over them holds each row in two hash tables of a task (its partial and its final aggregate) and sorts
    what is left for the join that follows. This is one sort, which the join uses too and which can spill.
    """
    columns = [*first, *(c for c in df.columns if c not in first)]
    copy = F.row_number().over(Window.partitionBy(*columns).orderBy(*first))
    return df.withColumn("_copy", copy).where(F.col("_copy") == 1).drop("_copy")


SLICE = "order_slice"
#: Which slices a source table is made of.
SOURCE_TABLES = {
    "source1.craft_market_wide": (0, 1),
    "source2.craft_market_masters_products": (1,),
    "source2.craft_market_orders_customers": (1,),
    "source3.craft_market_orders": (2,),
    "source3.craft_market_craftsmans": (2,),
    "source3.craft_market_customers": (2,),
    "external_source.craft_products_orders": (3,),
    "external_source.customers": (3,),
}


def _stored_lines(spark: SparkSession, sf_dir: str, *slices: int) -> DataFrame:
    """The rows of ``_joined_lines`` in these slices, written once: all source tables are columns of them.

    Customers are joined to the orders, of which there are fewer, and parts come last, so no line is shuffled
    with a part's strings. The files have a folder for each slice, in which the rows lie by part.
    """
    lines = _line_columns(spark, sf_dir).filter((_order_id() % SOURCE_SLICES).isin(*slices))
    lines = lines.join(_with_dim(spark, sf_dir, _order_columns(spark, sf_dir), "customer").drop("o_custkey"), "l_orderkey")
    for name in ("supplier", "part"):
        lines = _with_dim(spark, sf_dir, lines, name).drop(LINE_DIMS[name][0])
    lines = _with_line_keys(lines).withColumn(SLICE, (_order_id() % SOURCE_SLICES).cast("int")).drop("l_partkey", "l_suppkey")
    path = scratch_dir(spark, "source-lines")
    with freed_shuffles(spark):
        lines.sortWithinPartitions(SLICE, "p_partkey").write.option("compression", "zstd").partitionBy(SLICE).parquet(path)
    return spark.read.schema(lines.schema).parquet(path)


def _with_line_keys(joined: DataFrame) -> DataFrame:
    """The keys that lines were joined on, which stand in their part and supplier already."""
    return joined.withColumns({"l_partkey": F.col("p_partkey"), "l_suppkey": F.col("s_suppkey")})


def source_tables(spark: SparkSession, sf_dir: str, *names: str) -> dict[str, DataFrame]:
    """The eight reference source tables, or those named, keyed by their reference names.

    Lines that must lie by a key next are shuffled in the given columns, before the mapping makes more of them; those
    that a small table may be joined to in place are left to the planner.
    """
    names = names or tuple(SOURCE_TABLES)
    stored = _stored_lines(spark, sf_dir, *sorted({k for name in names for k in SOURCE_TABLES[name]}))
    product, craftsman, customer = (F.col(k) for k in ("p_partkey", "s_suppkey", "c_custkey"))

    def rows(name: str, *by: Column, distinct: str | None = None) -> DataFrame:
        lines = stored.where(F.col(SLICE).isin(*SOURCE_TABLES[name]))
        if distinct:  # the mapping keeps different rows different
            return lines.select(*LINE_DIMS[distinct][1]).distinct()
        return _with_line_keys(lines.repartition(*by) if by else lines)

    made = {
        "source1.craft_market_wide": lambda name: rows(name, customer).select(
            *_order_attrs(), *_craftsman_attrs(), *_product_attrs(), *_customer_attrs()
        ),
        "source2.craft_market_masters_products": lambda name: _distinct_in_order(
            rows(name, product, craftsman).select(*_craftsman_attrs(), *_product_attrs()), "product_id", "craftsman_id"
        ),
        "source2.craft_market_orders_customers": lambda name: rows(name, product, craftsman).select(
            *_order_attrs(), *_customer_attrs(), product.alias("product_id"), craftsman.alias("craftsman_id")
        ),
        "source3.craft_market_orders": lambda name: rows(name).select(
            *_order_attrs(), *_product_attrs(), craftsman.alias("craftsman_id"), customer.alias("customer_id")
        ),
        "source3.craft_market_craftsmans": lambda name: rows(name, distinct="supplier").select(*_craftsman_attrs()),
        "source3.craft_market_customers": lambda name: rows(name, distinct="customer").select(*_customer_attrs()),
        "external_source.craft_products_orders": lambda name: rows(name, customer).select(
            *_order_attrs(), *_craftsman_attrs(), *_product_attrs(), customer.alias("customer_id")
        ),
        "external_source.customers": lambda name: rows(name, distinct="customer").select(*_customer_attrs()),
    }
    return {name: made[name](name) for name in names}


def star_schema(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """``d_craftsman``, ``d_product``, ``d_customer`` and ``f_order``.

    Surrogate ids are the driver keys; ``load_dttm`` is a DATE spread over
    1995-2001 for dimensions and the created date for orders.
    """
    lines = order_lines(spark, sf_dir)
    f_order = lines.select(
        "order_id",
        "product_id",
        "craftsman_id",
        "customer_id",
        "order_created_date",
        "order_completion_date",
        "order_status",
        F.col("order_created_date").alias("load_dttm"),
    )
    return {
        "d_craftsman": craftsmen(spark, sf_dir),
        "d_product": products(spark, sf_dir),
        "d_customer": customers(spark, sf_dir),
        "f_order": f_order,
    }


def existing_mart_keys(f_order: DataFrame, watermark: date = FIXTURE_WATERMARK) -> DataFrame:
    """(customer_id, report_period) rows the mart already holds before the refresh."""
    from atelier.functions.dates import month_key

    return (
        f_order.filter(
            (F.col("order_created_date") <= F.lit(watermark))
            & (F.col("customer_id") % EXISTING_MART_CUSTOMER_MODULUS != 0)
        )
        .select("customer_id", month_key("order_created_date").alias("report_period"))
        .distinct()
    )

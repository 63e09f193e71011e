"""The mart's maintained state: the order grain, changed by what was added and taken back.

The state is the level-1 rollup of ``measures.order_grain``: counts and sums by
customer, month, craftsman, category and completion days. Everything the mart
needs follows from it, the exact median by its counts of days, and the
most frequent craftsman by the counts of craftsmen. It is a sum over orders, so it
follows the fact without reading it again: the grain of the orders as they are
now, less the grain of the same orders as they were, is added to it. Where nothing
is left of a group its counts are zero.

What changed is found from two versions of the star: folders of the fact that the
older one doesn't list hold the new orders, those that only it lists hold the
old ones. Of the new ones, those stamped after the watermark have changed; the rest of
their folder was written along. Product rows with another type or price take
all their orders back and add them again, which reads the fact; this happens only
where such a row is found.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from atelier.operators.measures import GRAIN_KEYS, order_grain
from atelier.operators.star import counted_orders, order_rows
from atelier.session import materialize

COUNTS = [
    "n_rows", "n_orders", "price_sum", "n_craftsman", "n_type", "n_created", "n_in_progress", "n_delivery", "n_done", "n_not_done",
]
#: The stored state; a grain's counts may be negative in a change.
STATE = T.StructType(
    [
        T.StructField("customer_id", T.LongType()),
        T.StructField("report_period", T.StringType()),
        T.StructField("craftsman_id", T.LongType()),
        T.StructField("product_type", T.StringType()),
        T.StructField("diff_order_date", T.IntegerType()),
        *(T.StructField(c, T.DecimalType(28, 2) if c == "price_sum" else T.LongType()) for c in COUNTS),
    ]
)
#: What the mart takes from a product and from a customer.
PRODUCT_VALUES = ["product_type", "product_price"]
CUSTOMER_VALUES = ["customer_name", "customer_address", "customer_birthday", "customer_email"]


def state_of(star: dict[str, DataFrame], orders: DataFrame | None = None) -> DataFrame:
    """The grain of these orders, by default of all."""
    rows = order_rows(counted_orders(star["f_order"] if orders is None else orders), star["d_craftsman"], star["d_product"])
    return order_grain(rows).withColumn("price_sum", F.coalesce("price_sum", F.lit(0)))


def negated(grain: DataFrame) -> DataFrame:
    return grain.select(*GRAIN_KEYS, *[(-F.col(c)).alias(c) for c in COUNTS])


def combined(*grains: DataFrame) -> DataFrame:
    """The sum of grains and changes."""
    rows = reduce(DataFrame.unionByName, [g.select(*GRAIN_KEYS, *COUNTS) for g in grains])
    return rows.groupBy(*GRAIN_KEYS).agg(*[F.sum(c).alias(c) for c in COUNTS])


def net_change(plus: DataFrame, minus: DataFrame) -> DataFrame:
    """What the added and the taken back orders change: groups with a count that isn't zero."""
    some = reduce(lambda a, b: a | b, [F.col(c) != 0 for c in COUNTS])
    return combined(plus, negated(minus)).where(some)


def standing(*grains: DataFrame) -> DataFrame:
    """The state after its changes: groups that have orders."""
    return combined(*grains).where(F.col("n_rows") > 0)


def other_values(old: DataFrame, new: DataFrame, id_col: str, values: list[str], watermark) -> DataFrame:
    """Ids of rows loaded after the watermark whose ``values`` differ from their earlier ones."""
    before = old.select(id_col, *[F.col(c).alias(f"old_{c}") for c in values])
    after = new.where(F.col("load_dttm") > F.lit(watermark)).select(id_col, *values)
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"old_{c}")) for c in values])
    return after.join(before, id_col).where(~same).select(id_col)


def order_feed(added: DataFrame, removed: DataFrame, watermark) -> tuple[DataFrame, DataFrame]:
    """C5 as a change feed: the orders loaded after the watermark, and the same orders as they were.

    ``added`` and ``removed`` are the fact's rows in folders that only the newer and only the older version lists.
    The new orders are written once, so that their measured size decides how the old ones are joined.
    """
    plus = materialize(added.where(F.col("load_dttm") > F.lit(watermark)), "feed")
    return plus, removed.join(plus.select("order_id"), "order_id", "left_semi")


def with_orders_of(products: DataFrame, plus: DataFrame, minus: DataFrame, old: DataFrame, new: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The feed with all other orders of these products, from the old and from the new fact."""
    fed = plus.select("order_id")
    more = [fact.join(products, "product_id", "left_semi").join(fed, "order_id", "left_anti") for fact in (new, old)]
    return plus.unionByName(more[0]), minus.unionByName(more[1])


def feed_change(plus: DataFrame, minus: DataFrame, old: dict[str, DataFrame], new: dict[str, DataFrame]) -> DataFrame:
    """The change of the state from a feed, with the dimensions as they were and as they are."""
    return net_change(state_of(new, plus), state_of(old, minus))


def craftsman_change(change: DataFrame) -> DataFrame:
    """The change of the counts by customer and craftsman."""
    counts = change.groupBy("customer_id", "craftsman_id").agg(F.sum("n_craftsman").alias("craftsman_count"))
    return counts.where("craftsman_count != 0")


def maintained_counts(counts: DataFrame, change: DataFrame) -> DataFrame:
    """Counts of the customers in ``change`` after it; counts that fall to zero go."""
    touched = change.select("customer_id").distinct()
    rows = counts.join(touched, "customer_id", "left_semi").unionByName(change)
    summed = rows.groupBy("customer_id", "craftsman_id").agg(F.sum("craftsman_count").alias("craftsman_count"))
    return summed.where("craftsman_count > 0")


def maintained_top(top: DataFrame, counts: DataFrame, change: DataFrame, rank) -> DataFrame:
    """W1, W4 kept up to date: ``top``, with the customers of ``change`` ranked anew from their maintained counts by ``rank``."""
    touched = change.select("customer_id").distinct()
    again = rank(maintained_counts(counts, change))
    return top.join(touched, "customer_id", "left_anti").unionByName(again.select(*top.columns))

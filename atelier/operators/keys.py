"""Surrogate keys (K1): a distributed ``row_number() OVER (ORDER BY ...)``.

An unpartitioned window sorts everything in one task. Instead:

1. range-partition on the ordering columns and sort within partitions (ties
   are broken by all remaining columns);
2. tag each row with its partition id and its position in the partition
   (``monotonically_increasing_id`` keeps the position in its low 33 bits),
   and write the tagged rows once to the shared checkpoint folder. Range
   bounds come from sampling seeded by the RDD id, so they differ between
   two queries over the same input; storing the tags as columns makes the
   counting pass and the numbering pass agree, also after an executor loss;
3. count rows per partition from the written table: one small row per
   partition is fetched, turned into start offsets, and broadcast back as a
   local table (its size is bounded by the number of partitions, not by the
   data).

The result equals ``base + row_number() OVER (ORDER BY order_cols)`` whenever
the ordering columns are unique.
"""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from atelier.session import materialize

_POSITION_BITS = 33


def _sort_col(c: Column | str) -> Column:
    return F.col(c).asc_nulls_last() if isinstance(c, str) else c


def assign_ids_counted(
    df: DataFrame,
    order_cols: list[Column | str],
    id_col: str = "id",
    base: int = 0,
    num_partitions: int | None = None,
) -> tuple[DataFrame, int]:
    """Add ``id_col`` = base + 1, base + 2, ... in ``order_cols`` order.

    Returns the frame and the largest id assigned (``base`` when empty).
    """
    spark = df.sparkSession
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = [_sort_col(c) for c in order_cols]
    named = {c for c in order_cols if isinstance(c, str)}
    tie_break = [F.col(c).asc_nulls_last() for c in df.columns if c not in named]
    ranged = (
        df.repartitionByRange(n, *order)
        .sortWithinPartitions(*order, *tie_break)
        .withColumn("_pid", F.spark_partition_id())
    )
    position = F.monotonically_increasing_id() - F.shiftleft(
        F.col("_pid").cast("long"), _POSITION_BITS
    )
    tagged = materialize(ranged.withColumn("_pos", position), "ids")
    sizes = sorted(
        (r["_pid"], r["_n"])
        for r in tagged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n")).collect()
    )
    starts = [0, *accumulate(size for _, size in sizes)]
    total = starts[-1]
    offsets = spark.createDataFrame(
        [(pid, start) for (pid, _), start in zip(sizes, starts)] or [(0, 0)],
        "_pid int, _off long",
    )
    out = (
        tagged.join(F.broadcast(offsets), "_pid")
        .withColumn(id_col, F.lit(base).cast("long") + F.col("_off") + F.col("_pos") + F.lit(1))
        .drop("_pid", "_pos", "_off")
    )
    return out, base + total


def assign_ids(
    df: DataFrame,
    order_cols: list[Column | str],
    id_col: str = "id",
    base: int = 0,
    num_partitions: int | None = None,
) -> DataFrame:
    """``assign_ids_counted`` without the largest id."""
    return assign_ids_counted(df, order_cols, id_col, base, num_partitions)[0]

"""Constraint checks (Q1-Q4): the DDL's NOT NULL, keys and column ranges.

Parquet tables enforce none of these, so they run as jobs that report
violations; ``row_checks`` are those that a commit can depend on
(``tables.prepare_version``). Each is a single aggregation
(partial on the map side); nothing is collected except the small report.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

NUMERIC = (T.IntegerType, T.LongType, T.DecimalType, T.ShortType, T.ByteType)


def null_violations(df: DataFrame, not_null: list[str]) -> DataFrame:
    """Q1: one row per NOT NULL column with the number of NULLs in it."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in not_null])
    entries = F.array(
        *[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("null_rows")) for c in not_null]
    )
    return counts.select(F.explode(entries).alias("e")).select("e.column_name", "e.null_rows")


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Q2 / Q4: key values held by more than one row, with their row count."""
    return (
        df.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("rows_per_key"))
        .filter(F.col("rows_per_key") > 1)
    )


def row_checks(not_null: list[str], schema: T.StructType) -> dict[str, Column]:
    """Q1 and Q3 as conditions on a row: NULL in a NOT NULL column, or a value that its declared type doesn't hold."""
    nulls = {f"{c} is null": F.col(c).isNull() for c in not_null}
    numeric = [f for f in schema.fields if isinstance(f.dataType, NUMERIC)]
    ranges = {f"{f.name} isn't {f.dataType.simpleString()}": F.col(f.name).isNotNull() & F.col(f.name).try_cast(f.dataType).isNull() for f in numeric}
    return nulls | ranges


def range_violations(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Q3: per numeric target column, values that do not fit its declared type.

    A value fails when it is not NULL but ``try_cast`` to the target type is.
    """
    cols = [f for f in schema.fields if isinstance(f.dataType, NUMERIC) and f.name in df.columns]
    counts = df.agg(
        *[
            F.count_if(F.col(f.name).isNotNull() & F.col(f.name).try_cast(f.dataType).isNull()).alias(
                f.name
            )
            for f in cols
        ]
    )
    entries = F.array(
        *[
            F.struct(
                F.lit(f.name).alias("column_name"),
                F.lit(f.dataType.simpleString()).alias("declared_type"),
                F.col(f.name).alias("bad_rows"),
            )
            for f in cols
        ]
    )
    return counts.select(F.explode(entries).alias("e")).select(
        "e.column_name", "e.declared_type", "e.bad_rows"
    )

"""Assignment casts (F7): make a DataFrame fit a target schema by column name.

The reference inserts numerics into INT / DECIMAL / NUMERIC columns, which
rounds half away from zero. Spark's cast truncates toward zero, so values are
rounded (HALF_UP) to the target scale first. Columns are matched by name, never
by position: the reference's insert lists and select lists are in different
orders. With ANSI mode on, an out-of-range value raises instead of wrapping.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_FRACTIONAL = (T.DoubleType, T.FloatType, T.DecimalType)


def exact(df: DataFrame, column: str, dtype: T.DecimalType) -> DataFrame:
    """``column`` as ``dtype``; a value that the type can't hold unchanged raises.

    For key columns: rounding one would make it match another row or none.
    """
    value = F.col(column)
    if isinstance(df.schema[column].dataType, (T.DoubleType, T.FloatType)):
        value = value.cast("string").cast("decimal(38,18)")  # the decimal that the double prints as
    fitted = F.round(value, dtype.scale).cast(dtype)
    message = F.concat(F.lit(f"{column} can't be stored unchanged: "), F.col(column).cast("string"))
    same = value.isNull() | (fitted == value)
    return df.withColumn(column, F.when(same, fitted).otherwise(F.raise_error(message).cast(dtype)))


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Select ``schema``'s columns from ``df`` by name, rounding before casting."""
    source = {f.name: f.dataType for f in df.schema.fields}
    cols = []
    for field in schema.fields:
        if field.name not in source:
            raise ValueError(f"column {field.name!r} missing; have {sorted(source)}")
        src_type = source[field.name]
        col = F.col(field.name)
        if isinstance(field.dataType, _INTEGRAL) and isinstance(src_type, _FRACTIONAL):
            col = F.round(col, 0)
        elif isinstance(field.dataType, T.DecimalType) and isinstance(src_type, _FRACTIONAL):
            col = F.round(col, field.dataType.scale)
        cols.append(col.cast(field.dataType).alias(field.name))
    return df.select(*cols)


def report_types(df: DataFrame) -> DataFrame:
    """Decimal columns as DOUBLE, for engine-neutral result comparison.

    Stored tables keep their declared decimal types; query results handed to
    another engine for comparison carry the same exact values as doubles.
    """
    cols = [
        F.col(f.name).cast("double").alias(f.name)
        if isinstance(f.dataType, T.DecimalType)
        else F.col(f.name)
        for f in df.schema.fields
    ]
    return df.select(*cols)

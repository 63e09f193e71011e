"""Tables written to the shared folder between the steps of an operator.

``spark.checkpoint.dir`` names the folder; it is read from the session and set
here only where it is unset on a local master, as in tests. Each table has a
new folder, which Hadoop deletes when the application ends.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def shared_root(spark: SparkSession) -> str:
    root = spark.sparkContext.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        root = "file://" + tempfile.mkdtemp(prefix="atelier-llm-")
        spark.sparkContext.setCheckpointDir(root)
        root = spark.sparkContext.getCheckpointDir()
    return root.rstrip("/")


def shared_folder(spark: SparkSession, label: str) -> str:
    """The name of a new folder below the shared one; it goes when the application ends."""
    folder = f"{shared_root(spark)}/atelier-{label}-{uuid.uuid4().hex[:12]}"
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    fs.mkdirs(path)
    fs.deleteOnExit(path)
    return fs.makeQualified(path).toString()


def staged(df: DataFrame, label: str) -> DataFrame:
    """``df`` written once as Parquet and read back, so later steps don't compute it again."""
    folder = shared_folder(df.sparkSession, label) + "/rows"
    df.write.option("compression", "zstd").parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def with_types(df: DataFrame, **kinds: str) -> DataFrame:
    """The named columns, cast to these types, and no others; a missing one is null."""
    return df.select(*(
        (F.col(f"`{c}`") if c in df.columns else F.lit(None)).cast(kind).alias(c) for c, kind in kinds.items()
    ))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def schema(**kinds: str) -> T.StructType:
    """A schema from names and simple type names."""
    return T.StructType([T.StructField(c, T._parse_datatype_string(k)) for c, k in kinds.items()])


def remainder(column: str, divisor: int):
    """crc32 of the id as text, modulo ``divisor``; null for a null id."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % divisor

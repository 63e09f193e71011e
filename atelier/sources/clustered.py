"""Tables whose files lie by natural key, so that a merge needn't shuffle them.

Spark's own bucketing does the work: rows with one key are in files of one
bucket, numbered ``pmod(hash(keys), buckets)``, and a scan that knows it needs no
exchange to be joined on these keys. Spark takes the bucketing of a scan
from the session catalog, so for the time of a merge the folders of a version
are an external table there, a partition each, under a name of its own. No
other reader needs it: to them the folders are plain parquet.

A commit notes the number of buckets of each folder. Folders written with another number, or without
buckets, are read without (Spark shuffles them) and get the present layout when
they are written again.

Rows with a NULL in the key can match nothing. They have a partition of their own
that no merge reads and only new folders are added to; they never meet in one
bucket.
"""

from __future__ import annotations

import contextlib
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass(frozen=True)
class Clustering:
    """How the files of a table lie: by these keys, in so many buckets."""

    keys: tuple[str, ...]
    buckets: int

    @property
    def partition(self) -> tuple[str, Column]:
        """A folder for each bucket, named with their number: folders of two layouts are never mixed up."""
        return f"key_bucket_{self.buckets}", F.when(keyed(self.keys), F.pmod(F.hash(*self.keys), F.lit(self.buckets)))

    def holds(self, folders: list[dict]) -> bool:
        return all(f.get("buckets") == self.buckets for f in folders)


def keyed(keys) -> Column:
    """Whether no column of the key is NULL."""
    return reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])


def _quoted(name: str) -> str:
    return f"`{name.replace('`', '``')}`"


def _literal(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


@contextlib.contextmanager
def _catalog_name(spark: SparkSession) -> Iterator[str]:
    """A name in the session catalog; what it stands for is forgotten at the end, its files stay."""
    name = f"atelier_{uuid.uuid4().hex}"
    try:
        yield name
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


@contextlib.contextmanager
def clustered_rows(spark: SparkSession, folders: list[dict], schema: T.StructType, clustering: Clustering) -> Iterator[DataFrame]:
    """The rows of the folders, known to Spark to lie by the clustering's keys; for use inside the ``with``."""
    columns = ", ".join(f"{_quoted(f.name)} {f.dataType.simpleString()}" for f in schema)
    keys = ", ".join(map(_quoted, clustering.keys))
    with _catalog_name(spark) as name:
        spark.sql(
            f"CREATE TABLE {name} ({columns}, _folder int) USING parquet PARTITIONED BY (_folder) "
            f"CLUSTERED BY ({keys}) INTO {clustering.buckets} BUCKETS LOCATION {_literal(folders[0]['path'])}"
        )
        places = " ".join(f"PARTITION (_folder = {k}) LOCATION {_literal(f['path'])}" for k, f in enumerate(folders))
        spark.sql(f"ALTER TABLE {name} ADD {places}")
        yield spark.table(name).select(*schema.fieldNames())


def write_clustered(df: DataFrame, folder: str, partition: str, clustering: Clustering) -> None:
    """Write ``df`` below ``folder``, by its column ``partition`` and in buckets.

    A task writes a file for each partition and bucket it has rows of: give it rows that lie by the keys already.
    """
    with _catalog_name(df.sparkSession) as name:
        writer = df.write.format("parquet").mode("errorifexists").option("path", folder)
        writer.partitionBy(partition).bucketBy(clustering.buckets, *clustering.keys).saveAsTable(name)

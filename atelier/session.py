"""Session helpers.

Library code never creates its own session: every operator takes DataFrames
(or a ``SparkSession`` handed in by the caller). ``get_session`` is for tests,
``bench.py`` and command-line use.
"""

from __future__ import annotations

import contextlib
import tempfile
import threading
import uuid
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession


def get_session(
    master: str | None = None,
    shuffle_partitions: int | None = None,
    driver_memory: str | None = None,
    app_name: str = "atelier",
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Build (or reuse) a session configured for this project.

    Master, shuffle partitions and driver memory are set only where they are
    given (tests, bench); otherwise what ``spark-submit`` or the cluster says
    holds.

    AQE is on so that joins against dimensions switch to broadcast only when
    the runtime size is under ``spark.sql.adaptive.autoBroadcastJoinThreshold``
    (a checked size, with sort-merge beyond it), small shuffle partitions are
    coalesced, and skewed join partitions are split.
    """
    given = {
        "spark.master": master,
        "spark.sql.shuffle.partitions": shuffle_partitions,
        "spark.driver.memory": driver_memory,
    }
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config(map={k: str(v) for k, v in given.items() if v is not None})
    )
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster this setting names a shared file system folder and is read
    as given. Only where it is unset (local tests) a fresh folder is created
    and registered with the session.
    """
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        master = spark.sparkContext.master
        if not master.startswith("local"):
            raise RuntimeError(
                "spark.checkpoint.dir is not set: on a cluster it must name a shared folder"
            )
        configured = tempfile.mkdtemp(prefix="atelier-ckpt-")
    spark.sparkContext.setCheckpointDir(configured)
    return spark.sparkContext.getCheckpointDir() or configured


#: Folders of the scope that this thread of work is in.
_SCOPE: ContextVar[list[str] | None] = ContextVar("scratch", default=None)


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A new, unique folder under the shared checkpoint root for written stages.

    It goes when the innermost ``scratch_scope`` ends, or with the application.
    """
    folder = f"{checkpoint_root(spark).rstrip('/')}/atelier-{label}-{uuid.uuid4().hex[:12]}"
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    fs.mkdirs(path)  # a folder that isn't there can't be marked
    fs.deleteOnExit(path)
    if _SCOPE.get() is not None:
        _SCOPE.get().append(folder)
    return f"{folder}/rows"


@contextlib.contextmanager
def scratch_scope(spark: SparkSession):
    """Remove the scratch folders made inside when it ends: for jobs that return no frame over them.

    A thread started inside belongs to it if it runs in a copy of the context.
    """
    folders: list[str] = []
    token = _SCOPE.set(folders)
    try:
        yield
    finally:
        _SCOPE.reset(token)
        for folder in folders:
            path = spark._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


#: Spark's setting by which a command's shuffle files go when it ends; else they stay until the driver's garbage collection.
SHUFFLE_CLEANUP_CONF = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Writes that are running, and what the setting was before them, by session.
_WRITES: dict[int, tuple[int, str | None]] = {}
_WRITES_LOCK = threading.Lock()


@contextlib.contextmanager
def freed_shuffles(spark: SparkSession):
    """Remove the shuffle files of a write or another action made inside when it has ended.

    Only that action, and frames that nothing else reads, belong inside: a frame made there loses its shuffles after its first action.
    """
    key = id(spark)
    with _WRITES_LOCK:
        running, earlier = _WRITES.get(key) or (0, spark.conf.get(SHUFFLE_CLEANUP_CONF, None))
        _WRITES[key] = running + 1, earlier
        spark.conf.set(SHUFFLE_CLEANUP_CONF, "true")
    try:
        yield
    finally:
        with _WRITES_LOCK:
            running, earlier = _WRITES[key]
            if running > 1:
                _WRITES[key] = running - 1, earlier
            else:
                del _WRITES[key]
                spark.conf.unset(SHUFFLE_CLEANUP_CONF) if earlier is None else spark.conf.set(SHUFFLE_CLEANUP_CONF, earlier)


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Cut lineage: write ``df`` as a parquet table in the shared checkpoint
    folder and read it back. The shuffles of the write go with it.

    One job computes and writes the data (``Dataset.checkpoint`` on an
    unpersisted frame computes it twice: once to count, once to write), and
    the re-read gets column pruning and filter pushdown. A lost executor
    re-reads the files instead of recomputing the lineage.
    """
    path = scratch_dir(df.sparkSession, label)
    with freed_shuffles(df.sparkSession):
        df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.parquet(path)

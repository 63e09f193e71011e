"""Tables on plain parquet files: staging, create, append, versioned commit.

A table lives under a root folder in shared storage:

    <root>/_commits/<version>.json   one file per committed version
    <root>/data-<n>-<tag>/           parquet files written for version n

A commit lists the folders that make up the version, each with its rows and
the least and greatest load stamp in it, so a scan for newer rows skips
folders without reading them (P7). An overwrite lists only its new folder; an append
lists the previous folders plus the new one, so appending never rewrites old
files. A partitioned table lists one folder per partition value
(``<root>/data-<n>-<tag>/<col>=<value>``); a commit that replaces some
partitions writes only those and keeps the previous version's folders for the
others. A change of some keys' rows is a folder of the new rows and one of the keys,
merged when read (``read_version``). What two versions don't share is what changed between them
(``changed_folders``).

Writers write their folder first and publish the commit file last, under a name
that must not exist yet. Of two writers of one version one succeeds. The other
raises ``CommitConflict``, or, appending, goes on from the version that won: no
update is lost. A crash in between leaves an orphan folder that no reader sees
and ``retention`` removes. Readers list the commit folder, read the newest
file and then exactly its folders, so a table can be rewritten while a job is
still reading the previous version. None of this starts a Spark job.
"""

from __future__ import annotations

import contextlib
import datetime as dt
import json
import uuid
from dataclasses import dataclass
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from atelier.functions.conform import conform
from atelier.session import freed_shuffles
from atelier.sources.clustered import Clustering, write_clustered

COMMITS = "_commits"
STAMP = "load_dttm"
#: Folders of an appended table, beyond which an append writes them anew as one.
MOST_FOLDERS = 16


class CommitConflict(RuntimeError):
    """Another writer has committed the version that this one was about to commit."""


class CheckFailed(ValueError):
    """Rows of a version violate the checks that its commit depends on."""


def hadoop_path(spark: SparkSession, path: str):
    """The path for the JVM, and its file system."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark._jsc.hadoopConfiguration())


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether the file system has ``path``; any failure to find out is raised."""
    place, fs = hadoop_path(spark, path)
    return fs.exists(place)


def child_names(spark: SparkSession, path: str) -> list[str]:
    """The names in a folder; none if there is no such folder."""
    if not path_exists(spark, path):
        return []
    place, fs = hadoop_path(spark, path)
    return [status.getPath().getName() for status in fs.listStatus(place)]


def publish(spark: SparkSession, path: str, content: dict) -> bool:
    """Write ``path`` whole, unless it exists already; whether this call wrote it.

    The content goes to a file of its own and then gets its name in one step that
    fails where the name is taken: a hard link on a local disk, elsewhere a
    rename (atomic, without overwriting, in HDFS and file systems like it).
    """
    place, fs = hadoop_path(spark, path)
    draft = place.getParent().suffix(f"/.{uuid.uuid4().hex}")
    fs.mkdirs(place.getParent())
    out = fs.create(draft, False)
    out.write(bytearray(json.dumps(content).encode()))
    out.close()
    try:
        if fs.getScheme() != "file":
            return fs.rename(draft, place)
        local = [spark._jvm.java.io.File(x.toUri().getPath()).toPath() for x in (place, draft)]
        try:
            spark._jvm.java.nio.file.Files.createLink(*local)
        except Py4JJavaError as error:
            if "FileAlreadyExists" not in error.java_exception.getClass().getName():
                raise
            return False
        return True
    finally:
        fs.delete(draft, False)


def read_json(spark: SparkSession, path: str) -> dict:
    place, fs = hadoop_path(spark, path)
    stream = fs.open(place)
    try:
        return json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def _commit_file(root: str, version: int) -> str:
    return f"{root.rstrip('/')}/{COMMITS}/{version:012d}.json"


def numbers(names: list[str]) -> list[int]:
    """The numbers of files named ``<number>.json``, ascending."""
    return sorted(int(n.split(".")[0]) for n in names if n.endswith(".json") and not n.startswith("."))


def versions(spark: SparkSession, root: str) -> list[int]:
    """The committed versions of a table, ascending."""
    return numbers(child_names(spark, f"{root.rstrip('/')}/{COMMITS}"))


def commit_of_version(spark: SparkSession, root: str, version: int) -> dict:
    """The commit of one version: version, folders, paths, max_id and note."""
    commit = read_json(spark, _commit_file(root, version))
    return commit | {"paths": [f["path"] for f in commit["folders"]]}


def current_commit(spark: SparkSession, root: str) -> dict | None:
    """The newest commit of the table, or None when it has none."""
    known = versions(spark, root)
    return commit_of_version(spark, root, known[-1]) if known else None


def changed_folders(old: dict | None, new: dict) -> tuple[list[dict], list[dict]]:
    """The folders of ``new`` that ``old`` doesn't have, and those of ``old`` that ``new`` doesn't."""
    before = {f["path"]: f for f in (old or {}).get("folders", [])}
    after = {f["path"]: f for f in new["folders"]}
    return [f for p, f in after.items() if p not in before], [f for p, f in before.items() if p not in after]


def stamp_literal(value: dt.date) -> int:
    """Microseconds of a load stamp, as the commits keep them. A stamp without a zone is the local zone's, as for Spark."""
    moment = value if isinstance(value, dt.datetime) else dt.datetime.combine(value, dt.time())
    return round(moment.timestamp() * 1_000_000)


def folders_since(folders: list[dict], stamp: dt.date) -> list[dict]:
    """The folders that may hold rows loaded after ``stamp``, by the stamps in their commit."""
    after = stamp_literal(stamp)
    return [f for f in folders if f["rows"] and (f["high"] is None or f["high"] > after)]


def newest_stamp(folders: list[dict]) -> dt.datetime | None:
    """The greatest load stamp in the folders."""
    high = max((f["high"] for f in folders if f["high"] is not None), default=None)
    return None if high is None else dt.datetime.fromtimestamp(high / 1_000_000)


def read_table(spark: SparkSession, root: str, schema: T.StructType) -> DataFrame:
    """Read the newest committed version of the table at ``root``."""
    commit = current_commit(spark, root)
    if commit is None:
        raise FileNotFoundError(f"no committed version under {root}")
    return read_version(spark, commit["folders"], schema)


def read_version(spark: SparkSession, folders: list[dict], schema: T.StructType) -> DataFrame:
    """The rows of a version's folders: later changes replace earlier rows of the same keys (merge on read).

    A folder of a change names the folder with its keys in ``replaces``: of these keys, only rows in it or in later
    folders count. The keys are one row each per change, and joined where their size says.
    """
    changes = [f for f in folders if "replaces" in f]
    rows = read_paths(spark, [f["path"] for f in folders if "replaces" not in f], schema)
    if not changes:
        return rows
    key = changes[0]["by"]
    rows = rows.withColumn("_change", F.lit(0))
    replaced = []
    for k, f in enumerate(changes, 1):
        rows = rows.unionByName(read_paths(spark, [f["path"]], schema).withColumn("_change", F.lit(k)))
        replaced.append(spark.read.schema(T.StructType([schema[key]])).parquet(f["replaces"]).withColumn("_last", F.lit(k)))
    last = reduce(DataFrame.unionByName, replaced).groupBy(key).agg(F.max("_last").alias("_last"))
    held = rows.join(last, key, "left").where(F.col("_last").isNull() | (F.col("_change") >= F.col("_last")))
    return held.select(*schema.fieldNames())


def read_paths(spark: SparkSession, paths: list[str], schema: T.StructType) -> DataFrame:
    """Read the listed folders with ``schema``; no folders is an empty table."""
    if not paths:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*paths)


NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"


def partition_dir_value(value) -> str:
    """How a partition value appears in its folder name."""
    return NULL_PARTITION if value is None else str(value)


def partition_value(path: str, column: str) -> str | None:
    """The partition value a folder holds (``.../<column>=<value>``), else None."""
    leaf = path.rstrip("/").rsplit("/", 1)[-1]
    prefix = f"{column}="
    return leaf[len(prefix):] if leaf.startswith(prefix) else None


def partition_paths(commit: dict | None, column: str, values) -> list[str]:
    """Folders of ``commit`` holding the given partition values."""
    wanted = {partition_dir_value(v) for v in values}
    return [p for p in (commit or {}).get("paths", []) if partition_value(p, column) in wanted]


def _written_folders(spark: SparkSession, folder: str, schema: T.StructType, name: str | None, id_col: str | None) -> tuple[list[dict], int | None]:
    """The folders of a write with their rows and stamps, and the largest id; one job over at most two columns.

    Read back from what was written, so the frame isn't computed a second time. A row for each partition value.
    """
    place, fs = hadoop_path(spark, folder)
    if name is not None and not any(s.getPath().getName().startswith(f"{name}=") for s in fs.listStatus(place)):
        return [], None  # an empty frame leaves no partition folder
    columns = [f for f in schema.fields if f.name in (STAMP, id_col)]
    kinds = T.StructType(columns + ([T.StructField(name, T.StringType())] if name else []))
    written = spark.read.schema(kinds).option("basePath", folder).parquet(folder)
    stamped = STAMP in kinds.fieldNames()
    low, high = (f(F.unix_micros(F.col(STAMP).cast("timestamp"))) if stamped else F.lit(None) for f in (F.min, F.max))
    largest = F.max(id_col) if id_col else F.lit(None)
    facts = written.groupBy(*([name] if name else [])).agg(
        F.count(F.lit(1)).alias("rows"), low.alias("low"), high.alias("high"), largest.alias("largest")
    )
    found = facts.collect()
    folders = [
        {"path": f"{folder}/{name}={partition_dir_value(r[name])}" if name else folder, "rows": r["rows"], "low": r["low"], "high": r["high"]}
        for r in found
    ]
    return folders, max((r["largest"] for r in found if r["largest"] is not None), default=None)


#: Stands for the table's newest commit.
NEWEST = object()


@dataclass
class Prepared:
    """A version whose folders are written, but which no reader sees yet."""

    root: str
    version: int
    folders: list[dict]
    max_id: int | None
    note: dict
    written: list[dict]


def prepare_version(
    df: DataFrame,
    root: str,
    schema: T.StructType,
    mode: str = "overwrite",
    max_id: int | None = None,
    partition: tuple[str, Column] | None = None,
    id_col: str | None = None,
    replace_partitions: list[str] | None = None,
    base=NEWEST,
    after: int | None = None,
    note: dict | None = None,
    checks: dict[str, Column] | None = None,
    clustering: Clustering | None = None,
    placed: bool = False,
) -> Prepared:
    """Write ``df`` as the next version's folders; ``publish_version`` commits it. Parameters: see ``commit_version``."""
    spark = df.sparkSession
    if after is None:
        after = (versions(spark, root) or [0])[-1]
    if base is NEWEST:
        base = commit_of_version(spark, root, after) if after else None
    folder = f"{root.rstrip('/')}/data-{after + 1:08d}-{uuid.uuid4().hex[:8]}"
    observed = Observation("checks") if checks else None
    if observed is not None:
        df = df.observe(observed, *[F.count_if(bad).alias(c) for c, bad in checks.items()])
    out = conform(df, schema)
    name = None
    if partition is not None:
        name, expr = partition
    with freed_shuffles(spark):
        if clustering is not None:
            if not placed:
                out = out.repartition(clustering.buckets, *clustering.keys)
            write_clustered(out.withColumn(name, expr), folder, name, clustering)
        elif partition is not None:
            # REBALANCE lets AQE pack small partition values into one file and
            # split a large one into advisory-size files (no small-file explosion
            # of one file per task and value, no single huge file per value).
            out = out.withColumn(name, expr).hint("rebalance", name)
            out.write.mode("errorifexists").partitionBy(name).parquet(folder)
        else:
            out.write.mode("errorifexists").parquet(folder)
    failed = {c: n for c, n in observed.get.items() if n} if observed is not None else {}
    if failed:
        place, fs = hadoop_path(spark, folder)
        fs.delete(place, True)
        raise CheckFailed(f"{root}: rows that violate a check: {failed}; the version isn't committed")
    new, largest = _written_folders(spark, folder, schema, name, id_col)
    if clustering is not None:
        new = [f | {"buckets": clustering.buckets} for f in new]
    kept = []
    if base is not None and mode == "append":
        kept = base["folders"]
    elif base is not None and replace_partitions is not None and name is not None:
        replaced = {partition_dir_value(v) for v in replace_partitions}
        kept = [f for f in base["folders"] if partition_value(f["path"], name) not in replaced]
    known = (base or {}).get("max_id")
    if id_col is not None:
        max_id = max(largest or 0, known or 0) if mode == "append" else largest or 0
    elif max_id is None:
        max_id = known
    return Prepared(root, after + 1, kept + new, max_id, note or {}, new)


def publish_version(spark: SparkSession, prepared: Prepared) -> int:
    """Commit a prepared version, or raise ``CommitConflict`` where another writer has committed that version."""
    content = {
        "version": prepared.version,
        "committed_at": dt.datetime.now(dt.timezone.utc).isoformat(),
        "folders": prepared.folders,
        "max_id": prepared.max_id,
        "note": prepared.note,
    }
    if not publish(spark, _commit_file(prepared.root, prepared.version), content):
        raise CommitConflict(f"version {prepared.version} of {prepared.root} was committed by another writer")
    return prepared.version


def commit_version(df: DataFrame, root: str, schema: T.StructType, mode: str = "overwrite", exclusive: bool = True, **how) -> int:
    """Write ``df`` (conformed to ``schema``) and commit it as the next version.

    ``base`` is the commit that the new version goes on from, and ``after`` the
    newest version that the writer knew when it read its input; the new version
    is the one after it. Where another writer has committed that by now,
    ``CommitConflict`` is raised, and the caller may read again. By default both
    are the newest commit as of now.

    ``mode='append'`` keeps the base's folders in the new version, and goes on from
    a version that another writer has committed meanwhile. Without ``exclusive`` the version
    takes the next free number: for writers whose ``base`` a manifest names, and whose own
    manifest decides which version counts.
    With ``id_col`` the largest id is read back from the written folder (one
    column, pruned scan) and kept in the commit for the next id range; otherwise
    ``max_id`` is, by default that of the base.

    ``partition=(name, expr)`` lays the files out by the derived column
    ``name`` (not stored in the files; readers read the listed folders).
    With ``replace_partitions`` only those partition values are replaced:
    ``df`` holds their complete new content, and the base's folders for every
    other value are kept as they are. ``note`` is kept in the commit.

    With ``clustering`` (and ``partition``) the files of each partition lie in buckets by its keys,
    see ``clustered``. ``placed`` says that ``df`` lies by these keys already; else it is shuffled.

    ``checks`` are conditions that no row may meet, by name (Q1, Q3). They are
    counted in the pass that writes; if a row meets one, the folder goes, and ``CheckFailed`` leaves
    the table at its old version. A repeated task may count a row twice, which makes
    a zero no less a zero.
    """
    spark = df.sparkSession
    prepared = prepare_version(df, root, schema, mode, **how)
    while True:
        try:
            return publish_version(spark, prepared)
        except CommitConflict:
            if mode != "append" and exclusive:
                raise
        newest = current_commit(spark, root)
        if mode != "append":
            prepared.version = newest["version"] + 1
            continue
        known = [v for v in (prepared.max_id, newest["max_id"]) if v is not None]
        prepared = Prepared(root, newest["version"] + 1, newest["folders"] + prepared.written, max(known, default=None), prepared.note, prepared.written)


def create_table(spark: SparkSession, schema: T.StructType, root: str) -> int:
    """(re)create the table empty with ``schema`` as a new version."""
    empty = spark.createDataFrame([], schema)
    return commit_version(empty, root, schema, mode="overwrite", max_id=0)


def append_rows(spark: SparkSession, root: str, rows: DataFrame, schema: T.StructType, max_id=None) -> int:
    """INSERT INTO ... SELECT: columns matched by name, conformed, appended.

    A table of more than ``MOST_FOLDERS`` folders is first written anew as one folder, so that
    commits and scans stay short however many appends there were.
    """
    commit = current_commit(spark, root)
    if commit is not None and len(commit["folders"]) >= MOST_FOLDERS:
        whole = read_paths(spark, commit["paths"], schema).coalesce(1)
        with contextlib.suppress(CommitConflict):  # another writer's rows are only in its version: left for a later append
            commit_version(whole, root, schema, base=commit, after=commit["version"], note=commit["note"])
    return commit_version(rows, root, schema, mode="append", max_id=max_id)


def stage(df: DataFrame, name: str) -> DataFrame:
    """A session-scoped staging table: a temp view over a persisted frame."""
    staged = df.persist()
    staged.createOrReplaceTempView(name)
    return staged


def write_stage(df: DataFrame, path: str) -> DataFrame:
    """Materialise a stage as files (the drafts' DROP + CREATE TABLE AS). The shuffles of the write go with it."""
    with freed_shuffles(df.sparkSession):
        df.write.mode("overwrite").option("compression", "zstd").parquet(path)
    return df.sparkSession.read.parquet(path)

"""One snapshot of the star schema (S3): the manifest of its four tables' versions.

A load commits each table on its own and, last, one manifest that names
the four versions, under a number that must be free. Readers resolve the newest
manifest and read exactly those versions, so they never see a load half done. A
load goes on from the newest manifest's versions as well: what a failed load has
committed is behind no manifest, and its repetition doesn't see it. A load's stamp must be
later than that of the newest manifest: the refresh looks for rows stamped
after its watermark, and a load stamped at or before it would be missed.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession

from atelier.schemas import D_CRAFTSMAN, D_CUSTOMER, D_PRODUCT, F_ORDER
from atelier.sources.tables import CommitConflict, child_names, commit_of_version, current_commit, numbers, publish, read_json, read_paths, stamp_literal

STAR_TABLES = {"d_craftsman": D_CRAFTSMAN, "d_product": D_PRODUCT, "d_customer": D_CUSTOMER, "f_order": F_ORDER}
MANIFEST = "_star"


def manifest_file(dwh_root: str, number: int) -> str:
    return f"{dwh_root.rstrip('/')}/{MANIFEST}/{number:012d}.json"


def manifests(spark: SparkSession, dwh_root: str) -> list[int]:
    """The numbers of the manifests, ascending."""
    return numbers(child_names(spark, f"{dwh_root.rstrip('/')}/{MANIFEST}"))


def manifest(spark: SparkSession, dwh_root: str, number: int) -> dict:
    """number, as_of and versions of one manifest."""
    found = read_json(spark, manifest_file(dwh_root, number))
    return found | {"as_of": dt.datetime.fromtimestamp(found["as_of"] / 1_000_000)}


def newest_manifest(spark: SparkSession, dwh_root: str) -> dict | None:
    known = manifests(spark, dwh_root)
    return manifest(spark, dwh_root, known[-1]) if known else None


def as_timestamp(value: dt.date) -> dt.datetime:
    return value if isinstance(value, dt.datetime) else dt.datetime.combine(value, dt.time())


def check_stamp(spark: SparkSession, dwh_root: str, as_of: dt.date) -> None:
    """Refuse a load stamp that isn't after the newest committed one."""
    newest = newest_manifest(spark, dwh_root)
    if newest is not None and as_timestamp(as_of).timestamp() <= newest["as_of"].timestamp():
        raise ValueError(f"load stamp {as_of} isn't after {newest['as_of']}, that of the last load")


def star_commits(spark: SparkSession, dwh_root: str, number: int | None = None) -> dict[str, dict] | None:
    """The commits of the four tables in one manifest, by default the newest; None where there is none."""
    found = newest_manifest(spark, dwh_root) if number is None else manifest(spark, dwh_root, number)
    if found is None:
        return None
    return {name: commit_of_version(spark, f"{dwh_root}/{name}", found["versions"][name]) for name in STAR_TABLES}


def commit_star(spark: SparkSession, dwh_root: str, as_of: dt.date, named: dict[str, int] | None = None, number: int | None = None) -> int:
    """Make these versions, by default the newest of each table, visible to readers, together.

    ``number`` is the manifest's, by default the next. If another load has taken it, ``CommitConflict`` is raised.
    """
    if number is None:
        number = (manifests(spark, dwh_root) or [0])[-1] + 1
    named = named or {name: current_commit(spark, f"{dwh_root}/{name}")["version"] for name in STAR_TABLES}
    if not publish(spark, manifest_file(dwh_root, number), {"number": number, "as_of": stamp_literal(as_of), "versions": named}):
        raise CommitConflict(f"manifest {number} of {dwh_root} was committed by another load")
    return number


def read_commits(spark: SparkSession, commits: dict[str, dict], names: tuple[str, ...] = tuple(STAR_TABLES)) -> dict[str, DataFrame]:
    return {name: read_paths(spark, commits[name]["paths"], STAR_TABLES[name]) for name in names}


def read_star(spark: SparkSession, dwh_root: str) -> dict[str, DataFrame]:
    """The four star tables at the versions of the newest manifest."""
    commits = star_commits(spark, dwh_root)
    if commits is None:
        raise FileNotFoundError(f"no complete load under {dwh_root}")
    return read_commits(spark, commits)

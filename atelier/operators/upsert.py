"""MERGE and UPDATE ... FROM on plain files.

``merge_upsert`` reproduces ``MERGE INTO target USING source ON keys``:

- matched: the ``set_cols`` take the source values and ``load_col`` is
  stamped with ``as_of``, even when nothing changed (the reference has no
  change test). Key and surrogate id stay.
- not matched: the source row is inserted with a new surrogate id. A NULL in
  a key never matches, so such rows are always inserted, and two unmatched
  source rows with one key are both inserted.
- target rows without a source row stay as they are.
- two source rows for one matched target row is an error (M5), as in the
  reference; the check runs before anything is written.

Two modes go beyond the reference:

- ``on_conflict='latest'``: of several source rows with one key (no NULL in it) the one with the
  greatest ``latest_by`` columns counts, matched or not; the other columns, in the source's order,
  break ties, so the choice doesn't depend on the rows' order. It is an aggregate that
  combines on the map side. Rows with a NULL in the key are all inserted.
- ``only_if_changed``: a matched row whose ``set_cols`` are all equal (NULL equal to NULL)
  stays as it is, load stamp included, so a reload of unchanged sources changes nothing.

Source and target meet once on the natural key: ``source LEFT JOIN target
keys`` is written to the shared folder with the matched target id, and the
conflicts (ids matched more than once), the updates (by id) and the inserts
(rows without an id, numbered by ``assign_ids`` after the largest id) are read
from it. The source is on the left, where AQE can split a hot key.
Physical strategies are left to the planner: a side is broadcast only when
its measured size is under the threshold, otherwise both are shuffled.

``merge_clustered`` is the same for a target whose files lie by the natural key
(``sources.clustered``). It joins on the key both times: first source and target keys, to number
the inserts, then the target and its changes (updates and inserts), in one full outer join. The
target has no exchange in either; the source's rows go to its buckets.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from atelier.operators.keys import assign_ids_counted
from atelier.session import freed_shuffles, materialize
from atelier.sources.clustered import keyed


class MergeConflict(ValueError):
    """More than one source row matched one target row."""


def merge_conflicts(target: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    """M5: source keys with more than one row that also match a target row."""
    per_key = source.groupBy(*keys).agg(F.count(F.lit(1)).alias("source_rows"))
    dups = per_key.filter(F.col("source_rows") > 1)
    return dups.join(target.select(*keys), keys, "left_semi")


def _eq(left: DataFrame, right: DataFrame, keys: list[str], prefix: str) -> Column:
    return reduce(lambda a, b: a & b, [left[k] == right[f"{prefix}{k}"] for k in keys])


def check_no_conflicts(matched: DataFrame, keys: list[str], id_col: str) -> None:
    """Raise ``MergeConflict`` when two source rows matched one target row (one aggregate job)."""
    with freed_shuffles(matched.sparkSession):
        per_row = matched.groupBy(id_col).agg(F.count(F.lit(1)).alias("source_rows"), F.min(F.struct(*keys)).alias("key"))
        stats = (
            per_row.filter((F.col("source_rows") > 1) & F.col(id_col).isNotNull())
            .agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("key", "source_rows")).alias("example"))
            .first()
        )
    if stats["n"]:
        raise MergeConflict(
            f"{stats['n']} target rows matched by several source rows, e.g. {stats['example']}"
        )


def latest_rows(source: DataFrame, keys: list[str], latest_by: list[str]) -> DataFrame:
    """One row for each key without NULL, that with the greatest ``latest_by``, then the greatest other columns; and all rows with a NULL in the key."""
    no_null = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    rest = [c for c in source.columns if c not in keys]
    if not rest:
        return source.where(no_null).distinct().unionByName(source.where(~no_null))
    order = F.struct(*latest_by, *[c for c in rest if c not in latest_by])
    best = source.where(no_null).groupBy(*keys).agg(F.max_by(F.struct(*rest), order).alias("_row"))
    return best.select(*keys, *[F.col(f"_row.{c}").alias(c) for c in rest]).unionByName(source.where(~no_null))


def merge_upsert(
    target: DataFrame,
    source: DataFrame,
    keys: list[str],
    set_cols: list[str],
    as_of,
    id_col: str,
    load_col: str = "load_dttm",
    check_conflicts: bool = True,
    base_id: int | None = None,
    on_conflict: str = "error",
    latest_by: list[str] | None = None,
    only_if_changed: bool = False,
) -> DataFrame:
    """Return the target after the merge (same columns as ``target``).

    ``base_id`` is the target's largest id (from its commit log); when not
    given it is read from the target.
    """
    return merge_upsert_counted(
        target, source, keys, set_cols, as_of, id_col, load_col, check_conflicts, base_id, on_conflict, latest_by, only_if_changed
    )[0]


def merge_upsert_counted(
    target: DataFrame,
    source: DataFrame,
    keys: list[str],
    set_cols: list[str],
    as_of,
    id_col: str,
    load_col: str = "load_dttm",
    check_conflicts: bool = True,
    base_id: int | None = None,
    on_conflict: str = "error",
    latest_by: list[str] | None = None,
    only_if_changed: bool = False,
) -> tuple[DataFrame, int]:
    """``merge_upsert`` that also returns the largest id after the merge."""
    if on_conflict not in ("error", "latest"):
        raise ValueError(f"on_conflict is 'error' or 'latest', not {on_conflict!r}")
    if on_conflict == "latest":
        source = latest_rows(source, keys, latest_by or [])
        check_conflicts = False  # one row a key is left
    src_cols = [c for c in source.columns if c in target.columns and c not in (id_col, load_col)]
    s = source.select(*src_cols)
    t = target.select(F.col(id_col), *[F.col(k).alias(f"t_{k}") for k in keys])
    met = materialize(s.join(t, _eq(s, t, keys, "t_"), "left").select(id_col, *src_cols), "merge")
    matched = met.filter(F.col(id_col).isNotNull())
    if check_conflicts:
        check_no_conflicts(matched, keys, id_col)
    stamp = F.lit(as_of).cast(target.schema[load_col].dataType)
    new_values = matched.select(
        F.col(id_col).alias("_id"), *[F.col(c).alias(f"s_{c}") for c in src_cols if c in set_cols]
    )
    joined = target.join(new_values, F.col(id_col) == F.col("_id"), "left")
    hit = F.col("_id").isNotNull()
    if only_if_changed:
        same = [F.col(f"s_{c}").eqNullSafe(F.col(c)) for c in src_cols if c in set_cols]
        hit = hit & ~reduce(lambda a, b: a & b, same, F.lit(True))
    updated = joined.select(
        *[
            (F.when(hit, F.col(f"s_{c}")).otherwise(F.col(c)) if c in set_cols else F.col(c)).alias(c)
            if c != load_col
            else F.when(hit, stamp).otherwise(F.col(c)).alias(c)
            for c in target.columns
        ]
    )
    new_rows = met.filter(F.col(id_col).isNull()).select(*src_cols)
    if base_id is None:
        with freed_shuffles(target.sparkSession):
            base_id = target.agg(F.max(id_col).alias("m")).first()["m"]
    base = base_id or 0
    inserted, max_id = assign_ids_counted(
        new_rows, keys + [c for c in src_cols if c not in keys], id_col, base
    )
    inserted = inserted.select(
        *[
            F.col(c)
            if c in src_cols or c == id_col
            else (stamp.alias(c) if c == load_col else F.lit(None).cast(target.schema[c].dataType).alias(c))
            for c in target.columns
        ]
    )
    return updated.unionByName(inserted), max_id


def merge_clustered(
    target: DataFrame | None,
    source: DataFrame,
    keys: list[str],
    set_cols: list[str],
    as_of,
    id_col: str,
    schema: T.StructType,
    base_id: int,
    buckets: int,
    load_col: str = "load_dttm",
    on_conflict: str = "error",
    latest_by: list[str] | None = None,
    only_if_changed: bool = False,
) -> tuple[DataFrame, int]:
    """``merge_upsert_counted`` for the part of a target that lies by its key: the rows that the source may match.

    ``target`` is None where there are no such rows. The result lies by the key, but for inserted rows with
    a NULL in it, which keep the ranges of their ids.
    """
    if on_conflict not in ("error", "latest"):
        raise ValueError(f"on_conflict is 'error' or 'latest', not {on_conflict!r}")
    if on_conflict == "latest":
        source = latest_rows(source, keys, latest_by or [])
    src_cols = [c for c in source.columns if c in schema.names and c not in (id_col, load_col)]
    kept = [c for c in src_cols if c in set_cols]
    s = source.select(*src_cols)
    order = keys + [c for c in src_cols if c not in keys]
    stamp = F.lit(as_of).cast(schema[load_col].dataType)

    def whole(rows: DataFrame) -> DataFrame:
        made = {load_col: stamp} | {c: F.col(c) for c in (*src_cols, id_col)}
        return rows.select(*[made.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in schema])

    if target is None:
        inserted, max_id = assign_ids_counted(s, order, id_col, base_id)
        rows = whole(inserted)
        return rows.where(keyed(keys)).repartition(buckets, *keys).unionByName(rows.where(~keyed(keys))), max_id
    t = target.select(F.col(id_col), *[F.col(k).alias(f"t_{k}") for k in keys])
    with_key = s.where(keyed(keys))
    met = materialize(with_key.join(t, _eq(with_key, t, keys, "t_"), "left").select(id_col, *src_cols), "merge")
    matched = met.where(F.col(id_col).isNotNull())
    if on_conflict == "error":
        check_no_conflicts(matched, keys, id_col)
    unmatched = met.where(F.col(id_col).isNull()).select(*src_cols)
    inserted, max_id = assign_ids_counted(unmatched.unionByName(s.where(~keyed(keys))), order, id_col, base_id)
    # One source row for each matched key is left, but a key may stand in several target rows.
    updates = matched.groupBy(*keys).agg(F.max(F.struct(*kept)).alias("_new")) if kept else matched.select(*keys).distinct()
    updates = updates.select(*keys, *[F.col(f"_new.{c}").alias(c) for c in kept])
    changes = inserted.where(keyed(keys)).unionByName(updates, allowMissingColumns=True)
    changes = changes.select(*[F.col(c).alias(f"s_{c}") for c in changes.columns])
    joined = target.join(changes, _eq(target, changes, keys, "s_"), "full_outer")
    old = F.col(id_col).isNotNull()
    hit = old & F.col(f"s_{keys[0]}").isNotNull()
    if only_if_changed:
        hit = hit & ~reduce(lambda a, b: a & b, [F.col(f"s_{c}").eqNullSafe(F.col(c)) for c in kept], F.lit(True))

    def merged(f: T.StructField) -> Column:
        c = f.name
        if c == load_col:
            return F.when(old & ~hit, F.col(c)).otherwise(stamp)
        new = F.col(f"s_{c}") if c == id_col or c in src_cols else F.lit(None)
        return F.when(hit | ~old if c in kept else ~old, new).otherwise(F.col(c))

    rows = joined.select(*[merged(f).cast(f.dataType).alias(f.name) for f in schema])
    return rows.unionByName(whole(inserted.where(~keyed(keys)))), max_id


def update_from(
    target: DataFrame,
    source: DataFrame,
    keys: list[str],
    set_cols: list[str],
    pick_by: list[str] | None = None,
) -> DataFrame:
    """``UPDATE target SET set_cols = source.* FROM source WHERE keys match``.

    When several source rows match one target row the reference applies an
    unspecified one; ``pick_by`` makes the choice deterministic (the source row
    with the greatest ``pick_by`` values). Without it the source must be
    unique on ``keys``. The reduction is an aggregate (partial on the map side),
    so a key with very many source rows is never gathered in one task.
    """
    src = source.select(*keys, *[c for c in set_cols if c not in keys])
    if pick_by:
        payload = [c for c in src.columns if c not in keys]
        reduced = src.groupBy(*keys).agg(
            F.max_by(F.struct(*payload), F.struct(*pick_by)).alias("_row")
        )
        src = reduced.select(*keys, *[F.col(f"_row.{c}").alias(c) for c in payload])
    s = src.select(*[F.col(c).alias(f"s_{c}") for c in src.columns]).withColumn(
        "_matched", F.lit(True)
    )
    joined = target.join(s, _eq(target, s, keys, "s_"), "left")
    hit = F.col("_matched").isNotNull()
    return joined.select(
        *[
            (F.when(hit, F.col(f"s_{c}")).otherwise(F.col(c)) if c in set_cols else F.col(c)).alias(c)
            for c in target.columns
        ]
    )

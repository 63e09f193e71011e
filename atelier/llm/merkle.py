"""A Merkle manifest of a dataset, by slot pivot.

Every row is a leaf. The leaves of a group (a source) ascend by id; every run of
``fanout`` neighbours is hashed to their parent until one node is left, the
group's subroot, and the subroots, ordered by group, are hashed likewise to the
root. All groups climb together, a level at a time: conditional aggregates by
(group, parent's position) spread a run's children into ``fanout`` slot
columns. The columns concatenated hash to the parent; the columns but a child's
own are its siblings, in the slots before and after it. Paths go down the same
pivoted levels: a child's path is its siblings and then its parent's path.

Only DataFrame functions are used. No group is gathered: positions come from
range-partitioned, sorted and written rows (a hot group spans many partitions)
plus the rows of the group in earlier partitions, a table with a row for each
partition and group; an aggregate sees ``fanout`` rows.

Defined results: a null field is ``-`` in its leaf. Rows without an id come
before the others of their group; rows of one id are ordered by their leaves.
The null group comes first. An empty table has no leaves and no root.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from atelier.llm.staging import staged, with_types

FANOUT = 16
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: The low bits of ``monotonically_increasing_id`` hold a row's place in its partition.
PLACE_BITS = 33


def digest(*parts: Column) -> Column:
    """SHA-256, in lowercase hex, of the concatenated texts."""
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def field(value: Column) -> Column:
    """A field of a leaf: its length in bytes and its value, or ``-`` for null."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(**changed: Column) -> Column:
    """The leaf of a row, with some fields replaced."""
    return digest(*(field(changed.get(c, F.col(c))) for c in FIELDS))


def lower_ascii(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def positions(rows: DataFrame, group: list[str], order: list[str]) -> DataFrame:
    """``rows`` with ``idx``, their place in their group from 0, and ``n``, the group's size."""
    by = [F.col(c).asc_nulls_first() for c in (*group, *order)]
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = rows.repartitionByRange(parts, *by).sortWithinPartitions(*by)
    placed = staged(ranged.withColumn("_at", F.monotonically_increasing_id()), "merkle-placed")
    placed = placed.withColumn("_part", F.shiftright("_at", PLACE_BITS))
    runs = placed.groupBy(*group, "_part").agg(F.min("_at").alias("_first"), F.count("*").alias("_rows"))
    sizes = runs.groupBy(*group).agg(F.sum("_rows").alias("n"))
    before = _before(runs, group)
    starts = _joined(before, sizes, group).select(*group, "_part", "_first", "_before", "n")
    out = _joined(placed, starts, [*group, "_part"])
    return out.withColumn("idx", F.col("_at") - F.col("_first") + F.col("_before")).drop("_at", "_part", "_first", "_before")


def _before(runs: DataFrame, group: list[str]) -> DataFrame:
    """With ``_before``, the group's rows in earlier partitions.

    Only a partition's first and last group reach beyond it, so a window over a group has a row for each partition.
    """
    earlier = Window.partitionBy(*group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    return runs.withColumn("_before", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)))


def _joined(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """An inner join in which null keys are equal."""
    renamed = right.select(*(F.col(c).alias(f"_{c}_r") if c in keys else F.col(c) for c in right.columns))
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_{c}_r")) for c in keys])
    return left.join(renamed, same).drop(*(f"_{c}_r" for c in keys))


def slot(k: int) -> str:
    return f"s{k}"


def pivoted(nodes: DataFrame, group: list[str], carried: list[str], fanout: int) -> DataFrame:
    """One row for each run of ``fanout`` nodes, a column for each slot: a struct of digest and carried columns."""
    child = F.struct("digest", *carried)
    place = F.col("idx") % fanout
    spread = [F.max(F.when(place == k, child)).alias(slot(k)) for k in range(fanout)]
    parent = F.floor(F.col("idx") / fanout).cast("long").alias("parent")
    size = F.ceil(F.col("n") / fanout).cast("long").alias("parents")
    return nodes.groupBy(*group, parent, size).agg(*spread)


def slot_digest(k: int) -> Column:
    return F.coalesce(F.col(f"{slot(k)}.digest"), F.lit(""))


def parents(level: DataFrame, group: list[str], fanout: int) -> DataFrame:
    columns = [slot_digest(k) for k in range(fanout)]
    return level.select(*group, F.col("parent").alias("idx"), F.col("parents").alias("n"), digest(*columns).alias("digest"))


def climb(leaves: DataFrame, group: list[str], carried: list[str], fanout: int) -> tuple[list[DataFrame], DataFrame]:
    """The pivoted levels from the leaves up, and the top of every group.

    ``leaves`` has the group, ``idx``, ``n``, ``digest`` and the carried columns. A group of one leaf is its own top.
    """
    levels, tops, nodes = [], [], leaves
    while True:
        alone = F.col("n") == 1
        tops.append(nodes.where(alone).select(*group, F.col("digest").alias("top"), F.lit(len(levels)).alias("height")))
        if nodes.where(~alone).isEmpty():
            break
        levels.append(staged(pivoted(nodes.where(~alone), group, carried if not levels else [], fanout), "merkle-level"))
        nodes = parents(levels[-1], group, fanout)
    return levels, staged(reduce(DataFrame.union, tops), "merkle-tops")


def descend(levels: list[DataFrame], tops: DataFrame, leaves: DataFrame, group: list[str], carried: list[str], fanout: int) -> DataFrame:
    """``digest``, the carried columns and ``path`` of every leaf, and what ``tops`` holds beside.

    ``tops`` has the group, ``height``, ``path`` (from the top on) and more columns, which go down to the leaves.
    A path is an array, from the leaf up, of the siblings' digests in slots before and after.
    """
    more = [c for c in tops.columns if c not in (*group, "height", "path")]
    above = None
    for height in range(len(levels), 0, -1):
        here = tops.where(F.col("height") == height).select(*group, F.lit(0).cast("long").alias("idx"), "path", *more)
        above = here if above is None else above.unionByName(here)
        level = levels[height - 1].withColumnRenamed("parent", "idx")
        joined = _joined(level, above, [*group, "idx"])
        payload = carried if height == 1 else []
        children = [
            F.when(
                F.col(slot(k)).isNotNull(),
                F.struct(
                    (F.col("idx") * fanout + k).alias("idx"),
                    F.col(f"{slot(k)}.digest").alias("digest"),
                    *(F.col(f"{slot(k)}.{c}").alias(c) for c in payload),
                    F.struct(
                        F.concat(F.lit(""), *(slot_digest(j) for j in range(k))).alias("before"),
                        F.concat(F.lit(""), *(slot_digest(j) for j in range(k + 1, fanout))).alias("after"),
                    ).alias("siblings"),
                ),
            )
            for k in range(fanout)
        ]
        exploded = joined.select(*group, "path", *more, F.explode(F.array_compact(F.array(*children))).alias("c"))
        above = exploded.select(
            *group, "c.idx", "c.digest", *(f"c.{c}" for c in payload), F.concat(F.array("c.siblings"), "path").alias("path"), *more
        )
        if height > 1:
            above = staged(above.drop("digest"), "merkle-paths")
    single = leaves.where(F.col("n") == 1).select(*group, "digest", *carried)
    single = _joined(single, tops.where(F.col("height") == 0).drop("height"), group)
    out = [*group, "digest", *carried, "path", *more]
    return single.select(*out) if above is None else above.select(*out).unionByName(single.select(*out))


def folded(start: Column, path: Column) -> Column:
    """The root that a leaf and its path lead to."""
    return F.aggregate(path, start, lambda node, step: digest(step["before"], node, step["after"]))


def proof_digest(path: Column) -> Column:
    """The digest of all siblings, level by level, left to right."""
    return digest(F.array_join(F.transform(path, lambda step: F.concat(step["before"], step["after"])), ""))


def manifest(docs: DataFrame, group: str = "source", order: str = "doc_id", carried: dict[str, Column] | None = None, fanout: int = FANOUT) -> DataFrame:
    """Group, ``order`` column, leaf, path, subroot and root of every row; ``carried`` are further columns by expression."""
    carried = carried or {}
    rows = with_types(docs, doc_id="long", source="string", lang="string", n_chars="long", text="string")
    rows = rows.select(F.col(group).alias("tree"), F.col(order).alias("id"), leaf_digest().alias("digest"), *(e.alias(c) for c, e in carried.items()))
    rows = staged(rows, "merkle-rows")  # the range bounds are sampled from it, not from the texts
    payload = ["id", *carried]
    leaves = staged(positions(rows, ["tree"], ["id", "digest"]), "merkle-leaves")
    levels, tops = climb(leaves, ["tree"], payload, fanout)
    roots = tops.select(F.lit(0).alias("forest"), F.col("top").alias("digest"), "tree", F.col("height").alias("tree_height"))
    upper = staged(positions(roots, ["forest"], ["tree"]), "merkle-roots")
    below = ["tree", "tree_height"]
    upper_levels, root = climb(upper, ["forest"], below, fanout)
    no_path = F.array().cast("array<struct<before:string,after:string>>")
    start = root.select("forest", "height", no_path.alias("path"), F.col("top").alias("root"))
    down = descend(upper_levels, start, upper, ["forest"], below, fanout)
    paths = staged(down.select("tree", F.col("tree_height").alias("height"), "path", F.col("digest").alias("subroot"), "root"), "merkle-subroots")
    out = descend(levels, paths, leaves, ["tree"], payload, fanout)
    return out.select(F.col("tree").alias(group), F.col("id").alias(order), F.col("digest").alias("leaf"), "path", "subroot", "root", *carried)

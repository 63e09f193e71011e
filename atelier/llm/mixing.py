"""Mixing sources to target weights by subset-sum budget fitting.

Sizes are counted in words. A source's target is its weighted share of all
words, at most ``MAX_REPEATS`` times its own. Every document of a source is
taken as often as the target holds the source whole; the rest of the target
is a budget to fit with a subset of its documents:

1. documents are counted by exact length (one row per source and length);
2. each length that fits the budget gives its share of documents, rounded down;
   single documents of the lengths that lost most by rounding follow; this is
   repeated over the documents still free and still fitting while a large budget
   is left;
3. bounded-knapsack dynamic programming over the counts that remain finds the
   largest sum within the last ``DP_BUDGET`` words;
4. of each length, the documents with the smallest seeded hashes are taken.

Step 4 ranks documents in hash buckets: whole buckets are taken by their
counts, and only the bucket in which a length's number falls is ranked, so a
length that holds a third of all documents is never sorted in one task.

A target is missed by less than the shortest document left out, or by what no
sum of those left within the last words can fill; by more only where all
documents that fit are taken.

Defined results: a null or empty text has size 0 and is never taken. Rows with
the same id are documents of their own. An empty table gives no rows.
"""

from __future__ import annotations

from fractions import Fraction

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from atelier.llm.staging import staged, with_types
from atelier.llm.textbytes import text_slices, words_of
from atelier.llm.workers import lean

WEIGHTS = (5, 2, 1)
MAX_REPEATS = 3
DP_BUDGET = 1 << 14
BUCKETS = 4096
#: The sources' targets are broadcast up to so many sources, and joined without a hint beyond.
BROADCAST_SOURCES = 100_000


def _sizes(batches):
    for batch in batches:
        sizes = [np.diff(words_of(data, offsets)[2]) for _, _, data, offsets in text_slices(batch.column("text"))]
        out = np.concatenate(sizes) if sizes else np.zeros(0, np.int64)
        rest = [batch.column(k) for k in ("doc_id", "source", "mark")]
        yield pa.RecordBatch.from_arrays([*rest, pa.array(out)], ["doc_id", "source", "mark", "size"])


def measured(docs: DataFrame) -> DataFrame:
    """doc_id, source, size in words, and ``mark``, a hash of the text."""
    rows = with_types(docs, doc_id="long", source="string", text="string")
    rows = rows.select("doc_id", "source", F.xxhash64("text").alias("mark"), "text")
    return rows.mapInArrow(lean(_sizes), "doc_id long, source string, mark long, size long")


def targets(sizes: dict[str | None, int], weights=WEIGHTS, cap: int = MAX_REPEATS) -> dict[str | None, Fraction]:
    """Words to take from each source: shares of the total by weight, none above ``cap`` times its size."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    out: dict[str | None, Fraction] = {}
    left, open_ = Fraction(sum(sizes.values())), list(names)
    while open_:
        total = sum(weight[s] for s in open_)
        share = {s: left * weight[s] / total for s in open_}
        full = [s for s in open_ if share[s] > cap * sizes[s]]
        if not full:
            return out | share
        out |= {s: Fraction(cap * sizes[s]) for s in full}
        left -= sum(out[s] for s in full)
        open_ = [s for s in open_ if s not in out]
    return out


def largest_sum(lengths: np.ndarray, counts: np.ndarray, budget: int) -> np.ndarray:
    """How many of each length give the largest sum up to ``budget`` (bounded knapsack).

    ``by[s]`` is the length at which sum s was first reached. Sums reached at
    one length are its multiples on top of earlier sums, so walking back from s
    never uses a length more often than it was counted.
    """
    reached, by = np.zeros(budget + 1, bool), np.full(budget + 1, -1)
    reached[0] = True
    for k, (length, count) in enumerate(zip(lengths.tolist(), counts.tolist(), strict=True)):
        if length <= 0 or length > budget or reached[budget]:
            continue
        front = reached.copy()
        for _ in range(min(count, budget // length)):
            step = np.zeros_like(front)
            step[length:] = front[:-length]
            front = step & ~reached
            if not front.any():
                break
            by[front] = k
            reached |= front
    chosen = np.zeros(len(lengths), np.int64)
    s = int(np.flatnonzero(reached)[-1])
    while s:
        chosen[by[s]] += 1
        s -= int(lengths[by[s]])
    return chosen


def fit(lengths: np.ndarray, counts: np.ndarray, budget: int) -> np.ndarray:
    """How many documents of each length to take so that their words come to ``budget`` or just below."""
    total = int((lengths * counts).sum())
    if budget <= 0 or total == 0:
        return np.zeros(len(lengths), np.int64)
    if budget >= total:
        return counts.copy()
    take, left = np.zeros(len(lengths), np.int64), budget
    # A round takes a document at least, or all that fit; lengths that no longer fit leave, so rounds are few.
    while left > DP_BUDGET:
        free = np.where((lengths > 0) & (lengths <= left), counts - take, 0)
        total = int((lengths * free).sum())
        if total <= left:
            take += free
            left -= total
            break
        exact = [Fraction(int(c)) * left / total for c in free]
        share = np.array([int(x) for x in exact], np.int64)
        lost = np.array([float(x - int(x)) for x in exact])
        take += share
        left -= int((lengths * share).sum())
        for k in np.lexsort((lengths, -lost)).tolist():
            if left <= DP_BUDGET:
                break
            if take[k] < counts[k] and 0 < lengths[k] <= left:
                take[k] += 1
                left -= int(lengths[k])
    order = np.lexsort((-lengths,))  # long documents first: few steps to a sum
    small = order[lengths[order] <= min(left, DP_BUDGET)]
    take[small] += largest_sum(lengths[small], (counts - take)[small], min(left, DP_BUDGET))
    return take


def _fitted(budgets: dict):
    def run(group: pd.DataFrame) -> pd.DataFrame:
        source = group["source"].iloc[0]
        budget = budgets[None if pd.isna(source) else source]
        group = group.sort_values("size")
        take = fit(group["size"].to_numpy(np.int64), group["n"].to_numpy(np.int64), budget)
        return group.assign(need=take)[["source", "size", "need"]]

    return run


def mix(docs: DataFrame, weights=WEIGHTS, cap: int = MAX_REPEATS, seed: int = 11) -> DataFrame:
    """doc_id, source, mark, size, source_size, target, times and taken of each document."""
    spark = docs.sparkSession
    hashed = F.xxhash64("doc_id", "mark", F.lit(seed))
    rows = staged(measured(docs).withColumn("draw", hashed), "sizes")
    # Sources are few: one number for each comes to the driver.
    sizes = {r[0]: r[1] for r in rows.groupBy("source").agg(F.sum("size").alias("n")).collect()}
    wanted = targets(sizes, weights, cap)
    whole = {s: min(cap, int(wanted[s] // sizes[s])) if sizes[s] else 0 for s in sizes}
    budgets = {s: 0 if whole[s] == cap else int(wanted[s] - whole[s] * sizes[s]) for s in sizes}
    plan = spark.createDataFrame(
        [(s, sizes[s], float(wanted[s]), whole[s]) for s in sizes], "source string, source_size long, target double, whole long"
    )
    lengths = rows.where("size > 0").groupBy("source", "size").agg(F.count("*").alias("n"))
    needs = lengths.groupBy("source").applyInPandas(_fitted(budgets), "source string, size long, need long")
    needs = staged(needs.where("need > 0"), "needs")

    rows = rows.withColumn("bucket", F.pmod("draw", F.lit(BUCKETS)))
    key = ["source", "size", "bucket"]
    filled = rows.groupBy(*key).agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy("source", "size").orderBy("bucket")) - F.col("n")
    filled = _join(filled.withColumn("before", before), needs, ["source", "size"], "inner")
    room = F.least(F.col("n"), F.col("need") - F.col("before"))
    filled = staged(filled.where("need > before").select(*key, "n", room.alias("room")), "buckets")
    drawn = _join(rows, filled, key, "left")
    place = F.row_number().over(Window.partitionBy(*key).orderBy("draw", "doc_id", "mark"))
    partly = drawn.where("room < n").withColumn("extra", (place <= F.col("room")).cast("long"))
    wholly = drawn.where("room is null or room = n").withColumn("extra", F.col("room").isNotNull().cast("long"))
    chosen = wholly.unionByName(partly)
    plan = plan.withColumnRenamed("source", "r_source")
    if len(sizes) <= BROADCAST_SOURCES:
        plan = F.broadcast(plan)
    out = chosen.join(plan, F.col("source").eqNullSafe(F.col("r_source")))
    times = F.when(F.col("size") > 0, F.col("whole") + F.col("extra")).otherwise(F.lit(0))
    return out.select(
        "doc_id", "source", "mark", "size", "source_size", "target", times.alias("times"), (times * F.col("size")).alias("taken")
    )


def _join(left: DataFrame, right: DataFrame, key: list[str], how: str) -> DataFrame:
    """A join by ``key`` in which a null source equals itself; the left side's key stays.

    Both sides grow with the documents, so neither is broadcast.
    """
    renamed = right.select(*[F.col(c).alias(f"r_{c}") if c in key else F.col(c) for c in right.columns]).hint("merge")
    on = None
    for c in key:
        same = F.col(c).eqNullSafe(F.col(f"r_{c}")) if c == "source" else F.col(c) == F.col(f"r_{c}")
        on = same if on is None else on & same
    keep = [c for c in left.columns if c not in right.columns or c in key]
    return left.select(*keep).join(renamed, on, how).drop(*[f"r_{c}" for c in key])


def mixed_rows(docs: DataFrame, weights=WEIGHTS, cap: int = MAX_REPEATS, seed: int = 11) -> DataFrame:
    """The rows of ``docs``, each as often as the mix takes it."""
    columns = docs.columns
    chosen = mix(docs, weights, cap, seed).where("times > 0")
    key = ["mix_id", "mix_source", "mix_mark"]
    # Such rows are of one source and size, so their numbers differ by one at most.
    times = chosen.groupBy("doc_id", "source", "mark").agg(F.count("*"), F.min("times"), F.sum("times") - F.count("*") * F.min("times"))
    times = times.toDF(*key, "mix_rows", "mix_low", "mix_more")
    named = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in columns]).alias("mix_row"),
        F.col("doc_id").cast("long").alias("d_id"),
        F.col("source").cast("string").alias("d_source"),
        F.xxhash64(F.col("text").cast("string")).alias("d_mark"),
    )
    # Rows alike in id, source and text share their numbers out in order.
    place = F.row_number().over(Window.partitionBy("d_id", "d_source", "d_mark").orderBy(F.xxhash64("mix_row")))
    named = named.withColumn("place", place)
    same = [F.col(f"d_{k}").eqNullSafe(F.col(f"mix_{k}")) for k in ("id", "source", "mark")]
    out = named.join(times, same[0] & same[1] & same[2])
    n = F.when(F.col("place") <= F.col("mix_rows"), F.col("mix_low") + (F.col("place") <= F.col("mix_more")).cast("long"))
    out = out.select("mix_row", n.alias("n")).where("n > 0")
    return out.select("mix_row", F.explode(F.sequence(F.lit(1), F.col("n").cast("int")))).select("mix_row.*")


"""Benchmark decontamination by spaced seeds.

A seed is a fixed mask over successive words; positions that the mask leaves
out don't enter its hash, so words substituted there don't hide a match. Each
mask ignores positions at another distance. The seeds of all benchmark items
are hashed, and so is every position of every training text; a bit map of
bounded size over the benchmark's hashes keeps positions that can't match at
home. Those left are joined by hash, together with the words around them, and
each hit is extended along its diagonal: a matching word adds 1, a
substituted one has a cost, and the best extension on either side counts.
A document is contaminated by an item if an extended hit has enough equal words
and they are a large enough share of its length, by one of ``RULES``: the second
asks for more words and bears more substitutions, such as every third word.
An item of fewer than ``SHORT_ITEM`` words is held against the words beside it
as a whole: at least ``SHORT_SHARE`` of its words must be equal, wherever the
others are. Such items have seeds of two pairs of words more, no, two or four
words apart; however the substituted words lie, one of them is left whole.

A passage that a third of all documents contain makes hits by the same few
hashes. The hits are written and counted by hash; a hash with more than a quarter of
a partition's even share is split into as many salts as it has such quarters,
so there are at most four times as many of these hashes as partitions.

Words are runs of letters and digits, A-Z lower-cased, so punctuation and
markup between words don't matter. Defined results: null and empty texts are
clean; an item with fewer than ``MIN_ITEM`` words is too common to be evidence
and is ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from atelier.llm.bitmap import BitMap, bits_for, collect_bits
from atelier.llm.staging import staged, with_types
from atelier.llm.textbytes import IS_ALNUM, LOWER, ByteHash, mix64, spans_of, text_slices
from atelier.llm.workers import lean

#: The masks ignore every third, fourth or fifth word.
MASKS = ("11011011011", "11101110111", "11011110111")
SPAN = 11
#: Two of four neighbouring pairs of words, for short items.
SHORT_MASKS = ("1111", "110011", "11000011")
CONTEXT = 24
WIDTH = CONTEXT + SPAN + CONTEXT
#: A substituted word's cost, the least equal words and their least share.
RULES = ((2, 13, 0.7), (1, 14, 0.6))
MIN_ITEM = 8
SHORT_ITEM = 20
SHORT_SHARE = 0.75
#: Hashes with fewer hits aren't split.
HOT_HITS = 1_000
_WORD = ByteHash(301, LOWER)
_FACTORS = np.random.default_rng(302).integers(1, 1 << 62, (64, SPAN), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
#: What stands beyond either end of a text; no word has these.
NO_WORD, NO_ITEM_WORD = 0, 0xFFFFFFFF


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of a slice, and where each text's words begin."""
    starts, ends, first = spans_of(IS_ALNUM[data], offsets)
    return _WORD.spans(data, starts, ends), first


def seed_hashes(words: np.ndarray, mask: str, number: int) -> np.ndarray:
    """The hash of the seed at every position, over the words that the mask selects."""
    n = len(words) - len(mask) + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    total = np.full(n, np.uint64(number + 1))
    for k, used in enumerate(mask):
        if used == "1":
            total += words[k:k + n] * _FACTORS[number, k]
    return mix64(total)


def contexts(words: np.ndarray, first: np.ndarray, text: np.ndarray, at: np.ndarray, beyond: int) -> np.ndarray:
    """32-bit words around each hit: ``CONTEXT`` before it, the rest from it on."""
    short = np.clip(words >> np.uint64(32), 1, 0xFFFFFFFE).astype(np.uint32)
    where = at[:, None] + np.arange(-CONTEXT, WIDTH - CONTEXT)
    inside = (where >= first[text][:, None]) & (where < first[text + 1][:, None])
    return np.where(inside, short[np.clip(where, 0, max(len(short) - 1, 0))], np.uint32(beyond)).astype("<u4")


def all_masks(short: bool) -> list[tuple[int, str]]:
    """The spaced masks, with those of short items if there are any: (number, mask)."""
    return list(enumerate(MASKS + SHORT_MASKS if short else MASKS))


def _hits(words, first, masks, holds):
    """Hashes that ``holds`` accepts: hash, text and word position, over all masks."""
    text = np.repeat(np.arange(len(first) - 1), np.diff(first))
    for number, mask in masks:
        hashes = seed_hashes(words, mask, number)
        if not len(hashes):
            continue
        whole = np.arange(len(hashes)) + len(mask) <= first[text[:len(hashes)] + 1]
        at = np.flatnonzero(whole)
        at = at[holds(hashes[at], text[at], number)]
        if len(at):
            yield hashes[at], text[at], at


def item_seeds(batch: pa.RecordBatch):
    """Every seed of the items: hash, item, its number of words, words around the seed."""
    for start, _, data, offsets in text_slices(batch.column("text")):
        words, first = word_hashes(data, offsets)
        sizes = np.diff(first)
        ids = batch.column("item_id").slice(start, len(sizes))

        def fits(hashes, text, number, sizes=sizes):
            n = sizes[text]
            return (n >= SPAN) if number < len(MASKS) else (n >= MIN_ITEM) & (n < SHORT_ITEM)

        for hashes, text, at in _hits(words, first, all_masks(True), fits):
            around = contexts(words, first, text, at, NO_ITEM_WORD)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(hashes.view(np.int64)),
                    ids.take(pa.array(text)),
                    pa.array(sizes[text]),
                    pa.array([a.tobytes() for a in around], pa.binary()),
                ],
                ["hash", "item_id", "n_words", "item_words"],
            )


def _item_seeds(batches):
    for batch in batches:
        yield from item_seeds(batch)


def text_hits(batch: pa.RecordBatch, bits: BitMap, short: bool):
    """Positions of the texts whose seed may be in the benchmark."""
    for start, _, data, offsets in text_slices(batch.column("text")):
        words, first = word_hashes(data, offsets)
        for hashes, text, at in _hits(words, first, all_masks(short), lambda h, t, k: bits.holds(h)):
            around = contexts(words, first, text, at, NO_WORD)
            rows = pa.array(text + start)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(hashes.view(np.int64)),
                    batch.column("doc_id").take(rows),
                    batch.column("mark").take(rows),
                    pa.array(at - first[text]),
                    pa.array([a.tobytes() for a in around], pa.binary()),
                ],
                ["hash", "doc_id", "mark", "at", "doc_words"],
            )


def _text_hits(table, short: bool):
    def run(batches):
        bits = BitMap(table.value)
        for batch in batches:
            yield from text_hits(batch, bits, short)

    return run


def extended(equal: np.ndarray, cost: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Equal words, words before the seed and words from it on, of each hit's best extension."""

    def side(part: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        score = np.cumsum(np.where(part, 1, -cost), axis=1)
        score = np.concatenate([np.zeros((len(part), 1), score.dtype), score], axis=1)
        length = score.argmax(axis=1)
        matches = np.concatenate([np.zeros((len(part), 1), int), np.cumsum(part, axis=1)], axis=1)
        return length, matches[np.arange(len(part)), length]

    before, left = side(equal[:, :CONTEXT][:, ::-1])
    after, right = side(equal[:, CONTEXT:])
    return left + right, before, after


def verify(batch: pa.RecordBatch) -> pa.RecordBatch:
    """The hits whose extension is long and alike enough."""
    n = batch.num_rows
    doc, item = (np.frombuffer(b"".join(batch.column(c).to_pylist()), "<u4").reshape(n, WIDTH) for c in ("doc_words", "item_words"))
    equal, sizes = doc == item, batch.column("n_words").to_numpy()
    good, matches, before, after = np.zeros(n, bool), *np.zeros((3, n), np.int64)
    for cost, least, share in RULES:
        found, b, a = extended(equal, cost)
        better = (found >= least) & (found >= share * (b + a)) & (found > matches)
        good |= better
        matches, before, after = (np.where(better, x, y) for x, y in ((found, matches), (b, before), (a, after)))
    # The words around a seed hold all of a short item.
    short = (sizes < SHORT_ITEM) & (equal.sum(axis=1) >= SHORT_SHARE * sizes)
    matches = np.where(short, equal.sum(axis=1), matches)
    before = np.where(short, CONTEXT - equal.argmax(axis=1), before)
    after = np.where(short, WIDTH - CONTEXT - equal[:, ::-1].argmax(axis=1), after)
    good = np.flatnonzero(good | short)
    at = batch.column("at").to_numpy()[good]
    rows = pa.array(good)
    return pa.RecordBatch.from_arrays(
        [
            batch.column("doc_id").take(rows),
            batch.column("mark").take(rows),
            batch.column("item_id").take(rows),
            pa.array(matches[good]),
            pa.array(at - before[good]),
            pa.array(at + after[good]),
        ],
        ["doc_id", "mark", "item_id", "matched", "word_start", "word_end"],
    )


def _verified(batches):
    for batch in batches:
        if batch.num_rows:
            yield verify(batch)


def split_hot(hits: DataFrame, seeds: DataFrame, least: int = HOT_HITS) -> tuple[DataFrame, DataFrame]:
    """Both sides of the join with a ``salt``: hits of a frequent hash have different ones, its seeds have each of them."""
    parts = int(hits.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    share = max(least, hits.count() // (4 * parts))
    hot = hits.groupBy("hash").count().where(F.col("count") > share)
    hot = staged(hot.select("hash", F.ceil(F.col("count") / share).alias("salts")), "hot")
    hot = F.broadcast(hot)  # at most four rows for each partition
    salts = F.coalesce("salts", F.lit(1))
    # The hits are read from files, so a task that runs again gives its rows the same numbers.
    hits = hits.withColumn("number", F.monotonically_increasing_id()).join(hot, "hash", "left")
    hits = hits.withColumn("salt", F.pmod("number", salts)).drop("number", "salts")
    each = F.explode(F.sequence(F.lit(0).cast("long"), salts - 1))
    return hits, seeds.join(hot, "hash", "left").withColumn("salt", each).drop("salts")


def overlaps(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, mark (a hash of the text), item_id, matched, word_start, word_end: one row per document and item."""
    spark = docs.sparkSession
    items = with_types(benchmark, item_id="long", text="string")
    seeds = staged(items.mapInArrow(lean(_item_seeds), "hash long, item_id long, n_words long, item_words binary"), "seeds")
    stats = seeds.agg(F.count("*"), F.count_if(F.col("n_words") < SHORT_ITEM)).first()
    table = spark.sparkContext.broadcast(collect_bits(seeds, "hash", bits_for(stats[0])))
    rows = with_types(docs, doc_id="long", text="string").select("doc_id", F.xxhash64("text").alias("mark"), "text")
    hits = rows.mapInArrow(lean(_text_hits(table, stats[1] > 0)), "hash long, doc_id long, mark long, at long, doc_words binary")
    hits, seeds = split_hot(staged(hits, "hits"), seeds)
    kind = "doc_id long, mark long, item_id long, matched long, word_start long, word_end long"
    found = hits.join(seeds, ["hash", "salt"]).mapInArrow(lean(_verified), kind)
    best = F.max(F.struct("matched", (-F.col("word_start")).alias("first"), F.col("word_end").alias("last"))).alias("best")
    return found.groupBy("doc_id", "mark", "item_id").agg(best).select(
        "doc_id", "mark", "item_id", F.col("best.matched").alias("matched"),
        (-F.col("best.first")).alias("word_start"), F.col("best.last").alias("word_end"),
    )


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per contaminated document: doc_id, mark, contaminated, item_id (of the longest overlap), n_items, matched, span."""
    best = F.max(F.struct("matched", (-F.col("item_id")).alias("item"), "word_start", "word_end")).alias("best")
    found = overlaps(docs, benchmark).groupBy("doc_id", "mark").agg(best, F.count("*").alias("n_items"))
    return found.select(
        "doc_id", "mark", F.lit(True).alias("contaminated"), (-F.col("best.item")).alias("item_id"), "n_items",
        F.col("best.matched").alias("matched"), F.col("best.word_start").alias("word_start"), F.col("best.word_end").alias("word_end"),
    )


def clean_rows(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` that aren't contaminated."""
    found = staged(contaminated(docs, benchmark).select(F.col("doc_id").alias("c_id"), F.col("mark").alias("c_mark")), "contaminated")
    same = F.col("doc_id").cast("long").eqNullSafe(F.col("c_id")) & (F.xxhash64(F.col("text").cast("string")) == F.col("c_mark"))
    return docs.join(found, same, "left_anti")

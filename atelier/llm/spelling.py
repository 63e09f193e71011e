"""Spelling variants by blocked Gram matrices of letter counts.

Words are maximal runs of Latin letters, counted over all texts. Two words are
near if one inserted, deleted or replaced letter makes one the other. Then
their letter counts are at a squared distance of 1 or 2, and their lengths
are equal or adjacent. With A the letter counts of a block of words, the
squared distances of all its pairs are one matrix product away: the diagonal
of A A' twice, minus 2 A A'. Pairs at most two apart are then compared letter
by letter.

Blocks. Of two near words of L and L or L + 1 letters, the edit lies in one of
four windows that the positions of L letters are cut into, and what is before
and after that window is equal. A block is the words of L and L + 1 letters
that agree outside one window. So every word is in at most eight blocks, each near
pair meets in the block of the window that holds its first difference, and only that block reports
it. A block of more than ``most`` words is cut again, by halving its window, until the
window is one letter: then the alphabet bounds it (90 letters for L and 90 * 90 for L + 1).
Blocks are rows sorted by block in Spark's partitions; a task makes tiles of
whole blocks and one product for each tile.

A word's form is its near word of largest count, if that count is at least
``ratio`` times the word's own; the root is reached by following forms, which
takes as many rounds as the logarithm of the longest chain, as each round doubles the steps.

Defined results: a null text has no words; a row without an id is corrupted, in
``corrupted`` below, as if its id were the empty text. An empty table has no words.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from atelier.llm.staging import staged, with_types
from atelier.llm.textbytes import LOWER
from atelier.llm.workers import lean

MIN_LETTERS, MIN_COUNT, RATIO = 5, 3, 2
#: Words of a block, beyond which its window is halved.
MOST = 1024
#: Words of a tile, beyond which no further block joins it.
TILE = 512
#: A text is read in pieces of so many characters, cut between runs.
PIECE = 1 << 18
#: Distinct words that a task counts before it passes them on.
COUNTED = 1 << 17
RUN = re.compile("[A-Za-zÀ-ÿ]+")
ASCII_LOWER = LOWER.tobytes()
#: Column of each letter: a to z, then U+00C0 to U+00FF.
LETTERS = 26 + 64


def pieces(text: str) -> Iterator[str]:
    """The text in pieces that end between runs of letters."""
    start, n = 0, len(text)
    while start < n:
        end = min(n, start + PIECE)
        while end < n and RUN.match(text, end) and RUN.match(text, end - 1):
            end += len(RUN.match(text, end)[0])
        yield text[start:end]
        start = end


def corrupted(start: int, run: str, every: int) -> str:
    """The run, without one of its letters where the checksum is divisible by ``every``: that of ``<id>:``, ``start``, carried over the run."""
    h = zlib.crc32(run.encode(), start)
    if h % every:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1:]


def _counts(every: int, min_letters: int):
    def count(batches):
        found: Counter = Counter()
        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
                text = text.as_py()
                if not text:
                    continue
                start = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
                for piece in pieces(text):
                    lowered = piece.encode().translate(ASCII_LOWER).decode()
                    for run, n in Counter(RUN.findall(lowered)).items():
                        word = corrupted(start, run, every)
                        if len(word) >= min_letters:
                            found[word] += n
                    if len(found) >= COUNTED:
                        yield _counted(found)
                        found = Counter()
        yield _counted(found)

    return lean(count)


def _counted(found: Counter) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(list(found), pa.string()), pa.array(list(found.values()), pa.int64())], ["word", "n"])


def word_counts(docs: DataFrame, every: int, min_letters: int = MIN_LETTERS, min_count: int = MIN_COUNT) -> DataFrame:
    """word and n, its occurrences, of words with enough letters and occurrences. ``every``: see ``corrupted``."""
    rows = with_types(docs, doc_id="long", text="string")
    counted = rows.mapInArrow(_counts(every, min_letters), "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)


def _block(short, low, high):
    """The block of words of ``short`` or ``short`` + 1 letters that agree before ``low`` and after ``high``."""
    return F.xxhash64(
        short, low, F.substring("word", F.lit(1), low), F.substring("word", F.length("word") - short + high + 1, short - high)
    )


def _windows(words: DataFrame) -> DataFrame:
    """A row for each block of each word: the shorter words' length, and the window as positions in them."""
    length = F.length("word")
    shorter = F.when(length > 1, F.array(length, length - 1)).otherwise(F.array(length))
    out = words.select("word", "n", F.explode(shorter).alias("short"))
    quarter = F.explode(F.sequence(F.lit(0), F.lit(3))).alias("k")
    out = out.select("word", "n", "short", quarter).select(
        "word", "n", "short", F.floor(F.col("short") * F.col("k") / 4).cast("int").alias("low"),
        F.floor(F.col("short") * (F.col("k") + 1) / 4).cast("int").alias("high"),
    )
    return _in_blocks(out.where("low < high"))


def _in_blocks(rows: DataFrame) -> DataFrame:
    return rows.withColumn("block", _block(F.col("short"), F.col("low"), F.col("high")))


def _halves(rows: DataFrame) -> DataFrame:
    middle = F.floor((F.col("low") + F.col("high")) / 2).cast("int")
    both = F.array(F.struct("low", middle.alias("high")), F.struct(middle.alias("low"), "high"))
    cut = rows.select("word", "n", "short", F.explode(both).alias("w"))
    return _in_blocks(cut.select("word", "n", "short", "w.low", "w.high"))


def blocks(words: DataFrame, most: int = MOST) -> DataFrame:
    """Words in blocks of at most ``most`` words, but where a window is one letter; words alone in a block are left out."""
    rows, done = staged(_windows(words), "spelling-windows"), None
    while True:
        sizes = staged(rows.groupBy("block").agg(F.count("*").alias("size")).where("size > 1"), "spelling-sizes")
        sized = rows.join(sizes, "block")
        final = (F.col("size") <= most) | (F.col("high") - F.col("low") == 1)
        done = sized.where(final).drop("size") if done is None else done.unionByName(sized.where(final).drop("size"))
        if sizes.where(F.col("size") > most).isEmpty():
            return done
        wide = sized.where(~final).drop("size")
        rows = staged(_halves(wide), "spelling-halves")


def letter_counts(words: list[str]) -> np.ndarray:
    """A row of letter counts for each word. Products of counts are exact in the type chosen."""
    lengths = np.fromiter((len(w) for w in words), np.int64, len(words))
    codes = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).astype(np.int64)
    column = np.where(codes < 0x80, codes - 97, codes - 0xC0 + 26)
    at = np.repeat(np.arange(len(words)), lengths) * LETTERS + column
    kind = np.float32 if lengths.max(initial=0) < 2000 else np.float64
    return np.bincount(at, minlength=len(words) * LETTERS).reshape(len(words), LETTERS).astype(kind)


def close_pairs(words: list[str], blocks: np.ndarray, rows: int = TILE) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (i < j) of one block with squared distances of 1 or 2, from products of blocks of ``rows`` letter-count rows."""
    counts = letter_counts(words)
    norms = (counts * counts).sum(1)
    firsts, seconds = [], []
    for start in range(0, len(words), rows):
        some = slice(start, start + rows)
        gram = counts[some] @ counts[start:].T
        distance = norms[some, None] + norms[None, start:] - 2 * gram
        near = (distance >= 1) & (distance <= 2) & (blocks[some, None] == blocks[None, start:])
        a, b = np.nonzero(np.triu(near, 1))
        firsts.append(a + start)
        seconds.append(b + start)
    return np.concatenate(firsts), np.concatenate(seconds)


def edit_place(a: str, b: str) -> int | None:
    """Where the words first differ if one edit makes one the other, else None; ``a`` isn't longer than ``b``."""
    low, high = 0, len(a)
    while low < high:  # the length of the common prefix
        middle = (low + high + 1) // 2
        if a[low:middle] == b[low:middle]:
            low = middle
        else:
            high = middle - 1
    if len(a) == len(b):
        return low if low < len(a) and a[low + 1:] == b[low + 1:] else None
    return low if a[low:] == b[low + 1:] else None


def near_pairs(words: list[str], blocks: np.ndarray, short: np.ndarray, low: np.ndarray, high: np.ndarray) -> Iterator[tuple[int, int]]:
    """The near pairs that belong to the window of their block."""
    for i, j in zip(*(x.tolist() for x in close_pairs(words, blocks)), strict=True):
        if len(words[i]) > len(words[j]):
            i, j = j, i
        # Two words of L + 1 letters meet in their own length's block.
        if len(words[i]) != short[i] or len(words[j]) > short[i] + 1:
            continue
        at = edit_place(words[i], words[j])
        if at is not None and (low[i] <= at < high[i] or at == high[i] == short[i]):
            yield i, j


def _pairs(batches):
    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        if sum(b.num_rows for b in held) < TILE:
            continue
        rows = pa.Table.from_batches(held).combine_chunks()
        block = rows.column("block").to_numpy()
        begins = np.flatnonzero(np.diff(block) != 0) + 1
        if len(begins):  # the last block may go on in the next batch
            yield from _tiles(rows.slice(0, int(begins[-1])))
            held = rows.slice(int(begins[-1])).to_batches()
    if held:
        yield from _tiles(pa.Table.from_batches(held))


def _tiles(rows: pa.Table) -> Iterator[pa.RecordBatch]:
    block = rows.column("block").to_numpy()
    ends = np.append(np.flatnonzero(np.diff(block) != 0) + 1, len(block))
    start = 0
    while start < len(block):
        # Whole blocks up to a tile, or one longer block.
        fit = int(np.searchsorted(ends, start + TILE, "right"))
        end = int(ends[fit - 1]) if fit and ends[fit - 1] > start else int(ends[fit])
        yield _tile(rows.slice(start, end - start))
        start = end


def _tile(rows: pa.Table) -> pa.RecordBatch:
    words = rows.column("word").to_pylist()
    n = rows.column("n").to_numpy()
    numbers = [rows.column(c).to_numpy() for c in ("block", "short", "low", "high")]
    both = [(x, y) for i, j in near_pairs(words, *numbers) for x, y in ((i, j), (j, i))]
    a, b = [x for x, _ in both], [y for _, y in both]
    return pa.RecordBatch.from_arrays(
        [pa.array([words[x] for x in a], pa.string()), pa.array([words[y] for y in b], pa.string()), pa.array(n[b], pa.int64())],
        ["word", "near", "near_n"],
    )


def near_words(words: DataFrame, most: int = MOST) -> DataFrame:
    """word, near and near_n: each near pair of words (word, n), in both directions, once."""
    sorted_rows = blocks(words, most).repartition("block").sortWithinPartitions("block")
    return sorted_rows.select("block", "word", "n", "short", "low", "high").mapInArrow(lean(_pairs), "word string, near string, near_n long")


def roots(forms: DataFrame) -> DataFrame:
    """word and root for each row (word, form), following forms; they never turn in a circle, as counts grow."""
    rows = forms.select("word", F.col("form").alias("root"))
    while True:
        further = rows.select(F.col("word").alias("root"), F.col("root").alias("next"))
        step = rows.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved"))
        rows = staged(step, "spelling-roots")
        if rows.where("moved").isEmpty():
            return rows.drop("moved")
        rows = rows.drop("moved")


def spelling_groups(words: DataFrame, ratio: int = RATIO, most: int = MOST) -> DataFrame:
    """word, n, n_near, form, form_n and root of each word (word, n)."""
    words = staged(words, "spelling-words")
    best = F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near")))
    near = near_words(words, most).groupBy("word").agg(F.count("*").alias("n_near"), best.alias("best"))
    formed = words.join(near, "word", "left").withColumn("top", -F.col("best.less"))
    is_form = F.col("top") >= ratio * F.col("n")
    formed = staged(
        formed.select(
            "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(is_form, F.col("best.near")).alias("form"), F.when(is_form, F.col("top")).alias("form_n"),
        ),
        "spelling-forms",
    )
    found = roots(formed.where(F.col("form").isNotNull()))
    out = formed.join(found, "word", "left")
    return out.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")

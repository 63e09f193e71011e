"""Line deduplication by range-partitioned hashes.

Each line with a long enough key becomes a narrow row: a 128-bit hash of the
key, the document and the line's position. The rows are range-partitioned and
sorted by (hash, document, position) and streamed: the first document of a
hash keeps its lines, all later ones lose theirs. A very common line spreads
over many partitions, since the document is part of the range. A partition
can't tell whether its first hash began before it, so it passes those lines on
undecided, together with the first document it saw of its first and of its
last hash: two short rows from each partition, which settle them.

The result is a compressed bit map of the kept lines for each document that loses
some (``keep_bitmaps``); text doesn't take part, and the bit map is all that travels to it.
``apply_bitmaps`` turns both into the kept texts.

Defined results: a null or empty text is one empty line, which stays. Rows
with the same id count as one document, and all rows without an id as one
document whose id is the largest.
"""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from atelier.llm.staging import staged, with_types
from atelier.llm.textbytes import IS_SPACE, LOWER, SLICE_BYTES, ByteHash, text_slices
from atelier.llm.workers import lean

MIN_KEY_POINTS = 10
#: Stands for a missing id.
NO_ID = (1 << 63) - 1
_HIGH, _LOW = ByteHash(201, LOWER), ByteHash(202, LOWER)
NEWLINE = 0x0A
#: Texts whose results are passed on together.
BATCH_TEXTS = 256


def line_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of every line and its text; a text without a newline is one line."""
    breaks = np.flatnonzero(data == NEWLINE)
    starts = np.sort(np.concatenate([offsets[:-1], breaks + 1]), kind="stable")
    # A text's lines end at its newlines and at its own end.
    ends = np.sort(np.concatenate([breaks, offsets[1:]]), kind="stable")
    counts = np.searchsorted(breaks, offsets[1:]) - np.searchsorted(breaks, offsets[:-1]) + 1
    return starts, ends, np.repeat(np.arange(len(offsets) - 1), counts)


def stripped(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The spans without white space at either end; an empty span where nothing is left."""
    solid = np.flatnonzero(~IS_SPACE[data])
    first, last = np.searchsorted(solid, starts), np.searchsorted(solid, ends) - 1
    some = first <= last
    if not len(solid):
        return starts, starts
    at = solid[np.minimum(first, len(solid) - 1)]
    return np.where(some, at, starts), np.where(some, solid[np.maximum(last, 0)] + 1, starts)


def long_enough(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, min_points: int) -> np.ndarray:
    """Whether each span has so many code points; a code point has one to four bytes, so most spans needn't be counted."""
    out = ends - starts >= 4 * min_points
    some = np.flatnonzero(~out & (ends - starts >= min_points))
    points, last = np.zeros(len(some), np.int64), max(len(data) - 1, 0)
    for k in range(4 * min_points):
        at = starts[some] + k
        points += (at < ends[some]) & ((data[np.minimum(at, last)] & 0xC0) != 0x80)
    out[some] = points >= min_points
    return out


def line_rows(batch: pa.RecordBatch, min_points: int):
    """The rows of one batch's lines, for runs of lines with at most ``SLICE_BYTES`` bytes, or one longer line."""
    docs = batch.column("doc").to_numpy()
    marks = batch.column("mark").to_numpy()
    for first, _, data, offsets in text_slices(batch.column("text")):
        starts, ends, text = line_spans(data, offsets)
        position = np.arange(len(starts)) - np.searchsorted(text, text)
        begin = 0
        while begin < len(starts):
            end = max(begin + 1, int(np.searchsorted(ends, starts[begin] + SLICE_BYTES, "right")))
            lines = slice(begin, end)
            some, base = data[starts[begin]:ends[end - 1]], starts[begin]
            yield _hashed(some, starts[lines] - base, ends[lines] - base, position[lines], text[lines] + first, docs, marks, min_points)
            begin = end


def _hashed(data, starts, ends, position, text, docs, marks, min_points: int) -> pa.RecordBatch:
    a, b = stripped(data, starts, ends)
    long = long_enough(data, a, b, min_points)
    a, b, text = a[long], b[long], text[long]
    return pa.RecordBatch.from_arrays(
        [
            pa.array(_HIGH.spans(data, a, b).view(np.int64)),
            pa.array(_LOW.spans(data, a, b).view(np.int64)),
            pa.array(docs[text]),
            pa.array(marks[text]),
            pa.array(position[long].astype(np.int32)),
        ],
        ["high", "low", "doc", "mark", "at"],
    )


def _line_rows(min_points: int):
    def run(batches):
        for batch in batches:
            yield from line_rows(batch, min_points)

    return lean(run)


DROP, UNDECIDED, EDGE = 0, 1, 2


def _first_documents(batches):
    """Streams one sorted partition: lines to drop, undecided lines, and the first document of the edge hashes."""
    group, owner, at_head = None, None, True
    head = None
    for batch in batches:
        if not batch.num_rows:
            continue
        high, low, doc, mark, at = (batch.column(k).to_numpy() for k in range(5))
        new = np.empty(len(high), bool)
        new[1:] = (high[1:] != high[:-1]) | (low[1:] != low[:-1])
        new[0] = group is None or (high[0], low[0]) != group
        if group is not None and new.any() and at_head:
            at_head = False
        begin = np.flatnonzero(new)
        owners = np.concatenate([[owner if owner is not None else 0], doc[begin]])
        of = np.cumsum(new)
        if group is None:  # the partition's first hash
            head, at_head = (int(high[0]), int(low[0]), int(doc[0])), True
            undecided = of == 1
            at_head = len(begin) == 1
        elif at_head:
            undecided = of == 0
        else:
            undecided = (of == 0) & ((high[0], low[0]) == (head[0], head[1]))
        drop = ~undecided & (doc != owners[of])
        out = drop | undecided
        kind = np.where(undecided[out], UNDECIDED, DROP).astype(np.int8)
        yield pa.RecordBatch.from_arrays(
            [pa.array(kind), *(pa.array(x[out]) for x in (high, low, doc, mark, at))],
            ["kind", "high", "low", "doc", "mark", "at"],
        )
        if len(begin):
            owner = int(doc[begin[-1]])
        group = (high[-1], low[-1])
    if head is not None:
        ends = [head, (int(group[0]), int(group[1]), owner)]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([EDGE] * 2, pa.int8()),
                *(pa.array([e[k] for e in ends], pa.int64()) for k in range(3)),
                pa.array([0, 0], pa.int64()),
                pa.array([0, 0], pa.int32()),
            ],
            ["kind", "high", "low", "doc", "mark", "at"],
        )


def dropped_lines(docs: DataFrame, min_points: int = MIN_KEY_POINTS) -> DataFrame:
    """One row for each text that loses lines: doc, mark, and the positions it loses."""
    spark = docs.sparkSession
    lines = staged(docs.mapInArrow(_line_rows(min_points), "high long, low long, doc long, mark long, at int"), "lines")
    order = ["high", "low", "doc", "mark", "at"]
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = lines.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    seen = staged(ranged.mapInArrow(lean(_first_documents), "kind byte, high long, low long, doc long, mark long, at int"), "first")
    # At most two rows from each partition: the bound of what is broadcast.
    edges = seen.where(F.col("kind") == EDGE).groupBy("high", "low").agg(F.min("doc").alias("owner"))
    undecided = seen.where(F.col("kind") == UNDECIDED).join(F.broadcast(edges), ["high", "low"])
    columns = ["doc", "mark", "at"]
    drops = seen.where(F.col("kind") == DROP).select(columns).union(undecided.where("doc > owner").select(columns))
    return drops.groupBy("doc", "mark").agg(F.collect_set("at").alias("drops"))


def keep_bitmap(n_lines: int, drops) -> bytes:
    """A bit for each of the first ``n_lines`` lines, set where it stays, compressed."""
    keep = np.ones(n_lines, bool)
    keep[drops] = False
    return zlib.compress(np.packbits(keep).tobytes(), 1)


def read_bitmap(bitmap: bytes, n_lines: int) -> np.ndarray:
    """The bits of the first ``n_lines`` lines."""
    return np.unpackbits(np.frombuffer(zlib.decompress(bitmap), np.uint8), count=n_lines).astype(bool)


def _bitmaps(batches):
    for batch in batches:
        drops = [d.values.to_numpy() for d in batch.column("drops")]
        # The bits end with the last dropped line; what comes after it stays.
        sizes = [int(d.max()) + 1 for d in drops]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc"), batch.column("mark"), pa.array(sizes, pa.int64()), pa.array([keep_bitmap(n, d) for n, d in zip(sizes, drops, strict=True)], pa.binary())],
            ["doc", "mark", "n_bits", "keep_bitmap"],
        )


def keep_bitmaps(docs: DataFrame, min_points: int = MIN_KEY_POINTS) -> DataFrame:
    """doc, mark, n_bits and keep_bitmap of each text that loses lines; ``docs`` has doc, mark and text."""
    return dropped_lines(docs, min_points).mapInArrow(lean(_bitmaps), "doc long, mark long, n_bits long, keep_bitmap binary")


def kept_text(text: bytes, n_bits: int | None, bitmap: bytes | None) -> tuple[int, int, bytes]:
    """Lines, dropped lines and the kept text."""
    n = text.count(b"\n") + 1
    if bitmap is None:
        return n, 0, text
    keep = read_bitmap(bitmap, n_bits)
    lines = text.split(b"\n", n_bits)  # the rest is whole
    kept = [line for line, stays in zip(lines, keep.tolist(), strict=False) if stays] + lines[n_bits:]
    return n, n_bits - int(keep.sum()), b"\n".join(kept)


APPLIED = "doc_id long, n_lines long, n_dropped long, kept string, keep_bitmap binary"


def _applied(digests: bool):
    def run(batches):
        for batch in batches:
            for k in range(0, batch.num_rows, BATCH_TEXTS):
                part = batch.slice(k, BATCH_TEXTS)
                sizes, lost, kept = [], [], []
                for text, bits, bitmap in zip(part.column("text"), part.column("n_bits").to_pylist(), part.column("keep_bitmap").to_pylist(), strict=True):
                    n, gone, body = kept_text(text.as_buffer().to_pybytes() if text.is_valid else b"", bits, bitmap)
                    sizes.append(n)
                    lost.append(gone)
                    kept.append(hashlib.sha256(body).hexdigest() if digests else body.decode())
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(lost, pa.int64()), pa.array(kept, pa.string()), part.column("keep_bitmap")],
                    ["doc_id", "n_lines", "n_dropped", "kept", "keep_bitmap"],
                )

    return lean(run)


def with_marks(docs: DataFrame) -> DataFrame:
    """doc_id, text, and what a text is known by: ``doc``, its document, and ``mark``, a hash of it."""
    return with_types(docs, doc_id="long", text="string").select(
        "doc_id", "text", F.coalesce("doc_id", F.lit(NO_ID)).alias("doc"), F.xxhash64("text").alias("mark")
    )


def apply_bitmaps(docs: DataFrame, bitmaps: DataFrame, digests: bool = False) -> DataFrame:
    """doc_id, n_lines, n_dropped, kept (the kept text, or its SHA-256) and keep_bitmap (null: every line stays) of each row of ``with_marks``."""
    joined = docs.join(bitmaps, ["doc", "mark"], "left").select("doc_id", "text", "n_bits", "keep_bitmap")
    return joined.mapInArrow(_applied(digests), APPLIED)


def deduplicate_lines(docs: DataFrame, min_points: int = MIN_KEY_POINTS, digests: bool = True) -> DataFrame:
    """doc_id, n_lines, n_dropped, keep_bitmap (null: every line stays) and kept_sha256, or with ``digests=False`` kept, the text."""
    rows = with_marks(docs)
    out = apply_bitmaps(rows, keep_bitmaps(rows, min_points), digests)
    return out.withColumnRenamed("kept", "kept_sha256") if digests else out

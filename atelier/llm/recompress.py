"""Substring deduplication by recompression.

A text is a sequence of words, and a round of recompression shortens it: runs of
one symbol become one symbol, then every pair of a left and a right symbol
becomes one. Which symbols are left or right, and the name of a run or a pair,
follow from the names of what they consist of, so every task gives the
same names, and what two texts share is compressed the same way inside; only
at its ends may neighbours outside take part. For a window of words this says
which symbols lie inside it wherever it occurs (``inside``): a round takes the
first and the last run, a right symbol at the beginning and a left one at the end
from it, as those may join what is outside.

A window that starts in two documents therefore consists, but for its ends, of
symbols that both have. Two Spark rounds use that:

1. *Reveal.* Pairs of neighbouring high-level symbols are named over all texts. A window
   all of whose inner pairs several documents have is a
   candidate; a window too uniform to have an inner pair (a word repeated) is one too.
2. *Verify.* Candidate windows are named by 96 bits of their words, again over all
   texts; those that start in a smaller document too are repeats.

How a round asks. Texts are written once to the shared folder in slices of a few
megabytes. For each slice a task sorts the names it holds, with the smallest and
the largest document of each, and sends them in buckets by range of names, packed by byte
planes. A bucket's task brings the slices together and answers with one bit for each
name: whether several documents have it, or whether one smaller than the slice's
smallest has it. So a name sends one entry for each slice, however often it
occurs, and texts move once.

Defined results: a null text has no words. Rows with one id are one document
(what they share isn't a repeat), and all rows without an id are one document whose id is the
largest. Windows are judged on the input. A text of any length is whole in one slice.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from atelier.llm.files import new_name, open_file, open_new
from atelier.llm.staging import shared_folder, staged, with_types
from atelier.llm.textbytes import IS_SPACE, ByteHash, mix64, pack_lists, text_buffers, words_of
from atelier.llm.workers import lean, lean_group

U64 = np.uint64
WIDTH = 13
#: Rounds of recompression before the first question.
LEVELS = 2
SLICE_BYTES = 8 << 20
#: Bytes of words that are hashed at once.
PIECE = 1 << 18
NO_ID = (1 << 63) - 1
_WORDS, _CHECKS = ByteHash(211), ByteHash(212)
RUN_SALT, PAIR_SALT, SIDE_SALT, NAME_SALT = (U64(k) for k in (0x51, 0x52, 0x53, 0x54))


def word_names(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, hashed: ByteHash) -> np.ndarray:
    """A hash of every word; bytes are hashed a piece at a time."""
    names = np.empty(len(starts), U64)
    a = 0
    while a < len(starts):
        b = max(a + 1, int(np.searchsorted(ends, starts[a] + PIECE, "right")))
        names[a:b] = hashed.spans(data[starts[a]:ends[b - 1]], starts[a:b] - starts[a], ends[a:b] - starts[a])
        a = b
    return names


def next_level(names: np.ndarray, texts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """One round: the symbols' names and texts, and the maps from old symbols to runs, from runs to symbols, and the runs' sides.

    ``texts`` is the text that each symbol belongs to; nothing joins across texts.
    """
    n = len(names)
    new = np.ones(n, bool)
    new[1:] = (names[1:] != names[:-1]) | (texts[1:] != texts[:-1])
    begin = np.flatnonzero(new)
    run_of = np.cumsum(new) - 1
    length = np.diff(np.append(begin, n))
    runs, run_texts = names[begin], texts[begin]
    many = length > 1
    runs[many] = mix64(runs[many] + mix64(length[many].astype(U64) + (RUN_SALT << U64(32))))
    right = (mix64(runs + SIDE_SALT) >> U64(63)).astype(bool)
    joined = np.zeros(len(runs), bool)  # with the one before
    joined[1:] = right[1:] & ~right[:-1] & (run_texts[1:] == run_texts[:-1])
    head = np.flatnonzero(~joined)
    symbol_of = np.cumsum(~joined) - 1
    symbols = runs[head]
    pairs = np.flatnonzero(joined)
    symbols[symbol_of[pairs]] = mix64(mix64(runs[pairs - 1] + PAIR_SALT) + runs[pairs])
    return symbols, run_texts[head], run_of, symbol_of, right


def inside(first: np.ndarray, end: np.ndarray, run_of: np.ndarray, symbol_of: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The symbols of the next level that are inside [first, end) whatever is around it; empty where end <= first."""
    some = end - first > 2
    last = len(right) - 1
    a = np.where(some, run_of[np.minimum(first, len(run_of) - 1)] + 1, 0)
    b = np.where(some, run_of[np.maximum(end - 1, 0)], 0)
    some &= b > a
    a = a + (some & right[np.minimum(a, last)])
    b = b - (some & (b > a) & ~right[np.clip(b - 1, 0, last)])
    some &= b > a
    low = symbol_of[np.minimum(a, last)]
    high = symbol_of[np.clip(b - 1, 0, last)] + 1
    return np.where(some, low, 0), np.where(some, high, 0)


class Slice:
    """Words and symbols of the texts of a slice, all arrays over the slice."""

    def __init__(self, documents: np.ndarray, data: np.ndarray, offsets: np.ndarray, width: int, levels: int):
        self.documents, self.data, self.offsets, self.width = documents, data, offsets, width
        self.starts, self.ends, self.first = words_of(data, offsets)
        self.names = word_names(data, self.starts, self.ends, _WORDS)
        self.text = np.repeat(np.arange(len(offsets) - 1), np.diff(self.first))
        n = len(self.names)
        at = np.arange(max(n - width + 1, 0))
        self.windows = at[self.text[at] == self.text[at + width - 1]] if len(at) else at
        self.levels = levels

    def pairs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Names and documents of all pairs of neighbouring symbols of the last level, and each window's inner pairs [first, end)."""
        names, texts = self.names, self.text
        first, end = self.windows, self.windows + self.width
        for _ in range(self.levels):
            if not len(names):
                break
            names, texts, run_of, symbol_of, right = next_level(names, texts)
            first, end = inside(first, end, run_of, symbol_of, right)
        both = mix64(mix64(names[:-1] + NAME_SALT) + names[1:])
        # A pair across two texts is inside no window.
        return both, self.documents[texts[:-1]], first, np.maximum(end - 1, first)

    def window_names(self, some: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """96 bits for each of these windows: 64 and 32."""
        checks = word_names(self.data, self.starts, self.ends, _CHECKS)
        name, check = np.full(len(some), NAME_SALT), np.full(len(some), NAME_SALT)
        for k in range(self.width):
            name = mix64(name + self.names[some + k])
            check = mix64(check + checks[some + k])
        return name, (check >> U64(32)).astype(np.uint32)


def holders(names: np.ndarray, checks: np.ndarray, documents: np.ndarray, last: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of the distinct (name, check) in order: a row of each, its smallest and its largest document; and of every row, its place among them.

    A row is a document, or with ``last`` several of them from ``documents`` to ``last``.
    """
    order = np.argsort(names)
    new = np.ones(len(order), bool)
    new[1:] = names[order][1:] != names[order][:-1]
    if (~new[1:] & (checks[order][1:] != checks[order][:-1])).any():  # one name of several checks
        order = np.lexsort((checks, names))
        new[1:] = (names[order][1:] != names[order][:-1]) | (checks[order][1:] != checks[order][:-1])
    begin = np.flatnonzero(new)
    of = np.empty(len(order), np.int64)
    of[order] = np.cumsum(new) - 1
    if not len(begin):
        return begin, np.zeros(0, np.int64), np.zeros(0, np.int64), of
    least = np.minimum.reduceat(documents[order], begin)
    most = np.maximum.reduceat((documents if last is None else last)[order], begin)
    return order[begin], least, most, of


def no_checks(names: np.ndarray) -> np.ndarray:
    return np.zeros(len(names), np.uint32)


def planes(values: np.ndarray) -> np.ndarray:
    """Integers as byte planes, a row for each, which compress where high bytes repeat."""
    return np.ascontiguousarray(values.view(np.uint8).reshape(len(values), values.dtype.itemsize).T)


def from_planes(data: bytes, kind) -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(size, -1).T).view(kind).ravel()


def packed(names: np.ndarray, checks: np.ndarray, least: np.ndarray, most: np.ndarray, buckets: int) -> Iterator[tuple[int, int, bytes, bytes, bytes, bytes]]:
    """bucket, rows, names (differences of the sorted), checks, smallest documents and the way to the largest, for each bucket that has some."""
    bucket = (names >> U64(32)) * U64(buckets) >> U64(32)
    edges = np.searchsorted(bucket, np.arange(buckets + 1, dtype=U64))
    used = np.flatnonzero(np.diff(edges))
    steps = np.diff(names, prepend=U64(0))
    steps[edges[used]] = names[edges[used]]  # a bucket's first name is whole
    columns = [planes(c) for c in (steps, checks, least, most - least)]
    for k in used.tolist():
        a, b = int(edges[k]), int(edges[k + 1])
        yield k, b - a, *(c[:, a:b].tobytes() for c in columns)


ASKED = "slice string, bucket int, rows long, names binary, checks binary, least binary, more binary"
ANSWER = "slice string, bucket int, rows long, yes binary"


def _asked(uri: str, names: np.ndarray, checks: np.ndarray, documents: np.ndarray, buckets: int) -> pa.RecordBatch | None:
    begin, least, most, _ = holders(names, checks, documents)
    rows = list(packed(names[begin], checks[begin], least, most, buckets))
    if not rows:
        return None
    bucket, count, *data = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays(
        [pa.array([uri] * len(rows)), pa.array(bucket, pa.int32()), pa.array(count, pa.int64()), *(pa.array(d, pa.binary()) for d in data)],
        ["slice", "bucket", "rows", "names", "checks", "least", "more"],
    )


def _answers(shared: bool):
    """For every slice's names of one bucket, bits: whether several documents have it, or whether one smaller than the slice's own has it."""

    def answer(bucket: pa.Table) -> pa.Table:
        columns = {"names": U64, "checks": np.uint32, "least": np.int64, "more": np.int64}
        parts = {c: [from_planes(row, kind) for row in bucket.column(c).to_pylist()] for c, kind in columns.items()}
        names = np.concatenate([np.cumsum(steps, dtype=U64) for steps in parts["names"]])
        checks, first, more = (np.concatenate(parts[c]) for c in ("checks", "least", "more"))
        _, least, most, of = holders(names, checks, first, first + more)
        yes = most[of] > least[of] if shared else first > least[of]
        ends = np.cumsum(bucket.column("rows").to_numpy()).tolist()
        bits = [np.packbits(yes[a:b]) for a, b in zip([0, *ends], ends, strict=False)]
        return pa.table([bucket.column("slice"), bucket.column("bucket"), bucket.column("rows"), pack_lists(bits, np.uint8)], names=["slice", "bucket", "rows", "yes"])

    return lean_group(answer)


def answered(asked: DataFrame, label: str, shared: bool) -> DataFrame:
    """slice and the answers to all its names, in the names' order: as many bits as the slice has names."""
    bits = asked.groupBy("bucket").applyInArrow(_answers(shared), ANSWER)
    answer = F.struct("bucket", "rows", "yes").alias("answer")
    return staged(bits.groupBy("slice").agg(F.sort_array(F.collect_list(answer)).alias(label)), label)


def bits_of(answers: list[dict] | None) -> np.ndarray:
    parts = [np.unpackbits(np.frombuffer(a["yes"], np.uint8), count=a["rows"]) for a in answers or []]
    return np.concatenate([*parts, np.zeros(0, np.uint8)]).astype(bool)


def _slices(folder: str, limit: int):
    """Writes texts to files of some megabytes each and returns their names."""

    def write(ids: list[np.ndarray], texts: list[pa.Array]) -> str:
        uri = new_name(folder, ".arrow")
        table = pa.table([pa.array(np.concatenate(ids), mask=np.concatenate(ids) == NO_ID), pa.chunked_array(texts)], names=["doc_id", "text"])
        with open_new(uri) as out, pa.ipc.new_file(out, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as file:
            file.write_table(table)
        return uri

    def run(batches):
        ids, texts, held = [], [], 0
        for batch in batches:
            column = batch.column("text").cast(pa.large_string())
            document = batch.column("doc").to_numpy()
            _, offsets = text_buffers(column)
            first = 0
            while first < batch.num_rows:
                end = int(np.searchsorted(offsets, offsets[first] + limit - held, "right")) - 1
                end = min(batch.num_rows, max(end, first + (not ids)))
                if end > first:
                    ids.append(document[first:end])
                    # A copy, so that the whole batch isn't held.
                    texts.append(pa.concat_arrays([column.slice(first, end - first)]))
                    held += int(offsets[end] - offsets[first])
                if end < batch.num_rows:
                    yield _named(write(ids, texts))
                    ids, texts, held = [], [], 0
                first = end
        if ids:
            yield _named(write(ids, texts))

    return lean(run)


def _named(uri: str) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([uri])], ["slice"])


def read_slice(uri: str, width: int, levels: int) -> tuple[pa.Table, Slice]:
    with open_file(uri) as file:
        table = pa.ipc.open_file(file).read_all()
    documents = table.column("doc_id").fill_null(NO_ID).to_numpy()
    data, offsets = text_buffers(table.column("text"))
    return table, Slice(documents, data, offsets, width, levels)


def candidates(part: Slice, shared: np.ndarray) -> np.ndarray:
    """The windows all of whose inner pairs another document has too."""
    names, documents, first, end = part.pairs()
    _, least, most, of = holders(names, no_checks(names), documents)
    alone = np.concatenate([[0], np.cumsum(~((most > least) | shared)[of])])
    return part.windows[alone[end] == alone[first]]


def repeated(part: Slice, some: np.ndarray, smaller: np.ndarray) -> np.ndarray:
    """Of these windows, those that start in a smaller document too."""
    documents = part.documents[part.text[some]]
    _, least, _, of = holders(*part.window_names(some), documents)
    return some[(documents > least[of]) | smaller[of]]


def kept_words(part: Slice, repeats: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Whether each word stays, and the kept words joined by one space: bytes and offsets."""
    cover = np.zeros(len(part.names) + 1, np.int32)
    cover[repeats] += 1  # at most one window starts at a word
    np.subtract.at(cover, repeats + part.width, 1)
    stays = np.cumsum(cover[:-1]) == 0
    # Each kept word's bytes and, but for the text's last one, the white space after it as a blank.
    kept = np.flatnonzero(stays)
    text = part.text[kept]
    blank = np.zeros(len(kept), bool)
    blank[:-1] = text[1:] == text[:-1]
    step = np.zeros(len(part.data) + 2, np.int8)
    step[part.starts[kept]] += 1
    np.subtract.at(step, part.ends[kept] + blank, 1)
    chosen = np.cumsum(step[:-2], dtype=np.int8).astype(bool)
    data = np.where(IS_SPACE[part.data], np.uint8(0x20), part.data)[chosen]
    sizes = np.bincount(text, part.ends[kept] - part.starts[kept] + blank, len(part.offsets) - 1)
    return stays, data, np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)


def _ask_pairs(width: int, levels: int, buckets: int):
    def run(batches):
        for batch in batches:
            for uri in batch.column("slice").to_pylist():
                _, part = read_slice(uri, width, levels)
                names, documents, _, _ = part.pairs()
                asked = _asked(uri, names, no_checks(names), documents, buckets)
                if asked is not None:
                    yield asked

    return lean(run)


def _ask_windows(width: int, levels: int, buckets: int):
    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                _, part = read_slice(row["slice"], width, levels)
                some = candidates(part, bits_of(row["reveal"]))
                asked = _asked(row["slice"], *part.window_names(some), part.documents[part.text[some]], buckets)
                if asked is not None:
                    yield asked

    return lean(run)


KEPT = "doc_id long, n_words long, n_removed long, kept string"


def _deduplicated(width: int, levels: int, digests: bool):
    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                table, part = read_slice(row["slice"], width, levels)
                some = candidates(part, bits_of(row["reveal"]))
                stays, data, offsets = kept_words(part, repeated(part, some, bits_of(row["verify"])))
                n = np.diff(part.first)
                sums = np.concatenate([[0], np.cumsum(~stays)])
                body = memoryview(data.tobytes())
                texts = (body[a:b] for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True))
                kept = [hashlib.sha256(t).hexdigest() if digests else str(t, "utf-8") for t in texts]
                yield from pa.table(
                    [table.column("doc_id").combine_chunks(), pa.array(n, pa.int64()), pa.array(sums[part.first[1:]] - sums[part.first[:-1]], pa.int64()), pa.array(kept, pa.string())],
                    names=["doc_id", "n_words", "n_removed", "kept"],
                ).to_batches(max_chunksize=4096)

    return lean(run)


def deduplicate_substrings(
    docs: DataFrame, width: int = WIDTH, levels: int = LEVELS, slice_bytes: int = SLICE_BYTES, buckets: int | None = None, digests: bool = False
) -> DataFrame:
    """doc_id, n_words, n_removed and kept: the words left, joined by one space (with ``digests`` their SHA-256).

    ``buckets``: ranges of names, of which a task holds one at a time; by default four for each shuffle partition.
    """
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    buckets = buckets or 4 * parts
    rows = with_types(docs, doc_id="long", text="string").select(F.coalesce("doc_id", F.lit(NO_ID)).alias("doc"), "text")
    folder = shared_folder(spark, "recompress")
    slices = staged(rows.mapInArrow(_slices(folder, slice_bytes), "slice string"), "slices")
    # A slice is a short row that stands for megabytes, so the number of tasks is set here.
    tasks = max(1, min(slices.count(), 4 * parts))
    reveal = answered(slices.repartition(tasks).mapInArrow(_ask_pairs(width, levels, buckets), ASKED), "reveal", True)
    known = slices.join(reveal, "slice", "left")
    verify = answered(known.repartition(tasks).mapInArrow(_ask_windows(width, levels, buckets), ASKED), "verify", False)
    both = known.join(verify, "slice", "left").repartition(tasks)
    return both.mapInArrow(_deduplicated(width, levels, digests), KEPT)

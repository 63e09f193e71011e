"""Vectorised reading of text columns: Arrow buffers in, numpy spans and hashes out.

A string column of an Arrow batch is one byte buffer plus offsets, so words,
lines and their hashes are found with array operations over all texts of a
batch at once and no Python object per word. Work proceeds in slices of a few
megabytes of text, whatever the batch holds; a single longer text is a slice
of its own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U64 = np.uint64
#: Characters that separate words and are stripped or deleted in the contracts.
SPACES = bytes([0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D])
SLICE_BYTES = 1 << 20

IS_SPACE = np.zeros(256, bool)
IS_SPACE[list(SPACES)] = True
#: A-Z lower-cased, every other byte as it is.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A"):ord("Z") + 1] += 32
#: Bytes of letters and digits; bytes of longer UTF-8 characters count as letters.
IS_ALNUM = np.zeros(256, bool)
for _a, _b in ((0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF)):
    IS_ALNUM[_a:_b + 1] = True
IS_LETTER = IS_ALNUM.copy()
IS_LETTER[0x30:0x3A] = False


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit integers, so that all bits depend on all bits."""
    x = x ^ (x >> U64(31))
    x = x * U64(0x7FB5D329728EA185)
    x = x ^ (x >> U64(27))
    x = x * U64(0x81DADEF4BC2DD44D)
    return x ^ (x >> U64(33))


class ByteHash:
    """64-bit hashes of byte spans from one running sum.

    Byte b at position i adds ``table[b] * base**i`` to the sum; the difference
    of two sums, times ``base**-start``, depends on the span's bytes only.
    Arithmetic is modulo 2**64, where every odd base has an inverse.
    """

    def __init__(self, seed: int, fold: np.ndarray | None = None):
        rng = np.random.default_rng(seed)
        table = rng.integers(1, 1 << 63, 256, dtype=np.uint64) * U64(2) + U64(1)
        self.table = table[fold] if fold is not None else table
        self.base = U64(int(rng.integers(1 << 40, 1 << 60)) * 8 + 5)
        self.inverse = U64(pow(int(self.base), -1, 1 << 64))
        self._powers = np.ones(1, U64)
        self._inverses = np.ones(1, U64)

    def _grown(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self._powers) < n:
            powers, inverses = self._run(self.base, n), self._run(self.inverse, n)
            if n > SLICE_BYTES + 1:  # kept for usual slices only
                return powers, inverses
            self._powers, self._inverses = powers, inverses
        return self._powers[:n], self._inverses[:n]

    @staticmethod
    def _run(base: np.uint64, n: int) -> np.ndarray:
        steps = np.full(n, base, U64)
        steps[0] = 1
        return np.multiply.accumulate(steps)

    def spans(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """The hashes of the spans. Longer data are read a piece at a time, so what is held is a piece and the spans."""
        if len(data) <= SLICE_BYTES:
            powers, inverses = self._grown(len(data) + 1)
            sums = np.zeros(len(data) + 1, U64)
            np.cumsum(self.table[data] * powers[:-1], out=sums[1:])
            raw = (sums[ends] - sums[starts]) * inverses[starts]
        else:
            raw = (self._sums_at(data, ends) - self._sums_at(data, starts)) * self._inverses_at(starts)
        return mix64(raw + (ends - starts).astype(U64) * U64(0x9E3779B97F4A7C15))

    def _sums_at(self, data: np.ndarray, places: np.ndarray) -> np.ndarray:
        """The running sum before each place."""
        order = np.argsort(places, kind="stable")
        sorted_places, out = places[order], np.empty(len(places), U64)
        powers, _ = self._grown(SLICE_BYTES + 1)
        carried, factor, first = U64(0), U64(1), 0
        for start in range(0, len(data) + 1, SLICE_BYTES):
            piece = data[start:start + SLICE_BYTES]
            sums = np.empty(len(piece) + 1, U64)
            sums[0] = carried
            np.cumsum(self.table[piece] * (powers[:len(piece)] * factor), out=sums[1:])
            sums[1:] += carried
            last = int(np.searchsorted(sorted_places, start + SLICE_BYTES))
            out[order[first:last]] = sums[sorted_places[first:last] - start]
            carried, factor, first = sums[-1], factor * powers[SLICE_BYTES], last
        return out

    def _inverses_at(self, places: np.ndarray) -> np.ndarray:
        _, inverses = self._grown(SLICE_BYTES + 1)
        steps = self._run(inverses[SLICE_BYTES], int(places.max(initial=0)) // SLICE_BYTES + 1)
        return inverses[places % SLICE_BYTES] * steps[places // SLICE_BYTES]


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts and the offsets between them; a null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type):
        kind = np.int64
    else:
        kind = np.int32
    if column.null_count:
        column = pc.fill_null(column, b"" if "binary" in str(column.type) else "")
    n = len(column)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, kind)[column.offset:column.offset + n + 1].astype(np.int64)
    if data is None or offsets[-1] == offsets[0]:
        return np.zeros(0, np.uint8), np.zeros(n + 1, np.int64)
    data = np.frombuffer(data, np.uint8)[offsets[0]:offsets[-1]]
    return data, offsets - offsets[0]


def text_slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of rows with at most ``limit`` bytes of text, or one longer row: (first, end, bytes, offsets)."""
    data, offsets = text_buffers(column)
    n, first = len(offsets) - 1, 0
    while first < n:
        end = int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1
        end = min(n, max(end, first + 1))
        yield first, end, data[offsets[first]:offsets[end]], offsets[first:end + 1] - offsets[first]
        first = end


def spans_of(member: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Maximal runs of ``member`` bytes inside each text: starts, ends and, per text, the first run.

    The third array has one entry more than there are texts: the runs of text
    t are those from ``first[t]`` to ``first[t + 1]``.
    """
    n = len(member)
    if n == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    before, after = np.empty(n, bool), np.empty(n, bool)
    before[0], before[1:] = False, member[:-1]
    after[-1], after[:-1] = False, member[1:]
    inner = offsets[1:-1]
    before[inner[inner < n]] = False
    after[inner[inner > 0] - 1] = False
    starts = np.flatnonzero(member & ~before)
    ends = np.flatnonzero(member & ~after) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def words_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words: runs of characters other than ``SPACES``."""
    return spans_of(~IS_SPACE[data], offsets)


def code_points(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Code points of each text: bytes that don't continue a UTF-8 character."""
    sums = np.zeros(len(data) + 1, np.int64)
    np.cumsum((data & 0xC0) != 0x80, out=sums[1:])
    return sums[offsets[1:]] - sums[offsets[:-1]]


def windows(values: np.ndarray, width: int, salt: int = 0) -> np.ndarray:
    """Hashes of every run of ``width`` successive values."""
    n = len(values) - width + 1
    if n <= 0:
        return np.zeros(0, U64)
    total = np.full(n, U64(salt * 2 + 1))
    for k in range(width):
        total = mix64(total + values[k:k + n])
    return total


def pack_lists(parts: list[np.ndarray], dtype) -> pa.Array:
    """Arrays as a binary column, little-endian."""
    return pa.array([p.astype(dtype).tobytes() for p in parts], pa.binary())

"""A bit map of fixed size over 64-bit hashes, built by Spark, to be broadcast.

Its size is set beforehand and at most ``2**MAX_BITS`` bits (8 MB), whatever it
is built from. Each hash sets two bits. A hash that was put in is always
found; another may be found by chance, the more often the fuller the map. It
only spares work: what it lets through is joined exactly afterwards.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MIN_BITS, MAX_BITS = 20, 26


def bits_for(count: int) -> int:
    """Sixteen bits for each hash, within the bounds."""
    return min(MAX_BITS, max(MIN_BITS, (16 * count).bit_length()))


def collect_bits(df: DataFrame, column: str, bits: int = 24) -> bytes:
    """The map of a column of 64-bit integers, or of digests by their first 8 bytes."""
    value = F.col(column)
    if df.schema[column].dataType.simpleString() == "binary":
        value = F.conv(F.rpad(F.hex(F.substring(value, 1, 8)), 16, "0"), 16, -10).cast("long")
    high = F.shiftrightunsigned(value, 64 - bits)
    low = value.bitwiseAND((1 << bits) - 1)
    words = (
        df.select(F.explode(F.array(high, low)).alias("place"))
        .select(F.shiftright("place", 6).alias("word"), (F.col("place") % 64).cast("int").alias("at"))
        .groupBy("word")
        .agg(F.expr("bit_or(shiftleft(1L, at))").alias("bits"))
    )
    table = np.zeros(1 << (bits - 6), np.int64)
    found = words.toArrow()  # at most one row of 16 bytes for each word of the map
    table[found.column("word").to_numpy()] = found.column("bits").to_numpy()
    return table.tobytes()


class BitMap:
    def __init__(self, table: bytes):
        self.words = np.frombuffer(table, np.uint64)
        self.bits = (len(self.words) * 64).bit_length() - 1

    def _set(self, place: np.ndarray) -> np.ndarray:
        return (self.words[place >> np.uint64(6)] >> (place & np.uint64(63))) & np.uint64(1) == 1

    def holds(self, hashes: np.ndarray) -> np.ndarray:
        out = self._set(hashes >> np.uint64(64 - self.bits))
        some = np.flatnonzero(out)
        out[some] = self._set(hashes[some] & np.uint64((1 << self.bits) - 1))
        return out

    def holds_digest(self, digest: bytes) -> bool:
        return bool(self.holds(np.array([int.from_bytes(digest[:8].ljust(8, b"\0"), "big")], np.uint64))[0])

"""Token ids in files: frequency-ranked, byte-aligned, with separate control bytes.

Every text is encoded, the ids of the whole corpus are counted, and each id is
replaced by its rank, so that frequent ids are small numbers. A number takes
one to four bytes; its length less one takes two bits of a control byte. A
file holds, in this order: a header, the documents' ids and lengths, all
control bytes, all number bytes. Reading looks the four lengths of each control
byte up in a table and gathers the bytes with numpy.

The texts are encoded once into a staged table, which is counted and then
range-partitioned by document id; each range writes its files in ascending
order, and a running sum over files gives every document's start.

Words recur, so each Python worker keeps the ids of the short word units it met, in a
hash table of numpy arrays: the units of a slice are cut, packed into integers, looked up
and replaced by array operations, without an object for each; only units not met before reach the
tokenizer. A unit begins where the byte-level pattern always splits: at a space or newline that follows a
character other than white space, and after a space and Latin letters that no other letter follows.
The pattern looks ahead only past white space, and a unit doesn't end with any but at
the text's end, so encoding units one by one gives the ids of the whole text. Units
that begin with a space or newline can stand side by side in one string; the byte lengths of its ids tell them apart again.

Defined results: null and empty texts have the end id only. Documents without
an id come first. Rows with the same id follow each other, ordered by a hash of their
ids and by these, so that many rows without an id spread over files; each gets its own start. Bytes that aren't UTF-8 count as U+FFFD.
"""

from __future__ import annotations

import json
import os
import struct
import zlib
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from atelier.llm.files import new_name, open_file, open_new
from atelier.llm.staging import shared_folder, staged, with_types
from atelier.llm.textbytes import SLICE_BYTES, U64, mix64, text_slices
from atelier.llm.workers import kept, lean

END_ID = 2
#: A unit's key has so many 8-byte words, so longer units aren't kept; nor are more units than this.
KEY_WORDS, KEEP_UNITS = 3, 1 << 20
#: Units that are encoded side by side.
PACKED_UNITS = 256
#: A file ends after the document that brings it to so many ids.
FILE_TOKENS = 1 << 22
#: Tasks that read files back.
MAX_READERS = 100_000
MAGIC = b"ATK1"
HEADER = struct.Struct("<4sQQQ")
_KEY_FACTORS = [U64(x) for x in (0x9FB21C651E98DF25, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB)]
_FILE_ROW = (pa.int32(), pa.int32(), pa.string(), pa.int64(), pa.int64())

#: Of each control byte: the lengths of its four numbers.
LENGTHS = ((np.arange(256)[:, None] >> np.array([0, 2, 4, 6])) & 3).astype(np.uint8) + np.uint8(1)


def pack_numbers(numbers: np.ndarray) -> tuple[bytes, bytes]:
    """Control bytes and number bytes of 32-bit numbers."""
    numbers = numbers.astype("<u4")
    size = 1 + (numbers > 0xFF).astype(np.uint8) + (numbers > 0xFFFF) + (numbers > 0xFFFFFF)
    codes = np.zeros(-(-len(numbers) // 4) * 4, np.uint8)
    codes[:len(numbers)] = size - 1
    control = (codes.reshape(-1, 4) << np.array([0, 2, 4, 6], np.uint8)).sum(axis=1).astype(np.uint8)
    octets = numbers.view(np.uint8).reshape(-1, 4)
    return control.tobytes(), octets[np.arange(4) < size[:, None]].tobytes()


def unpack_numbers(control: np.ndarray, octets: np.ndarray, n: int) -> np.ndarray:
    """The numbers again: lengths by table, then one gather for each byte of a number."""
    size = LENGTHS[control].ravel()[:n]
    at = np.cumsum(size, dtype=np.int64) - size
    out = octets[at].astype(np.uint32)
    some = np.flatnonzero(size > 1)
    for k in range(1, 4):
        out[some] |= octets[at[some] + k].astype(np.uint32) << np.uint32(8 * k)
        some = some[size[some] > k + 1]
    return out


def id_type(definition: str, end_id: int) -> str:
    """Ids travel as 16-bit integers where the vocabulary allows, else as 32-bit ones."""
    from tokenizers import Tokenizer

    return "<u2" if max(Tokenizer.from_str(definition).get_vocab_size(), end_id + 1) <= 1 << 16 else "<u4"


#: White space of one byte, more than the pattern's; the lead bytes of À to ȿ, which are letters but for × and ÷.
WHITE = np.zeros(256, bool)
WHITE[[*range(0x09, 0x0E), *range(0x1C, 0x21)]] = True
LETTER = np.zeros(256, bool)
LETTER[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = True
LATIN_LEAD = np.zeros(256, bool)
LATIN_LEAD[0xC3:0xC9] = True
#: The low bytes of a word, by their number.
LOW_BYTES = np.array([(1 << 8 * k) - 1 for k in range(9)], U64)


def _ends_white(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Whether white space of several bytes ends at each place."""
    last, second, third = data[at], data[np.maximum(at - 1, 0)], data[np.maximum(at - 2, 0)]
    two = (second == 0xC2) & ((last == 0x85) | (last == 0xA0))  # U+0085, U+00A0
    general = (second == 0x80) & ((last <= 0x8A) | (last == 0xA8) | (last == 0xA9) | (last == 0xAF))  # U+2000 to U+202F
    general |= (second == 0x81) & (last == 0x9F)  # U+205F
    others = ((third == 0xE1) & (second == 0x9A) | (third == 0xE3) & (second == 0x80)) & (last == 0x80)  # U+1680, U+3000
    return two | (third == 0xE2) & general | others


def unit_starts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Where the units of texts begin; a unit ends where the next one begins."""
    cut = np.zeros(len(data) + 1, bool)
    cut[offsets[:-1]] = True
    before, here, inner = data[:-1], data[1:], cut[1:-1]
    gap = ((here == 0x20) | (here == 0x0A)) & ~WHITE[before]
    letter = LETTER[data]
    if len(data) and data.max() >= 0x80:
        lead = LATIN_LEAD[data]
        sign = (before == 0xC3) & ((here == 0x97) | (here == 0xB7))
        lead[:-1] &= ~sign
        letter |= lead
        letter[1:] |= lead[:-1]
        wide = np.flatnonzero(gap & (before >= 0x80))
        gap[wide[_ends_white(data, wide)]] = False
    inner |= gap
    begins = np.flatnonzero(letter[1:] & ~letter[:-1]) + 1
    ends = np.flatnonzero(letter[:-1] & ~letter[1:]) + 1
    if len(data) and letter[0]:
        ends = ends[1:]
    begins = begins[:len(ends)]
    cut[ends[(data[begins - 1] == 0x20) & (data[ends] < 0x80)]] = True
    return np.flatnonzero(cut[:-1])


def text_pieces(data: np.ndarray) -> Iterator[np.ndarray]:
    """A long text cut where units begin, into pieces of some ``SLICE_BYTES``; one without such places is one piece."""
    begun, seen = 0, 0
    while len(data) - begun > SLICE_BYTES and seen < len(data):
        part = data[max(seen, begun):max(seen, begun) + SLICE_BYTES + 1]
        places = np.flatnonzero(((part[1:] == 0x20) | (part[1:] == 0x0A)) & ~WHITE[part[:-1]] & (part[:-1] < 0x80))
        seen = max(seen, begun) + SLICE_BYTES
        if len(places):
            end = seen - SLICE_BYTES + int(places[-1]) + 1
            yield data[begun:end]
            begun = end
    yield data[begun:]


class UnitTable:
    """Ids of short units. Keys are the units' bytes in whole words and their length, compared in full."""

    def __init__(self, kind: str, room: int = KEEP_UNITS):
        self.room, self.n, self.used = room, 0, 0
        self.slots = np.full(1 << (4 * room - 1).bit_length(), -1, np.int32)
        self.keys = np.empty((KEY_WORDS, room), U64)
        self.sizes, self.starts, self.counts = np.empty(room, np.uint8), np.empty(room, np.int64), np.empty(room, np.int64)
        self.pool = np.empty(1 << 16, kind)

    def _first_slots(self, keys: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        total = sizes.astype(U64) * _KEY_FACTORS[-1]
        for words, factor in zip(keys, _KEY_FACTORS, strict=False):
            total += words * factor
        return (mix64(total) & U64(len(self.slots) - 1)).astype(np.int64)

    def find(self, keys: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """The entry of each unit, or -1."""
        out = np.full(len(sizes), -1, np.int64)
        at, rest = self._first_slots(keys, sizes), np.arange(len(sizes))
        while len(rest):
            entry = self.slots[at]
            used = entry >= 0
            rest, at, entry = rest[used], at[used], entry[used]
            same = self.sizes[entry] == sizes[rest]
            for words, known in zip(keys, self.keys, strict=True):
                same &= known[entry] == words[rest]
            out[rest[same]] = entry[same]
            rest, at = rest[~same], (at[~same] + 1) & (len(self.slots) - 1)
        return out

    def hold(self, ids: np.ndarray) -> int:
        """Puts ids behind those of kept units, where the next ones replace them unless they are kept; their place."""
        if self.used + len(ids) > len(self.pool):
            grown = np.empty(2 * (self.used + len(ids)), self.pool.dtype)
            grown[:self.used] = self.pool[:self.used]
            self.pool = grown
        self.pool[self.used:self.used + len(ids)] = ids
        return self.used

    def keep(self, keys: np.ndarray, sizes: np.ndarray, counts: np.ndarray) -> None:
        """Keeps different new units, whose ids were held first, in their order."""
        new = slice(self.n, self.n + len(sizes))
        self.keys[:, new], self.sizes[new], self.counts[new] = keys, sizes, counts
        self.starts[new] = self.used + np.cumsum(counts) - counts
        at, rest = self._first_slots(keys, sizes), np.arange(self.n, self.n + len(sizes))
        while len(rest):
            free = self.slots[at] < 0
            self.slots[at[free]] = rest[free]
            placed = self.slots[at] == rest
            rest, at = rest[~placed], (at[~placed] + 1) & (len(self.slots) - 1)
        self.n, self.used = new.stop, self.used + int(counts.sum())


def unit_keys(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The first bytes of each unit as words, zeros behind its end."""
    padded = np.concatenate([data, np.zeros(8 * KEY_WORDS, np.uint8)])
    words = np.ndarray(len(padded) - 7, "<u8", buffer=padded, strides=(1,))
    return np.stack([words[starts + 8 * k if k else starts] & LOW_BYTES[np.clip(sizes - 8 * k, 0, 8)] if k == 0 or (sizes > 8 * k).any()
                     else np.zeros(len(starts), U64) for k in range(KEY_WORDS)])


class UnitEncoder:
    """A tokenizer that remembers the ids of short units."""

    def __init__(self, definition: str, kind: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer, self.kind = Tokenizer.from_str(definition), kind
        self.known = UnitTable(kind)
        names = self.tokenizer.get_vocab()
        #: Bytes of each id, as the byte-level alphabet has one character for each.
        self.id_bytes = np.zeros(max(names.values(), default=0) + 1, np.int64)
        self.id_bytes[list(names.values())] = [len(name) for name in names]

    def one_by_one(self, units: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the units, and how many each has."""
        found = [f.ids for f in self.tokenizer.encode_batch_fast(units, add_special_tokens=False)]
        return np.array([x for ids in found for x in ids], self.kind), np.array([len(ids) for ids in found], np.int64)

    def side_by_side(self, units: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The same for units that begin with a space or newline and don't end with white space."""
        joined = "".join(units)
        ids = np.array(self.tokenizer.encode_batch_fast([joined], add_special_tokens=False)[0].ids, np.int64)
        reached = np.cumsum(self.id_bytes[ids])
        ends = np.cumsum(list(map(len, units if joined.isascii() else map(str.encode, units))))
        last = np.searchsorted(reached, ends)
        if last[-1] != len(ids) - 1 or (reached[last] != ends).any():
            return self.one_by_one(units)  # a tokenizer whose ids have other lengths
        return ids.astype(self.kind), np.diff(last + 1, prepend=0)

    def learn(self, edges: list[str], inner: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids and their counts of new units, those that can't stand side by side first."""
        parts = [self.one_by_one(edges)]
        parts += [self.side_by_side(inner[k:k + PACKED_UNITS]) for k in range(0, len(inner), PACKED_UNITS)]
        ids, counts = zip(*parts, strict=True)
        return np.concatenate(ids), np.concatenate(counts)

    def _new_units(self, data: np.ndarray, starts: np.ndarray, sizes: np.ndarray, keys: np.ndarray):
        """Where the ids of units that aren't kept are held and how many there are; keeps the short ones while there is room."""
        raw, known = data.tobytes(), self.known
        found = [raw[a:b] for a, b in zip(starts.tolist(), (starts + sizes).tolist(), strict=True)]
        place = dict(zip(found, range(len(found)), strict=True))  # of each different unit, one place
        edges, inner, long = [], [], []
        names = {unit: unit.decode("utf-8", "replace") for unit in place}
        for unit, name in names.items():
            kind = long if len(unit) > 8 * KEY_WORDS else edges if name[0] not in " \n" or name[-1].isspace() else inner
            kind.append(unit)
        ids, counts = self.learn([names[u] for u in edges], [names[u] for u in inner])
        short = len(counts)
        if long:
            others = self.one_by_one([names[u] for u in long])
            ids, counts = np.concatenate([ids, others[0]]), np.concatenate([counts, others[1]])
        order = edges + inner + long
        begin = known.hold(ids) + np.cumsum(counts) - counts
        number = dict(zip(order, range(len(order)), strict=True))
        which = np.array([number[u] for u in found], np.int64)
        kept_now = np.array([place[u] for u in order[:min(short, known.room - known.n)]], np.int64)
        known.keep(keys[:, kept_now], sizes[kept_now], counts[:len(kept_now)])
        return begin[which], counts[which]

    def encode_bytes(self, data: np.ndarray, offsets: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts, each followed by ``end``, and the places between texts."""
        starts = unit_starts(data, offsets)
        sizes = np.diff(starts, append=len(data))
        keys = unit_keys(data, starts, sizes)
        entry = self.known.find(keys, np.minimum(sizes, 255))
        missing = np.flatnonzero(entry < 0)
        begin, counts = self.known.starts[entry], self.known.counts[entry]
        if len(missing):
            begin[missing], counts[missing] = self._new_units(data, starts[missing], sizes[missing], keys[:, missing])
        reached = np.concatenate([[0], np.cumsum(counts)])
        source = np.arange(reached[-1]) + np.repeat(begin - reached[:-1], counts)
        ids, ends = self.known.pool[source], reached[np.searchsorted(starts, offsets)]
        if len(end):
            ids = np.insert(ids, np.repeat(ends[1:], len(end)), np.tile(end, len(offsets) - 1))
        return ids, ends + len(end) * np.arange(len(offsets))

    def encode_column(self, texts: pa.Array, end: np.ndarray) -> Iterator[tuple[int, pa.Array]]:
        """The ids of runs of texts as a binary column, each with its first text's place."""
        for first, _, data, offsets in text_slices(texts, SLICE_BYTES):
            if len(data) > SLICE_BYTES:  # one long text
                parts = [self.encode_bytes(p, np.array([0, len(p)]), end[:0])[0] for p in text_pieces(data)]
                yield first, pa.array([np.concatenate([*parts, end]).tobytes()], pa.binary())
                continue
            ids, places = self.encode_bytes(data, offsets, end)
            places = (places * ids.itemsize).astype(np.int32)
            yield first, pa.Array.from_buffers(pa.binary(), len(places) - 1, [None, pa.py_buffer(places), pa.py_buffer(ids)])

    def encode(self, texts: list[str], end: bytes) -> list[bytes]:
        parts = self.encode_column(pa.array(texts, pa.string()), np.frombuffer(end, self.kind))
        return [ids for _, part in parts for ids in part.to_pylist()]


def encoder_of(definition: str, kind: str) -> UnitEncoder:
    """This Python worker's encoder: later tasks find the units of earlier ones."""
    return kept(("encoder", definition, kind), lambda: UnitEncoder(definition, kind))


def _encoded(definition, kind: str, end_id: int):
    def run(batches):
        encoder, end = encoder_of(definition.value, kind), np.array([end_id], kind)
        for batch in batches:
            for first, ids in encoder.encode_column(batch.column("text"), end):
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(first, len(ids)), ids], ["doc_id", "ids"])

    return run


def encode(docs: DataFrame, tokenizer_file: str, end_id: int = END_ID) -> tuple[DataFrame, str]:
    """doc_id and ``ids``, the document's ids with the end id as little-endian integers, and their type."""
    definition = Path(tokenizer_file).read_text(encoding="utf-8")
    kind = id_type(definition, end_id)
    rows = with_types(docs, doc_id="long", text="string")
    shared = docs.sparkSession.sparkContext.broadcast(definition)
    return rows.mapInArrow(lean(_encoded(shared, kind, end_id), keeps=True), "doc_id long, ids binary"), kind


def _counted(kind: str):
    def run(batches):
        total = np.zeros(0, np.int64)
        for batch in batches:
            ids = np.frombuffer(b"".join(batch.column("ids").to_pylist()), kind)
            found = np.bincount(ids, minlength=len(total))
            found[:len(total)] += total
            total = found
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], ["id", "n"])

    return run


def rank_ids(encoded: DataFrame, kind: str) -> np.ndarray:
    """Ids by falling frequency, then by number: as many entries as the vocabulary has ids in use."""
    counts = encoded.select("ids").mapInArrow(lean(_counted(kind)), "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))
    found = counts.toPandas().sort_values(["n", "id"], ascending=[False, True])
    return found["id"].to_numpy(np.uint32)


def write_file(uri: str, docs: list[int | None], sizes: list[int], numbers: np.ndarray) -> None:
    """One file of documents and the ranks of their ids."""
    control, octets = pack_numbers(numbers)
    named = np.array([d is not None for d in docs], np.uint8)
    with open_new(uri) as out:
        out.write(HEADER.pack(MAGIC, len(docs), len(numbers), len(octets)))
        out.write(np.array([d or 0 for d in docs], "<i8").tobytes() + named.tobytes())
        out.write(np.array(sizes, "<u8").tobytes())
        out.write(control)
        out.write(octets)


def _written(folder: str, ranked, kind: str):
    def run(batches):
        ranks = np.zeros(int(ranked.value.max()) + 1 if len(ranked.value) else 1, np.uint32)
        ranks[ranked.value] = np.arange(len(ranked.value), dtype=np.uint32)
        part, order = TaskContext.get().partitionId(), 0
        held, docs, sizes, total = [], [], [], 0

        def flush():
            name = new_name(folder, ".ids")
            write_file(name, docs, sizes, ranks[np.concatenate(held)])
            return pa.RecordBatch.from_arrays(
                [pa.array([x], t) for x, t in zip((part, order, name, len(docs), total), _FILE_ROW, strict=True)], ["part", "seq", "file", "n_docs", "n_ids"]
            )

        for batch in batches:
            for doc, ids in zip(batch.column("doc_id").to_pylist(), batch.column("ids"), strict=True):
                held.append(np.frombuffer(ids.as_buffer(), kind))
                docs.append(doc)
                sizes.append(len(held[-1]))
                total += sizes[-1]
                if total >= FILE_TOKENS:
                    yield flush()
                    held, docs, sizes, total, order = [], [], [], 0, order + 1
        if docs:
            yield flush()

    return run


def write_files(encoded: DataFrame, kind: str, folder: str) -> DataFrame:
    """Writes the files and the rank table below ``folder``; one row per file: part, seq, file, n_docs, n_ids."""
    spark = encoded.sparkSession
    ranked = rank_ids(encoded, kind)
    with open_new(f"{folder}/ranks.json") as out:
        out.write(json.dumps(ranked.tolist()).encode())
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = encoded.withColumn("place", F.xxhash64("ids")).repartitionByRange(parts, "doc_id", "place")
    ordered = ordered.sortWithinPartitions("doc_id", "place", "ids").drop("place")
    row = "part int, seq int, file string, n_docs long, n_ids long"
    return staged(ordered.mapInArrow(lean(_written(folder, spark.sparkContext.broadcast(ranked), kind)), row), "files")


def read_file(uri: str, ranked: np.ndarray):
    """Document ids (None for none), lengths and all ids of one file."""
    with open_file(uri) as f:
        magic, n_docs, n_ids, n_octets = HEADER.unpack(f.read(HEADER.size))
        if magic != MAGIC:
            raise ValueError(f"not a file of token ids: {uri}")
        docs = np.frombuffer(f.read(8 * n_docs), "<i8")
        named = np.frombuffer(f.read(n_docs), np.uint8)
        sizes = np.frombuffer(f.read(8 * n_docs), "<u8").astype(np.int64)
        control = np.frombuffer(f.read(-(-n_ids // 4)), np.uint8)
        octets = np.frombuffer(f.read(n_octets), np.uint8)
    ids = ranked[unpack_numbers(control, octets, n_ids)] if n_ids else np.zeros(0, np.uint32)
    return [int(d) if k else None for d, k in zip(docs, named, strict=True)], sizes, ids


def _read_back(folder: str):
    def run(batches):
        with open_file(f"{folder}/ranks.json") as f:
            ranked = np.array(json.loads(f.read()), np.uint32)
        for batch in batches:
            for name, start in zip(batch.column("file").to_pylist(), batch.column("start").to_pylist(), strict=True):
                docs, sizes, ids = read_file(name, ranked)
                ends = np.cumsum(sizes)
                begins = ends - sizes
                flat = memoryview(ids.astype("<u4").tobytes())
                sums = [zlib.crc32(flat[4 * a:4 * b]) for a, b in zip(begins, ends, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(docs, pa.int64()), pa.array(begins + start), pa.array(sizes), pa.array(sums, pa.int64())],
                    ["doc_id", "start", "n_tokens", "ids_crc32"],
                )

    return run


def read_files(files: DataFrame, folder: str) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of every document in the files."""
    # One row per part, in one task: as many rows as there are partitions.
    parts = files.groupBy("part").agg(F.sum("n_ids").alias("in_part"))
    parts = parts.select("part", (F.sum("in_part").over(Window.orderBy("part")) - F.col("in_part")).alias("before"))
    within = F.sum("n_ids").over(Window.partitionBy("part").orderBy("seq")) - F.col("n_ids")
    placed = files.join(F.broadcast(parts), "part").select("file", (F.col("before") + within).alias("start"))
    # A task for each file: the names alone are so short that Spark would give them all to one.
    placed = placed.repartition(max(1, min(files.count(), MAX_READERS)))
    return placed.mapInArrow(lean(_read_back(folder)), "doc_id long, start long, n_tokens long, ids_crc32 long")


def token_files(docs: DataFrame, tokenizer_file: str, end_id: int = END_ID) -> DataFrame:
    """Encodes, writes below the shared folder and reads back."""
    folder = shared_folder(docs.sparkSession, "token-ids")
    encoded, kind = encode(docs, tokenizer_file, end_id)
    return read_files(write_files(staged(encoded, "encoded"), kind, folder), folder)

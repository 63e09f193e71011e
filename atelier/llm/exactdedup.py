"""Exact deduplication by content-defined chunk recipes.

A text, without its white space, is cut where a hash of the last ``SPAN``
bytes has its low bits zero, so equal passages are cut alike wherever they
stand. A document becomes its recipe: the ordered list of its chunks'
digests. Documents are compared by recipe only; texts don't move.

Digests are verified. Chunks whose digest occurs again are gathered once for
each task that holds them, and equal digests over different bytes are told
apart by number. A fixed-size bit map of the repeated digests keeps the other
chunks at home. Where such a conflict exists, the recipes of the documents
concerned are written with the number beside the digest.

Defined results: null and empty texts are equal to each other and to texts of
white space only. Of equal texts the row with the most code points stays,
then the smallest id; rows alike in both (repeated ids) share one ``keep_id``
and are all marked as kept.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from atelier.llm.bitmap import BitMap, collect_bits
from atelier.llm.staging import schema, staged, with_types
from atelier.llm.textbytes import IS_SPACE, ByteHash, code_points, text_slices

#: A cut depends on so many bytes; chunks have 2**MEAN_BITS bytes in the mean and MAX_CHUNK at most.
SPAN = 24
MEAN_BITS = 12
MAX_CHUNK = 1 << 16
DIGEST_BYTES = 16
_CUT = ByteHash(101)


def cut_points(data: np.ndarray) -> np.ndarray:
    """The ends of the chunks of one text, the last being its end; none for an empty text."""
    n = len(data)
    if n == 0:
        return np.zeros(0, np.int64)
    ends = np.arange(SPAN, n)
    hashes = _CUT.spans(data, ends - SPAN, ends)
    cuts = np.append(ends[(hashes & np.uint64((1 << MEAN_BITS) - 1)) == 0], n)
    if np.diff(cuts, prepend=0).max() <= MAX_CHUNK:
        return cuts
    starts = np.append(0, cuts[:-1])
    return np.concatenate([np.append(np.arange(a + MAX_CHUNK, b, MAX_CHUNK), b) for a, b in zip(starts, cuts, strict=True)])


def chunk_digest(chunk: bytes, size: int) -> bytes:
    return hashlib.blake2b(chunk, digest_size=size).digest()


def _chunks(data: np.ndarray, offsets: np.ndarray):
    """For each text: its bytes without white space, and the ends of its chunks."""
    solid = ~IS_SPACE[data]
    kept = np.concatenate([[0], np.cumsum(solid)])[offsets]
    squeezed = data[solid]
    for t in range(len(kept) - 1):
        text = squeezed[kept[t]:kept[t + 1]]
        yield text.tobytes(), cut_points(text)


def _recipes(size: int):
    def run(batches):
        for batch in batches:
            for first, end, data, offsets in text_slices(batch.column("text")):
                recipes, wholes = [], []
                for text, cuts in _chunks(data, offsets):
                    view, starts = memoryview(text), [0, *cuts[:-1]]
                    recipes.append([chunk_digest(view[a:b], size) for a, b in zip(starts, cuts, strict=False)])
                    wholes.append(hashlib.sha256(text).hexdigest())
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(first, end - first),
                        pa.array(code_points(data, offsets)),
                        pa.array(wholes, pa.string()),
                        pa.array(recipes, pa.list_(pa.binary())),
                    ],
                    ["doc_id", "points", "text_sha256", "recipe"],
                )

    return run


def _repeated_chunks(size: int, wanted):
    """Chunks whose digest the bit map holds: digest, bytes, and where they stand."""

    def run(batches):
        bits = BitMap(wanted.value)
        for batch in batches:
            seen: dict[bytes, bytes] = {}  # of this batch, whose texts bound it
            for _, _, data, offsets in text_slices(batch.column("text")):
                for text, cuts in _chunks(data, offsets):
                    for a, b in zip([0, *cuts[:-1]], cuts, strict=False):
                        digest = chunk_digest(text[a:b], size)
                        if bits.holds_digest(digest) and seen.get(digest) != text[a:b]:
                            seen[digest] = text[a:b]
                            yield digest, text[a:b]

    def arrow(batches):
        rows, held = [], 0
        for row in run(batches):
            rows.append(row)
            held += len(row[1])
            if held > 1 << 22 or len(rows) > 4000:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.binary()) for c in zip(*rows, strict=True)], ["digest", "chunk"])
                rows, held = [], 0
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.binary()) for c in zip(*rows, strict=True)], ["digest", "chunk"])

    return arrow


def _placed_chunks(size: int, wanted):
    """Chunks whose digest the bit map holds, with document row and position."""

    def run(batches):
        bits = BitMap(wanted.value)
        for batch in batches:
            for first, end, data, offsets in text_slices(batch.column("text")):
                whole, ids = [], batch.column("doc_id").slice(first, end - first).to_pylist()
                for doc, (text, cuts) in zip(ids, _chunks(data, offsets), strict=True):
                    sha = hashlib.sha256(text).hexdigest()
                    for k, (a, b) in enumerate(zip([0, *cuts[:-1]], cuts, strict=False)):
                        digest = chunk_digest(text[a:b], size)
                        if bits.holds_digest(digest):
                            whole.append((doc, sha, k, digest, text[a:b]))
                cols = list(zip(*whole, strict=True)) or [[]] * 5
                kinds = (pa.int64(), pa.string(), pa.int32(), pa.binary(), pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], ["doc_id", "text_sha256", "at", "digest", "chunk"]
                )

    return run


def verified_recipes(docs: DataFrame, digest_bytes: int = DIGEST_BYTES) -> DataFrame:
    """One row per document: doc_id, points, text_sha256 and ``recipe``, a key of its verified chunk identifiers."""
    spark = docs.sparkSession
    rows = with_types(docs, doc_id="long", text="string")
    kind = schema(doc_id="long", points="long", text_sha256="string", recipe="array<binary>")
    recipes = staged(rows.mapInArrow(_recipes(digest_bytes), kind), "recipes")

    repeated = recipes.select(F.explode("recipe").alias("digest")).groupBy("digest").count().where("count > 1")
    bits = spark.sparkContext.broadcast(collect_bits(repeated, "digest"))
    chunks = rows.mapInArrow(_repeated_chunks(digest_bytes, bits), "digest binary, chunk binary")
    variants = chunks.distinct().groupBy("digest").agg(F.count("*").alias("variants")).where("variants > 1")
    conflicts = staged(variants.select("digest"), "conflicts")

    list_key = F.sha2(F.concat_ws(",", F.size("recipe"), F.transform("recipe", F.hex)), 256)
    plain = recipes.select("doc_id", "points", "text_sha256", list_key.alias("recipe"))
    if conflicts.isEmpty():
        return plain
    # Equal digests over different bytes: number them, and add the numbers to the recipes that hold them.
    concerned = spark.sparkContext.broadcast(collect_bits(conflicts, "digest"))
    placed = rows.mapInArrow(_placed_chunks(digest_bytes, concerned), "doc_id long, text_sha256 string, at int, digest binary, chunk binary")
    placed = staged(placed.join(conflicts, "digest", "left_semi"), "placed")
    contents = placed.select("digest", F.sha2("chunk", 512).alias("content")).distinct()
    numbers = contents.groupBy("digest").agg(F.array_sort(F.collect_list("content")).alias("contents"))
    marked = (
        placed.withColumn("content", F.sha2("chunk", 512))
        .join(numbers, "digest")
        .groupBy("doc_id", "text_sha256")
        .agg(F.sort_array(F.collect_set(F.struct("at", F.array_position("contents", F.col("content")).alias("number")))).alias("marks"))
    )
    same = [plain["doc_id"].eqNullSafe(marked["doc_id"]), plain["text_sha256"] == marked["text_sha256"]]
    joined = plain.join(marked, same[0] & same[1], "left")
    key = F.concat_ws("/", plain["recipe"], F.to_json("marks"))
    return joined.select(plain["doc_id"], "points", plain["text_sha256"], key.alias("recipe"))


def deduplicate(docs: DataFrame, digest_bytes: int = DIGEST_BYTES) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256, points."""
    rows = staged(verified_recipes(docs, digest_bytes), "keys")
    first = F.min(F.struct((-F.col("points")).alias("fewest"), F.col("doc_id").isNull().alias("unnamed"), F.col("doc_id").alias("id")))
    groups = rows.groupBy("recipe").agg(F.count("*").alias("group_size"), first.alias("best"))
    # Written first: a join of two plain exchanges, so that Spark can split the partition of a hot group.
    groups = staged(groups.where("group_size > 1"), "groups")
    alone = F.col("group_size").isNull()
    return rows.join(groups, "recipe", "left").select(
        "doc_id",
        F.when(alone, F.col("doc_id")).otherwise(F.col("best.id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"),
        (alone | (F.col("doc_id").eqNullSafe(F.col("best.id")) & (F.col("points") == -F.col("best.fewest")))).alias("kept"),
        "text_sha256",
        F.col("points").alias("n_points"),
    )

"""N-gram Jaccard join by prefix trees.

Every document is the set of its distinct word shingles, as 64-bit hashes. Two
documents link when 100 * intersection >= percent * union. Documents with
equal sets are one class, represented by the smallest id; classes are compared.

Finding links takes these steps, none of which loses one:

1. *Shared shingles.* A class whose set has too few shingles in common with
   all other classes together can't link. Tasks send 32 bits of each shingle
   to the bucket that the other bits name, packed by document; a shingle that
   several classes of one batch have is settled there and sent once, so a
   very common shingle stays small. Buckets return counts per class, packed.
2. *Blocks.* Only the survivors' sets move. Their shingles have a global order,
   rare ones first, by counts over all survivors in a table of fixed size.
   Linked sets share a shingle among the first ones of each, so the connected
   components of survivors and such first shingles are blocks: linked sets
   meet in one. A large block is cut by size class and hash into pieces, which are
   compared with themselves and along a chain. The links found make components; what
   is left to compare are sets of different ones, so a large group's pieces, by
   then one component mostly, needn't meet each other.
3. *Trees.* In a block the sets, in one order of their shingles, make a prefix
   tree. A set is compared with all others by walking the tree once: the
   overlap with a path is shared by all sets below it, and a subtree is left
   when its sizes don't fit, when the overlap so far and what remains of the
   set or of the subtree's longest set can't reach the least overlap, or when
   all its sets are already in the set's component.

The last rule makes the links found a spanning part of all links: enough for
the components, without all pairs of a large group. ``links`` with
``all_links=True`` keeps them all.

Defined results: a text without words has an empty set and links with nothing,
not even with its like. Null ids are left out when the smallest id is taken.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from atelier.llm.bitmap import BitMap, bits_for, collect_bits
from atelier.llm.components import components
from atelier.llm.staging import staged, with_types
from atelier.llm.textbytes import LOWER, ByteHash, mix64, pack_lists, text_slices, words_of
from atelier.llm.workers import lean, lean_group

WORDS = 5
PERCENT = 75
#: Stands for a missing id.
NO_ID = (1 << 63) - 1
#: Shingles gathered before a task sends them, shingles of a bucket, sets of a block.
SEND_SHINGLES = 1 << 20
BUCKET_SHINGLES = 1 << 21
BLOCK_SETS = 2000
#: Entries of the table that orders shingles, and rows in which tasks send theirs.
ORDER_BITS, ORDER_ROWS = 18, 64
_WORD = ByteHash(401, LOWER)
_FACTORS = np.random.default_rng(402).integers(1, 1 << 62, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def shingle_sets(data: np.ndarray, offsets: np.ndarray, width: int = WORDS) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text; fewer words than ``width`` make one shingle."""
    starts, ends, first = words_of(data, offsets)
    words = _WORD.spans(data, starts, ends)
    n = max(len(words) - width + 1, 0)
    total = np.full(n, np.uint64(width))
    for k in range(width):
        total += words[k:k + n] * _FACTORS[k]
    hashes = mix64(total)
    sets = []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        if b - a >= width:
            sets.append(np.unique(hashes[a:b - width + 1]))
        elif b > a:
            whole = np.uint64(b - a) + (words[a:b] * _FACTORS[:b - a]).sum(dtype=np.uint64)
            sets.append(mix64(np.array([whole])))
        else:
            sets.append(np.zeros(0, np.uint64))
    return sets


def set_key(shingles: np.ndarray) -> bytes:
    return hashlib.blake2b(shingles.astype("<u8").tobytes(), digest_size=16).digest()


def short_key(key: bytes) -> int:
    return int.from_bytes(key[:8], "big")


# ---- classes -----------------------------------------------------------------------------------


def _classed(width: int):
    def run(batches):
        for batch in batches:
            for start, end, data, offsets in text_slices(batch.column("text")):
                sets = shingle_sets(data, offsets, width)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(start, end - start),
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array([set_key(s) if len(s) else None for s in sets], pa.binary()),
                        batch.column("row").slice(start, end - start),
                    ],
                    ["doc_id", "n_shingles", "key", "row"],
                )

    return run


# ---- shared shingles ---------------------------------------------------------------------------


def shingle_packets(keys: np.ndarray, sets: list[np.ndarray], buckets: int):
    """The shingles of distinct classes, packed by bucket.

    A packet has the classes' short keys, how many shingles of each it lists,
    how many more are known to be shared, the 32-bit shingles themselves, and
    those of the shared ones once.
    """
    if not sets:
        return
    shingles = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    order = np.argsort(shingles, kind="stable")
    ranked = shingles[order]
    new = np.ones(len(ranked), bool)
    new[1:] = ranked[1:] != ranked[:-1]
    run = np.cumsum(new) - 1
    shared = np.empty(len(ranked), bool)
    shared[order] = (np.bincount(run) > 1)[run]
    bucket = ((shingles >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)
    low = (shingles & np.uint64(0xFFFFFFFF)).astype("<u4")
    cell = bucket * len(sets) + owner
    by_cell = np.argsort(cell, kind="stable")
    cells, begins = np.unique(cell[by_cell], return_index=True)
    known = np.add.reduceat(shared[by_cell].astype(np.int64), begins)
    listed = np.diff(np.append(begins, len(cell))) - known
    open_ = by_cell[~shared[by_cell]]
    witness = order[new & shared[order]]
    witness = witness[np.argsort(bucket[witness], kind="stable")]
    edges = np.arange(buckets + 1)
    cell_at, open_at, witness_at = (
        np.searchsorted(x, edges) for x in (cells // len(sets), bucket[open_], bucket[witness])
    )
    for b in range(buckets):
        c = slice(cell_at[b], cell_at[b + 1])
        if c.start == c.stop:
            continue
        yield (
            b,
            keys[cells[c] % len(sets)].astype("<u8").tobytes(),
            listed[c].astype("<u4").tobytes(),
            known[c].astype("<u4").tobytes(),
            low[open_[open_at[b]:open_at[b + 1]]].tobytes(),
            low[witness[witness_at[b]:witness_at[b + 1]]].tobytes(),
        )


PACKET = "bucket int, keys binary, listed binary, known binary, shingles binary, witnesses binary"
_PACKET_NAMES = ["bucket", "keys", "listed", "known", "shingles", "witnesses"]


def _packet_batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int32(), *[pa.binary()] * 5]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], _PACKET_NAMES)


def _packets(width: int, buckets: int):
    def run(batches):
        held: dict[bytes, np.ndarray] = {}
        size = 0
        for batch in batches:
            for _, _, data, offsets in text_slices(batch.column("text")):
                for s in shingle_sets(data, offsets, width):
                    if len(s):
                        key = set_key(s)
                        size += 0 if key in held else len(s)
                        held[key] = s
                if size >= SEND_SHINGLES:
                    yield _sent(held, buckets)
                    held, size = {}, 0
        if held:
            yield _sent(held, buckets)

    return run


def _sent(held: dict[bytes, np.ndarray], buckets: int) -> pa.RecordBatch:
    keys = np.array([short_key(k) for k in held], np.uint64)
    return _packet_batch(list(shingle_packets(keys, list(held.values()), buckets)))


def count_shared(packets: pa.Table, cells: int) -> pa.Table:
    """One bucket: how many of its shingles each class shares with another class, packed by cell of the key."""
    columns = {c: [np.frombuffer(x, k) for x in packets.column(c).to_pylist()] for c, k in (
        ("keys", "<u8"), ("listed", "<u4"), ("known", "<u4"), ("shingles", "<u4"), ("witnesses", "<u4"))}
    keys, listed, known = (np.concatenate(columns[c]) for c in ("keys", "listed", "known"))
    shingles = np.concatenate(columns["shingles"])
    witnesses = np.concatenate(columns["witnesses"])
    # A witness stands for two classes, so it makes any other mention of its shingle shared.
    every = np.concatenate([shingles, witnesses, witnesses])
    whose = np.concatenate([np.repeat(keys, listed), np.zeros(len(witnesses), np.uint64), np.full(len(witnesses), np.uint64(2**64 - 1))])
    out = known.astype(np.int64)
    if len(shingles):
        order = np.argsort(every, kind="stable")
        ranked = every[order]
        begins = np.flatnonzero(np.concatenate([[True], ranked[1:] != ranked[:-1]]))
        differ = np.minimum.reduceat(whose[order], begins) != np.maximum.reduceat(whose[order], begins)
        shared = np.empty(len(every), bool)
        shared[order] = np.repeat(differ, np.diff(np.append(begins, len(every))))
        sums = np.concatenate([[0], np.cumsum(shared[:len(shingles)])])
        ends = np.cumsum(listed.astype(np.int64))
        out += sums[ends] - sums[ends - listed]
    some = out > 0
    keys, out = keys[some], out[some]
    cell = (keys >> np.uint64(32)) * np.uint64(cells) >> np.uint64(32)
    order = np.argsort(cell, kind="stable")
    edges = np.searchsorted(cell[order], np.arange(cells + 1, dtype=np.uint64))
    rows = [(c, order[edges[c]:edges[c + 1]]) for c in range(cells) if edges[c] < edges[c + 1]]
    return pa.table({
        "cell": pa.array([c for c, _ in rows], pa.int32()),
        "keys": pack_lists([keys[at] for _, at in rows], "<u8"),
        "counts": pack_lists([out[at] for _, at in rows], "<u4"),
    })


def sum_shared(cell: pa.Table) -> pa.Table:
    """One cell: the counts of each class over all buckets."""
    keys = np.concatenate([np.frombuffer(x, "<u8") for x in cell.column("keys").to_pylist()])
    counts = np.concatenate([np.frombuffer(x, "<u4") for x in cell.column("counts").to_pylist()])
    found, at = np.unique(keys, return_inverse=True)
    total = np.bincount(at, weights=counts).astype(np.int64)
    return pa.table({"short": pa.array(found.view(np.int64)), "shared": pa.array(total)})


def survivors(rows: DataFrame, classes: DataFrame, width: int, percent: int) -> DataFrame:
    """The classes that may link: key, short (8 bytes of it), n_shingles, doc_id (the smallest)."""
    spark = rows.sparkSession
    total = classes.agg(F.sum("n_shingles")).first()[0] or 0
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // BUCKET_SHINGLES))
    packets = rows.mapInArrow(lean(_packets(width, buckets)), PACKET)
    counts = packets.groupBy("bucket").applyInArrow(lean_group(lambda t: count_shared(t, buckets)), "cell int, keys binary, counts binary")
    shared = counts.groupBy("cell").applyInArrow(lean_group(sum_shared), "short long, shared long")
    return classes.join(shared, "short").where(F.col("shared") * 100 >= F.col("n_shingles") * percent).drop("shared")


# ---- blocks ------------------------------------------------------------------------------------


def _chosen_sets(width: int, table):
    def run(batches):
        bits = BitMap(table.value)
        for batch in batches:
            chosen = np.flatnonzero(bits.holds(batch.column("draw").to_numpy().view(np.uint64)))
            if not len(chosen):
                continue
            ids = batch.column("doc_id").take(pa.array(chosen))
            for start, end, data, offsets in text_slices(batch.column("text").take(pa.array(chosen))):
                sets = shingle_sets(data, offsets, width)
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.slice(start, end - start),
                        pa.array([set_key(s) for s in sets], pa.binary()),
                        pa.array([s.astype("<u8").tobytes() for s in sets], pa.binary()),
                    ],
                    ["rep_id", "set_key", "shingles"],
                )

    return run


def survivor_sets(rows: DataFrame, chosen: DataFrame, width: int) -> DataFrame:
    """The survivors with their sets, read again from the texts of their representatives."""
    spark = rows.sparkSession
    draws = chosen.select(F.xxhash64("doc_id").alias("draw"))
    table = spark.sparkContext.broadcast(collect_bits(draws, "draw", bits_for(draws.count())))
    sets = rows.select("doc_id", "text", F.xxhash64("doc_id").alias("draw")).mapInArrow(
        lean(_chosen_sets(width, table)), "rep_id long, set_key binary, shingles binary"
    )
    same = (F.col("key") == F.col("set_key")) & F.col("doc_id").eqNullSafe(F.col("rep_id"))
    return chosen.join(sets, same).drop("rep_id", "set_key").dropDuplicates(["key"])


def _order_counts(batches):
    total = np.zeros(1 << ORDER_BITS, np.int64)
    for batch in batches:
        for blob in batch.column("shingles"):
            slots = np.frombuffer(blob.as_buffer(), "<u8") >> np.uint64(64 - ORDER_BITS)
            total += np.bincount(slots.astype(np.int64), minlength=len(total)) if len(slots) > 1 << 14 else 0
            if len(slots) <= 1 << 14:
                np.add.at(total, slots.astype(np.int64), 1)
    parts = total.reshape(ORDER_ROWS, -1)
    some = [k for k in range(ORDER_ROWS) if parts[k].any()]
    yield pa.RecordBatch.from_arrays(
        [pa.array(some, pa.int32()), pa.array([parts[k].astype("<i8").tobytes() for k in some], pa.binary())], ["part", "counts"]
    )


def _order_sums(group: pa.Table) -> pa.Table:
    total = sum(np.frombuffer(x, "<i8") for x in group.column("counts").to_pylist())
    return pa.table({"part": pa.array([group.column("part")[0].as_py()], pa.int32()), "counts": pa.array([total.tobytes()], pa.binary())})


def shingle_order(sets: DataFrame) -> np.ndarray:
    """A table of fixed size: how often the survivors have a shingle with these leading bits."""
    counts = sets.select("shingles").mapInArrow(lean(_order_counts), "part int, counts binary")
    sums = counts.groupBy("part").applyInArrow(_order_sums, "part int, counts binary")
    table = np.zeros((ORDER_ROWS, (1 << ORDER_BITS) // ORDER_ROWS), np.int64)
    for part, blob in sums.collect():
        table[part] = np.frombuffer(blob, "<i8")
    return table.ravel()


def first_shingles(shingles: np.ndarray, table: np.ndarray, percent: int) -> np.ndarray:
    """The rarest shingles, so many that two linked sets have one of them in common."""
    keep = len(shingles) - (-(-percent * len(shingles) // 100)) + 1
    counts = table[(shingles >> np.uint64(64 - ORDER_BITS)).astype(np.int64)]
    return shingles[np.lexsort((shingles, counts))[:keep]]


def _first(percent: int, table):
    def run(batches):
        for batch in batches:
            parts = [
                first_shingles(np.frombuffer(x.as_buffer(), "<u8"), table.value, percent) for x in batch.column("shingles")
            ]
            if not parts:
                continue
            shorts = np.repeat(batch.column("short").to_numpy(), [len(p) for p in parts])
            every = np.concatenate(parts).astype(np.uint64).view(np.int64)
            for k in range(0, len(every), 1 << 17):
                part = slice(k, k + (1 << 17))
                yield pa.RecordBatch.from_arrays([pa.array(every[part]), pa.array(shorts[part])], ["shingle", "short"])

    return run


def block_labels(sets: DataFrame, percent: int) -> DataFrame:
    """short and label: survivors of one label share first shingles, directly or through others."""
    table = sets.sparkSession.sparkContext.broadcast(shingle_order(sets))
    mentions = staged(sets.select("short", "shingles").mapInArrow(lean(_first(percent, table)), "shingle long, short long"), "first-shingles")
    pivots = mentions.groupBy("shingle").agg(F.min("short").alias("v"), F.max("short").alias("other")).where("v < other")
    pivots = staged(pivots.drop("other"), "pivots")
    links = mentions.join(pivots, "shingle").where("short != v").select(F.col("short").alias("u"), "v")
    found = staged(components(links), "labels")
    return found.select(F.col("node").alias("short"), F.col("root").alias("label")).union(
        found.select(F.col("root").alias("short"), F.col("root").alias("label")).distinct()
    )


def named_sets(sets: DataFrame, percent: int) -> DataFrame:
    """key, label and size class c of each survivor: sets whose sizes differ by more than the ratio can't link, and classes are that wide."""
    size_class = F.floor(F.log("n_shingles") / float(np.log(100 / percent))).cast("int")
    labels = block_labels(sets, percent)
    return staged(sets.select("key", "short", size_class.alias("c")).join(labels, "short").select("key", "label", "c"), "block-sets")


def sized(named: DataFrame, most: int) -> DataFrame:
    """label, c, pieces and cut: a label of at most ``most`` sets is one piece, a larger one is cut by size class and into pieces."""
    totals = staged(named.groupBy("label", "c").count(), "block-sizes")
    whole = totals.groupBy("label").agg(F.sum("count").alias("total"))
    pieces = F.when(F.col("total") > most, F.ceil(F.col("count") / most)).otherwise(F.lit(1)).cast("int")
    cut = F.col("total") > most
    return staged(totals.join(whole, "label").select("label", "c", pieces.alias("pieces"), cut.alias("cut")), "block-parts")


def _piece(c, component, number) -> Column:
    """The name of a piece in its label."""
    return F.concat_ws(":", c, component, number)


def first_round(named: DataFrame, parts: DataFrame, every_pair: bool) -> tuple[DataFrame, DataFrame]:
    """Blocks (label, a, b) and the pieces that sets are in (key, label, piece, component).

    Blocks are the whole labels, and of a cut one each piece with itself and the next one, and the first pieces of neighbouring
    size classes; with ``every_pair`` all pairs of pieces of one or two neighbouring size classes.
    """
    none = F.lit("")
    last = F.col("pieces") - 1
    alone = parts.where("not cut").select("label", F.lit("").alias("a"), F.lit("").alias("b")).distinct()
    own = parts.where("cut").select("label", "c", last.alias("last"), F.explode(F.sequence(F.lit(0), last)).alias("i"))
    reach = F.col("last") if every_pair else F.least(F.col("last"), F.col("i") + 1)
    own = own.select("label", "c", "i", F.explode(F.sequence(F.col("i"), reach)).alias("j"))
    own = own.select("label", _piece("c", none, "i").alias("a"), _piece("c", none, "j").alias("b"))
    lower = parts.where("cut").select("label", "c", F.explode(F.sequence(F.lit(0), last if every_pair else F.lit(0))).alias("i"))
    upper = parts.where("cut").select("label", (F.col("c") - 1).alias("c"), F.explode(F.sequence(F.lit(0), last if every_pair else F.lit(0))).alias("j"))
    next_to = lower.join(upper, ["label", "c"]).select("label", _piece("c", none, "i").alias("a"), _piece(F.col("c") + 1, none, "j").alias("b"))
    number = F.pmod(F.xxhash64("key"), "pieces")
    placed = named.join(parts, ["label", "c"]).select(
        "key", "label", F.when(F.col("cut"), _piece("c", none, number)).otherwise(F.lit("")).alias("piece"), F.col("key").alias("component")
    )
    return alone.union(own).union(next_to), placed


def second_round(named: DataFrame, parts: DataFrame, found: DataFrame, most: int) -> tuple[DataFrame, DataFrame]:
    """What the first round left of the cut labels, by the components that its links make (``found``: node, root).

    A component of more than ``most`` sets of a size class has pieces of its own, which meet no others of it; all other
    sets have pieces together. So a large group's sets are sent as often as there are pieces of other sets,
    and not as often as the group has pieces.
    """
    cut = parts.where("cut").select("label", "c", F.col("pieces").alias("before"))
    sets = named.join(cut, ["label", "c"]).join(found, F.col("key") == F.col("node"), "left")
    sets = staged(sets.select("key", "label", "c", "before", F.coalesce("root", "key").alias("component")), "cut-sets")
    large = sets.groupBy("label", "c", "component").count().where(F.col("count") > most)
    large = staged(large.select("label", "c", "component", F.hex("component").alias("name")), "large-components")
    sets = staged(sets.join(large, ["label", "c", "component"], "left").withColumn("name", F.coalesce("name", F.lit(""))), "cut-places")
    units = sets.groupBy("label", "c", "name").agg(F.ceil(F.count("*") / most).cast("int").alias("pieces"), F.max("before").alias("before"))
    units = staged(units, "units")
    # Where the others have as many pieces as before they are the same ones, and some pairs have been compared.
    same = (F.col("name") == "") & (F.col("pieces") == F.col("before"))
    units = units.withColumn("same", same)
    one, other = (units.select("label", *[F.col(c).alias(f"{c}_{side}") for c in ("c", "name", "pieces", "same")]) for side in "ab")
    met = one.join(other, "label").where(
        ((F.col("c_b") == F.col("c_a")) & (F.col("name_a") <= F.col("name_b"))) | (F.col("c_b") == F.col("c_a") + 1)
    )
    met = met.where("name_a != name_b or name_a = ''")
    pairs = met.withColumn("i", F.explode(F.sequence(F.lit(0), F.col("pieces_a") - 1)))
    pairs = pairs.withColumn("j", F.explode(F.sequence(F.lit(0), F.col("pieces_b") - 1)))
    alike = "(c_a = c_b and name_a = name_b)"
    done = f"same_a and same_b and ({alike} and j - i <= 1 or c_a != c_b and i = 0 and j = 0)"
    pairs = pairs.where(f"(not {alike} or i <= j) and not ({done})")
    blocks = pairs.select("label", _piece("c_a", "name_a", "i").alias("a"), _piece("c_b", "name_b", "j").alias("b"))
    number = F.pmod(F.xxhash64("key"), "pieces")
    placed = sets.join(units.select("label", "c", "name", "pieces"), ["label", "c", "name"])
    return blocks, placed.select("key", "label", _piece("c", "name", number).alias("piece"), "component")


def compared(sets: DataFrame, blocks: DataFrame, placed: DataFrame, percent: int, all_links: bool) -> DataFrame:
    """label, u and v: the links found in the blocks."""
    sides = blocks.select("label", "a", "b", F.col("a").alias("piece")).union(blocks.where("a != b").select("label", "a", "b", F.col("b").alias("piece")))
    where = placed.join(staged(sides, "blocks"), ["label", "piece"])
    sent = sets.select("key", "n_shingles", "shingles").join(where, "key")
    return sent.groupBy("label", "a", "b").applyInArrow(lean_group(_block(percent, all_links)), "label long, u binary, v binary")


# ---- trees -------------------------------------------------------------------------------------


class PrefixTree:
    """Sets of ranks, each ascending, as a tree of shared prefixes.

    The sets are sorted, so each subtree holds successive sets ``low`` to
    ``high``. A node's segment is the part of the path below its parent.
    """

    def __init__(self, ranks: list[np.ndarray], sizes: np.ndarray):
        self.order = sorted(range(len(ranks)), key=lambda k: ranks[k].astype(">u4").tobytes())
        self.ranks = [ranks[k] for k in self.order]
        self.sizes = sizes[self.order]
        lengths = np.array([len(r) for r in self.ranks])
        common = np.zeros(len(ranks) + 1, np.int64)  # with the set before
        for k in range(1, len(ranks)):
            a, b = self.ranks[k - 1], self.ranks[k]
            n = min(len(a), len(b))
            differ = np.flatnonzero(a[:n] != b[:n])
            common[k] = differ[0] if len(differ) else n
        self.segments: list[np.ndarray] = []
        self.low, self.high, self.children, self.ends = [], [], [], []
        self.rest, self.least, self.most = [], [], []
        waiting = [(0, len(ranks), 0, -1)]
        while waiting:
            low, high, depth, parent = waiting.pop()
            end = int(lengths[low]) if high - low == 1 else int(min(common[low + 1:high].min(), lengths[low]))
            node = len(self.segments)
            if parent >= 0:
                self.children[parent].append(node)
            self.segments.append(self.ranks[low][depth:end])
            self.low.append(low)
            self.high.append(high)
            self.children.append([])
            self.rest.append(int(lengths[low:high].max()) - end)
            self.least.append(int(self.sizes[low:high].min()))
            self.most.append(int(self.sizes[low:high].max()))
            stop = low
            while stop < high and lengths[stop] == end:
                stop += 1
            self.ends.append(stop)  # sets low..stop end here
            cuts = [stop, *(k for k in (np.flatnonzero(common[stop + 1:high] == end) + stop + 1).tolist()), high]
            waiting += [(a, b, end, node) for a, b in zip(cuts, cuts[1:], strict=False) if a < b]

    def walk(self, mine: np.ndarray, size: int, universe: int, percent: int, skip):
        """Sets whose overlap with ``mine`` is large enough; ``skip(low, high)`` leaves a subtree out."""
        mark = np.zeros(universe + 1, bool)
        mark[mine] = True
        least, most = -(-percent * size // 100), size * 100 // percent
        waiting = [(0, 0)]
        while waiting:
            node, overlap = waiting.pop()
            if self.most[node] < least or self.least[node] > most or skip(self.low[node], self.high[node]):
                continue
            segment = self.segments[node]
            if len(segment):
                overlap += int(np.count_nonzero(mark[segment]))
                left = len(mine) - int(np.searchsorted(mine, segment[-1], "right"))
            else:
                left = len(mine)
            # overlap * 100 >= percent * (size + other - overlap), for the smallest other that fits
            other = max(self.least[node], least)
            need = -(-percent * (size + other) // (100 + percent))
            if overlap + min(self.rest[node], left) < need:
                continue
            for k in range(self.low[node], self.ends[node]):
                if 100 * overlap >= percent * (size + int(self.sizes[k]) - overlap):
                    yield k
            waiting += [(child, overlap) for child in self.children[node]]


def block_links(sets: list[np.ndarray], sizes: np.ndarray, left: np.ndarray | None, percent: int, all_links: bool, known: np.ndarray | None = None):
    """Pairs of linked sets of one block; with ``left``, pairs of a set there and one that isn't. ``known``: the sets' components so far."""
    every = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
    values, inverse, counts = np.unique(every, return_inverse=True, return_counts=True)
    # Shingles of one set only can't overlap; the others are ranked by falling count, so that paths are shared.
    rank = np.empty(len(values), np.int64)
    rank[np.lexsort((values, -counts))] = np.arange(len(values))
    ends = np.cumsum([len(s) for s in sets])
    ranks = []
    for a, b in zip(np.append(0, ends[:-1]), ends, strict=True):
        at = inverse[a:b]
        ranks.append(np.sort(rank[at[counts[at] > 1]]))
    group = np.arange(len(sets)) if known is None else known.copy()

    def join(a: int, b: int) -> None:
        group[group == group[a]] = group[b]

    into = np.arange(len(sets)) if left is None else np.flatnonzero(~left)
    if not len(into):
        return
    tree = PrefixTree([ranks[k] for k in into], sizes[into])
    members = into[tree.order]
    place = np.full(len(sets), -1)
    place[members] = np.arange(len(members))
    queries = members if left is None else np.flatnonzero(left)
    for q in queries.tolist():
        after = place[q]  # sets before it have met it already; -1 on the other side

        def skip(low: int, high: int, q=q, after=after) -> bool:
            return high <= after + 1 or (not all_links and bool((group[members[low:high]] == group[q]).all()))

        for k in tree.walk(ranks[q], int(sizes[q]), len(values), percent, skip):
            other = int(members[k])
            if k > after and (all_links or group[other] != group[q]):
                join(other, q)
                yield q, other


def _block(percent: int, all_links: bool):
    def run(block: pa.Table) -> pa.Table:
        keys = block.column("key").to_pylist()
        sets = [np.frombuffer(x, "<u8") for x in block.column("shingles").to_pylist()]
        sizes = block.column("n_shingles").to_numpy().astype(np.int64)
        label, a, b = (block.column(c)[0].as_py() for c in ("label", "a", "b"))
        side = None
        if a != b:
            side = np.array([x == a for x in block.column("piece").to_pylist()])
        numbers: dict[bytes, int] = {}
        known = np.array([numbers.setdefault(x, len(numbers)) for x in block.column("component").to_pylist()])
        pairs = list(block_links(sets, sizes, side, percent, all_links, known))
        return pa.table({
            "label": pa.array([label] * len(pairs), pa.int64()),
            "u": pa.array([keys[a] for a, _ in pairs], pa.binary()),
            "v": pa.array([keys[b] for _, b in pairs], pa.binary()),
        })

    return run


# ---- results -----------------------------------------------------------------------------------


def document_classes(docs: DataFrame, width: int = WORDS, row: Column | None = None) -> DataFrame:
    """doc_id, n_shingles, key, the class of equal sets (null for an empty set), and ``row``, what the caller knows the row by, for each row."""
    named = with_types(docs.withColumn("_row", F.lit(0) if row is None else row), doc_id="long", text="string", _row="long")
    classed = named.withColumnRenamed("_row", "row").mapInArrow(lean(_classed(width)), "doc_id long, n_shingles long, key binary, row long")
    return staged(classed, "classes")


def class_table(classed: DataFrame) -> DataFrame:
    """One row per class: key, n_shingles, its smallest doc_id, copies, and short, 8 bytes of the key."""
    groups = classed.where("key is not null").groupBy("key", "n_shingles").agg(F.min("doc_id").alias("doc_id"), F.count("*").alias("copies"))
    return groups.withColumn("short", F.conv(F.hex(F.substring("key", 1, 8)), 16, -10).cast("long"))


def links(docs: DataFrame, classes: DataFrame, width: int = WORDS, percent: int = PERCENT, all_links: bool = False, most: int = BLOCK_SETS) -> DataFrame:
    """Linked classes (u, v): a spanning part of the links, or all of them."""
    rows = with_types(docs, doc_id="long", text="string")
    chosen = staged(survivors(rows, classes, width, percent), "survivors")
    sets = staged(survivor_sets(rows, chosen, width), "sets")
    named = named_sets(sets, percent)
    parts = sized(named, most)
    found = staged(compared(sets, *first_round(named, parts, all_links), percent, all_links), "first-links")
    cut = parts.where("cut")
    if all_links or cut.isEmpty():
        return found.select("u", "v")
    near = staged(components(found.join(cut.select("label").distinct(), "label", "left_semi").select("u", "v")), "first-components")
    rest = compared(sets, *second_round(named, parts, near, most), percent, all_links)
    return found.select("u", "v").union(rest.select("u", "v"))


def linked_classes(docs: DataFrame, classes: DataFrame, width: int, percent: int, most: int) -> DataFrame:
    """key, doc_id, copies and root, the class that stands for its component, of each class."""
    found = staged(components(links(docs, classes, width, percent, most=most)), "components")
    joined = classes.join(found, classes["key"] == found["node"], "left")
    return joined.select("key", "doc_id", "copies", F.coalesce("root", "key").alias("root"))


def near_groups(docs: DataFrame, width: int = WORDS, percent: int = PERCENT, most: int = BLOCK_SETS) -> DataFrame:
    """doc_id, n_shingles and component_id, the smallest doc_id reachable by links, for each row."""
    classed = document_classes(docs, width)
    classes = staged(class_table(classed), "class-table")
    linked = linked_classes(docs, classes, width, percent, most)
    smallest = linked.groupBy("root").agg(F.min("doc_id").alias("component_id"), F.count("*").alias("together"))
    # Classes of one document that link with nothing keep their own id and needn't be joined.
    named = linked.join(smallest.where("together > 1"), "root", "left").where("together is not null or copies > 1")
    named = staged(named.select("key", F.coalesce("component_id", "doc_id").alias("component_id")), "named")
    return classed.join(named, "key", "left").select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))


def _whole_row(docs: DataFrame) -> Column:
    """A hash of all columns; a null differs from any value."""
    columns = [F.col(f"`{c}`") for c, kind in docs.dtypes if not kind.startswith("map")]
    return F.xxhash64(*columns, *(c.isNull() for c in columns))


def one_of_each(docs: DataFrame, width: int = WORDS, percent: int = PERCENT, most: int = BLOCK_SETS) -> DataFrame:
    """The rows of ``docs``, of each component one: the row with the smallest id, and of its rows that with the smallest hash.

    Rows are told apart by a hash of all their columns: of two texts with one id, only the near copy goes. Rows
    without an id come after all others of their component. Rows without words are copies of nothing.
    Rows that are alike in every column count once.
    """
    row = _whole_row(docs)
    classed = document_classes(docs, width, row).withColumn("doc_id", F.coalesce("doc_id", F.lit(NO_ID)))
    classes = staged(class_table(classed), "class-table")
    linked = linked_classes(docs, classes, width, percent, most)
    together = linked.groupBy("root").agg(F.sum("copies").alias("rows")).where("rows > 1")
    groups = staged(linked.join(together, "root").select("key", "root"), "near-groups")
    members = staged(classed.join(groups, "key").select("root", "doc_id", "row"), "near-members")
    # Written, so that the join with it can be split at a large group.
    first = staged(members.groupBy("root").agg(F.min(F.struct("doc_id", "row")).alias("first")), "near-first")
    others = members.join(first, "root").where(F.struct("doc_id", "row") != F.col("first"))
    gone = staged(others.select(F.col("row").alias("_gone")).distinct(), "near-copies")
    kept = docs.withColumn("_near_row", row).join(gone, F.col("_near_row") == F.col("_gone"), "left_anti")
    if not classed.groupBy("row").count().where("count > 1").isEmpty():
        kept = kept.dropDuplicates(["_near_row"])
    return kept.drop("_near_row")

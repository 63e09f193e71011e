"""Toxicity by a convolutional text classifier over hashed word embeddings.

A word is the sum of three hashed embeddings: of the word, and of its first
four and first five bytes, so inflected forms share what their stem has
learnt. Filters over one, two and three successive words are pooled by their
maximum over the whole text, which lets a single phrase in a long text count.
The first embedding dimension starts from how much more often a bucket occurs in
toxic texts; everything else starts at random.

Every labelled row and whole text is learnt from. The rows are divided into
parts of a bounded number of rows. In each round every part trains the network
in numpy from the same parameters, and these move by the parts' mean change of
each parameter; the driver sees one vector of the network's size.

Thresholds are calibrated by language on a quarter of the labelled rows that training
doesn't see, all of them, by their counts in narrow bins of the logit. The language is
guessed from the words of the text alone, by
bucket frequencies; a language with too few toxic rows there uses the
threshold over all rows. Scores are shifted so that 0.7 is the threshold.

Words are runs of letters, A-Z lower-cased. Defined results: a null or empty
text is scored like one without toxic words; without labels of both kinds to
learn from, every score is 0. Repeated rows are scored alike.
"""

from __future__ import annotations

import pickle
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from atelier.llm.bitmap import BitMap, bits_for, collect_bits
from atelier.llm.staging import schema, staged
from atelier.llm.textbytes import IS_LETTER, LOWER, ByteHash, spans_of, text_slices

BUCKETS = 1 << 16
DIMENSIONS = 8
WIDTHS = (1, 2, 3)
FILTERS = 8
STEMS = (4, 5)
#: About so many labelled rows make a part, which one task trains on.
PART_ROWS = 8000
#: Passes over the rows: as many as make so many texts, within bounds.
TEXTS_SEEN, LEAST_EPOCHS, MOST_EPOCHS = 16_000, 3, 12
BATCH = 16
#: Words whose filter values are held at once in training; bins of a unit of the logit in calibration.
PIECE, BINS = 1 << 15, 100
#: Least toxic rows of a language for a threshold of its own, and the score that the threshold gets.
LEAST_TOXIC = 15
THRESHOLD = 0.7
MAX_LANGUAGES = 64
SLICE = 1 << 18
_HASH = ByteHash(501, LOWER)
_POOLED = FILTERS * len(WIDTHS)
#: What training changes, as parts of one vector: parameters and Adagrad's sums; the vector's slices are averaged apart.
SHAPES = {
    "embeddings": (BUCKETS, DIMENSIONS), "word_sums": (BUCKETS,),
    "filters": (sum(WIDTHS), DIMENSIONS, FILTERS), "offsets": (_POOLED,), "weights": (_POOLED,), "bias": (1,),
    "filter_sums": (sum(WIDTHS), DIMENSIONS, FILTERS), "offset_sums": (_POOLED,), "weight_sums": (_POOLED,), "bias_sum": (1,),
}
SLICES = 16


def word_buckets(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each word the buckets of the word and its stems, and where each text's words begin."""
    starts, ends, first = spans_of(IS_LETTER[data], offsets)
    stops = [ends, *(np.minimum(starts + n, ends) for n in STEMS)]
    hashes = _HASH.spans(data, np.tile(starts, len(stops)), np.concatenate(stops)).reshape(len(stops), -1)
    # The kind of part is mixed in, so a short word and its own stem have buckets of their own.
    kinds = np.arange(len(stops), dtype=np.uint64)[:, None]
    return ((hashes + kinds * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(48)).astype(np.int32).T, first


@dataclass
class TextNetwork:
    embeddings: np.ndarray
    filters: np.ndarray  # (position and width in order, dimension, filter)
    offsets: np.ndarray
    weights: np.ndarray
    bias: float | np.ndarray
    languages: list[str]
    language_odds: np.ndarray
    thresholds: np.ndarray

    def responses(self, buckets: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Filter values at every word; words beyond the text's end count as zeros."""
        words = self.embeddings[buckets].sum(axis=1)
        parts = np.einsum("nd,kdf->knf", words, self.filters, optimize=True)
        end = np.repeat(first[1:], np.diff(first))
        out, k = [], 0
        for width in WIDTHS:
            total = parts[k].copy()
            for shift in range(1, width):
                inside = np.arange(len(words) - shift) + shift < end[:len(words) - shift] if len(words) > shift else np.zeros(0, bool)
                total[:len(inside)][inside] += parts[k + shift][shift:][inside]
            out.append(total)
            k += width
        return np.concatenate(out, axis=1)

    def pooled(self, buckets: np.ndarray, first: np.ndarray) -> np.ndarray:
        out = np.zeros((len(first) - 1, FILTERS * len(WIDTHS)), np.float32)
        some = np.flatnonzero(np.diff(first))
        if len(some):
            out[some] = np.maximum(np.maximum.reduceat(self.responses(buckets, first), first[some], axis=0) + self.offsets, 0)
        return out

    def logits(self, buckets: np.ndarray, first: np.ndarray) -> np.ndarray:
        return self.pooled(buckets, first) @ self.weights + self.bias

    def language(self, buckets: np.ndarray, first: np.ndarray) -> np.ndarray:
        """The likeliest language of each text by its whole words."""
        out = np.zeros(len(first) - 1, np.int64)
        some = np.flatnonzero(np.diff(first))
        if len(some) and len(self.languages):
            out[some] = np.add.reduceat(self.language_odds[buckets[:, 0]], first[some], axis=0).argmax(axis=1)
        return out

    def scores(self, buckets: np.ndarray, first: np.ndarray) -> np.ndarray:
        over = self.logits(buckets, first) - self.thresholds[self.language(buckets, first)]
        return 1 / (1 + np.exp(-np.clip(over + np.log(THRESHOLD / (1 - THRESHOLD)), -30, 30)))


@dataclass
class Texts:
    """Word buckets of some texts, one after another."""

    buckets: np.ndarray
    first: np.ndarray

    def pick(self, rows: np.ndarray) -> Texts:
        parts = [self.buckets[self.first[r]:self.first[r + 1]] for r in rows]
        return Texts(np.concatenate(parts) if parts else self.buckets[:0], np.cumsum([0, *map(len, parts)]))


def views(flat: np.ndarray) -> dict[str, np.ndarray]:
    """The parameters and Adagrad's sums as parts of the one vector that tasks and driver exchange."""
    out, at = {}, 0
    for name, shape in SHAPES.items():
        size = int(np.prod(shape))
        out[name] = flat[at:at + size].reshape(shape)
        at += size
    return out


def network(flat: np.ndarray, languages: list[str] | None = None, odds: np.ndarray | None = None) -> TextNetwork:
    """The network over these parameters, all thresholds 0."""
    p, languages = views(flat), languages or []
    odds = np.zeros((BUCKETS, 1), np.float32) if odds is None else odds
    return TextNetwork(p["embeddings"], p["filters"], p["offsets"], p["weights"], p["bias"], languages, odds, np.zeros(max(len(languages), 1)))


def start(seen: np.ndarray, n_clean: int, n_toxic: int, seed: int = 5) -> np.ndarray:
    """Random filters; the first dimension of a bucket is how strongly toxic texts prefer it.

    ``seen`` counts the clean and the toxic texts that have a bucket.
    """
    rng = np.random.default_rng(seed)
    share = seen.sum(axis=0) / (n_clean + n_toxic)
    spread = np.sqrt(share * (1 - share) * (1 / n_clean + 1 / n_toxic) + 1e-6) + 1e-3
    preference = (seen[1] / n_toxic - seen[0] / n_clean) / spread
    flat = np.full(sum(int(np.prod(shape)) for shape in SHAPES.values()), 1e-2, np.float32)
    p = views(flat)
    p["embeddings"][:] = rng.normal(0, 0.02, (BUCKETS, DIMENSIONS))
    p["embeddings"][:, 0] = np.tanh(preference / 6)
    p["filters"][:] = rng.normal(0, 0.3, (sum(WIDTHS), DIMENSIONS, FILTERS))
    p["filters"][:, 0, :] = np.abs(p["filters"][:, 0, :]) + 0.2
    p["offsets"][:], p["weights"][:], p["bias"][:] = -0.2, 0.1, -1.0
    return flat


def peaks(net: TextNetwork, texts: Texts) -> tuple[np.ndarray, np.ndarray]:
    """Each filter's largest value in every text and the word it is at, by pieces of the words."""
    n, size = len(texts.first) - 1, np.diff(texts.first)
    best = np.where(size[:, None] > 0, -np.inf, -net.offsets).astype(np.float32)
    at = np.zeros(best.shape, np.int64)
    for low in range(0, len(texts.buckets), PIECE):
        words = texts.buckets[low:low + PIECE + max(WIDTHS) - 1]
        values = net.responses(words, np.clip(texts.first - low, 0, len(words)))
        here = np.clip(texts.first - low, 0, PIECE)
        for r in np.flatnonzero(np.diff(here)):
            part = values[here[r]:here[r + 1]]
            top = part.max(axis=0)
            more = top > best[r]
            at[r] = np.where(more, part.argmax(axis=0) + here[r] + low, at[r])
            best[r] = np.where(more, top, best[r])
    return best, at


def step(p: dict[str, np.ndarray], net: TextNetwork, batch: Texts, toxic: np.ndarray, balance: np.ndarray, rate: float) -> None:
    """One step of Adagrad on the log loss; the gradient of a maximum flows to the words of its window only."""
    starts = np.cumsum([0, *WIDTHS])
    size = np.diff(batch.first)
    best, at = peaks(net, batch)
    active = np.maximum(best + net.offsets, 0)
    odds = 1 / (1 + np.exp(-np.clip(active @ net.weights + net.bias, -30, 30)))
    delta = ((odds - toxic) * balance[toxic] / len(toxic)).astype(np.float32)
    grads = [np.zeros_like(net.filters), None, active.T @ delta]
    back = delta[:, None] * net.weights * (best + net.offsets > 0) * (size > 0)[:, None]
    grads[1] = back.sum(axis=0)
    for w, width in enumerate(WIDTHS):
        columns = slice(w * FILTERS, (w + 1) * FILTERS)
        for shift in range(width):
            k = starts[w] + shift
            r, f = np.nonzero(back[:, columns])
            where = at[:, columns][r, f] + shift
            inside = where < batch.first[r + 1]
            r, f, where = r[inside], f[inside], where[inside]
            push = back[:, columns][r, f][:, None]
            buckets = batch.buckets[where]
            np.add.at(grads[0][k].T, f, push * net.embeddings[buckets].sum(axis=1))
            change = push * net.filters[k][:, f].T
            for part in range(buckets.shape[1]):
                np.add.at(p["word_sums"], buckets[:, part], (change ** 2).mean(axis=1))
                move = rate * change / np.sqrt(p["word_sums"][buckets[:, part]])[:, None]
                np.add.at(net.embeddings, buckets[:, part], -move.astype(np.float32))
    for name, g in zip(("filter", "offset", "weight"), grads, strict=True):
        p[f"{name}_sums"] += g * g
        p[f"{name}s"] -= (rate * g / np.sqrt(p[f"{name}_sums"])).astype(np.float32)
    p["bias_sum"] += delta.sum() ** 2
    p["bias"] -= rate * delta.sum() / np.sqrt(p["bias_sum"])


_CHANGE = "slice int, part int, change binary"


def _trained(blob: bytes, rate: float, seed: int):
    """Every part trains the network on all its rows, in their order, and gives what it changed."""

    def changed(part: int, change: np.ndarray):
        parts = [c.astype(np.float32).tobytes() for c in np.array_split(change, SLICES)]
        yield pa.RecordBatch.from_pydict(
            {"slice": pa.array(range(SLICES), pa.int32()), "part": pa.array([part] * SLICES, pa.int32()), "change": pa.array(parts, pa.binary())}
        )

    def run(batches):
        flat, balance = pickle.loads(blob)
        part = None
        for batch in batches:
            parts = batch.column("part").to_numpy()
            cuts = [0, *(np.flatnonzero(np.diff(parts)) + 1), len(parts)] if len(parts) else []
            for low, high in zip(cuts, cuts[1:]):
                if part != int(parts[low]):
                    if part is not None:
                        yield from changed(part, now - flat)
                    part, now = int(parts[low]), flat.copy()
                    p, net, rng = views(now), network(now), np.random.default_rng([seed, part])
                rows = batch.slice(low, high - low)
                toxic = rows.column("toxic").to_numpy()
                for first, end, data, offsets in text_slices(rows.column("text"), SLICE):
                    texts, marks = Texts(*word_buckets(data, offsets)), toxic[first:end]
                    for some in np.array_split(rng.permutation(end - first), -(-(end - first) // BATCH)):
                        step(p, net, texts.pick(some), marks[some], balance, rate)
        if part is not None:
            yield from changed(part, now - flat)

    return run


def _averaged(batches):
    """The mean change of each parameter over the parts that changed it, for each slice of the vector."""
    at, total, count = None, None, None

    def mean():
        return pa.RecordBatch.from_pydict(
            {"slice": pa.array([at], pa.int32()), "part": pa.array([-1], pa.int32()), "change": pa.array([(total / np.maximum(count, 1)).tobytes()], pa.binary())}
        )

    for batch in batches:
        for k, change in zip(batch.column("slice").to_pylist(), batch.column("change")):
            change = np.frombuffer(change.as_buffer(), np.float32)
            if k != at:
                if at is not None:
                    yield mean()
                at, total, count = k, np.zeros(len(change)), np.zeros(len(change), np.int64)
            total += change
            count += change != 0
    if at is not None:
        yield mean()


def train(rows: DataFrame, flat: np.ndarray, n_clean: int, n_toxic: int) -> np.ndarray:
    """Rounds over all rows: the parts train side by side from the same network, which then moves by their mean change."""
    n = n_clean + n_toxic
    balance = np.array([n / (2 * n_clean), n / (2 * n_toxic)])
    for epoch in range(min(MOST_EPOCHS, max(LEAST_EPOCHS, TEXTS_SEEN // n))):
        changes = rows.select("part", "toxic", "text").mapInArrow(_trained(pickle.dumps((flat, balance)), 0.05 / (1 + epoch), epoch), _CHANGE)
        # Sorted, so that the sums don't depend on the order of arrival.
        means = changes.repartition(SLICES, "slice").sortWithinPartitions("slice", "part", "change").mapInArrow(_averaged, _CHANGE)
        # The size of one network, whatever the number of parts.
        moved = sorted((r["slice"], bytes(r["change"])) for r in means.collect())
        flat = (flat + np.concatenate([np.frombuffer(c) for _, c in moved])).astype(np.float32)
    return flat


def best_threshold(values: np.ndarray, clean: np.ndarray, toxic: np.ndarray) -> float:
    """The cut with the largest F1, in the middle between the two values it separates; so many clean and toxic texts have each value."""
    order = np.argsort(-values, kind="stable")
    hits, taken = np.cumsum(toxic[order]), np.cumsum((clean + toxic)[order])
    k = int((2 * hits / (taken + max(toxic.sum(), 1))).argmax())
    lower = values[order[k + 1]] if k + 1 < len(order) else values[order[k]] - 1
    return float((values[order[k]] + lower) / 2)


def _binned(blob: bytes):
    """The language and the logit's bin of every text."""

    def run(batches):
        net: TextNetwork = pickle.loads(blob)
        for batch in batches:
            for first, end, data, offsets in text_slices(batch.column("text"), SLICE):
                texts = Texts(*word_buckets(data, offsets))
                bins = np.round(np.clip(net.logits(texts.buckets, texts.first), -30, 30) * BINS).astype(np.int32)
                language = net.language(texts.buckets, texts.first).astype(np.int32)
                yield pa.RecordBatch.from_arrays([pa.array(language), batch.column("toxic").slice(first, end - first), pa.array(bins)], ["language", "toxic", "bin"])

    return run


def calibrate(net: TextNetwork, rows: DataFrame) -> None:
    """A threshold for each language that has enough toxic rows, else the common one."""
    found = rows.select("toxic", "text").mapInArrow(_binned(pickle.dumps(net)), schema(language="int", toxic="int", bin="int"))
    # At most a number for each language, label and bin.
    counts = found.groupBy("language", "toxic", "bin").agg(F.count("*").alias("n")).toPandas()
    if set(counts["toxic"]) != {0, 1}:
        return

    def cut(some) -> float:
        table = some.pivot_table(index="bin", columns="toxic", values="n", aggfunc="sum", fill_value=0)
        return best_threshold(table.index.to_numpy() / BINS, table[0].to_numpy(), table[1].to_numpy())

    net.thresholds = np.full(len(net.thresholds), cut(counts))
    for k in range(len(net.languages)):
        some = counts[counts["language"] == k]
        if min(some.loc[some["toxic"] == t, "n"].sum() for t in (0, 1)) >= LEAST_TOXIC:
            net.thresholds[k] = cut(some)


def _counted(languages: list[str]):
    """For each label the texts that have a bucket, for each of the languages the words in it."""

    def run(batches):
        labels, words = np.zeros((2, BUCKETS), np.int64), np.zeros((len(languages), BUCKETS), np.int64)
        place = {name: k for k, name in enumerate(languages)}
        for batch in batches:
            toxic, names = batch.column("toxic").to_pylist(), batch.column("lang").to_pylist()
            for first, end, data, offsets in text_slices(batch.column("text"), SLICE):
                texts = Texts(*word_buckets(data, offsets))
                for r in range(end - first):
                    buckets = texts.buckets[texts.first[r]:texts.first[r + 1]]
                    labels[toxic[first + r], np.unique(buckets)] += 1
                    if names[first + r] in place:
                        words[place[names[first + r]]] += np.bincount(buckets[:, 0], minlength=BUCKETS)
        for kind, counts in [*enumerate(labels), *((2 + k, c) for k, c in enumerate(words))]:
            some = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(some), kind, np.int32)), pa.array(some.astype(np.int32)), pa.array(counts[some])], ["kind", "bucket", "n"]
            )

    return run


def bucket_counts(rows: DataFrame, languages: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """``_counted`` over all rows: (label, bucket) and (bucket, language)."""
    found = rows.select("toxic", "lang", "text").mapInArrow(_counted(languages), schema(kind="int", bucket="int", n="long"))
    # At most a number for each bucket of the labels and languages.
    sums = found.groupBy("kind", "bucket").agg(F.sum("n").alias("n")).toPandas()
    counts = np.zeros((2 + max(len(languages), 1), BUCKETS))
    counts[sums["kind"].to_numpy(np.int64), sums["bucket"].to_numpy(np.int64)] = sums["n"].to_numpy(np.float64)
    return counts[:2], counts[2:].T


def _held(table: bytes):
    """Rows whose key the bit map holds."""

    def run(batches):
        bits = BitMap(table)
        for batch in batches:
            yield batch.filter(pa.array(bits.holds(batch.column("key").to_numpy().view(np.uint64))))

    return run


def labelled_rows(docs: DataFrame, labels: DataFrame, excluded) -> DataFrame:
    """The texts to learn from with toxic, lang, draw (0 for a quarter of the ids) and part, written once; rows of a part are together, in one order."""
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
    known = known.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & ~excluded).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    n_known = known.count()
    n_parts = max(1, -(-n_known // PART_ROWS))
    key = F.xxhash64("doc_id").alias("key")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
    texts = texts.where(F.col("text").isNotNull() & ~excluded).select("doc_id", "text", "lang", key)
    # Of the texts without a label few are shuffled: the map's size is bounded, and the join is exact.
    bits = collect_bits(known.select(key), "key", bits_for(n_known))
    texts = texts.mapInArrow(_held(bits), texts.schema).drop("key").repartition(n_parts, "doc_id")
    rows = texts.join(known.repartition(n_parts, "doc_id"), "doc_id")
    draw = F.pmod(F.xxhash64("doc_id", F.lit("calibration")), F.lit(4)).cast("int")
    part = F.pmod(F.hash("doc_id"), F.lit(n_parts))  # as repartition divides them
    rows = rows.select("doc_id", "text", "toxic", "lang", draw.alias("draw"), part.alias("part"))
    rows = rows.sortWithinPartitions("part", F.xxhash64("doc_id", F.lit("order")), "doc_id", "text", "lang")
    return staged(rows, "toxicity")


def learn(docs: DataFrame, labels: DataFrame, excluded) -> TextNetwork | None:
    """The network for all labelled rows whose id ``excluded`` (a condition on doc_id) doesn't hold for; None without both labels.

    An id with both labels counts as toxic. Where an id has several texts, all of them are learnt from, in one order.
    """
    rows = labelled_rows(docs, labels, excluded)
    fit = rows.where("draw != 0")
    counts = {r["toxic"]: r["count"] for r in fit.groupBy("toxic").count().collect()}
    if len(counts) < 2:
        return None
    by_rows = fit.where(F.col("lang").isNotNull()).groupBy("lang").count().orderBy(F.desc("count"), "lang")
    languages = sorted(r["lang"] for r in by_rows.limit(MAX_LANGUAGES).collect())
    seen, words = bucket_counts(fit, languages)
    flat = train(fit, start(seen, counts[0], counts[1]), counts[0], counts[1])
    odds = np.log((words + 0.1) / (words + 0.1).sum(axis=0)).astype(np.float32)
    net = network(flat, languages, odds)
    calibrate(net, rows.where("draw = 0"))
    return net


def _scored(blob: bytes):
    def run(batches):
        net: TextNetwork = pickle.loads(blob)
        for batch in batches:
            scores = [net.scores(*word_buckets(data, offsets)) for _, _, data, offsets in text_slices(batch.column("text"), SLICE)]
            out = np.concatenate(scores) if scores else np.zeros(0)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(out, pa.float64())], ["doc_id", "score"])

    return run


def score(docs: DataFrame, model: TextNetwork | None) -> DataFrame:
    """doc_id, score and predicted (1 from ``THRESHOLD`` on) for every whole text."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    if model is None:
        scored = rows.select("doc_id", F.lit(0.0).alias("score"))
    else:
        scored = rows.mapInArrow(_scored(pickle.dumps(model)), schema(doc_id="long", score="double"))
    return scored.select("doc_id", "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))

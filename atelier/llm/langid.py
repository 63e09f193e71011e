"""Language ID by a byte convolutional network.

The network reads fixed windows of bytes (one-hot). Filters of several widths
slide over a window, ReLU and the maximum over positions give one number per
filter, and a linear layer with softmax gives the languages. It is trained in
numpy on a bounded sample of labelled texts. A whole text is cut into windows
that overlap by the widest filter less one byte, so no filter position is
missed; the mean of the windows' scores, weighted by their bytes, decides.

A one-hot convolution is a sum of table rows, one per filter position. For
prediction the rows of two successive bytes are added beforehand, so a filter
of width w costs w/2 look-ups.

Defined results: a text that is null, empty or without a letter gets ``und``
and score 0. So does every text when no row has a label to learn from.
Repeated rows are predicted alike, and extra columns are ignored.
"""

from __future__ import annotations

import pickle
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from atelier.llm.staging import schema
from atelier.llm.textbytes import text_slices
from atelier.llm.workers import lean

UNDETERMINED = "und"
WINDOW = 128
WIDTHS = (2, 3, 4)
FILTERS = 16
#: Bounds of the training sample: languages (the most frequent), texts of each, windows of each text.
MAX_LANGUAGES = 256
TEXTS_PER_LANGUAGE = 800
WINDOWS_PER_TEXT = 4
STEPS = 900
BATCH = 96
#: Windows scored at once; their look-ups fit a core's cache.
BLOCK = 64


@dataclass
class ByteNetwork:
    """Filter tables (position, byte, filter) by width, their offsets, and the output layer."""

    languages: list[str]
    filters: dict[int, np.ndarray]
    offsets: dict[int, np.ndarray]
    weights: np.ndarray
    bias: np.ndarray

    def pairs(self) -> dict[int, list[np.ndarray]]:
        """By width, look-up tables over two successive bytes (one byte, if the width is odd, at the end)."""
        out = {}
        for w, table in self.filters.items():
            out[w] = [(table[k][:, None, :] + table[k + 1][None, :, :]).reshape(1 << 16, -1) for k in range(0, w - 1, 2)]
            if w % 2:
                out[w].append(table[w - 1])
            out[w] = [np.ascontiguousarray(t, np.float32) for t in out[w]]
        return out

    def pooled(self, windows: np.ndarray, pairs: dict[int, list[np.ndarray]]) -> np.ndarray:
        """The maximum of each filter over each window (ReLU included).

        Positions come first in memory, so the maximum runs over whole rows.
        """
        one = np.ascontiguousarray(windows.T).astype(np.intp)
        two = one[:-1] * 256 + one[1:]
        columns = []
        for w in self.filters:
            n = windows.shape[1] - w + 1
            total = None
            for k, rows in enumerate(pairs[w]):
                at = (two if len(rows) > 256 else one)[2 * k:2 * k + n]
                part = rows.take(at.ravel(), axis=0, mode="clip")
                total = part if total is None else np.add(total, part, out=total)
            best = total.reshape(n, -1).max(axis=0).reshape(len(windows), -1)
            columns.append(np.maximum(best + self.offsets[w], 0))
        return np.concatenate(columns, axis=1)

    def logits(self, windows: np.ndarray, pairs: dict[int, list[np.ndarray]]) -> np.ndarray:
        return self.pooled(windows, pairs) @ self.weights + self.bias


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def cut_windows(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of each window, and the first window of each text."""
    stride = WINDOW - (max(WIDTHS) - 1)
    sizes = np.diff(offsets)
    counts = np.maximum(1, -(-(sizes - (WINDOW - stride)) // stride))
    first = np.concatenate([[0], np.cumsum(counts)])
    text = np.repeat(np.arange(len(sizes)), counts)
    starts = offsets[text] + (np.arange(first[-1]) - first[text]) * stride
    return starts, np.minimum(starts + WINDOW, offsets[text + 1]), first


def window_bytes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Windows as rows of bytes; what lies beyond a text's end is 0."""
    at = starts[:, None] + np.arange(WINDOW)
    inside = at < ends[:, None]
    return np.where(inside, data[np.minimum(at, max(len(data) - 1, 0))], 0) if len(data) else np.zeros(at.shape, np.uint8)


def train(windows: np.ndarray, labels: np.ndarray, languages: list[str], seed: int = 7) -> ByteNetwork:
    """Adam on the cross-entropy; the gradient of a maximum flows to its position only."""
    rng = np.random.default_rng(seed)
    net = ByteNetwork(
        languages,
        {w: rng.normal(0, 0.3, (w, 256, FILTERS)).astype(np.float32) for w in WIDTHS},
        {w: np.zeros(FILTERS, np.float32) for w in WIDTHS},
        rng.normal(0, 0.2, (FILTERS * len(WIDTHS), len(languages))).astype(np.float32),
        np.zeros(len(languages), np.float32),
    )
    params = [*net.filters.values(), *net.offsets.values(), net.weights, net.bias]
    moments = [(np.zeros_like(p), np.zeros_like(p)) for p in params]
    by_class = [np.flatnonzero(labels == c) for c in range(len(languages))]
    for step in range(1, STEPS + 1):
        classes = rng.integers(0, len(languages), BATCH)  # every language as often
        rows = np.array([by_class[c][rng.integers(len(by_class[c]))] for c in classes])
        batch, wanted = windows[rows].astype(np.intp), classes
        pooled, where, grads = [], [], [np.zeros_like(p) for p in params]
        for k, w in enumerate(WIDTHS):
            n = WINDOW - w + 1
            total = sum(net.filters[w][j][batch[:, j:j + n]] for j in range(w))
            at = total.argmax(axis=1)
            pooled.append(np.take_along_axis(total, at[:, None, :], 1)[:, 0] + net.offsets[w])
            where.append(at)
        raw = np.concatenate(pooled, axis=1)
        active = np.maximum(raw, 0)
        delta = softmax(active @ net.weights + net.bias)
        delta[np.arange(BATCH), wanted] -= 1
        delta /= BATCH
        grads[-2], grads[-1] = active.T @ delta, delta.sum(axis=0)
        back = (delta @ net.weights.T) * (raw > 0)
        for k, w in enumerate(WIDTHS):
            part = back[:, k * FILTERS:(k + 1) * FILTERS]
            grads[len(WIDTHS) + k] = part.sum(axis=0)
            for j in range(w):
                at = np.take_along_axis(batch, where[k] + j, axis=1)
                np.add.at(grads[k][j], (at, np.arange(FILTERS)[None, :]), part)
        rate = 0.02 * (1 - step / (STEPS + 1)) + 0.0005
        for p, g, (m, v) in zip(params, grads, moments, strict=True):
            m += 0.1 * (g - m)
            v += 0.001 * (g * g - v)
            p -= (rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)).astype(np.float32)
    return net


def training_sample(labelled: DataFrame, text: str, label: str, row_id: str) -> list[tuple[str, str]]:
    """At most about ``TEXTS_PER_LANGUAGE`` texts of each language, as short passages: (language, passage).

    Rows are chosen by a hash of their id, the same ones in every run.
    """
    counts = labelled.groupBy(label).count().orderBy(F.desc("count"), label).limit(MAX_LANGUAGES).collect()
    if not counts:
        return []
    steps = 1 << 40
    share = {r[0]: min(steps, TEXTS_PER_LANGUAGE * steps // r[1]) for r in counts}
    bound = F.coalesce(*[F.when(F.col(label) == k, F.lit(v)) for k, v in share.items()])
    chosen = labelled.where(F.pmod(F.xxhash64(row_id, F.lit("language")), F.lit(steps)) < bound)
    spread = F.greatest(F.lit(1), F.length(text) - WINDOW)
    passages = F.array(*[
        F.substring(text, (F.pmod(F.xxhash64(row_id, F.lit(k)), spread) + 1).cast("int"), F.lit(WINDOW))
        for k in range(WINDOWS_PER_TEXT)
    ])
    rows = chosen.select(label, F.explode(passages).alias("passage")).collect()
    return [(r[0], r[1]) for r in rows]


def learn(labelled: DataFrame, text: str = "text", label: str = "lang", row_id: str = "doc_id") -> ByteNetwork | None:
    """The network for these labelled rows, or None if none has a label and a text."""
    known = labelled.where(F.col(label).isNotNull() & (F.length(text) > 0))
    sample = sorted(training_sample(known, text, label, row_id))
    languages = sorted({k for k, _ in sample})
    if not languages:
        return None
    texts = [t.encode() for _, t in sample]
    offsets = np.cumsum([0, *map(len, texts)])
    data = np.frombuffer(b"".join(texts), np.uint8)
    starts = offsets[:-1]
    rows = window_bytes(data, starts, np.minimum(starts + WINDOW, offsets[1:]))
    index = {k: i for i, k in enumerate(languages)}
    return train(rows, np.array([index[k] for k, _ in sample]), languages)


def _predictor(blob: bytes):
    """A function over Arrow batches; the look-up tables are built once in each task."""

    def predict(batches):
        net: ByteNetwork = pickle.loads(blob)
        pairs = net.pairs()
        for batch in batches:
            column = batch.column("text")
            best, score = np.zeros(len(column), np.int64), np.zeros(len(column))
            for first, _, data, offsets in text_slices(column, 1 << 18):
                starts, ends, begin = cut_windows(data, offsets)
                total = np.empty((len(starts), len(net.languages)), np.float32)
                for i in range(0, len(starts), BLOCK):
                    part = slice(i, i + BLOCK)
                    total[part] = net.logits(window_bytes(data, starts[part], ends[part]), pairs)
                weight = np.maximum(ends - starts, 1).astype(np.float64)
                mean = np.add.reduceat(total * weight[:, None], begin[:-1], axis=0)
                mean /= np.add.reduceat(weight, begin[:-1])[:, None]
                odds = softmax(mean)
                rows = slice(first, first + len(odds))
                best[rows], score[rows] = odds.argmax(axis=1), odds.max(axis=1)
            letters = batch.column("letters").to_numpy(zero_copy_only=False)
            names = np.array(net.languages, dtype=object)[best]
            names[~letters] = UNDETERMINED
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), pa.array(names, pa.string()), pa.array(np.where(letters, score, 0.0))],
                ["row", "lang_pred", "score"],
            )

    return predict


def identify(docs: DataFrame, model: ByteNetwork | None, row: Column, text: str = "text") -> DataFrame:
    """``row`` (any value that stands for the document), ``lang_pred`` and ``score`` of every whole text."""
    rows = docs.select(
        row.alias("row"),
        F.col(text).cast("string").alias("text"),
        F.coalesce(F.col(text).rlike(r"\p{L}"), F.lit(False)).alias("letters"),
    )
    if model is None:
        return rows.select("row", F.lit(UNDETERMINED).alias("lang_pred"), F.lit(0.0).alias("score"))
    out = T.StructType([rows.schema["row"], *schema(lang_pred="string", score="double")])
    return rows.mapInArrow(lean(_predictor(pickle.dumps(model))), out)


def identified_rows(docs: DataFrame, model: ByteNetwork | None, least: float) -> DataFrame:
    """The rows of ``docs`` whose language is determined with a score of at least ``least``."""
    found = identify(docs, model, F.struct(*[F.col(f"`{c}`") for c in docs.columns]))
    return found.where((F.col("lang_pred") != UNDETERMINED) & (F.col("score") >= least)).select("row.*")

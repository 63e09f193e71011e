"""Both networks against a convolution written out word by word and byte by byte; archives read by a parser of its own."""

from __future__ import annotations

import io
import math
import random
from email.parser import BytesHeaderParser
from pathlib import Path

import numpy as np
import pytest
import zstandard

from atelier.llm import langid, toxicity, warc
from atelier.llm.textbytes import IS_LETTER

TEXTS = ["", "a", "ab", " . ", "une phrase courte", "x" * 127, "y" * 128, "z" * 129, "mot " * 300, "ça ☃ et là " * 40, "one\ntwo\tthree four"]


def random_texts(seed, n):
    rng = random.Random(seed)
    return TEXTS + ["".join(rng.choice("abc dé☃.\n") for _ in range(rng.choice([2, 30, 200, 900]))) for _ in range(n)]


def softmax(values):
    top = max(values)
    e = [math.exp(v - top) for v in values]
    return [v / sum(e) for v in e]


def plain_language(net, text):
    """(language, score): each window, filter and position in its turn."""
    data = text.encode()
    stride = langid.WINDOW - max(langid.WIDTHS) + 1
    n = max(1, -(-(len(data) - langid.WINDOW + stride) // stride))
    sums, weight = [0.0] * len(net.languages), 0
    for k in range(n):
        part = data[k * stride:k * stride + langid.WINDOW]
        window = part + bytes(langid.WINDOW - len(part))
        pooled = []
        for w in langid.WIDTHS:
            for f in range(langid.FILTERS):
                best = max(sum(float(net.filters[w][j][window[p + j], f]) for j in range(w)) for p in range(langid.WINDOW - w + 1))
                pooled.append(max(best + float(net.offsets[w][f]), 0.0))
        size = max(len(part), 1)
        weight += size
        for c in range(len(sums)):
            sums[c] += size * (sum(x * float(net.weights[i, c]) for i, x in enumerate(pooled)) + float(net.bias[c]))
    odds = softmax([s / weight for s in sums])
    return net.languages[odds.index(max(odds))], max(odds)


def test_language_scores_are_those_of_a_plain_convolution(spark, monkeypatch):
    rng = np.random.default_rng(3)
    names = ["de", "en", "fr"]
    net = langid.ByteNetwork(
        names,
        {w: rng.normal(0, 1, (w, 256, langid.FILTERS)).astype(np.float32) for w in langid.WIDTHS},
        {w: rng.normal(0, 1, langid.FILTERS).astype(np.float32) for w in langid.WIDTHS},
        rng.normal(0, 0.2, (langid.FILTERS * len(langid.WIDTHS), 3)).astype(np.float32),
        rng.normal(0, 1, 3).astype(np.float32),
    )
    texts = [t[:400] for t in random_texts(1, 6)]
    rows = spark.createDataFrame(list(enumerate([*texts, None])), "doc_id long, text string").repartition(3)
    got = {r["row"]: (r.lang_pred, r.score) for r in langid.identify(rows, net, langid.F.col("doc_id")).collect()}
    assert got[len(texts)] == ("und", 0.0)
    for k, text in enumerate(texts):
        name, score = plain_language(net, text) if any(c.isalpha() for c in text) else ("und", 0.0)
        assert got[k][0] == name and got[k][1] == pytest.approx(score, abs=1e-3), text


def plain_logit(net, text):
    """Words one by one: summed embeddings, each filter at each word, words beyond the end zero."""
    data = np.frombuffer(text.encode(), np.uint8)
    words, word = [], b""
    for b in [*data, 32]:
        if IS_LETTER[b]:
            word += bytes([b])
        elif word:
            words.append(word)
            word = b""
    vectors = []
    for word in words:
        buckets, _ = toxicity.word_buckets(np.frombuffer(word, np.uint8), np.array([0, len(word)]))
        vectors.append(sum(net.embeddings[b].astype(float) for b in buckets[0]))
    logit, k, column = net.bias, 0, 0
    for width in toxicity.WIDTHS:
        for f in range(toxicity.FILTERS):
            found = [
                sum(float(vectors[p + j] @ net.filters[k + j][:, f]) for j in range(width) if p + j < len(vectors)) for p in range(len(vectors))
            ]
            value = max(max(found) + float(net.offsets[column]), 0.0) if found else 0.0
            logit += value * float(net.weights[column])
            column += 1
        k += width
    return logit


@pytest.mark.parametrize("size", [1 << 18, 64])
def test_toxicity_scores_are_those_of_a_plain_convolution(spark, monkeypatch, size):
    monkeypatch.setattr(toxicity, "SLICE", size)
    rng = np.random.default_rng(4)
    n = toxicity.FILTERS * len(toxicity.WIDTHS)
    net = toxicity.TextNetwork(
        rng.normal(0, 0.3, (toxicity.BUCKETS, toxicity.DIMENSIONS)).astype(np.float32),
        rng.normal(0, 0.3, (sum(toxicity.WIDTHS), toxicity.DIMENSIONS, toxicity.FILTERS)).astype(np.float32),
        rng.normal(0, 0.3, n).astype(np.float32), rng.normal(0, 0.3, n).astype(np.float32), 0.25, [],
        np.zeros((toxicity.BUCKETS, 1), np.float32), np.array([0.5]),
    )
    texts = random_texts(2, 12)
    batches = [toxicity.word_buckets(d, o) for _, _, d, o in toxicity.text_slices(toxicity.pa.array(texts), size)]
    got = np.concatenate([net.scores(*b) for b in batches])
    assert len(got) == len(texts)
    cut = math.log(toxicity.THRESHOLD / (1 - toxicity.THRESHOLD))
    for text, score in zip(texts, got, strict=True):
        assert score == pytest.approx(1 / (1 + math.exp(-(plain_logit(net, text) - 0.5 + cut))), abs=1e-4), text


def records_of(path):
    """Headers and bodies, read front to back by the standard library and a plain Zstandard stream."""
    data = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(path.read_bytes()), read_across_frames=True).read()
    at = 0
    while at < len(data):
        end = data.index(b"\r\n\r\n", at) + 4
        version, head = data[at:end].split(b"\r\n", 1)
        assert version == b"WARC/1.1"
        headers = BytesHeaderParser().parsebytes(head)
        stop = end + int(headers["Content-Length"])
        yield headers, data[end:stop]
        assert data[stop:stop + 4] == b"\r\n\r\n"
        at = stop + 4


def test_archives_read_by_another_parser(spark, workdir):
    rows = [(1, "http://a", "same"), (2, "http://b", "same"), (3, None, None), (7, "u", "one of two"), (7, "u", "two of two"), (9, "v", "one of two")]
    rows += [(None, "w", "no id"), (None, "w", "no id"), *((k, "long", f"{k} body ☃ " * 4000) for k in range(20, 30))]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    warc.write_archives(pages, "file://" + workdir, date="2024-05-06T07:08:09Z")
    records = [r for path in sorted(Path(workdir).glob("*.warc.zst")) for r in records_of(path)]
    ids = [h["WARC-Record-ID"] for h, _ in records]
    assert len(records) == len(rows) and len(set(ids)) == len(rows)
    assert {h["WARC-Date"] for h, _ in records} == {"2024-05-06T07:08:09Z"}
    for h, body in records:
        assert all(h[k] for k in ("WARC-Type", "WARC-Record-ID", "WARC-Date", "Content-Type"))
        assert h["WARC-Type"] == "revisit" or h["WARC-Payload-Digest"] == "sha1:" + warc.payload_digest(body)
    digest = {h["WARC-Record-ID"]: (h["WARC-Type"], h["WARC-Payload-Digest"]) for h, _ in records}
    revisits = [h for h, body in records if h["WARC-Type"] == "revisit" and body == b""]
    assert sorted(h["WARC-Record-ID"].split(":")[2] for h in revisits) == ["2", "9"]
    for h in revisits:
        assert digest[h["WARC-Refers-To"]] == ("response", h["WARC-Payload-Digest"])

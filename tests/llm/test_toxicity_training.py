"""Toxicity learns from every labelled row and whole text, in parts."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from atelier.llm import toxicity

CLEAN = ["calm", "green", "river", "stone", "bird"]


def _tables(spark, texts):
    docs = spark.createDataFrame([(k, text, "en") for k, (text, _) in enumerate(texts)], "doc_id long, text string, lang string")
    return docs, spark.createDataFrame([(k, toxic) for k, (_, toxic) in enumerate(texts)], "doc_id long, toxic int")


def _prose(seed, n):
    return " ".join(np.random.default_rng(seed).choice(CLEAN, n))


def test_long_texts_are_learnt_from(spark):
    """All texts are over 32 KB; the word that matters is at the end."""
    texts = [(_prose(k, 7000) + (" vilest" if k % 2 else " finest"), k % 2) for k in range(80)]
    docs, labels = _tables(spark, texts)
    model = toxicity.learn(docs, labels, F.lit(False))
    got = {r.doc_id: r.predicted for r in toxicity.score(docs, model).collect()}
    assert model is not None and [got[k] for k in range(80)] == [toxic for _, toxic in texts]


def test_all_rows_count_and_many_parts_learn_together(spark, monkeypatch):
    texts = [(_prose(k, 20) + (f" vilest mark{'abcdefghij'[k % 10]}" if k % 4 == 0 else ""), int(k % 4 == 0)) for k in range(6000)]
    docs, labels = _tables(spark, texts)
    monkeypatch.setattr(toxicity, "PART_ROWS", 700)
    rows = toxicity.labelled_rows(docs, labels, F.lit(False))
    assert rows.count() == 6000 and rows.select("part").distinct().count() == 9
    seen, words = toxicity.bucket_counts(rows, ["en"])
    bucket = toxicity.word_buckets(np.frombuffer(b"vilest", np.uint8), np.array([0, 6]))[0][0, 0]
    assert seen[1, bucket] == 1500 == words[bucket, 0] and seen[0, bucket] == 0
    models = [toxicity.learn(d, m, F.lit(False)) for d, m in ((docs, labels), (docs.repartition(3), labels.repartition(5)))]
    assert (models[0].embeddings == models[1].embeddings).all() and (models[0].thresholds == models[1].thresholds).all()
    got = toxicity.score(docs, models[0]).join(labels, "doc_id")
    assert got.where("predicted != toxic").count() == 0


def test_peaks_by_pieces_are_those_of_whole_texts(monkeypatch):
    rng = np.random.default_rng(1)
    net = toxicity.network(toxicity.start(rng.random((2, toxicity.BUCKETS)), 5, 5))
    sizes = [0, 1, 2, 40, 0, 300, 3]
    texts = toxicity.Texts(rng.integers(0, toxicity.BUCKETS, (sum(sizes), 3)).astype(np.int32), np.cumsum([0, *sizes]))
    whole = toxicity.peaks(net, texts)
    monkeypatch.setattr(toxicity, "PIECE", 7)
    pieces = toxicity.peaks(net, texts)
    assert np.allclose(whole[0], pieces[0], atol=1e-6) and (whole[1] == pieces[1]).all()
    values = net.responses(texts.buckets, texts.first)
    assert np.allclose(whole[0][5], values[43:343].max(axis=0)) and (whole[0][0] == -net.offsets).all()

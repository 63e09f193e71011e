"""Long texts by pieces, the pipeline's stages against plain Python, and inputs that once failed."""

from __future__ import annotations

import random
import resource
import subprocess
import sys
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import plain
import pytest

import corpus_pipeline
from atelier.llm import langid, linededup, mixing, ngramjoin, textbytes, tokenids, toxicity
from atelier.llm.queries import LEAST_LANGUAGE_SCORE, _language_model, decontamination_stage, language_stage, tokenizer_file
from atelier.llm.staging import shared_root

SF_SMALL = "/root/testdata/sf0.001"
ROOT = str(Path(__file__).resolve().parents[2])


def test_hashes_by_pieces_are_those_of_the_whole(monkeypatch):
    rng = np.random.default_rng(1)
    data = rng.integers(0, 256, 5000).astype(np.uint8)
    starts = rng.integers(0, 5000, 400)
    ends = np.minimum(starts + rng.integers(0, 3000, 400), 5000)
    whole = textbytes.ByteHash(7).spans(data, starts, ends)
    for size in (1, 7, 64, 4999, 5000):
        monkeypatch.setattr(textbytes, "SLICE_BYTES", size)
        assert (textbytes.ByteHash(7).spans(data, starts, ends) == whole).all()


def test_lines_of_a_long_text_need_little_memory():
    """50 MB of short lines, and one line of 20 MB, in a process of its own."""
    code = f"""
import resource, sys
sys.path.insert(0, {ROOT!r})
import numpy as np, pyarrow as pa
from atelier.llm import linededup
rng = np.random.default_rng(1)
for width in (60, 20_000_000):
    size = 50_000_000 if width == 60 else width
    data = rng.integers(97, 123, size).astype(np.uint8)
    data[width::width] = 10
    batch = pa.record_batch([pa.array([1]), pa.array([2]), pa.array([data.tobytes()], pa.binary()).view(pa.string())], ["doc", "mark", "text"])
    before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
    rows = sum(b.num_rows for b in linededup.line_rows(batch, 10))
    print(rows, (resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before) // 1024)
"""
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=300, check=True).stdout.split()
    assert int(out[0]) > 800_000 and int(out[2]) == 1
    assert int(out[1]) < 200 and int(out[3]) < 250


def test_long_lines_and_short_ones(spark, monkeypatch):
    rng = random.Random(4)
    lines = ["".join(rng.choice("abc é☃\t ") for _ in range(rng.choice([0, 3, 8, 9, 10, 11, 12, 50]))) for _ in range(60)]
    rows = [(k, "\n".join(rng.choice(lines) for _ in range(rng.randint(1, 30)))) for k in range(50)]
    monkeypatch.setattr(linededup, "SLICE_BYTES", 40)
    data = "\n".join(lines).encode()
    starts, ends, _ = linededup.line_spans(np.frombuffer(data, np.uint8), np.array([0, len(data)]))
    wanted = [len(line) >= 10 for line in lines]
    assert linededup.long_enough(np.frombuffer(data, np.uint8), starts, ends, 10).tolist() == wanted
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = Counter(map(tuple, linededup.deduplicate_lines(df).select("doc_id", "n_lines", "n_dropped", "kept_sha256").collect()))
    assert got == plain.line_dedup(rows)


def test_bitmaps_give_the_kept_texts(spark, edge_docs):
    rows = linededup.with_marks(edge_docs)
    bitmaps = linededup.keep_bitmaps(rows)
    assert set(bitmaps.columns) == {"doc", "mark", "n_bits", "keep_bitmap"}
    import hashlib

    kept = Counter((r.doc_id, r.n_lines, r.n_dropped, hashlib.sha256(r.kept.encode()).hexdigest()) for r in linededup.apply_bitmaps(rows, bitmaps).collect())
    assert kept == plain.line_dedup([(r.doc_id, r.text) for r in edge_docs.select("doc_id", "text").collect()])


def test_units_give_the_ids_of_whole_texts():
    from tokenizers import Tokenizer

    definition = Path(tokenizer_file()).read_text(encoding="utf-8")
    whole = Tokenizer.from_str(definition)
    encoder = tokenids.UnitEncoder(definition, "<u2")
    rng = random.Random(6)
    parts = [" ", " ", " ", "\n", "\n\n", "\t", "  ", "a", "Word", "été", "ɏ", "ω", "漢", "²", "Ⅷ", "7", "12", "_", "'", "'s", "'there", "'ll", ",", "...", "́", "☃", "\x1c", " ", "<|endoftext|>"]
    parts += ["\u2009", "\u3000", "\x85", "\u202f", "\u1680", "”", "×", "÷", "\0", "ab\0", "x" * 30]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 25))) for _ in range(6000)]
    got = [np.frombuffer(x, "<u2").tolist() for x in encoder.encode(texts, b"")]
    wrong = [t for t, ids in zip(texts, got, strict=True) if ids != whole.encode(t, add_special_tokens=False).ids]
    assert wrong == []


def test_long_texts_are_encoded_by_pieces_and_a_full_table_gives_the_same_ids(monkeypatch):
    from tokenizers import Tokenizer

    definition = Path(tokenizer_file()).read_text(encoding="utf-8")
    whole, rng = Tokenizer.from_str(definition), random.Random(7)
    words = ["".join(rng.choice("abcdeé漢'7") for _ in range(rng.randint(1, 9))) for _ in range(900)]
    texts = [" ".join(rng.choice(words) for _ in range(n)) + rng.choice(["", " ", "\n"]) for n in (9000, 0, 3, 4000, 1, 0)] + ["y" * 9000]
    monkeypatch.setattr(tokenids, "SLICE_BYTES", 4096)
    for room in (1, 50, 1 << 12):
        encoder = tokenids.UnitEncoder(definition, "<u2")
        encoder.known = tokenids.UnitTable("<u2", room)
        for _ in range(2):  # new units, then kept ones
            got = [np.frombuffer(x, "<u2").tolist() for x in encoder.encode(texts, np.array([2], "<u2").tobytes())]
            assert got == [[*whole.encode(t, add_special_tokens=False).ids, 2] for t in texts]
        assert encoder.known.n <= room


def test_pieces_of_a_text_are_the_whole_text(monkeypatch):
    monkeypatch.setattr(tokenids, "SLICE_BYTES", 64)
    for text in (b"", b"a" * 500, b"ab " * 100, b" " * 300 + b"x", b"x" * 200 + b" y" * 40, "é ".encode() * 90):
        pieces = list(tokenids.text_pieces(np.frombuffer(text, np.uint8)))
        assert b"".join(p.tobytes() for p in pieces) == text


def test_the_shared_folder_is_set_where_it_is_missing():
    code = (
        "from pyspark.sql import SparkSession as S\n"
        "s = S.builder.master('local[1]').config('spark.ui.enabled','false').getOrCreate()\n"
        "from atelier.llm.staging import shared_root\n"
        "print('ROOT', shared_root(s) == shared_root(s), shared_root(s).startswith('file:'))\n"
    )
    out = subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True, timeout=120)
    assert "ROOT True True" in out.stdout, out.stderr[-2000:]


def test_labels_that_differ_and_rows_without_a_language(spark):
    """An id with both labels is toxic; rows of one id and text with and without a language have an order."""
    docs, labels = [], []
    for k in range(60):
        text = ("you are awful rotten scum " if k % 2 else "a fine day in the garden ") * 4
        docs += [(k, text, "en"), (k, text, None)]
        labels.append((k, k % 2))
    labels += [(1, 0), (3, 0)]
    df = spark.createDataFrame(docs, "doc_id long, text string, lang string")
    marks = spark.createDataFrame(labels, "doc_id long, toxic int")
    from pyspark.sql import functions as F

    scores = [toxicity.score(df, toxicity.learn(df, m, F.lit(False))).collect() for m in (marks, marks.repartition(5), marks.filter("doc_id not in (1, 3) or toxic = 1"))]
    assert scores[0] == scores[1] == scores[2]


def stage_rows(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


def test_near_copies_go_and_clean_rows_stay(spark, edge_docs):
    """Against plain Python, with repeated ids, repeated rows and rows without an id, at the production threshold."""
    rng = random.Random(9)
    words = [f"w{k}" for k in range(400)]
    base = [" ".join(rng.choice(words) for _ in range(80)) for _ in range(3)]
    near = base[0] + " one more"
    rows = [(1, base[0]), (2, near), (2, base[1]), (3, base[2]), (3, base[2]), (None, base[2]), (None, near), (None, "nothing like it at all here"), (4, ""), (5, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    kept = Counter(stage_rows(ngramjoin.one_of_each(df)))
    assert kept == Counter([(1, base[0]), (2, base[1]), (3, base[2]), (None, "nothing like it at all here"), (4, ""), (5, None)])
    # In general: one row of each component, and all rows without words, repeated rows once.
    rows = [tuple(r) for r in edge_docs.collect()]
    sets = [plain.shingles(r[1]) for r in rows]
    parent = list(range(len(rows)))

    def find(k):
        while parent[k] != k:
            k = parent[k]
        return k

    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                parent[find(a)] = find(b)
    groups = defaultdict(set)
    for k, r in enumerate(rows):
        groups[find(k) if sets[k] else ("no words", r)].add(r)
    out = [tuple(r) for r in ngramjoin.one_of_each(edge_docs).collect()]
    assert len(out) == len(groups) == len(set(out))
    for members in groups.values():
        chosen = members.intersection(out)
        assert len(chosen) == 1 and min(plain.id_rank(m[0]) for m in members) == plain.id_rank(next(iter(chosen))[0])


@pytest.fixture(scope="module")
def pipeline_run(spark):
    """The stages' written rows over the smallest tables."""
    docs = corpus_pipeline.table(spark, SF_SMALL, "documents")
    stages = []
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, corpus_pipeline.staged(stage(spark, docs, SF_SMALL), name)
        stages.append((before, docs))
    return stages


def test_pipeline_language_stage(spark, pipeline_run):
    before, after = pipeline_run[0]
    from pyspark.sql import functions as F

    found = {r.row: r for r in langid.identify(before, _language_model(before), F.col("doc_id")).collect()}
    wanted = Counter((d, t) for d, t in stage_rows(before) if found[d].lang_pred != "und" and found[d].score >= LEAST_LANGUAGE_SCORE)
    assert Counter(stage_rows(after)) == wanted and after.columns == before.columns
    # Every text in one of the languages stays, whatever it says.
    with_letters = [(d, t) for d, t in stage_rows(before) if len(plain.words_only(t)) >= 30]
    assert sum(x in wanted for x in with_letters) >= 0.97 * len(with_letters)
    assert language_stage(spark, before.limit(0), SF_SMALL).count() == 0


def test_pipeline_near_copy_stage(pipeline_run):
    before, after = pipeline_run[1]
    rows = stage_rows(before)
    components = plain.near_groups(rows)
    roots = Counter({(d, c) for d, _, c in components})
    wanted = Counter((d, t) for d, t in rows if (d, d) in roots)
    assert Counter(stage_rows(after)) == wanted and after.columns == before.columns


def test_pipeline_decontamination_stage(spark, pipeline_run):
    before, after = pipeline_run[2]
    items = [plain.words_only(r.text) for r in corpus_pipeline.table(spark, SF_SMALL, "benchmark").collect()]
    runs = {tuple(w[k:k + 13]) for w in items for k in range(len(w) - 12)}
    kept = Counter(stage_rows(after))

    def holds(text, width, some):
        words = plain.words_only(text)
        return any(tuple(words[k:k + width]) in some for k in range(len(words) - width + 1))

    assert all(row in kept for row in stage_rows(before) if not holds(row[1], 4, {w[k:k + 4] for w in runs for k in range(10)}))
    assert not any(holds(t, 13, runs) for _, t in kept) and after.columns == before.columns
    assert decontamination_stage(spark, before.limit(0), SF_SMALL).count() == 0


def test_pipeline_mixing_stage(pipeline_run):
    before, after = pipeline_run[3]
    planned = Counter()
    for r in mixing.mix(before).collect():
        planned[r.doc_id] += r.times
    assert Counter(d for d, _ in stage_rows(after)) == +planned
    assert set(stage_rows(after)) <= set(stage_rows(before)) and after.columns == before.columns


def test_pipeline_token_stage(pipeline_run):
    from tokenizers import Tokenizer

    before, after = pipeline_run[4]
    tokenizer = Tokenizer.from_file(tokenizer_file())
    import zlib

    wanted = Counter()
    for d, t in stage_rows(before):
        ids = np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, tokenids.END_ID], "<u4")
        wanted[(d, len(ids), zlib.crc32(ids.tobytes()))] += 1
    got = sorted(map(tuple, after.select("start", "doc_id", "n_tokens", "ids_crc32").collect()))
    assert Counter(r[1:] for r in got) == wanted
    assert [r[0] for r in got] == np.cumsum([0, *(r[2] for r in got)])[:-1].tolist()
    assert [r[1] for r in got] == sorted(r[1] for r in got)


def test_the_pipeline_is_its_stages(spark, pipeline_run):
    again = corpus_pipeline.run(spark, SF_SMALL)
    assert Counter(map(tuple, again.collect())) == Counter(map(tuple, pipeline_run[-1][1].collect()))
    assert corpus_pipeline.ORACLE_SQL is None and shared_root(spark)
    assert resource.getrusage(resource.RUSAGE_SELF).ru_maxrss > 0


def test_hits_of_a_frequent_hash_are_split_and_meet_every_seed(spark):
    from atelier.llm import decontaminate

    hits = spark.range(5000).selectExpr("if(id % 5 < 4, 7, id) as hash", "id as doc_id")
    seeds = spark.createDataFrame([(7, 1), (7, 2), (10, 3), (14, 4), (99, 5)], "hash long, item_id long")
    left, right = decontaminate.split_hot(hits, seeds, least=300)
    assert left.where("hash = 7").select("salt").distinct().count() == right.where("hash = 7 and item_id = 1").count() > 1
    most = left.where("hash = 7").groupBy("salt").count().agg({"count": "max"}).first()[0]
    assert most < 1000
    got = sorted((r.doc_id, r.item_id) for r in left.join(right, ["hash", "salt"]).collect())
    want = sorted((r.doc_id, r.item_id) for r in hits.join(seeds, "hash").collect())
    assert got == want


@pytest.mark.parametrize("most", [0, 100])
def test_rows_alike_share_their_numbers_out(spark, monkeypatch, most):
    from atelier.llm import mixing

    monkeypatch.setattr(mixing, "BROADCAST_SOURCES", most)
    rows = [(None, "a", "one two three")] * 5 + [(k, "a", "one two " * (k % 3)) for k in range(9)] + [(k, "b", "x y") for k in range(40)] + [(1, None, "z")]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string")
    chosen = mixing.mix(docs).groupBy("doc_id", "source", "mark").agg({"times": "sum"}).collect()
    want = sorted((str(r[0]), str(r[1]), r[3]) for r in chosen if r[3])
    taken = mixing.mixed_rows(docs)
    assert taken.columns == docs.columns
    got = taken.selectExpr("doc_id", "source", "xxhash64(text) as mark").groupBy("doc_id", "source", "mark").count().collect()
    assert sorted((str(r[0]), str(r[1]), r[3]) for r in got) == want

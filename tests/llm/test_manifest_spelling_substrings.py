"""Merkle manifest, spelling variants and substring deduplication against plain Python."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import plain
import pytest

from pyspark.sql import functions as F

from atelier.llm import merkle, recompress, spelling
from atelier.llm.queries import op11_substring_dedup, op12_merkle_manifest, op13_spelling_variants
from atelier.llm.textbytes import words_of


def rows_of(df, *columns):
    return Counter(tuple(r) for r in df.select(*columns).collect())


# Merkle manifest


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(row, text):
    fields = [row["doc_id"], row["source"], row["lang"], row["n_chars"], text]
    return sha(*("-" if f is None else f"{len(str(f).encode())}:{f}" for f in fields))


def plain_tree(leaves, fanout):
    """The top of a list of digests, and the siblings of each leaf from the leaf up."""
    paths = [[] for _ in leaves]
    nodes, members = list(leaves), [[k] for k in range(len(leaves))]
    while len(nodes) > 1:
        upper, upper_members = [], []
        for a in range(0, len(nodes), fanout):
            run = nodes[a:a + fanout]
            for k in range(len(run)):
                for leaf in members[a + k]:
                    paths[leaf].append(("".join(run[:k]), "".join(run[k + 1:])))
            upper.append(sha(*run))
            upper_members.append([leaf for m in members[a:a + fanout] for leaf in m])
        nodes, members = upper, upper_members
    return nodes[0], paths


def plain_manifest(rows, fanout):
    rank = {s: k for k, s in enumerate(sorted({r["source"] for r in rows}, key=lambda s: (s is not None, (s or "").encode())))}
    groups = [[] for _ in rank]
    for r in rows:
        groups[rank[r["source"]]].append((r["doc_id"] is not None, r["doc_id"] or 0, leaf_of(r, r["text"]), r))
    trees = []
    for g in groups:
        g.sort(key=lambda x: x[:3])
        trees.append(plain_tree([x[2] for x in g], fanout))
    root, above = plain_tree([top for top, _ in trees], fanout)
    out = []
    for g, (top, paths), rest in zip(groups, trees, above, strict=True):
        for (_, _, leaf, r), path in zip(g, paths, strict=True):
            whole = path + rest
            tampered = r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0
            node = leaf_of(r, r["text"] and r["text"].translate(plain.LOWER)) if tampered else leaf
            for before, after in whole:
                node = sha(before, node, after)
            out.append((r["doc_id"], leaf, top, root, sha(*(b + a for b, a in whole)), node, node == root))
    return Counter(out)


MANIFEST = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


@pytest.fixture(scope="module")
def edge_folder(edge_docs, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("edge"))
    edge_docs.write.parquet(f"{folder}/documents.parquet")
    return folder


@pytest.fixture(scope="module")
def empty_folder(no_docs, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("empty"))
    no_docs.write.parquet(f"{folder}/documents.parquet")
    return folder


def test_manifest_query(spark, edge_docs, edge_folder):
    rows = [r.asDict() for r in edge_docs.collect()]
    assert rows_of(op12_merkle_manifest(spark, edge_folder), *MANIFEST) == plain_manifest(rows, 16)


@pytest.mark.parametrize("fanout", [2, 3, 64])
def test_manifest_with_other_fanouts(spark, fanout):
    rows = [{"doc_id": k, "source": f"s{k % 3 if k > 8 else 0}", "lang": None, "n_chars": k, "text": "Text " * (k % 4)} for k in range(70)]
    docs = spark.createDataFrame([tuple(r.values()) for r in rows], "doc_id long, source string, lang string, n_chars long, text string")
    found = merkle.manifest(docs, fanout=fanout)
    got = rows_of(found.select("doc_id", "leaf", "subroot", "root", merkle.folded(F.col("leaf"), F.col("path")).alias("again")), "doc_id", "leaf", "subroot", "root", "again")
    assert got == Counter((d, leaf, top, root, root) for d, leaf, top, root, *_ in plain_manifest(rows, fanout).elements())


def test_one_changed_text_changes_its_root_only(spark, edge_docs):
    before = {(r.doc_id, r.leaf): r.subroot for r in merkle.manifest(edge_docs).collect()}
    changed = edge_docs.withColumn("text", F.when(F.col("doc_id") == 100, F.lit("other")).otherwise(F.col("text")))
    after = merkle.manifest(changed).collect()
    assert {r.source for r in after if before.get((r.doc_id, r.leaf)) != r.subroot} == {"hot"}


def test_empty_manifest(spark, empty_folder):
    assert op12_merkle_manifest(spark, empty_folder).collect() == []


# Spelling variants


def plain_words(rows, every, min_letters=5, min_count=3):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(plain.LOWER)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            counts[run[:h % len(run)] + run[h % len(run) + 1:] if h % every == 0 else run] += 1
    return {w: n for w, n in counts.items() if len(w) >= min_letters and n >= min_count}


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return len(b) == len(a) + 1 and any(a == b[:k] + b[k + 1:] for k in range(len(b)))


def plain_groups(words, ratio=2):
    form, out = {}, []
    near = {w: [x for x in words if one_edit(w, x)] for w in words}
    for w, n in words.items():
        best = min(near[w], key=lambda x: (-words[x], x), default=None)
        form[w] = best if best is not None and words[best] >= ratio * n else None
    for w, n in words.items():
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, n, len(near[w]), words.get(form[w])))
    return Counter(out)


GROUPS = ["word", "form", "root", "n", "n_near", "form_n"]


def test_spelling_query(spark, edge_docs, edge_folder):
    rows = [(r.doc_id, r.text) for r in edge_docs.collect()]
    assert rows_of(op13_spelling_variants(spark, edge_folder), *GROUPS) == plain_groups(plain_words(rows, 97))


def test_word_counts_with_many_corrupted(spark, edge_docs):
    rows = [(r.doc_id, r.text) for r in edge_docs.collect()] + [(7, "Été é×÷ ŒUVRE naïve " * 3), (8, "aaaa " * 9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = rows_of(spelling.word_counts(docs, 2, 1, 1), "word", "n")
    assert got == Counter((w, n) for w, n in plain_words(rows, 2, 0, 1).items() if w)


def variants():
    """Words of two letters in all ways of a few lengths, long words one edit apart, anagrams and very long words."""
    rng = random.Random(5)
    words = {"".join("ab"[k >> j & 1] for j in range(m)) for m in range(1, 8) for k in range(1 << m)}
    for _ in range(120):
        w = "".join(rng.choice("abcdefgé") for _ in range(rng.randint(5, 14)))
        k = rng.randrange(len(w))
        words |= {w, w[:k] + w[k + 1:], w[:k] + "z" + w[k:], w[:k] + "y" + w[k + 1:], "".join(sorted(w))}
    long = "abcdefghij" * 500
    words |= {long, long[:2500] + long[2501:], long[:-1] + "z", long[::-1]}
    return {w: rng.choice([1, 2, 3, 5, 9, 20, 50, 200, 1000]) for w in sorted(words)}


@pytest.mark.parametrize("most", [1, 40, 100_000])
def test_near_words_however_blocks_are_cut(spark, most):
    words = variants()
    df = spark.createDataFrame(list(words.items()), "word string, n long").repartition(5)
    assert rows_of(spelling.spelling_groups(df, most=most), *GROUPS) == plain_groups(words)


def test_blocks_are_bounded(spark):
    df = spark.createDataFrame(list(variants().items()), "word string, n long")
    sizes = spelling.blocks(df, 30).groupBy("block").agg(F.count("*").alias("size"), F.max(F.col("high") - F.col("low")).alias("width"))
    assert sizes.where("size > 30 and width > 1").count() == 0


def test_gram_distances():
    words = ["abcde", "abcdf", "abced", "abcd", "zzzzz", "àbcde", "abcde" * 900, "abcde" * 900 + "f"]
    a, b = spelling.close_pairs(words, np.zeros(len(words), np.int64))
    counts = [Counter(w) for w in words]
    wanted = {(i, j) for j in range(len(words)) for i in range(j) if 1 <= sum((counts[i][c] - counts[j][c]) ** 2 for c in counts[i] | counts[j]) <= 2}
    assert set(zip(a.tolist(), b.tolist(), strict=True)) == wanted


def test_long_texts_are_read_in_pieces(monkeypatch):
    monkeypatch.setattr(spelling, "PIECE", 10)
    text = "aé" * 30 + " bb, c" * 7 + "x"
    parts = list(spelling.pieces(text))
    assert "".join(parts) == text and len(parts) > 2
    assert [w for p in parts for w in spelling.RUN.findall(p)] == spelling.RUN.findall(text)


def test_no_words(spark, empty_folder):
    assert op13_spelling_variants(spark, empty_folder).collect() == []


# Substring deduplication


def plain_substrings(rows, width=13):
    first = {}
    words = [plain.WORD.findall(t or "") for _, t in rows]
    for (doc_id, _), w in zip(rows, words, strict=True):
        for k in range(len(w) - width + 1):
            key = tuple(w[k:k + width])
            first[key] = min(first.get(key, (2, 0)), plain.id_rank(doc_id))
    out = []
    for (doc_id, _), w in zip(rows, words, strict=True):
        gone = {k + j for k in range(len(w) - width + 1) if first[tuple(w[k:k + width])] < plain.id_rank(doc_id) for j in range(width)}
        out.append((doc_id, len(w), len(gone), " ".join(x for k, x in enumerate(w) if k not in gone)))
    return Counter(out)


KEPT = ["doc_id", "n_words", "n_removed", "kept"]


def passages():
    """Texts of few words, with passages shared at other places, repeated words and periods of several lengths."""
    rng = random.Random(8)
    shared = [[rng.choice("abcdefgh") + rng.choice("xyz") for _ in range(n)] for n in (13, 14, 20, 60, 200)]
    rows = []
    for k in range(70):
        words = []
        for _ in range(rng.randint(1, 5)):
            words += [rng.choice("abcdefgh") + rng.choice("uvw") for _ in range(rng.randint(0, 30))]
            kind = rng.randrange(4)
            if kind == 0:
                words += rng.choice(shared)
            elif kind == 1:
                words += ["same"] * rng.randint(1, 40)
            elif kind == 2:
                words += ["p", "q", "r"][: rng.randint(1, 3)] * rng.randint(1, 20)
            else:
                some = rng.choice(shared)
                words += some[rng.randrange(len(some)):]
        rows.append((rng.choice([None, k, k, k, 3, -k]), rng.choice([" ", "\n", " \t "]).join(words)))
    return rows


@pytest.mark.parametrize(("levels", "slice_bytes", "buckets"), [(1, 700, 3), (2, 700, 3), (2, 1 << 20, 1), (3, 3000, 64)])
def test_substrings(spark, levels, slice_bytes, buckets):
    rows = passages()
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    found = recompress.deduplicate_substrings(docs, levels=levels, slice_bytes=slice_bytes, buckets=buckets)
    assert rows_of(found, *KEPT) == plain_substrings(rows)


def test_other_widths(spark):
    rows = passages()
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for width in (1, 2, 5, 30):
        assert rows_of(recompress.deduplicate_substrings(docs, width, 1), *KEPT) == plain_substrings(rows, width)


def test_substring_query(spark, edge_docs, edge_folder):
    rows = [(r.doc_id, r.text) for r in edge_docs.collect()]
    wanted = Counter((d, n, gone, hashlib.sha256(kept.encode()).hexdigest()) for d, n, gone, kept in plain_substrings(rows).elements())
    assert rows_of(op11_substring_dedup(spark, edge_folder), "doc_id", "n_words", "n_removed", "kept_sha256") == wanted


def test_no_texts(spark, empty_folder):
    assert op11_substring_dedup(spark, empty_folder).collect() == []


def test_equal_windows_have_equal_insides():
    """The names of a window's inner symbols are the same wherever it occurs."""
    rng = np.random.default_rng(2)
    for _ in range(200):
        window = rng.integers(0, 4, 13)
        seen = set()
        for _ in range(4):
            before, after = rng.integers(0, 4, rng.integers(0, 6)), rng.integers(0, 4, rng.integers(0, 6))
            text = " ".join(f"w{k}" for k in np.concatenate([before, window, after])).encode()
            part = recompress.Slice(np.array([1]), np.frombuffer(text, np.uint8), np.array([0, len(text)]), 13, 2)
            names, _, first, end = part.pairs()
            seen.add(tuple(names[first[len(before)]:end[len(before)]].tolist()))
        assert len(seen) == 1


def test_most_windows_have_insides():
    text = " ".join(f"w{k}" for k in np.random.default_rng(3).integers(0, 1000, 20_000)).encode()
    part = recompress.Slice(np.array([1]), np.frombuffer(text, np.uint8), np.array([0, len(text)]), 13, recompress.LEVELS)
    _, _, first, end = part.pairs()
    assert (end > first).mean() > 0.9 and len(part.pairs()[0]) < 0.7 * len(part.names)


def test_a_round_shortens_and_names_by_content():
    data = b"a a a b c a a b c a a a b c"
    starts, ends, _ = words_of(np.frombuffer(data, np.uint8), np.array([0, len(data)]))
    names = np.array([{"a": 1, "b": 2, "c": 3}[data[s:e].decode()] for s, e in zip(starts, ends, strict=True)], np.uint64)
    level, texts, run_of, symbol_of, _ = recompress.next_level(names, np.zeros(len(names), np.int64))
    assert len(level) < len(names) and len(run_of) == len(names) and len(symbol_of) == run_of[-1] + 1
    # The runs of three a have one name, the run of two another.
    runs = [level[symbol_of[run_of[k]]] for k in (0, 5, 9)]
    assert runs[0] == runs[2] != runs[1] and len(texts) == len(level)

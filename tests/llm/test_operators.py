"""Each operator on the edge cases, an empty table and, where it is exact, against plain Python."""

from __future__ import annotations

import random
import zlib
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import plain
import pytest

from pyspark.sql import functions as F

from atelier.llm import decontaminate, exactdedup, langid, linededup, mixing, ngramjoin, secretscan, tokenids, toxicity, warc
from atelier.llm.components import components
from atelier.llm.queries import queries, tokenizer_file
from atelier.llm.staging import remainder, with_types

SF_SMALL = "/root/testdata/sf0.001"


def rows_of(df, *columns):
    return Counter(tuple(r) for r in df.select(*columns).collect())


def texts(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


def test_line_dedup(edge_docs):
    got = rows_of(linededup.deduplicate_lines(edge_docs), "doc_id", "n_lines", "n_dropped", "kept_sha256")
    assert got == plain.line_dedup(texts(edge_docs))


def test_line_dedup_hot_line_over_many_partitions(spark):
    rows = [(k, f"a line in every document\nown line number {k}\na line in every document") for k in range(400)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "37")
    try:
        got = rows_of(linededup.deduplicate_lines(df), "doc_id", "n_lines", "n_dropped", "kept_sha256")
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert got == plain.line_dedup(rows)


def test_keep_bitmap_round_trip():
    keep = linededup.read_bitmap(linededup.keep_bitmap(19, [0, 7, 18]), 19)
    assert keep.tolist() == [k not in (0, 7, 18) for k in range(19)]


@pytest.mark.parametrize("digest_bytes", [16, 1])
def test_exact_dedup(edge_docs, digest_bytes):
    """One-byte digests conflict, so identifiers must be told apart by bytes."""
    got = rows_of(exactdedup.deduplicate(edge_docs, digest_bytes), "doc_id", "keep_id", "group_size", "kept", "text_sha256")
    assert got == plain.exact_dedup(texts(edge_docs))


def test_chunks_follow_content():
    rng = np.random.default_rng(1)
    body = rng.integers(97, 123, 200_000).astype(np.uint8)
    moved = np.concatenate([rng.integers(97, 123, 77).astype(np.uint8), body])
    cuts, later = exactdedup.cut_points(body), exactdedup.cut_points(moved)
    assert cuts[-1] == len(body) and len(set(cuts + 77) & set(later)) >= 0.9 * len(cuts)
    assert np.diff(exactdedup.cut_points(np.full(300_000, 97, np.uint8)), prepend=0).max() <= exactdedup.MAX_CHUNK


def test_warc(spark):
    rows = [(1, "u", "<p>x</p>"), (2, "u\nv", "<p>x</p>"), (3, None, None), (4, "u", ""), (None, "u", "<p>x</p>"), (5, "u", "☃" * 9000)]
    rows += [(2, "u", "<p>x</p>"), *((k, "h", "hot payload") for k in range(50, 150)), *((k, "h", "row" + "\r\n\r\n" * k) for k in range(200, 240))]
    pages = spark.createDataFrame([(*r, "extra") for r in rows], "page_id long, url string, html string, payload string").repartition(4)
    columns = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    assert rows_of(warc.archive_pages(pages), *columns) == plain.archive([(r[0], r[2]) for r in rows])
    assert warc.archive_pages(pages.limit(0)).count() == 0


def test_warc_record_by_index(spark, workdir):
    pages = spark.createDataFrame([(k, "u", f"body {k} " * 9000) for k in range(40)], "page_id long, url string, html string")
    index = warc.write_archives(pages, "file://" + workdir)
    assert index.select("frame").distinct().count() > 1
    got = warc.fetch(index, spark.createDataFrame([(7,), (39,)], "page_id long")).collect()
    assert {r.page_id: bytes(r.payload).decode() for r in got} == {k: f"body {k} " * 9000 for k in (7, 39)}


def test_mixing(edge_docs):
    got = mixing.mix(edge_docs).collect()
    assert Counter((r.doc_id, r.source, r["size"]) for r in got) == Counter(
        (r.doc_id, r.source, len(plain.WORD.findall(r.text or ""))) for r in edge_docs.collect()
    )
    total, taken, target, largest = Counter(), Counter(), {}, Counter()
    for r in got:
        total[r.source] += r["size"]
        taken[r.source] += r.taken
        target[r.source] = r.target
        largest[r.source] = max(largest[r.source], r["size"])
        assert r.taken in {k * r["size"] for k in range(4)} and r.source_size >= r["size"]
    wanted = plain.targets(total)
    for source in total:
        assert target[source] == pytest.approx(wanted[source])
        assert 0 <= target[source] - taken[source] <= max(8, largest[source])
    again = mixing.mix(edge_docs.repartition(3))
    assert rows_of(again, "doc_id", "source", "mark", "times") == Counter((r.doc_id, r.source, r.mark, r.times) for r in got)


def test_mixed_rows_repeat_as_planned(edge_docs):
    planned = Counter()
    for r in mixing.mix(edge_docs).collect():
        planned[r.doc_id] += r.times
    out = mixing.mixed_rows(edge_docs)
    assert out.columns == edge_docs.columns
    assert Counter(r.doc_id for r in out.select("doc_id").collect()) == +planned


def test_knapsack_fits_exactly():
    rng = np.random.default_rng(4)
    for _ in range(20):
        lengths = np.unique(rng.integers(1, 60, 8))
        counts = rng.integers(1, 5, len(lengths))
        budget = int(rng.integers(1, (lengths * counts).sum() + 1))
        reach = {0}
        for length, count in zip(lengths.tolist(), counts.tolist(), strict=True):
            reach = {s + k * length for s in reach for k in range(count + 1)}
        take = mixing.largest_sum(lengths, counts, budget)
        assert (take <= counts).all() and (take * lengths).sum() == max(s for s in reach if s <= budget)
        assert ((fit := mixing.fit(lengths, counts, budget)) <= counts).all() and budget - (fit * lengths).sum() < 60


@pytest.mark.parametrize(
    ("lengths", "counts", "budget", "taken"),
    [
        ([100, 1_000_000], [1_000, 1], 550_000, 100_000),  # all that fit
        ([100, 1_000_000], [9_000, 1], 550_000, 550_000),
        ([70, 90_000, 400_000], [40_000, 3, 2], 1_000_030, 1_000_000),
        ([20_000, 30_000], [5, 5], 215_000, 200_000),
    ],
)
def test_fit_with_documents_longer_than_the_rest(lengths, counts, budget, taken):
    lengths, counts = np.array(lengths), np.array(counts)
    take = mixing.fit(lengths, counts, budget)
    assert (take <= counts).all() and (take * lengths).sum() == taken


def test_fit_leaves_nothing_that_fits():
    rng = np.random.default_rng(12)
    for _ in range(60):
        lengths = np.unique(rng.integers(1, 10 ** rng.integers(2, 7, 6)))
        counts = rng.integers(1, 10 ** rng.integers(1, 5, len(lengths)))
        budget = int(rng.integers(1, (lengths * counts).sum() + 1))
        take = mixing.fit(lengths, counts, budget)
        left = budget - int((take * lengths).sum())
        assert (take <= counts).all() and left >= 0 and not ((take < counts) & (lengths <= left)).any()


def test_token_files(edge_docs):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokenizer_file())
    want = defaultdict(list)
    for doc_id, text in texts(edge_docs):
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 2], "<u4")
        want[doc_id].append((len(ids), zlib.crc32(ids.tobytes())))
    got = tokenids.token_files(edge_docs, tokenizer_file()).collect()
    assert Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in got) == Counter((d, *x) for d, xs in want.items() for x in xs)
    start = 0
    for r in sorted(got, key=lambda r: r.start):
        assert r.start == start
        start += r.n_tokens
    ids = [r.doc_id for r in sorted(got, key=lambda r: r.start)]
    assert ids == sorted(ids, key=lambda d: (d is not None, d or 0))


def test_number_coding_round_trip():
    rng = np.random.default_rng(2)
    for n in (0, 1, 3, 4, 1001):
        numbers = (rng.integers(0, 1 << 32, n, dtype=np.uint64) >> rng.integers(0, 32, n, dtype=np.uint64)).astype(np.uint32)
        control, octets = tokenids.pack_numbers(numbers)
        assert len(control) == -(-n // 4)
        back = tokenids.unpack_numbers(np.frombuffer(control, np.uint8), np.frombuffer(octets, np.uint8), n)
        assert (back == numbers).all()


def test_secret_scan(edge_docs):
    got = secretscan.scan(edge_docs)
    want = Counter((d, *plain.base_spans(t)) for d, t in texts(edge_docs))
    assert rows_of(got, "doc_id", "n_assign", "n_access", "n_hex", "base_sha256") == want
    found = {r.doc_id: r.spans for r in got.collect()}
    assert found[17] == "literal:8:20"  # the constant, where it is written
    assert found[1] == "" and found[2] == ""


@pytest.mark.parametrize(
    ("text", "literals"),
    [
        ('a = "Zx81kQ9a"\nb = "77LmPq22"\nauth_token = a + b', [(5, 13), (20, 28)]),
        ('{"db": {"password": "aB3$xyz9Q!"}}', [(21, 31)]),
        ("<clientSecret>q8Zr-11kk-0aQx</clientSecret>", [(14, 28)]),
        ("export SESSION_SALT=9fK2mmQ81xZz", []),
        ('password = "changeme"', []),
        ("the token is a word: nothing more", []),
        ('password: str = "aB3$xyz9Q!kk"', [(17, 29)]),
        ("private password?: string | undefined = 'aB3$xyz9Q!kk';", [(41, 53)]),
        ('val password: Map<String, List<String?>>? = "aB3$xyz9Q!kk"', [(45, 57)]),
        ('static PASSWORD: &\'static str = "aB3$xyz9Q!kk";', [(33, 45)]),
        ('part: Final[str] = "Zx81kQ9a77Lm"\napi_secret: str = part', [(20, 32)]),
        ("args: password=Zx81kQ9a77Lm", [(15, 27)]),
        ('config["password"] = "aB3$xyz9Q!kk"', [(22, 34)]),
        ("os.environ['API_SECRET'] = 'aB3$xyz9Q!kk'", [(28, 40)]),
        ('config["db"][ "password" ] = "aB3$xyz9Q!kk"', [(30, 42)]),
        ('config["password"] == "aB3$xyz9Q!kk"', []),
        ("a." * 60 + 'password = "aB3$xyz9Q!kk"', [(132, 144)]),
        ("<" + "a." * 60 + "password>aB3$xyz9Q!kk</" + "a." * 60 + "password>", [(130, 142)]),
    ],
)
def test_lexer(text, literals):
    assert secretscan.lexed_literals(text) == literals


def test_near_groups(edge_docs):
    rows = [r for r in texts(edge_docs)]
    got = rows_of(ngramjoin.near_groups(edge_docs), "doc_id", "n_shingles", "component_id")
    assert got == plain.near_groups(rows)


def test_near_groups_in_cut_blocks(edge_docs):
    """Blocks of three sets: large groups are compared piece by piece."""
    docs = edge_docs.where("doc_id >= 100")
    got = rows_of(ngramjoin.near_groups(docs, most=3), "doc_id", "n_shingles", "component_id")
    assert got == plain.near_groups(texts(docs))


@pytest.mark.parametrize("n_links", [0, 1, 40, 90, 400])
def test_components(spark, n_links):
    """Chains, stars and dense graphs; node names in no order along them."""
    rng = np.random.default_rng(n_links)
    name = rng.permutation(120).tolist()
    pairs = [(name[k], name[k + 1]) for k in range(60) if k % 20 and n_links] + [(name[70], name[k]) for k in range(71, 90) if n_links]
    pairs += [(name[a], name[b]) for a, b in rng.integers(90, 120, (n_links, 2)).tolist()]
    root = list(range(120))
    for _ in range(120):
        for a, b in pairs:
            root[a] = root[b] = min(root[a], root[b])
    got = components(spark.createDataFrame(pairs, "u long, v long")).collect()
    assert Counter((r.node, r.root) for r in got) == Counter((k, root[k]) for k in range(120) if root[k] != k)


def test_units_encode_like_whole_texts():
    from tokenizers import Tokenizer

    definition = Path(tokenizer_file()).read_text(encoding="utf-8")
    whole, encoder, rng = Tokenizer.from_str(definition), tokenids.UnitEncoder(definition, "<u2"), np.random.default_rng(9)
    parts = [*"ab's1.!, \n\t\r\x1c\x85", "  ", "é", "☃", "日本", "'ll", "<|endoftext|>"]
    some = ["".join(rng.choice(parts, rng.integers(0, 25))) for _ in range(3000)]
    want = [np.array([*whole.encode(t, add_special_tokens=False).ids, 2], "<u2").tobytes() for t in some]
    got = [ids for k in range(0, len(some), 100) for ids in encoder.encode(some[k:k + 100], want[0][-2:])]
    assert got == want


def test_tree_finds_every_link():
    rng = np.random.default_rng(6)
    base = rng.integers(0, 1 << 60, 60, dtype=np.uint64)
    sets = [np.unique(np.append(rng.choice(base, rng.integers(30, 60), replace=False), rng.integers(0, 99, 3).astype(np.uint64))) for _ in range(50)]
    sizes = np.array([len(s) for s in sets])
    want = {
        (a, b) for a in range(50) for b in range(a)
        if 100 * (k := len(np.intersect1d(sets[a], sets[b]))) >= 75 * (len(sets[a]) + len(sets[b]) - k)
    }
    got = list(ngramjoin.block_links(sets, sizes, None, 75, True))
    assert {(max(p), min(p)) for p in got} == want and len(got) == len(want)
    left = np.arange(50) < 20
    across = {(max(p), min(p)) for p in ngramjoin.block_links(sets, sizes, left, 75, True)}
    assert across == {p for p in want if left[p[0]] != left[p[1]]}


def test_one_of_each_keeps_columns(edge_docs):
    out = ngramjoin.one_of_each(edge_docs)
    assert out.columns == edge_docs.columns
    want = {d for d, _, c in plain.near_groups(texts(edge_docs)) if d == c} - {None}
    assert {r.doc_id for r in out.collect()} - {None} == want


def test_decontamination(spark, edge_docs):
    rng = np.random.default_rng(8)
    passage = [f"bench{k}" for k in rng.permutation(40)]
    changed = [w if k % 5 else "other" for k, w in enumerate(passage)]
    short = "eight words make an item of few words".split()
    bench = spark.createDataFrame(
        [(1, " ".join(passage)), (2, " ".join(short)), (3, "too short"), (4, None), (5, " ".join(passage[:20]) + " tail " * 12)],
        "item_id long, text string",
    )
    hot = [(1000 + k, "before it " + " ".join(passage).upper().replace(" ", ", ") + " and after", "en") for k in range(80)]
    more = [(2000, " ".join(changed), "en"), (2001, "x " + " ".join(short) + " y", "en"), (2002, " ".join(passage[:9]), "en"), (2003, "too short", "en")]
    docs = edge_docs.unionByName(spark.createDataFrame(hot + more, "doc_id long, text string, lang string"), allowMissingColumns=True)
    found = {r.doc_id: r for r in decontaminate.contaminated(docs, bench).collect()}
    assert set(found) == {*range(1000, 1080), 2000, 2001}
    assert found[1000].item_id == 1 and (found[1000].word_start, found[1000].word_end) >= (2, 2)
    kept = decontaminate.clean_rows(docs, bench)
    assert kept.columns == docs.columns
    assert Counter(r.doc_id for r in kept.collect()) == Counter(d for d, _ in texts(docs) if d not in found)


def test_short_items_with_substituted_words(spark):
    """Copies of items of 8 to 19 words with 0 to 2 substitutions everywhere, and 3 to 5 at random, against brute force."""
    rng = np.random.default_rng(21)
    items = {n: [f"i{n}w{k}" for k in range(n)] for n in range(8, 20)}
    docs, want = [], set()
    for n, words in items.items():
        sets = [(), *((a,) for a in range(n)), *((a, b) for a in range(n) for b in range(a))]
        sets += [tuple(rng.choice(n, k, replace=False).tolist()) for k in (3, 4, 5) for _ in range(15)]
        for gone in sets:
            copy = [f"x{len(docs)}" if k in gone else w for k, w in enumerate(words)]
            if 4 * (n - len(gone)) >= 3 * n:
                want.add((len(docs), n, n - len(gone)))
            docs.append((len(docs), " ".join(["b"] * int(rng.integers(0, 4)) + copy + ["a"] * int(rng.integers(0, 4)))))
    bench = spark.createDataFrame([(n, " ".join(w)) for n, w in items.items()], "item_id long, text string")
    got = decontaminate.contaminated(spark.createDataFrame(docs, "doc_id long, text string"), bench).collect()
    found = {(r.doc_id, r.item_id, r.matched) for r in got}
    # Of items of 18 and 19 words, 13 equal words close together are enough too.
    assert want <= found and all(n > 17 and matched >= 13 for _, n, matched in found - want)
    for r in got:
        if (r.doc_id, r.item_id, r.matched) not in want:
            continue
        equal = [w.startswith("i") for w in docs[r.doc_id][1].split()]
        assert sum(equal[r.word_start:r.word_end]) == sum(equal) and equal[r.word_start] and equal[r.word_end - 1]


def test_every_third_word_substituted(spark):
    """What the first mask is there for passes verification, whichever third it is; every second word doesn't."""
    items = {n: [f"i{n}w{k}" for k in range(n)] for n in (24, 40, 63)}
    bench = spark.createDataFrame([(n, " ".join(w)) for n, w in items.items()], "item_id long, text string")
    rows = [(100 * n + 10 * step + at, " ".join("x" if k % step == at else w for k, w in enumerate(words)))
            for n, words in items.items() for step in (2, 3) for at in range(step)]
    got = decontaminate.contaminated(spark.createDataFrame(rows, "doc_id long, text string"), bench).collect()
    assert {(r.doc_id, r.item_id) for r in got} == {(100 * n + 30 + at, n) for n in items for at in range(3)}


def test_decontamination_by_exact_search(spark):
    docs, bench = (spark.read.parquet(f"{SF_SMALL}/{t}.parquet") for t in ("documents", "benchmark"))
    items = [" " + " ".join(plain.words_only(r.text)) + " " for r in bench.collect()]
    want = {d for d, t in texts(docs) if any(i in f" {' '.join(plain.words_only(t))} " for i in items)}
    assert {r.doc_id for r in decontaminate.contaminated(docs, bench).collect()} == want


def test_language_edge_cases(spark, edge_docs):
    docs = with_types(edge_docs, doc_id="long", text="string", lang="string")
    model = langid.learn(docs.where(remainder("doc_id", 4) != 2))
    got = langid.identify(edge_docs, model, F.struct("doc_id", "text")).select("row.*", "lang_pred", "score").collect()
    assert len(got) == edge_docs.count()
    for r in got:
        letters = any(c.isalpha() for c in r.text or "")
        assert (r.lang_pred == "und") == (not letters) and 0 <= r.score <= 1
    assert {r.lang_pred for r in langid.identify(edge_docs, None, F.col("doc_id")).collect()} == {"und"}
    kept = langid.identified_rows(edge_docs, model, 0.0)
    assert kept.columns == edge_docs.columns and kept.count() == sum(r.lang_pred != "und" for r in got)


def test_language_windows_cover_every_byte():
    data, offsets = np.arange(1000, dtype=np.uint8), np.array([0, 0, 3, 128, 1000])
    starts, ends, first = langid.cut_windows(data, offsets)
    for t in range(4):
        mine = slice(first[t], first[t + 1])
        spans = list(zip(starts[mine], ends[mine], strict=True))
        assert spans[0][0] == offsets[t] and spans[-1][1] == offsets[t + 1]
        assert all(b[0] == a[1] - (max(langid.WIDTHS) - 1) for a, b in zip(spans, spans[1:], strict=False))


def test_language_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = queries()["op1_language_id"](spark, "/root/testdata/sf0.01").where("held_out").join(docs, "doc_id")
    right, n = got.agg(F.sum((F.col("lang") == F.col("lang_pred")).cast("int")), F.count("*")).first()
    assert n > 200 and right >= 0.97 * n


def test_toxicity_held_out_accuracy(spark):
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    got = queries()["op9_toxicity"](spark, "/root/testdata/sf0.1").where("held_out").join(labels, "doc_id")
    right, n, hits, toxic = got.agg(
        F.sum((F.col("predicted") == F.col("toxic")).cast("int")), F.count("*"), F.sum(F.col("predicted") * F.col("toxic")), F.sum("toxic")
    ).first()
    assert right >= 0.96 * n and hits >= 0.85 * toxic


def test_toxicity_edge_cases(spark, edge_docs):
    words = ["calm", "green", "river", "stone", "bird"]
    rows = [(5000 + k, " ".join(words[(k + j) % 5] for j in range(30)) + (" vilest" if k % 3 == 0 else ""), "en") for k in range(300)]
    docs = edge_docs.unionByName(spark.createDataFrame(rows, "doc_id long, text string, lang string"), allowMissingColumns=True)
    labels = spark.createDataFrame([(d, 1, int("vilest" in t)) for d, t, _ in rows] + [(None, 1, 1), (5000, 1, None)], "doc_id long, quality long, toxic long")
    model = toxicity.learn(docs, labels, remainder("doc_id", 3) == 1)
    got = {r.doc_id: r for r in toxicity.score(docs, model).collect()}
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in got.values())
    assert all(got[d].predicted == int("vilest" in t) for d, t, _ in rows) and got[1].predicted == 0
    assert toxicity.learn(docs, labels.where("toxic = 0"), remainder("doc_id", 3) == 1) is None


def test_empty_tables(spark, no_docs):
    bench = spark.createDataFrame([], "item_id long, text string")
    labels = spark.createDataFrame([], "doc_id long, quality long, toxic long")
    assert langid.learn(no_docs) is None and toxicity.learn(no_docs, labels, remainder("doc_id", 3) == 1) is None
    for df in (
        langid.identified_rows(no_docs, None, 0.4), decontaminate.contaminated(no_docs, bench), linededup.deduplicate_lines(no_docs),
        mixing.mix(no_docs), mixing.mixed_rows(no_docs), tokenids.token_files(no_docs, tokenizer_file()), exactdedup.deduplicate(no_docs),
        secretscan.scan(no_docs), toxicity.score(no_docs, None), ngramjoin.near_groups(no_docs),
    ):
        assert df.count() == 0


def test_registered_columns(spark):
    want = {
        "op3_line_dedup": ["doc_id", "n_lines", "n_dropped", "kept_sha256"],
        "op8_secret_scan": ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"],
        "op9_toxicity": ["doc_id", "held_out", "score", "predicted"],
    }
    for name, columns in want.items():
        assert queries()[name](spark, SF_SMALL).columns[:len(columns)] == columns


def test_near_groups_of_several_large_components(spark):
    """Groups of near copies, chains of drifting texts and strangers that share rare shingles, with pieces of two to forty sets."""
    rng = random.Random(8)
    words = lambda n, of: [rng.choice(of) for _ in range(n)]
    common = words(14, [f"c{k}" for k in range(40)])
    rows = []
    for group in range(3):
        base = common + words(60 + 30 * group, [f"g{group}x{k}" for k in range(200)])
        for _ in range(30):
            text = list(base)
            text[rng.randrange(14, len(text))] = f"n{len(rows)}"
            rows.append((len(rows), " ".join(text)))
    drift = common + words(50, [f"d{k}" for k in range(90)])
    for step in range(25):
        drift = [*drift[:14], *drift[16:], f"s{step}", f"t{step}"]
        rows.append((len(rows), " ".join(drift)))
    for _ in range(30):
        rows.append((len(rows), " ".join(common + words(rng.choice([20, 45, 80]), [f"u{k}" for k in range(900)]))))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    wanted = plain.near_groups(rows)
    for most in (2, 7, 40):
        assert rows_of(ngramjoin.near_groups(docs, most=most), "doc_id", "n_shingles", "component_id") == wanted, most

"""DuckDB statements for the operators that SQL can express."""

from __future__ import annotations

_SPACE_CLASS = r"[\x20\x09-\x0D]"
_TRIMMED = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

LINE_DEDUP = f"""
WITH split AS (
  SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents
), lines AS (
  SELECT doc_id, unnest(parts) AS line, generate_subscripts(parts, 1) AS place FROM split
), keyed AS (
  SELECT *, translate(trim(line, {_TRIMMED}), '{_UPPER}', '{_LOWER}') AS key FROM lines
), owners AS (
  SELECT key, min(doc_id) AS owner FROM keyed WHERE length(key) >= 10 GROUP BY key
), marked AS (
  SELECT keyed.*, coalesce(owner <> doc_id, false) AS dropped FROM keyed LEFT JOIN owners USING (key)
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (dropped) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (NOT dropped), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""

EXACT_DEDUP = f"""
WITH plain AS (
  SELECT doc_id, length(coalesce(text, '')) AS points,
         regexp_replace(coalesce(text, ''), '{_SPACE_CLASS}', '', 'g') AS body FROM documents
), best AS (
  SELECT body, count(*) AS group_size, first(doc_id ORDER BY points DESC, doc_id) AS keep_id FROM plain GROUP BY body
)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(body) AS text_sha256
FROM plain JOIN best USING (body)
"""

WARC = """
WITH payloads AS (
  SELECT page_id, coalesce(html, '') AS body FROM pages
), firsts AS (
  SELECT body, min(page_id) AS first_id FROM payloads GROUP BY body
), digests AS (
  SELECT *, list_reduce(list_transform(string_split(sha1(body), ''), lambda d:
           substr('0000000100100011010001010110011110001001101010111100110111101111',
                  (instr('0123456789abcdef', d) - 1) * 4 + 1, 4)), lambda a, b: a || b) AS bits
  FROM payloads JOIN firsts USING (body)
)
SELECT page_id, strlen(body) AS payload_bytes,
       list_reduce(list_transform(range(32), lambda k:
         substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                1 + 16 * substr(bits, 5 * k + 1, 1)::INT + 8 * substr(bits, 5 * k + 2, 1)::INT + 4 * substr(bits, 5 * k + 3, 1)::INT
                  + 2 * substr(bits, 5 * k + 4, 1)::INT + substr(bits, 5 * k + 5, 1)::INT, 1)), lambda a, b: a || b) AS payload_digest,
       CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = first_id THEN NULL ELSE first_id END AS refers_to
FROM digests
"""

NGRAM_JOIN = rf"""
WITH RECURSIVE worded AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\x20\x09-\x0D]+') AS words
  FROM documents
), shingles AS (
  SELECT DISTINCT doc_id, array_to_string(words[k:least(k + 4, len(words))], ' ') AS shingle
  FROM (SELECT doc_id, words, unnest(range(1, greatest(len(words) - 4, 1) + 1)) AS k FROM worded WHERE len(words) > 0)
), sizes AS (
  SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), common AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS both_have
  FROM shingles x JOIN shingles y ON x.shingle = y.shingle AND x.doc_id <> y.doc_id GROUP BY ALL
), links AS (
  SELECT a, b FROM common JOIN sizes sa ON sa.doc_id = a JOIN sizes sb ON sb.doc_id = b
  WHERE 100 * both_have >= 75 * (sa.n + sb.n - both_have)
), reach(doc_id, other) AS (
  SELECT doc_id, doc_id FROM documents
  UNION
  SELECT reach.doc_id, links.b FROM reach JOIN links ON links.a = reach.other
)
SELECT reach.doc_id, coalesce(any_value(n), 0) AS n_shingles, min(other) AS component_id
FROM reach LEFT JOIN sizes ON sizes.doc_id = reach.doc_id GROUP BY reach.doc_id
"""


SUBSTRING_DEDUP = r"""
WITH texts AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents
), starts AS (
  SELECT doc_id, k, array_to_string(words[k:k + 12], ' ') AS body
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 11)) AS k FROM texts)
), firsts AS (
  SELECT body, min(doc_id) AS first_id FROM starts GROUP BY body
), covered AS (
  SELECT DISTINCT doc_id, unnest(range(k, k + 13)) AS place FROM starts JOIN firsts USING (body) WHERE first_id < doc_id
), placed AS (
  SELECT doc_id, unnest(words) AS word, generate_subscripts(words, 1) AS place FROM texts
), left_over AS (
  SELECT doc_id, count(*) AS n_kept, string_agg(word, ' ' ORDER BY place) AS kept
  FROM placed ANTI JOIN covered USING (doc_id, place) GROUP BY doc_id
)
SELECT doc_id, len(words) AS n_words, len(words) - coalesce(n_kept, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM texts LEFT JOIN left_over USING (doc_id)
"""


def _crc32(text: str) -> str:
    """Unsigned CRC-32 of a text's UTF-8 bytes. The table's entry of a byte is the sum of the entries of its bits."""
    entries = []
    for bit in range(8):
        value = 1 << bit
        for _ in range(8):
            value = (value >> 1) ^ (0xEDB88320 if value & 1 else 0)
        entries.append(value)
    low = "(xor(c, b) & 255)"
    table = "0::BIGINT"
    for bit, entry in enumerate(entries):
        table = f"xor({table}, (({low} >> {bit}) & 1) * {entry}::BIGINT)"
    digits = "'0123456789ABCDEF'"
    data = (
        f"list_transform(range(strlen({text})), lambda k: ((instr({digits}, substr(hex(encode({text})), 2 * k + 1, 1)) - 1) * 16"
        f" + instr({digits}, substr(hex(encode({text})), 2 * k + 2, 1)) - 1)::BIGINT)"
    )
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, {data}), lambda c, b: xor(c >> 8, {table})), 4294967295::BIGINT)"


def _merkle(fanout: int = 16, levels: int = 7, top_levels: int = 4) -> str:
    """All groups climb ``levels`` levels, which holds for 16 ** 7 rows a source; a group of one node stays as it is."""

    def field(value: str) -> str:
        return f"coalesce(strlen({value}) || ':' || {value}, '-')"

    def leaf(text: str) -> str:
        return f"sha256({' || '.join(field(v) for v in ('doc_id::VARCHAR', 'source', 'lang', 'n_chars::VARCHAR', text))})"

    def tree(prefix: str, group: str, depth: int) -> list[str]:
        steps = []
        for k in range(depth):
            steps.append(
                f"{prefix}runs{k} AS (SELECT {group}, idx // {fanout} AS idx, any_value(n) AS n, list(digest ORDER BY idx) AS ds"
                f" FROM {prefix}{k} GROUP BY {group}, idx // {fanout})"
            )
            steps.append(
                f"{prefix}{k + 1} AS (SELECT {group}, idx, (n + {fanout - 1}) // {fanout} AS n,"
                f" CASE WHEN n = 1 THEN ds[1] ELSE sha256(array_to_string(ds, '')) END AS digest FROM {prefix}runs{k})"
            )
        return steps

    def side(level: str, place: str, before: bool) -> str:
        cut = f"ds[1:{place}]" if before else f"ds[{place} + 2:]"
        return f"CASE WHEN {level}.n > 1 THEN array_to_string({level}.{cut}, '') ELSE '' END"

    lower = f"translate(text, '{_UPPER}', '{_LOWER}')"
    steps = [
        f"leaves AS (SELECT doc_id, source, {leaf('text')} AS digest,"
        f" CASE WHEN {_crc32('doc_id::VARCHAR')} % 5 = 0 THEN {leaf(lower)} ELSE {leaf('text')} END AS altered FROM documents)",
        "d0 AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1 AS idx, count(*) OVER (PARTITION BY source) AS n FROM leaves)",
        *tree("d", "source", levels),
        f"t0 AS (SELECT 0 AS g, source, digest, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS idx, count(*) OVER () AS n FROM d{levels})",
        *tree("t", "g", top_levels),
    ]
    walked = "SELECT d0.doc_id, d0.digest AS leaf, top.digest AS subroot, top.idx AS top_idx, '' AS proof, d0.altered AS node, d0.source, d0.idx FROM d0 JOIN t0 top ON top.source IS NOT DISTINCT FROM d0.source"
    steps.append(f"w0 AS ({walked})")
    places = [(f"druns{k}", f"w.idx // {fanout ** k}", "r.source IS NOT DISTINCT FROM w.source") for k in range(levels)]
    places += [(f"truns{k}", f"w.top_idx // {fanout ** k}", "true") for k in range(top_levels)]
    for k, (runs, at, same) in enumerate(places):
        place = f"(({at}) % {fanout})"
        before, after = side("r", place, True), side("r", place, False)
        steps.append(
            f"w{k + 1} AS (SELECT w.* REPLACE (w.proof || {before} || {after} AS proof,"
            f" CASE WHEN r.n > 1 THEN sha256({before} || w.node || {after}) ELSE w.node END AS node)"
            f" FROM w{k} w JOIN {runs} r ON {same} AND r.idx = ({at}) // {fanout})"
        )
    last = f"w{len(places)}"
    return (
        "WITH " + ",\n".join(steps) + "\nSELECT doc_id, leaf, subroot, r.digest AS root, sha256(proof) AS proof_sha256,"
        f" node AS folded_root, node = r.digest AS verified FROM {last}, t{top_levels} r"
    )


SPELLING = f"""
WITH RECURSIVE runs AS (
  SELECT doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')), '{_UPPER}', '{_LOWER}') AS run FROM documents
), counted AS (
  SELECT coalesce(doc_id::VARCHAR, '') || ':' || run AS named, run, count(*) AS times FROM runs GROUP BY ALL
), hashed AS (
  SELECT run, times, {_crc32("named")} AS h FROM counted
), spelled AS (
  SELECT times, CASE WHEN h % 97 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word
  FROM hashed
), words AS (
  SELECT word, sum(times)::BIGINT AS n FROM spelled WHERE length(word) >= 5 GROUP BY word HAVING sum(times) >= 3
), gaps AS (
  SELECT word, n, k, substr(word, 1, k - 1) AS head, substr(word, k + 1) AS tail
  FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS k FROM words)
), near AS (
  SELECT x.word, y.word AS other, y.n FROM gaps x JOIN gaps y USING (k, head, tail) WHERE x.word <> y.word
  UNION SELECT x.word, y.word, y.n FROM gaps x JOIN words y ON y.word = x.head || x.tail
  UNION SELECT y.word, x.word, x.n FROM gaps x JOIN words y ON y.word = x.head || x.tail
), best AS (
  SELECT word, count(*) AS n_near, max(n) AS form_n, first(other ORDER BY n DESC, other) AS form FROM near GROUP BY word
), formed AS (
  SELECT word, words.n, coalesce(n_near, 0) AS n_near, CASE WHEN form_n >= 2 * words.n THEN form END AS form,
         CASE WHEN form_n >= 2 * words.n THEN form_n END AS form_n
  FROM words LEFT JOIN best USING (word)
), chain(word, reached) AS (
  SELECT word, word FROM formed
  UNION ALL
  SELECT chain.word, formed.form FROM chain JOIN formed ON formed.word = chain.reached WHERE formed.form IS NOT NULL
)
SELECT formed.word, formed.form, chain.reached AS root, formed.n, formed.n_near, formed.form_n
FROM formed JOIN chain ON chain.word = formed.word JOIN formed ends ON ends.word = chain.reached WHERE ends.form IS NULL
"""

SQL = {
    "op3_line_dedup": LINE_DEDUP,
    "op4_warc": WARC,
    "op7_exact_dedup": EXACT_DEDUP,
    "op10_ngram_join": NGRAM_JOIN,
    "op11_substring_dedup": SUBSTRING_DEDUP,
    "op12_merkle_manifest": _merkle(),
    "op13_spelling_variants": SPELLING,
}

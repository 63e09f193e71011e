"""Secret scan by assignment-aware lexing.

Three base patterns are always reported. The lexer adds to them: it reads
source and configuration text as statements that give a name a value
(``name = "x"``, ``name := 'x'``, ``"name": "x"``, ``name: x``,
``name: type = "x"``, ``table["name"] = "x"``, ``export NAME=x``,
``<name>x</name>``), keeps what each name stands for, and
propagates constants: a name on the right-hand side, or a sum of names and
literals, stands for the literals it leads to. A literal that reaches a name
is scored by how sensitive the name is and by the literal's shape, and is
reported as ``literal`` if the score is high enough. So a key given to
``part`` and only later to ``api_secret`` is found where it is written.

Spans are in code points, the end exclusive; each text is read whole.

Defined results: a null or empty text has no spans. Spans are ordered by
start, then kind in the order of ``KINDS``. A span of the lexer that lies
inside a base span isn't repeated.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame

from atelier.llm.staging import with_types

KINDS = ("assign", "access", "hex", "literal")

ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII
)
#: A match of the contract's pattern is a maximal run, so the least length can be part of the pattern.
ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")
HEX = re.compile(r"[0-9a-f]{16,}")
#: One of these must occur, in any case, before ASSIGN can match.
ASSIGN_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")

#: Parts of names and how sensitive they make a name.
NAME_SCORES = {
    "password": 1.0, "passwd": 1.0, "passphrase": 1.0, "pwd": 0.9, "secret": 1.0, "token": 0.9, "apikey": 1.0,
    "accesskey": 1.0, "privatekey": 1.0, "credential": 0.9, "bearer": 0.8, "auth": 0.7, "signing": 0.7,
    "encryption": 0.7, "clientsecret": 1.0, "connectionstring": 0.8, "webhook": 0.6, "salt": 0.5, "cookie": 0.5,
}
#: Literals that stand for something else.
PLACEHOLDERS = {"changeme", "example", "password", "placeholder", "secret", "undefined", "null", "none", "true", "false", "xxxxxxxx", "your_password"}
#: Of the name's and the literal's score together; the least length of a literal and of a piece of one.
MIN_SCORE = 1.5
MIN_LITERAL, MIN_PIECE = 8, 4

_QUOTED = r"""(?:"(?:[^"\\\n]|\\.)*"|'(?:[^'\\\n]|\\.)*'|`[^`\n]*`)"""
_NAME = r"[A-Za-z_$][A-Za-z0-9_$.-]*+"


def _nested(opening: str, closing: str, depth: int = 6) -> str:
    """Brackets on one line, nested up to ``depth``; without a choice, so read in one pass."""
    other = rf"[^{opening}{closing}\n=]"
    inner = rf"{opening}{other}*+{closing}"
    for _ in range(depth):
        inner = rf"{opening}(?:{other}|{inner})*+{closing}"
    return inner


_TYPE_NAME = rf"[A-Za-z_$][A-Za-z0-9_$.]*+(?:::[A-Za-z0-9_]++)*+(?:{_nested(r'\[', r'\]')}|{_nested('<', '>')})*+[?!]?"
_TYPE = rf"(?:&(?:'[a-z_]++[ \t]++)?(?:mut[ \t]++)?)?{_TYPE_NAME}(?:[ \t]*+\|[ \t]*+{_TYPE_NAME})*+"
#: A name, the bracket it may be a key in, an assignment sign, and the rest of the line up to a separator. After a
#: colon a type and its sign are looked at only (group 2), as they may be a statement of their own.
STATEMENT = re.compile(
    rf"""(?<![A-Za-z0-9_$.-])["']?({_NAME})["']?(?:[ \t]*\]|[?!](?=[ \t]*:))?[ \t]*"""
    rf"""(?:(?::=|=>|=)(?!=)[ \t]*|:(?!=)[ \t]*(?=({_TYPE}[ \t]*+=(?![=>])[ \t]*+)?))"""
)
ELEMENT = re.compile(rf"<({_NAME})(?:[ \t][^<>\n]*)?>([^<>\n]{{{MIN_LITERAL},}})</\1>")
TERM = re.compile(rf"""[ \t]*(?:({_QUOTED})|([A-Za-z0-9_$.+/=~!@%^&*-]+))""")
PLUS = re.compile(r"[ \t]*(?:\+|\.\.|\|\|)(?=[ \t\"'`A-Za-z_$])")
BARE_NAME = re.compile(rf"{_NAME}\Z")
_SENSITIVE = re.compile("|".join(sorted(NAME_SCORES)))


def name_score(name: str) -> float:
    """The most sensitive part that the name holds, separators and case aside."""
    plain = re.sub(r"[^a-z0-9]", "", name.lower())
    return max((NAME_SCORES[m] for m in _SENSITIVE.findall(plain)), default=0.0)


def literal_score(value: str) -> float:
    """0 for words and placeholders, up to 1 for long mixed strings."""
    if len(value) < MIN_LITERAL or " " in value or value.lower() in PLACEHOLDERS:
        return 0.0
    kinds = sum(any(f(c) for c in value) for f in (str.islower, str.isupper, str.isdigit, lambda c: not c.isalnum()))
    if kinds == 1 and not value.isdigit():
        return 0.0
    counts = Counter(value)
    entropy = -sum(n / len(value) * math.log2(n / len(value)) for n in counts.values())
    return min(1.0, entropy / 4) * min(1.0, len(value) / 12)


def assignments(text: str) -> list[tuple[str, list[tuple[int, int]], list[str]]]:
    """For each statement, in order: the name, the spans of its literals, the names it refers to."""
    out = []
    for found in STATEMENT.finditer(text):
        at, literals, names = found.end(2) if found[2] else found.end(), [], []
        while term := TERM.match(text, at):
            if term[1] is not None:
                literals.append((term.start(1) + 1, term.end(1) - 1))
            elif BARE_NAME.match(term[2]):
                names.append(term[2])
                literals.append(term.span(2))  # an unquoted value, unless it is a known name
            else:
                literals.append(term.span(2))
            at = term.end()
            if not (plus := PLUS.match(text, at)):
                break
            at = plus.end()
        if literals or names:
            out.append((found[1], literals, names))
    for found in ELEMENT.finditer(text):
        out.append((found[1], [found.span(2)], []))
    return out


def lexed_literals(text: str) -> list[tuple[int, int]]:
    """Spans of literals that reach a sensitive name; the pieces of a sum are judged by the sum."""
    known: dict[str, list[tuple[int, int]]] = {}
    found: set[tuple[int, int]] = set()
    for name, literals, names in assignments(text):
        spans = [s for s in literals if text[s[0]:s[1]] not in known]
        for other in names:
            spans += known.get(other, [])
        known[name] = sorted(set(spans))
        shape = literal_score("".join(text[a:b] for a, b in known[name]))
        if shape and name_score(name) + shape >= MIN_SCORE:
            found.update((a, b) for a, b in known[name] if b - a >= MIN_PIECE)
    return sorted(found)


def base_spans(text: str) -> list[tuple[int, int, str]]:
    lowered = text.lower()
    spans = []
    if any(w in lowered for w in ASSIGN_WORDS):
        spans += [(*m.span(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= 12]
    if "AKIA" in text:
        spans += [(*m.span(), "access") for m in ACCESS.finditer(text)]
    spans += [(*m.span(), "hex") for m in HEX.finditer(text)]
    return spans


def scan_text(text: str) -> tuple[list[tuple[int, int, str]], list[tuple[int, int, str]]]:
    """Base spans and all spans, each in order."""
    order = {k: i for i, k in enumerate(KINDS)}
    base = sorted(base_spans(text), key=lambda s: (s[0], order[s[2]]))
    spans = list(base)
    # Without a sensitive part of a name in the text no literal can reach one.
    if _SENSITIVE.search(re.sub(r"[-_.$]", "", text.lower())):
        for a, b in lexed_literals(text):
            if not any(x <= a and b <= y for x, y, _ in base):
                spans.append((a, b, "literal"))
    return base, sorted(spans, key=lambda s: (s[0], order[s[2]], s[1]))


def as_text(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{kind}:{a}:{b}" for a, b, kind in spans)


def _scanned(batches):
    for batch in batches:
        rows = []
        for text in batch.column("text"):
            base, spans = scan_text(text.as_py() or "")
            counts = Counter(kind for _, _, kind in base)
            rows.append((
                *(counts[k] for k in KINDS[:3]),
                hashlib.sha256(as_text(base).encode()).hexdigest(),
                as_text(spans),
                len(spans) - len(base),
            ))
        columns = list(zip(*rows, strict=True)) or [[]] * 6
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64())
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True))],
            ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_literal"],
        )


def scan(docs: DataFrame) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans and n_literal for each document."""
    rows = with_types(docs, doc_id="long", text="string")
    return rows.mapInArrow(
        _scanned, "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_literal long"
    )

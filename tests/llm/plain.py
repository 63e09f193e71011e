"""The operators' contracts in plain Python, for small inputs."""

from __future__ import annotations

import base64
import hashlib
import re
from collections import Counter, defaultdict

SPACES = " \t\n\x0b\x0c\r"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def id_rank(doc_id):
    return (doc_id is None, doc_id or 0)


def line_dedup(rows):
    owner = {}
    for doc_id, text in rows:
        for line in (text or "").split("\n"):
            key = line.strip(SPACES).translate(LOWER)
            if len(key) >= 10:
                owner[key] = min(owner.get(key, (2, 0)), id_rank(doc_id))
    out = []
    for doc_id, text in rows:
        lines = (text or "").split("\n")
        keys = [line.strip(SPACES).translate(LOWER) for line in lines]
        kept = [line for line, k in zip(lines, keys, strict=True) if len(k) < 10 or owner[k] == id_rank(doc_id)]
        out.append((doc_id, len(lines), len(lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return Counter(out)


def exact_dedup(rows):
    groups = defaultdict(list)
    for doc_id, text in rows:
        groups[re.sub(r"[\x20\x09-\x0D]", "", text or "")].append((-len(text or ""), id_rank(doc_id), doc_id))
    out = []
    for body, members in groups.items():
        best = min(members)
        for m in members:
            out.append((m[2], best[2], len(members), m == best, hashlib.sha256(body.encode()).hexdigest()))
    return Counter(out)


def archive(rows):
    first = {}
    for page_id, html in rows:
        if page_id is not None:
            first[html or ""] = min(page_id, first.get(html or "", page_id))
    out = []
    for page_id, html in rows:
        body = (html or "").encode()
        again = page_id is not None and page_id > first[html or ""]
        digest = base64.b32encode(hashlib.sha1(body).digest()).decode()
        out.append((page_id, len(body), digest, "revisit" if again else "response", first[html or ""] if again else None))
    return Counter(out)


def targets(sizes, weights=(5, 2, 1), cap=3):
    """By repeated filling, in floating point."""
    names = sorted(s for s in sizes if s is not None) + [None] * (None in sizes)
    weight = {s: weights[k % 3] for k, s in enumerate(names)}
    out, left, free = {}, float(sum(sizes.values())), set(names)
    while free:
        unit = left / sum(weight[s] for s in free)
        full = {s for s in free if unit * weight[s] > cap * sizes[s] + 1e-9}
        if not full:
            return out | {s: unit * weight[s] for s in free}
        for s in full:
            out[s] = float(cap * sizes[s])
            left -= out[s]
        free -= full
    return out


ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)


def base_spans(text):
    text = text or ""
    found = [(m.start(), 0, f"assign:{m.start()}:{m.end()}") for m in ASSIGN.finditer(text) if len(m[2]) >= 12]
    found += [(m.start(), 1, f"access:{m.start()}:{m.end()}") for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
    found += [(m.start(), 2, f"hex:{m.start()}:{m.end()}") for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 16]
    counts = Counter(k for _, k, _ in found)
    return counts[0], counts[1], counts[2], hashlib.sha256(",".join(s for _, _, s in sorted(found)).encode()).hexdigest()


def shingles(text):
    words = WORD.findall((text or "").translate(LOWER))
    if not words:
        return frozenset()
    return frozenset(tuple(words[k:k + 5]) for k in range(max(len(words) - 4, 1)))


def near_groups(rows):
    """(doc_id, set size, component) of each row; rows are nodes."""
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                root[find(a)] = find(b)
    smallest = {}
    for k, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            smallest[find(k)] = min(doc_id, smallest.get(find(k), doc_id))
    return Counter((doc_id, len(sets[k]), smallest.get(find(k))) for k, (doc_id, _) in enumerate(rows))


def words_only(text):
    return re.findall(r"[0-9A-Za-z\u0080-\U0010ffff]+", (text or "").translate(LOWER))

"""Plain-Python versions of the operators, for small tables."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", lower(text))


class Sets:
    """Union-find."""

    def __init__(self):
        self.up = {}

    def find(self, x):
        self.up.setdefault(x, x)
        while self.up[x] != x:
            x = self.up[x]
        return x

    def join(self, x, y):
        x, y = self.find(x), self.find(y)
        self.up[max(x, y)] = min(x, y)


def exact(rows):
    """rows (id, text) -> sorted (id, keep, size, kept)."""
    groups = defaultdict(list)
    for i, t in rows:
        groups[lower(t)].append(i)
    out = []
    for i, t in rows:
        own = groups[lower(t)]
        keep = max((x for x in own if x is not None), default=None)
        out.append((i, keep, len(own), i == keep))
    return sorted(out, key=str)


def shingles(text, k=5):
    w = words(text)
    return {tuple(w[j : j + k]) for j in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())


def near(rows, percent):
    """rows with distinct ids -> {id: (n, component)}."""
    sets = {i: shingles(t) for i, t in rows}
    seen, comp = defaultdict(list), Sets()
    for i in sorted(sets):
        shared = Counter()
        for s in sets[i]:
            shared.update(seen[s])
            seen[s].append(i)
        comp.find(i)
        for j, n in shared.items():
            if 100 * n >= percent * (len(sets[i]) + len(sets[j]) - n):
                comp.join(i, j)
    return {i: (len(sets[i]), comp.find(i)) for i in sets}


def substrings(rows, length=200):
    """-> sorted (id, bytes, removed, spans, sha256 of the rest)."""
    raw = [(i, (t or "").encode()) for i, t in rows]
    count = Counter(b[p : p + length] for _, b in raw for p in range(len(b) - length + 1))
    out = []
    for i, b in raw:
        mark = bytearray(len(b) + 1)
        for p in range(len(b) - length + 1):
            if count[b[p : p + length]] > 1:
                mark[p : p + length] = b"\1" * length
        spans = sum(1 for j in range(len(b)) if mark[j] and not mark[j - 1])
        kept = bytes(x for x, m in zip(b, mark) if not m)
        out.append((i, len(b), sum(mark), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def tokens(text):
    return re.findall(r"[^\W_]+", (text or "").lower())


def leaks(docs, items, overlap=0.8):
    """{(doc, item)} with the item's tokens equal on one diagonal."""
    out = set()
    for i, t in docs:
        w = tokens(t)
        for j, b in items:
            v = tokens(b)
            for d in range(1 - len(v), len(w)):
                if sum(1 for k in range(len(v)) if 0 <= d + k < len(w) and w[d + k] == v[k]) >= overlap * len(v):
                    out.add((i, j))
                    break
    return out


def dice(a, b):
    a, b = Counter(zip(a, a[1:])), Counter(zip(b, b[1:]))
    return 2 * sum((a & b).values()) / max(1, sum(a.values()) + sum(b.values()))


def repeated_words(rows, n=50):
    """{id: places of words in a run of n words that another row has too}."""
    own = {i: words(t) for i, t in rows}
    where = defaultdict(set)
    for i, w in own.items():
        for j in range(len(w) - n + 1):
            where[tuple(w[j : j + n])].add((i, j))
    out = defaultdict(set)
    for places in where.values():
        if len({i for i, _ in places}) > 1:
            for i, j in places:
                out[i].update(range(j, j + n))
    return out


def planted_words(doc_id, text):
    """The words of a text as the contract of operator 11 changes them."""
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    h = zlib.crc32(str(doc_id).encode())
    g, n = h // 10, len(w)
    if h % 10 or not n:
        return w
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return w[:a] + [w[a + (i - a) % p] for i in range(a, n)]


def _smallest_period(w):
    fail, k = [0], 0
    for x in w[1:]:
        while k and x != w[k]:
            k = fail[k - 1]
        k += x == w[k]
        fail.append(k)
    return len(w) - fail[-1]


def runs(w, min_length=24, exponent=3):
    """(start, length, period) of all runs: every stretch of words that equal
    the one ``p`` later, for every ``p``."""
    ids = {}
    a = np.array([ids.setdefault(x, len(ids)) for x in w], np.int64)
    n, out = len(a), []
    for p in range(1, n // exponent + 1):
        same = np.concatenate([[False], a[:-p] == a[p:], [False]])
        turns = np.flatnonzero(same[1:] != same[:-1])
        for s, e in zip(turns[::2].tolist(), turns[1::2].tolist(), strict=True):
            length = e - s + p
            if length >= max(min_length, exponent * p) and _smallest_period(w[s : s + length]) == p:
                out.append((s, length, p))
    return sorted(out, key=lambda r: (r[0], r[2]))


def run_row(w, min_length=24, exponent=3):
    """(number of runs, strongest, digest of runs, digest of what is left)."""
    found = runs(w, min_length, exponent)
    best = max(found, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=(None, None, None))
    gone = {i for s, length, p in found for i in range(s + p, s + length)}
    kept = " ".join(x for i, x in enumerate(w) if i not in gone)
    lines = "".join(f"{s},{length},{p}\n" for s, length, p in found)
    milli = None if best[0] is None else 1000 * best[1] // best[2]
    return (len(found), *best, milli, hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(kept.encode()).hexdigest())


PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def identifiers(text):
    """kind:start:end of the plain identifiers, by the patterns as stated."""
    out = []
    for order, (kind, pattern) in enumerate(PATTERNS.items()):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            doubled = [int(d) * (1 + i % 2) for i, d in enumerate(reversed(digits))]
            good = {
                "email": True,
                "ip": all(int(x) <= 255 for x in m[0].split(".")) if kind == "ip" else False,
                "card": 14 <= len(digits) <= 19 and sum(d - 9 * (d > 9) for d in doubled) % 10 == 0,
                "phone": 10 <= len(digits) <= 15,
            }
            if good[kind]:
                out.append((m.start(), order, f"{kind}:{m.start()}:{m.end()}"))
    return [x[2] for x in sorted(out)]


def collocations(rows, min_count=10, top=2000):
    """rows (text, lang) -> (lang, rank, phrase, a, l, r, n, score)."""
    f, n = Counter(), Counter()
    for text, lang in rows:
        for piece in re.split("[.,;:!?\x0a-\x0d]", lower(text)):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang or "und"] += len(w)
            for size in (1, 2, 3):
                f.update((lang or "und", *w[i : i + size]) for i in range(len(w) - size + 1))
    candidates = {p for p, a in f.items() if len(p) > 2 and a >= min_count}
    out = []
    for p in candidates:
        lang, a = p[0], f[p]
        if len(p) == 3 and any((q[1:3] == p[1:] or q[2:] == p[1:]) and q[0] == lang and len(q) == 4 and 100 * f[q] >= 50 * a for q in candidates):
            continue
        score, _, left, right = min((10**6 * a * a // (f[p[: k + 1]] * f[(lang, *p[k + 1 :])]), k, f[p[: k + 1]], f[(lang, *p[k + 1 :])]) for k in range(1, len(p) - 1))
        out.append((lang, -score, -a, " ".join(p[1:]).encode(), left, right))
    out.sort()
    rank, result = Counter(), []
    for lang, score, a, phrase, left, right in out:
        rank[lang] += 1
        if rank[lang] <= top:
            result.append((lang, rank[lang], phrase.decode(), -a, left, right, n[lang], -score))
    return result

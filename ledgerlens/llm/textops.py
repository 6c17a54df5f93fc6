"""Vectorised word and shingle hashes over whole batches of UTF-8 text."""

from __future__ import annotations

import numpy as np

U = np.uint64
#: 64-bit values of the 256 bytes, and multipliers of the words of a shingle.
_RNG = np.random.default_rng(20240229)
BYTE_VALUE = _RNG.integers(1, 2**63, 256, dtype=np.uint64) * U(2) + U(1)
WORD_MULT = _RNG.integers(1, 2**63, 64, dtype=np.uint64) * U(2) + U(1)
BASE = 0x9E3779B97F4A7C15
BASE_INV = pow(BASE, -1, 1 << 64)

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True

_powers: dict[str, np.ndarray] = {}


def powers(name: str, base: int, n: int) -> np.ndarray:
    """1, base, base**2, ... modulo 2**64; kept for the next call."""
    have = _powers.get(name)
    if have is None or len(have) < n:
        have = np.full(max(n, 1 << 16), base, np.uint64)
        have[0] = 1
        have = _powers[name] = np.multiply.accumulate(have)
    return have[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """Scramble 64-bit values (a bijection)."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def word_spans(data: np.ndarray, offs: np.ndarray, space: np.ndarray | None = None):
    """(starts, ends, first word of each text) of the words, which are runs
    without white space (0x20, 0x09-0x0D) inside one text."""
    n = len(data)
    if space is None:
        space = SPACE[data]
    if not n:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.zeros(len(offs), np.int64)
    before = np.empty(n, bool)
    before[0] = True
    before[1:] = space[:-1]
    before[offs[:-1][offs[:-1] < n]] = True
    after = np.empty(n, bool)
    after[-1] = True
    after[:-1] = space[1:]
    after[offs[1:] - 1] = True
    starts = np.flatnonzero(~space & before)
    ends = np.flatnonzero(~space & after) + 1
    return starts, ends, np.searchsorted(starts, offs)


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each byte span, by prefix sums of a polynomial."""
    n = len(data)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(BYTE_VALUE[data] * powers("up", BASE, n), out=total[1:])
    return mix((total[ends] - total[starts]) * powers("down", BASE_INV, n + 1)[starts])


def word_hashes(data: np.ndarray, offs: np.ndarray):
    """(hash of each word with A-Z lower-cased, first word of each text)."""
    data = LOWER[data]
    starts, ends, first = word_spans(data, offs)
    return span_hashes(data, starts, ends), first


def shingle_hashes(words: np.ndarray, first: np.ndarray, k: int = 5):
    """(hash of each k-word shingle, first shingle of each text). A text of
    fewer than k words, but at least one, has its whole sequence as one."""
    n, count = len(words), np.diff(first)
    have = np.where(count >= k, count - k + 1, np.minimum(count, 1))
    out = np.concatenate([[0], np.cumsum(have)])
    if not n:
        return np.empty(0, np.uint64), out
    at = np.arange(out[-1]) - np.repeat(out[:-1] - first[:-1], have)
    end = np.repeat(first[1:], have)
    padded = np.concatenate([words, np.zeros(k, np.uint64)])
    h = np.zeros(len(at), np.uint64)
    for j in range(k):
        h += padded[at + j] * WORD_MULT[j] if j == 0 else np.where(at + j < end, padded[at + j] * WORD_MULT[j], U(j))
    return mix(h), out

"""Periodic runs: stretches of a text that go on repeating one block of words.

A run is a stretch of consecutive words with smallest period ``q`` (words ``q``
apart are identical) that no neighbouring word extends keeping that period.
Reported are the runs of at least ``min_length`` words and ``min_exponent``
periods.

Every run holds, under one of the two orders of the words (ascending, or the
same turned round), a block of ``q`` words that is the longest Lyndon word at
its start. Phase one of suffix sorting by linear grouping refines groups of
suffixes until each holds those of one Lyndon prefix, so it gives the Lyndon
array as it stands, without a suffix array. It is done for both orders. Lyndon
words (from three periods on, those that are followed by themselves) are the
roots, and the longest common extensions of a root and the place one period
later, to both sides, make the run. Extensions are found by hashes, which can only be too long; every run is
compared word by word before it is reported.

Words that cannot lie in a run are left out before: in a run, each word lies in
a gram of ``min_length * (min_exponent - 2) // min_exponent + 1`` words that
occurs again in the run. What remains of a text are stretches that are sorted
one by one. Texts never leave their partition, and nothing is shuffled.

Defined cases: a null or empty text has no words and no runs. Rows with one id
give one row each. A text of equal words is one run of period 1. Only the id
and the text are read; other columns, whatever their names, are not used.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.common import text_chunks
from ledgerlens.llm.textops import BASE, BASE_INV, WORD_MULT, U, mix, powers, span_hashes, word_spans

RUN = "struct<start:long,length:long,period:long>"
_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
_OUT = pa.schema([("n_words", pa.int64()), ("runs", pa.list_(_RUN)), ("strongest", _RUN), ("collapsed", pa.string())])


def lyndon_lengths(symbols: np.ndarray) -> np.ndarray:
    """Length of the longest Lyndon word at each place; the end counts as
    smaller than every symbol.

    Groups of suffixes are taken in descending order. The one at hand holds the
    suffixes whose Lyndon prefix is ``u``; each looks for the nearest suffix to
    its left in a lower group, and a suffix looked for ``k`` times takes ``k``
    copies of ``u`` behind its own prefix and goes to a new group just above
    the one it leaves.
    """
    values, group = np.unique(symbols, return_inverse=True)
    n, count = len(symbols), len(values)
    by = np.split(np.argsort(group, kind="stable"), np.cumsum(np.bincount(group))[:-1])
    members = [m.tolist() for m in by]
    group = group.tolist()
    length = [1] * count
    below = list(range(-1, count - 1))
    above = [*range(1, count), -1]
    out = [0] * n
    left = [-1] * n
    g = count - 1
    while g >= 0:
        own = [i for i in members[g] if group[i] == g]
        members[g] = ()
        size = length[g]
        for i in own:
            out[i] = size
        asked: dict[int, int] = {}
        for i in own:
            j = i - 1
            while j >= 0 and out[j]:
                j = left[j]
            left[i] = j
            if j >= 0:
                asked[j] = asked.get(j, 0) + 1
        if asked:
            # the most often asked first: each new group comes directly above
            # the group its members leave, under those made before
            order = sorted(asked, key=lambda j: -asked[j]) if len(asked) > 1 else asked
            made: dict[tuple[int, int], int] = {}
            for j in order:
                old, k = group[j], asked[j]
                new = made.get((old, k))
                if new is None:
                    new = made[old, k] = len(length)
                    length.append(length[old] + k * size)
                    members.append([])
                    up = above[old]
                    above.append(up)
                    below.append(old)
                    above[old] = new
                    if up >= 0:
                        below[up] = new
                members[new].append(j)
                group[j] = new
        g = below[g]
    return np.array(out, np.int64)


class _Extensions:
    """Longest common extensions of two places of a sequence, by hashes of its
    prefixes: never too short."""

    def __init__(self, symbols: np.ndarray):
        self.n = n = len(symbols)
        self.total = np.zeros(n + 1, np.uint64)
        np.cumsum(mix(symbols.astype(np.uint64) + U(1)) * powers("up", BASE, n), out=self.total[1:])
        self.down = powers("down", BASE_INV, n + 1)

    def same(self, i: np.ndarray, j: np.ndarray, length: np.ndarray) -> np.ndarray:
        t, d = self.total, self.down
        return (t[i + length] - t[i]) * d[i] == (t[j + length] - t[j]) * d[j]

    def _longest(self, most: np.ndarray, holds) -> np.ndarray:
        low, high = np.zeros_like(most), most.copy()
        while (low < high).any():
            mid = (low + high + 1) // 2
            yes = holds(mid)
            low, high = np.where(yes, mid, low), np.where(yes, high, mid - 1)
        return low

    def right(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Equal symbols from ``i`` and ``j > i`` on."""
        return self._longest(self.n - j, lambda k: self.same(i, j, k))

    def left(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Equal symbols before ``i`` and ``j > i``."""
        return self._longest(i.copy(), lambda k: self.same(i - k, j - k, k))


def _exact(a: np.ndarray, root: int, period: int) -> tuple[int, int]:
    """(start, end) of the stretch around a root, word by word."""
    differ = np.flatnonzero(a[:-period] != a[period:])
    at = int(np.searchsorted(differ, root))
    start = int(differ[at - 1]) + 1 if at else 0
    return start, (int(differ[at]) if at < len(differ) else len(a) - period) + period


def find_runs(symbols: np.ndarray, min_length: int, min_exponent: int) -> list[tuple[int, int, int]]:
    """(start, length, period) of the runs of a sequence of integers, by start
    and period."""
    n = len(symbols)
    reach = _Extensions(symbols)
    found: dict[tuple[int, int, int], int] = {}
    for ordered in (symbols, -symbols):
        period = lyndon_lengths(ordered)
        i = np.flatnonzero(np.arange(n) + period <= n)
        if min_exponent > 2:  # then one of the run's roots is followed by itself
            i = i[i + 2 * period[i] <= n]
            i = i[reach.same(i, i + period[i], period[i])]
        p = period[i]
        start = i - reach.left(i, i + p)
        end = i + p + reach.right(i, i + p)
        long = end - start >= np.maximum(min_length, min_exponent * p)
        for run in zip(start[long].tolist(), end[long].tolist(), p[long].tolist(), i[long].tolist(), strict=True):
            found.setdefault(run[:3], run[3])
    runs = set()
    for (start, end, p), root in found.items():
        if not np.array_equal(symbols[start : end - p], symbols[start + p : end]):
            start, end = _exact(symbols, root, p)
        if end - start >= max(min_length, min_exponent * p):
            runs.add((start, end - start, p))
    return sorted(runs, key=lambda r: (r[0], r[2]))


def _open_stretches(words: np.ndarray, first: np.ndarray, gram: int, min_length: int) -> list[list[tuple[int, int]]]:
    """Per text, the stretches of at least ``min_length`` words (numbers over
    all texts) whose words all lie in a gram that the text has twice."""
    out: list[list[tuple[int, int]]] = [[] for _ in range(len(first) - 1)]
    n = len(words)
    if n < gram:
        return out
    text = np.repeat(np.arange(len(first) - 1), np.diff(first))
    at = np.arange(n - gram + 1)
    at = at[text[at] == text[at + gram - 1]]
    h = mix(text[at].astype(np.uint64) + U(1))
    for k in range(gram):
        h += words[at + k] * WORD_MULT[k % len(WORD_MULT)] * U(2 * (k // len(WORD_MULT)) + 1)
    order = np.argsort(h, kind="stable")
    sorted_h = h[order]
    twin = np.zeros(len(h), bool)
    equal = sorted_h[1:] == sorted_h[:-1]
    twin[order[1:][equal]] = True
    twin[order[:-1][equal]] = True
    depth = np.zeros(n + 1, np.int64)
    starts = at[twin]
    depth[starts] += 1  # each place starts one gram at most
    depth[starts + gram] -= 1
    inside = np.cumsum(depth[:-1]) > 0
    # a stretch ends with its text
    edge = np.zeros(n + 1, bool)
    edge[first[:-1]] = True
    opens = np.flatnonzero(inside & (edge[:-1] | ~np.concatenate([[False], inside[:-1]])))
    closes = np.flatnonzero(inside & (np.concatenate([edge[1:-1], [True]]) | ~np.concatenate([inside[1:], [False]]))) + 1
    for a, b in zip(opens.tolist(), closes.tolist(), strict=True):
        if b - a >= min_length:
            out[text[a]].append((a, b))
    return out


def _text_rows(column: pa.Array, min_length: int, min_exponent: int) -> Iterator[dict]:
    gram = min_length * (min_exponent - 2) // min_exponent + 1
    for _, _, data, offs in text_chunks(column):
        starts, ends, first = word_spans(data, offs)
        hashes = span_hashes(data, starts, ends) if len(starts) else np.empty(0, np.uint64)
        stretches = _open_stretches(hashes, first, gram, min_length)
        for t, open_ones in enumerate(stretches):
            words = data[offs[t] : offs[t + 1]].tobytes().split()
            runs, kept = [], words
            if open_ones:
                ids: dict[bytes, int] = {}
                drop = np.zeros(len(words) + 1, np.int64)
                for a, b in open_ones:
                    a, b = a - int(first[t]), b - int(first[t])
                    symbols = np.array([ids.setdefault(w, len(ids)) for w in words[a:b]], np.int64)
                    for start, length, period in find_runs(symbols, min_length, min_exponent):
                        runs.append({"start": a + start, "length": length, "period": period})
                        drop[a + start + period] += 1
                        drop[a + start + length] -= 1
                if runs:
                    kept = [words[i] for i in np.flatnonzero(np.cumsum(drop[:-1]) == 0).tolist()]
            strongest = None
            for r in runs:
                # by start, then period: only a greater exponent takes over
                if strongest is None or r["length"] * strongest["period"] > strongest["length"] * r["period"]:
                    strongest = r
            yield {"n_words": len(words), "runs": runs, "strongest": strongest, "collapsed": b" ".join(kept).decode("utf-8", "replace")}


def periodic_runs(docs: DataFrame, min_length: int = 24, min_exponent: int = 3) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): n_words, runs (start, length and
    period in words, by start, then period), strongest (the run with the
    greatest length / period, the first of equal ones) and collapsed (the words
    that no run holds after its first period, joined by one space)."""
    if min_exponent < 2 or min_length < 1:
        raise ValueError("a run has at least two periods and one word")
    base = docs.select(F.col("doc_id"), F.col("text").cast("string").alias("text"))
    kind = base.schema["doc_id"].dataType.simpleString()

    def find(batches):
        for batch in batches:
            rows = list(_text_rows(batch.column(1), min_length, min_exponent))
            if rows:
                out = pa.Table.from_pylist(rows, _OUT).combine_chunks().to_batches()[0]
                yield pa.RecordBatch.from_arrays([batch.column(0), *out.columns], names=["doc_id", *_OUT.names])

    return base.mapInArrow(find, f"doc_id {kind}, n_words long, runs array<{RUN}>, strongest {RUN}, collapsed string")

"""Exact repeated substrings: removes every byte covered by a string of
``length`` bytes that also starts anywhere else, in any document.

The work is cut so that equal strings meet without sorting all suffixes at
once:

* Each window of ``length`` bytes is assigned to its anchor, the leftmost of the
  smallest hashes of its 64-byte grams. That depends on the window's bytes only,
  so equal windows have equal anchors at equal places. Neighbouring windows with
  the same anchor form one *context*; the contexts of a text tile its windows.
* Anchors that occur once hold no repeat. The others go into a key filter of
  bounded size, and a second pass over the texts writes the contexts behind it.
* Equal contexts are counted together (with map-side combining): a context that
  occurs twice repeats as a whole, however many copies there are.
* The different contexts of an anchor are suffix-sorted, many anchors to one
  array, by linear grouping (``suffix_sort``). Bytes that no other context of the
  anchor has at the same place are cut off before, and what all of them share
  around the anchor is one symbol, so the sort sees only what tells contexts
  apart. A window repeats if the common prefix with a neighbour in the array
  covers it.
* An anchor with more than ``HOT_CONTEXTS`` different contexts does not go to
  one task: its windows are counted by a hash of their bytes, spread over all
  tasks.

The repeated windows of a document then meet its text, joined on a hash of the
text, and the rest is cut out.
"""

from __future__ import annotations

import os

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.common import KeyFilter, clustered, discard, sorted_groups, string_buffer, text_chunks, written
from ledgerlens.llm.suffix_sort import suffix_array
from ledgerlens.llm.textops import BYTE_VALUE, mix, span_hashes

GRAM = 64
#: Different contexts of an anchor that one task may sort.
HOT_CONTEXTS = 20_000
#: Symbols of one suffix array.
ARRAY_SYMBOLS = 1 << 17

_BASE = np.uint64(0x9E3779B97F4A7C15)


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """Hash of the 64-byte gram at each place that has one."""
    h, size = BYTE_VALUE[data], 1
    while size < GRAM:
        h = mix(h[:-size] * _BASE + h[size:])
        size *= 2
    return h


def contexts(data: np.ndarray, offs: np.ndarray, length: int):
    """(text number, anchor hash, bytes of the context before the anchor,
    place of the first window, number of windows) of the contexts of texts."""
    span = length - GRAM + 1  # grams in a window
    if len(data) < length:
        return [np.empty(0, np.int64)] * 5
    h = gram_hashes(data)
    bits = max(21, int(len(h)).bit_length())
    low = np.uint64((1 << bits) - 1)
    least = (h & ~low) | np.arange(len(h), dtype=np.uint64)
    size = 1
    while 2 * size <= span:
        least = np.minimum(least[:-size], least[size:])
        size *= 2
    n = len(h) - span + 1
    least = np.minimum(least[:n], least[span - size : span - size + n])
    at = (least & low).astype(np.int64)
    # windows inside one text, in runs of one anchor
    last = np.repeat(offs[1:], np.diff(offs))[:n]
    inside = np.arange(n) + length <= last
    text = np.repeat(np.arange(len(offs) - 1), np.diff(offs))[:n]
    new = np.ones(n, bool)
    new[1:] = (at[1:] != at[:-1]) | (text[1:] != text[:-1])
    first = np.flatnonzero(new & inside)
    edge = np.flatnonzero(np.concatenate([new | ~inside, [True]]))
    count = edge[np.searchsorted(edge, first, side="right")] - first
    return text[first], h[at[first]], at[first] - first, first, count


def _tail(values: list[bytes]) -> np.ndarray:
    """For each value the longest prefix it shares with any other."""
    order = sorted(range(len(values)), key=values.__getitem__)
    best = np.zeros(len(values), np.int64)
    for x, y in zip(order, order[1:]):
        n = len(os.path.commonprefix([values[x], values[y]]))
        best[x] = max(best[x], n)
        best[y] = max(best[y], n)
    return best


class _Array:
    """Contexts of several anchors, collected for one suffix array."""

    def __init__(self, length: int):
        self.length = length
        self.symbols: list[int] = []
        self.rows: list[tuple] = []  # (row, place of the core symbol, symbols before it, core bytes before and behind the anchor)
        self.anchors = 0

    def add(self, rows: list[int], texts: list[bytes], before: list[int]) -> None:
        left = [t[:b][::-1] for t, b in zip(texts, before)]
        right = [t[b + GRAM :] for t, b in zip(texts, before)]
        l_best, r_best = _tail(left), _tail(right)
        l_all, r_all = len(os.path.commonprefix(left)), len(os.path.commonprefix(right))
        core = 258 + self.anchors
        self.anchors += 1
        for row, a, b, x, y in zip(rows, left, right, l_best, r_best):
            own = [c + 2 for c in a[l_all:x][::-1]]
            self.rows.append((row, len(self.symbols) + len(own), len(own), l_all, r_all))
            self.symbols += own
            self.symbols.append(core)
            self.symbols += [c + 2 for c in b[r_all:y]]
            self.symbols.append(1)

    def repeats(self, before: np.ndarray, windows: np.ndarray) -> list[tuple[int, int, int]]:
        """(row, first window, one behind the last) of the repeated windows of
        the contexts added; ``before`` and ``windows`` by row."""
        s = np.array([*self.symbols, 0])
        sa = np.array(suffix_array(s.tolist()))
        ends = np.flatnonzero(s <= 1)
        room = ends[np.searchsorted(ends, np.arange(len(s)))] - np.arange(len(s))
        x, y = sa[:-1], sa[1:]
        most = np.minimum(room[x], room[y])
        common = np.zeros(len(x), np.int64)
        live = np.flatnonzero(most > 0)
        while len(live):
            live = live[s[x[live] + common[live]] == s[y[live] + common[live]]]
            common[live] += 1
            live = live[common[live] < most[live]]
        best = np.zeros(len(s), np.int64)
        np.maximum.at(best, x, common)
        np.maximum.at(best, y, common)
        out = []
        for row, core, own, l_all, r_all in self.rows:
            b, n = int(before[row]), int(windows[row])
            behind = GRAM + r_all  # core bytes from the anchor on
            marks = np.zeros(n, bool)
            # windows that begin inside the core: what lies behind it decides
            reach = best[core] - 1
            if reach >= 0:
                starts = np.arange(max(0, b - l_all), n)
                marks[starts] = (b - starts) + behind + reach >= self.length
            # windows that begin before it: a match that crosses the core
            for k in range(own):
                start = b - l_all - own + k
                if 0 <= start < n and best[core - own + k] > own - k:
                    total = (own - k) + l_all + behind + (best[core - own + k] - (own - k) - 1)
                    marks[start] = total >= self.length
            edge = np.flatnonzero(np.diff(np.concatenate([[0], marks.view(np.int8), [0]])))
            out += [(row, int(a), int(z)) for a, z in zip(edge[::2], edge[1::2])]
        return out


def repeated_windows(docs: DataFrame, text: str, length: int, hot_contexts: int) -> DataFrame:
    """(a, b, runs): by the key (a, b) of a text, the runs (lo, hi) of places
    where windows begin that occur elsewhere too, in order."""
    spark = docs.sparkSession
    keyed = docs.select(F.xxhash64(text).alias("a"), F.xxhash64(F.lit(1), text).alias("b"), F.col(text).alias("t"))

    def anchors(batches):
        for batch in batches:
            for _, _, data, offs in text_chunks(batch.column(0)):
                yield pa.RecordBatch.from_arrays([pa.array(contexts(data, offs, length)[1].view(np.int64))], names=["anchor"])

    common = keyed.select("t").mapInArrow(anchors, "anchor long").groupBy("anchor").count().filter("count > 1").select("anchor")
    test = KeyFilter(spark, written(common, "anchors"), "anchor").test()

    def cut(batches):
        for batch in batches:
            for x, y, data, offs in text_chunks(batch.column(2)):
                which, anchor, before, first, count = contexts(data, offs, length)
                some = test(anchor) if len(anchor) else np.empty(0, bool)
                if not some.any():
                    continue
                which, anchor, before, first, count = which[some], anchor[some], before[some], first[some], count[some]
                last = first + count - 1 + length
                own = span_hashes(data, first, last)
                raw = data.tobytes()
                rows = pa.array(which + x)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(rows),
                        batch.column(1).take(rows),
                        pa.array(anchor.view(np.int64)),
                        pa.array(own.view(np.int64)),
                        pa.array(before.astype(np.int32)),
                        pa.array((first - offs[which]).astype(np.int64)),
                        pa.array(count.astype(np.int32)),
                        pa.array([raw[p:q] for p, q in zip(first.tolist(), last.tolist())], pa.binary()),
                    ],
                    names=["a", "b", "anchor", "own", "before", "first", "windows", "bytes"],
                )

    found = keyed.mapInArrow(cut, "a long, b long, anchor long, own long, before int, first long, windows int, bytes binary")
    found = written(found, "contexts")
    distinct = found.groupBy("anchor", "own").agg(
        F.count(F.lit(1)).alias("count"), F.first("before").alias("before"), F.first("windows").alias("windows"), F.first("bytes").alias("bytes")
    )
    distinct = written(distinct, "distinct")
    sizes = distinct.groupBy("anchor").count()
    whole = distinct.filter("count > 1").select("anchor", "own", F.lit(0).alias("lo"), F.col("windows").alias("hi"))
    several = distinct.join(sizes.filter(F.col("count").between(2, hot_contexts)).select("anchor"), "anchor")

    def sort(batches):
        held = _Array(length)
        rows: list[tuple] = []

        def finished():
            before, windows = np.array([r[2] for r in rows]), np.array([r[3] for r in rows])
            got = [(*rows[r][:2], lo, hi) for r, lo, hi in held.repeats(before, windows) if rows[r][4] == 1]
            return pa.RecordBatch.from_arrays(
                [pa.array(list(c), t) for c, t in zip(list(zip(*got)) or [()] * 4, (pa.int64(), pa.int64(), pa.int32(), pa.int32()))],
                names=["anchor", "own", "lo", "hi"],
            )

        for t in sorted_groups(batches, ["anchor"]):
            at = len(rows)
            group = list(zip(*(t.column(c).to_pylist() for c in ("anchor", "own", "before", "windows", "count"))))
            rows += group
            if any(r[4] == 1 for r in group):
                held.add(list(range(at, len(rows))), t.column("bytes").to_pylist(), [r[2] for r in group])
            if len(held.symbols) > ARRAY_SYMBOLS:
                yield finished()
                held, rows = _Array(length), []
        if held.symbols:
            yield finished()

    sorted_ = clustered(several.select("anchor", "own", "before", "windows", "count", "bytes"), ["anchor"]).mapInArrow(
        sort, "anchor long, own long, lo int, hi int"
    )
    hot = distinct.join(sizes.filter(F.col("count") > hot_contexts).select("anchor"), "anchor")
    hot = hot.select("anchor", "own", "count", "bytes", F.explode(F.sequence(F.lit(0), F.col("windows") - 1)).alias("lo"))
    window = F.substring(F.col("bytes"), F.col("lo") + 1, F.lit(length))
    hot = hot.select("anchor", "own", "count", "lo", F.xxhash64(window).alias("g"), F.xxhash64(F.lit(1), window).alias("h"))
    twice = hot.groupBy("anchor", "g", "h").agg(F.sum("count").alias("n")).filter("n > 1").select("anchor", "g", "h")
    single = hot.join(twice, ["anchor", "g", "h"], "left_semi").select("anchor", "own", "lo", (F.col("lo") + 1).alias("hi"))
    runs = written(whole.unionByName(sorted_).unionByName(single), "runs")
    discard(distinct)
    places = found.select("a", "b", "anchor", "own", "first").join(runs, ["anchor", "own"])
    places = places.select("a", "b", (F.col("first") + F.col("lo")).alias("lo"), (F.col("first") + F.col("hi")).alias("hi")).distinct()
    by_text = written(places.groupBy("a", "b").agg(F.array_sort(F.collect_list(F.struct("lo", "hi"))).alias("runs")), "removals")
    discard(found)
    discard(runs)
    return by_text


def remove_repeats(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 200, hot_contexts: int = HOT_CONTEXTS
) -> DataFrame:
    """Per row: the id, ``n_bytes`` of its text in UTF-8, ``spans`` (maximal
    removed runs as (first byte, one behind the last), in order) and ``kept``
    (the remaining bytes).

    All occurrences go, the first included; overlaps count, in one document
    too; strings are judged on the input. A null text is empty. Texts shorter
    than ``length`` are kept whole. Rows that repeat an id, or a text, are rows
    of their own. An empty table gives an empty result.
    """
    if length < 2 * GRAM:
        raise ValueError(f"length must be at least {2 * GRAM}")
    rows = docs.select(docs[id_col].alias("_id"), F.coalesce(docs[text_col], F.lit("")).alias("_t"))
    by_text = repeated_windows(rows, "_t", length, hot_contexts).select(F.col("a").alias("_a"), F.col("b").alias("_b"), "runs")
    keyed = rows.select("_id", "_t", F.xxhash64("_t").alias("_x"), F.xxhash64(F.lit(1), "_t").alias("_y"))
    met = keyed.join(by_text, (F.col("_x") == F.col("_a")) & (F.col("_y") == F.col("_b")), "left").select("_id", "_t", "runs")
    id_type = docs.schema[id_col].dataType.simpleString()

    def cut(batches):
        for batch in batches:
            data, offs = string_buffer(batch.column(1))
            kept, sizes, spans = [], np.diff(offs), []
            for x, y, runs in zip(offs.tolist(), offs[1:].tolist(), batch.column(2).to_pylist()):
                parts, own, at = [], [], 0
                for r in runs or ():
                    lo, hi = r["lo"], r["hi"] - 1 + length
                    if own and lo <= own[-1][1]:
                        own[-1][1] = max(own[-1][1], hi)
                    else:
                        own.append([lo, hi])
                for lo, hi in own:
                    parts.append(data[x + at : x + lo].tobytes())
                    at = hi
                parts.append(data[x + at : y].tobytes())
                kept.append(b"".join(parts))
                spans.append([{"lo": lo, "hi": hi} for lo, hi in own])
            item = pa.list_(pa.struct([("lo", pa.int64()), ("hi", pa.int64())]))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(spans, item), pa.array(kept, pa.binary())], names=["id", "n_bytes", "spans", "kept"]
            )

    out = met.mapInArrow(cut, f"id {id_type}, n_bytes long, spans array<struct<lo: long, hi: long>>, kept binary")
    return out.withColumnRenamed("id", id_col)

"""Phrases of two and three words that occur together more often than their
parts suggest, per language, from exact counts.

1. ``shards``: texts are cut into words once, in blocks of ``BLOCK_BYTES``; a
   block is a list of its distinct (language, word) pairs with counts, and the
   sequence of its words as places in that list, 0 between pieces.
2. ``vocabulary``: the lists are summed; words that occur ``min_count`` times
   get numbers without gaps. Rarer ones cannot be part of a candidate, and
   break the sequence as the end of a piece does.
3. ``grams``: each task counts the packed numbers of its word pairs and triples
   in counting quotient filters. An invertible permutation spreads the packed
   numbers evenly; its leading bits, the quotient, are kept as unary run
   lengths, all bits behind them as the remainder, so a filter is small, loses
   nothing and is sorted. Filters are cut by their first bits into parts, whose
   number grows with the words, and the filters of one part are merged in one
   task. Frequent phrases were counted before the shuffle, so no part is hot.
4. Scores join the few phrases that reach ``min_count`` with the counts of
   their parts. All of it is exact; products are 38-digit decimals.

A word's rows in step 2 are as many as blocks hold it; the sum is combined
before its shuffle, and the join that hands out numbers has two tables as its
sides, so adaptive execution can split a word that all blocks hold.

Defined cases: null texts are empty; a null language counts as ``und``, together
with rows that say ``und``. Repeated rows count as often as they occur. Texts
without candidates give no rows. Only text and lang are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.llm.common import clustered, discard, sorted_groups, text_chunks, written
from ledgerlens.llm.textops import LOWER, U, mix, word_spans

#: Bytes of text of a block.
BLOCK_BYTES = 4 << 20
#: Distinct phrases a task holds before it writes its filters out.
HELD_ENTRIES = 1 << 19
#: Words of a block that are counted in one step.
STEP_WORDS = 1 << 17
#: Occurrences in a part of the phrases' numbers.
PART_WORDS = 1 << 19
#: Parts of a language that are ranked by themselves first; the best of so many
#: parts together next.
RANK_PARTS = (256, 16)

#: 0 for bytes of words, 1 for blanks, 2 for bytes that end a piece.
_KIND = np.zeros(256, np.uint8)
_KIND[[0x20, 0x09]] = 1
_KIND[[*b".,;:!?", *range(0x0A, 0x0E)]] = 2

_ROUNDS = [U(x) for x in (0x243F6A8885A308D3, 0x13198A2E03707344, 0xA4093822299F31D0, 0x082EFA98EC4E6C89)]


@dataclass(frozen=True)
class Layout:
    """How ``words`` word numbers of ``bits`` bits are packed: the first in a
    high half, the others in a low half of at most 64 bits. ``part_bits``
    leading bits of the permuted number tell the part."""

    words: int
    bits: int
    part_bits: int

    @property
    def low_bits(self) -> int:
        return (self.words - 1) * self.bits

    def _round(self, half: np.ndarray, by: np.ndarray, k: int, bits: int) -> np.ndarray:
        return half ^ (mix(by + _ROUNDS[k]) >> U(64 - bits))

    def permuted(self, high: np.ndarray, low: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Each half in turn is changed by a hash of the other: no two packed
        numbers meet, and ``restored`` goes back."""
        for k in (0, 2):
            high = self._round(high, low, k, self.bits)
            low = self._round(low, high, k + 1, self.low_bits)
        return high, low

    def restored(self, high: np.ndarray, low: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        for k in (2, 0):
            low = self._round(low, high, k + 1, self.low_bits)
            high = self._round(high, low, k, self.bits)
        return high, low

    def pack(self, ids: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        low = ids[1].astype(np.uint64)
        for x in ids[2:]:
            low = (low << U(self.bits)) | x.astype(np.uint64)
        return ids[0].astype(np.uint64), low

    def unpack(self, high: np.ndarray, low: np.ndarray) -> list[np.ndarray]:
        mask = U((1 << self.bits) - 1)
        rest = [(low >> U(self.bits * k)) & mask for k in range(self.words - 2, -1, -1)]
        return [x.astype(np.int64) for x in (high, *rest)]


def _bytes_of(values: np.ndarray, bits: int) -> bytes:
    size = -(-bits // 8)
    return np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :size]).tobytes()


def _values_of(data: memoryview, count: int, bits: int) -> np.ndarray:
    size = -(-bits // 8)
    wide = np.zeros((count, 8), np.uint8)
    wide[:, :size] = np.frombuffer(data, np.uint8, count * size).reshape(count, size)
    return wide.view("<u8").ravel().astype(np.uint64)


class CountingQuotientFilter:
    """Exact counters of permuted packed numbers, sorted by them."""

    def __init__(self, layout: Layout, high: np.ndarray, low: np.ndarray, counts: np.ndarray):
        self.layout, self.high, self.low, self.counts = layout, high, low, counts

    def __len__(self) -> int:
        return len(self.counts)

    @classmethod
    def summed(cls, layout: Layout, high: np.ndarray, low: np.ndarray, counts: np.ndarray | None = None) -> CountingQuotientFilter:
        """A filter of numbers in any order, each once or ``counts`` times."""
        if layout.bits + layout.low_bits <= 64:
            order = np.argsort((high << U(layout.low_bits)) | low, kind="stable")  # runs in order are merged
        else:
            order = np.lexsort((low, high))
        high, low = high[order], low[order]
        first = np.ones(len(high), bool)
        first[1:] = (high[1:] != high[:-1]) | (low[1:] != low[:-1])
        at = np.flatnonzero(first)
        if counts is None:
            counts = np.diff(np.append(at, len(high)))
        elif len(at):
            counts = np.add.reduceat(counts[order], at)
        return cls(layout, high[at], low[at], counts.astype(np.int64))

    @classmethod
    def merged(cls, filters: list[CountingQuotientFilter]) -> CountingQuotientFilter:
        if len(filters) == 1:
            return filters[0]
        parts = [np.concatenate([getattr(f, x) for f in filters]) for x in ("high", "low", "counts")]
        return cls.summed(filters[0].layout, *parts)

    def parts(self) -> Iterator[tuple[int, bytes]]:
        """(part, bytes) of the filter cut by its leading bits."""
        of = (self.high >> U(self.layout.bits - self.layout.part_bits)).astype(np.int64)
        cuts = np.flatnonzero(np.diff(of)) + 1
        for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(of)], strict=True):
            if b > a:
                yield int(of[a]), self._to_bytes(a, b)

    def _to_bytes(self, a: int, b: int) -> bytes:
        own = self.layout.bits - self.layout.part_bits
        slots = min(own, (b - a).bit_length())  # quotient bits: about a slot for each number
        rest = own - slots
        high = self.high[a:b] & U((1 << own) - 1)
        quotient = (high >> U(rest)).astype(np.int64)
        runs = np.zeros((1 << slots) + b - a, np.uint8)  # a 1 for each number, a 0 behind each slot
        runs[quotient + np.arange(b - a)] = 1
        counts = self.counts[a:b]
        large = counts[counts >= 255]
        return b"".join([
            np.array([b - a, slots], "<u4").tobytes(),
            np.packbits(runs).tobytes(),
            _bytes_of(high & U((1 << rest) - 1), rest),
            _bytes_of(self.low[a:b], self.layout.low_bits),
            np.minimum(counts, 255).astype(np.uint8).tobytes(),
            large.astype("<i8").tobytes(),
        ])

    @classmethod
    def from_bytes(cls, layout: Layout, part: int, data: bytes) -> CountingQuotientFilter:
        n, slots = np.frombuffer(data, "<u4", 2).tolist()
        view, at = memoryview(data), 8
        own = layout.bits - layout.part_bits
        rest = own - slots

        def take(size: int) -> memoryview:
            nonlocal at
            at += size
            return view[at - size : at]

        total = (1 << slots) + n
        runs = np.unpackbits(np.frombuffer(take(-(-total // 8)), np.uint8), count=total)
        quotient = (np.flatnonzero(runs) - np.arange(n)).astype(np.uint64)
        high = (U(part) << U(own)) | (quotient << U(rest)) | _values_of(take(n * -(-rest // 8)), n, rest)
        low = _values_of(take(n * -(-layout.low_bits // 8)), n, layout.low_bits)
        counts = np.frombuffer(take(n), np.uint8).astype(np.int64)
        large = np.frombuffer(view[at:], "<i8")
        counts[counts == 255] = large
        return cls(layout, high, low, counts)

    def at_least(self, least: int) -> tuple[list[np.ndarray], np.ndarray]:
        """The word numbers and counts of phrases that occur so often."""
        keep = self.counts >= least
        return self.layout.unpack(*self.layout.restored(self.high[keep], self.low[keep])), self.counts[keep]


# ---------------------------------------------------------------------------

SHARD = "block long, pos int, lang string, word binary, n long, codes binary"
_SHARD = pa.schema([("block", pa.int64()), ("pos", pa.int32()), ("lang", pa.string()), ("word", pa.binary()), ("n", pa.int64()), ("codes", pa.binary())])


def _block(langs: pa.Array, data: np.ndarray, offs: np.ndarray) -> tuple[pa.Array, pa.Array, np.ndarray, np.ndarray] | None:
    """(language, word, count) of the distinct pairs of some texts, and their
    words as places (from 1) in that list, 0 between pieces."""
    data = LOWER[data]
    kind = _KIND[data]
    starts, ends, first = word_spans(data, offs, kind > 0)
    if not len(starts):
        return None
    body = data[kind == 0]
    bounds = np.concatenate([[0], np.cumsum(ends - starts)])
    words = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(bounds.tobytes()), pa.py_buffer(body.tobytes())]).dictionary_encode()
    text = np.repeat(np.arange(len(first) - 1), np.diff(first))
    names = langs.dictionary_encode()
    size = len(words.dictionary)
    pair = names.indices.to_numpy().astype(np.int64)[text] * size + words.indices.to_numpy()
    pairs, place, counts = np.unique(pair, return_inverse=True, return_counts=True)
    ended = np.cumsum(kind == 2, dtype=np.int32)[starts]
    cut = np.flatnonzero((text[1:] != text[:-1]) | (ended[1:] != ended[:-1])) + 1
    codes = np.insert((place + 1).astype("<u4"), cut, 0)
    return names.dictionary.take(pa.array(pairs // size)), words.dictionary.take(pa.array(pairs % size)).cast(pa.binary()), counts, codes


def _shards(batches):
    block = TaskContext.get().partitionId() << 33
    for batch in batches:
        langs = batch.column(0)
        for i, j, data, offs in text_chunks(batch.column(1), BLOCK_BYTES):
            made = _block(langs.slice(i, j - i), data, offs)
            if made is None:
                continue
            lang, word, counts, codes = made
            n = len(counts)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(n, block)), pa.array(np.arange(1, n + 1, dtype=np.int32)), lang, word, pa.array(counts), pa.nulls(n, pa.binary())], schema=_SHARD
            )
            one = {"block": [block], "pos": [0], "lang": [None], "word": [None], "n": [n], "codes": [codes.tobytes()]}
            yield pa.RecordBatch.from_pydict(one, schema=_SHARD)
            block += 1


def _numbered(words: DataFrame) -> tuple[DataFrame, int]:
    """(lang, word, f, id) and the number of words: ids from 1 on without
    gaps, counted on from the sizes of the table's parts (one number each)."""
    inside = F.monotonically_increasing_id()
    table = written(words.withColumns({"part": F.shiftright(inside, 33), "row": inside.bitwiseAND(F.lit((1 << 33) - 1))}), "vocabulary")
    sizes = table.groupBy("part").count().orderBy("part").collect()  # one row for each task
    offsets, total = [], 0
    for r in sizes:
        offsets.append((r["part"], total))
        total += r["count"]
    before = words.sparkSession.createDataFrame(offsets, "part long, before long")
    numbered = table.join(F.broadcast(before), "part")
    return numbered.select("lang", "word", "f", (F.col("before") + F.col("row") + 1).alias("id")), total


def _gram_parts(layouts: dict[int, Layout]):
    def count(batches):
        held: dict[int, list[CountingQuotientFilter]] = {n: [] for n in layouts}

        def rows(n: int):
            whole = CountingQuotientFilter.merged(held[n])
            held[n] = []
            parts = list(whole.parts())
            for a in range(0, len(parts), 256):
                some = parts[a : a + 256]
                yield pa.RecordBatch.from_pydict(
                    {"n": [n] * len(some), "part": [p for p, _ in some], "filter": [x for _, x in some]},
                    schema=pa.schema([("n", pa.int32()), ("part", pa.int64()), ("filter", pa.binary())]),
                )

        for batch in batches:
            for size, codes, pos, ids in zip(*(batch.column(k) for k in range(4)), strict=True):
                number = np.zeros(size.as_py() + 1, np.int64)
                number[pos.values.to_numpy()] = ids.values.to_numpy()
                codes = np.frombuffer(codes.as_buffer(), "<u4")
                for begin in range(0, len(codes), STEP_WORDS):
                    for n, layout in layouts.items():
                        seq = number[codes[begin : begin + STEP_WORDS + n - 1]]
                        size = len(seq) - n + 1
                        at = np.flatnonzero(np.all([seq[k : size + k] > 0 for k in range(n)], axis=0)) if size > 0 else seq[:0]
                        if not len(at):
                            continue
                        numbers = layout.permuted(*layout.pack([seq[at + k] for k in range(n)]))
                        held[n].append(CountingQuotientFilter.summed(layout, *numbers))
                        if sum(map(len, held[n])) > HELD_ENTRIES:
                            held[n] = [CountingQuotientFilter.merged(held[n])]
                            if len(held[n][0]) > HELD_ENTRIES // 2:
                                yield from rows(n)
        for n in layouts:
            if held[n]:
                yield from rows(n)

    return count


def _merge_parts(layouts: dict[int, Layout], min_count: int):
    schema = pa.schema([("w1", pa.int64()), ("w2", pa.int64()), ("w3", pa.int64()), ("a", pa.int64())])

    def merge(batches):
        for group in sorted_groups(batches, ["n", "part"]):
            n, part = group.column("n")[0].as_py(), group.column("part")[0].as_py()
            filters = [CountingQuotientFilter.from_bytes(layouts[n], part, x.as_py()) for x in group.column("filter")]
            ids, counts = CountingQuotientFilter.merged(filters).at_least(min_count)
            if len(counts):
                third = pa.array(ids[2]) if n == 3 else pa.nulls(len(counts), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(ids[0]), pa.array(ids[1]), third, pa.array(counts)], schema=schema)

    return merge


def count_phrases(shards: DataFrame, vocabulary: DataFrame, n_words: int, occurrences: int, min_count: int) -> DataFrame:
    """(w1, w2, w3, a): word numbers (w3 null in pairs) and counts of the pairs
    and triples that occur ``min_count`` times."""
    bits = max(1, n_words.bit_length())
    if bits > 32:
        raise ValueError("word numbers of more than 32 bits")
    part_bits = min(bits, max(0, (occurrences // PART_WORDS).bit_length()))
    layouts = {n: Layout(n, bits, part_bits) for n in (2, 3)}
    entries = shards.filter("pos > 0").select("block", "pos", "lang", "word")
    ids = entries.join(vocabulary.select("lang", "word", "id"), ["lang", "word"]).groupBy("block").agg(
        F.collect_list(F.struct("pos", "id")).alias("known")  # at most a block's distinct words
    )
    codes = shards.filter("pos = 0").select("block", F.col("n").cast("long").alias("n"), "codes")
    blocks = codes.join(ids, "block").select("n", "codes", F.col("known.pos").alias("pos"), F.col("known.id").alias("ids"))
    parts = blocks.mapInArrow(_gram_parts(layouts), "n int, part long, filter binary")
    return clustered(parts, ["n", "part"]).mapInArrow(_merge_parts(layouts, min_count), "w1 long, w2 long, w3 long, a long")


def _score(a: Column, left: Column, right: Column) -> Column:
    wide = [x.cast("decimal(19,0)") for x in (a, left, right)]
    million = F.lit(1_000_000).cast("decimal(7,0)")
    return F.call_function("div", wide[0] * wide[0] * million, wide[1] * wide[2])


def collocations(docs: DataFrame, min_count: int = 10, top: int = 2000, inside_percent: int = 50) -> DataFrame:
    """The first ``top`` phrases of each language of ``docs`` (text, lang):
    lang, rank, phrase, a (count), l, r (counts of the parts at the cut that
    scores lowest, the first of equal ones), n (words of the language), score.

    score = floor(10**6 * a * a / (l * r)). Pairs inside a triple that reaches
    ``min_count`` and occurs ``inside_percent`` of their count are left out."""
    base = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), F.col("text").cast("string").alias("text"))
    shards = written(base.mapInArrow(_shards, SHARD), "shards")
    entries = shards.filter("pos > 0")
    totals = written(entries.groupBy("lang").agg(F.sum("n").alias("n")), "totals")  # a row for each language
    words = entries.groupBy("lang", "word").agg(F.sum("n").alias("f")).filter(F.col("f") >= min_count)
    vocabulary, n_words = _numbered(words)
    occurrences = totals.agg(F.coalesce(F.sum("n"), F.lit(0))).head()[0]
    grams = written(count_phrases(shards, vocabulary, n_words, occurrences, min_count), "grams")
    discard(shards)

    def of(i: int) -> DataFrame:
        return vocabulary.select(F.col("id").alias(f"w{i}"), F.col("word").cast("string").alias(f"word{i}"), F.col("f").alias(f"f{i}"))

    pairs = grams.filter("w3 IS NULL").select("w1", "w2", "a")
    triples = grams.filter("w3 IS NOT NULL")
    heads, tails = triples.select("w1", "w2", "a"), triples.select(F.col("w2").alias("w1"), F.col("w3").alias("w2"), "a")
    longer = written(heads.unionByName(tails).groupBy("w1", "w2").agg(F.max("a").alias("longer")), "longer")
    langs = vocabulary.select(F.col("id").alias("w1"), "lang")
    open_pairs = pairs.join(longer, ["w1", "w2"], "left").filter(F.expr(f"longer IS NULL OR 100 * longer < {inside_percent} * a")).drop("longer")
    two = open_pairs.join(of(1), "w1").join(of(2), "w2").join(langs, "w1")
    two = two.select("lang", F.concat_ws(" ", "word1", "word2").alias("phrase"), "a", F.col("f1").alias("l"), F.col("f2").alias("r"))
    two = two.withColumn("score", _score(F.col("a"), F.col("l"), F.col("r")))

    head = pairs.select("w1", "w2", F.col("a").alias("f12"))
    tail = pairs.select(F.col("w1").alias("w2"), F.col("w2").alias("w3"), F.col("a").alias("f23"))
    three = triples.join(head, ["w1", "w2"]).join(tail, ["w2", "w3"]).join(of(1), "w1").join(of(2), "w2").join(of(3), "w3").join(langs, "w1")
    cuts = [F.struct(_score(F.col("a"), F.col(x), F.col(y)).alias("score"), F.lit(k).alias("k"), F.col(x).alias("l"), F.col(y).alias("r")) for k, x, y in ((1, "f1", "f23"), (2, "f12", "f3"))]
    three = three.withColumn("cut", F.least(*cuts)).select(
        "lang", F.concat_ws(" ", "word1", "word2", "word3").alias("phrase"), "a", F.col("cut.l").alias("l"), F.col("cut.r").alias("r"), F.col("cut.score").alias("score")
    )

    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase").asc()]
    ranked = two.unionByName(three).withColumn("part", F.pmod(F.xxhash64("phrase"), F.lit(RANK_PARTS[0])))
    for parts in (RANK_PARTS[0], RANK_PARTS[0] // RANK_PARTS[1], 1):
        own = Window.partitionBy("lang", "part").orderBy(*order)
        ranked = ranked.withColumn("part", F.pmod("part", F.lit(parts))).withColumn("rank", F.row_number().over(own).cast("long")).filter(F.col("rank") <= top)
    return ranked.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")

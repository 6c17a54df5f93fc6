"""Collocations: the counting quotient filter, phrases against plain counting,
and null, empty, repeated and hot input."""

from __future__ import annotations

import random
from collections import Counter

import duckdb
import numpy as np
import pytest

from ledgerlens.llm import collocations as C
from ledgerlens.llm.oracle import COLLOCATIONS
from tests.llm import brute

DOC = "doc_id long, text string, lang string"
OUT = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


@pytest.mark.parametrize(("words", "bits", "part_bits"), [(2, 1, 0), (2, 5, 5), (3, 9, 2), (3, 21, 4), (2, 32, 6), (3, 22, 3), (3, 32, 7)])
def test_filters_lose_nothing(words, bits, part_bits):
    layout = C.Layout(words, bits, part_bits)
    rng = np.random.default_rng(bits)
    total, filters = Counter(), []
    for _ in range(4):
        pool = rng.integers(0, 1 << bits, (300, words))
        pick = pool[rng.integers(0, 300, 1500) ** 2 // 300]
        pick = np.concatenate([pick, np.repeat(pool[:1], 700, axis=0)])  # counts above a byte
        total.update(map(tuple, pick.tolist()))
        ids = [pick[:, k] for k in range(words)]
        high, low = layout.permuted(*layout.pack(ids))
        back = layout.unpack(*layout.restored(high, low))
        assert all((x == y).all() for x, y in zip(back, ids, strict=True))
        filters.append(C.CountingQuotientFilter.summed(layout, high, low))
    shards = {}
    for f in filters:
        for part, data in f.parts():
            shards.setdefault(part, []).append(C.CountingQuotientFilter.from_bytes(layout, part, data))
    got = Counter()
    for part, own in shards.items():
        merged = C.CountingQuotientFilter.merged(own)
        key = [(int(h) << layout.low_bits) | int(x) for h, x in zip(merged.high, merged.low, strict=True)]
        assert key == sorted(set(key)) and all(k >> (words * bits - part_bits) == part for k in key)
        ids, counts = merged.at_least(1)
        got.update(dict(zip(zip(*(x.tolist() for x in ids), strict=True), counts.tolist(), strict=True)))
    assert got == total


def test_permutation_spreads_neighbours():
    layout = C.Layout(2, 16, 4)
    ids = np.arange(4096)
    high, _ = layout.permuted(*layout.pack([np.zeros(4096, np.int64) + 7, ids]))
    sizes = np.bincount((high >> np.uint64(12)).astype(np.int64), minlength=16)
    assert sizes.min() > 150 and sizes.max() < 400


def _texts(seed, n, hot=0):
    rng = random.Random(seed)
    phrases = ["new york city", "red, green", "a b c d", "é è", "ROSE rose Rose", "x\ty", "one.two", "p  q r", "i! j", "u\nv w"]
    rows = []
    for i in range(n):
        w = [rng.choice(phrases) if rng.random() < 0.6 else f"w{rng.randrange(12)}" for _ in range(rng.randrange(40))]
        rows.append((i, rng.choice([" ", "  ", "\t"]).join(w), "en" if i < hot else rng.choice(["en", "de", None, "und"])))
    return rows + [(n, None, "en"), (n + 1, "", None), (n + 2, " ,. ", "fr")]


@pytest.mark.parametrize(("block", "held", "part"), [(1 << 23, 1 << 21, 1 << 21), (500, 64, 32)])
def test_collocations(spark, monkeypatch, block, held, part):
    rows = _texts(1, 150, hot=60)
    rows += rows[:20]
    for name, value in (("BLOCK_BYTES", block), ("HELD_ENTRIES", held), ("PART_WORDS", part), ("STEP_WORDS", max(3, part // 2))):
        monkeypatch.setattr(C, name, value)
    got = C.collocations(spark.createDataFrame(rows, DOC).repartition(3))
    assert got.columns == OUT
    want = brute.collocations([(t, lang) for _, t, lang in rows])
    assert sorted(map(tuple, got.collect())) == sorted(want) and len(want) > 40


def test_limits_of_the_report(spark):
    rows = _texts(2, 80)
    got = C.collocations(spark.createDataFrame(rows, DOC), min_count=3, top=7)
    assert sorted(map(tuple, got.collect())) == sorted(brute.collocations([(t, x) for _, t, x in rows], 3, 7))


def test_scores_past_64_bits(spark):
    row = spark.createDataFrame([(3_000_000_000, 4_000_000_000, 5_000_000_000)], "a long, l long, r long")
    assert row.select(C._score(row.a, row.l, row.r)).head()[0] == 10**6 * 3_000_000_000**2 // (4_000_000_000 * 5_000_000_000)


def test_empty_and_clashing_columns(spark):
    rows = [(*r, 1, "w", b"c") for r in _texts(3, 60)]
    d = spark.createDataFrame(rows, DOC + ", n int, word string, codes binary")
    assert sorted(map(tuple, C.collocations(d).collect())) == sorted(brute.collocations([(r[1], r[2]) for r in rows]))
    assert C.collocations(d.limit(0)).collect() == []
    assert C.collocations(spark.createDataFrame([(1, "a b", "en")], DOC)).collect() == []
    long = spark.createDataFrame([(1, "to be or not " * 200_000, "en")], DOC)
    assert sorted(map(tuple, C.collocations(long).collect())) == sorted(brute.collocations([("to be or not " * 200_000, "en")]))


def test_sql_twin_on_made_up_rows(spark):
    rows = _texts(4, 200)
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR, lang VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?, ?)", rows)
    cur = con.execute(COLLOCATIONS)
    assert [c[0] for c in cur.description] == OUT
    assert sorted(cur.fetchall()) == sorted(brute.collocations([(t, x) for _, t, x in rows]))

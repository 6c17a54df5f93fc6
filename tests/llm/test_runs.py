"""Periodic runs: Lyndon arrays, runs against every period tried out, the
query, and texts that are null, empty, of one word, or very long."""

from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
import pytest

from ledgerlens.llm import periodic_runs, queries
from ledgerlens.llm.common import load
from tests.llm import brute

SF0001 = "/root/testdata/sf0.001"


def blocks(rng, size, alphabet=3):
    w = []
    while len(w) < size:
        w += [f"w{rng.randrange(alphabet)}" for _ in range(rng.randrange(1, 6))] * rng.randrange(1, 12)
    return w


def test_lyndon_arrays_under_both_orders():
    rng = random.Random(3)
    for _ in range(400):
        s = np.array([rng.randrange(rng.randrange(1, 5)) for _ in range(rng.randrange(1, 40))])
        for x in (s, -s):
            v = x.tolist()
            # the next smaller suffix begins where the longest Lyndon word ends
            want = [next(j for j in range(i + 1, len(v) + 1) if v[j:] < v[i:]) - i for i in range(len(v))]
            assert periodic_runs.lyndon_lengths(x).tolist() == want


@pytest.mark.parametrize(("length", "exponent"), [(24, 3), (8, 3), (10, 4), (6, 2), (1, 2)])
def test_runs_are_all_found(length, exponent):
    rng = random.Random(length)
    texts = [" ".join(blocks(rng, rng.randrange(150))) for _ in range(120)] + [None, "", "  \n", "a", "a a", "a " * 40]
    got = list(periodic_runs._text_rows(pa.array(texts), length, exponent))
    assert len(got) == len(texts)
    for text, row in zip(texts, got, strict=True):
        w = (text or "").split()
        assert row["n_words"] == len(w)
        assert [tuple(r.values()) for r in row["runs"]] == brute.runs(w, length, exponent)


def test_extensions_that_are_too_long_are_put_right():
    a = np.array([9, 1, 2, 1, 2, 1, 2, 1, 8, 1, 2])
    assert periodic_runs._exact(a, 2, 2) == (1, 8)


def test_edge_cases_and_clashing_columns(spark):
    long = " ".join(f"a{i % 1000}" for i in range(120_000))
    rows = [(1, None), (2, ""), (3, "x " * 30), (3, "x " * 30), (4, long), (None, "y z " * 20), (5, "one two")]
    rows = [(*r, [1], "s", "c", 0) for r in rows]
    d = spark.createDataFrame(rows, "doc_id long, text string, runs array<int>, strongest string, collapsed string, n_words int")
    got = {}
    for r in periodic_runs.periodic_runs(d).collect():
        got.setdefault(r.doc_id, []).append(r)
    assert sorted(map(len, got.values())) == [1, 1, 1, 1, 1, 2]
    assert got[1][0].n_words == 0 and got[1][0].collapsed == "" and got[1][0].strongest is None
    assert got[3][0] == got[3][1] and got[3][0].collapsed == "x" and got[3][0].strongest.asDict() == {"start": 0, "length": 30, "period": 1}
    assert got[4][0].strongest.period == 1000 and got[4][0].collapsed.count(" ") == 999
    assert got[None][0].strongest.period == 2
    assert got[5][0].runs == [] and got[5][0].collapsed == "one two"
    assert periodic_runs.periodic_runs(d.limit(0)).collect() == []


def test_query(spark):
    docs = load(spark, SF0001, "documents").select("doc_id", "text").collect()
    got = {r.doc_id: r for r in queries.op11_runs(spark, SF0001).collect()}
    assert len(got) == len(docs)
    for d in docs:
        r = got[d.doc_id]
        row = (r.n_runs, r.start, r.length, r.period, r.exponent_milli, r.runs_sha256, r.collapsed_sha256)
        assert row == brute.run_row(brute.planted_words(d.doc_id, d.text))
    assert sum(r.n_runs > 0 for r in got.values()) >= 10


def test_planted_input_keeps_the_words(spark):
    rows = [(i, t) for i in range(60) for t in (" a  b\tc d e\n" * 5, None, " ")]
    d = spark.createDataFrame(rows, "doc_id long, text string")
    for i, (a, b) in enumerate(zip(rows, queries.with_planted_runs(d).collect(), strict=True)):
        assert (b.text or "").split() == brute.planted_words(*a), i

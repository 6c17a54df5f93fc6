"""The operators against plain-Python versions, with nulls, empty and very long
texts, ties, repeated rows, empty tables and columns with clashing names."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerlens.llm import (
    chat_format,
    components,
    decontaminate,
    exact_dedup,
    language_id,
    license_scan,
    near_dedup,
    passages,
    piece_codec,
    quality,
    queries,
    substring_exact,
    suffix_sort,
)
from tests.llm import brute

DOC = "doc_id long, text string"
CLASH = DOC + ", key string, id string, n string, a string, _id string, _text string, count string, score string, sig string"


def frame(spark, rows, clash=False):
    if clash:
        return spark.createDataFrame([(*r, "k", "i", "n", "a", "x", "y", "c", "s", "g") for r in rows], CLASH)
    return spark.createDataFrame(rows, DOC)


def prose(rng, n, vocab=400):
    return " ".join(f"w{rng.randrange(vocab)}" for _ in range(n))


def edited(rng, text, n):
    w = text.split(" ")
    for _ in range(n):
        w[rng.randrange(len(w))] = f"x{rng.randrange(10**6)}"
    return " ".join(w)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(7)
    out = []
    base = [prose(rng, 150) for _ in range(6)]
    passage = prose(rng, 70)
    for i in range(60):
        t = edited(rng, base[i % 6], rng.randrange(6)) if i % 3 else prose(rng, rng.randrange(1, 200))
        out.append((i, t + "\n" + passage if i % 7 == 0 else t))
    out += [(100, base[0]), (101, base[0]), (102, base[0].upper()), (103, None), (104, ""), (105, "   \n"), (106, "Two words"), (107, "two  WORDS")]
    out += [(108, prose(rng, 30_000)), (109, "é à É"), (110, "é à é"), (111, "Tie"), (112, "tie")]
    return out


# 9 ---------------------------------------------------------------------------


def test_exact_groups(spark, rows):
    more = [*rows, (111, "Tie"), (None, "tie"), (None, "alone"), (None, None)]
    for clash in (False, True):
        got = exact_dedup.exact_groups(frame(spark, more, clash)).collect()
        assert sorted(map(tuple, got), key=str) == brute.exact(more)
    assert exact_dedup.exact_groups(frame(spark, [])).count() == 0


def test_one_length_of_all_rows_is_spread(spark):
    """Different texts of one length: no exchange deals rows by the length."""
    d = spark.range(40_000).select(F.col("id").alias("doc_id"), F.sha2(F.col("id").cast("string"), 256).alias("text"))
    got = exact_dedup.exact_groups(d)
    plan = got._jdf.queryExecution().executedPlan().toString()
    dealt = [x for x in plan.splitlines() if "hashpartitioning(_len" in x]
    assert dealt and all("partial_count" not in x for x in dealt)
    assert got.filter("kept AND group_size = 1").count() == 40_000
    prev = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        shared = d.select(F.octet_length("text").cast("long").alias("_len"), F.xxhash64(exact_dedup.normalise(F.substring("text", 1, 256))).alias("_pre"))
        known = exact_dedup._marked(shared.withColumn("_bit", exact_dedup._bit(F.col("_len"))), exact_dedup._bitmap(shared.select(exact_dedup._bit(F.col("_len")).alias("_bit"))))
        sizes = known.filter("_in").groupBy("_len", "_pre").count().rdd.glom().map(len).collect()
        assert sum(sizes) == 40_000 and max(sizes) < 0.2 * 40_000
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", prev)


def test_drop_exact_copies(spark, rows):
    more = [*rows, (111, "Tie"), (112, "tie"), (None, "tie"), (None, "alone")]
    d = frame(spark, more, True)
    got = exact_dedup.drop_exact_copies(d)
    assert got.columns == d.columns
    want = {i for i, _, _, kept in brute.exact(rows) if kept}
    assert sorted(r.doc_id for r in got.collect() if r.doc_id is not None) == sorted(want)
    assert got.filter("doc_id IS NULL").count() == 2


# 5 ---------------------------------------------------------------------------


@pytest.mark.parametrize("leaf", [1024, 4])
def test_near_duplicates(spark, rows, leaf):
    got = near_dedup.near_duplicates(frame(spark, rows, leaf == 4), leaf_members=leaf).collect()
    want = brute.near(rows, 85)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == want
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_near_duplicates_blocks(spark, rows, monkeypatch):
    monkeypatch.setattr(near_dedup, "MAX_DEPTH", 0)
    monkeypatch.setattr(near_dedup, "BLOCK", 2)
    got = near_dedup.near_duplicates(frame(spark, rows), leaf_members=2).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute.near(rows, 85)


def test_near_duplicates_in_a_large_group(spark):
    """Pairs just above the threshold, in a group that shares a template."""
    rng = random.Random(13)
    template, rows = prose(rng, 100, 10**6), []
    for i in range(150):
        text = template + " " + prose(rng, 32, 10**6)
        w = text.split(" ")
        w[rng.randrange(10, 50)] = w[rng.randrange(60, 120)] = f"y{i}"
        rows += [(2 * i, text), (2 * i + 1, " ".join(w))]
    got = near_dedup.near_duplicates(frame(spark, rows), leaf_members=2).collect()
    want = brute.near(rows, 85)
    assert sum(c != i for i, (_, c) in want.items()) == 150
    assert {r.doc_id for r in got if r.component_id != want[r.doc_id][1]} == set()


def test_near_duplicates_in_a_branching_group(spark, monkeypatch):
    """1,500 texts with one template, of which pairs are just above the
    threshold: nodes branch, and no member is dropped."""
    monkeypatch.setattr(near_dedup, "BLOCK", 32)
    monkeypatch.setattr(near_dedup, "MANY", 2)
    rng = random.Random(17)
    template, rows = prose(rng, 60, 10**6), []
    for i in range(750):
        text = template + " " + prose(rng, 70, 10**6)
        w = text.split(" ")
        w[rng.randrange(10, 50)] = w[rng.randrange(70, 120)] = f"y{i}"
        rows += [(2 * i, text), (2 * i + 1, " ".join(w))]
    got = near_dedup.near_duplicates(frame(spark, rows), leaf_members=40).collect()
    linked = sum(r.component_id == r.doc_id - 1 for r in got)
    assert linked >= 0.99 * 750 and not any(r.component_id not in (r.doc_id, r.doc_id - 1) for r in got)


def test_a_group_of_near_copies_costs_in_proportion(spark, monkeypatch):
    """A group of near copies is joined through hubs: what is compared grows
    with its members, not with their pairs."""
    monkeypatch.setattr(near_dedup, "BLOCK", 16)
    rng = random.Random(19)
    base = prose(rng, 200, 10**6)
    made = {}
    compare = near_dedup.candidates

    def counted(leaf, *more):
        made[n] = made.get(n, 0) + leaf.count()
        return compare(leaf, *more)

    monkeypatch.setattr(near_dedup, "candidates", counted)
    for n in (300, 1200):
        rows = [(i, edited(rng, base, 1)) for i in range(n)]
        got = near_dedup.near_duplicates(frame(spark, rows), leaf_members=20).collect()
        assert {r.component_id for r in got} == {0}
    assert made[1200] <= 6 * made[300] <= 6 * 60 * 300


def test_near_duplicates_edges(spark):
    one = "a b c d e f g"
    got = near_dedup.near_duplicates(frame(spark, [(3, one), (3, one), (None, one), (5, "x y"), (4, "X  y"), (6, None)])).collect()
    assert sorted(((r.doc_id, r.component_id, r.kept) for r in got), key=str) == sorted(
        [(3, 3, True), (3, 3, True), (None, 3, False), (5, 4, False), (4, 4, True), (6, 6, True)], key=str
    )
    assert near_dedup.near_duplicates(frame(spark, [])).count() == 0
    assert near_dedup.drop_near_duplicates(frame(spark, [(1, one), (2, one), (None, one)], True)).count() == 2


def test_components(spark):
    rng = random.Random(1)
    edges = [(rng.randrange(80), rng.randrange(80)) for _ in range(60)] + [(i, i + 1) for i in range(100, 140)]
    sets = brute.Sets()
    for a, b in edges:
        sets.join(a, b)
    got = {r.vertex: r.component for r in components.connected_components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {x: sets.find(x) for a, b in edges if a != b for x in (a, b)}


# 4 ---------------------------------------------------------------------------


def test_suffix_array():
    rng = random.Random(3)
    for _ in range(1500):
        k = rng.choice([1, 2, 3, 200])
        s = [rng.randint(1, k) for _ in range(rng.randrange(40))] + [0]
        assert suffix_sort.suffix_array(s) == sorted(range(len(s)), key=lambda i: s[i:])


def removed(spark, rows, **options):
    got = substring_exact.remove_repeats(frame(spark, rows, bool(options)), **options)
    return sorted(
        map(tuple, got.select("doc_id", "n_bytes", F.col("n_bytes") - F.octet_length("kept"), F.size("spans"), F.sha2("kept", 256)).collect()), key=str
    )


def test_remove_repeats(spark):
    rng = random.Random(5)
    base = "".join(rng.choices("abcdefgh \né", k=600))
    rows = []
    for i in range(100):
        a = rng.randrange(300)
        m = base[a : a + rng.randrange(100, 400)]
        if i % 3 == 0:
            q = rng.randrange(len(m))
            m = m[:q] + "xyz"[i % 2] + m[q + 1 :]
        rows.append((i, "".join(rng.choices("abc", k=rng.choice([0, 1, 90]))) + m + "".join(rng.choices("ab", k=rng.choice([0, 1, 90])))))
    rows += [(200, "a" * 900), (201, "ab" * 400), (202, None), (203, ""), (204, "a" * 199), (205, ("x" * 150 + "y") * 5), (206, base * 2), (206, base * 2), (None, base)]
    want = brute.substrings(rows)
    assert removed(spark, rows) == want
    assert removed(spark, rows, hot_contexts=3) == want
    assert removed(spark, []) == []


# 10 --------------------------------------------------------------------------


def test_near_passages(spark, rows):
    got = passages.near_passages(frame(spark, rows, True)).collect()
    covered = {}
    for r in got:
        covered.setdefault(r.doc_id, set()).update(range(r.first_word, r.last_word))
    for i, places in brute.repeated_words(rows).items():
        assert len(places & covered[i]) >= 0.8 * len(places), i
    # documents without a likeness are left alone
    alone = {108, 103, 104, 105, 106, 107, 109, 110, 111, 112}
    assert not alone & set(covered)
    # one substitution in the middle of a passage does not hide it
    rng = random.Random(9)
    p = prose(rng, 80, 10**6)
    q = p.split(" ")
    q[40] = "other"
    two = [(1, prose(rng, 60, 10**6) + " " + p), (2, " ".join(q) + " " + prose(rng, 90, 10**6)), (3, prose(rng, 300, 10**6))]
    got = {r.doc_id: (r.first_word, r.last_word, r.class_id, r.class_rows) for r in passages.near_passages(frame(spark, two)).collect()}
    assert got == {1: (60, 140, 1, 2), 2: (0, 80, 1, 2)}
    assert passages.near_passages(frame(spark, [])).count() == 0


def test_passages_around_a_frequent_line(spark, monkeypatch):
    """Passages of 50 words with one substituted, each around a line that all
    texts share: they are found, and texts with the line alone are not compared
    with all others."""
    rng = random.Random(41)
    line, rows = prose(rng, 9, 10**6), []
    for i in range(60):
        p = prose(rng, 20, 10**6).split(" ") + line.split(" ") + prose(rng, 21, 10**6).split(" ")
        q = list(p)
        q[rng.choice([j for j in range(5, 45) if not 20 <= j < 29])] = f"y{i}"
        for k, text in enumerate((p, q)):
            rows.append((2 * i + k, f"{prose(rng, 70, 10**6)} {' '.join(text)} {prose(rng, 70, 10**6)}"))
    rows += [(1000 + i, f"{prose(rng, 60, 10**6)} {line} {prose(rng, 60, 10**6)}") for i in range(200)]
    met = []
    pairs = passages._pairs
    monkeypatch.setattr(passages, "_pairs", lambda *a: met.append((d := pairs(*a)).count()) or d)
    got = {}
    for r in passages.near_passages(frame(spark, rows)).collect():
        got.setdefault(r.class_id, set()).add(r.doc_id)
    assert sum({2 * i, 2 * i + 1} in got.values() for i in range(60)) >= 57
    assert all(len(x) == 2 for x in got.values())
    # 320 texts have the line: their pairs would be 51,040
    assert sum(met) < 8000


def test_compact_windows_are_all_windows():
    rng = np.random.default_rng(2)
    s = rng.integers(0, 30, 200, dtype=np.uint64)
    first = np.array([0, 0, 90, 100, 200])
    owner, left, c, right = passages.compact_windows(s, first, 7, np.uint64(5))
    h = passages.mix(s ^ np.uint64(5))
    of = {(o, i, j): k for o, a, k, b in zip(owner, left, c, right) for i in range(a, k + 1) for j in range(k, b + 1)}
    for t in range(4):
        for i in range(first[t], first[t + 1]):
            for j in range(i + 6, first[t + 1]):
                assert h[of[t, i, j]] == h[i : j + 1].min()


def test_context_places():
    assert passages.context_places(46, 5) == (23, (10, 18))
    assert passages.context_places(7, 5) == (3, (0,))
    for least in range(5, 200):
        half, offsets = passages.context_places(least, 5)
        assert offsets == (0,) or (0 < offsets[0] < offsets[1] - 5 and offsets[1] <= half)


def test_recall_at_the_threshold():
    """Runs of 50 words with one word substituted (similarity 0.8) have a key in common."""
    rng = np.random.default_rng(4)
    met = 0
    for _ in range(1000):
        one = rng.integers(0, 2**63, 46, dtype=np.uint64)
        two, at = one.copy(), rng.integers(4, 38)
        two[at : at + 5] = rng.integers(0, 2**63, 5, dtype=np.uint64)
        keys = [{int(g) for f in range(passages.HASHES) for g in passages.window_keys(s, np.array([0, 46]), 46, 5, f)[0]} for s in (one, two)]
        met += bool(keys[0] & keys[1])
    assert met >= 985


def test_recall_with_a_word_put_in():
    """Runs of 50 words, one of them with a word put in (similarity 0.82), in
    texts that differ around them, have a key in common."""
    rng = np.random.default_rng(6)

    def new(n):
        return rng.integers(0, 2**63, n, dtype=np.uint64)

    met = 0
    for _ in range(1000):
        run, at = new(46), rng.integers(4, 38)
        texts = [np.concatenate([new(60), x, new(60)]) for x in (run, np.concatenate([run[:at], new(5), run[at + 4 :]]))]
        keys = [{int(g) for f in range(passages.HASHES) for g in passages.window_keys(s, np.array([0, len(s)]), 46, 5, f)[0]} for s in texts]
        met += bool(keys[0] & keys[1])
    assert met >= 999


def test_windows_of_repeated_lines_are_few():
    s = np.tile(np.arange(1, 9, dtype=np.uint64), 1000)
    assert len(passages.compact_windows(s, np.array([0, len(s)]), 46, np.uint64(5))[0]) < 4 * len(s) / 46


def test_windows_that_begin_together_meet_once(spark):
    """A pair of texts that meets by many keys carries one window for each
    place both begin at, the longest one, whichever text is hub."""
    rows = [(g, t, 0, 10 * (g % 2), 60 + g) for g in range(12) for t in (1, 2)]
    found = spark.createDataFrame(rows, "g long, a long, b long, l int, r int")
    for hub in (1, 2):
        got = passages._pairs(found, found.filter(F.col("a") == hub), None).collect()
        assert [(r.ha, r.a) for r in got] == [(hub, 3 - hub)]
        assert sorted((w.hl, w.hr, w.l, w.r) for w in got[0].met) == [(0, 70, 0, 70), (10, 71, 10, 71)]


def test_verified_stretches_match_the_sets():
    """Each verified stretch has the asked similarity, and a run of equal
    shingles is found whole, whether the texts are equal or not."""
    rng = np.random.default_rng(8)
    for _ in range(200):
        a = rng.integers(0, 2**63, 120, dtype=np.uint64)
        b = a.copy()
        b[rng.integers(0, 120, rng.integers(0, 3))] = 7
        got = passages.verify(a, b, 46, 0.8)
        assert (got == [(0, 120, 0, 120)]) if np.array_equal(a, b) else got
        for x, y, u, v in got:
            one, two = set(a[x:y].tolist()), set(b[u:v].tolist())
            assert len(one & two) >= 0.8 * len(one | two)
    assert passages.verify(a[:40], a[:40], 46, 0.8) == []


def test_overlapping_stretches_are_one_passage(spark):
    """Stretches that touch but do not overlap stay apart; no Python is needed."""
    links = spark.createDataFrame(
        [(1, 0, lo, hi, 2, 0, 100 + lo, 100 + hi) for lo, hi in ((0, 50), (10, 90), (30, 60), (89, 120), (120, 170), (300, 350))],
        "ha long, hb long, hlo long, hhi long, a long, b long, lo long, hi long",
    )
    got = passages._merged(links)
    want = {(0, 0, 120), (10, 0, 120), (30, 0, 120), (89, 0, 120), (120, 120, 170), (300, 300, 350)}
    assert {(r.lo, r.at, r.end) for r in got.filter("a = 1").collect()} == want
    assert {(r.lo - 100, r.at - 100, r.end - 100) for r in got.filter("a = 2").collect()} == want


def frequent_lines(rng, pairs):
    """Pairs of texts that share a passage of 51 words made of lines; each line
    stands in many other texts."""
    lines = [prose(rng, 17, 10**6) for _ in range(12)]
    rows = [(1000 + i, prose(rng, 60, 10**6) + " " + lines[i % 12] + " " + prose(rng, 60, 10**6)) for i in range(240)]
    for i in range(pairs):
        passage = " ".join(rng.sample(lines, 3))
        rows += [(2 * i + z, prose(rng, 55, 10**6) + " " + passage + " " + prose(rng, 55, 10**6)) for z in range(2)]
    return rows


def test_passages_of_frequent_lines(spark):
    rows = frequent_lines(random.Random(11), 40)
    covered = {}
    for r in passages.near_passages(frame(spark, rows)).collect():
        covered.setdefault(r.doc_id, set()).update(range(r.first_word, r.last_word))
    want = brute.repeated_words(rows)
    assert len(want) >= 80
    assert {i for i, places in want.items() if places - covered.get(i, set())} == set()


def test_passage_in_a_group_without_any(spark):
    """Two texts share a passage that lies around a line of many other texts."""
    rng = random.Random(12)
    line = prose(rng, 34, 10**6)
    rows = [(i, prose(rng, 60, 10**6) + " " + line + " " + prose(rng, 60, 10**6)) for i in range(150)]
    for i in range(20):
        passage = prose(rng, 10, 10**6) + " " + line + " " + prose(rng, 10, 10**6)
        rows += [(1000 + 2 * i + z, prose(rng, 60, 10**6) + " " + passage + " " + prose(rng, 60, 10**6)) for z in range(2)]
    covered = {}
    for r in passages.near_passages(frame(spark, rows)).collect():
        covered.setdefault(r.doc_id, set()).update(range(r.first_word, r.last_word))
    want = brute.repeated_words(rows)
    assert len(want) == 40
    assert {i for i, places in want.items() if places - covered.get(i, set())} == set()


def test_passages_longer_than_what_the_hub_shares(spark):
    """A passage of all texts goes on in pairs of them: each pair is found
    whole, although the min-hashes lie in the passage of all."""
    rng = random.Random(17)
    whole, rows = prose(rng, 52, 10**6), []
    for i in range(20):
        more = prose(rng, 3, 10**6)
        rows += [(2 * i + z, prose(rng, 60, 10**6) + " " + whole + " " + more + " " + prose(rng, 60, 10**6)) for z in range(2)]
    covered, classes = {}, set()
    for r in passages.near_passages(frame(spark, rows)).collect():
        covered.setdefault(r.doc_id, set()).update(range(r.first_word, r.last_word))
        classes.add(r.class_id)
    want = brute.repeated_words(rows)
    assert len(want) == 40 and all(len(places) >= 55 for places in want.values())
    assert {i for i, places in want.items() if places - covered.get(i, set())} == set()
    assert classes == {0}


def test_windows_with_pairs_left(spark):
    """Two windows are settled if both lie whole in passages of one class."""
    found = spark.createDataFrame([(g, a, 0, 0, 9, 9, 60, n) for g, members, n in ((1, (1, 2), 2), (2, (1, 2, 3), 3), (3, (1, 2, 4), 3), (4, (1, 3), 2)) for a in members], "g long, a long, b long, l int, lo int, hi int, r int, size long")
    named = spark.createDataFrame([(1, 0, 0, 70, 5), (2, 0, 0, 61, 5), (3, 0, 0, 60, 5), (4, 0, 0, 70, 6)], "a long, b long, lo long, hi long, class long")
    got = passages._unsettled(found, named, None)
    assert {(r.g, r.a, r["class"], r.open) for r in got.collect()} == {
        (2, 1, 5, False), (2, 2, 5, False), (2, 3, None, True), (3, 1, 5, True), (3, 2, 5, True), (3, 4, 6, True), (4, 1, 5, False), (4, 3, None, True)
    }
    used = found.filter("g = 4 AND a = 3 OR g = 2 AND a = 3").select("g", "a", "b")
    assert {r.g for r in passages._unsettled(found, named, used).collect()} == {3}
    pairs = passages._pairs(got, passages._hubs(got, 9, 1)).collect()
    assert {frozenset((r.ha, r.a)) for r in pairs} == {frozenset(x) for x in ((1, 3), (2, 3), (1, 4), (2, 4))}


def test_texts_with_a_line_and_no_passage_are_not_compared_in_pairs(spark, monkeypatch):
    """Texts share a line of 34 words and no passage: each is compared with few
    others, and the two passages around the line are still found, one with a
    word substituted and one with a word put in."""
    rng = random.Random(13)
    line = prose(rng, 34, 10**6)
    rows = [(i, prose(rng, 60, 10**6) + " " + line + " " + prose(rng, 60, 10**6)) for i in range(300)]
    for i in range(2):
        one = (prose(rng, 20, 10**6) + " " + line + " " + prose(rng, 20, 10**6)).split(" ")
        two = one[:58] + [f"z{i}"] + one[58 + (i == 0) :]
        rows += [(1000 + 2 * i + z, f"{prose(rng, 60, 10**6)} {' '.join(x)} {prose(rng, 60, 10**6)}") for z, x in enumerate((one, two))]
    met = []
    pairs = passages._pairs
    monkeypatch.setattr(passages, "_pairs", lambda *a: met.append((d := pairs(*a)).count()) or d)
    got = {}
    for r in passages.near_passages(frame(spark, rows)).collect():
        got.setdefault(r.class_id, set()).add(r.doc_id)
    assert got == {1000: {1000, 1001}, 1002: {1002, 1003}}
    # all pairs would be 46,056
    assert sum(met) < 4000


def test_block_keys_of_similar_runs():
    """Runs of 46 shingles with one word substituted or put in have a key of
    their min-hash in common; runs with two words substituted have none."""
    rng = np.random.default_rng(15)

    def keys(s, c):
        ends = [np.array([x]) for x in (0, 0, c, len(s) - 1)]
        return [set(passages.block_keys(s, np.array([0, len(s)]), ends, 46, 5, e)[0].tolist()) for e in (False, True)]

    def new(n):
        return rng.integers(0, 2**63, n, dtype=np.uint64)

    for _ in range(100):
        run, at = new(46), int(rng.integers(4, 37))
        changed = np.concatenate([run[:at], new(5), run[at + 5 :]])
        longer = np.concatenate([run[:at], new(5), run[at + 4 :]])
        c = int(rng.choice([x for x in range(46) if not at <= x < at + 5]))
        for other, move in ((changed, 0), (longer, c > at)):
            texts = [(np.concatenate([new(30), run, new(30)]), 30 + c), (np.concatenate([new(50), other, new(30)]), 50 + c + move)]
            one, two = (keys(*x) for x in texts)
            assert all(x & y for x, y in zip(one, two))
    twice = run.copy()
    twice[10:15], twice[30:35] = new(5), new(5)
    assert not any(x & y for x, y in zip(keys(run, 20), keys(twice, 20)))


# 1 ---------------------------------------------------------------------------


def test_contaminated(spark):
    rng = random.Random(4)
    items = [(i, prose(rng, rng.randrange(12, 40), 300)) for i in range(12)] + [(50, None), (51, ""), (52, "too short")]
    items.append((60, items[0][1].upper()))
    docs = [(i, prose(rng, 120, 300)) for i in range(20)]
    for i in range(30, 60):
        _, t = items[i % 12]
        t = edited(rng, t, rng.randrange(len(t.split()) // 5 + 1))
        docs.append((i, prose(rng, rng.choice([0, 40]), 300) + "; " + t + "\n" + prose(rng, rng.choice([0, 40]), 300)))
    docs += [(70, None), (71, ""), (72, items[3][1]), (72, items[3][1]), (73, prose(rng, 20_000, 300))]
    want = {p for p in brute.leaks(docs, [x for x in items if len(brute.tokens(x[1])) >= 7])}
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = decontaminate.contaminated(frame(spark, docs, True), bench)
    found = {(r.doc_id, r.item_id) for r in got.collect()}
    assert found == want and got.count() == len(want)
    kept = decontaminate.drop_contaminated(frame(spark, docs, True), bench)
    assert {r.doc_id for r in kept.collect()} == {i for i, _ in docs} - {d for d, _ in want}
    assert decontaminate.contaminated(frame(spark, []), bench).count() == 0
    assert decontaminate.contaminated(frame(spark, docs), bench.limit(0)).count() == 0


def test_items_of_few_tokens(spark):
    """Items shorter than every mask, with a token substituted or missing at an
    end where their length allows it."""
    rng = random.Random(23)
    items = [(n, " ".join(f"q{n}x{i}" for i in range(n))) for n in range(1, 9)] + [(20, ""), (21, None), (22, "...")]
    docs = []
    for n, text in items[:8]:
        w = text.split(" ")
        docs += [prose(rng, 12) + " " + text + " " + prose(rng, 9), " ".join([*w[:-1], "zz"]), " ".join(w[1:]) + " " + prose(rng, 3), " ".join(w[: n // 2] + ["zz"] + w[n // 2 + 1 :])]
        docs += [" ".join(w[:-2] + ["a", "b"]), text.upper() + "!"]
    docs = [(i, t) for i, t in enumerate(docs)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.item_id): r.n_equal for r in decontaminate.contaminated(frame(spark, docs), bench).collect()}
    want = brute.leaks(docs, [(i, t) for i, t in items if i < 20])
    assert set(got) == {p for p in want if p[1] < 7} | {p for p in got if p[1] >= 7} and {p for p in got if p[1] >= 7} <= want
    assert all((6 * n - 6, n) in got and (6 * n - 1, n) in got for n in range(1, 9))


def test_contaminated_in_blocks(spark, monkeypatch):
    rng = random.Random(6)
    items = [(i, prose(rng, 20, 10**6)) for i in range(10)]
    docs = [(i, "pre " + t) for i, t in items]
    monkeypatch.setattr(decontaminate, "BLOCK_SEEDS", 100)
    got = decontaminate.contaminated(frame(spark, docs), spark.createDataFrame(items, "item_id long, text string"))
    assert sorted((r.doc_id, r.item_id, r.first_token) for r in got.collect()) == [(i, i, 1) for i in range(10)]


def test_documents_are_read_twice_at_most(spark, monkeypatch):
    """However many seeds the benchmark has, and the pairs stay the same, with
    ids that repeat, short items and items cut off at an end of a document."""
    rng = random.Random(31)
    items = [(i, prose(rng, rng.randrange(3, 30), 300)) for i in range(40)]
    docs = [(i, prose(rng, 30, 300) + " " + edited(rng, t, len(t.split()) // 5) + " " + prose(rng, 20, 300)) for i, t in items]
    docs += [(i, t) for i, t in items[:10]] + [(100, " ".join(t.split()[1:])) for _, t in items[10:15]] + [(101, None), (None, items[0][1])]
    bench = spark.createDataFrame(items, "item_id long, text string")
    read = spark.sparkContext.accumulator(0)

    def counted(batches):
        for b in batches:
            read.add(b.num_rows)
            yield b

    table = frame(spark, docs).mapInArrow(counted, DOC)
    few = sorted(map(tuple, decontaminate.contaminated(frame(spark, docs), bench).collect()))
    monkeypatch.setattr(decontaminate, "BLOCK_SEEDS", 100)
    many = sorted(map(tuple, decontaminate.contaminated(table, bench).collect()))
    assert read.value <= 2 * len(docs)
    assert many == few and {(d, i) for d, i, *_ in few} >= {(i, i) for i in range(10)}
    # a sieve holds back no key of its own, and few of the others pass
    keys = spark.range(3000).select(F.xxhash64("id").alias("h"))
    got = decontaminate._sifted(spark.range(30_000).select("id", F.xxhash64("id").alias("g")), "g", keys, 3000)
    ids = {r.id for r in got.collect()}
    assert ids >= set(range(3000)) and len(ids) < 3000 + 0.05 * 27_000


def test_documents_are_dropped_by_a_large_benchmark(spark, monkeypatch):
    """The plan of the stage has one broadcast of seeds, or none, not one for
    each block of them, and the rows left are those of a small benchmark."""
    rng = random.Random(37)
    items = [(i, prose(rng, rng.randrange(12, 30), 300)) for i in range(30)]
    docs = [(i, prose(rng, 20, 300) + (" " + items[i][1] if i < 30 and i % 2 else "")) for i in range(60)] + [(None, items[0][1]), (70, None)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    few = {r.doc_id for r in decontaminate.drop_contaminated(frame(spark, docs, True), bench).collect()}
    monkeypatch.setattr(decontaminate, "BLOCK_SEEDS", 100)
    many = decontaminate.drop_contaminated(frame(spark, docs, True), bench)
    assert many._jdf.queryExecution().optimizedPlan().toString().count("posexplode") <= 1
    assert {r.doc_id for r in many.collect()} == few == {i for i, _ in docs} - set(range(1, 30, 2))


def test_decontamination_is_native(spark):
    d = frame(spark, [(1, "a")])
    plan = decontaminate.contaminated(d, d.withColumnRenamed("doc_id", "item_id"))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


# 3 ---------------------------------------------------------------------------


@pytest.fixture(scope="module")
def library():
    public_tokenizers = pytest.importorskip("public_tokenizers")
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(queries.PIECE_MODEL))


def test_pieces_equal_the_library(spark, rows, library):
    rng = random.Random(2)
    letters = "abcdefghijklmnop  tionheraésß.,!|\n日🙂▁"
    texts = [t for _, t in rows]
    texts += ["".join(rng.choices(letters, k=rng.randrange(1, 60))) for _ in range(3000)]
    texts += ["<s>[INST] </s><0x0A>", "▁x", "  a   b ", "\x00a\t", " " * 40 + "x", "a" * 5000]
    d = frame(spark, list(enumerate(texts)), True)
    got = {r.doc_id: r for r in piece_codec.encode_and_decode(d, queries.piece_model()).collect()}
    for i, t in enumerate(texts):
        ids = library.encode(t or "", add_eos=True)
        assert got[i].ids == ids
        assert got[i].decoded == library.decode(ids)
    assert piece_codec.encode_and_decode(frame(spark, []), queries.piece_model()).count() == 0


def test_decode_any_ids(library):
    codec = piece_codec.Codec(queries.piece_model())
    rng = random.Random(8)
    for _ in range(300):
        ids = [rng.choice([1, 2, 259, rng.randrange(259, 32000)]) for _ in range(rng.randrange(12))]
        assert codec.decode(ids) == library.decode(ids)


# 2, 6 ------------------------------------------------------------------------


def test_quality_held_out(spark):
    rng = random.Random(1)
    docs, labels = [], []
    for i in range(400):
        good = i % 3 > 0
        t = prose(rng, 60, 5000)
        docs.append((i, t.replace(" ", ". ", 3) if good else t.replace(" ", " | ")))
        labels.append((i, int(good)))
    docs += [(900, None), (901, ""), (None, "text")]
    labels += [(None, 1), (5000, None), (0, 1 - labels[0][1])]
    d = frame(spark, docs, True)
    learn = ~queries.held_out(F.col("_id"), 4, 2)
    model = quality.train(d, spark.createDataFrame(labels, "doc_id long, quality int"), learn)
    got = {r.doc_id: r.score for r in quality.score(d, model).collect()}
    assert len(got) == 403 and all(0 <= s <= 1 for s in got.values()) and got[900] == got[901]
    good = [got[i] for i in range(400) if i % 3]
    bad = [got[i] for i in range(400) if not i % 3]
    assert np.mean(np.array(good)[:, None] > np.array(bad)) > 0.99
    kept = quality.drop_low_quality(d, model, 0.5)
    assert kept.columns == d.columns and 200 < kept.count() < 300
    none = quality.train(d, spark.createDataFrame([], "doc_id long, quality int"), learn)
    assert {r.score for r in quality.score(d, none).collect()} == {0.5}
    assert quality.score(frame(spark, []), model).count() == 0


def test_language(spark):
    rng = random.Random(2)
    parts = {"xx": ["ba", "bo", "bi", "lo"], "yy": ["tsch", "ung", "keit", "ö"], "zz": ["шо", "на", "кри"]}
    docs = []
    for i in range(300):
        lang = ["xx", "yy", "zz"][i % 3]
        docs.append((i, " ".join("".join(rng.choices(parts[lang], k=3)) for _ in range(40)), lang))
    docs += [(500, None, "xx"), (501, "123 --", "yy"), (502, "bo", None), (None, "babo", "xx")]
    d = spark.createDataFrame(docs, "doc_id long, text string, lang string")
    model = language_id.train(d, ~queries.held_out(F.col("_id"), 3, 1))
    got = {r.doc_id: r for r in language_id.predict(d, model).collect()}
    assert [got[i].lang_pred for i in range(300)] == [x[2] for x in docs[:300]]
    assert got[500].lang_pred == got[501].lang_pred == "und" and got[501].score == 0 and got[501].rejected
    assert got[502].lang_pred in parts
    assert all(0 <= r.score <= 1 for r in got.values()) and np.mean([got[i].rejected for i in range(300)]) < 0.1
    none = language_id.train(d, F.lit(False))
    assert {r.lang_pred for r in language_id.predict(d, none).collect()} == {"und"}
    assert language_id.predict(d.limit(0), model).count() == 0


# 7 ---------------------------------------------------------------------------


def test_licenses(spark):
    rng = random.Random(3)
    mit, apache = license_scan.TEMPLATES["MIT"][2], license_scan.TEMPLATES["Apache-2.0"][0]
    changed = mit.replace("charge", "cost").replace("copies of the Software", "copies")
    docs = [
        (1, prose(rng, 50) + "\n" + mit),
        (2, changed.upper()),
        (3, apache + " " + prose(rng, 9)),
        (4, prose(rng, 200) + " the MIT License is one; permission is granted, to any person"),
        (5, None),
        (6, ""),
        (7, prose(rng, 20_000) + "\nReleased under the MIT License.\n" + apache),
        (8, "Licensed under CC BY-NC 4.0."),
        (8, "Licensed under CC BY-NC 4.0."),
    ]
    got = license_scan.scan(frame(spark, docs, True)).collect()
    best = {r.doc_id: (r.license, r.n_matches) for r in got}
    assert best == {1: ("MIT", 1), 2: ("MIT", 1), 3: ("Apache-2.0", 1), 4: (None, 0), 5: (None, 0), 6: (None, 0), 7: ("MIT", 2), 8: ("CC-BY-NC-4.0", 1)}
    for r in got:
        w = license_scan.normalised_words(dict(docs)[r.doc_id] or "")
        for m in r.matches:
            have = [license_scan.normalised_words(t) for t in license_scan.TEMPLATES[m.license]]
            assert max(brute.dice(w[m.first_word : m.last_word + 1], t) for t in have) == pytest.approx(m.dice) and m.dice >= 0.8
    assert license_scan.scan(frame(spark, [])).count() == 0


def test_each_notice_gets_its_own_name(spark):
    """All templates within prose, as they are and with words changed: each is
    found, under its own name where it is unchanged."""
    rng = random.Random(31)
    docs, names = [], {}
    for name, texts in license_scan.TEMPLATES.items():
        for text in texts:
            names[len(docs)] = (name, 1.0)
            docs.append((len(docs), f"{prose(rng, 30)}.\n{text}\n{prose(rng, 30)}"))
            w = text.split(" ")
            if len(w) >= 30:
                k = len(w) // 20
                for i in rng.sample(range(len(w)), k):
                    w[i] = f"v{i}"
                names[len(docs)] = (None, 0.8)
                docs.append((len(docs), f"{prose(rng, 30)} {' '.join(w)}"))
    for r in license_scan.scan(frame(spark, docs)).collect():
        name, dice = names[r.doc_id]
        assert r.license is not None and r.dice >= dice - 1e-9
        assert name in (None, r.license), (name, r.license)


def test_models_that_cannot_be_encoded_are_told(tmp_path):
    import public_tokenizers
    from sentencepiece import sentencepiece_model_pb2

    path = public_tokenizers.path(queries.PIECE_MODEL)
    good = sentencepiece_model_pb2.ModelProto()
    with open(path, "rb") as f:
        good.ParseFromString(f.read())
    assert piece_codec.unsupported(good) == []
    changes = {
        "not BPE": lambda m: setattr(m.trainer_spec, "model_type", m.trainer_spec.UNIGRAM),
        "normalises": lambda m: setattr(m.normalizer_spec, "precompiled_charsmap", b"x"),
        "dummy prefix": lambda m: setattr(m.normalizer_spec, "add_dummy_prefix", False),
        "extra white space": lambda m: setattr(m.normalizer_spec, "remove_extra_whitespaces", True),
        "user-defined": lambda m: setattr(m.pieces[500], "type", m.SentencePiece.USER_DEFINED),
        "unused": lambda m: setattr(m.pieces[500], "type", m.SentencePiece.UNUSED),
    }
    for what, change in changes.items():
        model = sentencepiece_model_pb2.ModelProto()
        model.CopyFrom(good)
        change(model)
        assert len(piece_codec.unsupported(model)) == 1 and what in piece_codec.unsupported(model)[0]
    odd = sentencepiece_model_pb2.ModelProto()
    odd.CopyFrom(good)
    odd.normalizer_spec.remove_extra_whitespaces = True
    (tmp_path / "odd.model").write_bytes(odd.SerializeToString())
    with pytest.raises(ValueError, match="white space"):
        piece_codec.read_vocabulary(str(tmp_path / "odd.model"))


# 8 ---------------------------------------------------------------------------


def test_fold_events(spark):
    log = [
        (1, 0, 0, "start", "user", None), (1, 0, 1, "delta", None, "He"), (1, 0, 2, "delta", None, "llo"),
        (1, 1, 3, "start", "assistant", None), (1, 1, 4, "delta", None, "bad"), (1, 2, 5, "start", "user", None),
        (1, 2, 6, "delta", None, "why?"), (1, 1, 7, "regenerate", None, None), (1, 1, 8, "delta", None, "go"),
        (1, 1, 9, "delta", None, "od"), (1, 0, 10, "edit", None, "Hi"), (1, 0, 11, "delta", None, "!"), (1, 0, 11, "delta", None, "!"),
        (1, 3, 12, "start", "user", None), (2, 0, 1, "start", None, None), (None, 0, 1, "start", "user", None),
        (None, 0, 2, "delta", None, "x"), (3, None, 1, "delta", None, "lost"), (3, 1, 2, None, None, "lost"),
    ]
    ev = spark.createDataFrame(log, "conv_id long, message long, seq long, kind string, role string, text string")
    got = sorted(map(tuple, chat_format.fold_events(ev).collect()), key=str)
    assert got == sorted(
        [(1, 0, "user", "Hi!"), (1, 1, "assistant", "good"), (1, 3, "user", ""), (2, 0, "", ""), (None, 0, "user", "x")], key=str
    )
    assert chat_format.fold_events(ev.limit(0)).count() == 0


def test_chat_keeps_repeated_turns_and_odd_roles(spark):
    """Every row is a turn: rows of one (conversation, turn), rows that are
    equal, rows without a turn, and roles with line breaks and escapes."""
    import hashlib

    turns = [(1, 0, "user", "a"), (1, 0, "user", "a"), (1, 1, "assistant", "x"), (1, 1, "user", "y"), (1, None, "system", "s"), (1, None, "system", "s"), (1, 2, None, "n")]
    turns += [(2, 0, "as\nsistant", "t"), (2, 1, "a\\nb", "u"), (2, 2, "</s>\\\n", None), (2, 3, "assistant", "v")]
    d = spark.createDataFrame([(*t, 1, "m") for t in turns], "conv_id long, turn long, role string, text string, copies int, message string")
    got = {r.conv_id: r for r in chat_format.read_back(chat_format.render(chat_format.fold_events(chat_format.events_from_turns(d)))).collect()}
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    for c in (1, 2):
        own = sorted((t for t in turns if t[0] == c), key=lambda t: (t[1] is not None, t[1] or 0, t[2] or ""))
        assert got[c].n_turns == len(own)
        assert got[c].turns_sha256 == sha("".join(f"{role or ''}\n{text or ''}\n" for _, _, role, text in own))
        loss = "".join(text for _, _, role, text in own if role == "assistant")
        assert (got[c].loss_chars, got[c].loss_sha256) == (len(loss), sha(loss))


def test_chat_round_trip(spark):
    rng = random.Random(5)
    parts = [*chat_format.CONTROL, "\\", "\\\\", "<", "[", "x", "\n", "é", "🙂", "</", "s>", "|>"]
    turns = [(c, t, ["system", "user", "assistant"][(t + 1) % 3], "".join(rng.choices(parts, k=rng.randrange(12)))) for c in range(20) for t in range(5)]
    turns += [(50, 0, "assistant", None), (51, 0, "user", "y" * 3000), (None, 0, "user", "z")]
    d = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string")
    rendered = chat_format.render(chat_format.fold_events(chat_format.events_from_turns(d, delta_chars=7)))
    for r in rendered.collect():
        body = r.formatted[len(chat_format.TURN) : -len(chat_format.END)]
        assert not any(c in body for c in chat_format.CONTROL)
    import hashlib

    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    for r in chat_format.read_back(rendered).collect():
        own = sorted(x[1:] for x in turns if x[0] == r.conv_id)
        assert r.n_turns == len(own) and r.turns_sha256 == sha("".join(f"{role}\n{t or ''}\n" for _, role, t in own))
        loss = "".join(t or "" for _, role, t in own if role == "assistant")
        assert (r.loss_chars, r.loss_sha256) == (len(loss), sha(loss))
        assert r.formatted_chars == sum(len(x.formatted) for x in rendered.filter(F.col("conv_id").eqNullSafe(F.lit(r.conv_id))).collect())

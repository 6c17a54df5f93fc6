"""Identifiers: plain ones against the stated patterns, disguised ones by
disguising known ones, and prose that must stay as it is."""

from __future__ import annotations

import hashlib
import random
import time

import pytest

from ledgerlens.llm import identifiers, queries
from ledgerlens.llm.common import load
from tests.llm import brute

SF0001 = "/root/testdata/sf0.001"
WORDS = ["zero", "one", "two", "three", "four", "five", "six", "seven", "eight", "nine"]
CYRILLIC = str.maketrans("aeopcxyABEKMHOPCTX", "аеорсхуАВЕКМНОРСТХ")
FULL = str.maketrans({chr(c): chr(c + 0xFEE0) for c in range(33, 127)})


def listed(spans, disguised=None):
    return [f"{s['kind']}:{s['start']}:{s['end']}" for s in spans if disguised is None or s["disguised"] == disguised]


def test_plain_spans_follow_the_patterns():
    rng = random.Random(5)
    parts = ["a@b.c", "@", ".", "1", "22", "255", "256", "+", "(", ")", " ", "-", "x", "4111111111111111", "é", "_%", "00", "\n", "a.b@c-d.e.f", "+1 (555) 123-4567", "1.2.3.4"]
    for _ in range(3000):
        text = "".join(rng.choice(parts) for _ in range(rng.randrange(25)))
        assert listed(identifiers.spans_of(text), False) == brute.identifiers(text), text


def _card(rng):
    body = [rng.randrange(10) for _ in range(rng.randrange(13, 19))]
    return next(c for c in ("".join(map(str, [*body, d])) for d in range(10)) if identifiers.luhn(c))


def _spelled(rng, digits):
    return rng.choice([" ", "-", ", "]).join(WORDS[int(d)] for d in digits)


def _dots(rng, text):
    how = rng.choice([" dot ", " [dot] ", "[dot]", "(dot)", " DOT ", "[.]", "{dot}", "_dot_"])
    return text.replace(".", how)


def disguise(rng, kind):
    """(identifier, the same in disguise)."""
    if kind == "email":
        plain = rng.choice(["jane.roe", "bob7", "x_y"]) + "@" + rng.choice(["mail5.example.com", "corp.org", "a-b.co.uk"])
        if rng.random() < 0.3:
            return plain, plain.translate(rng.choice([CYRILLIC, FULL]))
        return plain, _dots(rng, plain).replace("@", rng.choice([" at ", " [at] ", "(at)", " AT ", "{at}", " (@) ", "_at_"]))
    if kind == "ip":
        plain = ".".join(str(rng.randrange(256)) for _ in range(4))
        if rng.random() < 0.5:
            return plain, " dot ".join(_spelled(rng, p) for p in plain.split("."))
        return plain, _dots(rng, plain)
    if kind == "card":
        plain = _card(rng)
        return plain, rng.choice([_spelled(rng, plain), plain.translate(FULL), plain[:4].translate(FULL) + plain[4:]])
    plain = "+" + "".join(rng.choice("123456789") for _ in range(rng.randrange(10, 16)))
    return plain, rng.choice(["plus ", "+"]) + _spelled(rng, plain[1:])


@pytest.mark.parametrize("kind", identifiers.KINDS)
def test_disguised_spans_map_back_to_the_source(kind):
    rng = random.Random(kind)
    for _ in range(300):
        plain, odd = disguise(rng, kind)
        before = rng.choice(["write to ", "é ", "", "see: ", "число "])
        text = before + odd + rng.choice([" now", "", ". Next", "\nline"])
        found = [s for s in identifiers.spans_of(text) if s["kind"] == kind and s["disguised"]]
        assert [(s["start"], s["end"]) for s in found] == [(len(before), len(before) + len(odd))], text
        assert found[0]["value"].replace(" ", "") == plain, text


@pytest.mark.parametrize("text", [
    "write us at example.com now", "meet at noon", "look at polka dot dresses", "one two three four five six seven",
    "un deux trois quatre", "the dot product at hand", "look at the dot. com is next", "at 10 dot 5", "page 1 - 2 - 3",
    "élan – garçon’s naïve café", "почта моя", "one at a time", "12 one 5",
])
def test_prose_is_left_alone(text):
    assert identifiers.spans_of(text) == []


def test_a_longer_disguised_span_stands_beside_the_plain_one():
    spans = identifiers.spans_of("jane@example.com dot uk")
    assert listed(spans) == ["email:0:16", "email:0:23"] and [s["disguised"] for s in spans] == [False, True]
    assert listed(identifiers.spans_of("​jane@example.com")) == ["email:1:17"]
    assert listed(identifiers.spans_of("ja​ne@example.com")) == ["email:0:17", "email:3:17"]


@pytest.mark.parametrize("piece", ["1", "1.", "a@", "+1 ", "one ", "[ ", " at ", "1 ", "a at b dot ", "0O0", "é–", "[.]"])
def test_time_is_linear(piece):
    size = 400_000 // len(piece)
    began = time.perf_counter()
    identifiers.spans_of(piece * size)
    assert time.perf_counter() - began < 20


def test_edge_cases_and_clashing_columns(spark):
    rows = [(1, None), (2, ""), (3, "a@b.cd"), (3, "a@b.cd"), (None, "1.2.3.4"), (4, "w " * 300_000 + "a@b.cd")]
    d = spark.createDataFrame([(*r, "x", [2]) for r in rows], "doc_id long, text string, spans string, base array<int>")
    got = sorted(((r.doc_id, listed(r.spans)) for r in identifiers.find_identifiers(d).collect()), key=str)
    assert got == [(1, []), (2, []), (3, ["email:0:6"]), (3, ["email:0:6"]), (4, ["email:600000:600006"]), (None, ["ip:0:7"])]
    assert identifiers.find_identifiers(d.limit(0)).collect() == []


def test_query(spark):
    docs = {r.doc_id: r.text for r in load(spark, SF0001, "documents").select("doc_id", "text").collect()}
    got = queries.op13_identifiers(spark, SF0001).collect()
    assert len(got) == len(docs)
    for r in got:
        want = brute.identifiers(docs[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(",".join(want).encode()).hexdigest()
        assert r.spans == ",".join(want) and r.n_disguised == 0
        assert [r[f"n_{k}"] for k in identifiers.KINDS] == [sum(w.startswith(k + ":") for w in want) for k in identifiers.KINDS]
    assert sum(r.n_email for r in got) and sum(r.n_ip for r in got) and sum(r.n_phone for r in got)

"""The registered queries on the small tables: SQL twins, brute force, and the
pipeline stage by stage."""

from __future__ import annotations

import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from ledgerlens.llm import queries
from ledgerlens.llm.common import load
from ledgerlens.llm.oracle import ORACLE
from tests.llm import brute

SF0001 = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs(spark):
    return [(r.doc_id, r.text) for r in load(spark, SF0001, "documents").select("doc_id", "text").collect()]


@pytest.mark.parametrize("key", sorted(ORACLE))
def test_oracle(spark, key):
    con = duckdb.connect()
    for t in ("documents", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF0001}/{t}.parquet')")
    got = queries.QUERIES[key](spark, SF0001)
    cur = con.execute(ORACLE[key])
    names = [c[0] for c in cur.description]
    assert sorted(names) == sorted(got.columns)
    assert sorted(map(tuple, got.select(*names).collect())) == sorted(cur.fetchall())


def test_near(spark, docs):
    got = queries.op5_near_dedup(spark, SF0001).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute.near(docs, 85)


def test_substrings(spark, docs):
    got = queries.op4_substrings(spark, SF0001).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    assert sorted(map(tuple, got.collect()), key=str) == brute.substrings(docs)


def test_passages(spark, docs):
    covered = {}
    for r in queries.op10_passages(spark, SF0001).collect():
        covered.setdefault(r.doc_id, set()).update(range(r.first_word, r.last_word))
    for i, places in brute.repeated_words(docs).items():
        assert len(places & covered[i]) >= 0.9 * len(places)


def test_leaks(spark, docs):
    items = [(r.item_id, r.text) for r in load(spark, SF0001, "benchmark").collect()]
    got = {(r.doc_id, r.item_id) for r in queries.op1_decontaminate(spark, SF0001).collect()}
    short = [(i, t) for i, t in docs if len(t) < 4000]
    ids = {i for i, _ in short}
    assert {p for p in got if p[0] in ids} == brute.leaks(short, items)


def test_held_out_rows_are_told(spark):
    import zlib

    for f, parts, part in ((queries.op2_quality, 4, 2), (queries.op6_language, 3, 1)):
        got = f(spark, SF0001).collect()
        assert len(got) == 200 and all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % parts == part) for r in got)
        assert all(0 <= r.score <= 1 for r in got)


def test_language_accuracy(spark):
    lang = dict(load(spark, SF0001, "documents").select("doc_id", "lang").collect())
    got = [r for r in queries.op6_language(spark, SF0001).collect() if r.held_out]
    assert sum(r.lang_pred == lang[r.doc_id] for r in got) >= 0.95 * len(got)


def test_pipeline_stages(spark, docs):
    names = [n for n, _ in corpus_pipeline.STAGES]
    stages = dict(corpus_pipeline.STAGES)
    assert names == ["quality", "exact_dedup", "near_dedup", "decontaminate", "encode"]
    table = load(spark, SF0001, "documents")
    texts = dict(docs)

    kept = stages["quality"](spark, table, SF0001)
    assert kept.columns == table.columns
    want = {r.doc_id for r in queries.op2_quality(spark, SF0001).collect() if r.predicted == 1}
    assert {r.doc_id for r in kept.collect()} == want

    kept = stages["exact_dedup"](spark, table, SF0001)
    left = {i for i, _, _, k in brute.exact(docs) if k}
    assert kept.columns == table.columns and {r.doc_id for r in kept.collect()} == left

    kept = stages["near_dedup"](spark, table, SF0001)
    left = {i for i, (_, c) in brute.near(docs, corpus_pipeline.NEAR_PERCENT).items() if i == c}
    assert kept.columns == table.columns and {r.doc_id for r in kept.collect()} == left

    kept = stages["decontaminate"](spark, table, SF0001)
    leaked = {r.doc_id for r in queries.op1_decontaminate(spark, SF0001).collect()}
    assert kept.columns == table.columns and {r.doc_id for r in kept.collect()} == set(texts) - leaked

    coded = stages["encode"](spark, table, SF0001).filter(F.col("doc_id") < 20).collect()
    assert len(coded) == 20 and all(r.n_tokens == len(r.ids) for r in coded)


def test_pipeline_run(spark):
    got = corpus_pipeline.run(spark, SF0001)
    assert 0 < got.count() < 200 and got.select("doc_id").distinct().count() == got.count()

"""Exact amounts against Python's integers, past 64 bits, 38 digits and 0."""

import random

import pytest
from pyspark.sql import functions as F

from ledgerlens.operators import amounts as A


def frame(spark, rows):
    return spark.createDataFrame(rows, "`from` string, `to` string, value_text string, isError string, date string")


@pytest.mark.parametrize("top", [10, 10**18, 2**64, 10**38, 2**256])
def test_sums_are_exact(spark, top):
    rng = random.Random(top)
    rows = [(rng.choice("abc"), rng.choice("abc"), str(rng.randrange(top)), str(rng.randrange(2)), f"d{rng.randrange(3)}") for _ in range(300)]
    got = {r.address: r for r in A.address_amounts_wei(frame(spark, rows)).collect()}
    for x in "abc":
        out, into = (sum(int(r[2]) for r in rows if r[side] == x) for side in (0, 1))
        assert (got[x].sent_wei, got[x].received_wei, got[x].net_wei) == (str(out), str(into), str(into - out))
    days = {r.date: r for r in A.daily_tx_stats_wei(frame(spark, rows)).collect()}
    for d in days:
        own = [r for r in rows if r[4] == d]
        assert days[d].total_wei == str(sum(int(r[2]) for r in own)) and days[d].failed_tx == sum(int(r[3]) for r in own)


def test_a_sum_that_passes_38_digits(spark):
    most = str(10**38 - 1)
    rows = [("a", "b", most, "0", "d")] * 500
    got = A.daily_tx_stats_wei(frame(spark, rows)).first()
    assert got.total_wei == str(500 * (10**38 - 1)) and len(got.total_wei) == 41


def test_text_that_is_no_amount(spark):
    texts = [None, "", "x", "-5", "1.5", "1e3", " 7 ", "007", "0", "0" * 200 + "3"]
    rows = [("a", None, t, "0", "d") for t in texts]
    got = A.address_amounts_wei(frame(spark, rows)).collect()
    assert len(got) == 1 and (got[0].sent_wei, got[0].received_wei, got[0].net_wei) == ("17", "0", "-17")
    assert A.daily_tx_stats_wei(frame(spark, rows[:0])).collect() == []


def test_value_wei_column(spark):
    d = spark.createDataFrame([("1234567890123456789",), ("9" * 38,), ("9" * 39,), ("x",)], "value string")
    got = [r.value_wei for r in A.with_value_wei(d).collect()]
    assert [None if v is None else int(v) for v in got] == [1234567890123456789, 10**38 - 1, None, None]
    assert A.with_value_wei(d).schema["value_wei"].dataType.simpleString() == "decimal(38,0)"


def test_one_hot_address_is_combined_before_the_shuffle(spark):
    d = spark.range(1000).select(F.lit("a").alias("from"), F.lit("a").alias("to"), F.lit("5").alias("value_text"))
    plan = A.address_amounts_wei(d)._jdf.queryExecution().executedPlan().toString()
    assert "partial_sum" in plan
    assert A.address_amounts_wei(d).first().net_wei == "0"

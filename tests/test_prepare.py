import math

from pyspark.sql import functions as F

from ledgerlens.functions import scalar as S
from ledgerlens.operators.aggregates import activity_stats
from ledgerlens.operators.prepare import clean_column_names, missing_columns, prepare_transactions, safe_names
from ledgerlens.sources.tables import tx_from_records
from helpers import tx_rows


def test_safe_names_blank_and_none():
    assert safe_names(["name", "", "value", None, "  "]) == ["name", "col_1", "value", "col_3", "col_4"]


def test_clean_column_names_frame(spark):
    df = spark.range(1).select(F.lit(1).alias(" a "), F.lit(2).alias(""), F.lit(3).alias("b"))
    assert clean_column_names(df).columns == ["a", "col_1", "b"]


def test_time_slots(spark):
    hours = [0, 3, 5, 6, 9, 11, 12, 15, 17, 18, 21, 23, None]
    df = spark.createDataFrame([(h,) for h in hours], "h int")
    got = [r[0] for r in df.select(S.time_slot("h")).collect()]
    want = ["midnight"] * 3 + ["morning"] * 3 + ["afternoon"] * 3 + ["night"] * 3 + ["night"]
    assert got == want


def test_log1p(spark):
    vals = [0.0, 1.0, 10.0, 100.0, 1_000_000.0, 1e18]
    df = spark.createDataFrame([(v,) for v in vals], "v double")
    got = [r[0] for r in df.select(F.log1p("v")).collect()]
    assert got[0] == 0.0
    for v, g in zip(vals, got):
        assert math.isfinite(g) and math.isclose(g, math.log1p(v), rel_tol=1e-12)


def test_smoothed_rate(spark):
    df = spark.createDataFrame([(0, 10), (10, 10), (3, 10)], "f long, n long")
    got = [r[0] for r in df.select(S.smoothed_rate("f", "n")).collect()]
    assert got == [1 / 11, 1.0, 4 / 11]


def test_contract_flag(spark):
    df = spark.createDataFrame([("0xABC123",), ("0x",), ("",), (None,)], "c string")
    assert [r[0] for r in df.select(S.contract_flag("c")).collect()] == [1, 1, 0, 0]


def test_contract_flag_absent_column(spark):
    df = tx_from_records(spark, [{"hash": "a", "timeStamp": "1"}]).drop("contractAddress")
    assert prepare_transactions(df).select("is_contract_call").first()[0] == 0


def test_zscore(spark):
    df = spark.createDataFrame([(120.0, 100.0, 10.0), (100.0, 100.0, 0.0), (90.0, 100.0, 10.0)], "x double, m double, s double")
    assert [r[0] for r in df.select(S.zscore("x", "m", "s")).collect()] == [2.0, None, -1.0]


def test_spike_rule(spark):
    df = spark.createDataFrame([(3.5, 15, 1.0), (5.0, 5, 1.0), (2.5, 15, 1.0), (9.0, 15, None)], "z double, n long, s double")
    assert [r[0] for r in df.select(S.spike_flag("n", "s", "z")).collect()] == [1, 0, 0, 0]


def test_epoch_conversion(spark):
    df = tx_rows(spark, [{"f": "a", "t": "b", "ts": t} for t in (1609459200, 1609502400, 1609545600)])
    rows = df.orderBy("timeStamp").select("hour", F.col("date").cast("string"), "time_slot").collect()
    assert [tuple(r) for r in rows] == [(0, "2021-01-01", "midnight"), (12, "2021-01-01", "afternoon"), (0, "2021-01-02", "midnight")]


def test_week_start_is_monday(spark):
    df = tx_rows(spark, [{"f": "a", "t": "b", "ts": 1704326400}])  # Thursday 2024-01-04
    assert str(df.select("week_start").first()[0]) == "2024-01-01 00:00:00"


def test_group_by_sender(spark):
    df = tx_rows(spark, [{"f": f, "t": "x", "ts": 1, "err": e} for f, e in zip("AABA", [0, 1, 0, 0])])
    out = {r["from"]: r for r in activity_stats(df, "from").collect()}
    assert len(out) == 2
    assert out["A"]["total_tx_count_from"] == 3 and out["A"]["total_fail_count_from"] == 1


def test_casts_are_lenient(spark):
    df = prepare_transactions(tx_from_records(spark, [{"hash": "a", "value": "", "gasPrice": "abc", "isError": "1"}]))
    r = df.first()
    assert r["value"] is None and r["gasPrice"] is None and r["isError"] == 1.0


def test_value_above_2_63_survives_as_double(spark):
    df = prepare_transactions(tx_from_records(spark, [{"hash": "a", "value": "12345678901234567890123"}]))
    assert df.first()["value"] > 2.0**63


def test_function_name_clean(spark):
    df = prepare_transactions(
        tx_from_records(spark, [{"functionName": "transfer(address,uint256)"}, {"functionName": ""}, {"functionName": None}, {"functionName": "swap"}])
    )
    assert [r[0] for r in df.select("functionName").collect()] == ["transfer", "", None, "swap"]


def test_missing_columns_audit(spark):
    df = tx_from_records(spark, [{"hash": "a"}]).drop("nonce", "gas")
    assert missing_columns(df) == ["nonce", "gas"]

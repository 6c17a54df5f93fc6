import datetime as dt

import pytest
from pyspark.sql import functions as F

from ledgerlens.operators import reports as R

SCHEMA = "tx_hash string, from_address string, to_address string, value_eth double, timestamp timestamp, anomaly_score double, fraud_flag int"


def view(spark, rows):
    out = []
    for i, r in enumerate(rows):
        out.append(
            (
                r.get("h", f"t{i}"),
                r.get("f", "A"),
                r.get("to", "Z"),
                r.get("v", 1.0),
                r.get("ts", dt.datetime(2024, 1, 1, 10)),
                r.get("s", 0.5),
                r.get("flag", 0),
            )
        )
    return spark.createDataFrame(out, SCHEMA)


def test_min_score_inclusive(spark):
    v = view(spark, [{"s": s} for s in (0.3, 0.5, 0.8, 0.95)])
    assert R.min_score_filter(v, 0.8).count() == 2
    v2 = view(spark, [{"s": s} for s in (0.1, 0.5, 0.9)])
    assert R.min_score_filter(v2, 0.0).count() == 3 and R.min_score_filter(v2, 1.0).count() == 0


def test_min_score_is_unbounded(spark):
    v = view(spark, [{"s": s} for s in (5.0, 50.0, 500.0)])
    assert R.min_score_filter(v, 40.0).count() == 2


def test_kpis(spark):
    v = view(spark, [{"flag": f, "s": s, "f": a} for f, s, a in zip([1, 0, 1, 0, 0], [0.5, 0.7, 0.9, 0.3, 0.6], "AABCC")])
    k = R.kpi_summary(v, 0.6).first()
    assert k["total_tx"] == 5 and k["fraud_tx"] == 2 and k["fraud_rate"] == pytest.approx(0.4)
    assert k["suspicious_tx"] == 3 and k["avg_score"] == pytest.approx(0.6) and k["max_score"] == pytest.approx(0.9)
    assert k["unique_suspicious_senders"] == 2


def test_flag_count_and_distinct_senders(spark):
    v = view(spark, [{"flag": f} for f in (1, 0, 1, 1, 0)])
    assert R.kpi_summary(v, 0.0).first()["fraud_tx"] == 3
    v2 = view(spark, [{"f": a, "flag": f} for a, f in zip("AABC", (1, 1, 1, 0))])
    assert R.kpi_summary(v2, 0.0).first()["unique_suspicious_senders"] == 2


def test_kpis_on_empty(spark):
    k = R.kpi_summary(view(spark, []), 0.5).first()
    assert k["total_tx"] == 0 and k["fraud_rate"] == 0.0 and k["fraud_tx"] == 0


def test_top_senders(spark):
    v = view(spark, [{"f": a, "flag": f} for a, f in zip("AABAC", (1, 1, 1, 0, 1))])
    rows = R.top_suspicious_senders(v).collect()
    assert rows[0]["from_address"] == "A" and rows[0]["fraud_tx"] == 2
    assert R.top_suspicious_senders(v, 1).count() == 1


def test_daily_trend_fills_gaps(spark):
    ts = [dt.datetime(2024, 1, 1, 10), dt.datetime(2024, 1, 1, 11), dt.datetime(2024, 1, 4, 10)]
    v = view(spark, [{"ts": t, "flag": f} for t, f in zip(ts, (1, 0, 1))])
    rows = R.daily_trend(v).orderBy("date").collect()
    assert [str(r["date"]) for r in rows] == ["2024-01-01", "2024-01-02", "2024-01-03", "2024-01-04"]
    assert [r["total_tx"] for r in rows] == [2, 0, 0, 1]
    assert [r["fraud_tx"] for r in rows] == [1, 0, 0, 1]


def test_dashboard_end_to_end(spark):
    v = view(spark, [{"s": 0.3, "flag": 0}, {"s": 0.9, "flag": 1}])
    k = R.kpi_summary(v, 0.5).first()
    assert (k["total_tx"], k["suspicious_tx"], k["fraud_rate"]) == (2, 1, 0.5)


def test_score_distribution_drops_nulls(spark):
    v = view(spark, [{"s": s} for s in (0.5, 0.5, 0.7, None)])
    rows = R.score_distribution(v).collect()
    assert [(r[0], r[1]) for r in rows] == [(0.5, 2), (0.7, 1)]


def test_tx_search(spark):
    ts = [dt.datetime(2024, 1, d, 12) for d in (1, 5, 9)]
    v = view(spark, [{"ts": t, "f": a, "to": b, "v": val} for t, a, b, val in zip(ts, "ABC", "XAY", (1.0, 2.0, 3.0))])
    got = R.tx_search(v, addresses=["A"], date_from="2024-01-01", date_to="2024-01-05").select("tx_hash").collect()
    assert sorted(r[0] for r in got) == ["t0", "t1"]
    assert R.tx_search(v, min_value=2.5).count() == 1


def test_prf_metrics(spark):
    df = spark.createDataFrame([(1, -1), (1, 1), (0, -1), (0, 1), (1, -1)], "truth int, pred_label int")
    r = R.prf_metrics(df, F.col("truth") == 1, F.col("pred_label") == -1).first()
    assert (r["tp"], r["fp"], r["fn"], r["tn"]) == (2, 1, 1, 1)
    assert r["precision"] == pytest.approx(2 / 3, abs=1e-6) and r["recall"] == pytest.approx(2 / 3, abs=1e-6)
    assert r["f1"] == pytest.approx(2 / 3, abs=1e-6)


def test_top_k_plans_without_global_sort(spark):
    df = spark.range(1000).select(F.col("id").cast("string").alias("hash"), (F.col("id") % 97).cast("double").alias("anomaly_score"))
    top = R.top_k_suspicious(df, 10)
    assert "TakeOrderedAndProject" in top._jdf.queryExecution().executedPlan().toString()
    assert top.first()["anomaly_score"] == 96.0


def test_address_profile(spark):
    from helpers import T0, tx_rows

    tx = tx_rows(spark, [{"f": "a", "t": "b", "ts": T0, "v": 1.0}, {"f": "a", "t": "c", "ts": T0 + 86400, "v": 3.0}, {"f": "b", "t": "a", "ts": T0, "v": 5.0}])
    p = {r["address"]: r for r in R.address_profile(tx).collect()}
    assert p["a"]["sent_count"] == 2 and p["a"]["received_count"] == 1 and p["a"]["sent_value"] == 4.0
    assert p["a"]["unique_counterparties"] == 2 and p["a"]["active_days"] == 2
    assert p["a"]["sender_receiver_ratio"] == 2.0 and p["c"]["sent_count"] == 0


def test_score_histogram(spark):
    v = view(spark, [{"s": s} for s in (0.05, 0.15, 0.16, 0.95, None)])
    rows = {r["bin"]: r["tx_count"] for r in R.score_histogram(v, 0.0, 1.0, 10).collect()}
    assert rows == {1: 1, 2: 2, 10: 1}


def test_value_quantiles_and_most_suspicious(spark):
    from helpers import T0, tx_rows

    tx = tx_rows(spark, [{"f": "a", "t": "b", "ts": T0 + i, "v": float(i)} for i in range(101)])
    q = R.value_quantiles(tx, {"median": 0.5, "q90": 0.9}).first()
    assert (q["from_address"], q["median"], q["q90"]) == ("a", 50.0, 90.0)
    scored = spark.createDataFrame([("x", 1.0), ("y", 9.0), ("z", 3.0)], "hash string, anomaly_score double")
    assert R.most_suspicious_hash(scored).first()["hash"] == "y"

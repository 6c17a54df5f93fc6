import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerlens.operators.scoring import (
    add_anomaly_score,
    add_labels,
    exact_percentile,
    label_summary,
    score_threshold,
    score_transactions,
)


def test_sum_of_squared_z(spark):
    x = [1.0, 2.0, 3.0, 10.0]
    y = [5.0, 5.0, 6.0, 4.0]
    df = spark.createDataFrame(list(zip(["a", "b", "c", "d"], x, y)), "hash string, log_value double, log_gasPrice double")
    scored, used = add_anomaly_score(df)
    assert used == ["log_value", "log_gasPrice"]
    zx = (np.array(x) - np.mean(x)) / np.std(x, ddof=1)
    zy = (np.array(y) - np.mean(y)) / np.std(y, ddof=1)
    got = [r["anomaly_score"] for r in scored.orderBy("hash").collect()]
    assert np.allclose(got, zx**2 + zy**2)


def test_constant_feature_is_skipped(spark):
    df = spark.createDataFrame([("a", 1.0, 7.0), ("b", 3.0, 7.0)], "hash string, log_value double, log_gasPrice double")
    scored, _ = add_anomaly_score(df)
    rows = scored.orderBy("hash").collect()
    assert all(r["log_gasPrice_z"] is None for r in rows)
    assert [r["anomaly_score"] for r in rows] == pytest.approx([0.5, 0.5])


def test_null_policy(spark):
    df = spark.createDataFrame([("a", 1.0, 1.0), ("b", 2.0, None), ("c", 3.0, 5.0)], "hash string, log_value double, log_gasPrice double")
    prop, _ = add_anomaly_score(df)
    skip, _ = add_anomaly_score(df, null_policy="skip")
    assert prop.filter(F.col("hash") == "b").first()["anomaly_score"] is None
    assert skip.filter(F.col("hash") == "b").first()["anomaly_score"] == pytest.approx(0.0)


def test_no_features(spark):
    df = spark.createDataFrame([("a",)], "hash string")
    scored, used = add_anomaly_score(df)
    assert used == [] and scored.first()["anomaly_score"] == 0.0
    assert add_labels(scored, None).first()["pred_label"] == 1


def test_label_at_threshold(spark):
    df = spark.createDataFrame([(15.0,), (5.0,), (10.0,), (None,)], "anomaly_score double")
    assert [r[0] for r in add_labels(df, 10.0).select("pred_label").collect()] == [-1, 1, -1, 1]


def test_percentile_of_0_to_99(spark):
    df = spark.range(100).select(F.col("id").cast("double").alias("anomaly_score"))
    t = score_threshold(df)
    assert t >= 97 and t == pytest.approx(np.percentile(np.arange(100), 99))


@pytest.mark.parametrize("n,q,ties", [(1, 0.99, False), (2, 0.5, False), (5000, 0.99, True), (5000, 0.01, False), (20000, 0.99, False)])
def test_exact_percentile_matches_numpy(spark, n, q, ties):
    rng = np.random.default_rng(n)
    vals = rng.integers(0, 50, n).astype(float) if ties else rng.standard_cauchy(n)
    df = spark.createDataFrame([(float(v),) for v in vals] + [(None,)], "v double")
    # a small collect limit forces the bracketing passes
    got = exact_percentile(df, "v", q, max_collect=300, accuracy=200)
    assert got == pytest.approx(float(np.percentile(vals, 100 * q)), rel=1e-12, abs=1e-12)


def test_all_null_scores(spark):
    df = spark.createDataFrame([(None,), (None,)], "anomaly_score double")
    assert score_threshold(df) is None
    assert [r[0] for r in add_labels(df, score_threshold(df)).select("pred_label").collect()] == [1, 1]


def test_outlier_gets_top_score(spark):
    df = spark.createDataFrame([("a", 100.0), ("b", 101.0), ("c", 99.0), ("d", 1000.0)], "hash string, log_value double")
    scored, _ = add_anomaly_score(df)
    assert scored.orderBy(F.desc("anomaly_score")).first()["hash"] == "d"


def test_score_transactions_and_summary(spark):
    rng = np.random.default_rng(7)
    vals = rng.normal(size=1000)
    df = spark.createDataFrame([(f"h{i}", float(v)) for i, v in enumerate(vals)], "hash string, log_value double")
    labeled, used, thr = score_transactions(df)
    s = {r["pred_label"]: r for r in label_summary(labeled).collect()}
    assert s[-1]["count"] == 10 and s[1]["count"] == 990
    assert s[-1]["pct"] == pytest.approx(1.0)
    assert math.isfinite(thr)


def test_approx_method_is_available(spark):
    df = spark.range(1000).select(F.col("id").cast("double").alias("anomaly_score"))
    assert score_threshold(df, method="approx") >= 970


@pytest.mark.parametrize("shape", ["two", "equal", "tied_at_rank"])
def test_percentile_ends_on_ties(spark, shape):
    n = 400_000
    v = {
        "two": F.when(F.col("id") % 2 == 0, 1.0).otherwise(2.0),
        "equal": F.lit(7.0),
        "tied_at_rank": F.when(F.col("id") < 0.985 * n, F.col("id").cast("double")).otherwise(1e9),
    }[shape]
    df = spark.range(n).select(v.alias("v"))
    want = {"two": 2.0, "equal": 7.0, "tied_at_rank": 1e9}[shape]
    assert exact_percentile(df, "v", 0.99) == want
    ends = {"two": 1.0, "equal": 7.0, "tied_at_rank": 0.0}[shape]
    assert exact_percentile(df, "v", 0.0, max_collect=10) == ends


def test_percentile_between_two_runs_of_ties(spark):
    df = spark.range(1000).select(F.when(F.col("id") < 500, 1.0).otherwise(3.0).alias("v"))
    assert exact_percentile(df, "v", 0.5, max_collect=5, accuracy=50) == pytest.approx(2.0)


def test_threshold_reads_only_the_scores(spark, monkeypatch):
    from ledgerlens.operators import scoring

    read = []
    own = scoring.score_threshold
    monkeypatch.setattr(scoring, "score_threshold", lambda df, *a, **k: read.append(df) or own(df, *a, **k))
    rows = [(str(i), float(i), float(i * i % 7)) for i in range(300)]
    df = spark.createDataFrame(rows, "hash string, log_value double, log_gasPrice double")
    lab, _, t = scoring.score_transactions(df)
    plan = read[0]._jdf.queryExecution().optimizedPlan().toString()
    assert read[0].columns == ["anomaly_score"] and "log_value" not in plan
    scores = sorted(r[0] for r in lab.select("anomaly_score").collect())
    assert t == pytest.approx(np.quantile(scores, 0.99))


def test_generated_methods_are_small_enough_to_be_compiled(spark):
    from ledgerlens.session import ensure_session

    spark.conf.unset("spark.sql.codegen.hugeMethodLimit")
    assert int(ensure_session(spark).conf.get("spark.sql.codegen.hugeMethodLimit")) == 8000

"""Saved model, search table, bucketed table, exact quantiles of large senders,
distinct sketches, labels of the caller and ranking metrics."""

import datetime as dt
import os
import random
import uuid

import pytest
from pyspark.sql import functions as F

from ledgerlens.operators import reports as R
from ledgerlens.operators.classifier import time_split, with_labels
from ledgerlens.operators.scoring import score_transactions
from ledgerlens.operators.zscore_model import ZScoreModel, versions
from ledgerlens.plans import queries as Q
from ledgerlens.plans.jobs import scoring_job
from ledgerlens.sources import sinks
from conftest import SF0001


@pytest.fixture(scope="module")
def features(spark):
    return Q.materialize(Q.features(spark, SF0001).select(*[f"`{c}`" for c in Q.SCORING_INPUT]), "features")


# --- saved model ----------------------------------------------------------------


def test_a_saved_model_scores_as_the_fitted_one(spark, features, tmp_dir):
    path = os.path.join(tmp_dir, "model")
    assert versions(spark, path) == []
    model = ZScoreModel.fit(features)
    assert model.save(spark, path) == 1 and model.save(spark, path) == 2 and versions(spark, path) == [1, 2]
    again = ZScoreModel.load(spark, path, 1)
    assert again == model
    direct, _, threshold = score_transactions(features)
    assert threshold == pytest.approx(again.threshold, rel=1e-12)
    want = {r["hash"]: (r["anomaly_score"], r["pred_label"]) for r in direct.collect()}
    got = {r["hash"]: (r["anomaly_score"], r["pred_label"]) for r in again.apply(features).collect()}
    assert got.keys() == want.keys()
    assert all(got[k][1] == want[k][1] and got[k][0] == pytest.approx(want[k][0], rel=1e-9) for k in want if want[k][0] is not None)
    with pytest.raises(ValueError):
        again.apply(features.drop("log_value"))


def test_constant_features_and_empty_tables(spark, tmp_dir):
    rows = spark.createDataFrame([("a", 1.0, 2.0), ("b", 3.0, 2.0), ("c", None, 2.0)], "hash string, log_value double, log_gasPrice double")
    model = ZScoreModel.fit(rows, ["log_value", "log_gasPrice"])
    path = os.path.join(tmp_dir, "m")
    model.save(spark, path)
    got = {r["hash"]: r for r in ZScoreModel.load(spark, path).apply(rows).collect()}
    assert got["a"]["log_gasPrice_z"] is None and got["c"]["anomaly_score"] is None and got["c"]["pred_label"] == 1
    assert model.apply(rows.limit(0)).collect() == []
    assert ZScoreModel.fit(rows.limit(0), ["log_value"]).threshold is None


def test_scoring_job_leaves_other_dates_alone(spark, features, tmp_dir):
    path, pred, model = (os.path.join(tmp_dir, x) for x in ("features", "pred", "model"))
    sinks.write_partitioned(features, path)
    dates = sorted(r[0] for r in features.select("date").distinct().collect())
    scoring_job(spark, path, pred, model_path=model, dates=dates[:20])
    folder = lambda d: os.path.join(pred, f"date={d}")
    before = {d: os.stat(folder(d)).st_mtime_ns for d in dates[:20]}
    _, threshold = scoring_job(spark, path, pred, model_path=model, dates=dates[20:])
    assert versions(spark, model) == [1] and threshold == ZScoreModel.load(spark, model).threshold
    assert {d: os.stat(folder(d)).st_mtime_ns for d in dates[:20]} == before
    assert spark.read.parquet(pred).count() == features.count()


# --- stored tables ----------------------------------------------------------------


def _footers(spark, path):
    """(column, has a bloom filter) of every column chunk under a path."""
    jvm = spark._jvm
    conf = spark._jsc.hadoopConfiguration()
    for folder, _, names in os.walk(path):
        for name in names:
            if name.endswith(".parquet"):
                file = jvm.org.apache.parquet.hadoop.util.HadoopInputFile.fromPath(jvm.org.apache.hadoop.fs.Path(os.path.join(folder, name)), conf)
                reader = jvm.org.apache.parquet.hadoop.ParquetFileReader.open(file)
                for block in reader.getFooter().getBlocks():
                    for column in block.getColumns():
                        yield column.getPath().toDotString(), column.getBloomFilterOffset() > 0
                reader.close()


def test_search_table_has_filters_and_prunes(spark, tmp_dir):
    # so many addresses that their columns are not held by a dictionary
    n = 120_000
    rows = spark.range(n).select(
        F.col("id").cast("string").alias("hash"),
        F.sha2(F.col("id").cast("string"), 256).alias("from"),
        F.sha2((F.col("id") * 7).cast("string"), 256).alias("to"),
        F.col("id").cast("double").alias("value"),
        F.timestamp_seconds(F.lit(1704067200) + F.col("id") % 3 * 86400).alias("datetime"),
        F.col("id").cast("double").alias("anomaly_score"),
        F.lit(1).alias("pred_label"),
    ).withColumn("date", F.to_date("datetime"))
    path = os.path.join(tmp_dir, "search")
    sinks.write_search_table(rows, path, parts=1)
    by = {}
    for column, has in _footers(spark, path):
        by.setdefault(column, []).append(has)
    assert all(by["from"]) and all(by["to"]) and not any(by["value"])
    stored = spark.read.parquet(path)
    one = rows.filter("hash = '31'").first()
    found = R.search_stored(stored, addresses=[one["from"]], date_from="2024-01-02", date_to="2024-01-02")
    got = sorted(r["tx_hash"] for r in found.collect())
    assert got == sorted(r["hash"] for r in rows.filter((F.col("from") == one["from"]) | (F.col("to") == one["from"])).filter("date = '2024-01-02'").collect()) and "31" in got
    plan = found._jdf.queryExecution().executedPlan().toString()
    scan = next(x for x in plan.splitlines() if "FileScan parquet" in x)
    assert "date" in scan.split("PartitionFilters:")[1].split("PushedFilters")[0]
    assert R.search_stored(stored, date_from="2024-01-02", date_to="2024-01-02").count() == n // 3


def test_bucketed_reports_have_no_exchange(spark, features, tmp_dir):
    labeled, _, _ = score_transactions(features)
    name = f"bucketed_{uuid.uuid4().hex}"
    table = sinks.write_bucketed(labeled, name, os.path.join(tmp_dir, "bucketed"), buckets=4)
    report = R.address_risk(table)
    assert "Exchange" not in report._jdf.queryExecution().executedPlan().toString()
    assert sorted(map(tuple, report.collect())) == sorted(map(tuple, R.address_risk(labeled).collect()))
    assert not spark.catalog.tableExists(name)


# --- quantiles and distinct counts ----------------------------------------------


def test_quantiles_of_a_large_sender_are_exact(spark):
    rng = random.Random(8)
    # 200,000 rows of one sender, half of them ties, beside small senders
    rows = [("big", float(rng.randrange(50) if i % 2 else rng.randrange(10**6))) for i in range(200_000)]
    rows += [("small", float(i)) for i in range(7)] + [("none", None), (None, 1.0)]
    df = spark.createDataFrame(rows, "`from` string, value double")
    for accuracy in (10_000, 100):
        got = {r["from_address"]: tuple(r)[1:] for r in R.value_quantiles(df, accuracy=accuracy).collect()}
        own = sorted(v for k, v in rows if k == "big")
        assert got["big"] == tuple(own[-(-len(own) * p // 100) - 1] for p in (25, 50, 75))
        assert got["small"] == (1.0, 3.0, 5.0) and got["none"] == (None, None, None) and None not in got
    assert R.value_quantiles(df.limit(0)).collect() == []


def test_distinct_sketches_merge_over_any_period(spark):
    rows = spark.range(60_000).select(
        F.lit("a").alias("from"), F.concat(F.lit("b"), F.col("id") % 20_000).alias("to"), F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 6).cast("int")).alias("date")
    )
    sketches = Q.materialize(R.counterparty_sketches(rows), "sketches")
    assert sketches.filter("address = 'a'").count() == 6
    for until, exact in (("2024-01-06", 20_000), ("2024-01-02", rows.filter("date <= '2024-01-02'").select("to").distinct().count())):
        got = R.merged_counterparties(sketches, "2024-01-01", until).filter("address = 'a'").first()["counterparties"]
        assert abs(got - exact) <= 4 * R.SKETCH_ERROR * exact


# --- labels -------------------------------------------------------------------------


def test_labels_of_the_caller(spark):
    rows = spark.createDataFrame([("h1", dt.datetime(2024, 1, 1)), ("h2", dt.datetime(2024, 2, 1)), ("h3", None), ("h4", None)], "hash string, datetime timestamp")
    labels = spark.createDataFrame([("h1", 1), ("h1", 1), ("h2", 0), ("h3", 0), ("h3", 1), ("h9", 1)], "hash string, label int")
    got = {r["hash"]: (r["label"], r["train"]) for r in with_labels(rows, labels).withColumn("train", time_split(F.col("datetime"), "2024-01-15")).collect()}
    assert got == {"h1": (1.0, True), "h2": (0.0, False), "h3": (None, False), "h4": (None, False)}


def test_ranking_metrics(spark):
    rng = random.Random(2)
    rows = [(float(rng.randrange(30)), rng.randrange(2)) for _ in range(400)] + [(None, 1), (5.0, None)]
    got = R.ranking_metrics(spark.createDataFrame(rows, "s double, y int"), "s", "y").first()
    known = [(s, y) for s, y in rows if s is not None and y is not None]
    pos, neg = [s for s, y in known if y], [s for s, y in known if not y]
    area = sum((p > n) + (p == n) / 2 for p in pos for n in neg) / (len(pos) * len(neg))
    assert (got["n_rows"], got["n_positive"]) == (400, len(pos)) and got["roc_auc"] == pytest.approx(area, abs=1e-6)
    ap = sum(sum(t >= p for t in pos) / sum(t >= p for t, _ in known) for p in pos) / len(pos)
    assert got["average_precision"] == pytest.approx(ap, abs=1e-6)
    empty = R.ranking_metrics(spark.createDataFrame([], "s double, y int"), "s", "y").first()
    assert (empty["n_rows"], empty["roc_auc"]) == (0, None)

"""Batch entry points matching the two scheduled jobs of the original
deployment: the feature job (landed payloads -> feature table) and the
scoring job (feature table -> predictions, CSV reports, run metadata,
optional JDBC table)."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.operators.features import build_features
from ledgerlens.operators.prepare import clean_column_names, missing_columns, prepare_transactions
from ledgerlens.operators.reports import predictions_view
from ledgerlens.operators.scoring import label_summary, materialize, score_transactions
from ledgerlens.operators.temporal import add_temporal_features
from ledgerlens.operators.zscore_model import ZScoreModel, versions
from ledgerlens.session import ensure_session
from ledgerlens.sources import sinks
from ledgerlens.sources.raw_json import flatten_payloads, read_raw_payloads, split_payloads


def feature_job(
    spark: SparkSession,
    landing_path: str,
    features_path: str,
    rejects_path: str | None = None,
    multi_line: bool = False,
) -> dict:
    """Landed payloads -> feature table partitioned by date.

    Returns a small summary: missing raw fields and the number of rejected
    payloads (written to ``rejects_path`` when given).
    """
    ensure_session(spark)
    payloads = materialize(read_raw_payloads(spark, landing_path, multi_line), "payloads")  # JSON is parsed once
    valid, rejects = split_payloads(payloads)
    if rejects_path:
        rejects.write.mode("overwrite").json(rejects_path)
    flat = clean_column_names(flatten_payloads(valid))
    missing = missing_columns(flat)
    tx = add_temporal_features(prepare_transactions(flat))
    feats = clean_column_names(build_features(tx))
    sinks.write_partitioned(feats, features_path, partition_col="date")
    return {"missing_fields": missing, "rejected_payloads": rejects.count() if rejects_path else None}


def scoring_job(
    spark: SparkSession,
    features_path: str,
    predictions_path: str,
    report_path: str | None = None,
    jdbc: dict | None = None,
    run_ts: _dt.datetime | None = None,
    model_path: str | None = None,
    dates: list[_dt.date] | None = None,
) -> tuple[DataFrame, float | None]:
    """Feature table -> scored and labelled predictions.

    With ``model_path`` the latest saved model scores the rows, and is fitted
    on all of them and saved first where there is none; without, a model is
    fitted for this run alone. ``dates`` are the dates to score: the date
    folders of others are neither read nor written.

    Writes the predictions (partitioned by date), and under ``report_path``
    the full CSV, the anomalies-only CSV and the run metadata; appends the
    relational predictions table when ``jdbc`` (url, table, properties) is
    given. Returns the label summary and the threshold.
    """
    ensure_session(spark)
    features = spark.read.parquet(features_path)
    if model_path:
        if not versions(spark, model_path):
            ZScoreModel.fit(features).save(spark, model_path)
        model = ZScoreModel.load(spark, model_path)
        used, threshold = model.features, model.threshold
    if dates is not None:
        features = features.filter(F.col("date").isin(dates))
    if model_path:
        labeled = model.apply(features)
    else:
        labeled, used, threshold = score_transactions(features, persist=False)  # a table already
    sinks.write_predictions(labeled, predictions_path)
    stored = spark.read.parquet(predictions_path)
    if "date" in features.columns:  # not the dates that earlier runs left there
        days = features.select(F.col("date").alias("_day")).distinct()
        stored = stored.join(days, stored["date"].eqNullSafe(days["_day"]), "left_semi")
    if report_path:
        ts = (run_ts or _dt.datetime.now(_dt.timezone.utc)).strftime("%Y-%m-%dT%H-%M-%S")
        sinks.write_csv(stored, f"{report_path}/predictions_{ts}")
        sinks.write_anomalies_csv(stored, f"{report_path}/anomalies_{ts}")
        sinks.write_run_metadata(sinks.run_metadata(spark, used, run_ts), f"{report_path}/metadata_{ts}")
    if jdbc:
        sinks.write_jdbc(predictions_view(stored), jdbc["url"], jdbc["table"], jdbc.get("properties", {}))
    return label_summary(stored), threshold


def daily_rejects(rejects: DataFrame) -> DataFrame:
    """Rejected payloads per landing day, from the file path: folders
    ``YYYY/MM/DD`` or ``year=YYYY/month=MM/day=DD``; NULL for other paths."""
    part = [F.regexp_extract(F.col("source_file"), r"(?:year=)?(\d{4})/(?:month=)?(\d{2})/(?:day=)?(\d{2})/", i) for i in (1, 2, 3)]
    day = F.when(part[0] != "", F.concat_ws("/", *part))
    return rejects.groupBy(day.alias("landing_day")).agg(F.count(F.lit(1)).alias("rejected"))

"""Registered queries: each takes (spark, sf_dir) and returns a DataFrame.

All of them read the ``events`` table through the transaction mapping and
run over every row. Output columns carry explicit aliases; doubles that come
out of floating aggregates are rounded to 6 decimals (their last bits depend
on summation order).
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.functions.scalar import landing_key, parse_timestamp, round6
from ledgerlens.operators import amounts
from ledgerlens.operators import reports as R
from ledgerlens.operators.aggregates import activity_stats
from ledgerlens.operators.classifier import classifier_scores, fit_classifier, time_split, with_labels
from ledgerlens.operators.encoding import add_indices, sparse_dummies, sparse_onehot
from ledgerlens.operators.features import DERIVED_COLS, build_features, daily_intervals
from ledgerlens.operators.iforest import fit_isolation_forest, score_isolation_forest
from ledgerlens.operators.prepare import clean_column_names, drop_identifiers, model_input, prepare_transactions, q
from ledgerlens.operators.scoring import (
    add_anomaly_score,
    feature_stats,
    label_summary,
    materialize,
    materialize_features,
    score_threshold,
    score_transactions,
)
from ledgerlens.operators.temporal import add_temporal_features
from ledgerlens.operators.zscore_model import ZScoreModel
from ledgerlens.schema import ENCODED_COLS, FEATURE_COLS
from ledgerlens.session import ensure_session, scratch_dir
from ledgerlens.plans.jobs import daily_rejects
from ledgerlens.sources.raw_json import flatten_payloads, payloads_from_tx, read_raw_payloads, split_payloads
from ledgerlens.sources import sinks
from ledgerlens.sources.sinks import landing_frame, write_landing, write_partitioned
from ledgerlens.sources.tables import read_partitioned, register_parquet_table
from ledgerlens.sources.testdata import load_raw_tx, load_table, raw_tx_from_events
from ledgerlens.streaming.incremental import ingest_new_payloads
from ledgerlens.streaming.refresh import FeatureTables, read_features, refresh_features

MIN_SCORE = 50.0  # dashboard minimum-score parameter used by the report queries
SEARCH = {
    "addresses": ["7", "42", "99"],
    "date_from": "2024-01-08",
    "date_to": "2024-01-21",
    "min_value": 0.0,
    "max_value": 1e-16,
}
SCAN_DATES = ("2024-01-08", "2024-01-14")
# the second landing of features_incremental, and from when it has late rows
SECOND_FROM, LATE_FROM = "2024-01-16", "2024-01-12"


# --- shared stages ----------------------------------------------------------


def tx(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prepared transactions with temporal columns."""
    ensure_session(spark)
    return add_temporal_features(prepare_transactions(load_raw_tx(spark, sf_dir)))


def features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build_features(tx(spark, sf_dir))


# columns the scored/labelled queries read: identifiers, the serving views'
# columns and the model features. Selected before the feature table is
# written (a write is an action, so Catalyst cannot prune past it).
SCORING_INPUT = ["hash", "from", "to", "blockNumber", "value", "datetime", "date"] + FEATURE_COLS


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feature table is written once to the shared checkpoint folder (as
    the feature job writes it for the scoring job); the global statistics and
    the scored rows read the written columnar table instead of recomputing the
    windows."""
    feats, stats = materialize_features(features(spark, sf_dir).select(*[q(c) for c in SCORING_INPUT]))
    df, _ = add_anomaly_score(feats, stats=stats)
    return df


def labeled(spark: SparkSession, sf_dir: str) -> DataFrame:
    lab, _, _ = score_transactions(features(spark, sf_dir).select(*[q(c) for c in SCORING_INPUT]))
    return lab


def view(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.dashboard_view(labeled(spark, sf_dir))


def _addr(df: DataFrame) -> list:
    return [q("from").alias("from_address"), q("to").alias("to_address")]


# --- sources / sinks ----------------------------------------------------------


def raw_json_roundtrip(spark, sf_dir):
    """Land the transactions as API payloads (one per address and hour) in the
    year/month/day layout, scan them back with the explicit schema, keep the
    valid payloads and flatten."""
    ensure_session(spark)
    path = scratch_dir(spark, "landing")
    land(spark, load_raw_tx(spark, sf_dir), path)
    valid, _ = split_payloads(read_raw_payloads(spark, path))
    flat = prepare_transactions(flatten_payloads(valid))
    return flat.select(
        q("hash"), *_addr(flat), q("value"), q("gasPrice"), q("isError"), q("timeStamp"),
        q("functionName"), q("is_contract_call"),
    )


def payload_rejects(spark, sf_dir):
    """Land one payload per address and day, of which some are the API's error
    answers and some are cut off, and count the rejects of each landing day."""
    t = tx(spark, sf_dir)
    kind = q("from").cast("long") % 7
    fetches = t.groupBy("from", "date").agg(F.slice(F.collect_set("hash"), 1, 3).alias("hashes"))
    result = F.transform("hashes", lambda h: F.struct(h.alias("hash")))
    good = F.to_json(F.struct(F.lit("1").alias("status"), F.lit("OK").alias("message"), result.alias("result")))
    refused = F.to_json(F.struct(F.lit("0").alias("status"), F.lit("NOTOK").alias("message"), F.lit("Max rate limit reached").alias("result")))
    line = F.when(kind == 0, refused).when(kind == 1, F.substring(good, 1, 25)).otherwise(good)
    day = [F.date_format("date", f).alias(n) for f, n in (("yyyy", "year"), ("MM", "month"), ("dd", "day"))]
    path = scratch_dir(spark, "payloads")
    fetches.select(line.alias("value"), *day).write.partitionBy("year", "month", "day").text(path)
    _, rejects = split_payloads(read_raw_payloads(spark, path))
    return daily_rejects(rejects)


def feature_scan_pruned(spark, sf_dir):
    """Write the feature table partitioned by date, then scan one week of it:
    only that week's folders are read (partition filter) and only the
    selected columns (read schema)."""
    feats = features(spark, sf_dir)
    path = scratch_dir(spark, "features")
    write_partitioned(feats, path, partition_col="date")
    cols = ["hash", "from", "date", "daily_tx_count_from", "weekly_tx_count_from", "total_tx_count_from"]
    df = read_partitioned(spark, path, SCAN_DATES[0], SCAN_DATES[1], columns=cols)
    return df.select(
        "hash", q("from").alias("from_address"), "date",
        "daily_tx_count_from", "weekly_tx_count_from", "total_tx_count_from",
    )


def predictions_table(spark, sf_dir):
    """Write the predictions partitioned by date and read them back."""
    path = scratch_dir(spark, "predictions")
    sinks.write_predictions(labeled(spark, sf_dir), path)
    p = spark.read.parquet(path)
    return p.select("hash", *_addr(p), "date", round6("anomaly_score").alias("anomaly_score"), "pred_label")


def csv_roundtrip(spark, sf_dir):
    """Write prepared transactions as CSV with a header and read them back
    with a schema."""
    t = tx(spark, sf_dir).select("hash", q("from").alias("from_address"), "value", "gasPrice", "functionName", "date")
    path = scratch_dir(spark, "csv")
    sinks.write_csv(t, path)
    return spark.read.schema(t.schema).option("header", "true").csv(path)


def anomalies_csv(spark, sf_dir):
    """Write only the anomalous rows as CSV and read them back."""
    lab = labeled(spark, sf_dir).select("hash", q("from").alias("from_address"), "pred_label")
    path = scratch_dir(spark, "anomalies")
    sinks.write_anomalies_csv(lab, path)
    return spark.read.schema(lab.schema).option("header", "true").csv(path)


def run_metadata(spark, sf_dir):
    """Write a scoring run's metadata as JSON and read back its features."""
    _, used, _ = score_transactions(features(spark, sf_dir).select(*[q(c) for c in SCORING_INPUT]))
    path = scratch_dir(spark, "metadata")
    sinks.write_run_metadata(sinks.run_metadata(spark, used), path)
    m = spark.read.json(path)
    return m.select(F.posexplode("feature_names").alias("position", "feature"), "num_features", "threshold_percentile")


def catalog_table(spark, sf_dir):
    """Write transactions partitioned by date, register the files as an
    external table with its partitions, and query the table."""
    t = tx(spark, sf_dir).select("hash", q("from").alias("from_address"), "value", "date")
    path = scratch_dir(spark, "external")
    write_partitioned(t, path, partition_col="date")
    name = f"ledgerlens_tx_{uuid.uuid4().hex}"
    table = register_parquet_table(spark, name, path, ["date"])
    out = materialize(table.groupBy("date").agg(F.count(F.lit(1)).alias("n_tx"), F.max("value").alias("max_value")), "per_day")
    spark.sql(f"DROP TABLE {name}")  # the files stay, the catalog is left as it was
    return out


def dashboard_scan(spark, sf_dir):
    v = view(spark, sf_dir)
    return v.select(
        "tx_hash", "from_address", "to_address", "value_eth", "timestamp",
        round6(q("anomaly_score")).alias("anomaly_score"), "fraud_flag",
    ).orderBy("timestamp", "tx_hash")


def predictions_projection(spark, sf_dir):
    p = R.predictions_view(labeled(spark, sf_dir))
    return p.withColumn("anomaly_score", round6(q("anomaly_score")))


def anomalies_only(spark, sf_dir):
    a = R.anomalies_only(labeled(spark, sf_dir))
    return a.select("hash", *_addr(a), round6(q("anomaly_score")).alias("anomaly_score"), "pred_label")


# --- preparation --------------------------------------------------------------


def clean_names(spark, sf_dir):
    t = tx(spark, sf_dir)
    messy = t.select(
        q("hash").alias("  hash "), q("from").alias(""), q("to").alias("   "), q("value").alias("value ")
    )
    return clean_column_names(messy)


def tx_flags(spark, sf_dir):
    t = tx(spark, sf_dir)
    return t.select("hash", "methodId", "is_contract_call")


def function_name_clean(spark, sf_dir):
    t = tx(spark, sf_dir)
    return t.select("hash", "functionName")


def cast_numeric(spark, sf_dir):
    t = tx(spark, sf_dir)
    return t.select(
        "hash", "blockNumber", "timeStamp", "transactionIndex", "value", "gasPrice", "isError",
        *_addr(t), "methodId",
    )


def model_input_q(spark, sf_dir):
    m = model_input(features(spark, sf_dir))
    out = [q("hash"), q("from").alias("from_address"), q("to").alias("to_address"), "methodId", "functionName", "time_slot"]
    for c in FEATURE_COLS:
        out.append(round6(q(c).cast("double")).alias(c))
    return m.select(*out)


def temporal_features(spark, sf_dir):
    t = tx(spark, sf_dir)
    return t.select("hash", "datetime", "date", "week_start", "hour", "time_slot")


def log_values(spark, sf_dir):
    t = tx(spark, sf_dir)
    return t.select(
        "hash", round6(F.log1p("value")).alias("log_value"), round6(F.log1p("gasPrice")).alias("log_gasPrice")
    )


def landing_path(spark, sf_dir):
    """One landing key per (address, day) fetch, stamped with the time of the
    last transaction in it."""
    t = tx(spark, sf_dir)
    g = t.groupBy(q("from").alias("from_address"), "date").agg(
        F.count(F.lit(1)).alias("n_tx"), F.max("datetime").alias("run_ts")
    )
    return g.select(
        "from_address", "date", "n_tx",
        landing_key(q("from_address"), q("run_ts")).alias("landing_key"),
    )


# --- aggregates ---------------------------------------------------------------


def _stats(side, period):
    def run(spark, sf_dir):
        s = activity_stats(tx(spark, sf_dir), side, period, with_rate=True)
        name = {None: "total", "date": "daily", "week_start": "weekly"}[period]
        cols = [q(side).alias(f"{side}_address")] + ([q(period)] if period else [])
        cols += [f"{name}_tx_count_{side}", q(f"{name}_fail_count_{side}").cast("bigint").alias(f"{name}_fail_count_{side}"),
                 round6(q(f"{name}_fail_rate_{side}")).alias(f"{name}_fail_rate_{side}")]
        return s.select(*cols)
    return run


def _avg_interval(side):
    def run(spark, sf_dir):
        d = daily_intervals(tx(spark, sf_dir), side)
        return d.select(
            q(side).alias(f"{side}_address"), "date",
            round6(q(f"daily_avg_interval_{side}")).alias(f"daily_avg_interval_{side}"),
        )
    return run


def tx_intervals(spark, sf_dir):
    f = features(spark, sf_dir)
    return f.select("hash", "prev_datetime_from", "interval_from", "prev_datetime_to", "interval_to")


def rolling_stats(spark, sf_dir):
    f = features(spark, sf_dir)
    return f.select(
        "hash",
        round6("rolling_value_mean").alias("rolling_value_mean"),
        round6("rolling_value_std").alias("rolling_value_std"),
        round6("rolling_gasPrice_mean").alias("rolling_gasPrice_mean"),
        round6("rolling_gasPrice_std").alias("rolling_gasPrice_std"),
        "rolling_tx_count",
    )


def rolling_zscores(spark, sf_dir):
    f = features(spark, sf_dir)
    return f.select(
        "hash", round6("value_zscore").alias("value_zscore"), round6("gasPrice_zscore").alias("gasPrice_zscore")
    )


def spike_flags(spark, sf_dir):
    f = features(spark, sf_dir)
    return f.select("hash", "rolling_tx_count", "value_spike", "gasPrice_spike")


def gas_spike_rows(spark, sf_dir):
    g = R.gas_spike_rows(features(spark, sf_dir))
    return g.select("hash", q("from").alias("from_address"), "gasPrice", round6("gasPrice_zscore").alias("gasPrice_zscore"))


def _rounded_features(f: DataFrame) -> DataFrame:
    out = []
    for field in f.schema.fields:
        c = field.name
        if c in ("from", "to"):
            out.append(q(c).alias(f"{c}_address"))
        elif field.dataType.typeName() == "double" and c not in (
            "blockNumber", "timeStamp", "transactionIndex", "value", "gasPrice", "isError",
            "interval_from", "interval_to",
        ):
            out.append(round6(q(c)).alias(c))
        else:
            out.append(q(c))
    return f.select(*out)


def features_full(spark, sf_dir):
    return _rounded_features(features(spark, sf_dir))


def land(spark: SparkSession, raw: DataFrame, path: str) -> None:
    """Land transactions as API payloads, one per address and hour."""
    ts = F.timestamp_seconds(q("timeStamp").cast("long"))
    keyed = raw.withColumns({"_addr": q("from"), "_hour": F.date_trunc("hour", ts)})
    write_landing(landing_frame(payloads_from_tx(keyed, ["_addr", "_hour"]), "_addr", "_hour"), path)


def features_incremental(spark, sf_dir):
    """Land the first half of the month, ingest and refresh; land the rest,
    with late rows of the first half, ingest and refresh; read the features."""
    ensure_session(spark)
    raw = load_raw_tx(spark, sf_dir)
    day = F.to_date(F.timestamp_seconds(q("timeStamp").cast("long")))
    late = (day >= LATE_FROM) & (q("hash").cast("long") % 20 == 0)
    rest = (day >= SECOND_FROM) | late
    root = scratch_dir(spark, "incremental")
    tables = FeatureTables(f"{root}/transactions", f"{root}/tables")
    for part in (raw.filter(~rest), raw.filter(rest)):
        land(spark, part, f"{root}/landing")
        ingest_new_payloads(spark, f"{root}/landing", tables.transactions, f"{root}/stream", rejects_path=f"{root}/rejects")
        refresh_features(spark, tables)
    f = read_features(spark, tables)
    return _rounded_features(f.select(*[q(c) for c in [*tx(spark, sf_dir).columns, *DERIVED_COLS]]))


def daily_tx_stats(spark, sf_dir):
    return R.daily_tx_stats(tx(spark, sf_dir))


def _tx_wei(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transactions with their amount in wei as digits: the value's cents at
    10**16 wei each, and the event id below that, which a double would lose."""
    events = load_table(spark, sf_dir, "events")
    cents = F.round(F.col("value") * 100).cast("decimal(20,0)")
    wei = (cents * F.lit(10**16).cast("decimal(17,0)") + F.col("event_id").cast("decimal(19,0)")).cast("decimal(38,0)")
    raw = raw_tx_from_events(events.withColumn("value_text", wei.cast("string")), keep=["value_text"])
    ensure_session(spark)
    return add_temporal_features(prepare_transactions(raw))


def daily_tx_stats_wei(spark, sf_dir):
    return amounts.daily_tx_stats_wei(_tx_wei(spark, sf_dir))


def address_amounts_wei(spark, sf_dir):
    return amounts.address_amounts_wei(_tx_wei(spark, sf_dir))


# --- scoring --------------------------------------------------------------------


def feature_stats_q(spark, sf_dir):
    f = features(spark, sf_dir)
    s = feature_stats(f, FEATURE_COLS)
    return s.select(*[round6(q(c)).alias(c) for c in s.columns])


def zscore_scores(spark, sf_dir):
    s = scored(spark, sf_dir)
    return s.select(
        "hash",
        round6("log_value_z").alias("log_value_z"),
        round6("total_tx_count_from_z").alias("total_tx_count_from_z"),
        round6("value_zscore_z").alias("value_zscore_z"),
        round6("anomaly_score").alias("anomaly_score"),
    )


def score_threshold_q(spark, sf_dir):
    s = materialize(scored(spark, sf_dir).select("anomaly_score"), "scores")
    t = score_threshold(s)
    n = s.agg(F.count("anomaly_score").alias("n_scored"))
    return n.select(F.lit(t).cast("double").alias("t")).select(round6("t").alias("threshold")).crossJoin(n)


def pred_labels(spark, sf_dir):
    lab = labeled(spark, sf_dir)
    return lab.select("hash", round6("anomaly_score").alias("anomaly_score"), "pred_label")


def label_summary_q(spark, sf_dir):
    return label_summary(labeled(spark, sf_dir))


def top10_suspicious(spark, sf_dir):
    top = R.top_k_suspicious(labeled(spark, sf_dir), 10)
    return top.select("hash", *_addr(top), round6("anomaly_score").alias("anomaly_score"), "pred_label")


# --- dashboard reports -----------------------------------------------------------


def most_suspicious(spark, sf_dir):
    return R.most_suspicious_hash(labeled(spark, sf_dir))


def timestamp_parse(spark, sf_dir):
    """Timestamp texts in several forms, and texts that are none, parsed."""
    t = tx(spark, sf_dir)
    form = q("blockNumber").cast("long") % 4
    text = (
        F.when(form == 0, F.date_format("datetime", "yyyy-MM-dd HH:mm:ss"))
        .when(form == 1, F.date_format("datetime", "yyyy-MM-dd'T'HH:mm:ss"))
        .when(form == 2, F.date_format("datetime", "yyyy-MM-dd"))
        .otherwise(F.concat(F.lit("block "), q("hash")))
    )
    return t.select("hash", parse_timestamp(text).alias("parsed"))


def min_score_filter(spark, sf_dir):
    v = R.min_score_filter(view(spark, sf_dir), MIN_SCORE)
    return v.select("tx_hash", "from_address", round6("anomaly_score").alias("anomaly_score"), "fraud_flag")


def kpi_summary(spark, sf_dir):
    return R.kpi_summary(view(spark, sf_dir), MIN_SCORE)


def daily_trend(spark, sf_dir):
    return R.daily_trend(view(spark, sf_dir))


def score_distribution(spark, sf_dir):
    return R.score_distribution(view(spark, sf_dir))


def top_suspicious_senders(spark, sf_dir):
    return R.top_suspicious_senders(view(spark, sf_dir))


def tx_search(spark, sf_dir):
    """Write the predictions for searches, once, and search the stored table."""
    path = scratch_dir(spark, "search")
    sinks.write_search_table(labeled(spark, sf_dir), path)
    v = R.search_stored(spark.read.parquet(path), **SEARCH)
    return v.select("tx_hash", "from_address", "to_address", "value_eth", "timestamp", "fraud_flag")


def scores_from_saved_model(spark, sf_dir):
    """Fit the z-score model on the first half of the month, save it, load it
    and score the second half."""
    feats = materialize(features(spark, sf_dir).select(*[q(c) for c in SCORING_INPUT]), "features")
    path = scratch_dir(spark, "model")
    ZScoreModel.fit(feats.filter(q("date") < SECOND_FROM)).save(spark, path)
    new = ZScoreModel.load(spark, path).apply(feats.filter(q("date") >= SECOND_FROM))
    return new.select("hash", round6("anomaly_score").alias("anomaly_score"), "pred_label")


# --- address analytics -------------------------------------------------------------


def address_profile(spark, sf_dir):
    return R.address_profile(tx(spark, sf_dir))


def value_distribution(spark, sf_dir):
    return R.value_distribution(tx(spark, sf_dir))


def value_quantiles(spark, sf_dir):
    return R.value_quantiles(tx(spark, sf_dir))


STANDARDIZED = ["log_value", "daily_avg_interval_from", "daily_avg_interval_to", "value_zscore"]


def standardized_features(spark, sf_dir):
    return R.standardized_features(features(spark, sf_dir), STANDARDIZED)


def prf_metrics(spark, sf_dir):
    """Labels against the rule-based spike flags taken as reference truth."""
    lab = labeled(spark, sf_dir)
    truth = (q("value_spike") == 1) | (q("gasPrice_spike") == 1)
    return R.prf_metrics(lab, truth, q("pred_label") == -1)


def address_risk(spark, sf_dir):
    return R.address_risk(labeled(spark, sf_dir))


def address_risk_bucketed(spark, sf_dir):
    """The same from a table bucketed by sender, without an exchange."""
    rows = labeled(spark, sf_dir).select("hash", "from", "anomaly_score", "pred_label")
    name, path = f"ledgerlens_risk_{uuid.uuid4().hex}", scratch_dir(spark, "bucketed")
    return R.address_risk(sinks.write_bucketed(rows, name, path, buckets=8))


def counterparties_sketch(spark, sf_dir):
    """Distinct counterparties per address in one week: the exact count, and
    whether the estimate merged from daily sketches is within 4 standard errors
    of it."""
    t = tx(spark, sf_dir)
    sketches = materialize(R.counterparty_sketches(t), "sketches")
    estimate = R.merged_counterparties(sketches, *SCAN_DATES)
    week = t.filter(q("date").between(F.lit(SCAN_DATES[0]).cast("date"), F.lit(SCAN_DATES[1]).cast("date")))
    sides = week.select("from", "to").unionByName(week.select(q("to").alias("from"), q("from").alias("to")))
    exact = sides.filter(q("from").isNotNull()).groupBy(q("from").alias("address")).agg(F.countDistinct("to").alias("exact_count"))
    near = F.abs(q("counterparties") - q("exact_count")) <= F.greatest(F.lit(1.0), q("exact_count") * (4 * R.SKETCH_ERROR))
    return exact.join(estimate, "address").select("address", "exact_count", near.alias("estimate_near"))


# --- encoders and models ---------------------------------------------------------


def string_index(spark, sf_dir):
    out = add_indices(tx(spark, sf_dir).select("hash", *ENCODED_COLS))
    return out.select("hash", *[f"{c}_index" for c in ENCODED_COLS])


def onehot_vector(spark, sf_dir):
    """One-hot vectors in sparse form: size and place of the 1."""
    out = add_indices(tx(spark, sf_dir).select("hash", *ENCODED_COLS))
    return out.select("hash", *[x for c in ENCODED_COLS for x in sparse_onehot(c)])


def onehot_dummies(spark, sf_dir):
    """Dummy variables as one sparse vector: size, places and values of what is
    not 0, with a place for NULL in each column."""
    out = add_indices(tx(spark, sf_dir).select("hash", *ENCODED_COLS)).select("hash", *sparse_dummies())
    listed = [F.array_join(F.transform(c, lambda x: x.cast("long").cast("string")), ",").alias(c) for c in ("indices", "values")]
    return out.select("hash", "size", *listed)


def _forest(spark, sf_dir):
    m = materialize(model_input(features(spark, sf_dir)), "model_input")
    feats = [c for c in drop_identifiers(m).columns if c not in ENCODED_COLS]
    model = fit_isolation_forest(m, feats, n_trees=100, max_samples=256, key="hash", seed=42, categories=ENCODED_COLS)
    return score_isolation_forest(m, model, contamination=0.01)


def iforest_scores(spark, sf_dir):
    s = _forest(spark, sf_dir)
    return s.select("hash", round6("anomaly_score").alias("anomaly_score"), "pred_label")


def iforest_top10(spark, sf_dir):
    s = _forest(spark, sf_dir)
    top = R.top_k_suspicious(s, 10, ascending=True)
    return top.select(
        "hash", *_addr(top), round6("log_value").alias("log_value"), "pred_label",
        round6("anomaly_score").alias("anomaly_score"),
    )


def _caller_labels(spark, sf_dir) -> DataFrame:
    """Labels that do not come from the transactions: the event's order, where
    it is not pending, was urgent or not."""
    orders = load_table(spark, sf_dir, "orders").filter(q("o_orderstatus") != "P")
    return orders.select(q("o_orderkey").cast("string").alias("hash"), (q("o_orderpriority") == "1-URGENT").cast("int").alias("label"))


def classifier_scores_q(spark, sf_dir):
    """Random forest trained on the caller's labels of the first half of the
    month, scored on every row."""
    lab = with_labels(labeled(spark, sf_dir), _caller_labels(spark, sf_dir)).withColumn("is_train", time_split(q("datetime"), SECOND_FROM))
    lab = materialize(lab, "labelled")
    model = fit_classifier(lab.filter(q("is_train") & q("label").isNotNull()), FEATURE_COLS, label="label")
    out = classifier_scores(lab, model, FEATURE_COLS)
    return out.select("hash", "is_train", "label", round6("risk_prob").alias("risk_prob"), "risk_pred")


def ranking_metrics(spark, sf_dir):
    """How well the z-score ranks the rows that the caller has labelled."""
    rows = materialize(scored(spark, sf_dir).select("hash", round6("anomaly_score").alias("score")), "scores")
    return R.ranking_metrics(with_labels(rows, _caller_labels(spark, sf_dir)), "score", "label")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "raw_json_roundtrip": raw_json_roundtrip,
    "payload_rejects": payload_rejects,
    "feature_scan_pruned": feature_scan_pruned,
    "dashboard_scan": dashboard_scan,
    "anomalies_only": anomalies_only,
    "clean_names": clean_names,
    "predictions_projection": predictions_projection,
    "tx_flags": tx_flags,
    "function_name_clean": function_name_clean,
    "cast_numeric": cast_numeric,
    "model_input": model_input_q,
    "zscore_scores": zscore_scores,
    "min_score_filter": min_score_filter,
    "kpi_summary": kpi_summary,
    "gas_spike_rows": gas_spike_rows,
    "tx_search": tx_search,
    "spike_flags": spike_flags,
    "temporal_features": temporal_features,
    "log_values": log_values,
    "total_stats_from": _stats("from", None),
    "tx_intervals": tx_intervals,
    "rolling_zscores": rolling_zscores,
    "landing_path": landing_path,
    "total_stats_to": _stats("to", None),
    "daily_stats_from": _stats("from", "date"),
    "daily_stats_to": _stats("to", "date"),
    "weekly_stats_from": _stats("from", "week_start"),
    "weekly_stats_to": _stats("to", "week_start"),
    "daily_avg_interval_from": _avg_interval("from"),
    "daily_avg_interval_to": _avg_interval("to"),
    "feature_stats": feature_stats_q,
    "score_threshold": score_threshold_q,
    "label_summary": label_summary_q,
    "daily_trend": daily_trend,
    "score_distribution": score_distribution,
    "top_suspicious_senders": top_suspicious_senders,
    "daily_tx_stats": daily_tx_stats,
    "daily_tx_stats_wei": daily_tx_stats_wei,
    "address_amounts_wei": address_amounts_wei,
    "rolling_stats": rolling_stats,
    "features_full": features_full,
    "features_incremental": features_incremental,
    "top10_suspicious": top10_suspicious,
    "pred_labels": pred_labels,
    "address_profile": address_profile,
    "value_distribution": value_distribution,
    "standardized_features": standardized_features,
    "prf_metrics": prf_metrics,
    "address_risk": address_risk,
    "string_index": string_index,
    "onehot_vector": onehot_vector,
    "onehot_dummies": onehot_dummies,
    "iforest_scores": iforest_scores,
    "iforest_top10": iforest_top10,
    "classifier_scores": classifier_scores_q,
    "predictions_table": predictions_table,
    "csv_roundtrip": csv_roundtrip,
    "anomalies_csv": anomalies_csv,
    "run_metadata": run_metadata,
    "catalog_table": catalog_table,
    "most_suspicious": most_suspicious,
    "timestamp_parse": timestamp_parse,
    "value_quantiles": value_quantiles,
    "scores_from_saved_model": scores_from_saved_model,
    "address_risk_bucketed": address_risk_bucketed,
    "counterparties_sketch": counterparties_sketch,
    "ranking_metrics": ranking_metrics,
}

"""DuckDB SQL twins of the registered queries (tables pre-registered as
views). Written independently of the Spark code: plain window functions and
GROUP BY + LEFT JOIN, the straightforward relational form of each query.
"""

from __future__ import annotations

from ledgerlens.schema import FEATURE_COLS, THRESHOLD_PERCENTILE


def r6(x: str) -> str:
    """Two-step rounding (9 then 6 decimals), the same convention as the
    Spark side: the first step maps last-bit differences to one double."""
    return f"(round(round(({x}) * 1e9) / 1e9 * 1e6) / 1e6)"


TX = """
src AS (
  SELECT *, json_extract_string(props, '$.k') AS k FROM events
),
tx AS (
  SELECT
    CAST(event_id // 10 AS DOUBLE) AS blockNumber,
    CAST(floor(epoch(ts)) AS DOUBLE) AS timeStamp,
    CAST(event_id AS VARCHAR) AS hash,
    CAST(event_id % 10 AS DOUBLE) AS transactionIndex,
    CAST(user_id AS VARCHAR) AS "from",
    k AS "to",
    value AS value,
    value * (1.0 + CAST(k AS DOUBLE) / 100.0) AS gasPrice,
    CASE WHEN event_type = 'error' THEN 1.0 ELSE 0.0 END AS isError,
    CASE WHEN event_type = 'purchase' THEN props ELSE '' END AS contractAddress,
    event_type AS methodId,
    split_part(event_type || '(' || k || ')', '(', 1) AS functionName,
    CASE WHEN (CASE WHEN event_type = 'purchase' THEN props ELSE '' END) <> '' THEN 1 ELSE 0 END
      AS is_contract_call,
    date_trunc('second', ts) AS datetime,
    CAST(date_trunc('second', ts) AS DATE) AS date,
    date_trunc('week', date_trunc('second', ts)) AS week_start,
    CAST(hour(ts) AS INTEGER) AS hour,
    CASE WHEN hour(ts) >= 0 AND hour(ts) < 6 THEN 'midnight'
         WHEN hour(ts) >= 6 AND hour(ts) < 12 THEN 'morning'
         WHEN hour(ts) >= 12 AND hour(ts) < 18 THEN 'afternoon'
         ELSE 'night' END AS time_slot,
    CAST(floor(epoch(ts)) AS BIGINT) AS ts_sec
  FROM src
)"""


def _agg(side: str, name: str, keys: list[str]) -> str:
    k = ", ".join(keys)
    return f"""
{name}_{side} AS (
  SELECT {k}, count(*) AS {name}_tx_count_{side},
         CAST(sum(CAST(isError AS INTEGER)) AS BIGINT) AS {name}_fail_count_{side}
  FROM tx GROUP BY {k}
)"""


def _rate(name: str, side: str) -> str:
    return (
        f"CAST({name}_fail_count_{side} + 1 AS DOUBLE) / CAST({name}_tx_count_{side} + 1 AS DOUBLE)"
        f" AS {name}_fail_rate_{side}"
    )


FEATURES = (
    TX
    + """,
w1 AS (
  SELECT *,
    ln(1 + value) AS log_value,
    ln(1 + gasPrice) AS log_gasPrice,
    lag(datetime) OVER (PARTITION BY "from" ORDER BY datetime, blockNumber, transactionIndex, hash)
      AS prev_datetime_from,
    lag(datetime) OVER (PARTITION BY "to" ORDER BY datetime, blockNumber, transactionIndex, hash)
      AS prev_datetime_to
  FROM tx
),
w2 AS (
  SELECT *,
    CAST(floor(epoch(datetime)) - floor(epoch(prev_datetime_from)) AS DOUBLE) AS interval_from,
    CAST(floor(epoch(datetime)) - floor(epoch(prev_datetime_to)) AS DOUBLE) AS interval_to,
    avg(log_value) OVER roll AS rolling_value_mean,
    stddev_samp(log_value) OVER roll AS rolling_value_std,
    avg(log_gasPrice) OVER roll AS rolling_gasPrice_mean,
    stddev_samp(log_gasPrice) OVER roll AS rolling_gasPrice_std,
    count(*) OVER roll AS rolling_tx_count
  FROM w1
  WINDOW roll AS (PARTITION BY "from" ORDER BY ts_sec
                  RANGE BETWEEN 604800 PRECEDING AND 1 PRECEDING)
),
w3 AS (
  SELECT *,
    (log_value - rolling_value_mean) / NULLIF(rolling_value_std, 0) AS value_zscore,
    (log_gasPrice - rolling_gasPrice_mean) / NULLIF(rolling_gasPrice_std, 0) AS gasPrice_zscore
  FROM w2
),
w4 AS (
  SELECT *,
    CASE WHEN rolling_tx_count < 10 THEN 0 WHEN rolling_value_std IS NULL THEN 0
         WHEN value_zscore > 3 THEN 1 ELSE 0 END AS value_spike,
    CASE WHEN rolling_tx_count < 10 THEN 0 WHEN rolling_gasPrice_std IS NULL THEN 0
         WHEN gasPrice_zscore > 3 THEN 1 ELSE 0 END AS gasPrice_spike
  FROM w3
),"""
    + ",".join(
        [
            _agg("from", "total", ['"from"']),
            _agg("to", "total", ['"to"']),
            _agg("from", "daily", ['"from"', "date"]),
            _agg("to", "daily", ['"to"', "date"]),
            _agg("from", "weekly", ['"from"', "week_start"]),
            _agg("to", "weekly", ['"to"', "week_start"]),
        ]
    )
    + """,
avgint_from AS (
  SELECT "from", date, avg(interval_from) AS daily_avg_interval_from FROM w4 GROUP BY "from", date
),
avgint_to AS (
  SELECT "to", date, avg(interval_to) AS daily_avg_interval_to FROM w4 GROUP BY "to", date
),
feat AS (
  SELECT w4.*,
    j1.daily_tx_count_from, j1.daily_fail_count_from, """
    + _rate("daily", "from")
    + """,
    j2.daily_tx_count_to, j2.daily_fail_count_to, """
    + _rate("daily", "to")
    + """,
    j3.weekly_tx_count_from, j3.weekly_fail_count_from, """
    + _rate("weekly", "from")
    + """,
    j4.weekly_tx_count_to, j4.weekly_fail_count_to, """
    + _rate("weekly", "to")
    + """,
    j5.total_tx_count_from, j5.total_fail_count_from, """
    + _rate("total", "from")
    + """,
    j6.total_tx_count_to, j6.total_fail_count_to, """
    + _rate("total", "to")
    + """,
    j7.daily_avg_interval_from, j8.daily_avg_interval_to
  FROM w4
  LEFT JOIN daily_from j1 ON w4."from" = j1."from" AND w4.date = j1.date
  LEFT JOIN daily_to j2 ON w4."to" = j2."to" AND w4.date = j2.date
  LEFT JOIN weekly_from j3 ON w4."from" = j3."from" AND w4.week_start = j3.week_start
  LEFT JOIN weekly_to j4 ON w4."to" = j4."to" AND w4.week_start = j4.week_start
  LEFT JOIN total_from j5 ON w4."from" = j5."from"
  LEFT JOIN total_to j6 ON w4."to" = j6."to"
  LEFT JOIN avgint_from j7 ON w4."from" = j7."from" AND w4.date = j7.date
  LEFT JOIN avgint_to j8 ON w4."to" = j8."to" AND w4.date = j8.date
)"""
)


def _stats_cols() -> str:
    parts = []
    for c in FEATURE_COLS:
        parts.append(f"avg(CAST({c} AS DOUBLE)) AS {c}_mean, stddev_samp(CAST({c} AS DOUBLE)) AS {c}_std")
    return ",\n    ".join(parts)


def _z(c: str) -> str:
    return f"((CAST({c} AS DOUBLE) - st.{c}_mean) / st.{c}_std)"


def _term(c: str) -> str:
    return f"(CASE WHEN st.{c}_std IS NULL OR st.{c}_std = 0 THEN 0.0 ELSE {_z(c)} * {_z(c)} END)"


SCORED = (
    FEATURES
    + """,
st AS (
  SELECT
    """
    + _stats_cols()
    + """
  FROM feat
),
scored AS (
  SELECT feat.*,
    CASE WHEN st.log_value_std IS NULL OR st.log_value_std = 0 THEN NULL ELSE """
    + _z("log_value")
    + """ END AS log_value_z,
    CASE WHEN st.total_tx_count_from_std IS NULL OR st.total_tx_count_from_std = 0 THEN NULL ELSE """
    + _z("total_tx_count_from")
    + """ END AS total_tx_count_from_z,
    CASE WHEN st.value_zscore_std IS NULL OR st.value_zscore_std = 0 THEN NULL ELSE """
    + _z("value_zscore")
    + """ END AS value_zscore_z,
    """
    + " + ".join(_term(c) for c in FEATURE_COLS)
    + """ AS anomaly_score
  FROM feat CROSS JOIN st
)"""
)

LABELED = (
    SCORED
    + """,
thr AS (SELECT quantile_cont(anomaly_score, 0.99) AS t FROM scored),
lab AS (
  SELECT scored.*, CASE WHEN anomaly_score >= thr.t THEN -1 ELSE 1 END AS pred_label
  FROM scored CROSS JOIN thr
)"""
)

VIEW = (
    LABELED
    + """,
v AS (
  SELECT hash AS tx_hash, "from" AS from_address, "to" AS to_address,
         value / 1e18 AS value_eth, datetime AS "timestamp", anomaly_score,
         CASE WHEN pred_label = -1 THEN 1 ELSE 0 END AS fraud_flag
  FROM lab
)"""
)


def w(ctes: str, body: str) -> str:
    return "WITH " + ctes.strip() + "\n" + body


MIN_SCORE = "50.0"

_ROUNDED_FEATURES = {
    "log_value", "log_gasPrice", "rolling_value_mean", "rolling_value_std", "rolling_gasPrice_mean",
    "rolling_gasPrice_std", "value_zscore", "gasPrice_zscore", "daily_fail_rate_from",
    "daily_fail_rate_to", "weekly_fail_rate_from", "weekly_fail_rate_to", "total_fail_rate_from",
    "total_fail_rate_to", "daily_avg_interval_from", "daily_avg_interval_to",
}

_FEATURE_TABLE = [
    "blockNumber", "timeStamp", "hash", "transactionIndex", "from", "to", "value", "gasPrice",
    "isError", "contractAddress", "methodId", "functionName", "is_contract_call", "datetime",
    "date", "week_start", "hour", "time_slot", "prev_datetime_from", "interval_from",
    "prev_datetime_to", "interval_to", "log_value", "log_gasPrice", "rolling_value_mean",
    "rolling_value_std", "rolling_gasPrice_mean", "rolling_gasPrice_std", "rolling_tx_count",
    "value_zscore", "gasPrice_zscore", "value_spike", "gasPrice_spike",
    "daily_tx_count_from", "daily_fail_count_from", "daily_fail_rate_from",
    "weekly_tx_count_from", "weekly_fail_count_from", "weekly_fail_rate_from",
    "total_tx_count_from", "total_fail_count_from", "total_fail_rate_from",
    "daily_tx_count_to", "daily_fail_count_to", "daily_fail_rate_to",
    "weekly_tx_count_to", "weekly_fail_count_to", "weekly_fail_rate_to",
    "total_tx_count_to", "total_fail_count_to", "total_fail_rate_to",
    "daily_avg_interval_from", "daily_avg_interval_to",
]


def _feature_select() -> str:
    out = []
    for c in _FEATURE_TABLE:
        if c in ("from", "to"):
            out.append(f'"{c}" AS {c}_address')
        elif c in _ROUNDED_FEATURES:
            out.append(f"{r6(c)} AS {c}")
        else:
            out.append(c)
    return ", ".join(out)


def _stats_sql(side: str, name: str, period: str | None) -> str:
    keys = f'"{side}"' + (f", {period}" if period else "")
    sel = f'"{side}" AS {side}_address' + (f", {period}" if period else "")
    return w(
        TX,
        f"""SELECT {sel}, count(*) AS {name}_tx_count_{side},
       CAST(sum(CAST(isError AS INTEGER)) AS BIGINT) AS {name}_fail_count_{side},
       {r6(f"CAST(sum(CAST(isError AS INTEGER)) + 1 AS DOUBLE) / CAST(count(*) + 1 AS DOUBLE)")}
         AS {name}_fail_rate_{side}
FROM tx GROUP BY {keys}""",
    )


def _avg_interval_sql(side: str) -> str:
    return w(
        FEATURES,
        f"""SELECT "{side}" AS {side}_address, date,
       {r6(f"avg(interval_{side})")} AS daily_avg_interval_{side}
FROM feat GROUP BY "{side}", date""",
    )


STANDARDIZED = ["log_value", "daily_avg_interval_from", "daily_avg_interval_to", "value_zscore"]


def _standardized_sql() -> str:
    stats = ", ".join(
        f"avg(CAST({c} AS DOUBLE)) AS {c}__m, stddev_samp(CAST({c} AS DOUBLE)) AS {c}__s" for c in STANDARDIZED
    )
    cols = ", ".join(
        f"{r6(f'(coalesce(CAST({c} AS DOUBLE), s.{c}__m) - s.{c}__m) / NULLIF(s.{c}__s, 0)')} AS {c}_std"
        for c in STANDARDIZED
    )
    return w(FEATURES + f",\ns AS (SELECT {stats} FROM feat)", f"SELECT hash, {cols} FROM feat CROSS JOIN s")


def _feature_stats_sql() -> str:
    cols = []
    for c in FEATURE_COLS:
        cols.append(f"{r6(f'avg(CAST({c} AS DOUBLE))')} AS {c}_mean")
        cols.append(f"{r6(f'stddev_samp(CAST({c} AS DOUBLE))')} AS {c}_std")
    return w(FEATURES, "SELECT " + ", ".join(cols) + " FROM feat")


def _model_input_sql() -> str:
    cols = ", ".join(f"{r6(f'CAST({c} AS DOUBLE)')} AS {c}" for c in FEATURE_COLS)
    return w(
        FEATURES,
        f'SELECT hash, "from" AS from_address, "to" AS to_address, methodId, functionName, time_slot, {cols} FROM feat',
    )


ORACLE: dict[str, str] = {
    "raw_json_roundtrip": w(
        TX,
        """SELECT hash, "from" AS from_address, "to" AS to_address, value, gasPrice, isError,
       timeStamp, functionName, is_contract_call FROM tx""",
    ),
    "feature_scan_pruned": w(
        FEATURES,
        """SELECT hash, "from" AS from_address, date, daily_tx_count_from, weekly_tx_count_from,
       total_tx_count_from
FROM feat WHERE date BETWEEN DATE '2024-01-08' AND DATE '2024-01-14'""",
    ),
    "dashboard_scan": w(
        VIEW,
        f"""SELECT tx_hash, from_address, to_address, value_eth, "timestamp",
       {r6("anomaly_score")} AS anomaly_score, fraud_flag
FROM v ORDER BY "timestamp", tx_hash""",
    ),
    "anomalies_only": w(
        LABELED,
        f"""SELECT hash, "from" AS from_address, "to" AS to_address,
       {r6("anomaly_score")} AS anomaly_score, pred_label
FROM lab WHERE pred_label = -1""",
    ),
    "clean_names": w(TX, 'SELECT hash, "from" AS col_1, "to" AS col_2, value FROM tx'),
    "predictions_projection": w(
        LABELED,
        f"""SELECT hash AS tx_hash, "from" AS from_address, "to" AS to_address,
       CAST(blockNumber AS BIGINT) AS block_number, date AS tx_date,
       {r6("anomaly_score")} AS anomaly_score, pred_label AS fraud_label
FROM lab""",
    ),
    "tx_flags": w(TX, "SELECT hash, methodId, is_contract_call FROM tx"),
    "function_name_clean": w(TX, "SELECT hash, functionName FROM tx"),
    "cast_numeric": w(
        TX,
        """SELECT hash, blockNumber, timeStamp, transactionIndex, value, gasPrice, isError,
       "from" AS from_address, "to" AS to_address, methodId FROM tx""",
    ),
    "model_input": _model_input_sql(),
    "zscore_scores": w(
        SCORED,
        f"""SELECT hash, {r6("log_value_z")} AS log_value_z,
       {r6("total_tx_count_from_z")} AS total_tx_count_from_z,
       {r6("value_zscore_z")} AS value_zscore_z, {r6("anomaly_score")} AS anomaly_score
FROM scored""",
    ),
    "min_score_filter": w(
        VIEW,
        f"""SELECT tx_hash, from_address, {r6("anomaly_score")} AS anomaly_score, fraud_flag
FROM v WHERE anomaly_score >= {MIN_SCORE}""",
    ),
    "kpi_summary": w(
        VIEW,
        f"""SELECT count(*) AS total_tx,
       count(*) FILTER (WHERE anomaly_score >= {MIN_SCORE}) AS suspicious_tx,
       CAST(coalesce(sum(fraud_flag), 0) AS BIGINT) AS fraud_tx,
       CASE WHEN count(*) > 0 THEN CAST(coalesce(sum(fraud_flag), 0) AS DOUBLE) / count(*) ELSE 0.0 END
         AS fraud_rate,
       {r6("avg(anomaly_score)")} AS avg_score,
       {r6("max(anomaly_score)")} AS max_score,
       count(DISTINCT CASE WHEN fraud_flag = 1 THEN from_address END) AS unique_suspicious_senders
FROM v""",
    ),
    "gas_spike_rows": w(
        FEATURES,
        f"""SELECT hash, "from" AS from_address, gasPrice, {r6("gasPrice_zscore")} AS gasPrice_zscore
FROM feat WHERE gasPrice_spike = 1""",
    ),
    "tx_search": w(
        VIEW,
        """SELECT tx_hash, from_address, to_address, value_eth, "timestamp", fraud_flag
FROM v
WHERE (from_address IN ('7', '42', '99') OR to_address IN ('7', '42', '99'))
  AND "timestamp" >= TIMESTAMP '2024-01-08 00:00:00' AND "timestamp" < TIMESTAMP '2024-01-22 00:00:00'
  AND value_eth >= 0.0 AND value_eth <= 1e-16""",
    ),
    "spike_flags": w(FEATURES, "SELECT hash, rolling_tx_count, value_spike, gasPrice_spike FROM feat"),
    "temporal_features": w(TX, "SELECT hash, datetime, date, week_start, hour, time_slot FROM tx"),
    "log_values": w(
        TX, f"SELECT hash, {r6('ln(1 + value)')} AS log_value, {r6('ln(1 + gasPrice)')} AS log_gasPrice FROM tx"
    ),
    "total_stats_from": _stats_sql("from", "total", None),
    "total_stats_to": _stats_sql("to", "total", None),
    "daily_stats_from": _stats_sql("from", "daily", "date"),
    "daily_stats_to": _stats_sql("to", "daily", "date"),
    "weekly_stats_from": _stats_sql("from", "weekly", "week_start"),
    "weekly_stats_to": _stats_sql("to", "weekly", "week_start"),
    "tx_intervals": w(
        FEATURES, "SELECT hash, prev_datetime_from, interval_from, prev_datetime_to, interval_to FROM feat"
    ),
    "rolling_zscores": w(
        FEATURES,
        f"SELECT hash, {r6('value_zscore')} AS value_zscore, {r6('gasPrice_zscore')} AS gasPrice_zscore FROM feat",
    ),
    "landing_path": w(
        TX,
        """SELECT "from" AS from_address, date, count(*) AS n_tx,
       'raw/ethereum/txlist/' || strftime(max(datetime), '%Y/%m/%d') || '/eth_txlist_' || "from" || '_'
         || strftime(max(datetime), '%Y-%m-%dT%H-%M-%S') || '.json' AS landing_key
FROM tx GROUP BY "from", date""",
    ),
    "daily_avg_interval_from": _avg_interval_sql("from"),
    "daily_avg_interval_to": _avg_interval_sql("to"),
    "feature_stats": _feature_stats_sql(),
    "score_threshold": w(
        SCORED,
        f"""SELECT {r6("quantile_cont(anomaly_score, 0.99)")} AS threshold,
       count(anomaly_score) AS n_scored FROM scored""",
    ),
    "label_summary": w(
        LABELED,
        """SELECT pred_label, count(*) AS count,
       """ + r6("CAST(count(*) AS DOUBLE) * 100.0 / CAST(sum(count(*)) OVER () AS DOUBLE)") + """ AS pct
FROM lab GROUP BY pred_label""",
    ),
    "daily_trend": w(
        VIEW
        + """,
per_day AS (
  SELECT CAST("timestamp" AS DATE) AS date, count(tx_hash) AS total_tx,
         CAST(sum(fraud_flag) AS BIGINT) AS fraud_tx, avg(anomaly_score) AS avg_score
  FROM v GROUP BY 1
),
cal AS (
  SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS date
  FROM (SELECT min(date) AS lo, max(date) AS hi FROM per_day)
)""",
        f"""SELECT cal.date, CAST(coalesce(total_tx, 0) AS BIGINT) AS total_tx,
       CAST(coalesce(fraud_tx, 0) AS BIGINT) AS fraud_tx, {r6("avg_score")} AS avg_score
FROM cal LEFT JOIN per_day USING (date)""",
    ),
    "score_distribution": w(
        VIEW,
        f"""SELECT {r6("anomaly_score")} AS anomaly_score, count(*) AS tx_count
FROM v WHERE anomaly_score IS NOT NULL GROUP BY 1 ORDER BY 1""",
    ),
    "top_suspicious_senders": w(
        VIEW,
        """SELECT from_address, count(*) AS fraud_tx FROM v WHERE fraud_flag = 1
GROUP BY from_address ORDER BY fraud_tx DESC, from_address""",
    ),
    "daily_tx_stats": w(
        TX,
        f"""SELECT date, count(*) AS tx_count, CAST(sum(CAST(isError AS INTEGER)) AS BIGINT) AS failed_tx,
       {r6("sum(value)")} AS total_value
FROM tx GROUP BY date""",
    ),
    "rolling_stats": w(
        FEATURES,
        f"""SELECT hash, {r6("rolling_value_mean")} AS rolling_value_mean,
       {r6("rolling_value_std")} AS rolling_value_std,
       {r6("rolling_gasPrice_mean")} AS rolling_gasPrice_mean,
       {r6("rolling_gasPrice_std")} AS rolling_gasPrice_std, rolling_tx_count
FROM feat""",
    ),
    "features_full": w(FEATURES, "SELECT " + _feature_select() + " FROM feat"),
    "top10_suspicious": w(
        LABELED,
        f"""SELECT hash, "from" AS from_address, "to" AS to_address,
       {r6("anomaly_score")} AS anomaly_score, pred_label
FROM lab ORDER BY anomaly_score DESC NULLS LAST, hash LIMIT 10""",
    ),
    "pred_labels": w(LABELED, f"SELECT hash, {r6('anomaly_score')} AS anomaly_score, pred_label FROM lab"),
    "address_profile": w(
        TX
        + """,
sent AS (
  SELECT "from" AS address, count(*) AS sent_count, sum(value) AS sent_value,
         avg(value) AS avg_sent_value, count(DISTINCT "to") AS unique_receivers,
         avg(gap) AS avg_send_interval
  FROM (SELECT *, CAST(epoch(datetime) - epoch(lag(datetime) OVER (PARTITION BY "from" ORDER BY datetime)) AS DOUBLE) AS gap
        FROM tx) WHERE "from" IS NOT NULL GROUP BY 1
),
recv AS (
  SELECT "to" AS address, count(*) AS received_count, sum(value) AS received_value,
         count(DISTINCT "from") AS unique_senders
  FROM tx WHERE "to" IS NOT NULL GROUP BY 1
),
sides AS (
  SELECT "from" AS address, "to" AS other, date FROM tx
  UNION ALL
  SELECT "to" AS address, "from" AS other, date FROM tx
),
act AS (
  SELECT address, count(DISTINCT other) AS unique_counterparties, count(DISTINCT date) AS active_days
  FROM sides WHERE address IS NOT NULL GROUP BY 1
),
prof AS (
  SELECT coalesce(s.address, r.address) AS address, s.sent_count, s.sent_value, s.avg_sent_value,
         s.unique_receivers, r.received_count, r.received_value, r.unique_senders, s.avg_send_interval
  FROM sent s FULL OUTER JOIN recv r ON s.address = r.address
)""",
        f"""SELECT p.address,
       CAST(coalesce(sent_count, 0) AS BIGINT) AS sent_count,
       CAST(coalesce(received_count, 0) AS BIGINT) AS received_count,
       {r6("coalesce(sent_value, 0.0)")} AS sent_value,
       {r6("coalesce(received_value, 0.0)")} AS received_value,
       {r6("avg_sent_value")} AS avg_sent_value,
       CAST(coalesce(unique_receivers, 0) AS BIGINT) AS unique_receivers,
       CAST(coalesce(unique_senders, 0) AS BIGINT) AS unique_senders,
       CAST(a.unique_counterparties AS BIGINT) AS unique_counterparties,
       CAST(a.active_days AS BIGINT) AS active_days,
       {r6("CAST(coalesce(sent_count, 0) + coalesce(received_count, 0) AS DOUBLE) / NULLIF(CAST(a.active_days AS DOUBLE), 0)")}
         AS tx_per_active_day,
       {r6("CAST(sent_count AS DOUBLE) / NULLIF(CAST(received_count AS DOUBLE), 0)")} AS sender_receiver_ratio,
       {r6("avg_send_interval")} AS avg_send_interval
FROM prof p LEFT JOIN act a ON p.address = a.address""",
    ),
    "value_distribution": w(
        TX,
        f"""SELECT "from" AS from_address, count(value) AS n_values, min(value) AS min_value,
       max(value) AS max_value, {r6("avg(value)")} AS mean_value,
       {r6("stddev_samp(value)")} AS std_value
FROM tx WHERE "from" IS NOT NULL GROUP BY 1""",
    ),
    "standardized_features": _standardized_sql(),
    "prf_metrics": w(
        LABELED
        + """,
cm AS (
  SELECT
    count(*) FILTER (WHERE (value_spike = 1 OR gasPrice_spike = 1) AND pred_label = -1) AS tp,
    count(*) FILTER (WHERE NOT (value_spike = 1 OR gasPrice_spike = 1) AND pred_label = -1) AS fp,
    count(*) FILTER (WHERE (value_spike = 1 OR gasPrice_spike = 1) AND pred_label <> -1) AS fn,
    count(*) FILTER (WHERE NOT (value_spike = 1 OR gasPrice_spike = 1) AND pred_label <> -1) AS tn
  FROM lab
),
pr AS (
  SELECT *, CAST(tp AS DOUBLE) / NULLIF(CAST(tp + fp AS DOUBLE), 0) AS precision,
         CAST(tp AS DOUBLE) / NULLIF(CAST(tp + fn AS DOUBLE), 0) AS recall
  FROM cm
)""",
        f"""SELECT tp, fp, fn, tn, {r6("precision")} AS precision, {r6("recall")} AS recall,
       {r6("2 * precision * recall / NULLIF(precision + recall, 0)")} AS f1
FROM pr""",
    ),
    "address_risk": w(
        LABELED,
        f"""SELECT "from" AS from_address, count(*) AS tx_count,
       count(*) FILTER (WHERE pred_label = -1) AS flagged_tx,
       {r6("max(anomaly_score)")} AS max_score, {r6("avg(anomaly_score)")} AS avg_score
FROM lab WHERE "from" IS NOT NULL GROUP BY 1""",
    ),
}


_ENC_COLS = ["methodId", "functionName", "time_slot"]


def _index_ctes() -> str:
    parts = []
    for c in _ENC_COLS:
        parts.append(
            f"""cnt_{c} AS (SELECT {c} AS val, count(*) AS c FROM tx WHERE {c} IS NOT NULL GROUP BY 1),
idx_{c} AS (SELECT val, CAST(row_number() OVER (ORDER BY c DESC, val) - 1 AS DOUBLE) AS idx FROM cnt_{c}),
n_{c} AS (SELECT CAST(count(*) AS DOUBLE) AS n FROM cnt_{c})"""
        )
    return TX + ",\n" + ",\n".join(parts) + """,
enc AS (
  SELECT tx.hash, """ + ", ".join(
        f"coalesce(idx_{c}.idx, (SELECT n FROM n_{c})) AS {c}_index" for c in _ENC_COLS
    ) + """
  FROM tx """ + " ".join(f"LEFT JOIN idx_{c} ON tx.{c} = idx_{c}.val" for c in _ENC_COLS) + """
)"""


def _onehot_sql() -> str:
    cols = []
    for c in _ENC_COLS:
        size = f"(SELECT CAST(n AS BIGINT) FROM n_{c})"
        cols.append(f"CASE WHEN {c}_index < {size} THEN CAST({c}_index AS BIGINT) END AS {c}_onehot_at")
        cols.append(f"{size} AS {c}_onehot_size")
    return w(_index_ctes(), "SELECT hash, " + ", ".join(cols) + " FROM enc")


ORACLE["string_index"] = w(_index_ctes(), "SELECT hash, methodId_index, functionName_index, time_slot_index FROM enc")
ORACLE["onehot_vector"] = _onehot_sql()
# Written and read back.
ORACLE["predictions_table"] = w(
    LABELED,
    f"""SELECT hash, "from" AS from_address, "to" AS to_address, date,
       {r6("anomaly_score")} AS anomaly_score, pred_label FROM lab""",
)
ORACLE["csv_roundtrip"] = w(TX, 'SELECT hash, "from" AS from_address, value, gasPrice, functionName, date FROM tx')
ORACLE["anomalies_csv"] = w(LABELED, 'SELECT hash, "from" AS from_address, pred_label FROM lab WHERE pred_label = -1')
ORACLE["catalog_table"] = w(TX, "SELECT date, count(*) AS n_tx, max(value) AS max_value FROM tx GROUP BY 1")
ORACLE["run_metadata"] = " UNION ALL ".join(
    f"SELECT {i} AS position, '{c}' AS feature, CAST({len(FEATURE_COLS)} AS BIGINT) AS num_features, "
    f"CAST({THRESHOLD_PERCENTILE} AS DOUBLE) AS threshold_percentile"
    for i, c in enumerate(FEATURE_COLS)
)
ORACLE["most_suspicious"] = w(LABELED, "SELECT hash FROM lab ORDER BY anomaly_score DESC NULLS LAST, hash DESC LIMIT 1")
ORACLE["timestamp_parse"] = w(
    TX,
    """SELECT hash, CASE CAST(blockNumber AS BIGINT) % 4 WHEN 0 THEN datetime WHEN 1 THEN datetime
       WHEN 2 THEN CAST(CAST(datetime AS DATE) AS TIMESTAMP) END AS parsed FROM tx""",
)
ORACLE["value_quantiles"] = w(
    TX + """,
v AS (SELECT "from", list_sort(list(value)) AS l, count(value) AS n FROM tx WHERE "from" IS NOT NULL GROUP BY 1)""",
    """SELECT "from" AS from_address, l[CAST(ceil(0.25 * n) AS INT)] AS q25_value, l[CAST(ceil(0.5 * n) AS INT)] AS median_value,
       l[CAST(ceil(0.75 * n) AS INT)] AS q75_value FROM v""",
)

# Landed, ingested and refreshed in two parts: the same table.
ORACLE["features_incremental"] = ORACLE["features_full"]

# Exact amounts: 128-bit integers, shown as digits.
_WEI = TX + """,
wei AS (
  SELECT "from", "to", date, isError,
         CAST(round(value * 100) AS HUGEINT) * 10000000000000000::HUGEINT + CAST(hash AS HUGEINT) AS wei
  FROM tx
)"""
ORACLE["daily_tx_stats_wei"] = w(
    _WEI,
    """SELECT date, count(*) AS tx_count, CAST(sum(CAST(isError AS INTEGER)) AS BIGINT) AS failed_tx,
       CAST(sum(wei) AS VARCHAR) AS total_wei FROM wei GROUP BY 1""",
)
ORACLE["address_amounts_wei"] = w(
    _WEI + """,
moved AS (
  SELECT "from" AS address, 1 AS sent, wei, 0::HUGEINT AS back FROM wei WHERE "from" IS NOT NULL
  UNION ALL SELECT "to", 0, 0::HUGEINT, wei FROM wei WHERE "to" IS NOT NULL
)""",
    """SELECT address, CAST(sum(sent) AS BIGINT) AS sent_count, CAST(sum(wei) AS VARCHAR) AS sent_wei,
       CAST(sum(back) AS VARCHAR) AS received_wei, CAST(sum(back) - sum(wei) AS VARCHAR) AS net_wei
FROM moved GROUP BY 1""",
)
# A model of the first half of the month, applied to the second.
ORACLE["scores_from_saved_model"] = w(
    SCORED.replace("  FROM feat\n),\nscored AS", "  FROM feat WHERE date < DATE '2024-01-16'\n),\nscored AS")
    + """,
thr AS (SELECT quantile_cont(anomaly_score, 0.99) AS t FROM scored WHERE date < DATE '2024-01-16')""",
    f"""SELECT hash, {r6("anomaly_score")} AS anomaly_score, CASE WHEN anomaly_score >= thr.t THEN -1 ELSE 1 END AS pred_label
FROM scored CROSS JOIN thr WHERE date >= DATE '2024-01-16'""",
)
ORACLE["address_risk_bucketed"] = ORACLE["address_risk"]
ORACLE["counterparties_sketch"] = w(
    TX + """,
sides AS (
  SELECT "from" AS address, "to" AS other, date FROM tx UNION ALL SELECT "to", "from", date FROM tx
)""",
    """SELECT address, count(DISTINCT other) AS exact_count, TRUE AS estimate_near FROM sides
WHERE address IS NOT NULL AND date BETWEEN DATE '2024-01-08' AND DATE '2024-01-14' GROUP BY 1""",
)
ORACLE["ranking_metrics"] = w(
    SCORED + f""",
ranked AS (
  SELECT {r6("anomaly_score")} AS s, CAST(o_orderpriority = '1-URGENT' AS INTEGER) AS y
  FROM scored JOIN orders ON CAST(o_orderkey AS VARCHAR) = hash WHERE o_orderstatus <> 'P' AND anomaly_score IS NOT NULL
),
steps AS (SELECT s, CAST(sum(y) AS DOUBLE) AS p, CAST(count(*) AS DOUBLE) AS c FROM ranked GROUP BY 1),
curve AS (SELECT *, sum(p) OVER o AS p_upto, sum(c) OVER o AS c_upto, sum(p) OVER () AS all_p, sum(c) OVER () AS all_c
          FROM steps WINDOW o AS (ORDER BY s DESC))""",
    f"""SELECT CAST(max(all_c) AS BIGINT) AS n_rows, CAST(max(all_p) AS BIGINT) AS n_positive,
       {r6("sum((c - p) * (p_upto - p / 2)) / NULLIF(max(all_p) * (max(all_c) - max(all_p)), 0)")} AS roc_auc,
       {r6("sum(p * p_upto / c_upto) / NULLIF(max(all_p), 0)")} AS average_precision
FROM curve""",
)


# Dummies: places of the columns one behind the other, the last of each for NULL.
def _dummies_sql() -> str:
    places, first = [], "0"
    for c in _ENC_COLS:
        places.append(f"CAST({first} + {c}_index AS BIGINT)")  # NULL has the number of values as its index
        first += f" + (SELECT n FROM n_{c}) + 1"
    return w(
        _index_ctes(),
        f"""SELECT hash, CAST({first} AS BIGINT) AS size, concat_ws(',', {", ".join(places)}) AS indices,
       '{",".join("1" for _ in _ENC_COLS)}' AS "values" FROM enc""",
    )


ORACLE["onehot_dummies"] = _dummies_sql()


# The isolation forest: samples, splits and walks from md5 hashes.
_TREES, _PSI, _DEPTH, _SEED, _RANGE = 100, 256, 8, 42, 16**12


def _md5_number(*parts: str) -> str:
    return f"CAST('0x' || substr(md5('{_SEED}:' || {" || ':' || ".join(parts)}), 1, 12) AS BIGINT)"


def _md5_uniform(what: str) -> str:
    return f"((CAST({_md5_number(f"'{what}'", "t", "node")} AS DOUBLE) + 0.5e0) / {_RANGE}e0)"


def _path_length(n: str) -> str:
    return (
        f"(CASE WHEN {n} <= 1 THEN 0e0 WHEN {n} = 2 THEN 1e0 ELSE 2e0 * (ln(CAST({n} AS DOUBLE) - 1e0) + 0.5772156649015329e0)"
        f" - 2e0 * (CAST({n} AS DOUBLE) - 1e0) / CAST({n} AS DOUBLE) END)"
    )


def _forest_ctes() -> str:
    numeric = [f"coalesce({r6(f'CAST(feat.{c} AS DOUBLE)')}, fill.{c}) AS {c}" for c in FEATURE_COLS]
    fill = [f"{r6('avg(' + r6(f'CAST({c} AS DOUBLE)') + ')')} AS {c}" for c in FEATURE_COLS]
    values = [f"SELECT hash, 'n:{c}' AS f, {c} AS v FROM filled" for c in FEATURE_COLS]
    values += [f"SELECT hash, 'c:{c}' || coalesce('=' || {c}, ''), 1e0 FROM filled" for c in _ENC_COLS]
    out = f"""{FEATURES},
fill AS (SELECT {", ".join(fill)} FROM feat),
filled AS MATERIALIZED (SELECT hash, {", ".join(_ENC_COLS)}, {", ".join(numeric)} FROM feat CROSS JOIN fill),
vals AS MATERIALIZED ({" UNION ALL ".join(values)}),
par AS (
  SELECT psi, CAST(floor(p_any * {_RANGE}e0) AS BIGINT) AS any_limit, CAST(floor(least(1e0, p_row / p_any) * {_RANGE}e0) AS BIGINT) AS tree_limit
  FROM (SELECT psi, p_row, least(1e0, {_TREES} * p_row) AS p_any
        FROM (SELECT least({_PSI}, n) AS psi, least(1e0, 1.5e0 * least({_PSI}, n) / n) AS p_row FROM (SELECT CAST(count(*) AS DOUBLE) AS n FROM feat)))
),
drawn AS (
  SELECT hash, t, psi FROM (SELECT hash, psi, tree_limit FROM feat CROSS JOIN par WHERE {_md5_number("'any'", "hash")} < any_limit)
  CROSS JOIN range({_TREES}) AS r(t) WHERE {_md5_number("'tree'", "hash", "t")} < tree_limit
),
a0 AS MATERIALIZED (
  SELECT t, hash, 0 AS node FROM drawn
  QUALIFY row_number() OVER (PARTITION BY t ORDER BY {_md5_number("'rank'", "hash", "t")}, hash) <= psi
)"""
    for i in range(_DEPTH):
        out += f""",
z{i} AS (SELECT t, node, count(*) AS size FROM a{i} GROUP BY 1, 2),
b{i} AS (
  SELECT t, node, f, CASE WHEN c < size THEN least(low, 0e0) ELSE low END AS low, CASE WHEN c < size THEN greatest(high, 0e0) ELSE high END AS high
  FROM (SELECT a.t, a.node, v.f, count(*) AS c, min(v.v) AS low, max(v.v) AS high FROM a{i} a JOIN vals v ON v.hash = a.hash GROUP BY 1, 2, 3)
  JOIN z{i} USING (t, node)
),
c{i} AS (
  SELECT t, node, f, low, high, row_number() OVER (PARTITION BY t, node ORDER BY f) - 1 AS i, count(*) OVER (PARTITION BY t, node) AS m
  FROM b{i} WHERE high > low
),
s{i} AS MATERIALIZED (
  SELECT t, node, f, low + {_md5_uniform("threshold")} * (high - low) AS cut
  FROM c{i} WHERE i = CAST(floor({_md5_uniform("feature")} * m) AS BIGINT)
),
a{i + 1} AS MATERIALIZED (
  SELECT a.t, a.hash, CASE WHEN coalesce(v.v, 0e0) < s.cut THEN 2 * a.node + 1 ELSE 2 * a.node + 2 END AS node
  FROM a{i} a JOIN s{i} s ON s.t = a.t AND s.node = a.node LEFT JOIN vals v ON v.hash = a.hash AND v.f = s.f
)"""
    out += f""",
z{_DEPTH} AS (SELECT t, node, count(*) AS size FROM a{_DEPTH} GROUP BY 1, 2),
sizes AS MATERIALIZED ({" UNION ALL ".join(f"SELECT t, node, size FROM z{i}" for i in range(_DEPTH + 1))}),
walk0 AS (SELECT hash, t, 0 AS node FROM feat CROSS JOIN range({_TREES}) AS r(t))"""
    for i in range(_DEPTH):
        out += f""",
walk{i + 1} AS MATERIALIZED (
  SELECT w.hash, w.t, CASE WHEN coalesce(v.v, 0e0) < s.cut THEN 2 * w.node + 1 ELSE 2 * w.node + 2 END AS node
  FROM walk{i} w JOIN s{i} s ON s.t = w.t AND s.node = w.node LEFT JOIN vals v ON v.hash = w.hash AND v.f = s.f
)"""
    # a row's last node in a tree is the largest; its depth follows from it
    ends = " UNION ALL ".join(f"SELECT hash, t, node, {i} AS depth FROM walk{i}" for i in range(_DEPTH + 1))
    out += f""",
ends AS (SELECT hash, t, max(depth) AS depth, max(node) AS node FROM ({ends}) GROUP BY 1, 2),
raw AS (
  SELECT e.hash, round(-pow(2e0, -avg(e.depth + {_path_length("z.size")}) / {_path_length("max(par.psi)")}), 9) AS raw
  FROM ends e JOIN sizes z ON z.t = e.t AND z.node = e.node CROSS JOIN par GROUP BY 1
),
decided AS (
  SELECT feat.hash, feat."from", feat."to", feat.log_value, raw - o AS anomaly_score, CASE WHEN raw - o < 0 THEN -1 ELSE 1 END AS pred_label
  FROM raw JOIN feat ON feat.hash = raw.hash CROSS JOIN (SELECT quantile_cont(raw, 0.01) AS o FROM raw)
)"""
    return out


ORACLE["iforest_scores"] = w(_forest_ctes(), f"SELECT hash, {r6('anomaly_score')} AS anomaly_score, pred_label FROM decided")
ORACLE["iforest_top10"] = w(
    _forest_ctes(),
    f"""SELECT hash, "from" AS from_address, "to" AS to_address, {r6("log_value")} AS log_value, pred_label, {r6("anomaly_score")} AS anomaly_score
FROM (SELECT * FROM decided ORDER BY anomaly_score, hash LIMIT 10)""",
)

# One payload per address and day; refused and cut-off ones are rejects.
ORACLE["payload_rejects"] = w(
    TX,
    """SELECT strftime(date, '%Y/%m/%d') AS landing_day, count(*) AS rejected
FROM (SELECT DISTINCT "from", date FROM tx WHERE CAST("from" AS BIGINT) % 7 IN (0, 1)) GROUP BY 1""",
)

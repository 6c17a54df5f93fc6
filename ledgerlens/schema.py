"""Schemas, column lists and constants shared across the library.

Everything under the "fixed values" comments must equal the behaviour the
library reproduces (raw payload layout, feature names, thresholds).
"""

from __future__ import annotations

from pyspark.sql import types as T

# --- fixed values: raw transaction fields delivered by the block-explorer API,
# in API order. Every field arrives as a string.
RAW_TX_FIELDS = [
    "blockNumber",
    "timeStamp",
    "hash",
    "nonce",
    "blockHash",
    "transactionIndex",
    "from",
    "to",
    "value",
    "gas",
    "gasPrice",
    "isError",
    "txreceipt_status",
    "input",
    "contractAddress",
    "cumulativeGasUsed",
    "gasUsed",
    "confirmations",
    "methodId",
    "functionName",
]

# --- fixed values: numeric raw fields cast to double during preparation.
NUMERIC_COLS = [
    "blockNumber",
    "timeStamp",
    "nonce",
    "transactionIndex",
    "value",
    "gas",
    "gasPrice",
    "cumulativeGasUsed",
    "gasUsed",
    "confirmations",
    "isError",
    "txreceipt_status",
]

# --- fixed values: categorical raw fields kept as strings.
CATEGORICAL_COLS = ["from", "to", "methodId", "functionName"]

# --- fixed values: the 22 engineered features used by the anomaly score.
FEATURE_COLS = [
    "log_value",
    "log_gasPrice",
    "total_tx_count_from",
    "total_fail_rate_from",
    "daily_tx_count_from",
    "daily_fail_rate_from",
    "weekly_tx_count_from",
    "weekly_fail_rate_from",
    "daily_avg_interval_from",
    "total_tx_count_to",
    "total_fail_rate_to",
    "daily_tx_count_to",
    "daily_fail_rate_to",
    "weekly_tx_count_to",
    "weekly_fail_rate_to",
    "daily_avg_interval_to",
    "rolling_tx_count",
    "value_zscore",
    "gasPrice_zscore",
    "value_spike",
    "gasPrice_spike",
    "is_contract_call",
]

# --- fixed values: categorical columns fed to the encoders.
ENCODED_COLS = ["methodId", "functionName", "time_slot"]

# --- fixed values: identifier columns never used as model inputs.
ID_COLS = ["hash", "from", "to"]

# --- fixed values: time-of-day buckets as [start_hour, end_hour) -> label;
# any other hour (including NULL) is "night".
TIME_SLOTS = [(0, 6, "midnight"), (6, 12, "morning"), (12, 18, "afternoon")]
DEFAULT_TIME_SLOT = "night"

# --- fixed values: rolling window and spike rule.
ROLLING_WINDOW_SECONDS = 7 * 86400  # preceding 7 days, current second excluded
SPIKE_MIN_COUNT = 10  # fewer rows in the frame -> never a spike
SPIKE_Z = 3.0  # strictly above -> spike

# --- fixed values: scoring.
THRESHOLD_PERCENTILE = 0.99
APPROX_RELATIVE_ERROR = 0.01
ANOMALY_LABEL = -1
NORMAL_LABEL = 1
MODEL_TYPE = "zscore_anomaly_scoring"
WEI_PER_ETHER = 1e18

# --- fixed values: landing-zone layout of raw payloads.
LANDING_PREFIX = "raw/ethereum/txlist"
LANDING_TIME_FORMAT = "yyyy-MM-dd'T'HH-mm-ss"

RAW_TX_STRUCT = T.StructType([T.StructField(c, T.StringType(), True) for c in RAW_TX_FIELDS])

# One raw payload per file: {"status", "message", "result": [tx, ...]}.
# Declared explicitly so a rate-limit payload ("result": "<text>") yields a
# NULL result instead of turning the whole column into a string.
RAW_PAYLOAD_SCHEMA = T.StructType(
    [
        T.StructField("status", T.StringType(), True),
        T.StructField("message", T.StringType(), True),
        T.StructField("result", T.ArrayType(RAW_TX_STRUCT), True),
    ]
)

# Serving tables.
PREDICTIONS_COLUMNS = [
    "tx_hash",
    "from_address",
    "to_address",
    "block_number",
    "tx_date",
    "anomaly_score",
    "fraud_label",
]
DASHBOARD_COLUMNS = [
    "tx_hash",
    "from_address",
    "to_address",
    "value_eth",
    "timestamp",
    "anomaly_score",
    "fraud_flag",
]

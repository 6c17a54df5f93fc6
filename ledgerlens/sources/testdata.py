"""Readers for the parity tables and their mapping to the raw transaction
layout.

The ``events`` table plays the role of the transaction log: one event is one
transfer from ``user_id`` to the receiver ``props.k``. The mapping yields the
same all-string layout the block-explorer API delivers, so the rest of the
library runs unchanged on it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def load_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def raw_tx_from_events(events: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """events -> raw transaction rows (all strings, API field names), with the
    columns ``keep`` as they are."""
    k = F.get_json_object(F.col("props"), "$.k")
    et = F.col("event_type")
    gas_price = F.col("value") * (F.lit(1.0) + k.cast("double") / F.lit(100.0))
    return events.select(
        F.expr("event_id div 10").cast("string").alias("blockNumber"),
        F.unix_timestamp(F.col("ts")).cast("string").alias("timeStamp"),
        F.col("event_id").cast("string").alias("hash"),
        (F.col("event_id") % 10).cast("string").alias("transactionIndex"),
        F.col("user_id").cast("string").alias("from"),
        k.alias("to"),
        F.col("value").cast("string").alias("value"),
        gas_price.cast("string").alias("gasPrice"),
        F.when(et == "error", F.lit("1")).otherwise(F.lit("0")).alias("isError"),
        F.when(et == "purchase", F.col("props")).otherwise(F.lit("")).alias("contractAddress"),
        et.alias("methodId"),
        F.concat(et, F.lit("("), k, F.lit(")")).alias("functionName"),
        *(keep or []),
    )


def load_raw_tx(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw_tx_from_events(load_table(spark, sf_dir, "events"))

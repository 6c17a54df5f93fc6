"""Refresh of the feature table after new transactions.

Three tables: the transactions (by batch and date, see ``incremental``), the
activity per (side, address, day), by date, and the features, by date. A
refresh takes the batches that it has not seen and

1. counts the activity of the dates they have rows on again, from the
   transactions of these dates, and overwrites these date folders;
2. finds the dates on which features change: of each new row the rest of its
   week and the 7 days behind it, and the next day on which the sender or the
   receiver is active, whose first interval changes;
3. builds the features of these dates from their rows and those of the 7 days
   before them, with the activity of all days for what lies further back, and
   overwrites these date folders.

Each step overwrites, and the batches are noted last, so a refresh that breaks
off is simply run again. Features that change with every transaction of an
address at any time, the totals, are not stored: ``read_features`` joins them
from the activity table, so no other date needs to be touched.
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerlens.functions.scalar import smoothed_rate
from ledgerlens.operators.features import DERIVED_COLS, NULL_KEY, SIDES, W, activity_days, build_features
from ledgerlens.operators.prepare import q
from ledgerlens.operators.temporal import add_temporal_features
from ledgerlens.session import ensure_session, path_exists
from ledgerlens.streaming.incremental import BATCH

LOOK_BACK = W // 86400
TOTALS = [f"total_{c}_{s}" for s in SIDES for c in ("tx_count", "fail_count", "fail_rate")]


@dataclass(frozen=True)
class FeatureTables:
    """Where the transactions lie, and the tables a refresh keeps."""

    transactions: str
    root: str

    @property
    def activity(self) -> str:
        return f"{self.root}/activity"

    @property
    def features(self) -> str:
        return f"{self.root}/features"

    @property
    def seen(self) -> str:
        return f"{self.root}/batches"


def on_dates(dates: set[_dt.date | None]) -> Column:
    """A filter by dates that prunes date folders; None is the NULL date."""
    some = sorted(d for d in dates if d is not None)
    out = q("date").isin(some) if some else F.lit(False)
    return out | q("date").isNull() if None in dates else out


def _dates(df: DataFrame) -> set[_dt.date | None]:
    return {r[0] for r in df.select("date").distinct().collect()}  # at most one row a day


def touched_dates(new_keys: DataFrame, activity: DataFrame) -> set[_dt.date | None]:
    """Dates whose features change: ``new_keys`` are the (side, k, date) of new
    rows, ``activity`` is the refreshed table of all days."""
    week = F.date_trunc("week", q("date")).cast("date")
    last = F.greatest(F.date_add(week, 6), F.date_add(q("date"), LOOK_BACK))
    dates = new_keys.filter(q("date").isNotNull()).select("date").distinct()
    around = dates.select(F.explode(F.sequence(week, last)).alias("date"))
    named = new_keys.select("side", "k").distinct()
    days = activity.filter(q("date").isNotNull()).select("side", "k", "date").join(named, ["side", "k"], "left_semi")
    coming = days.withColumn("next", F.lead("date").over(Window.partitionBy("side", "k").orderBy("date")))
    coming = coming.join(new_keys, ["side", "k", "date"], "left_semi").filter(q("next").isNotNull()).select(q("next").alias("date"))
    untimed = new_keys.filter(q("date").isNull()).select("date")
    return _dates(around.unionByName(coming).unionByName(untimed))


def features_input(transactions: DataFrame, touched: set[_dt.date | None]) -> DataFrame:
    """The rows of the touched dates and of the 7 days before each."""
    back = {d - _dt.timedelta(days=k) for d in touched if d is not None for k in range(1, LOOK_BACK + 1)}
    return transactions.filter(on_dates(touched | back))


def _overwrite_dates(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("date").parquet(path)


def refresh_features(spark: SparkSession, tables: FeatureTables) -> set[_dt.date | None]:
    """Bring the tables up to date with the batches not yet seen; returns the
    dates whose features were written."""
    ensure_session(spark)
    transactions = spark.read.parquet(tables.transactions)
    batches = {r[0] for r in transactions.select(BATCH).distinct().collect()}  # one row a batch
    if path_exists(spark, tables.seen):
        batches -= {r[0] for r in spark.read.schema(f"{BATCH} string").parquet(tables.seen).collect()}
    if not batches:
        return set()
    fresh = transactions.filter(q(BATCH).isin(sorted(batches)))
    new_dates = _dates(fresh)
    transactions = transactions.drop(BATCH)

    def timed(rows: DataFrame) -> DataFrame:
        return add_temporal_features(rows)

    counted = activity_days(timed(transactions.filter(on_dates(new_dates))))
    _overwrite_dates(counted, tables.activity)
    activity = spark.read.schema(counted.schema).parquet(tables.activity)
    new_keys = activity_days(timed(fresh.drop(BATCH))).select("side", "k", "date")
    touched = touched_dates(new_keys, activity)
    features = build_features(timed(features_input(transactions, touched)), days=activity)
    _overwrite_dates(features.filter(on_dates(touched)).drop(*TOTALS), tables.features)
    spark.createDataFrame([(b,) for b in sorted(batches)], f"{BATCH} string").write.mode("append").parquet(tables.seen)
    return touched


def read_features(spark: SparkSession, tables: FeatureTables, dates: set[_dt.date | None] | None = None) -> DataFrame:
    """The feature table (of some dates), with the totals as of now."""
    out = spark.read.parquet(tables.features)
    if dates is not None:
        out = out.filter(on_dates(dates))
    names = [c for c in out.columns if c not in DERIVED_COLS]
    activity = spark.read.parquet(tables.activity)
    totals = activity.groupBy("side", "k").agg(F.sum("day_rows").alias("rows"), F.sum("day_fails").alias("fails"))
    for side in SIDES:
        own = totals.filter(q("side") == side).filter(q("k") != NULL_KEY)
        own = own.select(q("k").alias("_k"), q("rows").alias(f"total_tx_count_{side}"), q("fails").alias(f"total_fail_count_{side}"))
        out = out.join(own, out[f"`{side}`"] == own["_k"], "left").drop("_k")
        rate = smoothed_rate(q(f"total_fail_count_{side}"), q(f"total_tx_count_{side}"))
        out = out.withColumn(f"total_fail_rate_{side}", rate)
    return out.select(*[q(c) for c in names + DERIVED_COLS])

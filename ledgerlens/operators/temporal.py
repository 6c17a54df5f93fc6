"""Temporal columns derived from the epoch-seconds ``timeStamp`` (UTC)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.functions.scalar import epoch_to_timestamp, time_slot


def add_temporal_features(df: DataFrame) -> DataFrame:
    """datetime, date, week_start (Monday 00:00), hour, time_slot.

    A frame without ``timeStamp`` gets a NULL datetime (and so NULL date,
    week and hour, and the "night" slot).
    """
    if "timeStamp" in df.columns:
        dt = epoch_to_timestamp(F.col("timeStamp"))
    else:
        dt = F.lit(None).cast("timestamp")
    df = df.withColumn("datetime", dt)
    return df.withColumns(
        {
            "date": F.to_date(F.col("datetime")),
            "week_start": F.date_trunc("week", F.col("datetime")),
            "hour": F.hour(F.col("datetime")),
            "time_slot": time_slot(F.hour(F.col("datetime"))),
        }
    )

"""Address-level aggregate tables (one row per address and period).

``groupBy`` plans as partial + final hash aggregation, so a hot address is
pre-aggregated on the map side before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.functions.scalar import smoothed_rate
from ledgerlens.operators.prepare import q

PERIOD_NAMES = {None: "total", "date": "daily", "week_start": "weekly"}


def activity_stats(tx: DataFrame, side: str, period: str | None = None, with_rate: bool = False) -> DataFrame:
    """Transaction count and failure count per address (``side`` is "from" or
    "to") and optionally per ``period`` ("date" or "week_start")."""
    name = PERIOD_NAMES[period]
    keys = [q(side)] + ([q(period)] if period else [])
    out = tx.groupBy(*keys).agg(
        F.count(F.lit(1)).alias(f"{name}_tx_count_{side}"),
        F.sum(q("isError").try_cast("int")).alias(f"{name}_fail_count_{side}"),
    )
    if with_rate:
        out = out.withColumn(
            f"{name}_fail_rate_{side}",
            smoothed_rate(q(f"{name}_fail_count_{side}"), q(f"{name}_tx_count_{side}")),
        )
    return out


def daily_avg_interval(tx_with_intervals: DataFrame, side: str) -> DataFrame:
    """Mean interval (seconds) per address and day; the first transaction of
    an address has no interval and is ignored."""
    return tx_with_intervals.groupBy(q(side), q("date")).agg(
        F.avg(q(f"interval_{side}")).alias(f"daily_avg_interval_{side}")
    )

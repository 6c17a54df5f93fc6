"""Per-transaction behavioural features.

Given prepared transactions with temporal columns, attach for both sides of
the transfer (sender ``from`` and receiver ``to``):

* total / daily / weekly transaction and failure counts and the smoothed
  failure rate ``(fails + 1) / (n + 1)``;
* the previous transaction time and the interval to it (ties broken by
  block number, transaction index, hash) and the mean interval per day;

and for the sender the rolling statistics of ``log1p(value)`` and
``log1p(gasPrice)`` over the preceding 7 days excluding the current second,
their z-scores and the spike flags.

Counts and first and last times per (side, address, day) are one small table
(``activity_days``), partially aggregated before its shuffle. Windows by address
over it (``day_table``; at most one row a day) give all that crosses clusters:
totals, weeks, the last time before a day, and the telescoped intervals.

Rows are clustered by (address, week), and the day table's rows go with them.
With each row goes a narrow copy moved on by 7 days, into the next week's
cluster. So a 7-day frame is the copies from a row's time on, and the rows
before it, of one cluster: two running windows, whatever the length of the
frame, and time is linear in the rows of an address.

A week of one address with very many rows is cut into slices: its hours, and
busy hours into equal parts. Only then, (n, mean, squared deviation) of whole
slices are merged by the difference of their means, which does not cancel on
near-constant values, and added to what the running windows give. Which weeks
are cut depends on the share of rows they hold, so their number is bounded.

``window`` (window aggregates by address) and ``join`` (the aggregate +
left-join form) give the same table on small data; they are what tests compare
with, and put all rows of an address into one task.

NULL keys never get aggregate features (a NULL address or date matches no
group), as with an equi-join. Rows without a time have each other as rolling
frame, as a RANGE frame has it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.functions.scalar import seconds_between, smoothed_rate, spike_flag, zscore
from ledgerlens.operators.aggregates import activity_stats, daily_avg_interval
from ledgerlens.operators.prepare import q
from ledgerlens.operators.scoring import materialize
from ledgerlens.schema import ROLLING_WINDOW_SECONDS

W = ROLLING_WINDOW_SECONDS
SIDES = ("from", "to")
PERIODS = (("total", None), ("daily", "date"), ("weekly", "week_start"))
TIEBREAK = ("blockNumber", "transactionIndex", "hash")

ROLLING_COLS = [
    "rolling_value_mean",
    "rolling_value_std",
    "rolling_gasPrice_mean",
    "rolling_gasPrice_std",
    "rolling_tx_count",
]


def stat_cols(side: str) -> list[str]:
    out = []
    for period, _ in (("daily", 0), ("weekly", 0), ("total", 0)):
        out += [f"{period}_tx_count_{side}", f"{period}_fail_count_{side}", f"{period}_fail_rate_{side}"]
    return out


DERIVED_COLS = (
    [
        "prev_datetime_from",
        "interval_from",
        "prev_datetime_to",
        "interval_to",
        "log_value",
        "log_gasPrice",
    ]
    + ROLLING_COLS
    + ["value_zscore", "gasPrice_zscore", "value_spike", "gasPrice_spike"]
    + stat_cols("from")
    + stat_cols("to")
    + ["daily_avg_interval_from", "daily_avg_interval_to"]
)


def _tiebreak(df: DataFrame) -> list[Column]:
    return [q(c) for c in TIEBREAK if c in df.columns]


def with_value_logs(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {"log_value": F.log1p(q("value")), "log_gasPrice": F.log1p(q("gasPrice"))}
    )


def _key_ok(side: str, period: str | None) -> Column:
    ok = q(side).isNotNull()
    return ok & q(period).isNotNull() if period else ok


def _fail() -> Column:
    return q("isError").try_cast("int")


# ---------------------------------------------------------------------------
# plan "window"
# ---------------------------------------------------------------------------


def _window_side(df: DataFrame, side: str) -> DataFrame:
    """One side's features with window aggregates.

    All windows share one sort: rows are ordered by (address, week_start,
    date, datetime, tie-breakers) and every window asks for a prefix of that
    order -- the address total (address), the week (address, week_start),
    the day (address, week_start, date; the week is implied by the date) and
    the ``lag`` (address; ordered by week_start, date, datetime, which is
    datetime order). Only the rolling RANGE frame, which must be ordered by
    the epoch second alone, sorts once more; it is evaluated first so the
    shared sort stays on top of it.
    """
    key = q(side)
    tb = _tiebreak(df)
    by_key = Window.partitionBy(key)
    ordered = by_key.orderBy(q("week_start"), q("date"), q("datetime"), *tb)
    periods = {
        None: by_key,
        "week_start": Window.partitionBy(key, q("week_start")),
        "date": Window.partitionBy(key, q("week_start"), q("date")),
    }
    if side == "from":
        roll = by_key.orderBy(q("ts")).rangeBetween(-W, -1)
        df = df.withColumns(
            {
                "rolling_value_mean": F.avg("log_value").over(roll),
                "rolling_value_std": F.stddev_samp("log_value").over(roll),
                "rolling_gasPrice_mean": F.avg("log_gasPrice").over(roll),
                "rolling_gasPrice_std": F.stddev_samp("log_gasPrice").over(roll),
                "rolling_tx_count": F.count(F.lit(1)).over(roll),
            }
        )
    cols = {f"prev_datetime_{side}": F.lag(q("datetime")).over(ordered)}
    for period, pcol in PERIODS:
        w = periods[pcol]
        ok = _key_ok(side, pcol)
        cols[f"{period}_tx_count_{side}"] = F.when(ok, F.count(F.lit(1)).over(w))
        cols[f"{period}_fail_count_{side}"] = F.when(ok, F.sum(_fail()).over(w))
    df = df.withColumns(cols)
    df = df.withColumn(
        f"interval_{side}", seconds_between(q("datetime"), q(f"prev_datetime_{side}"))
    )
    df = df.withColumn(
        f"daily_avg_interval_{side}",
        F.when(_key_ok(side, "date"), F.avg(q(f"interval_{side}")).over(periods["date"])),
    )
    return df


def _features_window(base: DataFrame) -> DataFrame:
    df = _window_side(base, "from")
    return _window_side(df, "to")


# ---------------------------------------------------------------------------
# plan "join"
# ---------------------------------------------------------------------------


def _features_join(base: DataFrame) -> DataFrame:
    tb = _tiebreak(base)
    df = base
    for side in SIDES:
        w = Window.partitionBy(q(side)).orderBy(q("datetime"), *tb)
        df = df.withColumn(f"prev_datetime_{side}", F.lag(q("datetime")).over(w))
        df = df.withColumn(
            f"interval_{side}", seconds_between(q("datetime"), q(f"prev_datetime_{side}"))
        )
    roll = Window.partitionBy(q("from")).orderBy(q("ts")).rangeBetween(-W, -1)
    df = df.withColumns(
        {
            "rolling_value_mean": F.avg("log_value").over(roll),
            "rolling_value_std": F.stddev_samp("log_value").over(roll),
            "rolling_gasPrice_mean": F.avg("log_gasPrice").over(roll),
            "rolling_gasPrice_std": F.stddev_samp("log_gasPrice").over(roll),
            "rolling_tx_count": F.count(F.lit(1)).over(roll),
        }
    )
    out = df
    for side in SIDES:
        for period, pcol in (("daily", "date"), ("weekly", "week_start"), ("total", None)):
            stats = activity_stats(df, side, pcol)
            keys = [side] + ([pcol] if pcol else [])
            out = out.join(stats, keys, "left")
    for side in SIDES:
        out = out.join(daily_avg_interval(df, side), [side, "date"], "left")
    return out


# ---------------------------------------------------------------------------
# plan "clustered"
# ---------------------------------------------------------------------------

NULL_KEY = "\u0000"  # stands for a NULL address
MONDAY = 4 * 86400  # 1970-01-05: weeks of seconds begin where week_start does
#: A week of an address is cut once it holds more rows than this, and more than
#: one in MAX_BUSY of all rows: at most MAX_BUSY weeks are.
BUSY_ROWS = 100_000
MAX_BUSY = 20_000
SLICES = 1 << 20  # a week has fewer slices
#: Rows, copies included, of a task that sorts clusters: the number of tasks
#: grows with the input, and the memory of one does not.
TASK_ROWS = 200_000


def _merged(a: Column, b: Column) -> Column:
    """Two (n, mean, m2) structs as one: the means meet by their difference,
    so equal values keep a squared deviation of exactly 0."""
    n = a["n"] + b["n"]
    delta = b["mean"] - a["mean"]
    both = F.struct(
        n.alias("n"),
        (a["mean"] + delta * b["n"] / n).alias("mean"),
        (a["m2"] + b["m2"] + delta * delta * a["n"] * b["n"] / n).alias("m2"),
    )
    return F.when(F.coalesce(a["n"], F.lit(0.0)) == 0, b).when(F.coalesce(b["n"], F.lit(0.0)) == 0, a).otherwise(both)


def _moment_struct(x: Column, over=None) -> Column:
    """(n, mean, m2) of the non-NULL values of ``x``, as an aggregate or over
    a window."""
    parts = [F.count(x), F.avg(x), F.var_pop(x), F.max(x)]
    n, mean, var, high = parts if over is None else [p.over(over) for p in parts]
    n = n.cast("double")
    # the deviation of equal values is exactly 0, but sum / n may be off by a bit
    mean = F.when(var == 0, high).otherwise(mean)
    return F.struct(n.alias("n"), F.coalesce(mean, F.lit(0.0)).alias("mean"), (F.coalesce(var, F.lit(0.0)) * n).alias("m2"))


def _no_values() -> Column:
    return F.struct(*[F.lit(0.0).alias(c) for c in ("n", "mean", "m2")])


def _mean_std(m: Column) -> dict[str, Column]:
    """Mean and sample standard deviation of a (n, mean, m2) struct."""
    return {"mean": F.when(m["n"] > 0, m["mean"]), "std": F.when(m["n"] > 1, F.sqrt(m["m2"] / (m["n"] - 1)))}


def _week(t: Column) -> Column:
    return F.floor((t - MONDAY) / W)


def _key(side: str) -> Column:
    return F.coalesce(q(side), F.lit(NULL_KEY))


def activity_days(base: DataFrame) -> DataFrame:
    """(side, k, date, week_start, day_rows, day_fails, day_first, day_last) of
    both sides in one pass; ``k`` is the address. Tables of separate rows can
    be added up (``merge_days``)."""
    sides = F.explode(F.array(*[F.struct(F.lit(s).alias("side"), _key(s).alias("k")) for s in SIDES]))
    rows = base.select(sides.alias("_s"), q("date"), q("week_start"), q("datetime"), _fail().alias("fail"))
    return rows.groupBy("_s.side", "_s.k", "date").agg(
        F.min("week_start").alias("week_start"),
        F.count(F.lit(1)).alias("day_rows"),
        F.sum("fail").alias("day_fails"),
        F.min("datetime").alias("day_first"),
        F.max("datetime").alias("day_last"),
    )


def merge_days(days: DataFrame) -> DataFrame:
    """Several rows of a (side, k, date) as one."""
    return days.groupBy("side", "k", "date").agg(
        F.min("week_start").alias("week_start"),
        F.sum("day_rows").alias("day_rows"),
        F.sum("day_fails").alias("day_fails"),
        F.min("day_first").alias("day_first"),
        F.max("day_last").alias("day_last"),
    )


def day_table(days: DataFrame) -> DataFrame:
    """``activity_days`` with what crosses days: the last time before the day,
    the counts of the week and in all, and the mean interval of the day."""
    by_key = Window.partitionBy("side", "k")
    by_week = Window.partitionBy("side", "k", "week_start")
    in_order = by_key.orderBy("week_start", "date")
    days = days.withColumn("prev_last", F.lag("day_last").over(in_order))
    has_prev = q("prev_last").isNotNull()
    length = seconds_between(q("day_last"), F.coalesce("prev_last", "day_first"))
    number = q("day_rows") - 1 + has_prev.cast("long")
    return days.withColumns(
        {
            "week_rows": F.sum("day_rows").over(by_week),
            "week_fails": F.sum("day_fails").over(by_week),
            "total_rows": F.sum("day_rows").over(by_key),
            "total_fails": F.sum("day_fails").over(by_key),
            "day_interval": F.try_divide(length, number.cast("double")),
        }
    )


def daily_intervals(tx: DataFrame, side: str) -> DataFrame:
    """Mean interval (seconds) per address and day, from the day table alone:
    the intervals of a day add up to the time between its last transaction and
    the last one before it. NULL addresses are one address, as in a group."""
    days = day_table(activity_days(tx)).filter(q("side") == side)
    return days.select(F.when(q("k") != F.lit(NULL_KEY), q("k")).alias(side), "date", q("day_interval").alias(f"daily_avg_interval_{side}"))


INFO = ["prev_last", "day_rows", "day_fails", "week_rows", "week_fails", "total_rows", "total_fails", "day_interval"]
PIECES = ["pre_rows", "pre_v", "pre_g", "suf_rows", "suf_v", "suf_g"]


class _Layout:
    """The slices of the busy weeks of one side, and what whole slices hold."""

    def __init__(self, rows: DataFrame, days: DataFrame, side: str, weeks: DataFrame, limit: int, rolling: bool):
        self.side = side
        self.weeks = F.broadcast(weeks.filter(q("side") == side).select("k", "_week"))
        moved = F.array(F.lit(0), F.lit(1)) if rolling else F.array(F.lit(0))
        logs = ["log_value", "log_gasPrice"] if rolling else []
        own = rows.select(_key(side).alias("k"), q("ts"), q("date"), q("datetime"), *[q(c) for c in logs], F.explode(moved).alias("_copy"))
        own = own.withColumn("_t", q("ts") + q("_copy") * W).withColumn("_week", _week(q("_t")))
        own = own.join(self.weeks, ["k", "_week"]).withColumn("_hour", F.floor(q("_t") / 3600))
        hours = own.groupBy("k", "_week", "_hour").agg(F.count(F.lit(1)).alias("n"))
        parts = F.least(F.lit(3600), F.ceil(q("n") / F.lit(limit)))
        before = Window.partitionBy("k", "_week").orderBy("_hour").rowsBetween(Window.unboundedPreceding, -1)
        hours = hours.withColumn("parts", parts).withColumn("first", F.coalesce(F.sum("parts").over(before), F.lit(0)))
        entry = F.struct("_hour", F.struct("first", "parts"))
        slices = hours.groupBy("k", "_week").agg(F.map_from_entries(F.collect_list(entry)).alias("_slices"))  # 168 hours at most
        self.slices = F.broadcast(materialize(slices, "slices"))
        self.info = materialize(self._info(self.cut(own), days, rolling), "slice_info")

    def cut(self, data: DataFrame) -> DataFrame:
        """``_slice``: the slice of a row in its week, 0 where that is whole."""
        own = q("_slices")[F.floor(q("_t") / 3600)]
        at = own["first"] + F.floor(F.pmod(q("_t"), F.lit(3600)) * own["parts"] / 3600)
        out = data.join(self.slices, ["k", "_week"], "left")
        return out.withColumn("_slice", F.coalesce(at, F.lit(0)).cast("long")).drop("_slices")

    def _info(self, own: DataFrame, days: DataFrame, rolling: bool) -> DataFrame:
        real = q("_copy") == 0
        sums = [F.min("_t").alias("_t"), F.min(F.when(real, q("date"))).alias("date"), F.max(F.when(real, q("datetime"))).alias("last")]
        if rolling:
            for name, which in (("rows", real), ("copies", ~real)):
                sums.append(F.count(F.when(which, 1)).alias(name))
                sums += [_moment_struct(F.when(which, q(c))).alias(f"{name}_{x}") for x, c in (("v", "log_value"), ("g", "log_gasPrice"))]
        slices = own.groupBy("k", "_week", "_slice").agg(*sums)
        order = Window.partitionBy("k", "_week").orderBy("_slice")
        earlier = order.rowsBetween(Window.unboundedPreceding, -1)
        later = Window.partitionBy("k", "_week").orderBy(F.desc("_slice")).rowsBetween(Window.unboundedPreceding, -1)
        new = {"last_before": F.last("last", ignorenulls=True).over(earlier)}
        if rolling:
            for to, name, frame in (("pre", "rows", earlier), ("suf", "copies", later)):
                new[f"{to}_rows"] = F.coalesce(F.sum(name).over(frame), F.lit(0))
                new[f"_{to}"] = F.collect_list(F.struct(q(f"{name}_v").alias("v"), q(f"{name}_g").alias("g"))).over(frame)
        slices = slices.withColumns(new).filter(q("date").isNotNull())  # the others have copies only
        if rolling:
            for to in ("pre", "suf"):
                for x in ("v", "g"):
                    slices = slices.withColumn(f"{to}_{x}", _folded(f"_{to}", x))
        day = days.filter(q("side") == self.side).select("k", "date", *INFO)
        out = slices.join(day, ["k", "date"]).withColumn("prev_last", F.coalesce("last_before", "prev_last"))
        return out.select("k", "_week", "_slice", "_t", *INFO, *(PIECES if rolling else []))


def _folded(pieces: str, x: str) -> Column:
    return F.aggregate(pieces, _no_values(), lambda acc, p: _merged(acc, p[x]))


def _cluster_side(rows: DataFrame, days: DataFrame, side: str, layout: _Layout | None, rolling: bool, n_rows: int = 0) -> DataFrame:
    """Attach one side's features to rows that have a time: one exchange, by
    (address, week, slice), of the rows, their copies and the day table.
    ``n_rows``: about how many rows there are."""
    tb = _tiebreak(rows)
    names = rows.columns
    data = rows.withColumns({"k": _key(side), "_t": q("ts"), "_kind": F.lit(0)})
    if rolling:
        # each row as itself (kind 0) and as a narrow copy 7 days on (kind 1)
        data = rows.select("*", _key(side).alias("k"), F.explode(F.array(F.lit(0), F.lit(1))).alias("_kind"))
        own = q("_kind") == 0
        data = data.select(
            *[F.when(own, q(c)).alias(c) for c in names],
            "k", "_kind", (q("ts") + q("_kind") * W).alias("_t"),
            F.when(~own, q("log_value")).alias("_sv"), F.when(~own, q("log_gasPrice")).alias("_sg"),
        )
    data = data.withColumn("_week", _week(q("_t")))
    data = layout.cut(data) if layout else data.withColumn("_slice", F.lit(0).cast("long"))

    # the day's row stands before the rows of the day
    info = days.filter((q("side") == side) & q("date").isNotNull())
    info = info.withColumn("_t", F.unix_seconds(q("date").cast("timestamp"))).withColumn("_week", _week(q("_t")))
    kept = [*INFO, *(PIECES if layout and rolling else [])]
    if layout:
        whole = info.join(layout.weeks, ["k", "_week"], "left_anti").withColumn("_slice", F.lit(0).cast("long"))
        info = whole.unionByName(layout.info, allowMissingColumns=True)
    else:
        info = info.withColumn("_slice", F.lit(0).cast("long"))
    info = info.select("k", "_week", "_slice", "_t", F.lit(-1).alias("_kind"), F.struct(*[q(c) for c in kept]).alias("_info"))
    data = data.unionByName(info, allowMissingColumns=True).withColumn("_seg", q("_week") * SLICES + q("_slice")).drop("_week", "_slice")
    n_rows *= 2 if rolling else 1
    if n_rows > TASK_ROWS:
        # a number of its own: adaptive execution would join parts by their compressed size
        parts = max(-(-n_rows // TASK_ROWS), rows.sparkSession.sparkContext.defaultParallelism)
        data = data.repartition(parts, "k", "_seg")

    part = Window.partitionBy("k", "_seg")
    earlier = part.orderBy(q("_t"), q("_kind"), *tb).rowsBetween(Window.unboundedPreceding, -1)
    is_row = q("_kind") == 0
    cols = {
        "_prev": F.last(F.when(is_row, q("datetime")), ignorenulls=True).over(earlier),
        "_info": F.last("_info", ignorenulls=True).over(earlier),
    }
    if rolling:
        before = part.orderBy(q("_t")).rangeBetween(Window.unboundedPreceding, -1)
        after = part.orderBy(q("_t").desc()).rangeBetween(Window.unboundedPreceding, 0)
        cols["_cur_rows"] = F.count(F.when(is_row, F.lit(1))).over(before)
        cols["_old_rows"] = F.count(F.when(q("_kind") == 1, F.lit(1))).over(after)
        for x, c, old in (("v", "log_value", "_sv"), ("g", "log_gasPrice", "_sg")):
            cols[f"_cur_{x}"] = _moment_struct(F.when(is_row, q(c)), before)
            cols[f"_old_{x}"] = _moment_struct(q(old), after)
    out = data.withColumns(cols).filter(is_row)
    get = q("_info")
    prev = F.coalesce(q("_prev"), get["prev_last"])
    known = q("k") != F.lit(NULL_KEY)
    new = {
        f"prev_datetime_{side}": prev,
        f"interval_{side}": seconds_between(q("datetime"), prev),
        f"daily_avg_interval_{side}": F.when(known, get["day_interval"]),
    }
    for period, name in (("daily", "day"), ("weekly", "week"), ("total", "total")):
        new[f"{period}_tx_count_{side}"] = F.when(known, get[f"{name}_rows"])
        new[f"{period}_fail_count_{side}"] = F.when(known, get[f"{name}_fails"])
    if rolling:
        count = q("_old_rows") + q("_cur_rows")
        # one column a step: nested, the merges would repeat their inputs
        if layout:
            count = count + F.coalesce(get["suf_rows"] + get["pre_rows"], F.lit(0))
            for x in ("v", "g"):
                for piece in ("suf", "pre"):
                    out = out.withColumn(f"_old_{x}", _merged(q(f"_old_{x}"), F.coalesce(get[f"{piece}_{x}"], _no_values())))
        for name, x in (("value", "v"), ("gasPrice", "g")):
            out = out.withColumn(f"_old_{x}", _merged(q(f"_old_{x}"), q(f"_cur_{x}")))
            both = _mean_std(q(f"_old_{x}"))
            new[f"rolling_{name}_mean"], new[f"rolling_{name}_std"] = both["mean"], both["std"]
        new["rolling_tx_count"] = count.cast("long")
    return out.withColumns(new).select(*[q(c) for c in names], *new)


def _untimed(rows: DataFrame, days: DataFrame) -> DataFrame:
    """Features of the rows without a time: they have each other as rolling
    frame, and totals, but no day and no order."""
    own = rows.groupBy(_key("from").alias("k")).agg(
        F.count(F.lit(1)).alias("n"), _moment_struct(q("log_value")).alias("v"), _moment_struct(q("log_gasPrice")).alias("g")
    )
    totals = days.filter(q("date").isNull()).select("side", "k", "total_rows", "total_fails")
    out = rows
    for side in SIDES:
        mine = totals.filter(q("side") == side).drop("side")
        if side == "from":
            mine = mine.join(own, "k")
        out = out.withColumn("k", _key(side)).join(materialize(mine, "untimed"), "k")
        known = q("k") != F.lit(NULL_KEY)
        new = {f"prev_datetime_{side}": F.lit(None).cast("timestamp")}
        new |= dict.fromkeys((f"interval_{side}", f"daily_avg_interval_{side}"), F.lit(None).cast("double"))
        for c in ("tx_count", "fail_count"):
            new |= {f"{p}_{c}_{side}": F.lit(None).cast("long") for p in ("daily", "weekly")}
        new[f"total_tx_count_{side}"] = F.when(known, q("total_rows"))
        new[f"total_fail_count_{side}"] = F.when(known, q("total_fails"))
        if side == "from":
            for name, x in (("value", "v"), ("gasPrice", "g")):
                both = _mean_std(q(x))
                new[f"rolling_{name}_mean"], new[f"rolling_{name}_std"] = both["mean"], both["std"]
            new["rolling_tx_count"] = q("n")
        out = out.withColumns(new).drop("k", "total_rows", "total_fails", "n", "v", "g")
    return out


def _features_clustered(base: DataFrame, busy_rows: int, days: DataFrame | None) -> DataFrame:
    # ``days`` may be of a longer history than the rows
    n_rows = None if days is None else base.count()
    days = materialize(day_table(activity_days(base) if days is None else days), "days")
    size = days.agg(
        F.sum(F.when(q("side") == "from", q("day_rows"))).alias("rows"),
        F.max(F.when(q("date").isNotNull(), q("week_rows"))).alias("busiest"),
        F.count(F.when(q("date").isNull(), 1)).alias("untimed"),
    ).first()
    limit = max(busy_rows, (size["rows"] or 0) // MAX_BUSY)
    n_rows = (size["rows"] or 0) if n_rows is None else n_rows
    layouts = dict.fromkeys(SIDES)
    timed = base.filter(q("ts").isNotNull()) if size["untimed"] else base
    if (size["busiest"] or 0) > limit:
        first = F.unix_seconds(q("week_start").cast("timestamp"))
        weeks = days.filter((q("week_rows") > limit) & q("date").isNotNull()).select("side", "k", _week(first).alias("_week")).distinct()
        # copies of a busy week go to the next one
        weeks = weeks.withColumn("_week", F.explode(F.when(q("side") == "from", F.array("_week", q("_week") + 1)).otherwise(F.array("_week")))).distinct()
        weeks = materialize(weeks, "busy_weeks")
        layouts = {s: _Layout(timed, days, s, weeks, limit, s == "from") for s in SIDES}
    out = _cluster_side(timed, days, "from", layouts["from"], True, n_rows)
    out = _cluster_side(out, days, "to", layouts["to"], False, n_rows)
    if size["untimed"]:
        out = out.unionByName(_untimed(base.filter(q("ts").isNull()), days))
    return out


# ---------------------------------------------------------------------------


def build_features(
    tx: DataFrame,
    strategy: str = "clustered",
    busy_rows: int = BUSY_ROWS,
    days: DataFrame | None = None,
) -> DataFrame:
    """Feature table from prepared transactions with temporal columns.

    Weeks of one address with more than ``busy_rows`` rows are cut (see the
    module). ``days`` is the ``activity_days`` table of a longer history than
    ``tx``; counts and intervals are then of that history. The day table is
    written when this is called. ``strategy`` "window" or "join" takes a plan
    that tests compare with.
    """
    base = with_value_logs(tx).withColumn("ts", F.unix_seconds(q("datetime")))
    if strategy == "window":
        df = _features_window(base)
    elif strategy == "join":
        df = _features_join(base)
    elif strategy == "clustered":
        df = _features_clustered(base, busy_rows, days)
    else:
        raise ValueError(f"unknown strategy {strategy!r}")
    df = df.withColumns(
        {
            f"{period}_fail_rate_{side}": smoothed_rate(
                q(f"{period}_fail_count_{side}"), q(f"{period}_tx_count_{side}")
            )
            for side in SIDES
            for period, _ in PERIODS
        }
    )
    df = df.withColumns(
        {
            "value_zscore": zscore(q("log_value"), q("rolling_value_mean"), q("rolling_value_std")),
            "gasPrice_zscore": zscore(
                q("log_gasPrice"), q("rolling_gasPrice_mean"), q("rolling_gasPrice_std")
            ),
        }
    )
    df = df.withColumns(
        {
            "value_spike": spike_flag(q("rolling_tx_count"), q("rolling_value_std"), q("value_zscore")),
            "gasPrice_spike": spike_flag(
                q("rolling_tx_count"), q("rolling_gasPrice_std"), q("gasPrice_zscore")
            ),
        }
    )
    base_cols = [c for c in tx.columns]
    return df.select(*[q(c) for c in base_cols + DERIVED_COLS])

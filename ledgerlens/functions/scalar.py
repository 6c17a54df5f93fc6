"""Column-level building blocks (all JVM-side built-ins, no Python UDFs).

Spark 4 runs with ANSI mode on: bad casts and division by zero raise. The
helpers here use ``try_cast`` / ``try_divide`` so that bad input and a zero
denominator yield NULL, which is the behaviour the pipeline's rules assume.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerlens.schema import (
    DEFAULT_TIME_SLOT,
    LANDING_PREFIX,
    LANDING_TIME_FORMAT,
    SPIKE_MIN_COUNT,
    SPIKE_Z,
    TIME_SLOTS,
    WEI_PER_ETHER,
)


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_double(c: Column | str) -> Column:
    """Lenient cast to double: '' or garbage -> NULL."""
    return _c(c).try_cast("double")


def epoch_to_timestamp(c: Column | str) -> Column:
    """Epoch seconds (numeric) -> timestamp."""
    return F.timestamp_seconds(_c(c))


def time_slot(hour: Column | str) -> Column:
    """0-5 midnight, 6-11 morning, 12-17 afternoon, anything else night."""
    h = _c(hour)
    expr = None
    for lo, hi, label in TIME_SLOTS:
        cond = (h >= lo) & (h < hi)
        expr = F.when(cond, label) if expr is None else expr.when(cond, label)
    return expr.otherwise(DEFAULT_TIME_SLOT)


def smoothed_rate(fails: Column | str, total: Column | str) -> Column:
    """(fails + 1) / (total + 1): 0 of 10 -> 1/11, 10 of 10 -> 1.0."""
    return F.try_divide((_c(fails) + 1).cast("double"), (_c(total) + 1).cast("double"))


def contract_flag(contract_address: Column | str) -> Column:
    """1 when the contract address is a non-empty string, else 0 (NULL -> 0)."""
    return F.when(_c(contract_address) != "", 1).otherwise(0)


def strip_call_args(function_name: Column | str) -> Column:
    """'transfer(address,uint256)' -> 'transfer'; NULL stays NULL."""
    return F.substring_index(_c(function_name), "(", 1)


def seconds_between(t: Column | str, prev: Column | str) -> Column:
    """Whole seconds from ``prev`` to ``t`` as a double (NULL if either is)."""
    return (F.unix_seconds(_c(t)) - F.unix_seconds(_c(prev))).cast("double")


def zscore(x: Column | str, mean: Column | str, std: Column | str) -> Column:
    """(x - mean) / std; NULL when std is NULL or 0."""
    return F.try_divide(_c(x) - _c(mean), _c(std))


def spike_flag(count: Column | str, std: Column | str, z: Column | str) -> Column:
    """1 when there are at least SPIKE_MIN_COUNT rows in the frame, a
    defined deviation and z strictly above SPIKE_Z; otherwise 0."""
    return (
        F.when(_c(count) < SPIKE_MIN_COUNT, 0)
        .when(_c(std).isNull(), 0)
        .when(_c(z) > SPIKE_Z, 1)
        .otherwise(0)
    )


def parse_timestamp(c: Column | str) -> Column:
    """Timestamp text (ISO forms, with or without time) -> timestamp; text
    that is not a timestamp -> NULL."""
    return F.coalesce(F.try_to_timestamp(_c(c)), F.try_to_timestamp(_c(c), F.lit("yyyy-MM-dd HH:mm:ss.SSSSSS")))


def wei_to_ether(c: Column | str) -> Column:
    return _c(c) / F.lit(WEI_PER_ETHER)


def sum_columns(cols: list[Column]) -> Column:
    """n-ary sum; 0 columns -> 0.0, 1 column -> itself."""
    if not cols:
        return F.lit(0.0)
    return reduce(lambda a, b: a + b, cols)


def sum_of_squares(cols: list[Column]) -> Column:
    return sum_columns([c * c for c in cols])


def landing_key(address: Column | str, run_ts: Column | str, prefix: str = LANDING_PREFIX) -> Column:
    """<prefix>/YYYY/MM/DD/eth_txlist_<address>_<YYYY-MM-DDTHH-MM-SS>.json (UTC)."""
    ts = _c(run_ts)
    return F.concat(
        F.lit(prefix + "/"),
        F.date_format(ts, "yyyy/MM/dd"),
        F.lit("/eth_txlist_"),
        _c(address),
        F.lit("_"),
        F.date_format(ts, LANDING_TIME_FORMAT),
        F.lit(".json"),
    )


def round6(c: Column | str) -> Column:
    """Round to 6 decimals, for result columns that come from floating
    aggregates whose last bits depend on summation order.

    Two scaled steps, round(round(x * 1e9) / 1e9 * 1e6) / 1e6: the first maps
    values that differ only in their last bits to one double, so a value
    whose exact form ends in 5 at the 7th decimal is not split by the noise;
    each step rounds half away from zero, so any engine gets the same result.
    """
    x9 = F.round(_c(c) * F.lit(1e9), 0) / F.lit(1e9)
    return F.round(x9 * F.lit(1e6), 0) / F.lit(1e6)

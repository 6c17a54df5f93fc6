"""Schema clean-up, flags and casts applied to raw transaction rows.

Every step is one projection, so Catalyst collapses the chain into a single
``Project`` over the scan.
"""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.functions.scalar import contract_flag, strip_call_args, to_double
from ledgerlens.schema import CATEGORICAL_COLS, FEATURE_COLS, ID_COLS, NUMERIC_COLS, RAW_TX_FIELDS


@lru_cache(maxsize=4096)
def q(name: str):
    """Column reference safe for names such as ``from``/``to``. A column
    reference is an unresolved name (not bound to a frame), so one object per
    name is reused; this saves JVM round trips while plans are built."""
    return F.col(f"`{name}`")


def safe_names(names: list[str | None]) -> list[str]:
    """Strip names; a blank (or None) name at position i becomes ``col_<i>``."""
    out = []
    for i, c in enumerate(names):
        name = (c or "").strip()
        out.append(name if name else f"col_{i}")
    return out


def clean_column_names(df: DataFrame) -> DataFrame:
    """``safe_names`` applied to a frame; duplicate results are an error."""
    names = safe_names(df.columns)
    dup = {n for n in names if names.count(n) > 1}
    if dup:
        raise ValueError(f"duplicate column names after cleaning: {sorted(dup)}")
    return df.toDF(*names)


def missing_columns(df: DataFrame, expected: list[str] = RAW_TX_FIELDS) -> list[str]:
    """Expected raw fields absent from ``df`` (an audit, not an error)."""
    have = set(df.columns)
    return [c for c in expected if c not in have]


def prepare_transactions(df: DataFrame) -> DataFrame:
    """Contract flag, cleaned function name, numeric and categorical casts.

    Absent optional fields are skipped; the flag is 0 when ``contractAddress``
    is absent.
    """
    cols = set(df.columns)
    out = []
    for c in df.columns:
        if c in NUMERIC_COLS:
            out.append(to_double(q(c)).alias(c))
        elif c == "functionName":
            out.append(strip_call_args(q(c)).cast("string").alias(c))
        elif c in CATEGORICAL_COLS:
            out.append(q(c).cast("string").alias(c))
        else:
            out.append(q(c))
    flag = contract_flag(q("contractAddress")) if "contractAddress" in cols else F.lit(0)
    out.append(flag.alias("is_contract_call"))
    return df.select(*out)


def available_features(df: DataFrame, features: list[str] = FEATURE_COLS) -> list[str]:
    """Features present in ``df``, in the canonical order."""
    have = set(df.columns)
    return [c for c in features if c in have]


def model_input(df: DataFrame, features: list[str] = FEATURE_COLS) -> DataFrame:
    """Identifiers, encoded categories and the feature columns."""
    keep = ["hash", "from", "to", "methodId", "functionName", "time_slot"]
    keep = [c for c in keep if c in df.columns] + available_features(df, features)
    return df.select(*[q(c) for c in keep])


def drop_identifiers(df: DataFrame) -> DataFrame:
    return df.drop(*ID_COLS)

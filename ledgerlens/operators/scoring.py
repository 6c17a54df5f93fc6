"""Global z-score anomaly scoring.

score = sum over features of z^2, with z = (x - mean) / std against the
global mean and sample std of each feature. The statistics are one
aggregate job whose single row (two numbers per feature, a fixed size)
enters the plan as literals, so every later pass over the rows is a plain
projection.

Rules kept from the original scoring job:
* a feature whose std is NULL or 0 contributes nothing (its ``_z`` is NULL);
* with ``null_policy="propagate"`` a NULL feature value makes the score NULL
  (and a NULL score is never labelled anomalous); ``"skip"`` counts it as 0;
* rows scoring at or above the 99th percentile are labelled -1, others 1.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.functions.scalar import round6, sum_columns
from ledgerlens.operators.prepare import available_features, q
from ledgerlens.schema import (
    ANOMALY_LABEL,
    APPROX_RELATIVE_ERROR,
    FEATURE_COLS,
    NORMAL_LABEL,
    THRESHOLD_PERCENTILE,
)
from ledgerlens.session import scratch_dir


def feature_stats(df: DataFrame, features: list[str]) -> DataFrame:
    """One row: ``<f>_mean`` and ``<f>_std`` (sample) for every feature."""
    exprs = stat_exprs(features)
    if not exprs:
        raise ValueError("no feature columns to describe")
    return df.agg(*exprs)


def stat_exprs(features: list[str]) -> list:
    exprs = []
    for c in features:
        x = q(c).cast("double")
        exprs += [F.avg(x).alias(f"{c}_mean"), F.stddev_samp(x).alias(f"{c}_std")]
    return exprs


def usable(stats: dict, feature: str) -> bool:
    sd = stats.get(f"{feature}_std")
    return sd is not None and sd != 0 and stats.get(f"{feature}_mean") is not None


def add_anomaly_score(
    df: DataFrame,
    features: list[str] | None = None,
    null_policy: str = "propagate",
    stats: dict | None = None,
) -> tuple[DataFrame, list[str]]:
    """Adds ``<f>_z`` for every available feature and ``anomaly_score``.
    ``stats`` (``<f>_mean`` / ``<f>_std``) may come from an earlier pass;
    otherwise one aggregate job computes them."""
    if null_policy not in ("propagate", "skip"):
        raise ValueError("null_policy must be 'propagate' or 'skip'")
    feats = available_features(df, features or FEATURE_COLS)
    if not feats:
        return df.withColumn("anomaly_score", F.lit(0.0)), []
    if stats is None:
        stats = feature_stats(df, feats).first().asDict()
    scored = df.withColumns({c: q(c).cast("double") for c in feats})
    zcols, terms = {}, []
    for c in feats:
        m, sd = stats[f"{c}_mean"], stats[f"{c}_std"]
        if not usable(stats, c):
            zcols[f"{c}_z"] = F.lit(None).cast("double")
            terms.append(F.lit(0.0))
            continue
        z = (q(c) - F.lit(float(m))) / F.lit(float(sd))
        zcols[f"{c}_z"] = z
        term = z * z
        terms.append(F.coalesce(term, F.lit(0.0)) if null_policy == "skip" else term)
    scored = scored.withColumns(zcols).withColumn("anomaly_score", sum_columns(terms))
    return scored, feats


def value_at_rank(vals: DataFrame, rank: int, n: int, max_collect: int, accuracy: int) -> float:
    """The value at 0-based ``rank`` of the ``n`` values of column ``v``.

    Each round takes two values a <= b that bracket the rank by
    ``percentile_approx`` and counts the rows below, at, between and above
    them. A rank that falls on a or b is answered at once; otherwise the search
    goes on in the open interval that holds it. That interval holds neither a
    nor b, so it always shrinks, ties or not. The last ``max_collect`` values
    are fetched as a bounded top-k of the shorter tail.
    """
    sub, below, m = vals, 0, n
    while m > max_collect:
        share = (rank - below) / m
        eps = 2.0 / accuracy
        a, b = sub.agg(
            F.percentile_approx("v", [max(0.0, share - eps), min(1.0, share + eps)], accuracy)
        ).first()[0]
        v = q("v")
        c = sub.agg(
            F.count(F.when(v < a, 1)).alias("lt"),
            F.count(F.when(v == a, 1)).alias("at_a"),
            F.count(F.when((v > a) & (v < b), 1)).alias("mid"),
            F.count(F.when((v == b) & F.lit(b > a), 1)).alias("at_b"),
            F.count(F.when(v > b, 1)).alias("gt"),
        ).first()
        r = rank - below
        if r < c["lt"]:
            sub, m = sub.filter(v < a), c["lt"]
        elif r < c["lt"] + c["at_a"]:
            return float(a)
        elif r < c["lt"] + c["at_a"] + c["mid"]:
            sub, m = sub.filter((v > a) & (v < b)), c["mid"]
            below += c["lt"] + c["at_a"]
        elif r < m - c["gt"]:
            return float(b)
        else:
            sub = sub.filter(v > b)
            below += m - c["gt"]
            m = c["gt"]
    r = rank - below
    if m - r <= r + 1:
        return float(sub.orderBy(F.desc("v")).limit(m - r).collect()[-1][0])
    return float(sub.orderBy("v").limit(r + 1).collect()[-1][0])


def exact_percentile(
    df: DataFrame,
    col: str,
    q_: float = THRESHOLD_PERCENTILE,
    max_collect: int = 200_000,
    accuracy: int = 10_000,
    n: int | None = None,
) -> float | None:
    """Exact continuous percentile (linear interpolation between the two
    neighbouring ranks) of the non-NULL, non-NaN values of ``col``.

    Distributed (see ``value_at_rank``); the upper neighbour is the same value
    or the smallest one above it, which one aggregate tells. Only scalars and a
    bounded set of values reach the driver.
    """
    vals = df.select(q(col).cast("double").alias("v")).filter(q("v").isNotNull() & ~F.isnan("v"))
    if n is None:  # the number of such values, unless already known
        n = vals.count()
    if n == 0:
        return None
    pos = (n - 1) * q_
    lo = math.floor(pos)
    frac = pos - lo
    low = value_at_rank(vals, lo, n, max_collect, accuracy)
    if frac == 0:
        return low
    c = vals.agg(F.count(F.when(q("v") <= low, 1)).alias("le"), F.min(F.when(q("v") > low, q("v"))).alias("next")).first()
    high = low if lo + 1 < c["le"] else c["next"]
    return float(low + frac * (high - low))


def score_threshold(
    scored: DataFrame,
    q_: float = THRESHOLD_PERCENTILE,
    method: str = "exact",
    relative_error: float = APPROX_RELATIVE_ERROR,
    n_scored: int | None = None,
) -> float | None:
    """Threshold at the ``q_`` percentile of ``anomaly_score``.

    ``method="exact"``: exact interpolated percentile (default).
    ``method="approx"``: ``approxQuantile(q_, relative_error)``, the sketch
    used by the original job (may land anywhere within the error band).
    """
    if method == "exact":
        return exact_percentile(scored, "anomaly_score", q_, n=n_scored)
    if method == "approx":
        res = scored.filter(q("anomaly_score").isNotNull()).approxQuantile(
            "anomaly_score", [q_], relative_error
        )
        return float(res[0]) if res else None
    raise ValueError("method must be 'exact' or 'approx'")


def add_labels(scored: DataFrame, threshold: float | None) -> DataFrame:
    """pred_label = -1 where score >= threshold, else 1 (NULL score -> 1)."""
    if threshold is None:
        return scored.withColumn("pred_label", F.lit(NORMAL_LABEL))
    return scored.withColumn(
        "pred_label",
        F.when(q("anomaly_score") >= F.lit(float(threshold)), F.lit(ANOMALY_LABEL)).otherwise(
            F.lit(NORMAL_LABEL)
        ),
    )


def label_summary(labeled: DataFrame) -> DataFrame:
    """Count and share (percent) per label."""
    counts = labeled.groupBy("pred_label").agg(F.count(F.lit(1)).alias("count"))
    total = counts.agg(F.sum("count").alias("_total"))  # one row
    return (
        counts.crossJoin(F.broadcast(total))
        .withColumn("pct", round6(q("count").cast("double") * 100.0 / q("_total").cast("double")))
        .drop("_total")
    )


def materialize(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write ``df`` as Parquet under the shared checkpoint folder and read it
    back: cuts the lineage, survives executor loss, and later scans read only
    the columns they need."""
    spark = SparkSession.getActiveSession() or df.sparkSession
    path = scratch_dir(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def materialize_features(features: DataFrame, name: str = "features") -> tuple[DataFrame, dict]:
    """Write the feature table once (shared checkpoint folder), then gather
    in one aggregate over the written columnar table the global statistics
    the score needs, the row count and the number of rows with every feature
    present (so the threshold needs no separate counting pass).

    (The statistics are not gathered with ``Observation`` during the write:
    on Spark 4.1 a session that has used it can no longer serialize MLlib
    models that keep a training summary.)"""
    table = materialize(features, name)
    feats = available_features(table, FEATURE_COLS)
    complete = F.lit(True)
    for c in feats:
        complete = complete & q(c).isNotNull()
    exprs = stat_exprs(feats) + [
        F.count(F.lit(1)).alias("_rows"),
        F.count(F.when(complete, 1)).alias("_complete"),
    ]
    return table, table.agg(*exprs).first().asDict()


def score_transactions(
    features: DataFrame,
    q_: float = THRESHOLD_PERCENTILE,
    method: str = "exact",
    null_policy: str = "propagate",
    persist: bool = True,
) -> tuple[DataFrame, list[str], float | None]:
    """features -> (labelled rows, features used, threshold).

    With ``persist`` the feature table is written once to the shared
    checkpoint folder, and so are the scores; the statistics and the scored
    rows then read the written table, the threshold passes the scores. The number of scored rows comes with
    the statistics when every feature is usable (or NULLs count as 0), which
    saves the counting pass."""
    stats, n_scored = None, None
    if persist:
        features, stats = materialize_features(features)
    scored, used = add_anomaly_score(features, null_policy=null_policy, stats=stats)
    if stats is not None:
        if null_policy == "skip" or not used:
            n_scored = stats["_rows"]
        elif all(usable(stats, c) for c in used):
            n_scored = stats["_complete"]
    # each pass of the threshold reads one written column, not every feature
    scores = materialize(scored.select("anomaly_score"), "scores") if persist else scored
    threshold = score_threshold(scores, q_, method, n_scored=n_scored)
    return add_labels(scored, threshold), used, threshold

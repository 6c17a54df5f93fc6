"""Serving projections, filters and report queries over scored rows.

Every function returns a lazy DataFrame; filters are plain predicates so
they reach the Parquet/JDBC scan when the input is a table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.functions.scalar import round6, wei_to_ether
from ledgerlens.operators.scoring import materialize
from ledgerlens.operators.prepare import q
from ledgerlens.schema import ANOMALY_LABEL


# --- serving shapes ---------------------------------------------------------


def predictions_view(labeled: DataFrame) -> DataFrame:
    """Relational predictions table: one row per transaction."""
    return labeled.select(
        q("hash").alias("tx_hash"),
        q("from").alias("from_address"),
        q("to").alias("to_address"),
        q("blockNumber").cast("bigint").alias("block_number"),
        q("date").alias("tx_date"),
        q("anomaly_score"),
        q("pred_label").alias("fraud_label"),
    )


def dashboard_view(labeled: DataFrame) -> DataFrame:
    """Dashboard table: value in ether, event time, 0/1 fraud flag."""
    return labeled.select(
        q("hash").alias("tx_hash"),
        q("from").alias("from_address"),
        q("to").alias("to_address"),
        wei_to_ether(q("value")).alias("value_eth"),
        q("datetime").alias("timestamp"),
        q("anomaly_score"),
        (q("pred_label") == ANOMALY_LABEL).cast("int").alias("fraud_flag"),
    )


def normalize_flag(c: Column) -> Column:
    """Boolean or numeric flag -> int 0/1."""
    return F.coalesce(c.cast("int"), F.lit(0))


# --- filters ------------------------------------------------------------------


def anomalies_only(labeled: DataFrame) -> DataFrame:
    return labeled.filter(q("pred_label") == ANOMALY_LABEL)


def min_score_filter(view: DataFrame, min_score: float) -> DataFrame:
    """Rows at or above ``min_score`` (inclusive). The score is unbounded."""
    return view.filter(q("anomaly_score") >= F.lit(float(min_score)))


def gas_spike_rows(features: DataFrame) -> DataFrame:
    return features.filter(q("gasPrice_spike") == 1)


def tx_search(
    view: DataFrame,
    addresses: list[str] | None = None,
    date_from: str | None = None,
    date_to: str | None = None,
    min_value: float | None = None,
    max_value: float | None = None,
    min_score: float | None = None,
    flagged_only: bool = False,
) -> DataFrame:
    """Conjunctive search over the dashboard table; address matches either
    side of the transfer."""
    cond = F.lit(True)
    if addresses:
        cond = cond & (q("from_address").isin(addresses) | q("to_address").isin(addresses))
    if date_from is not None:
        cond = cond & (q("timestamp") >= F.lit(date_from).cast("timestamp"))
    if date_to is not None:
        cond = cond & (q("timestamp") < F.date_add(F.lit(date_to).cast("date"), 1).cast("timestamp"))
    if min_value is not None:
        cond = cond & (q("value_eth") >= F.lit(float(min_value)))
    if max_value is not None:
        cond = cond & (q("value_eth") <= F.lit(float(max_value)))
    if min_score is not None:
        cond = cond & (q("anomaly_score") >= F.lit(float(min_score)))
    if flagged_only:
        cond = cond & (q("fraud_flag") == 1)
    return view.filter(cond)


def search_stored(
    predictions: DataFrame,
    addresses: list[str] | None = None,
    date_from: str | None = None,
    date_to: str | None = None,
    **more,
) -> DataFrame:
    """``tx_search`` over a stored predictions table (``write_search_table``):
    the dates prune its folders, the addresses reach its files' statistics and
    bloom filters, and the dashboard columns are made from what is left."""
    rows = predictions
    if date_from is not None:
        rows = rows.filter(q("date") >= F.lit(date_from).cast("date"))
    if date_to is not None:
        rows = rows.filter(q("date") <= F.lit(date_to).cast("date"))
    return tx_search(dashboard_view(rows), addresses, date_from, date_to, **more)


# --- KPIs and trends -----------------------------------------------------------


def kpi_summary(view: DataFrame, min_score: float) -> DataFrame:
    """One row: totals, rows over the minimum score, flagged count and rate
    (0 when empty), mean and max score, distinct flagged senders."""
    flag = normalize_flag(q("fraud_flag"))
    out = view.agg(
        F.count(F.lit(1)).alias("total_tx"),
        F.count(F.when(q("anomaly_score") >= F.lit(float(min_score)), 1)).alias("suspicious_tx"),
        F.coalesce(F.sum(flag), F.lit(0)).cast("bigint").alias("fraud_tx"),
        F.avg(q("anomaly_score")).alias("avg_score"),
        F.max(q("anomaly_score")).alias("max_score"),
        F.count_distinct(F.when(flag == 1, q("from_address"))).alias("unique_suspicious_senders"),
    )
    return out.select(
        "total_tx",
        "suspicious_tx",
        "fraud_tx",
        F.when(q("total_tx") > 0, q("fraud_tx") / q("total_tx")).otherwise(F.lit(0.0)).alias("fraud_rate"),
        round6(q("avg_score")).alias("avg_score"),
        round6(q("max_score")).alias("max_score"),
        "unique_suspicious_senders",
    )


def daily_trend(view: DataFrame) -> DataFrame:
    """Per calendar day from the first to the last: transactions, flagged
    transactions and mean score; days without rows are filled with 0."""
    flag = normalize_flag(q("fraud_flag"))
    per_day = view.groupBy(F.to_date(q("timestamp")).alias("date")).agg(
        F.count(q("tx_hash")).alias("total_tx"),
        F.sum(flag).cast("bigint").alias("fraud_tx"),
        F.avg(q("anomaly_score")).alias("avg_score"),
    )
    per_day = materialize(per_day, "per_day")  # read twice: one row per day
    span = per_day.agg(F.min("date").alias("lo"), F.max("date").alias("hi"))
    # one row per day of the span: bounded by the number of days
    calendar = span.select(F.explode(F.sequence(q("lo"), q("hi"), F.expr("interval 1 day"))).alias("date"))
    return calendar.join(per_day, "date", "left").select(
        "date",
        F.coalesce(q("total_tx"), F.lit(0)).cast("bigint").alias("total_tx"),
        F.coalesce(q("fraud_tx"), F.lit(0)).cast("bigint").alias("fraud_tx"),
        round6(q("avg_score")).alias("avg_score"),
    )


def score_distribution(view: DataFrame) -> DataFrame:
    """Distinct (rounded) score -> count, NULL scores dropped, by score."""
    return (
        view.filter(q("anomaly_score").isNotNull())
        .groupBy(round6(q("anomaly_score")).alias("anomaly_score"))
        .agg(F.count(F.lit(1)).alias("tx_count"))
        .orderBy("anomaly_score")
    )


def score_histogram(view: DataFrame, lo: float, hi: float, bins: int) -> DataFrame:
    """Equal-width bins over [lo, hi] for continuous scores."""
    return (
        view.filter(q("anomaly_score").isNotNull())
        .groupBy(F.expr(f"width_bucket(anomaly_score, {float(lo)}, {float(hi)}, {int(bins)})").alias("bin"))
        .agg(F.count(F.lit(1)).alias("tx_count"))
        .orderBy("bin")
    )


def top_suspicious_senders(view: DataFrame, n: int | None = None) -> DataFrame:
    """Senders ranked by their number of flagged transactions."""
    out = (
        view.filter(normalize_flag(q("fraud_flag")) == 1)
        .groupBy("from_address")
        .agg(F.count(F.lit(1)).alias("fraud_tx"))
        .orderBy(F.desc("fraud_tx"), "from_address")
    )
    return out.limit(n) if n else out


def daily_tx_stats(tx: DataFrame) -> DataFrame:
    """Per day: transactions, failed transactions, total value."""
    return tx.groupBy("date").agg(
        F.count(F.lit(1)).alias("tx_count"),
        F.sum(q("isError").try_cast("int")).cast("bigint").alias("failed_tx"),
        round6(F.sum(q("value"))).alias("total_value"),
    )


def top_k_suspicious(labeled: DataFrame, k: int = 10, ascending: bool = False) -> DataFrame:
    """The k most suspicious rows (highest z score; ``ascending`` for
    scores where lower is more abnormal). Plans as TakeOrderedAndProject:
    each task keeps k rows, so no global sort."""
    order = q("anomaly_score").asc_nulls_last() if ascending else q("anomaly_score").desc_nulls_last()
    return labeled.orderBy(order, q("hash")).limit(k)


def most_suspicious_hash(labeled: DataFrame) -> DataFrame:
    """Hash of the row with the highest score; of equals the largest hash."""
    return labeled.agg(F.max(F.struct("anomaly_score", "hash")).alias("top")).select("top.hash")


# --- address-level analytics ----------------------------------------------------


def address_profile(tx: DataFrame) -> DataFrame:
    """Per address: sent/received counts and amounts, mean sent value,
    distinct counterparties, active days, velocity (transactions per active
    day), mean time between sends, sender/receiver ratio."""
    secs = F.unix_seconds(q("datetime"))
    # each row once for either side, in one scan; folded by (address, other,
    # day) before the distinct counts
    sides = F.array(
        F.struct(q("from").alias("address"), q("to").alias("other"), F.lit(True).alias("sent")),
        F.struct(q("to").alias("address"), q("from").alias("other"), F.lit(False).alias("sent")),
    )
    rows = tx.select("date", q("value").alias("value"), secs.alias("secs"), F.explode(sides).alias("s"))
    rows = rows.select("s.*", "date", "value", "secs").filter(q("address").isNotNull())
    out, back = q("sent"), ~q("sent")
    folded = rows.groupBy("address", "other", "date").agg(
        F.count(F.when(out, 1)).alias("sent_n"),
        F.count(F.when(back, 1)).alias("received_n"),
        F.sum(F.when(out, q("value"))).alias("sent_sum"),
        F.count(F.when(out, q("value"))).alias("sent_values"),
        F.sum(F.when(back, q("value"))).alias("received_sum"),
        F.count(F.when(out, q("secs"))).alias("timed"),
        F.min(F.when(out, q("secs"))).alias("first"),
        F.max(F.when(out, q("secs"))).alias("last"),
    )
    prof = folded.groupBy("address").agg(
        F.sum("sent_n").alias("sent_count"),
        F.sum("received_n").alias("received_count"),
        F.sum("sent_sum").alias("sent_value"),
        F.sum("received_sum").alias("received_value"),
        F.try_divide(F.sum("sent_sum"), F.sum("sent_values")).alias("avg_sent_value"),
        F.sum("timed").alias("_timed"),
        (F.max("last") - F.min("first")).alias("_span"),
        F.count_distinct(F.when(q("sent_n") > 0, q("other"))).alias("unique_receivers"),
        F.count_distinct(F.when(q("received_n") > 0, q("other"))).alias("unique_senders"),
        F.count_distinct("other").alias("unique_counterparties"),
        F.count_distinct("date").alias("active_days"),
    )
    n_tx = q("sent_count") + q("received_count")
    return prof.select(
        "address",
        F.coalesce(q("sent_count"), F.lit(0)).cast("bigint").alias("sent_count"),
        F.coalesce(q("received_count"), F.lit(0)).cast("bigint").alias("received_count"),
        round6(F.coalesce(q("sent_value"), F.lit(0.0))).alias("sent_value"),
        round6(F.coalesce(q("received_value"), F.lit(0.0))).alias("received_value"),
        round6(q("avg_sent_value")).alias("avg_sent_value"),
        F.coalesce(q("unique_receivers"), F.lit(0)).cast("bigint").alias("unique_receivers"),
        F.coalesce(q("unique_senders"), F.lit(0)).cast("bigint").alias("unique_senders"),
        q("unique_counterparties").cast("bigint").alias("unique_counterparties"),
        q("active_days").cast("bigint").alias("active_days"),
        round6(F.try_divide(n_tx.cast("double"), q("active_days").cast("double"))).alias("tx_per_active_day"),
        round6(
            F.when(q("sent_count") > 0, F.try_divide(q("sent_count").cast("double"), q("received_count").cast("double")))
        ).alias("sender_receiver_ratio"),
        # mean gap between consecutive sends: the gaps telescope to last - first
        round6(F.try_divide(q("_span").cast("double"), (q("_timed") - 1).cast("double"))).alias(
            "avg_send_interval"
        ),
    )


def value_distribution(tx: DataFrame) -> DataFrame:
    """Per sender: count, min, max, mean and sample std of the value."""
    return tx.filter(q("from").isNotNull()).groupBy(q("from").alias("from_address")).agg(
        F.count(q("value")).alias("n_values"),
        F.min(q("value")).alias("min_value"),
        F.max(q("value")).alias("max_value"),
        round6(F.avg(q("value"))).alias("mean_value"),
        round6(F.stddev_samp(q("value"))).alias("std_value"),
    )


QUANTILES = {"q25_value": 0.25, "median_value": 0.5, "q75_value": 0.75}


def value_quantiles(tx: DataFrame, probs: dict[str, float] | None = None, accuracy: int = 10_000) -> DataFrame:
    """Per sender, exact quantiles of the value: of its n values, the one at
    rank ceil(p * n).

    One aggregate gives each sender's count and a bounded, mergeable sketch.
    Up to ``accuracy`` rows the sketch is exact. For larger senders it gives two
    values that bracket each wanted rank; only the values inside the brackets,
    about 4 / ``accuracy`` of the rows, are counted one by one, and what lies
    below is a number. Rows meet the brackets in a join of two tables, so a
    sender with a large share of all rows is split over tasks.
    """
    probs = probs or QUANTILES
    wanted = list(probs.values())
    eps = 2.0 / accuracy
    points = wanted + [max(0.0, p - eps) for p in wanted] + [min(1.0, p + eps) for p in wanted]
    rows = tx.filter(q("from").isNotNull()).select(q("from").alias("k"), q("value").alias("v"))
    groups = rows.groupBy("k").agg(F.count("v").alias("n"), F.percentile_approx("v", points, accuracy).alias("s"))
    groups = materialize(groups, "value_sketches")
    small = groups.filter(q("n") <= accuracy).select(q("k").alias("from_address"), *[q("s")[i].alias(c) for i, c in enumerate(probs)])
    if groups.filter(q("n") > accuracy).head() is None:
        return small
    m = len(wanted)
    ranks = F.explode(
        F.array(*[F.struct(F.lit(i).alias("i"), F.ceil(F.lit(p) * q("n")).alias("r"), q("s")[m + i].alias("lo"), q("s")[2 * m + i].alias("hi")) for i, p in enumerate(wanted)])
    )
    brackets = materialize(groups.filter(q("n") > accuracy).select("k", ranks.alias("b")).select("k", "b.*"), "brackets")
    met = rows.filter(q("v").isNotNull()).join(brackets, "k").filter(q("v") <= q("hi"))
    inside = F.when(q("v") >= q("lo"), q("v"))  # NULL: below the bracket, counted only
    counted = materialize(met.groupBy("k", "i", inside.alias("v")).agg(F.count(F.lit(1)).alias("c"), F.first("r").alias("r")), "bracketed")
    upto = F.sum("c").over(Window.partitionBy("k", "i").orderBy(F.asc_nulls_first("v")))
    found = counted.withColumn("upto", upto).filter(q("v").isNotNull() & (q("upto") >= q("r"))).groupBy("k", "i").agg(F.min("v").alias("v"))
    large = found.groupBy(q("k").alias("from_address")).agg(*[F.max(F.when(q("i") == i, q("v"))).alias(c) for i, c in enumerate(probs)])
    return small.unionByName(large)


# --- distinct counts that can be merged ------------------------------------------

#: log2 of the registers of a sketch: relative standard error 1.04 / sqrt(4096).
SKETCH_BITS = 12
SKETCH_ERROR = 0.0163


def counterparty_sketches(tx: DataFrame) -> DataFrame:
    """Per address and day a sketch of its counterparties (about 4 KB at most,
    whatever their number); stored by date, they serve any period."""
    sides = F.array(
        F.struct(q("from").alias("address"), q("to").alias("other")),
        F.struct(q("to").alias("address"), q("from").alias("other")),
    )
    rows = tx.select("date", F.explode(sides).alias("s")).select("date", "s.*").filter(q("address").isNotNull() & q("other").isNotNull())
    return rows.groupBy("address", "date").agg(F.hll_sketch_agg("other", F.lit(SKETCH_BITS)).alias("sketch"))


def merged_counterparties(sketches: DataFrame, date_from: str | None = None, date_to: str | None = None) -> DataFrame:
    """Per address the estimated number of distinct counterparties of a
    period, from the sketches of its days alone."""
    rows = sketches
    if date_from is not None:
        rows = rows.filter(q("date") >= F.lit(date_from).cast("date"))
    if date_to is not None:
        rows = rows.filter(q("date") <= F.lit(date_to).cast("date"))
    return rows.groupBy("address").agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("counterparties"))


def standardized_features(df: DataFrame, features: list[str]) -> DataFrame:
    """Mean-imputed then standardised features (z against global stats). The
    columns are written once; statistics and rows read the written table."""
    df = materialize(df.select(q("hash"), *[q(c) for c in features]), "standardize")
    stats_exprs = []
    for c in features:
        x = q(c).cast("double")
        stats_exprs += [F.avg(x).alias(f"{c}__m"), F.stddev_samp(x).alias(f"{c}__s")]
    stats = df.agg(*stats_exprs)  # one row
    out = df.crossJoin(F.broadcast(stats))
    cols = [q("hash")]
    for c in features:
        filled = F.coalesce(q(c).cast("double"), q(f"{c}__m"))
        cols.append(round6(F.try_divide(filled - q(f"{c}__m"), q(f"{c}__s"))).alias(f"{c}_std"))
    return out.select(*cols)


def prf_metrics(labeled: DataFrame, truth: Column, predicted: Column) -> DataFrame:
    """Confusion counts, precision, recall and F1 in one aggregate."""
    t = F.coalesce(truth.cast("boolean"), F.lit(False))
    p = F.coalesce(predicted.cast("boolean"), F.lit(False))
    cm = labeled.agg(
        F.count(F.when(t & p, 1)).alias("tp"),
        F.count(F.when(~t & p, 1)).alias("fp"),
        F.count(F.when(t & ~p, 1)).alias("fn"),
        F.count(F.when(~t & ~p, 1)).alias("tn"),
    )
    prec = F.try_divide(q("tp").cast("double"), (q("tp") + q("fp")).cast("double"))
    rec = F.try_divide(q("tp").cast("double"), (q("tp") + q("fn")).cast("double"))
    cm = cm.withColumns({"precision": prec, "recall": rec})
    f1 = F.try_divide(2 * q("precision") * q("recall"), q("precision") + q("recall"))
    return cm.select(
        "tp", "fp", "fn", "tn",
        round6(q("precision")).alias("precision"),
        round6(q("recall")).alias("recall"),
        round6(f1).alias("f1"),
    )


def address_risk(labeled: DataFrame) -> DataFrame:
    """Per sender: transactions, flagged transactions, max and mean score."""
    return labeled.filter(q("from").isNotNull()).groupBy(q("from").alias("from_address")).agg(
        F.count(F.lit(1)).alias("tx_count"),
        F.count(F.when(q("pred_label") == ANOMALY_LABEL, 1)).alias("flagged_tx"),
        round6(F.max(q("anomaly_score"))).alias("max_score"),
        round6(F.avg(q("anomaly_score"))).alias("avg_score"),
    )


def ranking_metrics(scored: DataFrame, score: str, label: str) -> DataFrame:
    """One row: rows, positives, area under the ROC curve and average precision
    of a score (higher: positive likelier) against a 0/1 label; rows without
    either are left out. Equal scores count as one step of the curves.

    Scores are counted, range-partitioned from the highest on, and added up
    within each partition behind the sums of those before it, one row each.
    """
    rows = scored.select(q(score).cast("double").alias("s"), q(label).cast("int").alias("y")).filter(q("s").isNotNull() & q("y").isNotNull())
    steps = rows.groupBy("s").agg(F.sum("y").alias("p"), F.count(F.lit(1)).alias("c"))
    steps = materialize(steps.repartitionByRange(F.desc("s")).withColumn("part", F.spark_partition_id()), "steps")
    sums = steps.groupBy("part").agg(F.sum("p").alias("part_p"), F.sum("c").alias("part_c"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row per partition
    offsets = sums.select("part", *[F.coalesce(F.sum(f"part_{x}").over(before), F.lit(0)).alias(f"{x}_before") for x in "pc"])
    total = sums.agg(F.sum("part_p").alias("all_p"), F.sum("part_c").alias("all_c"))
    upto = Window.partitionBy("part").orderBy(F.desc("s"))
    curve = steps.withColumns({f"{x}_upto": F.sum(x).over(upto) for x in "pc"}).join(F.broadcast(offsets), "part")
    hits, seen = q("p_before") + q("p_upto"), q("c_before") + q("c_upto")
    negatives = (q("c") - q("p")).cast("double")
    out = curve.agg(
        F.sum(negatives * (hits - q("p") / F.lit(2.0))).alias("area"),
        F.sum(q("p") * (hits.cast("double") / seen)).alias("precisions"),
    ).crossJoin(F.broadcast(total))
    positives = q("all_p").cast("double")
    return out.select(
        F.coalesce(q("all_c"), F.lit(0)).alias("n_rows"),
        F.coalesce(q("all_p"), F.lit(0)).alias("n_positive"),
        round6(F.try_divide(q("area"), positives * (q("all_c") - q("all_p")))).alias("roc_auc"),
        round6(F.try_divide(q("precisions"), positives)).alias("average_precision"),
    )

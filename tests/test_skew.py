"""A sender, or one hour of it, holding a third of all rows: the clustered plan
spreads it over tasks, the plain window plan cannot; both give the same table."""

import time

from pyspark.sql import functions as F

from ledgerlens.operators import features as FT
from ledgerlens.operators.prepare import prepare_transactions
from ledgerlens.operators.temporal import add_temporal_features
from ledgerlens.plans import queries as Q
from conftest import SF001
from helpers import T0


def skewed_tx(spark):
    tx = Q.tx(spark, SF001)
    hot = (F.col("hash").cast("long") % 3) == 0
    return tx.withColumn("from", F.when(hot, F.lit("hot")).otherwise(F.col("from")))


def max_partition_share(df) -> float:
    """Largest partition's share of the rows, measured on the full plan (an
    aggregate over the partition id alone would let column pruning drop the
    windows)."""
    sizes = df.rdd.glom().map(len).collect()
    return max(sizes) / sum(sizes)


def busy_hour(spark, n=30_000):
    """A third of all rows in one hour of one sender."""
    rows = spark.range(n)
    i, hot = F.col("id"), F.col("id") % 3 == 0
    ts = F.lit(T0) + F.when(hot, 3 * 86400 + 7200 + i * 3599 / n).otherwise(F.pmod(F.xxhash64(i), F.lit(30 * 86400)))
    raw = rows.select(
        i.cast("string").alias("hash"),
        F.when(hot, "hot").otherwise(F.concat(F.lit("a"), i % 50)).alias("from"),
        F.concat(F.lit("r"), i % 40).alias("to"),
        F.floor(ts).cast("string").alias("timeStamp"),
        (1 + i % 17).cast("string").alias("value"),
        (2 + i % 5).cast("string").alias("gasPrice"),
        (i % 2).cast("string").alias("isError"),
        F.lit("").alias("contractAddress"),
        F.lit("m").alias("methodId"),
        F.lit("f(x)").alias("functionName"),
        (i / 10).cast("long").cast("string").alias("blockNumber"),
        (i % 10).cast("string").alias("transactionIndex"),
    )
    return add_temporal_features(prepare_transactions(raw))


def clustered_side(tx, busy):
    base = FT.with_value_logs(tx).withColumn("ts", F.unix_seconds(F.col("datetime")))
    days = FT.materialize(FT.day_table(FT.activity_days(base)), "days")
    first = F.unix_seconds(F.col("week_start").cast("timestamp"))
    weeks = days.filter(F.col("week_rows") > busy).select("side", "k", FT._week(first).alias("_week")).distinct()
    weeks = weeks.union(weeks.withColumn("_week", F.col("_week") + 1)).distinct()
    layout = FT._Layout(base, days, "from", weeks, busy, rolling=True)
    return FT._cluster_side(base, days, "from", layout, rolling=True).select("hash", "prev_datetime_from", "rolling_tx_count")


def test_a_busy_hour_is_spread_over_tasks(spark):
    prev = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        tx = busy_hour(spark)
        base = FT.with_value_logs(tx).withColumn("ts", F.unix_seconds(F.col("datetime")))
        by_sender = FT._window_side(base, "from").select("hash", "prev_datetime_from", "rolling_tx_count")
        assert max_partition_share(by_sender) > 1 / 3
        assert max_partition_share(clustered_side(tx, busy=500)) < 0.2
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", prev)


def test_a_busy_hour_gives_the_same_table(spark):
    tx = busy_hour(spark, 6000)
    cols = ["hash", "rolling_tx_count", "interval_from", "daily_tx_count_from", "total_tx_count_to", "value_spike"]
    floats = ["rolling_value_mean", "rolling_value_std", "rolling_gasPrice_std", "daily_avg_interval_from"]
    a, b = FT.build_features(tx, "window"), FT.build_features(tx, busy_rows=300)
    assert a.select(*cols).exceptAll(b.select(*cols)).count() == 0
    same = a.select("hash", *floats).join(b.select("hash", *[F.col(c).alias(f"{c}_b") for c in floats]), "hash")
    apart = [F.max(F.abs(F.col(c) - F.col(f"{c}_b"))) for c in floats]
    none = [F.count(F.when(F.col(c).isNull() != F.col(f"{c}_b").isNull(), 1)) for c in floats]
    got = same.agg(F.count("hash"), *apart, *none).first()
    assert got[0] == 6000 and all(x < 1e-9 for x in got[1:5]) and not any(got[5:])


def seconds(f):
    t = time.perf_counter()
    f().write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t


def test_time_is_linear_in_the_rows_of_one_sender(spark):
    def one_sender(n):
        tx = busy_hour(spark, n).withColumn("from", F.lit("one")).withColumn("ts", F.col("datetime"))
        return lambda: FT.build_features(tx.drop("ts"))

    small, large = one_sender(5000), one_sender(40_000)
    seconds(small)
    assert min(seconds(large) for _ in range(2)) < 8 * min(seconds(small) for _ in range(2))


def test_results_match(spark):
    tx = skewed_tx(spark)
    cols = ["hash", "rolling_tx_count", "interval_from", "daily_tx_count_from", "total_tx_count_from", "value_spike"]
    a = FT.build_features(tx, "window").select(*cols)
    b = FT.build_features(tx).select(*cols)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0

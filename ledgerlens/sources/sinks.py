"""Sinks: Parquet datasets, CSV reports, run metadata, JDBC and the raw
landing zone. All writes are distributed (no ``toPandas``)."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlens.functions.scalar import landing_key
from ledgerlens.schema import ANOMALY_LABEL, MODEL_TYPE, THRESHOLD_PERCENTILE


def write_partitioned(
    df: DataFrame,
    path: str,
    partition_col: str = "date",
    mode: str = "overwrite",
    cluster: bool = True,
    order_col: str | None = "hash",
    max_records_per_file: int | None = 5_000_000,
    tasks_per_value: int = 8,
) -> None:
    """Parquet dataset partitioned by ``partition_col`` (Hive layout).

    ``cluster`` hashes the rows by (partition value, ``order_col`` modulo
    ``tasks_per_value``) before writing: each task then writes to a few date
    folders only, and a large day is split over several tasks instead of landing
    in one. A hash needs no pass over the input to sample it. Overwrite replaces
    only the partitions present in ``df`` (dynamic mode).
    """
    out = df
    if cluster and partition_col in df.columns:
        keys = [F.col(f"`{partition_col}`")]
        if order_col and order_col in df.columns:
            keys.append(F.pmod(F.xxhash64(F.col(f"`{order_col}`")), F.lit(tasks_per_value)))
        out = df.repartition(*keys)
    writer = out.write.mode(mode).option("partitionOverwriteMode", "dynamic")
    if max_records_per_file:
        writer = writer.option("maxRecordsPerFile", str(max_records_per_file))
    if partition_col in df.columns:
        writer = writer.partitionBy(partition_col)
    writer.parquet(path)


def write_predictions(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Scored rows as Parquet, partitioned by date only when it exists."""
    write_partitioned(df, path, partition_col="date", mode=mode, cluster="date" in df.columns)


def write_search_table(df: DataFrame, path: str, keys: tuple[str, ...] = ("from", "to"), mode: str = "overwrite", parts: int = 8, expected_keys: int = 1_000_000) -> None:
    """Scored rows for searches by address: date folders, files that hold the
    rows of some senders in order, and Parquet bloom filters on the addresses.
    A search reads the folders of its dates and skips the row groups whose
    statistics or filters rule its addresses out. Files are dealt by (date, part
    of the senders) in a way that lets adaptive execution split a busy one."""
    first = F.col(f"`{keys[0]}`")
    dealt = df.withColumn("_part", F.pmod(F.xxhash64(first), F.lit(parts))).hint("rebalance", "date", "_part")
    writer = dealt.sortWithinPartitions("date", first).drop("_part").write.mode(mode).option("partitionOverwriteMode", "dynamic")
    for key in keys:
        writer = writer.option(f"parquet.bloom.filter.enabled#{key}", "true").option(f"parquet.bloom.filter.expected.ndv#{key}", str(expected_keys))
    writer.partitionBy("date").parquet(path)


def write_bucketed(df: DataFrame, name: str, path: str, key: str = "from", buckets: int = 64) -> DataFrame:
    """The rows as an external table bucketed and sorted by ``key``: reports
    grouped by it need no exchange. A key with a large share of all rows makes a
    large bucket, so this suits tables that are read by address again and again.
    Returns the table; its entry in the catalog is dropped, the files stay."""
    spark = df.sparkSession
    df.repartition(buckets, F.col(f"`{key}`")).write.bucketBy(buckets, key).sortBy(key).option("path", path).format("parquet").saveAsTable(name)
    table = spark.table(name)
    spark.sql(f"DROP TABLE {name}")
    return table


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """CSV with a header line; vectors/arrays are not CSV types, so complex
    columns are rendered as JSON strings."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType)):
            cols.append(F.to_json(F.col(f"`{f.name}`")).alias(f.name))
        else:
            cols.append(F.col(f"`{f.name}`"))
    df.select(*cols).write.mode(mode).option("header", "true").csv(path)


def write_anomalies_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Only rows labelled anomalous; an empty file set if there is no label."""
    if "pred_label" in df.columns:
        out = df.filter(F.col("pred_label") == ANOMALY_LABEL)
    else:
        out = df.limit(0)
    write_csv(out, path, mode)


def run_metadata(
    spark: SparkSession,
    feature_names: list[str],
    run_ts: _dt.datetime | None = None,
    model_type: str = MODEL_TYPE,
    threshold_percentile: float = THRESHOLD_PERCENTILE,
) -> DataFrame:
    """One-row frame describing a scoring run."""
    ts = (run_ts or _dt.datetime.now(_dt.timezone.utc)).strftime("%Y-%m-%dT%H-%M-%S")
    schema = T.StructType(
        [
            T.StructField("feature_names", T.ArrayType(T.StringType()), False),
            T.StructField("num_features", T.IntegerType(), False),
            T.StructField("model_type", T.StringType(), False),
            T.StructField("threshold_percentile", T.DoubleType(), False),
            T.StructField("timestamp", T.StringType(), False),
        ]
    )
    return spark.createDataFrame(
        [(list(feature_names), len(feature_names), model_type, float(threshold_percentile), ts)],
        schema,
    )


def write_run_metadata(meta: DataFrame, path: str, mode: str = "overwrite") -> None:
    meta.coalesce(1).write.mode(mode).json(path)


def write_jdbc(
    df: DataFrame,
    url: str,
    table: str,
    properties: dict[str, str],
    mode: str = "append",
    batch_size: int = 10_000,
    num_partitions: int | None = None,
) -> None:
    """Append rows to a relational table; ``num_partitions`` bounds the number
    of concurrent connections."""
    out = df.coalesce(num_partitions) if num_partitions else df
    props = {"batchsize": str(batch_size), **properties}
    out.write.mode(mode).jdbc(url=url, table=table, properties=props)


def landing_frame(payloads: DataFrame, address_col: str, run_ts_col: str) -> DataFrame:
    """Adds the landing key and the UTC year/month/day partition values."""
    ts = F.col(run_ts_col)
    return payloads.withColumns(
        {
            "landing_key": landing_key(F.col(address_col), ts),
            "year": F.date_format(ts, "yyyy"),
            "month": F.date_format(ts, "MM"),
            "day": F.date_format(ts, "dd"),
        }
    )


def write_landing(payloads: DataFrame, path: str, mode: str = "append") -> None:
    """Raw payload JSON laid out by year/month/day folders."""
    cols = ["status", "message", "result", "year", "month", "day"]
    payloads.select(*cols).write.mode(mode).partitionBy("year", "month", "day").json(path)

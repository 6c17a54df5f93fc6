"""Table sources: feature/prediction datasets, catalog tables, JDBC and
in-memory records."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlens.schema import RAW_TX_STRUCT


def read_partitioned(
    spark: SparkSession,
    path: str,
    date_from: str | None = None,
    date_to: str | None = None,
    columns: list[str] | None = None,
    date_col: str = "date",
) -> DataFrame:
    """Scan a Parquet dataset laid out as ``<date_col>=YYYY-MM-DD`` folders.

    The date bounds become partition filters (only matching folders are
    listed and read) and ``columns`` becomes the read schema.
    """
    df = spark.read.option("basePath", path).parquet(path)
    if date_from is not None:
        df = df.filter(F.col(date_col) >= F.lit(date_from).cast("date"))
    if date_to is not None:
        df = df.filter(F.col(date_col) <= F.lit(date_to).cast("date"))
    if columns:
        df = df.select(*[F.col(f"`{c}`") for c in columns])
    return df


def register_parquet_table(
    spark: SparkSession, name: str, path: str, partition_cols: list[str] | None = None
) -> DataFrame:
    """External table over Parquet files plus partition discovery (what a
    crawler does): CREATE TABLE ... USING PARQUET LOCATION, then recover
    partitions."""
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    part = ""
    if partition_cols:
        schema = spark.read.parquet(path).schema
        cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
        part = f"({cols}) "
        spark.sql(
            f"CREATE TABLE {name} {part}USING PARQUET "
            f"PARTITIONED BY ({', '.join(partition_cols)}) LOCATION '{path}'"
        )
        spark.catalog.recoverPartitions(name)
    else:
        spark.sql(f"CREATE TABLE {name} USING PARQUET LOCATION '{path}'")
    return spark.table(name)


def read_jdbc_table(
    spark: SparkSession,
    url: str,
    table: str,
    properties: dict[str, str],
    columns: list[str] | None = None,
    partition_column: str | None = None,
    lower_bound: int | None = None,
    upper_bound: int | None = None,
    num_partitions: int = 8,
) -> DataFrame:
    """Parallel JDBC scan. Column selection and filters applied to the result
    are pushed into the remote query by Spark; ``partition_column`` splits the
    read into ``num_partitions`` range queries."""
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table)
    for k, v in properties.items():
        reader = reader.option(k, v)
    if partition_column is not None:
        reader = (
            reader.option("partitionColumn", partition_column)
            .option("lowerBound", str(lower_bound))
            .option("upperBound", str(upper_bound))
            .option("numPartitions", str(num_partitions))
        )
    df = reader.load()
    if columns:
        df = df.select(*columns)
    return df


def tx_from_records(spark: SparkSession, records: list[dict]) -> DataFrame:
    """Raw transaction rows from in-memory API records (explicit schema: the
    missing fields become NULL, values stay strings)."""
    names = RAW_TX_STRUCT.fieldNames()
    rows = [tuple(None if r.get(n) is None else str(r.get(n)) for n in names) for r in records]
    return spark.createDataFrame(rows, schema=T.StructType(RAW_TX_STRUCT.fields))

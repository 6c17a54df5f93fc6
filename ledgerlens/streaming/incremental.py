"""Incremental pick-up of newly landed raw payloads.

A file-source stream over the landing folder with the explicit payload
schema; ``trigger(availableNow=True)`` processes whatever landed since the
last run (the checkpoint remembers which files were seen) and stops, which
is what a daily scheduled batch needs. Each micro-batch is flattened, prepared
and written to a folder of its own, ``batch=<stream>-<epoch>/date=<date>``, for
rows and for rejects alike. A batch that is tried again replaces what its first
try left, so each payload counts exactly once. Hashes that other batches have
stored are skipped (a re-fetched address returns its old transactions too); only
the date folders of the batch are read for that. ``refresh`` brings the feature
table up to date from there.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlens.operators.prepare import prepare_transactions, q
from ledgerlens.session import ensure_session, path_exists
from ledgerlens.sources.raw_json import CORRUPT, flatten_payloads, payload_schema, split_payloads

BATCH = "batch"


def read_batches(spark: SparkSession, table_path: str, schema: T.StructType) -> DataFrame:
    """The stored rows of all batches, with the name of the batch."""
    return spark.read.schema(T.StructType([*schema.fields, T.StructField(BATCH, T.StringType())])).parquet(table_path)


def batch_writer(table_path: str, rejects_path: str | None, stream: str) -> Callable[[DataFrame, int], None]:
    """The function that stores one micro-batch; a second call with the same
    epoch replaces what the first one wrote."""

    def write_batch(batch: DataFrame, epoch_id: int) -> None:
        spark = batch.sparkSession
        name = f"{stream}-{epoch_id}"
        valid, rejects = split_payloads(batch)
        if rejects_path:
            rejects.write.mode("overwrite").json(f"{rejects_path}/{BATCH}={name}")
        day = F.to_date(F.timestamp_seconds(q("timeStamp").cast("long")))
        rows = prepare_transactions(flatten_payloads(valid)).withColumn("date", day)
        # a row without a hash is a repeat only if it is equal as a whole
        named = rows.filter(q("hash").isNotNull()).dropDuplicates(["hash"])
        rows = named.unionByName(rows.filter(q("hash").isNull()).distinct())
        if path_exists(spark, table_path):
            # a transaction has one date: only the batch's date folders are read
            days = rows.select(q("date").alias("_day")).distinct()
            stored = read_batches(spark, table_path, rows.schema).filter(q(BATCH) != name).drop(BATCH)
            stored = stored.join(days, stored["date"].eqNullSafe(days["_day"]), "left_semi")
            # one key for both kinds: the hash, or all fields of a row without
            key = F.coalesce(q("hash"), F.sha2(F.to_json(F.struct(*[q(c) for c in sorted(rows.columns)])), 256))
            old = stored.select(key.alias("_old"))
            rows = rows.withColumn("_key", key)
            rows = rows.join(old, rows["_key"] == old["_old"], "left_anti").drop("_key")
        rows.write.mode("overwrite").partitionBy("date").parquet(f"{table_path}/{BATCH}={name}")

    return write_batch


def ingest_new_payloads(
    spark: SparkSession,
    landing_path: str,
    table_path: str,
    checkpoint_path: str,
    max_files_per_trigger: int | None = None,
    rejects_path: str | None = None,
    multi_line: bool = False,
) -> None:
    """Process every payload landed since the previous call, then return. The
    table is partitioned by batch and date; rejected payloads, corrupt text
    included, go to ``rejects_path`` by batch. Batches are named by the
    checkpoint folder, so several streams can fill one table."""
    ensure_session(spark)
    reader = (
        spark.readStream.schema(payload_schema())
        .option("columnNameOfCorruptRecord", CORRUPT)
        .option("multiLine", "true" if multi_line else "false")
        .option("recursiveFileLookup", "true")
        .option("mode", "PERMISSIVE")
    )
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    stream = hashlib.sha256(checkpoint_path.encode()).hexdigest()[:8]
    query = (
        reader.json(landing_path)
        .writeStream.foreachBatch(batch_writer(table_path, rejects_path, stream))
        .option("checkpointLocation", checkpoint_path)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()

"""Raw JSON payloads: scan, validity split and flattening.

Payloads land as one JSON object per file:
``{"status": "1", "message": "OK", "result": [ {tx fields...}, ... ]}``.
The scan uses an explicit schema, so an error payload whose ``result`` is a
text message yields a NULL ``result`` instead of changing the schema.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ledgerlens.schema import RAW_PAYLOAD_SCHEMA

OK_STATUS = "1"


CORRUPT = "_corrupt_record"


def payload_schema() -> StructType:
    """The payload schema with a column for text that does not parse."""
    return StructType([*RAW_PAYLOAD_SCHEMA.fields, StructField(CORRUPT, StringType())])


def read_raw_payloads(
    spark: SparkSession, path: str, multi_line: bool = False, with_source: bool = True
) -> DataFrame:
    """Scan every payload under ``path`` (recursively, any partition layout).
    Text that is not JSON is kept in ``_corrupt_record``, so it shows among the
    rejects. ``multi_line`` reads payloads that span several lines."""
    reader = (
        spark.read.schema(payload_schema())
        .option("columnNameOfCorruptRecord", CORRUPT)
        .option("recursiveFileLookup", "true")
        .option("multiLine", "true" if multi_line else "false")
        .option("mode", "PERMISSIVE")
    )
    df = reader.json(path)
    if with_source:
        df = df.withColumn("source_file", F.input_file_name())
    return df


def split_payloads(payloads: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid, rejects): a valid payload has status "1" and an array result."""
    ok = (F.col("status") == OK_STATUS) & F.col("result").isNotNull()
    valid = payloads.filter(ok)
    rejects = payloads.filter(~F.coalesce(ok, F.lit(False)))
    return valid, rejects


def flatten_payloads(df: DataFrame) -> DataFrame:
    """One row per transaction. A frame without ``result`` is already flat
    and passes through; NULL or empty arrays yield no rows."""
    if "result" not in df.columns:
        return df
    return df.select(F.explode(F.col("result")).alias("tx")).select("tx.*")


def payloads_from_tx(raw_tx: DataFrame, group_cols: list[str], max_rows: int = 10_000) -> DataFrame:
    """Pack raw transaction rows into API-shaped payloads.

    A group (e.g. one address and hour: one fetch) is split into
    ``ceil(rows / max_rows)`` pages by a hash of the row, like
    the API's paged responses, so no payload -- and no task building one --
    holds an unbounded group. Group sizes come from a partial aggregate and are
    joined null-safe, so rows with a NULL address or time stay; a group with a
    large share of all rows can be split by adaptive execution.
    Every column except helper columns named with a leading underscore goes
    into the payload rows.
    """
    fields = [c for c in raw_tx.columns if not c.startswith("_")]
    sizes = raw_tx.groupBy(*group_cols).agg(F.count(F.lit(1)).alias("_n"))
    pages = F.greatest(F.lit(1), F.ceil(F.col("_n") / F.lit(max_rows)))
    sizes = sizes.select(*[F.col(c).alias(f"_g{i}") for i, c in enumerate(group_cols)], pages.alias("_pages"))
    same = reduce(and_, [raw_tx[c].eqNullSafe(sizes[f"_g{i}"]) for i, c in enumerate(group_cols)])
    # rows without a hash are spread by all their fields
    spread = F.xxhash64(*[F.col(f"`{c}`") for c in fields])
    paged = raw_tx.join(sizes, same).withColumn("_page", F.pmod(spread, F.col("_pages")))
    return paged.groupBy(*group_cols, "_page").agg(
        F.lit("1").alias("status"),
        F.lit("OK").alias("message"),
        F.collect_list(F.struct(*[F.col(f"`{c}`") for c in fields])).alias("result"),
    )

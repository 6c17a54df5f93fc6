"""Training-data pipeline: documents in, encoded documents out.

``STAGES`` are applied in order; each one's result is written as Parquet under
the shared checkpoint folder and read again as the next one's documents, so a
lost executor costs at most the stage at hand. All but the last return the
columns of documents.

1. ``quality``: documents the classifier scores under 0.7 go.
2. ``exact_dedup``: of texts equal but for the case of A-Z, the row with the
   largest id stays.
3. ``near_dedup``: of documents linked by a similarity of 0.8 or more over
   five-word shingles, the one with the smallest id stays.
4. ``decontaminate``: documents that hold a benchmark item go.
5. ``encode``: piece ids of each document, the end id last, and digests of the
   ids and of the text they decode to.

SQL can express neither the classifier's training nor the encoder, so there is
no SQL twin; tests compare each stage with a brute-force version.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.llm import decontaminate, exact_dedup, near_dedup, piece_codec, quality
from ledgerlens.llm.common import load, written
from ledgerlens.llm.queries import QUALITY_SCORE, piece_model, quality_model

#: Percent of Jaccard similarity from which documents are near copies.
NEAR_PERCENT = 80


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.drop_low_quality(docs, quality_model(docs, load(spark, sf_dir, "labels")), QUALITY_SCORE)


def exact_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.drop_exact_copies(docs)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dedup.drop_near_duplicates(docs, percent=NEAR_PERCENT)


def decontaminate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.drop_contaminated(docs, load(spark, sf_dir, "benchmark"))


def encode_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    coded = piece_codec.encode_and_decode(docs, piece_model())
    return coded.select(
        "doc_id",
        "ids",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded"), 256).alias("decoded_sha256"),
    )


STAGES = [
    ("quality", quality_stage),
    ("exact_dedup", exact_dedup_stage),
    ("near_dedup", near_dedup_stage),
    ("decontaminate", decontaminate_stage),
    ("encode", encode_stage),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs

"""Supervised scoring: a random forest trained on labelled transactions.

The labels are the caller's (confirmed cases, say), a table of its own that is
joined by transaction hash. Rows to train on are told by time (train on the
past, test on what came later) or by a deterministic hash split; neither depends
on partitioning or on a random seed per run.
"""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import Imputer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.operators.prepare import q


def hash_split(key: Column, train_pct: int = 80, seed: int = 42) -> Column:
    """True for rows in the training share (stable per key)."""
    return F.pmod(F.xxhash64(key.cast("string"), F.lit(seed)), F.lit(100)) < F.lit(train_pct)


def with_labels(rows: DataFrame, labels: DataFrame, key: str = "hash") -> DataFrame:
    """Adds ``label`` (double) from ``labels`` (hash, label); NULL where the
    caller knows nothing. A hash that is labelled twice must agree, else it has
    no label."""
    known = labels.select(q(key).cast("string").alias("_key"), q("label").cast("double").alias("label")).groupBy("_key").agg(
        F.min("label").alias("_low"), F.max("label").alias("_high")
    )
    out = rows.drop("label").join(known, rows[key] == known["_key"], "left")
    return out.withColumn("label", F.when(q("_low") == q("_high"), q("_low"))).drop("_key", "_low", "_high")


def time_split(when: Column, cutoff: str) -> Column:
    """True for rows before ``cutoff``; rows without a time are not trained on."""
    return F.coalesce(when < F.lit(cutoff).cast("timestamp"), F.lit(False))


def fit_classifier(
    df: DataFrame,
    features: list[str],
    label: str = "label",
    num_trees: int = 20,
    max_depth: int = 5,
    seed: int = 42,
) -> PipelineModel:
    """Mean imputation -> feature vector -> random forest."""
    dcols = [f"{c}__d" for c in features]
    prepared = df.withColumns({d: q(c).cast("double") for c, d in zip(features, dcols)})
    imp = Imputer(inputCols=dcols, outputCols=[f"{d}i" for d in dcols], strategy="mean")
    vec = VectorAssembler(inputCols=[f"{d}i" for d in dcols], outputCol="_features", handleInvalid="keep")
    rf = RandomForestClassifier(
        featuresCol="_features", labelCol=label, numTrees=num_trees, maxDepth=max_depth, seed=seed,
        probabilityCol="_prob", predictionCol="_pred", rawPredictionCol="_raw",
    )
    return Pipeline(stages=[imp, vec, rf]).fit(prepared)


def classifier_scores(df: DataFrame, model: PipelineModel, features: list[str]) -> DataFrame:
    """Adds ``risk_prob`` (probability of class 1) and ``risk_pred``."""
    dcols = [f"{c}__d" for c in features]
    prepared = df.withColumns({d: q(c).cast("double") for c, d in zip(features, dcols)})
    out = model.transform(prepared)
    out = out.withColumn("risk_prob", vector_to_array(q("_prob"))[1]).withColumn(
        "risk_pred", q("_pred").cast("int")
    )
    drop = dcols + [f"{d}i" for d in dcols] + ["_features", "_prob", "_pred", "_raw"]
    return out.drop(*drop)

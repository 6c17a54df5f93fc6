"""The z-score model as a thing of its own: fitted once, saved, applied to rows
it has not seen.

A saved model is a folder ``version=<n>`` with one Parquet row per feature (mean,
deviation) and the settings that hold for all of them. Versions are never
overwritten, so scores can be traced to the model that made them.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from ledgerlens.operators.prepare import available_features
from ledgerlens.operators.scoring import add_anomaly_score, add_labels, feature_stats, score_threshold
from ledgerlens.schema import FEATURE_COLS, THRESHOLD_PERCENTILE
from ledgerlens.session import path_exists

TABLE = "feature string, position int, mean double, std double, threshold double, percentile double, null_policy string"


@dataclass(frozen=True)
class ZScoreModel:
    """Global statistics of the features and the score from which a row is
    labelled anomalous."""

    features: list[str]
    stats: dict[str, float | None] = field(repr=False)
    threshold: float | None
    percentile: float = THRESHOLD_PERCENTILE
    null_policy: str = "propagate"

    @classmethod
    def fit(cls, rows: DataFrame, features: list[str] | None = None, percentile: float = THRESHOLD_PERCENTILE, null_policy: str = "propagate") -> ZScoreModel:
        """Statistics and threshold of ``rows``, a written feature table."""
        used = available_features(rows, features or FEATURE_COLS)
        stats = feature_stats(rows, used).first().asDict() if used else {}
        scored, _ = add_anomaly_score(rows, used, null_policy, stats)
        return cls(used, stats, score_threshold(scored, percentile), percentile, null_policy)

    def apply(self, rows: DataFrame) -> DataFrame:
        """``rows`` with ``<f>_z``, ``anomaly_score`` and ``pred_label``. All
        features of the model must be there."""
        missing = [c for c in self.features if c not in rows.columns]
        if missing:
            raise ValueError(f"the model needs columns {missing}")
        scored, _ = add_anomaly_score(rows, self.features, self.null_policy, self.stats)
        return add_labels(scored, self.threshold)

    def save(self, spark: SparkSession, path: str) -> int:
        """Write the model as the next version; returns its number."""
        version = 1 + max(versions(spark, path), default=0)
        rows = [
            (c, i, self.stats[f"{c}_mean"], self.stats[f"{c}_std"], self.threshold, self.percentile, self.null_policy)
            for i, c in enumerate(self.features)
        ]
        spark.createDataFrame(rows, TABLE).coalesce(1).write.mode("errorifexists").parquet(f"{path}/version={version}")
        return version

    @classmethod
    def load(cls, spark: SparkSession, path: str, version: int | None = None) -> ZScoreModel:
        """A version of the model, by default the latest."""
        version = version or max(versions(spark, path))
        rows = spark.read.schema(TABLE).parquet(f"{path}/version={version}").orderBy("position").collect()  # a row per feature
        stats = {f"{r['feature']}_{k}": r[k] for r in rows for k in ("mean", "std")}
        return cls([r["feature"] for r in rows], stats, rows[0]["threshold"], rows[0]["percentile"], rows[0]["null_policy"])


def versions(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the saved versions."""
    if not path_exists(spark, path):
        return []
    table = spark.read.schema(TABLE + ", version int").parquet(path)
    return sorted(r[0] for r in table.select("version").distinct().collect())

"""Isolation forest as a Spark job, over sparse rows.

A row has numeric features and categorical ones. A category is a feature of
its own, ``c:<column>=<value>`` (``c:<column>`` for NULL), that is 1 in the rows
that have it and 0 elsewhere, so every value of a column can be split on; there
are no buckets, and no column per category.

fit
  * every tree draws its own sample of ``psi = min(256, n)`` rows by hashing
    (row key, tree id): one hash pre-filter keeps about 1.5 * trees * psi
    candidate rows in total, then each tree keeps its ``psi`` candidates with
    the smallest per-tree hash (``row_number`` inside a group of ~1.5 psi
    rows). Deterministic for a given seed, independent of partitioning;
  * ``groupBy(tree).applyInPandas`` grows one isolation tree per group: a
    random one of the features that differ in the node, in the order of their
    names, split at a uniform value between the node's min and max, depth
    limit ceil(log2 psi). All random numbers are md5 hashes of (seed, tree,
    node), which SQL can compute too. The children of node i are 2i + 1 and
    2i + 2. A tree has at most 2 psi - 1 nodes, so the forest is bounded by
    trees * (2 * 256 - 1) rows and is broadcast for scoring.

score
  * a pandas UDF (Arrow batches) averages the path length over the trees:
    s = 2^(-E[h] / c(psi)); ``score_samples = -s``, rounded to 9 decimals so
    that rows that take the same paths score alike;
  * offset = the ``contamination`` percentile of score_samples (exact,
    distributed); decision = score_samples - offset; label -1 when < 0.
    Lower decision = more abnormal.

Numeric values are rounded to 6 decimals (see ``round6``) and missing ones
filled with the feature mean, before fitting and scoring.
"""

from __future__ import annotations

import hashlib
import json
import math
import sys

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlens.functions.scalar import round6
from ledgerlens.operators.prepare import q
from ledgerlens.operators.scoring import exact_percentile, materialize

try:  # ship this module's functions by value: workers need no installed package
    from pyspark import cloudpickle as _cloudpickle

    _cloudpickle.register_pickle_by_value(sys.modules[__name__])
except Exception:  # noqa: BLE001 - older cloudpickle: rely on --py-files
    pass

EULER_GAMMA = 0.5772156649015329
#: Hashes are the first 12 hex digits of an md5.
HASH_DIGITS = 12
HASH_RANGE = 16**HASH_DIGITS

NODE_SCHEMA = "tree int, node int, feature string, threshold double, size long"


def _hash(*parts: Column | str | int) -> Column:
    """0 to HASH_RANGE - 1 for the parts joined by colons."""
    text = F.concat_ws(":", *[p.cast("string") if isinstance(p, Column) else F.lit(str(p)) for p in parts])
    return F.conv(F.substring(F.md5(text), 1, HASH_DIGITS), 16, 10).cast("long")


def _uniform(*parts: str | int) -> float:
    """A number between 0 and 1 for the parts; the hash is that of ``_hash``."""
    text = ":".join(map(str, parts))
    return (int(hashlib.md5(text.encode()).hexdigest()[:HASH_DIGITS], 16) + 0.5) / HASH_RANGE


def average_path_length(n: np.ndarray | float) -> np.ndarray:
    """c(n): mean depth of an unsuccessful search in a BST of n keys."""
    n = np.asarray(n, dtype=float)
    out = np.zeros_like(n)
    two = n == 2
    big = n > 2
    out[two] = 1.0
    out[big] = 2.0 * (np.log(n[big] - 1.0) + EULER_GAMMA) - 2.0 * (n[big] - 1.0) / n[big]
    return out


def _grow_tree(x: np.ndarray, names: list[str], seed: int, tree: int, max_depth: int) -> list[tuple]:
    """(node, feature, threshold, size) of a tree over the rows of ``x``, whose
    columns are in the order of their names; leaves have no feature."""
    out = []
    stack = [(0, np.arange(len(x)), 0)]
    while stack:
        node, idx, depth = stack.pop()
        feature, threshold = None, None
        if depth < max_depth and len(idx) > 1:
            low, high = x[idx].min(axis=0), x[idx].max(axis=0)
            open_ones = np.flatnonzero(high > low)
            if len(open_ones):
                f = open_ones[int(_uniform(seed, "feature", tree, node) * len(open_ones))]
                at = float(low[f] + _uniform(seed, "threshold", tree, node) * (high[f] - low[f]))
                left = x[idx, f] < at
                if left.any():
                    feature, threshold = names[f], at
                    stack.append((2 * node + 1, idx[left], depth + 1))
                    stack.append((2 * node + 2, idx[~left], depth + 1))
        out.append((node, feature, threshold, len(idx)))
    return out


def category_name(column: str, value: str | None) -> str:
    return f"c:{column}" if value is None else f"c:{column}={value}"


def _fit_group(features: list[str], categories: list[str], seed: int, max_depth: int):
    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        tree = int(pdf["tree"].iloc[0])
        columns = {f"n:{c}": pdf[c].to_numpy(dtype=float) for c in features}
        for c in categories:
            value = [None if pd.isna(v) else v for v in pdf[c]]
            for v in set(value):
                columns[category_name(c, v)] = np.array([w == v for w in value], dtype=float)
        names = sorted(columns)
        x = np.column_stack([columns[c] for c in names])
        nodes = _grow_tree(x, names, seed, tree, max_depth)
        out = pd.DataFrame(nodes, columns=["node", "feature", "threshold", "size"])
        out.insert(0, "tree", tree)
        return out

    return fit


class IsolationForestModel:
    def __init__(self, features: list[str], categories: list[str], fill: dict[str, float], nodes: list[tuple], psi: int, n_trees: int):
        """``nodes``: (tree, node, feature, threshold, size) rows."""
        self.features, self.categories, self.fill = features, categories, fill
        self.psi, self.n_trees = psi, n_trees
        self.nodes = sorted(tuple(n) for n in nodes)
        width = max(n[1] for n in self.nodes) + 1
        shape = (n_trees, width)
        self.feature = np.full(shape, -1, dtype=np.int64)  # place of the column, -1 in leaves
        self.threshold = np.zeros(shape)  # or the code of the category
        self.size = np.zeros(shape)
        place = {f"n:{c}": i for i, c in enumerate(features)}
        self.codes: list[dict[str | None, int]] = [{} for _ in categories]
        for tree, node, feature, threshold, size in self.nodes:
            self.size[tree, node] = size
            if feature is None:
                continue
            if feature in place:
                self.feature[tree, node], self.threshold[tree, node] = place[feature], threshold
                continue
            column, _, value = feature[2:].partition("=")
            k = categories.index(column)
            code = self.codes[k].setdefault(value if "=" in feature else None, len(self.codes[k]))
            self.feature[tree, node], self.threshold[tree, node] = len(features) + k, code
        self.offset: float | None = None
        self.n_rows: int | None = None

    def arrays(self):
        return (self.feature, self.threshold, self.size, self.psi, len(self.features), self.codes)

    def save(self, spark: SparkSession, path: str) -> None:
        """Nodes as Parquet plus one JSON row of settings (features, fill
        values, psi, trees, offset)."""
        spark.createDataFrame(self.nodes, NODE_SCHEMA).write.mode("overwrite").parquet(f"{path}/nodes")
        meta = {
            "features": self.features,
            "categories": self.categories,
            "fill": [self.fill.get(c, 0.0) for c in self.features],
            "psi": self.psi,
            "n_trees": self.n_trees,
            "offset": self.offset,
        }
        spark.createDataFrame([(json.dumps(meta),)], "meta string").write.mode("overwrite").text(f"{path}/meta")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> "IsolationForestModel":
        meta = json.loads(spark.read.text(f"{path}/meta").first()[0])
        nodes = spark.read.schema(NODE_SCHEMA).parquet(f"{path}/nodes").collect()  # bounded, see above
        model = cls(meta["features"], meta["categories"], dict(zip(meta["features"], meta["fill"])), nodes, meta["psi"], meta["n_trees"])
        model.offset = meta["offset"]
        return model

    def matrix(self, df: DataFrame):
        return F.array(*[F.coalesce(round6(q(c).cast("double")), F.lit(self.fill.get(c, 0.0))) for c in self.features])

    def values(self, df: DataFrame):
        return F.array(*[q(c).cast("string") for c in self.categories]).cast("array<string>")


def _path_lengths(x: np.ndarray, feature, threshold, size, n_numeric: int) -> np.ndarray:
    """Mean path length of every row over all trees, vectorised over rows and
    trees together with flat ``take`` gathers; rows in a leaf stay there. A
    split on a category sends the rows that have it to the right."""
    n_trees, width = feature.shape
    n, d = x.shape
    base = (np.arange(n_trees, dtype=np.int64) * width)[None, :]
    flat, thr, is_category = feature.ravel(), threshold.ravel(), feature.ravel() >= n_numeric
    xf = np.ascontiguousarray(x, dtype=float).ravel()
    row_base = (np.arange(n, dtype=np.int64) * d)[:, None]
    node = np.zeros((n, n_trees), dtype=np.int64)
    depth = np.zeros((n, n_trees))
    while True:
        at = base + node
        f = flat.take(at)
        inner = f >= 0
        if not inner.any():
            break
        v, t = xf.take(row_base + np.maximum(f, 0)), thr.take(at)
        right = np.where(is_category.take(at), v == t, v >= t)
        node = np.where(inner, 2 * node + 1 + right, node)
        depth += inner
    return (depth + average_path_length(size.ravel().take(base + node))).mean(axis=1)


def fit_isolation_forest(
    df: DataFrame,
    features: list[str],
    n_trees: int = 100,
    max_samples: int = 256,
    key: str = "hash",
    seed: int = 42,
    categories: list[str] | None = None,
) -> IsolationForestModel:
    """Fit on the rows of ``df`` (``key`` identifies a row)."""
    categories = list(categories or [])
    row = df.agg(
        F.count(F.lit(1)).alias("__rows"), *[round6(F.avg(round6(q(c).cast("double")))).alias(c) for c in features]
    ).first().asDict()
    n = int(row.pop("__rows"))
    fill = {c: (0.0 if v is None else float(v)) for c, v in row.items()}
    if n == 0:
        raise ValueError("cannot fit on an empty frame")
    psi = int(min(max_samples, n))
    max_depth = int(math.ceil(math.log2(max(psi, 2))))
    p_row = min(1.0, 1.5 * psi / n)  # per-tree inclusion probability
    p_any = min(1.0, n_trees * p_row)  # one-hash pre-filter
    cand = df.filter(_hash(seed, "any", q(key)) < F.lit(int(p_any * HASH_RANGE)))
    limit = F.lit(int(min(1.0, p_row / p_any) * HASH_RANGE))
    trees = F.filter(F.sequence(F.lit(0), F.lit(n_trees - 1)), lambda t: _hash(seed, "tree", q("_key"), t) < limit)
    filled = [F.coalesce(round6(q(c).cast("double")), F.lit(fill[c])).alias(c) for c in features]
    named = [q(c).cast("string").alias(c) for c in categories]
    sample = cand.select(q(key).cast("string").alias("_key"), *filled, *named).withColumn("tree", F.explode(trees))
    rank = Window.partitionBy("tree").orderBy(_hash(seed, "rank", q("_key"), q("tree")), "_key")
    sample = sample.withColumn("_r", F.row_number().over(rank)).filter(q("_r") <= psi)
    nodes = (
        sample.select("tree", *features, *categories)
        .groupBy("tree")
        .applyInPandas(_fit_group(features, categories, seed, max_depth), schema=NODE_SCHEMA)
    )
    # at most n_trees * (2 * psi - 1) small rows
    model = IsolationForestModel(features, categories, fill, nodes.collect(), psi, n_trees)
    model.n_rows = n  # rows of the fitting frame: every one gets a score
    model.fitted_on = df
    return model


def isolation_scores(df: DataFrame, model: IsolationForestModel) -> DataFrame:
    """Adds ``iforest_raw`` (= score_samples: -2^(-E[h]/c(psi)), lower is
    more abnormal)."""
    spark = SparkSession.getActiveSession() or df.sparkSession
    bc = spark.sparkContext.broadcast(model.arrays())

    @F.pandas_udf(T.DoubleType())
    def raw_score(rows: pd.Series, values: pd.Series) -> pd.Series:
        feature, threshold, size, psi, n_numeric, codes = bc.value
        if not len(rows):
            return pd.Series([], dtype=float)
        x = np.vstack(rows.to_numpy())
        if codes:
            own = zip(*values, strict=True)
            x = np.column_stack([x, *([code.get(v, -1) for v in column] for code, column in zip(codes, own, strict=True))])
        mean_path = _path_lengths(x, feature, threshold, size, n_numeric)
        c = average_path_length(np.array([float(psi)]))[0]
        return pd.Series(np.round(-np.power(2.0, -mean_path / c), 9))

    return df.withColumn("iforest_raw", raw_score(model.matrix(df), model.values(df)))


def score_isolation_forest(
    df: DataFrame,
    model: IsolationForestModel,
    contamination: float | None = 0.01,
    persist: bool = True,
) -> DataFrame:
    """Adds ``anomaly_score`` (decision function) and ``pred_label`` (-1/1).

    The offset is the ``contamination`` percentile of the scores of ``df``
    (fitting data); pass ``contamination=None`` to reuse the offset stored in
    the model (scoring new data with a saved model)."""
    scored = isolation_scores(df, model)
    if contamination is None:
        if model.offset is None:
            raise ValueError("model has no offset; pass contamination")
        offset = model.offset
    else:
        if persist:
            scored = materialize(scored, "iforest")
        # scores are never NULL (inputs are filled): the fitting count is n
        known = model.n_rows if df is getattr(model, "fitted_on", None) else None
        offset = exact_percentile(scored, "iforest_raw", contamination, n=known)
        model.offset = offset
    decision = q("iforest_raw") - F.lit(float(offset))
    return scored.withColumn("anomaly_score", decision).withColumn(
        "pred_label", F.when(decision < 0, F.lit(-1)).otherwise(F.lit(1))
    )

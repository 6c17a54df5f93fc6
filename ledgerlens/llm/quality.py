"""Quality classifier: hashed word n-gram logistic regression, trained with
follow-the-regularised-leader updates, scored as sparse dot products.

Tokens are runs of letters and digits and runs of other characters, so marks
glued to words count as tokens of their own. Single tokens and pairs of
neighbours are hashed into ``BUCKETS`` features, any token followed by itself,
at once or after one other, into the same one; a text's vector has the square roots of their shares, so its
length is 1 whatever the text's length.

Training uses at most ``max_rows`` labelled rows (chosen by a hash of the id),
dealt to ``SHARDS`` tasks that each run FTRL-proximal over their rows, several
times in an order fixed by the hash; the shards' weights are averaged by an
aggregate over the features. The model is at most ``BUCKETS`` weights.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.common import sorted_groups, text_chunks
from ledgerlens.llm.textops import WORD_MULT, mix, span_hashes

BUCKETS = 1 << 18
#: The bound of the training sample, and the tasks it is dealt to.
MAX_ROWS = 16_000
SHARDS = 4
#: FTRL-proximal: step, its decay, L1 and L2, passes over the rows.
ALPHA, BETA, L1, L2, PASSES = 0.3, 1.0, 0.02, 0.1, 4

#: Features of any token followed by itself, at once or after one other.
REPEATED, ECHO = np.uint64(0x5EA7), 0x1EC40

#: 0: white space, 1: letters and digits (all bytes of non-ASCII characters
#: included), 2: other characters.
_KIND = np.full(256, 2, np.uint8)
_KIND[[0x20, *range(0x09, 0x0E)]] = 0
_KIND[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = 1


def features(data: np.ndarray, offs: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(feature numbers, values) of each text."""
    n = len(data)
    if n:
        kind = _KIND[data]
        edge = np.empty(n + 1, bool)
        edge[0] = edge[-1] = True
        edge[1:-1] = kind[1:] != kind[:-1]
        edge[offs] = True
        cut = np.flatnonzero(edge)
        solid = kind[cut[:-1]] > 0
        starts, ends = cut[:-1][solid], cut[1:][solid]
        words = span_hashes(data, starts, ends)
        first = np.searchsorted(starts, offs)
    else:
        words, first = np.empty(0, np.uint64), np.zeros(len(offs), np.int64)
    pairs = mix(words[:-1] * WORD_MULT[0] + words[1:] * WORD_MULT[1]) if len(words) else words
    pairs[words[:-1] == words[1:]] = REPEATED
    low = np.uint64(BUCKETS - 1)
    one, two = (words & low).astype(np.int32), (pairs & low).astype(np.int32)
    again = np.concatenate([[0], np.cumsum(words[:-2] == words[2:])])
    for a, b in zip(first[:-1], first[1:]):
        echoes = np.full(again[max(a, b - 2)] - again[a] if b - a > 2 else 0, ECHO, np.int32)
        idx, count = np.unique(np.concatenate([one[a:b], two[a : max(a, b - 1)], echoes]), return_counts=True)
        yield idx, np.sqrt(count / max(1, count.sum()))


def sigmoid(x):
    return 1.0 / (1.0 + np.exp(-np.clip(x, -35, 35)))


def ftrl(rows: list[tuple[np.ndarray, np.ndarray]], labels: list[int], passes: int = PASSES) -> tuple[np.ndarray, float]:
    """Weights and bias after FTRL-proximal updates over the rows in order."""
    z, n = np.zeros(BUCKETS + 1), np.zeros(BUCKETS + 1)

    def weights(i):
        zi, ni = z[i], n[i]
        l1 = np.where(i == BUCKETS, 0.0, L1)
        return np.where(np.abs(zi) <= l1, 0.0, -(zi - np.sign(zi) * l1) / ((BETA + np.sqrt(ni)) / ALPHA + L2))

    rows = [(np.append(i, BUCKETS), np.append(x, 1.0)) for i, x in rows]
    for _ in range(passes):
        for (i, x), y in zip(rows, labels, strict=True):
            w = weights(i)
            g = (sigmoid(w @ x) - y) * x
            step = (np.sqrt(n[i] + g * g) - np.sqrt(n[i])) / ALPHA
            z[i] += g - step * w
            n[i] += g * g
    w = weights(np.arange(BUCKETS + 1))
    return w[:-1], float(w[-1])


def train(docs: DataFrame, labels: DataFrame, learn: Column, id_col: str = "doc_id", text_col: str = "text", max_rows: int = MAX_ROWS) -> tuple[np.ndarray, float]:
    """Weights and bias learned from rows of ``docs`` where ``learn`` (a
    condition on the id) holds and ``labels`` (id, quality 0/1) has a label.

    Rows without an id or label are not used; an id with labels that disagree
    counts as its smallest. Without any labelled row the model scores 0.5.
    """
    known = labels.filter("quality IS NOT NULL").groupBy(labels[id_col].alias("_id")).agg(F.min("quality").alias("_y"))
    ids = docs.select(docs[id_col].alias("_id")).filter(learn & F.col("_id").isNotNull())
    n = ids.join(known, "_id").count()
    part = F.pmod(F.xxhash64("_id"), F.lit(1 << 20))
    sample = (
        docs.select(docs[id_col].alias("_id"), docs[text_col].alias("_text"))
        .filter(learn)
        .filter(part < int((1 << 20) * min(1.0, max_rows / max(1, n))))
        .join(known, "_id")
        .select(F.pmod(F.xxhash64("_id", F.lit(7)), F.lit(SHARDS)).alias("shard"), F.xxhash64("_id").alias("turn"), "_y", "_text")
    )

    def shard(batches):
        for t in sorted_groups(batches, ["shard"]):
            rows = []
            for _, _, data, offs in text_chunks(t.column("_text")):
                rows += features(data, offs)
            w, bias = ftrl(rows, t.column("_y").to_pylist())
            at = np.append(np.flatnonzero(w), BUCKETS)
            yield pa.RecordBatch.from_pydict({"i": at, "w": np.append(w[at[:-1]], bias)})

    parts = sample.repartition(SHARDS, "shard").sortWithinPartitions("shard", "turn").mapInArrow(shard, "i long, w double")
    weights, bias, shards = np.zeros(BUCKETS), 0.0, 0
    # at most BUCKETS + 1 rows
    for r in parts.groupBy("i").agg(F.sum("w").alias("w"), F.count("w").alias("n")).collect():
        if r["i"] == BUCKETS:
            bias, shards = r["w"], r["n"]
        else:
            weights[r["i"]] = r["w"]
    return weights / max(1, shards), bias / max(1, shards)


def score(
    docs: DataFrame,
    model: tuple[np.ndarray, float],
    id_col: str = "doc_id",
    text_col: str = "text",
    keep: list[str] | None = None,
    score_col: str = "score",
) -> DataFrame:
    """Per row: the id (or the columns ``keep``) and ``score_col``, 0 to 1.
    Whole texts are read; a null or empty text has the score of the bias alone.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # BUCKETS weights: 2 MB
    names = keep or [id_col]
    if score_col in names:
        raise ValueError(f"{score_col} is a column already")
    read = names if text_col in names else [*names, text_col]
    at = read.index(text_col)
    schema = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in names)

    def run(batches):
        weights, bias = shared.value
        for batch in batches:
            for a, b, data, offs in text_chunks(batch.column(at)):
                got = sigmoid(np.array([bias + weights[i] @ x for i, x in features(data, offs)]))
                cols = [batch.column(k).slice(a, b - a) for k in range(len(names))]
                yield pa.RecordBatch.from_arrays([*cols, pa.array(got)], names=[*names, score_col])

    return docs.select(*[docs[c] for c in read]).mapInArrow(run, f"{schema}, `{score_col}` double")


def drop_low_quality(docs: DataFrame, model: tuple[np.ndarray, float], least: float, text_col: str = "text") -> DataFrame:
    """``docs`` without the documents that score under ``least``; same
    columns."""
    name = "quality_score"
    while name in docs.columns:
        name += "_"
    return score(docs, model, text_col=text_col, keep=docs.columns, score_col=name).filter(F.col(name) >= least).drop(name)

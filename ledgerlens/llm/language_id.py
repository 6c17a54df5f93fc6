"""Language identification: averaged hashed subword embeddings with a linear
softmax, trained by stochastic gradient descent in numpy, with a calibrated
rejection threshold.

Subwords are runs of three and of four bytes of the lower-cased text, in which
everything but letters is a space; they hash into ``BUCKETS`` embeddings of
``DIM`` numbers. A text's embedding is their mean, a linear layer and a softmax
give its languages. Mean and layer are linear, so scoring looks up each
subword's share of the logits directly.

Training uses at most ``max_rows`` rows (chosen by a hash of the id) in one
task; the model is BUCKETS x DIM numbers. A fifth of the sample is held back to
calibrate: the rejection threshold is the probability that all but
``REJECTED`` of its rightly predicted texts reach.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.common import sorted_groups, text_chunks
from ledgerlens.llm.textops import BYTE_VALUE, WORD_MULT

BUCKETS = 1 << 15
DIM = 16
#: The bound of the training sample.
MAX_ROWS = 6_000
PASSES, RATE, REJECTED = 4, 4.0, 0.01
UNKNOWN = "und"

_FOLD = np.full(256, 32, np.uint8)
_FOLD[97:123] = np.arange(97, 123)
_FOLD[65:91] = np.arange(97, 123)
_FOLD[128:] = np.arange(128, 256)
_LETTER = re.compile(r"[^\W\d_]").search


def subwords(data: np.ndarray, offs: np.ndarray):
    """(bucket of each subword, first subword of each text, one behind last).
    Texts are set apart by spaces, so each has subwords of its own only."""
    n = len(offs) - 1
    at = np.arange(len(data)) + np.repeat(np.arange(n), np.diff(offs)) * 4 + 2
    padded = np.full(len(data) + 4 * n + 2, 32, np.uint8)
    padded[at] = _FOLD[data]
    v = BYTE_VALUE[padded]
    three = v[:-3] * WORD_MULT[0] + v[1:-2] * WORD_MULT[1] + v[2:-1] * WORD_MULT[2]
    four = three + v[3:] * WORD_MULT[3]
    shift = np.uint64(64 - (BUCKETS.bit_length() - 1))
    both = np.empty((len(three), 2), np.int32)
    both[:, 0] = (three * WORD_MULT[4]) >> shift
    both[:, 1] = (four * WORD_MULT[5]) >> shift
    starts = offs + 4 * np.arange(n + 1)
    return both.ravel(), 2 * starts[:-1] + 2, 2 * (starts[1:] - 2)


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(-1, keepdims=True))
    return e / e.sum(-1, keepdims=True)


def fit(rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, n_labels: int) -> tuple[np.ndarray, np.ndarray]:
    """(embeddings, layer) after SGD over (buckets, shares) rows."""
    rng = np.random.default_rng(11)
    emb = rng.normal(0, 1 / DIM, (BUCKETS, DIM))
    layer = np.zeros((DIM, n_labels))
    steps, step = PASSES * max(1, len(rows)), 0
    for _ in range(PASSES):
        for k in rng.permutation(len(rows)):
            i, x = rows[k]
            rate = RATE * (1 - step / steps)
            step += 1
            hidden = x @ emb[i]
            err = softmax(hidden @ layer)
            err[labels[k]] -= 1
            back = layer @ err
            layer -= rate * np.outer(hidden, err)
            emb[i] -= rate * np.outer(x, back)
    return emb, layer


def logits(table: np.ndarray, buckets: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Mean of the subwords' rows of ``table`` for each text."""
    out = np.zeros((len(first), table.shape[1]))
    some = last > first
    if some.any():
        cut = np.stack([first[some], last[some]], 1).ravel()
        for j in range(table.shape[1]):
            col = np.append(table[:, j][buckets], 0.0)
            out[some, j] = np.add.reduceat(col, cut)[::2] / (last - first)[some]
    return out


def train(docs: DataFrame, learn: Column, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", max_rows: int = MAX_ROWS) -> dict:
    """Model learned from rows where ``learn`` (a condition on the id, called
    ``_id``) holds and the language is not null: ``langs``, ``table`` (logits
    of each bucket) and ``threshold``. Without such rows it has no language and
    every prediction is ``und``."""
    rows = docs.select(docs[id_col].alias("_id"), docs[text_col].alias("_text"), docs[lang_col].alias("_lang")).filter(
        learn & F.col("_id").isNotNull() & F.col("_lang").isNotNull()
    )
    n = rows.select("_id").count()
    part = F.pmod(F.xxhash64("_id"), F.lit(1 << 20))
    sample = rows.filter(part < int((1 << 20) * min(1.0, max_rows / max(1, n)))).select(
        F.lit(0).alias("all"), F.xxhash64("_id").alias("turn"), "_lang", "_text"
    )

    def one(batches):
        for t in sorted_groups(batches, ["all"]):
            names = t.column("_lang").to_pylist()
            langs = sorted(set(names))
            y = np.array([langs.index(x) for x in names])
            feats = []
            for _, _, data, offs in text_chunks(t.column("_text")):
                buckets, first, last = subwords(data, offs)
                for a, b in zip(first, last):
                    i, c = np.unique(buckets[a:b], return_counts=True)
                    feats.append((i, c / max(1, c.sum())))
            held = np.arange(len(feats)) % 5 == 4
            learned = np.flatnonzero(~held)
            emb, layer = fit([feats[k] for k in learned], y[learned], len(langs))
            table = emb @ layer
            right = [p.max() for k in np.flatnonzero(held) if (p := softmax(feats[k][1] @ table[feats[k][0]])).argmax() == y[k]]
            threshold = float(np.quantile(right, REJECTED)) if right else 0.0
            yield pa.RecordBatch.from_pydict({"langs": [langs], "threshold": [threshold], "model": [table.astype(np.float32).tobytes()]})

    got = sample.repartition(1, "all").sortWithinPartitions("all", "turn").mapInArrow(one, "langs array<string>, threshold double, model binary").collect()
    if not got:
        return {"langs": [], "table": np.zeros((BUCKETS, 0), np.float32), "threshold": 0.0}
    langs = list(got[0]["langs"])
    return {"langs": langs, "threshold": got[0]["threshold"], "table": np.frombuffer(got[0]["model"], np.float32).reshape(BUCKETS, len(langs))}


def predict(docs: DataFrame, model: dict, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: the id, ``lang_pred`` (``und`` for a null text or one without a
    letter), ``score`` (the prediction's probability; 0 for ``und``) and
    ``rejected`` (the score is under the calibrated threshold). Whole texts
    are read."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # BUCKETS x languages numbers
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        m = shared.value
        for batch in batches:
            for a, b, data, offs in text_chunks(batch.column(1)):
                raw = data.tobytes()
                p = softmax(logits(m["table"], *subwords(data, offs))) if m["langs"] else np.zeros((b - a, 1))
                best, top = p.argmax(1), p.max(1)
                known = [bool(m["langs"]) and _LETTER(raw[x:y].decode("utf-8", "replace")) is not None for x, y in zip(offs.tolist(), offs[1:].tolist())]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(a, b - a),
                        pa.array([m["langs"][k] if ok else UNKNOWN for k, ok in zip(best, known)], pa.string()),
                        pa.array(np.where(known, top, 0.0)),
                        pa.array(~np.array(known) | (top < m["threshold"])),
                    ],
                    names=[id_col, "lang_pred", "score", "rejected"],
                )

    return docs.select(docs[id_col], docs[text_col]).mapInArrow(run, f"`{id_col}` {id_type}, lang_pred string, score double, rejected boolean")

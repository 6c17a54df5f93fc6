"""Helpers shared by the operators: table access, written intermediate
tables, Arrow string buffers, sorted-group streaming and bounded key filters."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.session import drop_path, scratch_dir

#: Bytes of text handled by one numpy step; longer texts are steps of their own.
CHUNK_BYTES = 1 << 20


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` under the shared checkpoint folder and read it back: the
    lineage ends there, so a lost executor costs at most a re-read."""
    spark = df.sparkSession
    path = scratch_dir(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(table: DataFrame) -> None:
    """Delete a table that ``written`` made, once all that is made from it has
    been written as well."""
    for path in {f.rsplit("/", 1)[0] for f in table.inputFiles()}:
        drop_path(table.sparkSession, path)


def string_buffer(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string or binary column; null counts as empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if pa.types.is_binary(col.type) or pa.types.is_large_binary(col.type):
        col = col.cast(pa.large_binary())
    else:
        col = col.cast(pa.large_string())
    if col.null_count:
        col = col.fill_null(b"" if pa.types.is_large_binary(col.type) else "")
    _, offs, data = col.buffers()
    offs = np.frombuffer(offs, np.int64)[col.offset : col.offset + len(col) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return data, offs


def text_chunks(col: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, last row + 1, bytes, offsets from 0) of runs of whole texts
    of at most ``limit`` bytes, or of one longer text."""
    data, offs = string_buffer(col)
    n, i = len(offs) - 1, 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(offs, offs[i] + limit, side="right")) - 1)
        yield i, j, data[offs[i] : offs[j]], offs[i : j + 1] - offs[i]
        i = j


def sorted_groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """One table per run of equal keys in a partition that is sorted by them;
    a run may cross batches."""
    held: list[pa.RecordBatch] = []
    held_key = None
    for batch in batches:
        if not batch.num_rows:
            continue
        cols = [batch.column(batch.schema.get_field_index(k)) for k in keys]
        change = np.zeros(batch.num_rows, bool)
        for c in cols:
            v = c.to_numpy(zero_copy_only=False)
            change[1:] |= v[1:] != v[:-1]
        cuts = np.flatnonzero(change).tolist()
        starts = [0, *cuts]
        ends = [*cuts, batch.num_rows]
        for a, b in zip(starts, ends, strict=True):
            key = tuple(c[a].as_py() for c in cols)
            if held and key != held_key:
                yield pa.Table.from_batches(held)
                held = []
            held_key = key
            held.append(batch.slice(a, b - a))
    if held:
        yield pa.Table.from_batches(held)


def clustered(df: DataFrame, keys: list[str], then: list[str] | None = None) -> DataFrame:
    """Rows of a key in one partition, sorted by it."""
    return df.repartition(*keys).sortWithinPartitions(*keys, *(then or []))


#: A key filter has at most this many bits (16 MB), however many keys go in.
MAX_FILTER_BITS = 1 << 27
_PIECE = 1 << 16


class KeyFilter:
    """A bit for each 64-bit key modulo a power of two, broadcast to Python
    tasks. Its size is bounded by ``MAX_FILTER_BITS``; with more keys than
    that it lets more rows through, which later exact joins sort out, and it
    never holds back a row whose key went in."""

    def __init__(self, spark: SparkSession, keys: DataFrame, col: str, bits_per_key: int = 32):
        n = keys.count()
        bits = _PIECE
        while bits < min(MAX_FILTER_BITS, bits_per_key * n):
            bits *= 2
        shift = _PIECE.bit_length() - 1
        low = F.col(col).bitwiseAND(F.lit(bits - 1))

        def piece(groups):
            for t in sorted_groups(groups, ["piece"]):
                marks = np.zeros(_PIECE, np.uint8)
                marks[t.column("bit").to_numpy()] = 1
                yield pa.RecordBatch.from_pydict(
                    {"piece": [t.column("piece")[0].as_py()], "marks": [np.packbits(marks).tobytes()]},
                    schema=pa.schema([("piece", pa.int64()), ("marks", pa.binary())]),
                )

        pieces = keys.select(F.shiftright(low, shift).alias("piece"), low.bitwiseAND(F.lit(_PIECE - 1)).alias("bit"))
        full = np.zeros(bits // 8, np.uint8)
        # at most MAX_FILTER_BITS / 2**16 pieces of 8 KB
        for r in clustered(pieces, ["piece"]).mapInArrow(piece, "piece long, marks binary").collect():
            full[r["piece"] * (_PIECE // 8) : (r["piece"] + 1) * (_PIECE // 8)] = np.frombuffer(r["marks"], np.uint8)
        self.bits = bits
        self.shared = spark.sparkContext.broadcast(full)

    def test(self) -> Callable[[np.ndarray], np.ndarray]:
        """A function for tasks: which of an array of keys may be in the set."""
        return _Test(self.shared, self.bits)


class _Test:
    def __init__(self, shared, bits: int):
        self.shared, self.mask = shared, bits - 1

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        k = keys.astype(np.uint64) & np.uint64(self.mask)
        return (self.shared.value[(k >> np.uint64(3)).astype(np.int64)] >> (np.uint8(7) - (k & np.uint64(7)).astype(np.uint8))) & 1 == 1

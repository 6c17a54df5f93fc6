"""Exact duplicates by progressive refinement.

Rows are grouped by the byte length of their normalised text, then by a hash
of its first characters, then by a hash of all of it. Each step looks only at
the groups the step before left with two rows or more:

1. ``length``: one partial aggregate over (length).
2. ``length, prefix hash``: rows of shared lengths only; a bitmap of fixed size
   tells them, so a length that very many rows have is no group of its own.
3. ``full hash``: the whole text is normalised and hashed only for rows whose
   (length, prefix hash) is shared. A bitmap of fixed size, broadcast to the
   scan, tells which rows those are; it may let a few more through, whose
   groups then turn out to have one row.

Texts never cross a shuffle: rows travel as (id, hashes). Groups are found by
aggregates with map-side combining, and the result is joined back on the full
hash alone, so that adaptive execution can split a group holding a large
share of all rows.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Characters of the normalised text that the second step hashes.
PREFIX_CHARS = 256
#: Bits of the bitmap of shared (length, prefix) pairs: 2**23 bits are at most
#: 131,072 rows of 16 bytes, whatever the input.
FILTER_BITS = 1 << 23


def normalise(text: Column) -> Column:
    """A-Z lower-cased, nothing else changed; null counts as empty."""
    t = F.coalesce(text, F.lit(""))
    ascii_only = F.octet_length(t) == F.length(t)
    return F.when(ascii_only, F.lower(t)).otherwise(F.translate(t, string.ascii_uppercase, string.ascii_lowercase))


def _bit(*parts: Column) -> Column:
    return F.pmod(F.xxhash64(*parts), F.lit(FILTER_BITS))


def _bitmap(bits: DataFrame) -> DataFrame:
    """The set of ``_bit`` as words of 64: at most FILTER_BITS / 64 rows of two
    longs, 2 MB."""
    marks = bits.select(F.shiftright("_bit", 6).alias("_word"), F.expr("shiftleft(1L, cast(_bit & 63 AS int))").alias("_mark"))
    return marks.groupBy("_word").agg(F.bit_or("_mark").alias("_marks"))


def _marked(rows: DataFrame, bitmap: DataFrame) -> DataFrame:
    """Adds ``_in``: whether the row's ``_bit`` is in the set. More may be in,
    none is missing."""
    met = rows.withColumn("_word", F.shiftright("_bit", 6)).join(F.broadcast(bitmap), "_word", "left")
    return met.withColumn("_in", F.expr("coalesce(_marks & shiftleft(1L, cast(_bit & 63 AS int)), 0L) <> 0"))


def exact_groups(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    carry: dict[str, Column] | None = None,
) -> DataFrame:
    """One row per row of ``docs``: the id, ``keep_id`` (the largest id of the
    rows with an equal text), ``group_size``, ``kept`` (it is the row that
    stays), and the columns ``carry`` computes from the row.

    Null texts equal empty ones. A null id is smaller than any other; a group
    of null ids only has keep_id null and keeps them. Rows that repeat an id
    and its text are all ``kept`` if that id stays. An empty table gives an
    empty result. Other columns of ``docs`` are not read.
    """
    text = docs[text_col]
    length = F.octet_length(F.coalesce(text, F.lit(""))).cast("long")
    prefix = F.xxhash64(normalise(F.substring(F.coalesce(text, F.lit("")), 1, PREFIX_CHARS)))

    # lengths that occur once need no further step; they are told by a bitmap of
    # fixed size, so that the rows of one length, which may be all rows, are
    # dealt by (length, prefix hash) only
    by_length = docs.select(length.alias("_len")).groupBy("_len").count().filter("count > 1")
    lengths = _bitmap(by_length.select(_bit(F.col("_len")).alias("_bit")))
    known = _marked(docs.select(length.alias("_len"), prefix.alias("_pre")).withColumn("_bit", _bit(F.col("_len"))), lengths)
    shared = known.filter("_in").groupBy("_len", "_pre").count().filter("count > 1")

    bitmap = _bitmap(shared.select(_bit(F.col("_len"), F.col("_pre")).alias("_bit")))
    rows = docs.select(
        docs[id_col].alias("_id"),
        text.alias("_text"),
        length.alias("_len"),
        prefix.alias("_pre"),
        *[c.alias(n) for n, c in (carry or {}).items()],
    ).withColumn("_bit", _bit(F.col("_len"), F.col("_pre")))
    rows = _marked(rows, bitmap).select(
        "_id",
        "_len",
        "_pre",
        F.when(F.col("_in"), F.sha2(normalise(F.col("_text")), 256)).alias("_full"),
        *(carry or {}),
    )
    groups = (
        rows.filter("_full IS NOT NULL")
        .groupBy("_len", "_pre", "_full")
        .agg(F.max("_id").alias("_keep"), F.count(F.lit(1)).alias("_n"))
        .select(F.col("_full").alias("_g"), "_keep", "_n")
    )
    out = rows.join(groups, F.col("_full") == F.col("_g"), "left")
    alone = F.col("_g").isNull()
    return out.select(
        F.col("_id").alias(id_col),
        F.when(alone, F.col("_id")).otherwise(F.col("_keep")).alias("keep_id"),
        F.coalesce(F.col("_n"), F.lit(1)).cast("long").alias("group_size"),
        (alone | F.col("_id").eqNullSafe(F.col("_keep"))).alias("kept"),
        *(carry or {}),
    )


def one_row_per_id(docs: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Rows whose id repeats, with all columns equal, kept once. Only rows of
    ids that do repeat are compared in full; without any, ``docs`` itself."""
    repeated = docs.filter(docs[id_col].isNotNull()).groupBy(id_col).count().filter("count > 1").select(F.col(id_col).alias("_rid"))
    if not repeated.head(1):
        return docs
    same = docs[id_col] == repeated["_rid"]
    return docs.join(repeated, same, "left_anti").unionByName(docs.join(repeated, same, "left_semi").distinct())


def drop_exact_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the rows that are exact copies of a row that stays;
    same columns. Rows that repeat an id with all columns equal stay once, rows
    without an id all stay: nothing tells which of them to drop."""
    docs = one_row_per_id(docs, id_col)
    dropped = exact_groups(docs, id_col, text_col).filter(~F.col("kept")).select(F.col(id_col).alias("_rid"))
    dropped = dropped.distinct()
    return docs.join(dropped, docs[id_col] == dropped["_rid"], "left_anti")

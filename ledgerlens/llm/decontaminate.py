"""Benchmark decontamination by spaced-seed hashing.

A seed is a fixed mask of ``1`` and ``0`` over neighbouring tokens; the hash of
a position ignores the tokens under ``0``. Two passages that differ by a
substituted token still share the hashes of the positions whose mask ignores
it. Hashes of the benchmark items are joined with those of all positions of the
training documents, and each hit is verified on the diagonal it lies on: the
item is laid over the document so that the hit's tokens meet, and the equal
tokens are counted, position by position.

Items shorter than the shortest mask have masks of their own length: one for all
their tokens, and, where the asked share lets a token differ, one for each place
that leaves that token out. Documents are hashed by them only if the benchmark
has such items.

Only DataFrame functions run on this path. A document's positions are exploded
with a slice per mask column, hashed in generated code and matched against the
item seeds. The items are the query set: up to ``BLOCK_SEEDS`` seeds are
broadcast. More are joined by a shuffle, behind a sieve of at most
``MAX_PIECES`` times 8 KB that holds back nearly all positions of the documents:
what executors hold at once, and how often documents are read, does not grow
with the benchmark. Hits travel as numbers, and only the documents that have
any are read a second time, for the tokens of the diagonals.
"""

from __future__ import annotations

import math
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.common import written

#: Fixed masks of five tokens each. With a fifth of the tokens substituted at
#: random, one of them keeps a clean position in every of 4,000 trials for items
#: of 16 to 60 tokens.
MASKS = ("1101011", "11100101", "110010011")
#: An item is leaked if this share of its tokens is equal on one diagonal.
OVERLAP = 0.8
#: Seeds that are broadcast as they are: some 2 MB.
BLOCK_SEEDS = 40_000
#: A sieve is cut into pieces of 2**16 bits, has 16 bits a key or more, and at
#: most so many pieces: 16 MB.
MAX_PIECES = 1 << 11


def tokens(text: Column) -> Column:
    """Lower-case runs of letters and digits of any script."""
    return F.split(F.trim(F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+", " ")), " ")


def _width(masks) -> int:
    return max(len(m) for m in masks)


def short_masks(n: int, overlap: float) -> list[str]:
    """Masks for items of ``n`` tokens that ignore as many as may differ; those
    that begin or end with ignored places are cut there, so that what is ignored
    may lie outside a document."""
    spare = n - math.ceil(n * overlap - 1e-9)
    made = ("".join("0" if i in gone else "1" for i in range(n)).strip("0") for k in range(spare + 1) for gone in combinations(range(n), k))
    return sorted(set(made) - {""})


def _seed_rows(words: Column, masks: tuple[str, ...]) -> Column:
    """For each position, the tokens from there on that any mask can need, as
    a struct; behind the end they are null."""
    width = _width(masks)
    n = F.size(words)
    padded = F.concat(words, F.array_repeat(F.lit(None).cast("string"), width - 1))
    return F.arrays_zip(*[F.slice(padded, F.lit(j + 1), n).alias(f"t{j}") for j in range(width)])


def _hashes(masks: tuple[str, ...], at: str, n: Column, pos: Column, only: dict[str, list[int]] | None = None) -> Column:
    """The hash of each mask at a position; null where the mask does not fit.
    ``only`` says for some masks which numbers of tokens they are for."""
    out = []
    for k, mask in enumerate(masks):
        picked = [F.col(f"{at}.t{j}") for j, c in enumerate(mask) if c == "1"]
        fits = pos + len(mask) <= n
        if only and mask in only:
            fits = fits & n.isin(only[mask])
        out.append(F.when(fits, F.xxhash64(F.lit(k), *picked)))
    return F.array(*out)


def _item_seeds(items: DataFrame, masks: tuple[str, ...], only: dict[str, list[int]]) -> DataFrame:
    """(item, n, pos, hash) of the benchmark."""
    w = items.withColumn("_n", F.size("_words")).select("_item", "_n", F.posexplode_outer(_seed_rows(F.col("_words"), masks)).alias("_pos", "_at"))
    return w.select("_item", "_n", "_pos", F.explode(_hashes(masks, "_at", F.col("_n"), F.col("_pos"), only)).alias("_hash")).filter("_hash IS NOT NULL")


def _bits(hash_: Column) -> list[Column]:
    """The two bits of a hash in its piece of a sieve."""
    return [hash_.bitwiseAND(F.lit(0xFFFF)).cast("int"), F.shiftrightunsigned(hash_, 16).bitwiseAND(F.lit(0xFFFF)).cast("int")]


def _sifted(rows: DataFrame, col: str, keys: DataFrame, n: int) -> DataFrame:
    """``rows`` whose 64-bit hash ``col`` may be among the hashes of ``keys``
    (one column), some ``n``: all that are, and few others."""
    pieces = 1
    while pieces < min(MAX_PIECES, 16 * n / 65536):
        pieces *= 2

    def piece(hash_: Column) -> Column:
        return F.shiftrightunsigned(hash_, 32).bitwiseAND(F.lit(pieces - 1)).cast("long")

    key = F.col(keys.columns[0])
    marks = keys.select(piece(key).alias("_piece"), F.explode(F.array(*_bits(key))).alias("_bit"))
    marks = marks.select("_piece", F.shiftright("_bit", 6).alias("_word"), F.expr("shiftleft(1L, _bit & 63)").alias("_mark"))
    # every word of every piece, so that a word's place in the array is its number
    every = rows.sparkSession.range(pieces * 1024).select(F.shiftright("id", 10).alias("_piece"), F.col("id").bitwiseAND(F.lit(1023)).cast("int").alias("_word"), F.lit(0).cast("long").alias("_mark"))
    words = marks.unionByName(every).groupBy("_piece", "_word").agg(F.bit_or("_mark").alias("_mark"))
    sieve = words.groupBy("_piece").agg(F.sort_array(F.collect_list(F.struct("_word", "_mark")))["_mark"].alias("_marks"))
    met = rows.withColumn("_piece", piece(F.col(col))).join(F.broadcast(sieve), "_piece")
    for k, bit in enumerate(_bits(F.col(col))):
        met = met.withColumn(f"_bit{k}", bit)
    held = " AND ".join(f"(_marks[shiftright(_bit{k}, 6)] & shiftleft(1L, _bit{k} & 63)) <> 0" for k in range(2))
    return met.filter(held).select(*rows.columns)


def contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    masks: tuple[str, ...] = MASKS,
    overlap: float = OVERLAP,
) -> DataFrame:
    """Per pair of a document and a benchmark item leaked into it: the ids,
    ``n_equal`` (equal tokens on the best diagonal), ``n_tokens`` (of the item),
    ``first_token`` (of the document, where the item begins) and ``overlap``.

    Null texts have no tokens, rows with a null id are left out, rows that
    repeat a document's id count as one document. Items without tokens are not
    looked for; items of few tokens are found wherever the asked share of them
    stands, so an item of one common word is in many documents. Items with equal
    tokens are looked up
    once and reported under each of their ids. A benchmark or documents table
    without rows gives an empty result.
    """
    items = (
        benchmark.select(benchmark[item_col].alias("_iid"), tokens(benchmark[text_col]).alias("_words"))
        .filter("_iid IS NOT NULL AND _words[0] <> ''")
        .withColumn("_item", F.xxhash64("_words"))
    )
    named = items.select("_item", "_iid").distinct()
    unique = written(items.select("_item", "_words").dropDuplicates(["_item"]), "items")
    # a bound on the seeds from a one-row count, to choose the join
    shortest = min(map(len, masks))
    known = unique.agg(F.sum(F.size("_words")), F.collect_set(F.when(F.size("_words") < shortest, F.size("_words")))).first()
    only: dict[str, list[int]] = {}
    for n in sorted(known[1]):
        for mask in short_masks(n, overlap):
            only.setdefault(mask, []).append(n)
    masks = (*masks, *only)
    n_seeds = (known[0] or 0) * len(masks)
    seeds = _item_seeds(unique, masks, only)

    # rows that repeat an id are told apart by their text
    texts = docs.select(docs[id_col].alias("_doc"), docs[text_col].alias("_text")).filter("_doc IS NOT NULL").withColumn("_row", F.xxhash64("_text"))
    places = texts.select("_doc", "_row", tokens(F.col("_text")).alias("_dwords")).withColumn("_dn", F.size("_dwords"))
    places = places.select("_doc", "_row", "_dn", F.posexplode_outer(_seed_rows(F.col("_dwords"), masks)).alias("_dpos", "_at"))
    places = places.select("_doc", "_row", "_dpos", F.explode_outer(_hashes(masks, "_at", F.col("_dn"), F.col("_dpos"))).alias("_hash"))
    if n_seeds <= BLOCK_SEEDS:
        hit = places.join(F.broadcast(seeds), "_hash")
    else:
        hit = _sifted(places, "_hash", seeds.select("_hash"), n_seeds).join(seeds, "_hash")
    # a diagonal once, however many of its positions meet
    hits = hit.select("_doc", "_row", "_item", "_n", (F.col("_dpos") - F.col("_pos")).alias("_start")).distinct()
    hits = written(hits, "hits")

    read = _sifted(texts, "_row", hits.select("_row"), hits.count()).select("_doc", "_row", tokens(F.col("_text")).alias("_dwords"))
    start = F.col("_start")
    lead = F.greatest(F.lit(0), -start)  # tokens of the item before the document
    doc_part = F.slice(F.col("_dwords"), F.greatest(F.lit(1), start + 1), F.greatest(F.lit(0), F.col("_n") - lead))
    # cut out before the items are joined: no row with all tokens of a document is copied
    parts = read.join(hits, ["_doc", "_row"]).select("_doc", "_item", "_n", "_start", lead.alias("_lead"), doc_part.alias("_part"))
    item_part = F.slice(F.col("_words"), F.col("_lead") + 1, F.size("_part"))
    equal = F.size(F.filter(F.zip_with("_part", item_part, lambda a, b: a == b), lambda x: x)).cast("long")
    # the most equal tokens, then the first place, as one number
    best = F.max(equal * (1 << 32) + (1 << 31) - start)
    pairs = parts.join(unique, "_item").groupBy("_doc", "_item", "_n").agg(best.alias("_best"))
    pairs = pairs.select(
        "_doc", "_item", F.col("_n").alias("n_tokens"), F.shiftright("_best", 32).alias("n_equal"), (F.lit(1 << 31) - F.col("_best").bitwiseAND(F.lit((1 << 32) - 1))).alias("first_token")
    )
    pairs = pairs.filter(F.col("n_equal") >= F.ceil(F.col("n_tokens") * overlap))
    return pairs.join(named, "_item").select(
        F.col("_doc").alias(id_col),
        F.col("_iid").alias(item_col),
        F.col("n_equal").cast("int").alias("n_equal"),
        F.col("n_tokens").cast("int").alias("n_tokens"),
        F.col("first_token").cast("int").alias("first_token"),
        (F.col("n_equal") / F.col("n_tokens")).alias("overlap"),
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` without the documents that hold a benchmark item; same columns."""
    leaked = contaminated(docs, benchmark, id_col, text_col, **options).select(F.col(id_col).alias("_lid")).distinct()
    return docs.join(leaked, docs[id_col] == leaked["_lid"], "left_anti")

"""Near-duplicate documents by a chosen-path set similarity join.

A document is the set of its distinct five-word shingles, as 64-bit hashes.
Documents with equal sets are one class; all else works on classes.

* A class has ``COORDINATES`` min-hashes: the tokens that stand for its set.
* ``TREES`` independent trees start with two tokens each, no token in two trees.
  Classes that share a node's tokens are its members. A node is a leaf when it
  is small; else its members branch by two other tokens, but for nodes with at
  most ``MANY`` leaves' members outside their largest component so far, which are
  compared at once.
* In a leaf, members are compared exhaustively: first by length and by the
  share of equal tokens, with a margin that a similar pair misses with less
  than 1e-7 probability, then by exact intersection of their full sets. Only
  links that join two components of the leaf are emitted, never all pairs.
* ``FIRST`` trees run first. In their large nodes, each block of members is
  compared with itself and with a few members that all blocks share; nearly all
  of a group of near copies is then one component, at a cost in proportion to
  its size. The trees, those first ones again for their large nodes, compare
  members of different components only: those outside a node's largest component
  with all others. A pair that an earlier tree's leaf has compared is not
  compared anew.

With similarity s, a pair meets in a tree's first node with probability s * s, so
14 trees miss a pair at the threshold 0.85 with probability 2e-8, and at 0.8 with
6e-7. In nodes that branch, a pair stays together in 2 s > 1 children in the mean,
so the chance that none of them keeps it does not grow to 1 with the depth. Nodes
still too large at ``MAX_DEPTH`` are compared exhaustively in pairs of blocks.

Full sets are fetched for members with a candidate only: a second pass over the
texts computes them again, behind a key filter of bounded size.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.common import KeyFilter, clustered, discard, sorted_groups, text_chunks, written
from ledgerlens.llm.components import connected_components
from ledgerlens.llm.textops import mix, shingle_hashes, word_hashes

COORDINATES = 64
TREES = 14
#: Trees that run first.
FIRST = 3
#: A node is a leaf up to so many members, and shingles of all of them.
LEAF_MEMBERS = 1024
LEAF_SHINGLES = 1 << 21
MANY = 8
MAX_DEPTH = 8
#: Members of a block, and members of a large node that all its blocks share.
BLOCK = 512
HUBS = 8

_RNG = np.random.default_rng(85)
_XOR = _RNG.integers(0, 2**63, COORDINATES, dtype=np.uint64)
_MULT = _RNG.integers(0, 2**63, COORDINATES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def agreement_floor(threshold: float) -> int:
    """Equal coordinates a pair at the threshold has at least, but for 1e-7."""
    return int(COORDINATES * threshold - 5.4 * (COORDINATES * threshold * (1 - threshold)) ** 0.5)


def shingle_sets(column: pa.Array, k: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, last row + 1, distinct shingles, offsets) of runs of texts."""
    for a, b, data, offs in text_chunks(column):
        shingles, first = shingle_hashes(*word_hashes(data, offs), k)
        sets = [np.unique(shingles[x:y]) for x, y in zip(first, first[1:])]
        ends = np.cumsum([0, *map(len, sets)])
        yield a, b, np.concatenate(sets) if sets else shingles, ends


def set_keys(shingles: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit sums that identify each set."""
    out = []
    for x in (mix(shingles), mix(shingles ^ np.uint64(0xA5A5A5A5A5A5A5A5))):
        total = np.concatenate([[np.uint64(0)], np.cumsum(x, dtype=np.uint64)])
        out.append((total[ends[1:]] - total[ends[:-1]]).view(np.int64))
    return out[0], out[1]


def signatures(docs: DataFrame, id_col: str, text_col: str, k: int) -> DataFrame:
    """(id, n, key, sig) of each row; n is 0 and sig null without words."""
    id_type = docs.schema[id_col].dataType.simpleString()
    key_type = pa.struct([("a", pa.int64()), ("b", pa.int64())])

    def run(batches):
        for batch in batches:
            for x, y, shingles, ends in shingle_sets(batch.column(1), k):
                a, b = set_keys(shingles, ends)
                n = np.diff(ends)
                some = n > 0
                sig = np.zeros((y - x, COORDINATES), np.int32)
                if some.any():
                    cut = ends[:-1][some]
                    for c in range(COORDINATES):
                        sig[some, c] = (np.minimum.reduceat((shingles ^ _XOR[c]) * _MULT[c], cut) >> np.uint64(32)).astype(np.uint32).view(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(some)]) * COORDINATES, pa.int32()), pa.array(sig[some].ravel()))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(x, y - x), pa.array(n), pa.StructArray.from_arrays([pa.array(a), pa.array(b)], fields=list(key_type)), lists],
                    names=["id", "n", "key", "sig"],
                )

    return docs.select(docs[id_col], docs[text_col]).mapInArrow(run, f"id {id_type}, n long, key struct<a: long, b: long>, sig array<int>")


def full_sets(docs: DataFrame, id_col: str, text_col: str, k: int, wanted: DataFrame) -> DataFrame:
    """(key, set) of the classes in ``wanted`` (key, rep), read anew from the
    row of each class that has the id ``rep``."""
    tagged = wanted.select(F.col("key.a").bitwiseXOR(F.coalesce(F.col("rep").cast("long"), F.lit(0))).alias("tag"))
    test = KeyFilter(docs.sparkSession, tagged, "tag").test()

    def run(batches):
        for batch in batches:
            ids = batch.column(0).cast(pa.int64()).fill_null(0)
            for x, y, shingles, ends in shingle_sets(batch.column(1), k):
                a, b = set_keys(shingles, ends)
                own = ids.slice(x, y - x).to_numpy()
                for i in np.flatnonzero(test((a ^ own).view(np.uint64)) & (np.diff(ends) > 0)):
                    yield pa.RecordBatch.from_pydict(
                        {"id": pa.array([int(own[i])]), "a": pa.array([int(a[i])]), "b": pa.array([int(b[i])]), "set": pa.array([shingles[ends[i] : ends[i + 1]].tobytes()])}
                    )

    rows = docs.select(docs[id_col], docs[text_col]).mapInArrow(_joined(run), "id long, a long, b long, set binary")
    rows = rows.select(F.struct("a", "b").alias("key"), F.col("id").alias("_own"), "set")
    rep = wanted.select("key", F.coalesce(F.col("rep").cast("long"), F.lit(0)).alias("_own"))
    return rows.join(rep, ["key", "_own"]).select("key", "set")


def _joined(run, size: int = 256):
    """Small batches put together."""

    def out(batches):
        held = []
        for b in run(batches):
            held.append(b)
            if len(held) >= size:
                yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
                held = []
        if held:
            yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]

    return out


def _branches(node: Column) -> list[Column]:
    """Two different coordinates, none of those that trees start with."""
    rest = COORDINATES - 2 * TREES
    one = F.pmod(F.xxhash64(node, F.lit(1)), F.lit(rest)).cast("int")
    two = F.pmod(one + 1 + F.pmod(F.xxhash64(node, F.lit(3)), F.lit(rest - 1)), F.lit(rest)).cast("int")
    return [one + 2 * TREES, two + 2 * TREES]


LEAF = ["node", "tree", "depth", "key", "label", "n", "sig"]


def _blocks(members: Column, weight: Column) -> Column:
    return F.greatest(F.lit(1), F.ceil(F.greatest(members / BLOCK, weight * 2 / LEAF_SHINGLES))).cast("int")


def _block(key: str, blocks: Column) -> Column:
    return F.pmod(F.xxhash64(key), blocks).cast("int")


def _hub_cells(large: DataFrame) -> DataFrame:
    """Blocks of a large node, each with the node's hubs: some ``HUBS`` members
    whose hash is below a bound that the node's size gives."""
    blocks = _blocks(F.col("size"), F.col("weight"))
    chance = F.shiftright(F.xxhash64("key", "node"), 1).cast("double") / F.lit(float(2**62)) + 1  # from 0 to 2
    hub = chance * F.col("size") < 2 * HUBS
    cells = F.when(hub, F.sequence(F.lit(0), blocks - 1)).otherwise(F.array(_block("key", blocks)))
    at = large.withColumn("cell", F.explode(cells))
    return at.withColumn("node", F.xxhash64("node", "cell")).withColumn("depth", F.lit(-1)).select(LEAF)


def _rest_cells(large: DataFrame) -> DataFrame:
    """Cells that hold each pair of members of a node of which not both are of
    its largest component: blocks of the others with blocks of the largest
    component, and with one another."""
    blocks = _blocks(F.col("top.c"), F.col("top.w"))
    rest = _blocks(F.col("size") - F.col("top.c"), F.col("weight") - F.col("top.w"))
    inner = F.col("label") == F.col("top.label")
    large = large.withColumns({"inner": inner, "blocks": blocks, "rest": rest, "mine": _block("key", F.when(inner, blocks).otherwise(rest))})
    own, every = F.col("mine"), lambda n: F.sequence(F.lit(0), n - 1)
    node = F.col("node")
    across = F.when(F.col("inner"), F.transform(every(F.col("rest")), lambda i: F.xxhash64(node, F.lit(0), i, own)))
    across = across.otherwise(F.transform(every(F.col("blocks")), lambda j: F.xxhash64(node, F.lit(0), own, j)))
    among = F.transform(F.filter(every(F.col("rest")), lambda i: i != own), lambda i: F.xxhash64(node, F.lit(1), F.least(i, own), F.greatest(i, own)))
    cells = F.when(F.col("inner"), across).otherwise(F.concat(across, among))
    return large.withColumn("node", F.explode(cells)).withColumn("depth", F.lit(-1)).select(LEAF)


def leaves(
    classes: DataFrame, trees: range, labels: DataFrame | None, leaf_members: int
) -> tuple[DataFrame, list[DataFrame]]:
    """(node, tree, depth, key, label, n, sig) of the leaves of some trees, and
    the written tables they are read from. Without ``labels`` large nodes are
    compared with hubs; with them, members of one component never are, and of
    the trees that ran first only large nodes remain.
    The min-hashes join members once, after the nodes of a single member are
    gone, and go down the tree with them."""
    known = classes.withColumn("label", F.col("key")) if labels is None else classes.join(labels, "key", "left").withColumn("label", F.coalesce("label", "key"))
    roots = F.array(*[F.struct(F.lit(t).alias("tree"), F.xxhash64(F.lit(t), F.col("sig")[2 * t], F.col("sig")[2 * t + 1]).alias("node")) for t in trees])
    members = known.select("key", "label", "n", F.explode(roots).alias("r")).select("r.tree", "r.node", "key", "label", "n")
    found, depth, tables = None, 0, []
    while True:
        parts = members.groupBy("node", "tree", "label").agg(F.count(F.lit(1)).alias("c"), F.sum("n").alias("w"))
        stats = parts.groupBy("node", "tree").agg(
            F.sum("c").alias("size"), F.sum("w").alias("weight"), F.count(F.lit(1)).alias("labels"), F.max(F.struct("c", "w", "label")).alias("top")
        )
        big = (F.col("size") > leaf_members) | (F.col("weight") > LEAF_SHINGLES)
        stats = stats.filter("labels > 1").withColumn("big", big).drop("labels")
        if labels is not None and depth == 0:
            stats = stats.filter(F.col("big") | (F.col("tree") >= FIRST))
        # a node with few members outside its largest component costs little
        deep = (F.col("size") - F.col("top.c") > MANY * leaf_members) & F.lit(depth < MAX_DEPTH and labels is not None)
        # written first: a join of two tables can be split where a node is hot
        stats = written(stats.withColumn("branch", F.col("big") & deep).drop("tree"), "nodes")
        mixed = members.join(stats, "node")
        mixed = written(mixed if depth else mixed.join(classes.select("key", "sig"), "key"), "members")
        tables += [stats, mixed]
        here = mixed.filter("NOT big").withColumn("depth", F.lit(depth)).select(LEAF)
        large = mixed.filter("big AND NOT branch")
        here = here.unionByName(_hub_cells(large) if labels is None else _rest_cells(large))
        found = here if found is None else found.unionByName(here)
        large = mixed.filter("branch")
        if not large.head(1):
            return found, tables
        depth += 1
        nodes = F.array(*[F.xxhash64("node", c, F.element_at("sig", c + 1)) for c in _branches(F.col("node"))])
        members = large.select("tree", F.explode(nodes).alias("node"), "key", "label", "n", "sig")


def candidates(leaf: DataFrame, done: DataFrame, threshold: float) -> DataFrame:
    """(node, key, label) of leaf members that may have a link in their leaf.
    ``done`` has, by key, a bit for each tree whose first node was a leaf."""
    rows = leaf.join(done, "key", "left")
    rows = rows.select(
        "node", "tree", F.col("key.a").alias("a"), F.col("key.b").alias("b"), F.col("label.a").alias("la"), F.col("label.b").alias("lb"),
        "n", F.coalesce("done", F.lit(0)).cast("long").alias("done"), "sig",
    )
    floor = agreement_floor(threshold)

    def run(batches):
        for t in sorted_groups(batches, ["node"]):
            m = t.num_rows
            if m < 2:
                continue
            t = t.combine_chunks()
            sig = t.column("sig").chunk(0).flatten().to_numpy().reshape(m, COORDINATES)
            n, done_, la, lb = (t.column(c).to_numpy() for c in ("n", "done", "la", "lb"))
            earlier = np.arange(t.column("tree")[0].as_py())  # trees in which a pair may have met
            hit = np.zeros(m, bool)
            for i in range(m - 1):
                rest = slice(i + 1, m)
                equal = sig[rest] == sig[i]
                ok = (equal.sum(1) >= floor) & ((la[rest] != la[i]) | (lb[rest] != lb[i]))
                ok &= np.minimum(n[rest], n[i]) >= threshold * np.maximum(n[rest], n[i]) - 1e-9
                if len(earlier) and ok.any():
                    both = (done_[rest] & done_[i])[:, None] >> earlier & 1 == 1
                    ok &= ~(equal[:, : 2 * len(earlier) : 2] & equal[:, 1 : 2 * len(earlier) : 2] & both).any(1)
                if ok.any():
                    hit[i] = True
                    hit[rest] |= ok
            if hit.any():
                yield from t.filter(pa.array(hit)).select(["node", "a", "b", "la", "lb"]).to_batches()

    got = clustered(rows, ["node"]).mapInArrow(_joined(run), "node long, a long, b long, la long, lb long")
    return got.select("node", F.struct("a", "b").alias("key"), F.struct(F.col("la").alias("a"), F.col("lb").alias("b")).alias("label"))


def links(found: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(u, v): for each component of a leaf, by links that hold on the full
    sets, its smallest member u and each other member v."""
    rows = found.join(sets, "key").select(
        "node", F.col("key.a").alias("a"), F.col("key.b").alias("b"), F.col("label.a").alias("la"), F.col("label.b").alias("lb"), "set"
    )

    def run(batches):
        for t in sorted_groups(batches, ["node"]):
            rows = {(r["a"], r["b"]): r for r in t.to_pylist()}
            keys = sorted(rows)
            sets_ = [np.frombuffer(rows[k]["set"], np.uint64) for k in keys]
            n = np.array([len(s) for s in sets_])
            ends = np.cumsum([0, *n])
            vocab, flat = np.unique(np.concatenate(sets_), return_inverse=True)
            mark = np.zeros(len(vocab), np.int32)
            names = {x: i for i, x in enumerate({(rows[k]["la"], rows[k]["lb"]) for k in keys})}
            comp = np.array([names[rows[k]["la"], rows[k]["lb"]] for k in keys])
            linked = np.zeros(len(keys), bool)
            for i in range(len(keys) - 1):
                j = np.arange(i + 1, len(keys))
                small, large = np.minimum(n[j], n[i]), np.maximum(n[j], n[i])
                j = j[(comp[j] != comp[i]) & (100 * small >= percent * large)]
                if not len(j):
                    continue
                mark[flat[ends[i] : ends[i + 1]]] = 1
                size = n[j]
                cut = np.concatenate([[0], np.cumsum(size)])
                at = np.arange(cut[-1]) + np.repeat(ends[j] - cut[:-1], size)
                both = np.add.reduceat(mark[flat[at]], cut[:-1])
                mark[flat[ends[i] : ends[i + 1]]] = 0
                for k in j[100 * both >= percent * (n[i] + size - both)]:
                    if comp[k] != comp[i]:
                        comp[comp == comp[k]] = comp[i]
                        linked[i] = linked[k] = True
            # members that came with one label are joined already; a linked
            # one stands for them
            out, least = [], {}
            for i in np.flatnonzero(linked):
                low = least.setdefault(comp[i], i)
                if low != i:
                    out.append((*keys[low], *keys[i]))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], names=["a", "b", "c", "d"])

    got = clustered(rows, ["node"]).mapInArrow(run, "a long, b long, c long, d long")
    return got.select(F.struct("a", "b").alias("u"), F.struct(F.col("c").alias("a"), F.col("d").alias("b")).alias("v"))


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = 85, k: int = 5, trees: int = TREES, leaf_members: int = LEAF_MEMBERS
) -> DataFrame:
    """Per row: the id (an integer), ``n_shingles``, ``component_id`` (smallest
    id reachable over links of ``percent`` / 100 Jaccard similarity or more) and
    ``kept`` (the id is the component's).

    Words are lower-cased (A-Z only) runs without white space; a text with
    fewer than ``k`` words has its whole sequence as its only shingle. Null,
    empty and blank texts have none, are linked with nothing and kept. Rows
    that repeat an id count as one document. A null id is larger than any
    other: its row is kept only if its component has no id. An empty table
    gives an empty result.
    """
    threshold = percent / 100
    full = written(signatures(docs, id_col, text_col, k), "signatures")
    classes = written(full.filter("n > 0").groupBy("key", "n").agg(F.min("id").alias("rep"), F.first("sig").alias("sig")), "classes")
    sigs = written(full.select("id", "n", "key"), "rows")
    discard(full)
    labels = edges = done = None
    kept: list[DataFrame] = []
    for part in (range(min(FIRST, trees)), range(trees)):
        leaf, tables = leaves(classes, part, labels, leaf_members)
        first = leaf.filter("depth = 0").groupBy("key").agg(F.expr("bit_or(shiftleft(1L, tree))").alias("done"))
        done = written(first if done is None else done.unionByName(first).groupBy("key").agg(F.bit_or("done").alias("done")), "done")
        found = written(candidates(leaf, done, threshold), "candidates")
        for table in tables:
            discard(table)
        wanted = written(found.select("key").distinct().join(classes.select("key", "rep"), "key"), "wanted")
        new = written(links(found, full_sets(docs, id_col, text_col, k, wanted), percent), "links")
        discard(found)
        discard(wanted)
        kept += [done, new]
        edges = new if edges is None else edges.unionByName(new)
        if labels is not None:
            discard(labels)
        labels = written(connected_components(edges).select(F.col("vertex").alias("key"), F.col("component").alias("label")), "labels")
    for table in kept:
        discard(table)
    # tables, not aggregates, are joined: a component or a set that very many
    # rows share can then be split
    joined = written(labels.join(classes.select("key", "rep"), "key"), "component_rows")
    lowest = written(joined.groupBy("label").agg(F.min("rep").alias("low")), "lowest")
    component = joined.join(lowest, "label").select("key", "low")
    reps = classes.select("key", "rep").join(component, "key", "left").select("key", F.coalesce("low", "rep").alias("component_id"))
    reps = written(reps, "components")
    for table in (classes, joined, lowest, labels):
        discard(table)
    out = sigs.select("id", "n", F.when(F.col("n") > 0, F.col("key")).alias("key")).join(reps, "key", "left")
    own = F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("id"))
    return out.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), own.alias("component_id"), F.col("id").eqNullSafe(own).alias("kept"))


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` with one document of each component; same columns. Rows
    without an id stay: nothing tells which of them to drop."""
    gone = near_duplicates(docs, id_col, text_col, **options).filter("NOT kept").select(F.col(id_col).alias("_nid")).distinct()
    return docs.join(gone, docs[id_col] == gone["_nid"], "left_anti")

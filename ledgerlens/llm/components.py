"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.common import discard, written


def _low(edges: DataFrame) -> DataFrame:
    """(u, m): the smallest of u and its neighbours ``v``."""
    return edges.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))


def connected_components(edges: DataFrame) -> DataFrame:
    """(vertex, component) of a graph given by ``edges`` (u, v): component is
    the smallest vertex reachable. Vertices without an edge do not appear.

    Each round joins edges with one minimum per vertex and is written to the
    shared folder; the rounds needed grow with the logarithm of the graph. It
    ends when every edge leads to a vertex that has no smaller neighbour.
    Neighbours are never gathered: a vertex with very many is a partial
    aggregate, which is written, and one side of a join of two tables that can
    be split. Tables of earlier rounds are deleted.
    """
    e = written(edges.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")), "edges")
    while True:
        # stars only: one edge per larger vertex, none from a smaller one
        shape = e.groupBy("u").agg(F.min("v").alias("lo"), F.max("v").alias("hi"))
        ends = shape.select("u", (F.col("lo") != F.col("hi")).cast("int").alias("many"), F.lit(1).alias("out"), F.lit(0).alias("into"))
        roots = e.select(F.col("v").alias("u"), F.lit(0).alias("many"), F.lit(0).alias("out"), F.lit(1).alias("into"))
        seen = ends.unionByName(roots).groupBy("u").agg(F.max("many").alias("many"), F.max("out").alias("out"), F.max("into").alias("into"))
        if not seen.filter("many = 1 OR (out = 1 AND into = 1)").head(1):
            return e.select(F.col("u").alias("vertex"), F.col("v").alias("component")).unionByName(
                e.select(F.col("v").alias("vertex"), F.col("v").alias("component"))
            ).distinct()
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = written(_low(both), "low")
        large = written(both.join(low, "u").filter("v > u AND v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")), "large")
        used = [e, low, large]
        low = written(_low(large), "low")
        down = large.join(low, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = down.unionByName(low.select("u", F.col("m").alias("v")))
        e = written(small.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u <> v").distinct(), "edges")
        for table in (*used, low):
            discard(table)

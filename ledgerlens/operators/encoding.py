"""Categorical encodings: frequency index, sparse one-hot and dummy vectors.

Real categories (function names, method ids) have no small bound, so nothing
here has a column per category or brings the categories to the driver. Indices
of all columns come from one table of value counts that is ranked in range
partitions and joined back; one-hot and dummy vectors are sparse, as columns of
places and values or as MLlib vectors, made without a Python worker.
"""

from __future__ import annotations

from pyspark.ml.feature import OneHotEncoder, VectorAssembler
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.operators.prepare import q
from ledgerlens.operators.scoring import materialize
from ledgerlens.schema import ENCODED_COLS

def category_tables(df: DataFrame, cols: list[str] = ENCODED_COLS) -> DataFrame:
    """(column, value, index) of the non-NULL values of some columns: index 0
    for a column's most frequent value, ties in alphabetical order. Written.

    One pass counts the values of all columns with map-side combining; they are
    range-partitioned by (column, count, value) and numbered in each partition;
    the partitions' offsets are a table of one row per partition and column.
    """
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), q(c).cast("string").alias("value")) for c in cols]))
    counts = df.select(pairs.alias("p")).select("p.*").filter("value IS NOT NULL").groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
    order = [F.desc("n"), F.asc("value")]
    ranged = materialize(counts.repartitionByRange(F.asc("column"), *order).withColumn("part", F.spark_partition_id()), "categories")
    sizes = ranged.groupBy("part", "column").agg(F.count(F.lit(1)).alias("size"))
    before = Window.partitionBy("column").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("part", "column", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("first"))
    own = Window.partitionBy("part", "column").orderBy(*order)
    numbered = ranged.withColumn("at", F.row_number().over(own) - 1).join(F.broadcast(offsets), ["part", "column"])
    return materialize(numbered.select("column", "value", (F.col("first") + F.col("at")).alias("index")), "index")


def add_indices(df: DataFrame, cols: list[str] = ENCODED_COLS, tables: DataFrame | None = None) -> DataFrame:
    """``<c>_index`` (double) and ``<c>_categories`` (number of values) for
    each column, from the written ``tables`` or counted on ``df`` itself. Values
    that are NULL or not in the tables get the number of values. A frequent
    value's rows can be split by adaptive execution."""
    if tables is None:
        tables = category_tables(df, cols)
    sizes = dict(tables.groupBy("column").count().collect())  # a row per column
    out = df
    for c in cols:
        own = tables.filter(F.col("column") == c).select(F.col("value").alias("_value"), F.col("index").alias("_index"))
        n = F.lit(sizes.get(c, 0))
        out = out.join(own, q(c).cast("string") == F.col("_value"), "left")
        out = out.withColumns({f"{c}_index": F.coalesce("_index", n).cast("double"), f"{c}_categories": n.cast("long")}).drop("_value", "_index")
    return out


def sparse_onehot(col: str) -> list[Column]:
    """One-hot vector of an indexed column in sparse form: its size, and the
    place of its only 1 (NULL for the zero vector of NULL and unseen values)."""
    index, size = q(f"{col}_index").cast("long"), q(f"{col}_categories")
    return [F.when(index < size, index).alias(f"{col}_onehot_at"), size.alias(f"{col}_onehot_size")]


def _dummy_place(c: str) -> Column:
    """A row's place among the dummies of an indexed column: the index of its
    value, the number of values for NULL, NULL for a value that is unseen."""
    index, size = q(f"{c}_index").cast("long"), q(f"{c}_categories")
    return F.when(q(c).isNull(), size).when(index < size, index)


def sparse_dummies(cols: list[str] = ENCODED_COLS) -> list[Column]:
    """The dummies of indexed columns as one sparse vector: ``size``, and the
    ``indices`` and ``values`` of what is not 0. Each column has a place for
    each of its values and one for NULL, behind those of the columns before."""
    places, first = [], F.lit(0).cast("long")
    for c in cols:
        places.append(first + _dummy_place(c))
        first = first + q(f"{c}_categories") + 1
    indices = F.array_compact(F.array(*places))
    return [first.alias("size"), indices.alias("indices"), F.transform(indices, lambda _: F.lit(1.0)).alias("values")]


def add_dummy_vectors(df: DataFrame, cols: list[str] = ENCODED_COLS, more: list[str] | None = None, output: str = "features") -> DataFrame:
    """The same vector as an MLlib column, behind the numeric columns ``more``;
    ``df`` is indexed. Made by MLlib's own encoder and assembler in the JVM."""
    sizes = df.select(*[q(f"{c}_categories") for c in cols]).head()
    if sizes is None:
        sizes = [0] * len(cols)
    # the last place of each column, for unseen values, is dropped: no 1 at all
    names = [f"_{c}_place" for c in cols]
    out = df.withColumns({n: F.coalesce(_dummy_place(c), q(f"{c}_categories") + 1).cast("double") for n, c in zip(names, cols, strict=True)})
    last = df.sparkSession.createDataFrame([tuple(float(s + 1) for s in sizes)], ", ".join(f"`{n}` double" for n in names))
    vectors = [f"{n}_vector" for n in names]
    encoder = OneHotEncoder(inputCols=names, outputCols=vectors, dropLast=True).fit(last)
    assembler = VectorAssembler(inputCols=[*(more or []), *vectors], outputCol=output)
    return assembler.transform(encoder.transform(out)).drop(*names, *vectors)

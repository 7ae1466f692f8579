"""Coordinate-table matrices ``(i, j, v)``.

Matrices are sparse long tables; products and broadcast sums meet block by
block on a replication grid, element-wise operations are full outer joins on
``(i, j)`` with absent cells read as 0.  Indexes are never negative.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLOCK = 256          # rows and columns of a block: at most BLOCK * BLOCK cells in one array


def shape(m: DataFrame) -> Column:
    """struct(rows, cols) of a coordinate matrix, as a scalar subquery."""
    return m.select(F.struct((F.max("i") + 1).alias("rows"), (F.max("j") + 1).alias("cols"))).scalar()


def fill(shape_of: DataFrame, kind: str = "consecutive") -> DataFrame:
    """M1: a matrix of the same shape as ``shape_of``: consecutive i*cols+j,
    zeros or ones, for every row index that occurs.  A row is generated in
    spans of ``BLOCK * BLOCK`` columns, so no array is as wide as the matrix."""
    sh = shape(shape_of)
    span = BLOCK * BLOCK
    last = sh.getField("cols") - 1
    spans = (shape_of.select("i").distinct()
             .select("i", F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor(last / span))).alias("__s")))
    cells = spans.select("i", F.explode(F.sequence(F.col("__s") * span, F.least((F.col("__s") + 1) * span - 1, last))).alias("j"))
    if kind == "consecutive":
        v = (F.col("i") * sh.getField("cols") + F.col("j")).cast("double")
    elif kind == "zeros":
        v = F.lit(0.0)
    elif kind == "ones":
        v = F.lit(1.0)
    else:
        raise ValueError(f"unknown fill {kind!r}")
    return cells.select(F.col("i").cast("bigint").alias("i"), F.col("j").cast("bigint").alias("j"), v.alias("v"))


def reshape(m: DataFrame, new_cols: int) -> DataFrame:
    """M2: row-major reshape to ``(-1, new_cols)``; flat index k = i*cols + j."""
    cols = shape(m).getField("cols")
    k = F.col("i") * cols + F.col("j")
    return m.select(F.floor(k / new_cols).cast("bigint").alias("i"), (k % new_cols).cast("bigint").alias("j"), "v")


def transpose(m: DataFrame) -> DataFrame:
    """M3."""
    return m.select(F.col("j").alias("i"), F.col("i").alias("j"), "v")


def elementwise(a: DataFrame, b: DataFrame, exp_scale: float = 1.0) -> DataFrame:
    """M4: + - * / and exp(exp_scale * a) on the union of cells (absent = 0; x/0 = null)."""
    j = a.withColumnRenamed("v", "a").join(b.withColumnRenamed("v", "b"), ["i", "j"], "full_outer")
    x, y = F.coalesce("a", F.lit(0.0)), F.coalesce("b", F.lit(0.0))
    return j.select("i", "j", (x + y).alias("add"), (x - y).alias("sub"), (x * y).alias("mul"),
                    F.try_divide(x, y).alias("div"), F.exp(x * exp_scale).alias("exp_a"))


def _blocks(m: DataFrame, rows: int, cols: int, prefix: str) -> DataFrame:
    """``(<p>r, <p>c, <p>cells array<struct<i, j, v>>)``: the present cells of each ``rows`` x ``cols`` block."""
    cells = m.filter(F.col("v").isNotNull()).select(
        F.floor(F.col("i") / rows).alias(f"{prefix}r"), F.floor(F.col("j") / cols).alias(f"{prefix}c"),
        F.struct((F.col("i") % rows).cast("int").alias("i"), (F.col("j") % cols).cast("int").alias("j"),
                 F.col("v").cast("double").alias("v")).alias("cell"))
    return cells.groupBy(f"{prefix}r", f"{prefix}c").agg(F.collect_list("cell").alias(f"{prefix}cells"))


def _last(m: DataFrame, col: str, size: int) -> Column:
    """Number of the last block along ``col``, as a scalar subquery (null for an empty matrix: nothing is replicated)."""
    return m.select(F.floor(F.max(col) / size)).scalar()


def _dense(cells: pa.StructScalar, block: int) -> tuple[np.ndarray, np.ndarray]:
    """A block's values (absent = 0) and which of its cells are present."""
    c = cells.values
    i, j = (c.field(k).to_numpy() for k in ("i", "j"))
    v, there = np.zeros((block, block)), np.zeros((block, block), dtype=bool)
    v[i, j], there[i, j] = c.field("v").to_numpy(), True
    return v, there


def _multiply_blocks(batches: Iterator[pa.RecordBatch], block: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for n in range(batch.num_rows):
            row = {name: batch.column(k)[n] for k, name in enumerate(batch.schema.names)}
            (x, in_x), (y, in_y) = _dense(row["acells"], block), _dense(row["bcells"], block)
            met = in_x.astype(np.float32) @ in_y.T.astype(np.float32) > 0
            if np.isfinite(x).all() and np.isfinite(y).all():
                v = x @ y.T
            else:                                  # an absent cell must not meet an infinite one as 0 * inf
                v = np.zeros((block, block))
                for k in range(block):
                    rows, cols = np.flatnonzero(in_x[:, k]), np.flatnonzero(in_y[:, k])
                    v[np.ix_(rows, cols)] += np.outer(x[rows, k], y[cols, k])
            i, j = np.nonzero(met)
            yield pa.RecordBatch.from_arrays(
                [pa.array(i + row["ar"].as_py() * block), pa.array(j + row["br"].as_py() * block), pa.array(v[i, j])],
                names=["i", "j", "v"])


def multiply_transposed(a: DataFrame, b: DataFrame, block: int = BLOCK) -> DataFrame:
    """M5: a . b^T, a cell for every pair of rows that share a column.

    Both sides are cut into ``block`` x ``block`` blocks.  Block (I, K) of ``a`` goes to every
    (I, J, K) and block (J, K) of ``b`` likewise, a grid that the join spreads by all three
    numbers, so the work has as many tasks as the product has block triples, however few inner
    keys there are.  Each meeting is one dense product, and the partial blocks are summed over K
    (combined before the shuffle).  A null value is an absent cell; a cell given twice is summed.
    """
    a, b = (m.groupBy("i", "j").agg(F.sum("v").alias("v")) for m in (a, b))
    x = _blocks(a, block, block, "a").withColumn("br", F.explode(F.sequence(F.lit(0).cast("bigint"), _last(b, "i", block))))
    y = (_blocks(b, block, block, "b").withColumnRenamed("bc", "ac")
         .withColumn("ar", F.explode(F.sequence(F.lit(0).cast("bigint"), _last(a, "i", block)))))
    met = x.join(y, ["ar", "br", "ac"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _multiply_blocks(batches, block)

    parts = met.select("ar", "br", "acells", "bcells").mapInArrow(run, "i bigint, j bigint, v double")
    return parts.groupBy("i", "j").agg(F.sum("v").alias("v"))


def concat(a: DataFrame, b: DataFrame, axis: int) -> DataFrame:
    """M6: along rows (axis 0) or columns (axis 1); b is offset by a's extent."""
    sh = shape(a)
    if axis == 0:
        b2 = b.select((F.col("i") + sh.getField("rows")).alias("i"), "j", "v")
    else:
        b2 = b.select("i", (F.col("j") + sh.getField("cols")).alias("j"), "v")
    return a.unionByName(b2)


def equal(a: DataFrame, b: DataFrame) -> DataFrame:
    """M7: 1 where entries are equal (absent = 0)."""
    j = a.withColumnRenamed("v", "a").join(b.withColumnRenamed("v", "b"), ["i", "j"], "full_outer")
    return j.select("i", "j", (F.coalesce("a", F.lit(0.0)) == F.coalesce("b", F.lit(0.0))).cast("int").alias("eq"))


def total(m: DataFrame) -> DataFrame:
    """M8."""
    return m.agg(F.sum("v").alias("total"))


def broadcast_add(col_vec: DataFrame, row_vec: DataFrame, block: int = BLOCK) -> DataFrame:
    """M9: (n x 1) + (1 x m) -> n x m.

    Both vectors travel as spans of ``block`` entries, each to every span of the other, and the
    join spreads the meetings by both span numbers; the output is the n x m grid by definition.
    """
    def spans(vec: DataFrame, index: str, own: str) -> DataFrame:
        return vec.groupBy(F.floor(F.col(index) / block).alias(own)).agg(
            F.collect_list(F.struct(F.col(index).alias("n"), "v")).alias(f"{own}s"))

    def other(vec: DataFrame, index: str) -> Column:
        return F.explode(F.sequence(F.lit(0).cast("bigint"), _last(vec, index, block)))

    x = spans(col_vec, "i", "__r").withColumn("__c", other(row_vec, "j"))
    y = spans(row_vec, "j", "__c").withColumn("__r", other(col_vec, "i"))
    met = x.join(y, ["__r", "__c"]).select(F.explode("__rs").alias("a"), F.col("__cs"))
    return (met.select("a", F.explode("__cs").alias("b"))
            .select(F.col("a.n").alias("i"), F.col("b.n").alias("j"), (F.col("a.v") + F.col("b.v")).alias("v")))


def slice_rows(m: DataFrame, n: int) -> DataFrame:
    """Leading n rows."""
    return m.filter(F.col("i") < n)


def update(m: DataFrame, cell: tuple[int, int, float] | None = None,
           block: tuple[int, int, int, int, float] | None = None) -> DataFrame:
    """Set one cell and / or a block [r0, r1) x [c0, c1) (cells that
    exist; absent cells of a sparse matrix are added for a single cell)."""
    v = F.col("v")
    if block is not None:
        r0, r1, c0, c1, bv = block
        inside = (F.col("i") >= r0) & (F.col("i") < r1) & (F.col("j") >= c0) & (F.col("j") < c1)
        v = F.when(inside, F.lit(float(bv))).otherwise(v)
    if cell is not None:
        ci, cj, cv = cell
        v = F.when((F.col("i") == ci) & (F.col("j") == cj), F.lit(float(cv))).otherwise(v)
    return m.select("i", "j", v.alias("v"))


def latent_grid(points: DataFrame, n: int, lo: float = -1.0, hi: float = 1.0) -> DataFrame:
    """V9: an n x n grid of 2-d points, x = linspace(lo, hi, n) and
    y = reversed linspace, one row per (row, col); ``points`` supplies the
    session (the grid itself is generated by Spark, one row per grid row)."""
    step = (hi - lo) / (n - 1) if n > 1 else 0.0
    rows = points.sparkSession.range(n).select(F.col("id").alias("r"))
    g = rows.select("r", F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias("c"))
    return g.select(F.col("r").cast("bigint").alias("row"), F.col("c").cast("bigint").alias("col"),
                    (F.lit(lo) + F.col("c") * step).alias("x"), (F.lit(hi) - F.col("r") * step).alias("y"))

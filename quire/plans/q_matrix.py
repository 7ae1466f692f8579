"""Matrix queries (M1-M11) on coordinate matrices derived from the fact tables:
X = lineitem (i = orderkey % 50, j = partkey % 40, v = sum quantity),
Y = orders (i = orderkey % 50, j = custkey % 40, v = sum totalprice / 1000)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.operators import matrix as M
from quire.plans.registry import query
from quire.sources.tables import table


def mat_x(spark, sf_dir) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    return (li.groupBy((F.col("l_orderkey") % 50).alias("i"), (F.col("l_partkey") % 40).alias("j"))
            .agg(F.sum("l_quantity").alias("v")))


def mat_y(spark, sf_dir) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    return (o.groupBy((F.col("o_orderkey") % 50).alias("i"), (F.col("o_custkey") % 40).alias("j"))
            .agg((F.sum("o_totalprice") / 1000.0).alias("v")))


SQL_XY = """
x AS (SELECT l_orderkey % 50 AS i, l_partkey % 40 AS j, sum(l_quantity) AS v FROM lineitem GROUP BY ALL),
y AS (SELECT o_orderkey % 50 AS i, o_custkey % 40 AS j, sum(o_totalprice) / 1000.0 AS v FROM orders GROUP BY ALL)"""


def _r(df: DataFrame, *cols: str) -> DataFrame:
    return df.select(*[F.round(c, 6).alias(c) if c in cols else F.col(c) for c in df.columns])


@query("matrix_fill", f"""
WITH {SQL_XY}
SELECT CAST(r.i AS BIGINT) AS i, CAST(c.j AS BIGINT) AS j,
       CAST(r.i * (SELECT max(j) + 1 FROM x) + c.j AS DOUBLE) AS v
FROM (SELECT DISTINCT i FROM x) r, range((SELECT max(j) + 1 FROM x)) AS c(j)
""")
def q_matrix_fill(spark, sf_dir):
    """M1: consecutive-valued matrix of X's shape."""
    return M.fill(mat_x(spark, sf_dir), "consecutive")


@query("matrix_reshape", f"""
WITH {SQL_XY}
SELECT CAST(floor((i * (SELECT max(j) + 1 FROM x) + j) / 80) AS BIGINT) AS i,
       CAST((i * (SELECT max(j) + 1 FROM x) + j) % 80 AS BIGINT) AS j, round(v, 6) AS v FROM x
""")
def q_matrix_reshape(spark, sf_dir):
    """M2: X reshaped to (-1, 80)."""
    return _r(M.reshape(mat_x(spark, sf_dir), 80), "v")


@query("matrix_transpose", f"WITH {SQL_XY} SELECT j AS i, i AS j, round(v, 6) AS v FROM x")
def q_matrix_transpose(spark, sf_dir):
    """M3: X transposed."""
    return _r(M.transpose(mat_x(spark, sf_dir)), "v")


@query("matrix_elementwise", f"""
WITH {SQL_XY},
j AS (SELECT coalesce(x.i, y.i) AS i, coalesce(x.j, y.j) AS j, coalesce(x.v, 0) AS a, coalesce(y.v, 0) AS b
      FROM x FULL OUTER JOIN y ON x.i = y.i AND x.j = y.j)
SELECT i, j, round(a + b, 6) AS add, round(a - b, 6) AS sub, round(a * b, 6) AS mul,
       round(CASE WHEN b = 0 THEN NULL ELSE a / b END, 6) AS div, round(exp(a * 0.001), 6) AS exp_a FROM j
""")
def q_matrix_elementwise(spark, sf_dir):
    """M4: X + - * / Y and exp(X / 1000)."""
    return _r(M.elementwise(mat_x(spark, sf_dir), mat_y(spark, sf_dir), 0.001),
              "add", "sub", "mul", "div", "exp_a")


@query("matrix_multiply", f"""
WITH {SQL_XY}
SELECT x.i AS i, y.i AS j, round(sum(x.v * y.v), 6) AS v FROM x JOIN y ON x.j = y.j GROUP BY x.i, y.i
""")
def q_matrix_multiply(spark, sf_dir):
    """M5: X . Y^T in blocks of 16 x 16 (4 x 4 x 3 meetings)."""
    return _r(M.multiply_transposed(mat_x(spark, sf_dir), mat_y(spark, sf_dir), block=16), "v")


@query("matrix_concat", f"""
WITH {SQL_XY}
SELECT CAST(0 AS INTEGER) AS axis, i, j, round(v, 6) AS v FROM x
UNION ALL SELECT 0, i + (SELECT max(i) + 1 FROM x), j, round(v, 6) FROM y
UNION ALL SELECT 1, i, j, round(v, 6) FROM x
UNION ALL SELECT 1, i, j + (SELECT max(j) + 1 FROM x), round(v, 6) FROM y
""")
def q_matrix_concat(spark, sf_dir):
    """M6: X and Y concatenated along rows and along columns."""
    x, y = mat_x(spark, sf_dir), mat_y(spark, sf_dir)
    r = M.concat(x, y, 0).select(F.lit(0).alias("axis"), "*")
    c = M.concat(x, y, 1).select(F.lit(1).alias("axis"), "*")
    return _r(r.unionByName(c), "v")


@query("matrix_equal", f"""
WITH {SQL_XY},
p AS (SELECT l_orderkey % 50 AS i, l_partkey % 40 AS j, sum(CASE WHEN l_quantity > 2 THEN l_quantity ELSE 0 END) AS v
      FROM lineitem GROUP BY ALL)
SELECT 'x_y' AS pair, coalesce(x.i, y.i) AS i, coalesce(x.j, y.j) AS j,
       CAST(coalesce(x.v, 0) = coalesce(y.v, 0) AS INTEGER) AS eq
FROM x FULL OUTER JOIN y ON x.i = y.i AND x.j = y.j
UNION ALL SELECT 'x_part', x.i, x.j, CAST(x.v = coalesce(p.v, 0) AS INTEGER) FROM x LEFT JOIN p USING (i, j)
""")
def q_matrix_equal(spark, sf_dir):
    """M7: 1 where X and Y agree, and where X agrees with itself without the quantities of 1 and 2."""
    x = mat_x(spark, sf_dir)
    part = (table(spark, sf_dir, "lineitem").groupBy((F.col("l_orderkey") % 50).alias("i"), (F.col("l_partkey") % 40).alias("j"))
            .agg(F.sum(F.when(F.col("l_quantity") > 2, F.col("l_quantity")).otherwise(0)).alias("v")))
    pairs = [M.equal(x, m).select(F.lit(name).alias("pair"), "i", "j", "eq") for name, m in (("x_y", mat_y(spark, sf_dir)), ("x_part", part))]
    return pairs[0].unionByName(pairs[1])


@query("matrix_sum", f"WITH {SQL_XY} SELECT round(sum(v), 6) AS total FROM x")
def q_matrix_sum(spark, sf_dir):
    """M8: sum of all entries of X."""
    return _r(M.total(mat_x(spark, sf_dir)), "total")


@query("matrix_broadcast_add", f"""
WITH {SQL_XY},
a AS (SELECT i, sum(v) AS v FROM x GROUP BY i),
b AS (SELECT j, sum(v) AS v FROM y GROUP BY j)
SELECT a.i, b.j, round(a.v + b.v, 6) AS v FROM a, b
""")
def q_matrix_broadcast_add(spark, sf_dir):
    """M9: row sums of X (n x 1) + column sums of Y (1 x m)."""
    x, y = mat_x(spark, sf_dir), mat_y(spark, sf_dir)
    a = x.groupBy("i").agg(F.sum("v").alias("v"))
    b = y.groupBy("j").agg(F.sum("v").alias("v"))
    return _r(M.broadcast_add(a, b), "v")


@query("matrix_slice", f"WITH {SQL_XY} SELECT i, j, round(v, 6) AS v FROM x WHERE i < 10")
def q_matrix_slice(spark, sf_dir):
    """The leading 10 rows of X."""
    return _r(M.slice_rows(mat_x(spark, sf_dir), 10), "v")


@query("matrix_update", f"""
WITH {SQL_XY}
SELECT i, j, round(CASE WHEN i = 0 AND j = 0 THEN 100.0
                        WHEN i >= 1 AND i < 3 AND j >= 0 AND j < 2 THEN -1.0 ELSE v END, 6) AS v FROM x
""")
def q_matrix_update(spark, sf_dir):
    """Set cell (0, 0) to 100 and the block rows 1-2, columns 0-1 to -1."""
    return _r(M.update(mat_x(spark, sf_dir), cell=(0, 0, 100.0), block=(1, 3, 0, 2, -1.0)), "v")

"""Blocked matrix operators against numpy."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from quire.operators import matrix as M


def _table(spark, cells):
    return spark.createDataFrame([(int(i), int(j), None if v is None else float(v)) for (i, j), v in cells.items()],
                                 "i bigint, j bigint, v double")


def _cells(df):
    return {(r["i"], r["j"]): r["v"] for r in df.collect()}


def _brute(a, b):
    out = {}
    for (i, k), x in a.items():
        for (j, l), y in b.items():
            if k == l and x is not None and y is not None:
                out[i, j] = out.get((i, j), 0.0) + x * y
    return out


@pytest.mark.parametrize("block", [1, 4, 7, 64])
@pytest.mark.parametrize("share", [0.2, 1.0])
def test_product_of_blocks(spark, block, share):
    rng = np.random.default_rng(block)
    a, b = ({(i, j): rng.normal() for i in range(n) for j in range(11) if rng.random() < share} for n in (9, 13))
    got, want = _cells(M.multiply_transposed(_table(spark, a), _table(spark, b), block)), _brute(a, b)
    assert got.keys() == want.keys()
    assert all(abs(got[k] - want[k]) < 1e-9 for k in want)


def test_product_of_odd_cells(spark):
    """Nulls are absent, infinite values meet present cells only, repeated cells add up, an empty side gives nothing."""
    a = {(0, 0): float("inf"), (0, 1): 2.0, (1, 1): 3.0, (2, 0): None}
    b = {(0, 1): 5.0, (1, 0): -1.0, (2, 9): 1.0}
    got = _cells(M.multiply_transposed(_table(spark, a), _table(spark, b), 4))
    assert got == {(0, 0): 10.0, (0, 1): float("-inf"), (1, 0): 15.0}
    twice = _table(spark, b).unionAll(_table(spark, b))
    assert _cells(M.multiply_transposed(_table(spark, a), twice, 4)) == {(0, 0): 20.0, (0, 1): float("-inf"), (1, 0): 30.0}
    assert _cells(M.multiply_transposed(_table(spark, a), _table(spark, b).limit(0), 4)) == {}


def test_few_inner_keys_have_many_meetings(spark):
    """Two inner keys and 6 x 5 row blocks: the dense products are keyed by all three block numbers."""
    a, b = (spark.range(n * 2).select((F.col("id") / 2).cast("bigint").alias("i"), (F.col("id") % 2).alias("j"), F.lit(1.0).alias("v"))
            for n in (60, 50))
    m = M.multiply_transposed(a, b, 10)
    assert m.count() == 3000 and m.filter("v <> 2").count() == 0
    assert "hashpartitioning(ar" in m._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("block", [1, 3, 100])
def test_broadcast_sum_and_fill(spark, block, monkeypatch):
    col, row = {(i, 0): i * 10.0 for i in (0, 1, 4)}, {(0, j): float(j) for j in (0, 2, 3, 8)}
    got = _cells(M.broadcast_add(_table(spark, col), _table(spark, row), block))
    assert got == {(i, j): x + y for (i, _), x in col.items() for (_, j), y in row.items()}
    monkeypatch.setattr(M, "BLOCK", 2)
    filled = _cells(M.fill(_table(spark, {(0, 10): 1.0, (3, 4): 1.0})))
    assert filled == {(i, j): float(i * 11 + j) for i in (0, 3) for j in range(11)}

"""Seeded sampling, balancing, splits, folds and batches.

Every random choice orders rows by ``md5(seed-id)`` (reproducible across
partitionings and engines).  Whole-table and whole-class ranks go through
:func:`quire.operators.ranking.bucketed_rank`, never through a window that
puts a whole table or a hot class into one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quire.functions.keys import hash_key
from quire.operators.ranking import bucketed_rank, ntile_of_rank


def _keyed(df: DataFrame, id_cols: Sequence[str], seed) -> DataFrame:
    return df.withColumn("__key", hash_key(seed, *id_cols))


def sample_n(df: DataFrame, n: int, id_cols: Sequence[str], seed=42) -> DataFrame:
    """N rows without replacement (all rows when fewer); the limit is
    the feature, planned as a distributed top-n (TakeOrderedAndProject)."""
    return _keyed(df, id_cols, seed).orderBy("__key").limit(n).drop("__key")


def sample_n_per_class(df: DataFrame, n: int, class_col: str, id_cols: Sequence[str], seed=42) -> DataFrame:
    """N seeded rows of every class (a per-class top-n: the window group
    limit keeps only n rows per class before the shuffle)."""
    w = Window.partitionBy(class_col).orderBy("__key")
    return (_keyed(df, id_cols, seed).withColumn("__rn", F.row_number().over(w))
            .filter(F.col("__rn") <= n).drop("__rn", "__key"))


def downsample_to_smallest(df: DataFrame, class_col: str, id_cols: Sequence[str], seed=42) -> DataFrame:
    """Every class cut to the size of the smallest class.

    The cut size is a scalar subquery; the per-class rank is bucketed, so a
    class holding a third of the table is ranked by many tasks."""
    smallest = df.groupBy(class_col).count().select(F.min("count")).scalar()
    r = bucketed_rank(_keyed(df, id_cols, seed), "__key", [class_col], rank_col="__rank")
    return r.filter(F.col("__rank") <= smallest).drop("__rank", "__key")


def random_split(df: DataFrame, id_cols: Sequence[str], train_share: float = 0.8, seed=42,
                 strata: Sequence[str] = ()) -> DataFrame:
    """Exact-size split; the first floor(share * n) rows of the seeded
    order (per stratum) are ``train``, the rest ``test``."""
    r = bucketed_rank(_keyed(df, id_cols, seed), "__key", list(strata), rank_col="__rank", size_col="__n")
    cut = F.floor(F.col("__n") * F.lit(train_share))
    return (r.withColumn("split", F.when(F.col("__rank") <= cut, "train").otherwise("test"))
            .drop("__rank", "__n", "__key"))


def stratified_folds(df: DataFrame, label_col: str, id_cols: Sequence[str], k: int = 5,
                     seed=42, shuffle: bool = True) -> DataFrame:
    """Fold 0..k-1 = ntile(k) over the seeded (or id) order inside each label."""
    if shuffle:
        d = _keyed(df, id_cols, seed)
        r = bucketed_rank(d, "__key", [label_col], rank_col="__rank", size_col="__n")
    else:
        d = df.withColumn("__key", F.lit(0))
        w = Window.partitionBy(label_col).orderBy(*id_cols)
        r = d.withColumn("__rank", F.row_number().over(w)) \
            .withColumn("__n", F.count(F.lit(1)).over(Window.partitionBy(label_col)))
    return r.withColumn("fold", ntile_of_rank(F.col("__rank"), F.col("__n"), k)).drop("__rank", "__n", "__key")


def batch_numbers(df: DataFrame, batch_size: int, id_cols: Sequence[str], seed=42) -> DataFrame:
    """Fixed-size batches over the seeded order (0-based batch number)."""
    r = bucketed_rank(_keyed(df, id_cols, seed), "__key", rank_col="__rank")
    return r.withColumn("batch", F.floor((F.col("__rank") - 1) / batch_size).cast("bigint")) \
        .drop("__rank", "__key")

"""Projection, label and aggregate helpers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quire.operators.ranking import range_rank


def clean_and_map_label(col: str, mapping: dict[str, int]) -> Column:
    """Cast to string, strip, delete '.', map listed strings, others null."""
    s = F.replace(F.trim(F.col(col).cast("string")), F.lit("."), F.lit(""))
    m = F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])
    return m[s]


def value_counts(df: DataFrame, col: str) -> DataFrame:
    """A1: rows per value."""
    return df.groupBy(col).agg(F.count(F.lit(1)).alias("cnt"))


def word_counts(df: DataFrame, text_col: str) -> DataFrame:
    """Blank-separated word counts (partial aggregation before the shuffle)."""
    w = df.select(F.explode(F.split(F.col(text_col), " ")).alias("word")).filter(F.col("word") != "")
    return w.groupBy("word").agg(F.count(F.lit(1)).alias("cnt"))


def top_k(df: DataFrame, k: int, order: Sequence[Column]) -> DataFrame:
    """Distributed top-k (TakeOrderedAndProject) plus its 1-based rank.
    The rank window runs over the k surviving rows only."""
    top = df.orderBy(*order).limit(k)
    return top.withColumn("rank", F.row_number().over(Window.orderBy(*order)).cast("bigint"))


def rank_labels(counts: DataFrame, count_col: str, name_col: str, first_rank: int = 1,
                labels: Sequence[str] = ("first", "second"), other: str = "other") -> DataFrame:
    """Rank names by count (desc, then name) and label ranks
    ``first_rank``, ``first_rank + 1``; the rest are ``other``.  The input has
    one row per name (already aggregated)."""
    r = range_rank(counts, [F.col(count_col).desc(), F.col(name_col).asc()])
    lab = F.lit(other)
    for i, name in reversed(list(enumerate(labels))):
        lab = F.when(F.col("rank") == first_rank + i, F.lit(name)).otherwise(lab)
    return r.withColumn("label", lab)


def label_encode(df: DataFrame, col: str) -> DataFrame:
    """Sorted distinct values -> 0..n-1 (the window runs over the
    distinct label set only)."""
    d = df.select(col).distinct()
    return d.withColumn("code", (F.dense_rank().over(Window.orderBy(col)) - 1).cast("bigint"))


def label_decode(pred: DataFrame, codes: DataFrame, code_col: str, col: str) -> DataFrame:
    """A12 inverse: code -> label (join with the small code table)."""
    return pred.join(codes.withColumnRenamed("code", code_col), code_col, "left")

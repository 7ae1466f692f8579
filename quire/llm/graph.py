"""Connected components of an edge table by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.llm.common import materialise


def _stars(edges: DataFrame, small: bool) -> DataFrame:
    """One star operation over directed pairs (u, v); v may equal nothing larger than u if ``small``.

    large: every larger neighbour v of u is linked with the least of u's neighbourhood;
    small: every smaller-or-equal neighbour of u, and u, are linked with their least.
    """
    if small:
        near = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    else:
        near = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = near.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
    moved = near.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    if small:
        moved = moved.union(least.select("u", F.col("m").alias("v")))
    else:
        moved = near.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.where("u <> v").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (u long, v long); root is the least node reachable.

    Large-star and small-star alternate until the edges stop changing; each
    round is two aggregations with partial minima and is written to the shared
    folder.  A node with very many neighbours only ever feeds a minimum and
    joins that adaptive execution may split.  No edges: an empty table.
    """
    edges = materialise(edges.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v"))
                        .where("u <> v").distinct(), "cc")
    mark = None
    while True:
        new = edges.select(F.count("*").alias("n"), F.sum(F.xxhash64(F.least("u", "v"), F.greatest("u", "v"))
                                                          .cast("decimal(38,0)")).alias("s")).first()
        if tuple(new) == mark or new["n"] == 0:
            break
        mark = tuple(new)
        edges = materialise(_stars(_stars(edges, small=False), small=True), "cc")
    roots = edges.select(F.greatest("u", "v").alias("node"), F.least("u", "v").alias("root"))
    return roots.union(roots.select(F.col("root").alias("node"), "root")).groupBy("node").agg(F.min("root").alias("root"))

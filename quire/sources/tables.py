"""Access to the parquet tables of a scale-factor folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def table(spark: SparkSession, sf_dir: str, name: str, spread: bool = False) -> DataFrame:
    """Read one table; ``spread=True`` for CPU-heavy text work (see :func:`spread`)."""
    if name not in TABLES:
        raise ValueError(f"unknown table {name!r}")
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return spread_rows(df) if spread else df


def spread_rows(df: DataFrame) -> DataFrame:
    """Round-robin the rows over the cluster when the scan yields fewer
    partitions than there are cores (a file with one row group is read by one
    task).  A large input already has many splits and is left untouched, so
    at scale this adds no shuffle."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() < cores:
        return df.repartition(cores)
    return df

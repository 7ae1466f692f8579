"""Spark session helpers.

Cluster settings win: nothing here overrides a value the cluster already set.
The checkpoint folder is read from ``spark.checkpoint.dir``; only when it is
unset (tests, local runs) do we point it at a fresh scratch folder.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # a shuffled join builds a hash table where every partition is this small, else it sorts and can spill
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64m",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # top-k per group: keep the partial WindowGroupLimit before the shuffle
    "spark.sql.optimizer.windowGroupLimitThreshold": "1000",
}


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app_name: str = "quire", driver_memory: str | None = None) -> SparkSession:
    """Session with the defaults above.  ``driver_memory`` only matters for
    local mode (the driver JVM is the executor there) and only before the
    JVM starts."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    if driver_memory:
        builder = builder.config("spark.driver.memory", driver_memory)
    for k, v in DEFAULTS.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    builder = builder.config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder; create a scratch one only if unset."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not conf_dir:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir is unset: point it at a folder shared by the cluster")
        conf_dir = tempfile.mkdtemp(prefix="quire-ckpt-")      # local runs and tests only
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir() or conf_dir


#: shuffle files go when the job that made them ends, not when the driver happens to collect its garbage
FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def _shuffles_freed(spark: SparkSession) -> Iterator[None]:
    before = spark.conf.get(FREE_SHUFFLES, "false")
    spark.conf.set(FREE_SHUFFLES, "true")
    try:
        yield
    finally:
        spark.conf.set(FREE_SHUFFLES, before)


def written(df: DataFrame, schema: StructType | None = None, compression: str = "zstd") -> DataFrame:
    """``df`` as Parquet in the shared checkpoint folder, read back (as ``schema``, by default its own).

    Cuts the lineage and survives the loss of executors; later scans prune
    columns, and the planner knows the size, so it can choose joins by it.
    What was shuffled for it is freed at once: only the table stays on disk.
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/quire-{uuid.uuid4().hex}"
    with _shuffles_freed(spark):
        df.write.parquet(path, compression=compression)
    return spark.read.schema(schema or df.schema).parquet(path)

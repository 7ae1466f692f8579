"""Helpers shared by the operators of this package.

Row keys: every operator takes the names of its id and text columns and reads
nothing else, so extra columns (whatever their names) never clash.
"""

from __future__ import annotations

import ctypes
import gc
import uuid

import pyarrow as pa
from pyspark import Broadcast, cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.session import ensure_checkpoint_dir

#: stands for a null id inside joins, so that such rows are neither lost nor matched to nothing
NULL_ID = -(1 << 63)

#: white space of the word contracts: U+0020 and U+0009 to U+000D
WORD_REGEX = r"[^\x20\x09-\x0D]+"

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def id_key(col: str | Column) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return F.coalesce(c.cast("long"), F.lit(NULL_ID))


def key_to_id(col: str | Column) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return F.when(c != F.lit(NULL_ID), c)


def ascii_lower(text: Column) -> Column:
    """A-Z to a-z and nothing else.  Pure ASCII strings take the fast built-in path."""
    plain = F.octet_length(text) == F.char_length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, UPPER, UPPER.lower()))


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh folder below the shared checkpoint folder of the session."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/quire-{name}-{uuid.uuid4().hex}"


#: Parquet looks after every row whether a row group is full, not after a hundred; a reader holds one group at a time
LARGE_ROWS = {"parquet.block.size": str(4 << 20), "parquet.block.size.row.check.min": "1", "parquet.block.size.row.check.max": "1",
              "parquet.page.size.row.check.min": "1", "parquet.page.size.row.check.max": "1"}


def materialise(df: DataFrame, name: str, large_rows: bool = False) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and read it back.

    Cuts the lineage like ``checkpoint()`` does (a lost executor costs nothing
    but the reads under way), but stays columnar: later scans prune columns.
    ``large_rows`` (of megabytes each) go to row groups of their own, so that
    neither the writer nor a reader gathers all that a task has.
    """
    spark = df.sparkSession
    path = shared_path(spark, name)
    df.write.options(**(LARGE_ROWS if large_rows else {})).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: broadcasts of this driver that :func:`release` has not freed yet
_sent: list[Broadcast] = []


def share(spark: SparkSession, value) -> Broadcast:
    """Broadcast of a value of bounded size, classes of this package included; tasks read it with :func:`shared`."""
    _sent.append(spark.sparkContext.broadcast(cloudpickle.dumps(value)))
    return _sent[-1]


def shared(value: Broadcast):
    give_back()
    return cloudpickle.loads(value.value)


def release() -> None:
    """Frees what :func:`share` has put on the executors; a frame that is evaluated after all fetches it anew."""
    while _sent:
        _sent.pop().unpersist()


def discard(value: Broadcast) -> None:
    """Ends a broadcast for good; nothing may be evaluated with it afterwards."""
    _sent[:] = [x for x in _sent if x is not value]
    value.destroy()


#: bytes of rows that go to a Python worker at a time (Spark's own default, 64 MB, is held several times over on both sides)
BATCH_BYTES = 4 << 20


def bound_batches(spark: SparkSession) -> None:
    """Smaller Arrow batches, unless the session has set a size of its own."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(name) == "67108864b":
        spark.conf.set(name, str(BATCH_BYTES))


def give_back() -> None:
    """Memory that earlier tasks of this Python worker have freed goes back to the system (Spark keeps its workers)."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):       # another C library
        pass

"""Ranks over whole tables or whole groups without a single-task window.

A ``row_number()`` whose partition is a whole table (or a hot group) sorts
all those rows in one task.  Here every row carries a bucket that is monotone
in the sort order (the leading hex digits of an md5 sort key, or any caller
supplied monotone bucket).  Rows are counted per (group, bucket); a running
sum over that small table gives each bucket's offset; the final rank is the
offset plus a ``row_number()`` inside the (group, bucket) partition.  No task
holds more than one bucket of one group.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quire.functions.keys import hash_bucket
from quire.session import written


def bucketed_rank(df: DataFrame, order_key: str, group_cols: Sequence[str] = (),
                  bucket: Column | None = None, digits: int = 4,
                  rank_col: str = "rank", size_col: str | None = None,
                  tiebreak: Sequence[str] = ()) -> DataFrame:
    """Add a 1-based ``rank_col`` ordered by ``order_key`` (then ``tiebreak``)
    within ``group_cols``; optionally ``size_col`` = rows in the group.

    ``bucket`` must be non-decreasing in the order; by default it is the
    leading ``digits`` hex digits of ``order_key`` (an md5 hex string).
    """
    g = list(group_cols)
    b = "__bucket"
    with_b = df.withColumn(b, bucket if bucket is not None else hash_bucket(F.col(order_key), digits))
    counts = with_b.groupBy(*g, b).agg(F.count(F.lit(1)).alias("__n"))
    w = Window.partitionBy(*g).orderBy(b)
    offsets = counts.select(
        *g, b,
        (F.sum("__n").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("__n"))
        .alias("__off"),
        *([F.sum("__n").over(Window.partitionBy(*g)).alias(size_col)] if size_col else []))
    inner = Window.partitionBy(*g, b).orderBy(order_key, *tiebreak)
    out = with_b.join(offsets, on=[*g, b], how="inner")
    out = out.withColumn(rank_col, (F.col("__off") + F.row_number().over(inner)).cast("bigint"))
    return out.drop(b, "__off")


def range_rank(df: DataFrame, order: Sequence[Column], group_cols: Sequence[str] = (), rank_col: str = "rank") -> DataFrame:
    """Add a 1-based ``rank_col`` by ``order`` within ``group_cols``, for any distribution of the keys.

    Spark's range partitioner samples the keys and cuts them into even ranges,
    so no bucket has to be chosen by hand; rows are numbered inside their range,
    and the ranges' row counts (one number per partition, summed up on the
    driver) give each its offset.  The ranged rows are written first: the
    sample, and so the ranges, could differ if they were made twice.  Rows with
    equal keys share a range, so add a unique column last.
    """
    g = list(group_cols)
    keys = [F.col(c).asc() for c in g] + list(order)
    rows = written(df.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("__at", F.monotonically_increasing_id()))
    part = F.shiftright("__at", 33)
    before, offsets = 0, []
    for r in rows.groupBy(part.alias("__part")).agg(F.count(F.lit(1)).alias("n")).orderBy("__part").collect():
        offsets.append((r["__part"], before))
        before += r["n"]
    starts = df.sparkSession.createDataFrame(offsets, "__part long, __before long")
    out = rows.withColumn("__part", part).join(F.broadcast(starts), "__part")
    out = out.withColumn(rank_col, F.col("__before") + F.col("__at").bitwiseAND(F.lit((1 << 33) - 1)) + 1)
    if g:
        out = out.join(out.groupBy(*g).agg(F.min(rank_col).alias("__first")), g)
        out = out.withColumn(rank_col, F.col(rank_col) - F.col("__first") + 1)
    return out.select(*df.columns, rank_col)


def join_groups(rows: DataFrame, groups: DataFrame, cols: Sequence[str]) -> DataFrame:
    """``rows`` with the other columns of ``groups``, of the one that equals in ``cols``, nulls too."""
    own = groups.withColumnsRenamed({c: f"__of_{c}" for c in cols})
    on = F.lit(True)
    for c in cols:
        on = on & F.col(c).eqNullSafe(F.col(f"__of_{c}"))
    return rows.join(own, on).drop(*[f"__of_{c}" for c in cols])


def running_sum(df: DataFrame, value: str, order: Sequence[Column], group_cols: Sequence[str], out_col: str) -> DataFrame:
    """Add the sum of ``value`` through each row by ``order`` within ``group_cols``, with no task that holds a whole group.

    As in :func:`range_rank`: even ranges of the order, sums inside them, and the sums of the ranges before (a row per range and group)."""
    g = list(group_cols)
    keys = [F.col(c).asc() for c in g] + list(order)
    rows = written(df.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("__at", F.monotonically_increasing_id()))
    rows = rows.withColumn("__part", F.shiftright("__at", 33))
    parts = rows.groupBy(*g, "__part").agg(F.sum(value).alias("__sum"))
    before = Window.partitionBy(*g).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select(*g, "__part", F.coalesce(F.sum("__sum").over(before), F.lit(0.0)).alias("__before"))
    inside = Window.partitionBy(*g, "__part").orderBy("__at").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    out = rows.withColumn("__inside", F.sum(value).over(inside))
    return join_groups(out, parts, [*g, "__part"]).select(*df.columns, (F.col("__before") + F.col("__inside")).alias(out_col))


def ntile_of_rank(rank: Column, n: Column, tiles: int) -> Column:
    """0-based ``ntile(tiles)`` bucket of a 1-based rank among n rows
    (the first ``n % tiles`` tiles get one extra row, as SQL ``ntile``)."""
    q = F.floor(n / tiles)
    rem = n - q * tiles
    big = rem * (q + 1)
    return F.when(rank <= big, F.floor((rank - 1) / (q + 1))) \
        .otherwise(rem + F.floor((rank - 1 - big) / q)).cast("bigint")

"""Mixing sources to target weights by Efraimidis-Spirakis sampling; DataFrame functions only.

Sources weigh 5, 2, 1, repeating in code point order (null last), and share the
words of all documents; a target stops at three times its source's size and
the excess is shared again by weight.  A source first takes as many complete
epochs as fit its target; the rest is a weighted sample without replacement:
documents in ascending order of ``-ln(u) / quality``, u uniform from the id,
up to the remaining budget.

The order inside a source is never built in one task: documents fall into
buckets of their key, the bucket sums give the bucket where the budget ends,
and only that bucket is sorted.  What is left of each source is one row (its
epochs and the key where the sample ends), by which every document is judged
where it stands, without moving its text.

Edge cases: null and empty texts have no words and are never needed for a
target; a null source is a source of its own, last in order; a source without
words has target 0; rows that repeat an id get the same key and each counts;
ties in the key go by id; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quire.llm.common import WORD_REGEX, id_key, key_to_id, materialise

WEIGHTS = (5, 2, 1)
MOST_EPOCHS = 3
BUCKETS = 4096
SEED = 20_240_229


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD_REGEX)), F.lit(0)).cast("long")


def quality_of(text: Column, size: Column) -> Column:
    """Weight from 0.25 to 1: highest where the mean word length is usual for prose (about six)."""
    mean = F.char_length(text) / F.greatest(size, F.lit(1))
    return F.coalesce(F.greatest(F.lit(0.25), 1.0 / (1.0 + F.abs(mean - 6.0) / 6.0)), F.lit(0.25))


def _measured(docs: DataFrame, id_col: str, text_col: str, source_col: str) -> dict[str, Column]:
    text = F.col(text_col).cast("string")
    size = word_count(text)
    uniform = (F.shiftrightunsigned(F.xxhash64(F.lit(SEED), id_key(id_col)), 11) + F.lit(1)) / float((1 << 53) + 1)
    key = -F.log(uniform) / quality_of(text, size)
    return {"_m_id": id_key(id_col), "_m_source": F.col(source_col).cast("string"), "_m_size": size, "_m_key": key,
            "_m_bucket": F.least(F.lit(BUCKETS - 1), F.floor((1.0 - F.exp(-key)) * BUCKETS)).cast("int")}


def targets(sources: DataFrame) -> DataFrame:
    """(_m_source, source_size, target) from one row per source: shares by weight, none above its cap."""
    order = Window.orderBy(F.col("_m_source").asc_nulls_last())
    weight = F.element_at(F.array(*map(F.lit, WEIGHTS)), (F.pmod(F.row_number().over(order) - 1, F.lit(len(WEIGHTS))) + 1).cast("int"))
    rows = sources.withColumn("w", weight.cast("double")).withColumn("cap", F.lit(float(MOST_EPOCHS)) * F.col("source_size"))
    everything = Window.partitionBy()
    before = Window.orderBy(F.col("cap") / F.col("w"), F.col("_m_source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    total, weights = F.sum("source_size").over(everything), F.sum("w").over(everything)
    level = ((total - F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
             / (weights - F.coalesce(F.sum("w").over(before), F.lit(0.0))))
    rows = rows.withColumn("level", level).withColumn("full", F.col("cap") / F.col("w") <= F.col("level"))
    common = F.max(F.when(~F.col("full"), F.col("level"))).over(everything)
    return rows.select("_m_source", "source_size", F.when(F.col("full"), F.col("cap")).otherwise(common * F.col("w")).alias("target"))


def _quotas(sized: DataFrame) -> DataFrame:
    """One row per source: its target, complete epochs, and where its fractional sample ends."""
    per_bucket = sized.groupBy("_m_source", "_m_bucket").agg(F.sum("_m_size").alias("n"))
    goal = targets(per_bucket.groupBy("_m_source").agg(F.sum("n").alias("source_size")))
    goal = (goal.withColumn("epochs", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size") + 1e-9)).otherwise(0).cast("int"))
            .withColumn("rest", F.greatest(F.lit(0.0), F.col("target") - F.col("epochs") * F.col("source_size"))))
    goal = materialise(goal, "targets")
    upto = Window.partitionBy("_m_source").orderBy("_m_bucket").rowsBetween(Window.unboundedPreceding, -1)
    place = per_bucket.withColumn("before", F.coalesce(F.sum("n").over(upto), F.lit(0)))
    g = goal.select(F.col("_m_source").alias("g_source"), "rest")
    edge = (place.join(g, F.col("_m_source").eqNullSafe(F.col("g_source")))
            .where((F.col("before") < F.col("rest")) & (F.col("before") + F.col("n") >= F.col("rest")))
            .select(F.col("_m_source").alias("e_source"), F.col("_m_bucket").alias("edge"), "before", "rest"))
    edge = materialise(edge, "edges")
    sums = Window.partitionBy("_m_source").orderBy("_m_key", "_m_id").rowsBetween(Window.unboundedPreceding, 0)
    near = (sized.join(edge, F.col("_m_source").eqNullSafe(F.col("e_source")) & (F.col("_m_bucket") == F.col("edge")))
            .withColumn("upto", F.col("before") + F.sum("_m_size").over(sums))
            .where(F.col("upto") - F.col("_m_size") / 2 <= F.col("rest"))
            .groupBy(F.col("_m_source").alias("c_source")).agg(F.max(F.struct("_m_key", "_m_id")).alias("cut")))
    out = (goal.join(edge.select("e_source", "edge"), F.col("_m_source").eqNullSafe(F.col("e_source")), "left")
           .join(near, F.col("_m_source").eqNullSafe(F.col("c_source")), "left"))
    return materialise(out.select(F.col("_m_source").alias("q_source"), "source_size", "target", "epochs", "edge", "cut"), "quotas")


def _copies(prefix: str = "") -> Column:
    """How often a document is taken, from its key and its source's row."""
    edge = F.col(f"{prefix}edge")
    at_edge = (F.col("_m_bucket") == edge) & (F.struct("_m_key", "_m_id") <= F.col(f"{prefix}cut"))
    chosen = F.coalesce((F.col("_m_bucket") < edge) | at_edge, F.lit(False))
    return F.col(f"{prefix}epochs") + chosen.cast("int")


def _sized(docs: DataFrame, id_col: str, text_col: str, source_col: str) -> DataFrame:
    cols = _measured(docs, id_col, text_col, source_col)
    return materialise(docs.select(*(c.alias(n) for n, c in cols.items())), "sized")


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """One row per document: id_col, size, source_size, target (its source's), taken (words the mix takes, repeats counted)."""
    sized = _sized(docs, id_col, text_col, source_col)
    rows = sized.join(_quotas(sized), F.col("_m_source").eqNullSafe(F.col("q_source")))
    return rows.select(key_to_id("_m_id").alias(id_col), F.col("_m_size").alias("size"), F.col("source_size").cast("long").alias("source_size"),
                       "target", (F.col("_m_size") * _copies()).cast("long").alias("taken"))


def take_mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """``docs`` in the mix: each document as many times as it is taken, all columns as they are, whatever their names."""
    quotas = _quotas(_sized(docs, id_col, text_col, source_col))
    quotas = quotas.toDF(*[f"_m_of_{c}" for c in quotas.columns])
    rows = docs.select("*", *(c.alias(n) for n, c in _measured(docs, id_col, text_col, source_col).items()))
    rows = rows.join(quotas, F.col("_m_source").eqNullSafe(F.col("_m_of_q_source")))
    rows = rows.withColumn("_m_copies", _copies("_m_of_")).where("_m_copies > 0")
    return rows.withColumn("_m_copy", F.explode(F.sequence(F.lit(1), F.col("_m_copies")))).select(*[F.col(f"`{c}`") for c in docs.columns])

"""Removal of lines that many documents share; DataFrame functions only.

Lines are exploded with their positions, normalised and hashed (two 64-bit
hashes); distinct documents are counted per hash in two aggregations, so a
line of a third of all documents reaches its final task pre-aggregated; the
positions of dropped lines go back to their documents, which keep the others
in order.

Edge cases: a null or empty text is one empty line; a document repeating a
line counts once for it; rows that repeat an id are one document when counting
and are each cut for themselves; a null id counts as the smallest id; an empty
table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.llm.common import ascii_lower, id_key, key_to_id, materialise

MIN_CHARS, MIN_DOCS = 40, 5
_TRIM = " \t\n\x0b\f\r"


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def shared_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = MIN_CHARS,
                 min_docs: int = MIN_DOCS) -> DataFrame:
    """(id, tid, positions): the lines of each document to drop."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    base = docs.select(id_key(id_col).alias("id"), F.xxhash64(text).alias("tid"), _lines(ascii_lower(text)).alias("lines"))
    key = F.btrim(F.col("line"), F.lit(_TRIM))
    rows = materialise(base.select("id", "tid", F.posexplode("lines").alias("pos", "line")).withColumn("line", key)
                       .where(F.char_length("line") >= min_chars)
                       .select("id", "tid", "pos", F.xxhash64("line").alias("h1"), F.xxhash64(F.lit(1), "line").alias("h2")), "lines")
    often = (rows.groupBy("h1", "h2", "id").agg(F.lit(1).alias("one")).groupBy("h1", "h2")
             .agg(F.count("*").alias("n"), F.max("id").alias("last")).where(F.col("n") >= min_docs).select("h1", "h2", "last"))
    return (rows.join(often, ["h1", "h2"]).where("id <> last").groupBy("id", "tid")
            .agg(F.collect_set("pos").alias("positions")))


def drop_shared_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = MIN_CHARS,
                      min_docs: int = MIN_DOCS) -> DataFrame:
    """One row per document: id_col, n_lines, n_dropped, kept_text."""
    drop = shared_lines(docs, id_col, text_col, min_chars, min_docs)
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    base = docs.select(id_key(id_col).alias("id"), F.xxhash64(text).alias("tid"), text.alias("text"))
    lines = _lines(F.col("text"))
    rows = (base.join(drop.hint("shuffle_hash"), ["id", "tid"], "left").withColumn("lines", lines)
            .withColumn("n_lines", F.size("lines").cast("long")))
    left = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), F.col("positions"))
    kept = F.when(F.col("positions").isNull(), F.col("text")).otherwise(
        F.array_join(F.transform(left, lambda p: F.get("lines", p)), "\n"))
    return rows.select(key_to_id("id").alias(id_col), "n_lines",
                       F.coalesce(F.size("positions"), F.lit(0)).cast("long").alias("n_dropped"), kept.alias("kept_text"))

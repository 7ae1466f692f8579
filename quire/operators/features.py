"""Feature building (F1-F9): relational TF-IDF, chi-square selection,
one-hot dummies, column alignment, standard scaling, vector rescaling.

TF-IDF is kept in long form ``(id, term, weight)``; the vocabulary is bounded
by ``max_features`` (so it may be broadcast), and everything else is joins
and aggregates.  Terms are counted inside their row, without a shuffle: the
document frequencies combine on the map side, and only the terms that the
vocabulary keeps are shuffled, by row id, for the row's norm.  Both travel as
compressed tables, one for each bucket of terms or ids.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quire.operators.gram_blocks import BLOCK_TOKENS, COUNT_BUCKETS, _dealt, _one, _packed_batches, _unpack

cloudpickle.register_pickle_by_value(sys.modules[__name__])      # tasks need no copy of the library

# --- fixed values that must equal the reference ---------------------------
TOKEN_RE = r"[\p{L}\p{N}_]{2,}"      # words of two or more word characters
MIN_DF, MAX_DF, MAX_FEATURES, K_BEST = 2, 0.4, 5000, 1000
# ---------------------------------------------------------------------------


def _count_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        terms = batch.column("terms")
        t = pa.table({"row": pc.list_parent_indices(terms), "term": pc.list_flatten(terms)})
        n = t.group_by(["row", "term"], use_threads=False).aggregate([([], "count_all")])
        out = pa.table([batch.column("id").take(n["row"].combine_chunks()), n["term"], n["count_all"]], names=["id", "term", "tf"])
        yield from out.to_batches(max_chunksize=1 << 16)


def term_frequencies(docs: DataFrame, id_col: str, text_col: str, ngram_max: int = 2) -> DataFrame:
    """(id, term, tf) of lower-cased word 1..ngram_max-grams; ids are unique.

    Word n-grams come from Spark ML's ``NGram`` (compiled per-row code), and
    are counted within each row by Arrow, so nothing is shuffled.  A null text
    or one without a word has no terms."""
    from pyspark.ml.feature import NGram
    words = F.regexp_extract_all(F.lower(F.coalesce(F.col(text_col), F.lit(""))), F.lit(TOKEN_RE), 0)
    d = docs.select(F.col(id_col).alias("id"), words.alias("__t1"))
    for n in range(2, ngram_max + 1):
        d = NGram(n=n, inputCol="__t1", outputCol=f"__t{n}").transform(d)
    t = d.select("id", F.concat(*[F.col(f"__t{n}") for n in range(1, ngram_max + 1)]).alias("terms"))
    id_type = t.schema["id"].dataType.simpleString()
    return t.mapInArrow(_count_terms, f"id {id_type}, term string, tf bigint")


def _bucket(col: str) -> Column:
    return F.pmod(F.xxhash64(col), F.lit(COUNT_BUCKETS)).alias("bucket")


def _summed(parts: list[pa.Table], by: list[str]) -> pa.Table:
    schema = pa.schema([(c, pa.string() if c == "term" else pa.int64()) for c in (*by, "df", "total_cnt")])
    t = pa.concat_tables([x.cast(schema) for x in parts])          # sums may be null, the counts that come in are not
    out = t.group_by(by, use_threads=False).aggregate([("df", "sum"), ("total_cnt", "sum")])
    return out.rename_columns({"df_sum": "df", "total_cnt_sum": "total_cnt"}).select([*by, "df", "total_cnt"])


def _term_parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(bucket, term, df, total_cnt) -> (bucket, packed (term, df, total_cnt)), added up as long as a task's terms stay few."""
    def deal(t: pa.Table) -> Iterator[pa.RecordBatch]:
        yield from _packed_batches("bucket", _dealt(t.drop_columns(["bucket"]), t.column("bucket").to_numpy()))
    held, size, kept = [], 0, 0
    for batch in batches:
        held.append(pa.Table.from_batches([batch]))
        size += len(batch)
        if size - kept >= BLOCK_TOKENS:
            held = [_summed(held, ["bucket", "term"])]
            size = kept = len(held[0])
            if size >= 2 * BLOCK_TOKENS:
                yield from deal(held[0])
                held, size, kept = [], 0, 0
    if size:
        yield from deal(_summed(held, ["bucket", "term"]))


def _term_sums(t: pa.Table) -> pa.Table:
    return _summed(_unpack(t.column("packed")), ["term"])


def term_statistics(tf: DataFrame) -> DataFrame:
    """(term, df, total_cnt): the rows of each term in ``tf(id, term, tf)`` and their sum."""
    rows = tf.select(_bucket("term"), "term", F.lit(1).cast("long").alias("df"), F.col("tf").cast("long").alias("total_cnt"))
    parts = rows.mapInArrow(_term_parts, "bucket long, packed binary")
    return parts.groupBy("bucket").applyInArrow(_term_sums, "term string, df long, total_cnt long")


def tfidf_fit(docs: DataFrame, id_col: str, text_col: str, min_df: int = MIN_DF, max_df: float = MAX_DF,
              max_features: int = MAX_FEATURES, ngram_max: int = 2, tf: DataFrame | None = None) -> DataFrame:
    """vocabulary ``(term, df, total_cnt, idf)``.

    Keep min_df <= df <= max_df * N, then the max_features terms with the
    largest total count (ties: smaller term); idf = ln((1 + N) / (1 + df)) + 1.
    ``tf`` may pass precomputed term frequencies of ``docs``.
    """
    n_docs = docs.select(F.count(F.lit(1))).scalar()
    tf = term_frequencies(docs, id_col, text_col, ngram_max) if tf is None else tf
    st = term_statistics(tf).filter((F.col("df") >= min_df) & (F.col("df") <= F.lit(max_df) * n_docs))
    top = st.orderBy(F.desc("total_cnt"), F.asc("term")).limit(max_features)
    return top.select("term", "df", "total_cnt",
                      (F.log((F.lit(1) + n_docs) / (F.lit(1) + F.col("df"))) + 1).alias("idf"))


def tfidf_transform(docs: DataFrame, vocab: DataFrame, id_col: str, text_col: str,
                    ngram_max: int = 2, tf: DataFrame | None = None) -> DataFrame:
    """``(id, term, weight)`` = (1 + ln tf) * idf, L2-normalised per
    row over the vocabulary terms; terms outside the vocabulary are dropped.
    The vocabulary is bounded by ``max_features``, so it is broadcast; the
    norm window shuffles the kept terms only."""
    tf = term_frequencies(docs, id_col, text_col, ngram_max) if tf is None else tf
    w = tf.join(F.broadcast(vocab.select("term", "idf")), "term")
    w = w.select(_bucket("id"), "id", "term", ((1 + F.log("tf")) * F.col("idf")).alias("w")).mapInArrow(_row_parts, "bucket long, packed binary")
    return w.groupBy("bucket").applyInArrow(_normalised, f"id {dict(tf.dtypes)['id']}, term string, weight double")


def _row_parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(bucket, id, term, w) -> (bucket, packed (id, term, w))."""
    def deal(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = pa.Table.from_batches(held)
        yield from _packed_batches("bucket", _dealt(t.drop_columns(["bucket"]), t.column("bucket").to_numpy()))
    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += len(batch)
        if size >= BLOCK_TOKENS:
            yield from deal(held)
            held, size = [], 0
    if size:
        yield from deal(held)


def _normalised(t: pa.Table) -> pa.Table:
    """A bucket's rows (id, term, w) -> (id, term, weight), of length 1 by id."""
    rows = pa.concat_tables(_unpack(t.column("packed")))
    own = _one(rows.column("id").combine_chunks().dictionary_encode(null_encoding="encode")).indices.to_numpy()
    w = rows.column("w").to_numpy()
    weight = w / np.sqrt(np.bincount(own, weights=w * w))[own]
    return pa.table({"id": rows.column("id"), "term": rows.column("term"), "weight": pa.array(weight)})


def chi2_scores(weights: DataFrame, classes: DataFrame, class_col: str = "class") -> DataFrame:
    """chi-square of class sums of feature values.

    ``weights(id, term, weight)``, ``classes(id, class)``.  observed =
    per-class weight sums, expected = class share * term total; the sum runs
    over every class (a class with no weight still contributes)."""
    n_docs = classes.select(F.count(F.lit(1))).scalar()
    share = classes.groupBy(class_col).agg((F.count(F.lit(1)) / n_docs).alias("share"))
    all_c = share.select(F.sort_array(F.collect_list(F.struct(class_col, "share")))).scalar()
    obs = weights.join(classes, "id").groupBy("term", class_col).agg(F.sum("weight").alias("obs"))
    tot = obs.groupBy("term").agg(F.sum("obs").alias("fc"))
    grid = tot.select("term", "fc", F.explode(all_c).alias("c")) \
        .select("term", "fc", F.col("c")[class_col].alias(class_col), F.col("c.share").alias("share"))
    g = grid.join(obs, ["term", class_col], "left").withColumn("obs", F.coalesce("obs", F.lit(0.0)))
    e = F.col("share") * F.col("fc")
    return g.groupBy("term").agg(F.sum((F.col("obs") - e) * (F.col("obs") - e) / e).alias("chi2"))


def chi2_select(weights: DataFrame, classes: DataFrame, k: int = K_BEST, class_col: str = "class") -> DataFrame:
    """the k terms with the largest chi-square (ties: smaller term)."""
    s = chi2_scores(weights, classes, class_col).withColumn("__r9", F.round("chi2", 9))
    top = s.orderBy(F.desc("__r9"), F.asc("term")).limit(k)
    w = Window.orderBy(F.desc("__r9"), F.asc("term"))
    return top.withColumn("rank", F.row_number().over(w).cast("bigint")).drop("__r9")


def sparse_rows(weights: DataFrame, terms: DataFrame, rows: DataFrame) -> DataFrame:
    """``(id, terms array<int>, weights array<double>, ...)`` for every row of ``rows(id, ...)``, from the long form
    ``weights(id, term, weight)`` and the selected ``terms(term, idx)``; a row without a selected term has empty arrays."""
    own = (weights.join(terms.select("term", "idx"), "term").groupBy("id")
           .agg(F.sort_array(F.collect_list(F.struct("idx", "weight"))).alias("__s")))
    empty = F.coalesce(F.col("__s"), F.array().cast("array<struct<idx:int,weight:double>>"))
    return rows.join(own, "id", "left").withColumn("__s", empty).select(
        *rows.columns, F.col("__s.idx").alias("terms"), F.col("__s.weight").alias("weights"))


def standard_scale(df: DataFrame, cols: Sequence[str], fit: DataFrame | None = None) -> DataFrame:
    """(x - mean) / population std, std 0 -> 1; statistics come from
    ``fit`` (default: ``df``) as one struct-valued scalar subquery."""
    src = df if fit is None else fit
    stats = src.select(F.struct(*[F.avg(c).alias(f"m_{i}") for i, c in enumerate(cols)],
                                *[F.stddev_pop(c).alias(f"s_{i}") for i, c in enumerate(cols)])).scalar()
    out = []
    for i, c in enumerate(cols):
        s = stats.getField(f"s_{i}")
        s = F.when(s == 0, F.lit(1.0)).otherwise(s)
        out.append(((F.col(c) - stats.getField(f"m_{i}")) / s).alias(c))
    keep = [c for c in df.columns if c not in cols]
    return df.select(*keep, *out)


def one_hot_long(df: DataFrame, id_col: str, cols: Sequence[str], drop_first: bool = True) -> DataFrame:
    """long-form dummies ``(id, feature)`` with feature = col_value; the
    first category of each column in sort order is dropped."""
    stacked = df.select(F.col(id_col).alias("id"), F.explode(F.array(*[
        F.struct(F.lit(c).alias("col"), F.col(c).cast("string").alias("value")) for c in cols])).alias("s"))
    stacked = stacked.select("id", "s.col", "s.value").filter(F.col("value").isNotNull())
    cats = stacked.select("col", "value").distinct()
    if drop_first:
        first = cats.groupBy("col").agg(F.min("value").alias("first"))
        stacked = stacked.join(first, "col").filter(F.col("value") != F.col("first")).drop("first")
    return stacked.select("id", F.concat_ws("_", "col", "value").alias("feature"))


def align_columns(test_long: DataFrame, train_features: DataFrame) -> DataFrame:
    """F8: keep only training features (missing = 0 is implicit in long
    form; extra test features are dropped) -- a left semi join."""
    return test_long.join(train_features.select("feature").distinct(), "feature", "left_semi")


def pivot_wide(long: DataFrame, features: list[str]) -> DataFrame:
    """Wide 0/1 matrix from long dummies for a known (bounded) feature list."""
    return (long.withColumn("v", F.lit(1)).groupBy("id").pivot("feature", features).agg(F.max("v"))
            .fillna(0))


def rescale(vec: Column, mean: float | Sequence[float] = 0.5, std: float | Sequence[float] = 0.5,
            channel_size: int = 1) -> Column:
    """(x - m) / s with scalar or per-channel constants; a flattened
    channel-first image has channel = index // channel_size."""
    if isinstance(mean, (int, float)) and isinstance(std, (int, float)):
        return F.transform(vec, lambda x: (x - F.lit(float(mean))) / F.lit(float(std)))
    m = F.array(*[F.lit(float(x)) for x in mean])
    s = F.array(*[F.lit(float(x)) for x in std])
    return F.transform(vec, lambda x, i: (x - F.element_at(m, F.floor(i / channel_size).cast("int") + 1))
                       / F.element_at(s, F.floor(i / channel_size).cast("int") + 1))


def unscale(vec: Column, mean: float = 0.5, std: float = 0.5) -> Column:
    """F9 inverse: x * s + m."""
    return F.transform(vec, lambda x: x * F.lit(float(std)) + F.lit(float(mean)))

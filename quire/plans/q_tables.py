"""Projection / filter / aggregate / ranking / sampling queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quire.functions import text as T
from quire.functions.keys import hash_key
from quire.operators import ngrams as N
from quire.operators import sampling as R
from quire.operators.tables import (clean_and_map_label, label_encode, rank_labels, top_k,
                                    value_counts, word_counts)
from quire.plans.common import SQL_DOC_SENTENCES, doc_sentences
from quire.plans.q_text import _sql_clean
from quire.plans.registry import query
from quire.sources.tables import table

SEED = 42
LABEL_MAP = {"BUILDING": 0, "AUTOMOBILE": 1}     # stand-in for <=50K / >50K


def _t(spark, sf_dir, name, spread=False) -> DataFrame:
    return table(spark, sf_dir, name, spread=spread)


SQL_LABEL = ("CASE replace(trim(CAST(c_mktsegment AS VARCHAR)), '.', '') "
             + " ".join(f"WHEN '{k}' THEN {v}" for k, v in LABEL_MAP.items()) + " END")


# ------------------------------------------------------------------ P1-P10
@query("filter_equals", "SELECT doc_id, source FROM documents WHERE lang = 'en'")
def q_filter_equals(spark, sf_dir):
    """Rows of one type."""
    return _t(spark, sf_dir, "documents").filter(F.col("lang") == "en").select("doc_id", "source")


@query("filter_in_set", "SELECT doc_id, source FROM documents WHERE source IN ('src0', 'src1')")
def q_filter_in_set(spark, sf_dir):
    """Rows whose class is in a list."""
    return _t(spark, sf_dir, "documents").filter(F.col("source").isin("src0", "src1")).select("doc_id", "source")


@query("filter_less_than", "SELECT vec_id, label FROM embeddings WHERE label < 4")
def q_filter_less_than(spark, sf_dir):
    """First four classes only."""
    return _t(spark, sf_dir, "embeddings").filter(F.col("label") < 4).select("vec_id", "label")


@query("clean_and_map_label", f"SELECT c_custkey, {SQL_LABEL} AS label FROM customer")
def q_clean_and_map_label(spark, sf_dir):
    """Cast, strip, delete '.', map two strings to 0/1, else null."""
    c = _t(spark, sf_dir, "customer")
    return c.select("c_custkey", clean_and_map_label("c_mktsegment", LABEL_MAP).alias("label"))


@query("drop_null_target", f"""
SELECT c_custkey, label FROM (SELECT c_custkey, {SQL_LABEL} AS label FROM customer) WHERE label IS NOT NULL
""")
def q_drop_null_target(spark, sf_dir):
    """Drop rows whose mapped target is null."""
    return q_clean_and_map_label(spark, sf_dir).dropna(subset=["label"])


@query("count_nulls", f"""
SELECT count(*) FILTER (WHERE label IS NULL) AS n_null FROM (SELECT {SQL_LABEL} AS label FROM customer)
""")
def q_count_nulls(spark, sf_dir):
    """P5: number of nulls in a column."""
    return q_clean_and_map_label(spark, sf_dir).agg(
        F.sum(F.col("label").isNull().cast("long")).alias("n_null"))


@query("replace_cell_value", """
SELECT c_custkey, c_name, c_nationkey, c_acctbal,
       CASE WHEN c_acctbal < 0 THEN 'Unknown' WHEN c_custkey % 10 = 0 THEN c_mktsegment || '?' ELSE c_mktsegment END AS c_mktsegment
FROM customer
""")
def q_replace_cell_value(spark, sf_dir):
    """Whole-cell '?' -> 'Unknown' in every string column (the segment of customers in debt is '?'; a longer
    cell with a '?' in it stays)."""
    segment = (F.when(F.col("c_acctbal") < 0, "?").when(F.col("c_custkey") % 10 == 0, F.concat("c_mktsegment", F.lit("?")))
               .otherwise(F.col("c_mktsegment")))
    c = _t(spark, sf_dir, "customer").withColumn("c_mktsegment", segment)
    strings = [f.name for f in c.schema.fields if f.dataType.simpleString() == "string"]
    return c.replace("?", "Unknown", subset=strings)


@query("rename_drop_columns", """
SELECT c_custkey AS id, c_nationkey AS nation, c_acctbal AS balance, c_mktsegment AS segment FROM customer
""")
def q_rename_drop_columns(spark, sf_dir):
    """Rename and drop columns."""
    c = _t(spark, sf_dir, "customer").drop("c_name")
    return c.toDF("id", "nation", "balance", "segment")


@query("cast_columns", """
SELECT CAST(o_orderkey AS DOUBLE) AS o_orderkey, CAST(o_custkey AS DOUBLE) AS o_custkey FROM orders
""")
def q_cast_columns(spark, sf_dir):
    """Numeric casts of id columns."""
    o = _t(spark, sf_dir, "orders")
    return o.select(F.col("o_orderkey").cast("double").alias("o_orderkey"),
                    F.col("o_custkey").cast("double").alias("o_custkey"))


@query("distinct_values", "SELECT DISTINCT c_mktsegment FROM customer")
def q_distinct_values(spark, sf_dir):
    """P10: unique values of a column."""
    return _t(spark, sf_dir, "customer").select("c_mktsegment").distinct()


# ------------------------------------------------------------------ A1-A12
@query("value_counts", "SELECT lang, count(*) AS cnt FROM documents GROUP BY lang")
def q_value_counts(spark, sf_dir):
    """A1: rows per value (descending when ordered)."""
    return value_counts(_t(spark, sf_dir, "documents"), "lang")


@query("table_shape", "SELECT count(*) AS n_rows, CAST(5 AS BIGINT) AS n_cols FROM documents")
def q_table_shape(spark, sf_dir):
    """A2: rows and columns."""
    d = _t(spark, sf_dir, "documents")
    return d.agg(F.count(F.lit(1)).alias("n_rows")).withColumn("n_cols", F.lit(len(d.columns)).cast("bigint"))


@query("mean_text_length", """
SELECT round(avg(length(text)), 6) AS mean_chars,
       round(avg(len(list_filter(string_split_regex(text, '\\s+'), lambda t: t <> ''))), 6) AS mean_words
FROM documents
""")
def q_mean_text_length(spark, sf_dir):
    """A3: mean characters and mean words per row."""
    d = _t(spark, sf_dir, "documents", spread=True)
    return d.agg(F.round(F.avg(F.length("text")), 6).alias("mean_chars"),
                 F.round(F.avg(T.whitespace_token_count("text")), 6).alias("mean_words"))


SQL_WORDS = f"""
words AS (
  SELECT u.w, count(*) AS cnt
  FROM (SELECT {_sql_clean('text')} AS c FROM documents) d, unnest(string_split(c, ' ')) AS u(w)
  WHERE u.w <> '' GROUP BY u.w
)"""


@query("top_words", f"""
WITH {SQL_WORDS}
SELECT CAST(row_number() OVER (ORDER BY cnt DESC, w) AS BIGINT) AS rank, w AS word, cnt
FROM words ORDER BY cnt DESC, w LIMIT 10
""")
def q_top_words(spark, sf_dir):
    """A4 (+ A8): the 10 most frequent words of the cleaned corpus."""
    d = _t(spark, sf_dir, "documents", spread=True).select(T.clean_lyrics("text").alias("c"))
    wc = word_counts(d, "c")
    return top_k(wc, 10, [F.desc("cnt"), F.asc("word")]).select("rank", "word", "cnt")


@query("word_weights", f"""
WITH {SQL_WORDS}
SELECT w AS word, round(cnt / (SELECT max(cnt) FROM words), 6) AS weight FROM words
""")
def q_word_weights(spark, sf_dir):
    """A5: word frequency relative to the most frequent word (scalar-subquery maximum)."""
    d = _t(spark, sf_dir, "documents", spread=True).select(T.clean_lyrics("text").alias("c"))
    wc = word_counts(d, "c")
    top = wc.select(F.max("cnt")).scalar()
    return wc.select("word", F.round(F.col("cnt") / top, 6).alias("weight"))


@query("count_distinct_documents", f"""
WITH {SQL_DOC_SENTENCES}
SELECT lang, count(DISTINCT doc_id) AS n_documents FROM sentences GROUP BY lang
""")
def q_count_distinct_documents(spark, sf_dir):
    """Distinct documents per corpus."""
    s = doc_sentences(spark, sf_dir)
    return s.groupBy("lang").agg(F.count_distinct("doc_id").alias("n_documents"))


@query("rank_speakers", f"""
WITH {SQL_DOC_SENTENCES},
c AS (SELECT source, count(*) AS n_sentences FROM sentences GROUP BY source),
r AS (SELECT *, CAST(row_number() OVER (ORDER BY n_sentences DESC, source) AS BIGINT) AS rank FROM c)
SELECT source, n_sentences, rank,
       CASE WHEN rank = 1 THEN 'first' WHEN rank = 2 THEN 'second' ELSE 'other' END AS label FROM r
""")
def q_rank_speakers(spark, sf_dir):
    """Sentences per speaker, ranked; ranks 1 and 2 labelled first / second."""
    s = doc_sentences(spark, sf_dir)
    c = s.groupBy("source").agg(F.count(F.lit(1)).alias("n_sentences"))
    return rank_labels(c, "n_sentences", "source", first_rank=1)


@query("top_k", "SELECT doc_id, n_chars FROM documents ORDER BY n_chars DESC, doc_id LIMIT 10")
def q_top_k(spark, sf_dir):
    """First k of a sort (distributed top-k)."""
    d = _t(spark, sf_dir, "documents").select("doc_id", "n_chars")
    return d.orderBy(F.desc("n_chars"), F.asc("doc_id")).limit(10)


@query("first_n_rows", "SELECT doc_id, lang FROM documents ORDER BY doc_id LIMIT 10")
def q_first_n_rows(spark, sf_dir):
    """head(n) in id order."""
    return _t(spark, sf_dir, "documents").select("doc_id", "lang").orderBy("doc_id").limit(10)


@query("union_rows", """
SELECT doc_id, 'quality' AS part FROM labels WHERE quality = 1
UNION ALL SELECT doc_id, 'toxic' AS part FROM labels WHERE toxic = 1
""")
def q_union_rows(spark, sf_dir):
    """A10: concatenate two selections."""
    lab = _t(spark, sf_dir, "labels")
    a = lab.filter(F.col("quality") == 1).select("doc_id", F.lit("quality").alias("part"))
    b = lab.filter(F.col("toxic") == 1).select("doc_id", F.lit("toxic").alias("part"))
    return a.unionByName(b)


@query("intersect_keys", f"""
WITH {SQL_DOC_SENTENCES},
g AS (
  SELECT lang, doc_id, u.gram FROM (SELECT lang, doc_id, list_concat(['s_1'], tokens, ['s_2']) AS p FROM sentences) s,
       unnest(list_transform(range(1, len(p)), lambda i: array_to_string(p[i:i + 1], ' '))) AS u(gram)
),
valid AS (SELECT lang, gram FROM g WHERE NOT list_has_any(string_split(gram, ' '), ['s_1', 's_2'])
          GROUP BY lang, gram HAVING count(*) >= 5)
SELECT lang, doc_id, count(*) AS n_valid_grams FROM (SELECT DISTINCT lang, doc_id, gram FROM g) d
WHERE EXISTS (SELECT 1 FROM valid v WHERE v.lang = d.lang AND v.gram = d.gram)
GROUP BY lang, doc_id
""")
def q_intersect_keys(spark, sf_dir):
    """Bigrams valid corpus-wide (count >= 5) present in each document (left semi join)."""
    s = doc_sentences(spark, sf_dir).withColumnRenamed("lang", "corpus")
    g = N.frequent_ngrams(s.select("corpus", "doc_id", F.col("tokens").alias("t")), (2,), 5, "doc_id").per_document()
    return g.select(F.col("corpus").alias("lang"), F.col("doc").alias("doc_id"), F.col("n_grams").alias("n_valid_grams"))


@query("numeric_label_encode", """
SELECT source, CAST(dense_rank() OVER (ORDER BY source) - 1 AS BIGINT) AS code FROM (SELECT DISTINCT source FROM documents)
""")
def q_numeric_label_encode(spark, sf_dir):
    """Sorted distinct labels -> 0..n-1."""
    return label_encode(_t(spark, sf_dir, "documents"), "source")


# ------------------------------------------------------------------ R1-R9
def _md5(expr: str) -> str:
    return f"md5('{SEED}-' || CAST({expr} AS VARCHAR))"


@query("sample_n", f"SELECT doc_id FROM documents ORDER BY {_md5('doc_id')} LIMIT 10")
def q_sample_n(spark, sf_dir):
    """10 seeded random rows."""
    return R.sample_n(_t(spark, sf_dir, "documents").select("doc_id"), 10, ["doc_id"], SEED)


@query("shuffle_take", f"SELECT doc_id FROM documents ORDER BY {_md5('doc_id')} LIMIT 500")
def q_shuffle_take(spark, sf_dir):
    """R2: seeded shuffle, first 500."""
    return R.sample_n(_t(spark, sf_dir, "documents").select("doc_id"), 500, ["doc_id"], SEED)


@query("sample_n_per_class", f"""
SELECT doc_id, quality FROM (
  SELECT doc_id, quality, row_number() OVER (PARTITION BY quality ORDER BY {_md5('doc_id')}) AS rn FROM labels
) WHERE rn <= 25
""")
def q_sample_n_per_class(spark, sf_dir):
    """25 seeded rows of each class."""
    lab = _t(spark, sf_dir, "labels").select("doc_id", "quality")
    return R.sample_n_per_class(lab, 25, "quality", ["doc_id"], SEED)


@query("downsample_to_smallest", f"""
SELECT doc_id, lang FROM (
  SELECT doc_id, lang, row_number() OVER (PARTITION BY lang ORDER BY {_md5('doc_id')}) AS rn FROM documents
) WHERE rn <= (SELECT min(c) FROM (SELECT count(*) AS c FROM documents GROUP BY lang))
""")
def q_downsample_to_smallest(spark, sf_dir):
    """Every class cut to the smallest class size."""
    d = _t(spark, sf_dir, "documents").select("doc_id", "lang")
    return R.downsample_to_smallest(d, "lang", ["doc_id"], SEED)


@query("downsample_majority", f"""
SELECT doc_id, quality FROM (
  SELECT doc_id, quality, row_number() OVER (PARTITION BY quality ORDER BY {_md5('doc_id')}) AS rn FROM labels
) WHERE rn <= (SELECT min(c) FROM (SELECT count(*) AS c FROM labels GROUP BY quality))
""")
def q_downsample_majority(spark, sf_dir):
    """Two classes; the larger one cut to the smaller one."""
    lab = _t(spark, sf_dir, "labels").select("doc_id", "quality")
    return R.downsample_to_smallest(lab, "quality", ["doc_id"], SEED)


@query("random_split", f"""
SELECT doc_id, CASE WHEN row_number() OVER (ORDER BY {_md5('doc_id')}) <= floor(0.8 * count(*) OVER ())
       THEN 'train' ELSE 'test' END AS split FROM documents
""")
def q_random_split(spark, sf_dir):
    """Exact 80 / 20 split over the seeded order."""
    return R.random_split(_t(spark, sf_dir, "documents").select("doc_id"), ["doc_id"], 0.8, SEED)


@query("stratified_split", f"""
SELECT doc_id, lang, CASE WHEN row_number() OVER (PARTITION BY lang ORDER BY {_md5('doc_id')})
       <= floor(0.8 * count(*) OVER (PARTITION BY lang)) THEN 'train' ELSE 'test' END AS split FROM documents
""")
def q_stratified_split(spark, sf_dir):
    """80 / 20 inside each label."""
    d = _t(spark, sf_dir, "documents").select("doc_id", "lang")
    return R.random_split(d, ["doc_id"], 0.8, SEED, strata=["lang"])


@query("stratified_folds", f"""
SELECT vec_id, label, CAST(ntile(5) OVER (PARTITION BY label ORDER BY {_md5('vec_id')}) - 1 AS BIGINT) AS fold
FROM embeddings
""")
def q_stratified_folds(spark, sf_dir):
    """5 seeded folds, each with the class mix."""
    e = _t(spark, sf_dir, "embeddings").select("vec_id", "label")
    return R.stratified_folds(e, "label", ["vec_id"], 5, SEED)


@query("batch_numbers", f"""
SELECT l_orderkey, l_linenumber,
       CAST(floor((row_number() OVER (ORDER BY md5('{SEED}-' || CAST(l_orderkey AS VARCHAR) || '-' ||
             CAST(l_linenumber AS VARCHAR))) - 1) / 64) AS BIGINT) AS batch
FROM lineitem
""")
def q_batch_numbers(spark, sf_dir):
    """Seeded batches of 64 over the whole lineitem table."""
    li = _t(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber")
    return R.batch_numbers(li, 64, ["l_orderkey", "l_linenumber"], SEED)

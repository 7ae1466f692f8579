"""Feature queries.

TF-IDF corpus: every kept ``documents`` sentence; its class is the rank
label (first / second / other) of its ``source`` by sentence count (A7).
Unseen sentences: ``benchmark``.  Categorical table: ``customer`` joined
to ``nation``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.functions import text as T
from quire.operators import features as FT
from quire.operators.sampling import downsample_to_smallest, random_split, stratified_folds
from quire.operators.tables import label_encode, rank_labels
from quire.plans.common import SQL_DOC_SENTENCES, doc_sentences
from quire.plans.registry import query
from quire.session import written
from quire.sources.tables import table

SEED = 42


def tfidf_docs(spark, sf_dir) -> DataFrame:
    """Tokenised sentences, written once in the shared checkpoint folder:
    the TF-IDF / chi-square plans read them four times (terms, row count,
    class ranks, class shares), and the regex work should run once."""
    s = doc_sentences(spark, sf_dir)
    return written(s.select(F.concat_ws("-", "doc_id", "para_no", "sent_no").alias("id"), "source", "lang",
                    "doc_id", "para_no", "sentence_text"))


def doc_classes(docs: DataFrame) -> DataFrame:
    c = docs.groupBy("source").agg(F.count(F.lit(1)).alias("n"))
    lab = rank_labels(c, "n", "source", first_rank=1)
    # a row per source: sent to the sentences, which a few sources would else deal out to a few tasks
    return docs.join(F.broadcast(lab.select("source", F.col("label").alias("class"))), "source").select("id", "class")


SQL_TFIDF = f"""
{SQL_DOC_SENTENCES},
docs AS (SELECT concat_ws('-', doc_id, para_no, sent_no) AS id, source, sentence_text FROM sentences),
nd AS (SELECT count(*) AS n FROM docs),
toks AS (SELECT id, regexp_extract_all(lower(sentence_text), '{FT.TOKEN_RE}', 0) AS t FROM docs),
terms AS (
  SELECT id, u.term FROM toks, unnest(t) AS u(term)
  UNION ALL SELECT id, array_to_string(t[i:i + 1], ' ') FROM toks, unnest(range(1, len(t))) AS r(i)
),
tf AS (SELECT id, term, count(*) AS tf FROM terms GROUP BY id, term),
st AS (SELECT term, count(*) AS df, sum(tf) AS total_cnt FROM tf GROUP BY term),
vocab AS (SELECT term, df, CAST(total_cnt AS BIGINT) AS total_cnt, ln((1 + (SELECT n FROM nd)) / (1 + df)) + 1 AS idf
          FROM st WHERE df >= {FT.MIN_DF} AND df <= {FT.MAX_DF} * (SELECT n FROM nd)
          ORDER BY total_cnt DESC, term LIMIT {FT.MAX_FEATURES}),
w0 AS (SELECT id, term, (1 + ln(tf)) * idf AS w FROM tf JOIN vocab USING (term)),
w AS (SELECT id, term, w / sqrt(sum(w * w) OVER (PARTITION BY id)) AS weight FROM w0),
sc AS (SELECT source, count(*) AS n FROM docs GROUP BY source),
rk AS (SELECT source, CASE row_number() OVER (ORDER BY n DESC, source) WHEN 1 THEN 'first' WHEN 2 THEN 'second'
                      ELSE 'other' END AS class FROM sc),
cls AS (SELECT id, class FROM docs JOIN rk USING (source)),
share AS (SELECT class, count(*) / (SELECT n FROM nd) AS share FROM cls GROUP BY class),
obs AS (SELECT term, class, sum(weight) AS obs FROM w JOIN cls USING (id) GROUP BY term, class),
fc AS (SELECT term, sum(obs) AS fc FROM obs GROUP BY term),
chi AS (
  SELECT g.term, sum((coalesce(o.obs, 0) - g.share * g.fc) * (coalesce(o.obs, 0) - g.share * g.fc) / (g.share * g.fc)) AS chi2
  FROM (SELECT term, fc, class, share FROM fc, share) g LEFT JOIN obs o ON o.term = g.term AND o.class = g.class
  GROUP BY g.term
),
sel AS (SELECT term, chi2, CAST(row_number() OVER (ORDER BY round(chi2, 9) DESC, term) AS BIGINT) AS rank FROM chi
        QUALIFY rank <= {FT.K_BEST})"""


def balanced_tfidf(spark, sf_dir, docs: DataFrame | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """F1-F3 on the sentences of the R4-balanced classes: (rows, vocabulary, terms), the rows with class, one of five
    stratified folds and their selected terms as sparse arrays; rows and terms are written.  ``docs`` may pass the written sentences."""
    d = tfidf_docs(spark, sf_dir) if docs is None else docs
    balanced = downsample_to_smallest(d.join(doc_classes(d), "id"), "class", ["id"], SEED)
    balanced = written(balanced.select("id", "class", "sentence_text"))
    tf = written(FT.term_frequencies(balanced, "id", "sentence_text"))
    vocabulary = written(FT.tfidf_fit(balanced, "id", "sentence_text", tf=tf))
    weights = written(FT.tfidf_transform(balanced, vocabulary, "id", "sentence_text", tf=tf))
    top = FT.chi2_select(weights, balanced.select("id", "class"))
    terms = written(top.select("term", (F.col("rank") - 1).cast("int").alias("idx")))
    folds = stratified_folds(balanced.select("id", "class"), "class", ["id"], 5, SEED)
    return written(FT.sparse_rows(weights, terms, folds)), vocabulary, terms


@query("tfidf_vocabulary", f"""
WITH {SQL_TFIDF}
SELECT term, df, total_cnt, round(idf, 6) AS idf FROM vocab
""")
def q_tfidf_vocabulary(spark, sf_dir):
    """F1: 1-2-gram vocabulary with min_df 2, max_df 0.4, 5000 most frequent terms."""
    v = FT.tfidf_fit(tfidf_docs(spark, sf_dir), "id", "sentence_text")
    return v.select("term", "df", "total_cnt", F.round("idf", 6).alias("idf"))


@query("tfidf_weights", f"""
WITH {SQL_TFIDF}
SELECT id, term, round(weight, 6) AS weight FROM w
""")
def q_tfidf_weights(spark, sf_dir):
    """sublinear TF x smoothed IDF, L2-normalised per sentence."""
    d = tfidf_docs(spark, sf_dir)
    tf = written(FT.term_frequencies(d, "id", "sentence_text"))
    v = written(FT.tfidf_fit(d, "id", "sentence_text", tf=tf))
    w = FT.tfidf_transform(d, v, "id", "sentence_text", tf=tf)
    return w.select("id", "term", F.round("weight", 6).alias("weight"))


def fitted(spark, sf_dir) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """F1-F3 on all sentences: (sentences, vocabulary, weights, selected terms); the counts, the vocabulary and the
    weights are written once for their readers."""
    d = tfidf_docs(spark, sf_dir)
    tf = written(FT.term_frequencies(d, "id", "sentence_text"))
    v = written(FT.tfidf_fit(d, "id", "sentence_text", tf=tf))
    w = written(FT.tfidf_transform(d, v, "id", "sentence_text", tf=tf))
    return d, v, w, FT.chi2_select(w, doc_classes(d))


@query("chi2_select", f"""
WITH {SQL_TFIDF}
SELECT term, round(chi2, 6) AS chi2, rank FROM sel
""")
def q_chi2_select(spark, sf_dir):
    """the 1000 terms with the largest chi-square against the speaker class."""
    sel = fitted(spark, sf_dir)[-1]
    return sel.select("term", F.round("chi2", 6).alias("chi2"), "rank")


@query("tfidf_transform", f"""
WITH {SQL_TFIDF},
ntoks AS (SELECT item_id AS id, regexp_extract_all(lower(text), '{FT.TOKEN_RE}', 0) AS t FROM benchmark),
nterms AS (
  SELECT id, u.term FROM ntoks, unnest(t) AS u(term)
  UNION ALL SELECT id, array_to_string(t[i:i + 1], ' ') FROM ntoks, unnest(range(1, len(t))) AS r(i)
),
ntf AS (SELECT id, term, count(*) AS tf FROM nterms GROUP BY id, term),
nw0 AS (SELECT id, term, (1 + ln(tf)) * idf AS w FROM ntf JOIN vocab USING (term)),
nw AS (SELECT id, term, w / sqrt(sum(w * w) OVER (PARTITION BY id)) AS weight FROM nw0)
SELECT id AS item_id, term, round(weight, 6) AS weight FROM nw WHERE term IN (SELECT term FROM sel)
""")
def q_tfidf_transform(spark, sf_dir):
    """fitted vocabulary, IDF and chi-square selection applied to unseen sentences."""
    _, v, _, sel = fitted(spark, sf_dir)
    b = table(spark, sf_dir, "benchmark").select("item_id", "text")
    w = FT.tfidf_transform(b, v, "item_id", "text")
    w = w.join(F.broadcast(sel.select("term")), "term", "left_semi")
    return w.select(F.col("id").alias("item_id"), "term", F.round("weight", 6).alias("weight"))


FEATURE_COLS = ["sentence_length", "commas", "period", "quotations", "dashes", "question",
                "protocol_number", "knesset_number", "protocol_type"]


def custom_features(spark, sf_dir, docs: DataFrame | None = None) -> DataFrame:
    """T25 counts + two numeric ids (paragraph and document number as
    doubles) + label-encoded corpus type -> 9 columns.  ``docs`` may pass the
    written sentences."""
    d = tfidf_docs(spark, sf_dir) if docs is None else docs
    codes = label_encode(d, "lang")
    f = T.punctuation_features("sentence_text")
    d = d.join(F.broadcast(codes), "lang")              # a row per language, sent as in doc_classes
    return d.select("id", *[v.cast("double").alias(k) for k, v in f.items()],
                    F.col("para_no").cast("double").alias("protocol_number"),
                    F.col("doc_id").cast("double").alias("knesset_number"),
                    F.col("code").cast("double").alias("protocol_type"))


SQL_CUSTOM = f"""
{SQL_DOC_SENTENCES},
codes AS (SELECT lang, dense_rank() OVER (ORDER BY lang) - 1 AS code FROM (SELECT DISTINCT lang FROM sentences)),
cf AS (
  SELECT concat_ws('-', doc_id, para_no, sent_no) AS id,
         CAST(len(list_filter(string_split_regex(sentence_text, '\\s+'), lambda t: t <> '')) AS DOUBLE) AS sentence_length,
         CAST(len(regexp_extract_all(sentence_text, ',', 0)) AS DOUBLE) AS commas,
         CAST(len(regexp_extract_all(sentence_text, '\\.', 0)) AS DOUBLE) AS period,
         CAST(len(regexp_extract_all(sentence_text, '"', 0)) + len(regexp_extract_all(sentence_text, '''', 0)) AS DOUBLE) AS quotations,
         CAST(len(regexp_extract_all(sentence_text, '-', 0)) AS DOUBLE) AS dashes,
         CAST(len(regexp_extract_all(sentence_text, '\\?', 0)) AS DOUBLE) AS question,
         CAST(para_no AS DOUBLE) AS protocol_number, CAST(doc_id AS DOUBLE) AS knesset_number,
         CAST(code AS DOUBLE) AS protocol_type
  FROM sentences JOIN codes USING (lang)
)"""


@query("custom_feature_matrix", f"""
WITH {SQL_CUSTOM}
SELECT * FROM cf
""")
def q_custom_feature_matrix(spark, sf_dir):
    """the 9-column hand-made feature matrix."""
    return custom_features(spark, sf_dir)


@query("standard_scale", f"""
WITH {SQL_CUSTOM}
SELECT id, {", ".join(f"round(({c} - avg({c}) OVER ()) / CASE WHEN stddev_pop({c}) OVER () = 0 THEN 1 ELSE stddev_pop({c}) OVER () END, 6) AS {c}" for c in FEATURE_COLS)}
FROM cf
""")
def q_standard_scale(spark, sf_dir):
    """z-scores with population std (std 0 -> 1)."""
    s = FT.standard_scale(custom_features(spark, sf_dir), FEATURE_COLS)
    return s.select("id", *[F.round(c, 6).alias(c) for c in FEATURE_COLS])


def _cust(spark, sf_dir) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    n = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    return c.join(n, "c_nationkey").select("c_custkey", "c_mktsegment", "n_name")


CAT_COLS = ["c_mktsegment", "n_name"]


def _sql_long(src: str) -> str:
    return f"""(
  SELECT id, col, value FROM (
    SELECT c_custkey AS id, 'c_mktsegment' AS col, c_mktsegment AS value FROM {src}
    UNION ALL SELECT c_custkey, 'n_name', n_name FROM {src}) x
  WHERE value IS NOT NULL AND value <> (SELECT min(value) FROM (
    SELECT 'c_mktsegment' AS col, c_mktsegment AS value FROM {src} UNION ALL SELECT 'n_name', n_name FROM {src}) y
    WHERE y.col = x.col)
)"""


SQL_CUST = """
cust AS (SELECT c_custkey, c_mktsegment, n_name FROM customer JOIN nation ON n_nationkey = c_nationkey)"""


@query("one_hot_drop_first", f"""
WITH {SQL_CUST}
SELECT id AS c_custkey, col || '_' || value AS feature FROM {_sql_long('cust')}
""")
def q_one_hot_drop_first(spark, sf_dir):
    """dummy features per text column, first category in sort order dropped (long form)."""
    return FT.one_hot_long(_cust(spark, sf_dir), "c_custkey", CAT_COLS).withColumnRenamed("id", "c_custkey")


@query("align_columns", f"""
WITH {SQL_CUST},
sp AS (SELECT *, CASE WHEN row_number() OVER (ORDER BY md5('{SEED}-' || CAST(c_custkey AS VARCHAR)))
                 <= floor(0.8 * count(*) OVER ()) THEN 'train' ELSE 'test' END AS split FROM cust),
tr AS (SELECT * FROM sp WHERE split = 'train'),
te AS (SELECT * FROM sp WHERE split = 'test'),
trf AS (SELECT DISTINCT col || '_' || value AS feature FROM {_sql_long('tr')}),
tef AS (SELECT id, col || '_' || value AS feature FROM {_sql_long('te')})
SELECT id AS c_custkey, feature FROM tef WHERE feature IN (SELECT feature FROM trf)
""")
def q_align_columns(spark, sf_dir):
    """F8: test dummies re-indexed to the training features (extra dropped, missing = 0)."""
    sp = random_split(_cust(spark, sf_dir), ["c_custkey"], 0.8, SEED)
    tr = FT.one_hot_long(sp.filter(F.col("split") == "train"), "c_custkey", CAT_COLS)
    te = FT.one_hot_long(sp.filter(F.col("split") == "test"), "c_custkey", CAT_COLS)
    return FT.align_columns(te, tr).select(F.col("id").alias("c_custkey"), "feature")


@query("rescale_vectors", """
SELECT vec_id, list_transform(CAST(embedding AS DOUBLE[]), lambda x: round((x - 0.5) / 0.5, 6)) AS scaled,
       list_transform(CAST(embedding AS DOUBLE[]), lambda x: round(((x - 0.5) / 0.5) * 0.5 + 0.5, 6)) AS restored
FROM embeddings
""")
def q_rescale_vectors(spark, sf_dir):
    """(x - 0.5) / 0.5 and its inverse."""
    e = table(spark, sf_dir, "embeddings").select(
        "vec_id", F.transform("embedding", lambda x: x.cast("double")).alias("v"))
    s = e.select("vec_id", FT.rescale(F.col("v")).alias("s"))
    return s.select("vec_id", F.transform("s", lambda x: F.round(x, 6)).alias("scaled"),
                    F.transform(FT.unscale(F.col("s")), lambda x: F.round(x, 6)).alias("restored"))

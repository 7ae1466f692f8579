"""Vector, nearest-neighbour, classifier-output and metric queries
(V2-V7, C1, C5, C8-C10, E1-E10) on ``embeddings`` (vec_id plays the word /
image id) and on predictions derived from it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quire.functions import vectors as VX
from quire.functions.keys import hash_key
from quire.functions.text import response_label
from quire.operators import metrics as E
from quire.operators.gram_blocks import mean_vectors
from quire.operators.neighbors import SCORE_DIGITS, knn_vote, topk_similar, topk_sparse
from quire.operators.replace import analogy, replace_words, replacements_by_analogy
from quire.operators.ranking import range_rank
from quire.operators.sampling import stratified_folds
from quire.plans.common import SQL_DOC_SENTENCES, doc_sentences
from quire.plans.q_features import SQL_TFIDF, balanced_tfidf
from quire.plans.q_text import SQL_ANSWERS, prompt_answers
from quire.plans.registry import query
from quire.sources.tables import table

SEED = 42
DIMS = 64
CHOSEN = 50          # the chosen rows of V3 and V5 have ids divisible by it


def _emb(spark, sf_dir) -> DataFrame:
    e = table(spark, sf_dir, "embeddings")
    return e.select("vec_id", F.transform("embedding", lambda x: x.cast("double")).alias("vec"), "label")


SQL_EMB = "emb AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS vec, label FROM embeddings)"
SQL_FOLDS = f"""
folds AS (SELECT vec_id, vec, label,
                 ntile(5) OVER (PARTITION BY label ORDER BY md5('{SEED}-' || CAST(vec_id AS VARCHAR))) - 1 AS fold
          FROM emb)"""
SQL_PRED = f"""
pred AS (SELECT vec_id, fold, label,
                CASE WHEN substr(md5('{SEED}-' || CAST(vec_id AS VARCHAR)), 1, 1) < 'c' THEN label
                     ELSE (label + 1) % 10 END AS prediction
         FROM folds)"""


def _folds(spark, sf_dir) -> DataFrame:
    return stratified_folds(_emb(spark, sf_dir), "label", ["vec_id"], 5, SEED)


def predictions(spark, sf_dir) -> DataFrame:
    """Prediction table (vec_id, fold, label, prediction) derived from the
    labels and a fixed hash: about 3/4 correct."""
    f = _folds(spark, sf_dir)
    wrong = F.substring(hash_key(SEED, "vec_id"), 1, 1) >= "c"
    return f.select("vec_id", "fold", "label",
                    F.when(wrong, (F.col("label") + 1) % 10).otherwise(F.col("label")).alias("prediction"))


def _rv(c):
    return F.transform(c, lambda x: F.round(x, 6))


# ------------------------------------------------------------- V2 vectors
def word_vector_table(spark, sf_dir) -> DataFrame:
    """Fixed word-vector table: the i-th most frequent corpus token gets the
    i-th embedding (by vec_id)."""
    s = doc_sentences(spark, sf_dir)
    wc = s.select(F.explode("tokens").alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("cnt"))
    wr = range_rank(wc, [F.col("cnt").desc(), F.col("word").asc()], rank_col="r")
    er = range_rank(_emb(spark, sf_dir), [F.col("vec_id").asc()], rank_col="r")
    return wr.join(er, "r").select("word", "vec", "r")


SQL_WORDVEC = f"""
{SQL_EMB},
wc AS (SELECT u.w AS word, count(*) AS cnt FROM sentences, unnest(tokens) AS u(w) GROUP BY u.w),
wr AS (SELECT word, row_number() OVER (ORDER BY cnt DESC, word) AS r FROM wc),
er AS (SELECT vec, row_number() OVER (ORDER BY vec_id) AS r FROM emb),
wv AS (SELECT word, vec FROM wr JOIN er USING (r))"""


@query("sentence_vectors", f"""
WITH {SQL_DOC_SENTENCES}, {SQL_WORDVEC},
st AS (SELECT concat_ws('-', doc_id, para_no, sent_no) AS sid, u.w AS word
       FROM sentences, unnest(tokens) AS u(w)),
known AS (SELECT sid, vec FROM st JOIN wv USING (word)),
dims AS (SELECT sid, d.i AS dim, avg(d.x) AS m FROM known, unnest(vec) WITH ORDINALITY AS d(x, i) GROUP BY sid, d.i),
mv AS (SELECT sid, list(round(m, 6) ORDER BY dim) AS vector FROM dims GROUP BY sid),
nk AS (SELECT sid, count(*) AS n_known FROM known GROUP BY sid),
alls AS (SELECT DISTINCT concat_ws('-', doc_id, para_no, sent_no) AS sid FROM sentences)
SELECT alls.sid, coalesce(n_known, 0) AS n_known,
       coalesce(vector, list_transform(range({DIMS}), lambda i: 0.0::DOUBLE)) AS vector
FROM alls LEFT JOIN nk USING (sid) LEFT JOIN mv USING (sid)
""")
def q_sentence_vectors(spark, sf_dir):
    """V2: mean of the vectors of the known words of every sentence, else a zero vector."""
    s = doc_sentences(spark, sf_dir).select(F.concat_ws("-", "doc_id", "para_no", "sent_no").alias("sid"),
                                            "tokens")
    return sentence_vectors(s, word_vector_table(spark, sf_dir), DIMS)


def sentence_vectors(sentences: DataFrame, word_vectors: DataFrame, dim: int) -> DataFrame:
    """V2 operator: ``sentences(sid, tokens)`` x ``word_vectors(word, vec)``, each word once.

    A block of sentences asks for the vectors of its distinct words, not of
    every token, and adds them up where they arrive (see
    :mod:`quire.operators.gram_blocks`)."""
    m = mean_vectors(sentences, word_vectors, dim)
    zero = F.array_repeat(F.lit(0.0), dim)
    return m.select("sid", "n_known", F.when(F.col("n_known") == 0, zero).otherwise(_rv(F.col("mean"))).alias("vector"))


# ------------------------------------------------------- V3-V5 neighbours
SQL_PAIRS = f"""
{SQL_EMB},
pairs AS (
  SELECT a.vec_id AS qid, b.vec_id AS cid,
         round(CASE WHEN sqrt(list_dot_product(a.vec, a.vec)) * sqrt(list_dot_product(b.vec, b.vec)) = 0 THEN 0.0
              ELSE list_dot_product(a.vec, b.vec) / (sqrt(list_dot_product(a.vec, a.vec)) * sqrt(list_dot_product(b.vec, b.vec))) END, {SCORE_DIGITS}) AS score
  FROM emb a, emb b WHERE a.vec_id <> b.vec_id AND a.vec_id % {CHOSEN} = 0
)"""


@query("similar_words", f"""
WITH {SQL_PAIRS}
SELECT qid AS vec_id, CAST(rank AS BIGINT) AS rank, cid AS neighbour, round(score, 6) AS score FROM (
  SELECT *, row_number() OVER (PARTITION BY qid ORDER BY score DESC, cid) AS rank FROM pairs) WHERE rank <= 5
""")
def q_similar_words(spark, sf_dir):
    """V3: top 5 neighbours by cosine among all vectors of each chosen one, itself excluded."""
    e = _emb(spark, sf_dir)
    r = topk_similar(e.filter(F.col("vec_id") % CHOSEN == 0), e, 5, "cosine", "vec_id", "vec", "vec_id", "vec", exclude_self=True)
    return r.select(F.col("qid").alias("vec_id"), F.col("rank").cast("bigint").alias("rank"),
                    F.col("cid").alias("neighbour"), F.round("score", 6).alias("score"))


@query("nearest_sentence", f"""
WITH {SQL_PAIRS}
SELECT qid AS vec_id, cid AS nearest, round(score, 6) AS score FROM (
  SELECT *, row_number() OVER (PARTITION BY qid ORDER BY score DESC, cid) AS rank FROM pairs) WHERE rank = 1
""")
def q_nearest_sentence(spark, sf_dir):
    """V5: the most similar other row among all of each chosen row (ties to the lowest id)."""
    e = _emb(spark, sf_dir)
    r = topk_similar(e.filter(F.col("vec_id") % CHOSEN == 0), e, 1, "cosine", "vec_id", "vec", "vec_id", "vec", exclude_self=True)
    return r.select(F.col("qid").alias("vec_id"), F.col("cid").alias("nearest"), F.round("score", 6).alias("score"))


def analogy_queries(e: DataFrame) -> DataFrame:
    """(query, word, sign): per label L, the two smallest ids of L positive,
    the smallest id of label (L + 1) % 10 negative."""
    w = Window.partitionBy("label").orderBy("vec_id")
    firsts = e.select("vec_id", "label", F.row_number().over(w).alias("r")).filter("r <= 2")
    pos = firsts.select(F.col("label").alias("query"), F.col("vec_id").alias("word"), F.lit(1.0).alias("sign"))
    neg = firsts.filter("r = 1").select(((F.col("label") + 9) % 10).alias("query"),
                                        F.col("vec_id").alias("word"), F.lit(-1.0).alias("sign"))
    return pos.unionByName(neg)


@query("analogy", f"""
WITH {SQL_EMB},
firsts AS (SELECT vec_id, label, row_number() OVER (PARTITION BY label ORDER BY vec_id) AS r FROM emb),
qw AS (SELECT label AS query, vec_id AS word, 1.0 AS sign FROM firsts WHERE r <= 2
       UNION ALL SELECT (label + 9) % 10, vec_id, -1.0 FROM firsts WHERE r = 1),
u AS (SELECT query, word, list_transform(vec, lambda x: x / sqrt(list_dot_product(vec, vec)) * sign) AS u
      FROM qw JOIN emb ON emb.vec_id = qw.word),
dims AS (SELECT query, d.i AS dim, avg(d.x) AS m FROM u, unnest(u.u) WITH ORDINALITY AS d(x, i) GROUP BY query, d.i),
qv AS (SELECT query, list(m ORDER BY dim) AS vec FROM dims GROUP BY query),
sc AS (
  SELECT query, vec_id AS cid,
         round(list_dot_product(qv.vec, emb.vec) / (sqrt(list_dot_product(qv.vec, qv.vec)) * sqrt(list_dot_product(emb.vec, emb.vec))), {SCORE_DIGITS}) AS score
  FROM qv, emb
  WHERE NOT EXISTS (SELECT 1 FROM qw WHERE qw.query = qv.query AND qw.word = emb.vec_id)
)
SELECT CAST(query AS INTEGER) AS query, CAST(rank AS BIGINT) AS rank, cid AS neighbour, round(score, 6) AS score FROM (
  SELECT *, row_number() OVER (PARTITION BY query ORDER BY score DESC, cid) AS rank FROM sc) WHERE rank <= 3
""")
def q_analogy(spark, sf_dir):
    """V4: positive / negative word arithmetic, top 3 by cosine, inputs excluded."""
    e = _emb(spark, sf_dir)
    r = analogy(analogy_queries(e), e.select("vec_id", "vec"), 3)
    return r.select(F.col("qid").cast("int").alias("query"), F.col("rank").cast("bigint").alias("rank"),
                    F.col("cid").alias("neighbour"), F.round("score", 6).alias("score"))


@query("replace_words_by_analogy", f"""
WITH {SQL_DOC_SENTENCES}, {SQL_WORDVEC.replace("wv AS (SELECT word, vec FROM", "wv AS (SELECT word, vec, r FROM")},
unit AS (SELECT word, r, vec, list_transform(vec, lambda x: x / sqrt(list_dot_product(vec, vec))) AS u FROM wv),
asked AS (
  SELECT a.r AS pos, a.word, b.word AS positive, c.word AS negative,
         list_transform(list_zip(a.u, b.u, c.u), lambda z: (z[1] + z[2] - z[3]) / 3) AS m
  FROM unit a JOIN unit b ON b.r = a.r + 1 JOIN unit c ON c.r = a.r + 2
),
rep AS (
  SELECT pos, word, other AS new FROM (
    SELECT pos, a.word, w.word AS other,
           round(list_dot_product(m, w.vec) / (sqrt(list_dot_product(m, m)) * sqrt(list_dot_product(w.vec, w.vec))), {SCORE_DIGITS}) AS score
    FROM asked a, wv w WHERE w.word <> a.word AND w.word <> positive AND w.word <> negative)
  QUALIFY row_number() OVER (PARTITION BY pos ORDER BY score DESC, other) = 1
),
sents AS (SELECT concat_ws('-', doc_id, para_no, sent_no) AS sid, sentence_text FROM sentences),
found AS (
  SELECT sid, list(struct_pack(w := word, n := new) ORDER BY pos) AS l FROM sents JOIN rep ON contains(sentence_text, word) GROUP BY sid
)
SELECT sid, coalesce(list_reduce(list_prepend(struct_pack(w := sentence_text, n := ''), l),
                                 lambda done, x: struct_pack(w := replace(done.w, x.w, x.n), n := '')).w, sentence_text) AS replaced,
       coalesce(array_to_string(list_transform(l, lambda x: '(' || x.w || ':' || x.n || ')'), ', '), '') AS pairs
FROM sents LEFT JOIN found USING (sid)
""")
def q_replace_words_by_analogy(spark, sf_dir):
    """T17 fed by V4: each word with a vector, found in a sentence, gives way to the word most analogous to it and its
    neighbour in the frequency order without the next one."""
    v = word_vector_table(spark, sf_dir)
    near = v.select(F.col("word").alias("positive"), (F.col("r") - 1).alias("r")).join(
        v.select(F.col("word").alias("negative"), (F.col("r") - 2).alias("r")), "r")
    context = v.select("word", "r").join(near, "r").select(F.col("r").alias("pos"), "word", F.array("positive").alias("positive"),
                                                           F.array("negative").alias("negative"))
    s = doc_sentences(spark, sf_dir).select(F.concat_ws("-", "doc_id", "para_no", "sent_no").alias("sid"), "sentence_text")
    return replace_words(s, replacements_by_analogy(context, v.select("word", "vec")), "sentence_text").select("sid", "replaced", "pairs")


# ------------------------------------------------------------ V6 / V7
def pick_pair(e: DataFrame, seed=SEED) -> DataFrame:
    """V7: two distinct labels drawn (seeded), the first row of each."""
    labels = e.select("label").distinct()
    drawn = labels.orderBy(hash_key(seed, "label")).limit(2) \
        .withColumn("pick", F.row_number().over(Window.orderBy(hash_key(seed, "label"))).cast("bigint"))
    first = e.groupBy("label").agg(F.min("vec_id").alias("vec_id"))
    return drawn.join(first, "label").select("pick", "label", "vec_id")


SQL_PICK = f"""
drawn AS (SELECT label, row_number() OVER (ORDER BY md5('{SEED}-' || CAST(label AS VARCHAR))) AS pick
          FROM (SELECT DISTINCT label FROM emb)),
pick AS (SELECT CAST(pick AS BIGINT) AS pick, d.label, min(vec_id) AS vec_id FROM drawn d JOIN emb USING (label)
         WHERE pick <= 2 GROUP BY pick, d.label)"""


@query("pick_pair_of_classes", f"""
WITH {SQL_EMB}, {SQL_PICK}
SELECT pick, label, vec_id FROM pick
""")
def q_pick_pair_of_classes(spark, sf_dir):
    """V7: two seeded distinct labels and the first row of each."""
    return pick_pair(_emb(spark, sf_dir))


@query("interpolate_vectors", f"""
WITH {SQL_EMB}, {SQL_PICK},
ab AS (SELECT (SELECT vec FROM emb WHERE vec_id = (SELECT vec_id FROM pick WHERE pick = 1)) AS a,
              (SELECT vec FROM emb WHERE vec_id = (SELECT vec_id FROM pick WHERE pick = 2)) AS b)
SELECT CAST(s.i AS BIGINT) AS step,
       list_transform(list_zip(a, b), lambda z: round((1 - s.i / 9.0) * z[1] + (s.i / 9.0) * z[2], 6)) AS vector
FROM ab, range(10) AS s(i)
""")
def q_interpolate_vectors(spark, sf_dir):
    """V6: (1 - t) a + t b for t in linspace(0, 1, 10) between the V7 pair."""
    e = _emb(spark, sf_dir)
    p = pick_pair(e).join(e.select("vec_id", "vec"), "vec_id")
    pair = p.groupBy().agg(F.max_by("vec", F.when(F.col("pick") == 1, 1).otherwise(0)).alias("a"),
                           F.max_by("vec", F.when(F.col("pick") == 2, 1).otherwise(0)).alias("b"))
    steps = pair.select("a", "b", F.explode(F.sequence(F.lit(0), F.lit(9))).alias("step"))
    t = F.col("step") / 9.0
    return steps.select(F.col("step").cast("bigint").alias("step"),
                        F.zip_with("a", "b", lambda x, y: F.round((1 - t) * x + t * y, 6)).alias("vector"))


# --------------------------------------------------------------- C1 / C5
def _sql_knn(k: int, weighting: str, metric: str) -> str:
    if metric == "cosine":
        score = ("list_dot_product(a.vec, b.vec) / (sqrt(list_dot_product(a.vec, a.vec)) * "
                 "sqrt(list_dot_product(b.vec, b.vec)))")
        dist = "1.0 - score"
    else:
        score = "-sqrt(list_sum(list_transform(list_zip(a.vec, b.vec), lambda z: (z[1] - z[2]) * (z[1] - z[2]))))"
        dist = "-score"
    w = "1.0" if weighting == "uniform" else \
        f"CASE WHEN max(CASE WHEN {dist} = 0 THEN 1 ELSE 0 END) OVER (PARTITION BY qid) = 1 " \
        f"THEN CASE WHEN {dist} = 0 THEN 1.0 ELSE 0.0 END ELSE 1.0 / ({dist}) END"
    return f"""
WITH {SQL_EMB}, {SQL_FOLDS},
pairs AS (SELECT a.vec_id AS qid, a.fold, a.label AS qlabel, b.vec_id AS cid, b.label, round({score}, {SCORE_DIGITS}) AS score
          FROM folds a JOIN folds b ON a.fold <> b.fold),
nb AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY score DESC, cid) AS rk FROM pairs)
       WHERE rk <= {k}),
wt AS (SELECT *, {w} AS w FROM nb),
votes AS (SELECT qid, fold, qlabel, label, round(sum(w), {SCORE_DIGITS}) AS v FROM wt GROUP BY qid, fold, qlabel, label)
SELECT qid AS vec_id, CAST(fold AS BIGINT) AS fold, qlabel AS label, label AS prediction FROM (
  SELECT *, row_number() OVER (PARTITION BY qid ORDER BY v DESC, label) AS r FROM votes) WHERE r = 1
"""


SQL_BALANCED = (SQL_TFIDF
                .replace("docs AS (SELECT concat_ws('-', doc_id, para_no, sent_no) AS id, source, sentence_text FROM sentences),", f"""
all_docs AS (SELECT concat_ws('-', doc_id, para_no, sent_no) AS id, source, sentence_text FROM sentences),
sc AS (SELECT source, count(*) AS n FROM all_docs GROUP BY source),
rk AS (SELECT source, CASE row_number() OVER (ORDER BY n DESC, source) WHEN 1 THEN 'first' WHEN 2 THEN 'second' ELSE 'other' END AS class FROM sc),
seeded AS (SELECT id, source, sentence_text, class, row_number() OVER (PARTITION BY class ORDER BY md5('{SEED}-' || id)) AS r,
                  count(*) OVER (PARTITION BY class) AS n_class FROM all_docs JOIN rk USING (source)),
docs AS (SELECT id, source, sentence_text FROM seeded WHERE r <= (SELECT min(n_class) FROM seeded)),""")
                .replace("""sc AS (SELECT source, count(*) AS n FROM docs GROUP BY source),
rk AS (SELECT source, CASE row_number() OVER (ORDER BY n DESC, source) WHEN 1 THEN 'first' WHEN 2 THEN 'second'
                      ELSE 'other' END AS class FROM sc),
""", ""))


@query("tfidf_knn", f"""
WITH {SQL_BALANCED},
x AS (SELECT id, term, weight FROM w JOIN sel USING (term)),
norms AS (SELECT id, class, ntile(5) OVER (PARTITION BY class ORDER BY md5('{SEED}-' || id)) - 1 AS fold, coalesce(n, 0) AS n
          FROM cls LEFT JOIN (SELECT id, sum(weight * weight) AS n FROM x GROUP BY id) USING (id)),
dots AS (SELECT a.id AS qid, b.id AS cid, sum(a.weight * b.weight) AS d FROM x a JOIN x b USING (term) GROUP BY a.id, b.id),
pairs AS (SELECT a.id AS qid, b.id AS cid, b.class, round(-sqrt(greatest(round(a.n + b.n - 2 * coalesce(d, 0), 12), 0)), {SCORE_DIGITS}) AS score
          FROM norms a JOIN norms b ON a.fold <> b.fold LEFT JOIN dots ON dots.qid = a.id AND dots.cid = b.id),
nb AS (SELECT * FROM pairs QUALIFY row_number() OVER (PARTITION BY qid ORDER BY score DESC, cid) <= 7),
wt AS (SELECT *, CASE WHEN max(CASE WHEN score = 0 THEN 1 ELSE 0 END) OVER (PARTITION BY qid) = 1
                      THEN CASE WHEN score = 0 THEN 1.0 ELSE 0.0 END ELSE 1.0 / (-score) END AS v FROM nb),
votes AS (SELECT qid, class, round(sum(v), {SCORE_DIGITS}) AS v FROM wt GROUP BY qid, class)
SELECT n.id, CAST(fold AS BIGINT) AS fold, n.class AS label, p.class AS prediction
FROM norms n JOIN (SELECT * FROM votes QUALIFY row_number() OVER (PARTITION BY qid ORDER BY v DESC, class) = 1) p ON p.qid = n.id
""")
def q_tfidf_knn(spark, sf_dir):
    """C1 + C5 on F1-F3 after R4: out-of-fold classes of the balanced sentences, k = 7 euclidean on the 1000 selected terms,
    1/distance vote."""
    rows, _, _ = balanced_tfidf(spark, sf_dir)
    near = topk_sparse(rows, rows, 7, "euclidean")
    p = knn_vote(near.select("qid", "cid", "score"), rows.select(F.col("id").alias("cid"), F.col("class").alias("label")), "distance", "euclidean")
    return rows.select(F.col("id").alias("qid"), "fold", F.col("class").alias("label")).join(p, "qid").select(
        F.col("qid").alias("id"), "fold", "label", "prediction")


def cross_validated_knn(f: DataFrame, k: int, metric: str, weighting: str) -> DataFrame:
    """C5 with C1: out-of-fold k-NN prediction of every row in one job."""
    nb = topk_similar(f, f, k, metric, "vec_id", "vec", "vec_id", "vec", q_group="fold", c_group="fold")
    pred = knn_vote(nb.select("qid", "cid", "score"), f.select(F.col("vec_id").alias("cid"), "label"),
                    weighting, metric)
    return (f.select(F.col("vec_id").alias("qid"), "fold", "label").join(pred, "qid")
            .select(F.col("qid").alias("vec_id"), "fold", "label", "prediction"))


@query("cross_validated_predictions", _sql_knn(5, "uniform", "cosine"))
def q_cross_validated_predictions(spark, sf_dir):
    """C5 + C1: 5-fold out-of-fold predictions, k = 5, cosine, plain vote."""
    return cross_validated_knn(_folds(spark, sf_dir), 5, "cosine", "uniform")


@query("knn_classify", _sql_knn(7, "distance", "euclidean"))
def q_knn_classify(spark, sf_dir):
    """k = 7 euclidean, 1/distance vote, out-of-fold."""
    return cross_validated_knn(_folds(spark, sf_dir), 7, "euclidean", "distance")


# --------------------------------------------------------------- C8-C10
def class_scores(e: DataFrame, label: Column) -> DataFrame:
    """(vec_id, label, z): linear scores of every class over all dimensions, x . mu - |mu|^2 / 2 with the class mean mu
    (the nearest mean has the largest score); classes in ascending order."""
    rows = e.select("vec_id", label.cast("int").alias("label"), "vec")
    means = rows.select("label", F.posexplode("vec").alias("pos", "x")).groupBy("label", "pos").agg(F.avg("x").alias("m"))
    mu = means.groupBy("label").agg(F.sort_array(F.collect_list(F.struct("pos", "m")))["m"].alias("mu"))
    mu = mu.select("label", "mu", (VX.dot("mu", "mu") / 2).alias("half"))
    classes = mu.select(F.sort_array(F.collect_list(F.struct("label", "mu", "half")))).scalar()    # classes x dimensions numbers
    return (rows.withColumn("__c", classes)
            .select("vec_id", "label", "vec",          # behind a generator: a reader's lambda must not score again per element
                    F.explode(F.array(F.transform("__c", lambda c: VX.dot(F.col("vec"), c["mu"]) - c["half"]))).alias("z")))


def sql_scores(label: str, vec: str = "vec", name: str = "scores") -> str:
    return f"""
{name}_m AS (SELECT label, list(m ORDER BY pos) AS mu FROM (
  SELECT {label} AS label, u.pos, avg(u.x) AS m FROM emb, unnest({vec}) WITH ORDINALITY AS u(x, pos) GROUP BY ALL) GROUP BY label),
{name} AS (SELECT e.vec_id, e.label, list(list_dot_product(e.v, c.mu) - list_dot_product(c.mu, c.mu) / 2 ORDER BY c.label) AS z
           FROM (SELECT vec_id, {vec} AS v, {label} AS label FROM emb) e, {name}_m c GROUP BY e.vec_id, e.label)"""


def _upper_half() -> Column:
    return (F.col("label") >= 5).cast("int")


SQL_UPPER = "CAST(label >= 5 AS INTEGER)"


def _probability(spark, sf_dir) -> DataFrame:
    """(vec_id, y, p): the probability of the upper five labels from the two groups' scores."""
    s = class_scores(_emb(spark, sf_dir), _upper_half())
    return s.select("vec_id", F.col("label").alias("y"), (F.lit(1.0) / (1 + F.exp(F.col("z")[0] - F.col("z")[1]))).alias("p"))


@query("threshold_decision", f"""
WITH {SQL_EMB}, {sql_scores(SQL_UPPER)}
SELECT vec_id, CAST(1.0 / (1.0 + exp(z[1] - z[2])) > 0.5 AS INTEGER) AS decision FROM scores
""")
def q_threshold_decision(spark, sf_dir):
    """Probability (sigmoid of the difference of the two groups' scores) > 0.5 -> 1."""
    return _probability(spark, sf_dir).select("vec_id", (F.col("p") > 0.5).cast("int").alias("decision"))


@query("argmax_class", f"""
WITH {SQL_EMB}, {sql_scores('label')}
SELECT vec_id, CAST(list_position(z, list_max(z)) - 1 AS INTEGER) AS class FROM scores
""")
def q_argmax_class(spark, sf_dir):
    """Class with the largest score."""
    s = class_scores(_emb(spark, sf_dir), F.col("label"))
    return s.select("vec_id", (F.array_position("z", F.array_max("z")) - 1).cast("int").alias("class"))


@query("softmax_probabilities", f"""
WITH {SQL_EMB}, {sql_scores('label')}
SELECT vec_id, CAST(u.i - 1 AS INTEGER) AS class,
       round(exp(u.x - list_max(z)) / list_sum(list_transform(z, lambda y: exp(y - list_max(z)))), 6) AS prob
FROM scores, unnest(z) WITH ORDINALITY AS u(x, i)
""")
def q_softmax_probabilities(spark, sf_dir):
    """Softmax of the scores, one row per class."""
    e = class_scores(_emb(spark, sf_dir), F.col("label")).select("vec_id", "z")
    p = E.softmax(e, "z", "p")
    return p.select("vec_id", F.posexplode("p").alias("class", "prob")) \
        .select("vec_id", F.col("class").cast("int").alias("class"), F.round("prob", 6).alias("prob"))


# ------------------------------------------------------------------ E1-E10
@query("accuracy", f"""
WITH {SQL_EMB}, {SQL_FOLDS}, {SQL_PRED}
SELECT round(avg(CAST(prediction = label AS DOUBLE)), 6) AS accuracy FROM pred
""")
def q_accuracy(spark, sf_dir):
    """Share of correct predictions."""
    return E.accuracy(predictions(spark, sf_dir))


@query("mean_fold_accuracy", f"""
WITH {SQL_EMB}, {SQL_FOLDS}, {SQL_PRED}
SELECT round(avg(a), 6) AS mean_accuracy FROM (
  SELECT fold, avg(CAST(prediction = label AS DOUBLE)) AS a FROM pred GROUP BY fold)
""")
def q_mean_fold_accuracy(spark, sf_dir):
    """Accuracy per fold, then the mean."""
    return E.mean_fold_accuracy(predictions(spark, sf_dir))


@query("classification_report", f"""
WITH {SQL_EMB}, {SQL_FOLDS}, {SQL_PRED},
cls AS (SELECT label AS c FROM pred UNION SELECT prediction FROM pred),
st AS (
  SELECT c, sum(CASE WHEN label = c AND prediction = c THEN 1 ELSE 0 END) AS tp,
         sum(CASE WHEN label <> c AND prediction = c THEN 1 ELSE 0 END) AS fp,
         sum(CASE WHEN label = c AND prediction <> c THEN 1 ELSE 0 END) AS fn
  FROM cls, pred GROUP BY c
),
pc AS (
  SELECT CAST(c AS VARCHAR) AS name,
         CASE WHEN tp + fp = 0 THEN 0.0 ELSE tp / (tp + fp) END AS precision,
         CASE WHEN tp + fn = 0 THEN 0.0 ELSE tp / (tp + fn) END AS recall,
         tp + fn AS support
  FROM st
),
pcf AS (SELECT *, CASE WHEN precision + recall = 0 THEN 0.0 ELSE 2 * precision * recall / (precision + recall) END AS f1 FROM pc)
SELECT name, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1,
       CAST(support AS BIGINT) AS support FROM pcf
UNION ALL SELECT 'accuracy', NULL, NULL, (SELECT round(avg(CAST(prediction = label AS DOUBLE)), 6) FROM pred),
       (SELECT count(*) FROM pred)
UNION ALL SELECT 'macro avg', round(avg(precision), 6), round(avg(recall), 6), round(avg(f1), 6),
       CAST(sum(support) AS BIGINT) FROM pcf
UNION ALL SELECT 'weighted avg', round(sum(precision * support) / sum(support), 6),
       round(sum(recall * support) / sum(support), 6), round(sum(f1 * support) / sum(support), 6),
       CAST(sum(support) AS BIGINT) FROM pcf
""")
def q_classification_report(spark, sf_dir):
    """Precision, recall, F1, support per class; accuracy; macro and weighted means."""
    return E.classification_report(predictions(spark, sf_dir))


@query("confusion_matrix", f"""
WITH {SQL_EMB}, {SQL_FOLDS}, {SQL_PRED},
cls AS (SELECT label AS c FROM pred UNION SELECT prediction FROM pred),
cnt AS (SELECT label, prediction, count(*) AS n FROM pred GROUP BY ALL)
SELECT a.c AS label, b.c AS prediction, coalesce(n, 0) AS count
FROM cls a, cls b LEFT JOIN cnt ON cnt.label = a.c AND cnt.prediction = b.c
""")
def q_confusion_matrix(spark, sf_dir):
    """Label x prediction counts, zeros included."""
    return E.confusion_matrix(predictions(spark, sf_dir))


@query("cross_entropy", f"""
WITH {SQL_EMB}, {sql_scores('label')}
SELECT round(avg(list_max(z) + ln(list_sum(list_transform(z, lambda y: exp(y - list_max(z))))) - z[label + 1]), 6)
       AS loss FROM scores
""")
def q_cross_entropy(spark, sf_dir):
    """E5: mean of -log softmax(scores)[label]."""
    return E.cross_entropy(class_scores(_emb(spark, sf_dir), F.col("label")), "z", "label")


@query("binary_cross_entropy", f"""
WITH {SQL_EMB}, {sql_scores(SQL_UPPER)},
l AS (SELECT 1.0 / (1.0 + exp(z[1] - z[2])) AS p, label AS y FROM scores)
SELECT round(avg(-(y * ln(p) + (1 - y) * ln(1 - p))), 6) AS loss FROM l
""")
def q_binary_cross_entropy(spark, sf_dir):
    """Mean of -(y ln p + (1 - y) ln(1 - p))."""
    return E.binary_cross_entropy(_probability(spark, sf_dir), "p", "y")


# --- fixed values that must equal the reference: loss settings -------------
SMOOTHING = 0.1
CLASS_WEIGHTS = [1.0, 1.5, 1.2, 1.3]
# ---------------------------------------------------------------------------


@query("smoothed_weighted_loss", f"""
WITH {SQL_EMB}, {sql_scores('label % 4')},
ls AS (SELECT z, label, list_transform(z, lambda y: y - list_max(z) - ln(list_sum(list_transform(z, lambda t: exp(t - list_max(z)))))) AS lsm FROM scores)
SELECT round(avg(-list_sum(list_transform(range(4), lambda c:
         ((1 - {SMOOTHING}) * CASE WHEN c = label THEN 1 ELSE 0 END + {SMOOTHING} / 4) * lsm[c + 1]))
         * ({CLASS_WEIGHTS})[label + 1]), 6) AS loss
FROM ls
""")
def q_smoothed_weighted_loss(spark, sf_dir):
    """Label-smoothed cross-entropy weighted by the true class (label modulo 4)."""
    e = class_scores(_emb(spark, sf_dir), F.col("label") % 4)
    return E.smoothed_weighted_loss(e, "z", "label", 4, SMOOTHING, CLASS_WEIGHTS)


@query("reconstruction_plus_kl", """
WITH v AS (SELECT list_transform(CAST(embedding[1:24] AS DOUBLE[]), lambda y: 1.0 / (1.0 + exp(-y))) AS x,
                  list_transform(CAST(embedding[25:48] AS DOUBLE[]), lambda y: 1.0 / (1.0 + exp(-y))) AS xh,
                  CAST(embedding[49:56] AS DOUBLE[]) AS m, CAST(embedding[57:64] AS DOUBLE[]) AS lv
           FROM embeddings)
SELECT round(sum(
  -list_sum(list_transform(list_zip(x, xh), lambda z: z[1] * ln(z[2] + 1e-8) + (1 - z[1]) * ln(1 - z[2] + 1e-8)))
  - 0.5 * list_sum(list_transform(list_zip(m, lv), lambda z: 1 + z[2] - z[1] * z[1] - exp(z[2])))), 6) AS loss
FROM v
""")
def q_reconstruction_plus_kl(spark, sf_dir):
    """Binary reconstruction loss plus KL term, summed over rows (24 dimensions rebuilt as the next 24, 8 means, 8 log variances)."""
    e = _emb(spark, sf_dir)
    sig = lambda a: F.transform(a, lambda y: F.lit(1.0) / (1 + F.exp(-y)))
    d = e.select(sig(F.slice("vec", 1, 24)).alias("x"), sig(F.slice("vec", 25, 24)).alias("xh"),
                 F.slice("vec", 49, 8).alias("m"), F.slice("vec", 57, 8).alias("lv"))
    return E.reconstruction_plus_kl(d)


EPOCH_DIMS = (22, 43, 64)         # dimensions that the scores of epoch 0, 1 and 2 use


@query("metrics_by_split", f"""
WITH {SQL_EMB}, {", ".join(sql_scores('label', f'vec[1:{n}]', f's{e}').strip() for e, n in enumerate(EPOCH_DIMS))},
sp AS (SELECT vec_id, CASE WHEN row_number() OVER (ORDER BY md5('{SEED}-' || CAST(vec_id AS VARCHAR)))
       <= floor(0.8 * count(*) OVER ()) THEN 'train' ELSE 'test' END AS split,
       floor((row_number() OVER (ORDER BY md5('{SEED}-' || CAST(vec_id AS VARCHAR))) - 1) / 64) AS batch FROM emb),
ep AS (SELECT split, batch, label, epoch, z FROM sp JOIN (
         {" UNION ALL ".join(f"SELECT vec_id, label, z, {e} AS epoch FROM s{e}" for e in range(len(EPOCH_DIMS)))}) USING (vec_id)),
r AS (SELECT split, batch, epoch, label, z,
             list_max(z) + ln(list_sum(list_transform(z, lambda y: exp(y - list_max(z))))) - z[label + 1] AS loss,
             list_position(z, list_max(z)) - 1 AS prediction FROM ep),
b AS (SELECT epoch, split, batch, avg(loss) AS loss, sum(CASE WHEN prediction = label THEN 1.0 ELSE 0.0 END) AS hits, count(*) AS n
      FROM r GROUP BY epoch, split, batch)
SELECT CAST(epoch AS BIGINT) AS epoch, split, round(avg(loss), 6) AS loss, round(CAST(sum(hits) AS DOUBLE) / sum(n), 6) AS accuracy
FROM b GROUP BY epoch, split
""")
def q_metrics_by_split(spark, sf_dir):
    """Batch-mean loss (seeded batches of 64) and accuracy per (epoch,
    split) of a prediction table (the scores of each epoch use more dimensions, the last all)."""
    from quire.operators.sampling import batch_numbers, random_split
    emb = _emb(spark, sf_dir)
    rows = batch_numbers(random_split(emb, ["vec_id"], 0.8, SEED), 64, ["vec_id"], SEED).select("vec_id", "split", "batch")
    scores = None
    for epoch, n in enumerate(EPOCH_DIMS):
        s = class_scores(emb.withColumn("vec", F.slice("vec", 1, n)), F.col("label"))
        s = s.select("vec_id", "label", "z", F.lit(epoch).cast("bigint").alias("epoch"))
        scores = s if scores is None else scores.unionByName(s)
    return E.metrics_by_split(scores.join(rows, "vec_id"), "z", "label", ["epoch", "split"], "batch")


@query("accuracy_by_strategy", f"""
WITH {SQL_ANSWERS}
SELECT strategy, round(avg(CAST((CASE WHEN contains(lower(answer), 'positive') THEN 'Positive' ELSE 'Negative' END)
                                = (CASE WHEN quality = 1 THEN 'Positive' ELSE 'Negative' END) AS DOUBLE)), 6) AS accuracy
FROM answers GROUP BY strategy
""")
def q_accuracy_by_strategy(spark, sf_dir):
    """Accuracy of the parsed answer (T19 on T18 prompts) per prompt strategy."""
    p = prompt_answers(spark, sf_dir).select("strategy", response_label("answer").alias("answer"),
                                             F.when(F.col("quality") == 1, "Positive").otherwise("Negative").alias("truth"))
    return p.groupBy("strategy").agg(F.round(F.avg((F.col("answer") == F.col("truth")).cast("double")), 6)
                                     .alias("accuracy"))

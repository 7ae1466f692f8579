"""Trigram language-model queries (N3-N14, T14, R1) on the ``documents`` corpus.

One model per ``lang``.  Sentence id ``sid`` = ``doc_id-para_no-sent_no``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quire.functions.keys import hash_key
from quire.operators import ngrams as N
from quire.operators.fill import fill_masks
from quire.plans.common import SQL_DOC_SENTENCES, doc_sentences
from quire.plans.registry import query
from quire.session import written

SEED = 42
SAMPLE_CORPUS = "fr"                     # of the sampled sentences
MASK_PCT = 10
MIN_MASK_TOKENS = 5
#: what is scored: a sentence's text is not written beside its tokens
SCORED = ("sid", "corpus", "tokens")


def lm_sentences(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = doc_sentences(spark, sf_dir)
    return s.select(F.concat_ws("-", "doc_id", "para_no", "sent_no").alias("sid"),
                    F.col("lang").alias("corpus"), "doc_id", "para_no", "sent_no", "tokens", "sentence_text")


def lm_model(spark: SparkSession, sf_dir: str, columns: Sequence[str] = ("*",)) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Sentences (their ``columns``) and n-gram counts, each written once for all that reads them, with the totals."""
    s = written(lm_sentences(spark, sf_dir).select(*columns))
    counts = written(N.ngram_counts(s))
    return s, counts, N.totals_from_counts(counts)


def lm_counts(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """As :func:`lm_model`, for those that read no sentence: they are not written."""
    counts = written(N.ngram_counts(lm_sentences(spark, sf_dir)))
    return counts, N.totals_from_counts(counts)


def other_models(s: DataFrame) -> DataFrame:
    """(corpus, model): each corpus with the next one in order, the last with the first."""
    c = s.select("corpus").distinct()
    w = Window.orderBy("corpus")                  # one row per corpus
    return c.select("corpus", F.coalesce(F.lead("corpus").over(w), F.first("corpus").over(w)).alias("model"))


# ---------------------------------------------------------------- SQL twins
SQL_LM = f"""
{SQL_DOC_SENTENCES},
lm_s AS (
  SELECT concat_ws('-', doc_id, para_no, sent_no) AS sid, lang AS corpus, tokens,
         list_concat(['s_1', 's_1'], tokens, ['s_2']) AS p
  FROM sentences
),
lm_grams AS (
  SELECT corpus, 1 AS n, u.g AS gram FROM lm_s, unnest(p) AS u(g)
  UNION ALL
  SELECT corpus, 2, array_to_string(p[i - 1:i], ' ') FROM lm_s, unnest(range(2, len(p) + 1)) AS r(i)
  UNION ALL
  SELECT corpus, 3, array_to_string(p[i - 2:i], ' ') FROM lm_s, unnest(range(3, len(p) + 1)) AS r(i)
),
counts AS (SELECT corpus, n, gram, count(*) AS cnt FROM lm_grams GROUP BY ALL),
totals AS (SELECT corpus, sum(cnt) AS total, count(*) AS vocab FROM counts WHERE n = 1 GROUP BY corpus)"""


def sql_position_probs(sent_cte: str) -> str:
    """CTE ``pp(sid, corpus, pos, token, p)`` for sentences in ``sent_cte(sid, corpus, tokens)``."""
    return f"""
pos AS (
  SELECT sid, corpus, i AS pos, p[i] AS w, p[i - 1] AS w1, p[i - 2] AS w2
  FROM (SELECT sid, corpus, list_concat(['s_1', 's_1'], tokens, ['s_2']) AS p FROM {sent_cte}) x,
       unnest(range(3, len(p) + 1)) AS r(i)
),
pp AS (
  SELECT pos.sid, pos.corpus, pos.pos, pos.w AS token,
         (coalesce(u.cnt, 0) + 1) / (t.total + t.vocab) AS p1,
         (coalesce(b.cnt, 0) + 1) / (coalesce(u1.cnt, 0) + t.vocab) AS p2,
         (coalesce(tr.cnt, 0) + 1) / (coalesce(b2.cnt, 0) + t.vocab) AS p3,
         0.99 * (coalesce(u.cnt, 0) + 1) / (t.total + t.vocab)
       + 0.003 * (coalesce(b.cnt, 0) + 1) / (coalesce(u1.cnt, 0) + t.vocab)
       + 0.007 * (coalesce(tr.cnt, 0) + 1) / (coalesce(b2.cnt, 0) + t.vocab) AS p
  FROM pos
  JOIN totals t ON t.corpus = pos.corpus
  LEFT JOIN counts u ON u.corpus = pos.corpus AND u.n = 1 AND u.gram = pos.w
  LEFT JOIN counts b ON b.corpus = pos.corpus AND b.n = 2 AND b.gram = pos.w1 || ' ' || pos.w
  LEFT JOIN counts u1 ON u1.corpus = pos.corpus AND u1.n = 1 AND u1.gram = pos.w1
  LEFT JOIN counts tr ON tr.corpus = pos.corpus AND tr.n = 3 AND tr.gram = pos.w2 || ' ' || pos.w1 || ' ' || pos.w
  LEFT JOIN counts b2 ON b2.corpus = pos.corpus AND b2.n = 2 AND b2.gram = pos.w2 || ' ' || pos.w1
)"""


# ------------------------------------------------------------------ queries
@query("ngram_counts", f"""
WITH {SQL_LM}
SELECT corpus AS lang, CAST(n AS BIGINT) AS n, gram, cnt FROM counts
""")
def q_ngram_counts(spark, sf_dir):
    """Unigram, bigram and trigram counts per corpus (s_1 s_1 ... s_2 padding)."""
    counts = N.ngram_counts(lm_sentences(spark, sf_dir))
    return counts.select(F.col("corpus").alias("lang"), F.col("n").cast("bigint").alias("n"), "gram", "cnt")


@query("lm_totals", f"""
WITH {SQL_LM}
SELECT corpus AS lang, CAST(total AS BIGINT) AS total, vocab FROM totals
""")
def q_lm_totals(spark, sf_dir):
    """Total padded tokens and vocabulary size per corpus (one pass, from the corpus)."""
    s = lm_sentences(spark, sf_dir)
    return N.lm_totals(s).select(F.col("corpus").alias("lang"), "total", "vocab")


@query("smoothed_probability", f"""
WITH {SQL_LM}, {sql_position_probs('lm_s')}
SELECT sid, corpus AS lang, CAST(pos AS BIGINT) AS pos, token, round(p1, 9) AS p1, round(p2, 9) AS p2, round(p3, 9) AS p3 FROM pp
""")
def q_smoothed_probability(spark, sf_dir):
    """The smoothed unigram, bigram and trigram probability of every token of every sentence."""
    pp = N.position_probabilities(*lm_model(spark, sf_dir, SCORED))
    return pp.select("sid", F.col("corpus").alias("lang"), F.col("pos").cast("bigint").alias("pos"), "token",
                     *[F.round(p, 9).alias(p) for p in ("p1", "p2", "p3")])


@query("interpolated_probability", f"""
WITH {SQL_LM}, {sql_position_probs('lm_s')}
SELECT sid, corpus AS lang, CAST(pos AS BIGINT) AS pos, token, round(p, 9) AS p FROM pp
""")
def q_interpolated_probability(spark, sf_dir):
    """The interpolated probability of every token of every sentence."""
    pp = N.position_probabilities(*lm_model(spark, sf_dir, SCORED))
    return pp.select("sid", F.col("corpus").alias("lang"), F.col("pos").cast("bigint").alias("pos"), "token", F.round("p", 9).alias("p"))


@query("sentence_log_probability", f"""
WITH {SQL_LM}, {sql_position_probs('lm_s')}
SELECT sid, corpus AS lang, round(sum(log2(p)), 6) AS log_prob FROM pp GROUP BY sid, corpus
""")
def q_sentence_log_probability(spark, sf_dir):
    """log2 probability of every sentence under its own corpus model."""
    s, counts, totals = lm_model(spark, sf_dir, SCORED)
    r = N.sentence_scores(s, counts, totals)
    return r.select("sid", F.col("corpus").alias("lang"), F.round("log_prob", 6).alias("log_prob"))


@query("sentence_perplexity", f"""
WITH {SQL_LM}, {sql_position_probs('lm_s')}
SELECT sid, corpus AS lang, round(pow(2.0, -avg(log2(p))), 6) AS perplexity FROM pp GROUP BY sid, corpus
""")
def q_sentence_perplexity(spark, sf_dir):
    """2 ** (-mean log2 p) per sentence."""
    s, counts, totals = lm_model(spark, sf_dir, SCORED)
    r = N.sentence_scores(s, counts, totals)
    return r.select("sid", F.col("corpus").alias("lang"), F.round("perplexity", 6).alias("perplexity"))


@query("mean_perplexity", f"""
WITH {SQL_LM}, {sql_position_probs('lm_s')},
per AS (SELECT sid, corpus, pow(2.0, -avg(log2(p))) AS perplexity FROM pp GROUP BY sid, corpus)
SELECT corpus AS lang, round(avg(perplexity), 4) AS mean_perplexity FROM per GROUP BY corpus
""")
def q_mean_perplexity(spark, sf_dir):
    """Plain mean of sentence perplexities per corpus."""
    s, counts, totals = lm_model(spark, sf_dir, SCORED)
    r = N.sentence_scores(s, counts, totals)
    return (r.groupBy(F.col("corpus").alias("lang"))
            .agg(F.round(F.avg("perplexity"), 4).alias("mean_perplexity")))


_SQL_MODELS = """
models AS (SELECT corpus, coalesce(lead(corpus) OVER (ORDER BY corpus), first(corpus) OVER (ORDER BY corpus)) AS model
           FROM (SELECT DISTINCT corpus FROM lm_s))"""


@query("compare_models", f"""
WITH {SQL_LM}, {_SQL_MODELS},
two AS (SELECT sid, m.model AS corpus, tokens FROM lm_s JOIN models m USING (corpus) UNION ALL SELECT sid, corpus, tokens FROM lm_s),
{sql_position_probs('two')}
SELECT sid, corpus AS model, round(sum(log2(p)), 6) AS log_prob FROM pp GROUP BY sid, corpus
""")
def q_compare_models(spark, sf_dir):
    """log2 probability of each sentence of every corpus under its own model and under another corpus'."""
    s, counts, totals = lm_model(spark, sf_dir, SCORED)
    two = s.join(other_models(s), "corpus").select("sid", "tokens", F.explode(F.array("corpus", "model")).alias("model"))
    r = N.sentence_scores(two, counts, totals, model_col="model")
    return r.select("sid", F.col("corpus").alias("model"), F.round("log_prob", 6).alias("log_prob"))


SQL_NEXT = """
uni AS (SELECT corpus, gram AS w, cnt AS c1 FROM counts WHERE n = 1 AND gram NOT IN ('s_1', 's_2')),
bi AS (SELECT corpus, split_part(gram, ' ', 1) AS w1, split_part(gram, ' ', 2) AS w, gram, cnt FROM counts WHERE n = 2),
tri AS (SELECT corpus, split_part(gram, ' ', 1) AS w2, split_part(gram, ' ', 2) AS w1, split_part(gram, ' ', 3) AS w, cnt FROM counts WHERE n = 3),
top_uni AS (SELECT corpus, w FROM uni QUALIFY row_number() OVER (PARTITION BY corpus ORDER BY c1 DESC, w) = 1),
words AS (SELECT corpus, gram AS w1, cnt AS d2 FROM counts WHERE n = 1 AND gram <> 's_2'),
cand_one AS (
  SELECT corpus, w1, w FROM bi JOIN uni USING (corpus, w)
  UNION SELECT x.corpus, x.w1, t.w FROM words x JOIN top_uni t USING (corpus)
),
after_one AS (
  SELECT corpus, w1, w AS token FROM (
    SELECT c.corpus, c.w1, c.w, 0.99 * (u.c1 + 1) / (t.total + t.vocab) + 0.003 * (coalesce(b.cnt, 0) + 1) / (x.d2 + t.vocab) AS s
    FROM cand_one c JOIN uni u USING (corpus, w) JOIN totals t USING (corpus) JOIN words x USING (corpus, w1)
    LEFT JOIN bi b USING (corpus, w1, w))
  QUALIFY row_number() OVER (PARTITION BY corpus, w1 ORDER BY s DESC, w) = 1
),
cand_two AS (
  SELECT corpus, w2, w1, w FROM tri JOIN uni USING (corpus, w)
  UNION SELECT b.corpus, b.w1, b.w, o.token FROM bi b JOIN after_one o ON o.corpus = b.corpus AND o.w1 = b.w
),
after_two AS (
  SELECT corpus, w2, w1, w AS token, p FROM (
    SELECT c.corpus, c.w2, c.w1, c.w,
           0.99 * (u.c1 + 1) / (t.total + t.vocab) + 0.003 * (coalesce(b.cnt, 0) + 1) / (x.d2 + t.vocab)
         + 0.007 * (coalesce(tr.cnt, 0) + 1) / (d3.cnt + t.vocab) AS p
    FROM cand_two c JOIN uni u USING (corpus, w) JOIN totals t USING (corpus) JOIN words x USING (corpus, w1)
    JOIN bi d3 ON d3.corpus = c.corpus AND d3.w1 = c.w2 AND d3.w = c.w1
    LEFT JOIN bi b ON b.corpus = c.corpus AND b.w1 = c.w1 AND b.w = c.w
    LEFT JOIN tri tr ON tr.corpus = c.corpus AND tr.w2 = c.w2 AND tr.w1 = c.w1 AND tr.w = c.w)
  QUALIFY row_number() OVER (PARTITION BY corpus, w2, w1 ORDER BY p DESC, w) = 1
)"""


@query("best_next_token", f"""
WITH {SQL_LM}, {SQL_NEXT}
SELECT corpus AS lang, w2, w1, token, round(p, 10) AS p FROM after_two
""")
def q_best_next_token(spark, sf_dir):
    """Most probable next token after every two tokens (start marks too) that occur together."""
    r = N.next_token_index(*lm_counts(spark, sf_dir)).after_two
    return r.select(F.col("corpus").alias("lang"), "w2", "w1", "token", F.round("p", 10).alias("p"))


_SQL_MASKED = f"""
m AS (
  SELECT concat_ws('-', doc_id, para_no, sent_no) AS sid, lang, tokens,
         greatest(1, CAST(floor(len(tokens) * {MASK_PCT} / 100) AS INTEGER)) AS k
  FROM sentences WHERE len(tokens) >= {MIN_MASK_TOKENS}
),
h AS (SELECT sid, lang, tokens, k,
             list_transform(tokens, lambda t, i: md5('{SEED}-' || sid || '-' || CAST(i - 1 AS VARCHAR))) AS hs
      FROM m),
masked AS (SELECT sid, lang, k, list_transform(list_zip(tokens, hs),
             lambda z: CASE WHEN z[2] <= list_sort(hs)[k] THEN '[*]' ELSE z[1] END) AS toks FROM h)"""


@query("mask_tokens", f"""
WITH {SQL_DOC_SENTENCES}, {_SQL_MASKED}
SELECT sid, array_to_string(toks, ' ') AS masked_sentence, CAST(k AS BIGINT) AS n_masked FROM masked
""")
def q_mask_tokens(spark, sf_dir):
    """Mask max(1, 10 %) seeded tokens of every sentence with >= 5 tokens."""
    s = lm_sentences(spark, sf_dir).filter(F.size("tokens") >= MIN_MASK_TOKENS)
    s = N.mask_sentences(s, "tokens", "sid", SEED, MASK_PCT)
    return s.select("sid", F.array_join("masked", " ").alias("masked_sentence"),
                    F.greatest(F.lit(1), F.floor(F.size("tokens") * MASK_PCT / 100)).cast("bigint")
                    .alias("n_masked"))


@query("sample_sentences", f"""
WITH {SQL_DOC_SENTENCES}
SELECT concat_ws('-', doc_id, para_no, sent_no) AS sid, sentence_text FROM sentences
WHERE lang = '{SAMPLE_CORPUS}' AND len(tokens) >= {MIN_MASK_TOKENS}
ORDER BY md5('{SEED}-' || concat_ws('-', doc_id, para_no, sent_no)) LIMIT 10
""")
def q_sample_sentences(spark, sf_dir):
    """10 seeded random sentences with >= 5 tokens (the sample is the feature)."""
    s = lm_sentences(spark, sf_dir).filter((F.col("corpus") == SAMPLE_CORPUS)
                                           & (F.size("tokens") >= MIN_MASK_TOKENS))
    return s.orderBy(hash_key(SEED, "sid")).limit(10).select("sid", "sentence_text")


def _sql_round(i: int) -> str:
    """Round ``i`` of filling ``fill{i}(sid, corpus, toks)``: every marker with no marker among the two tokens before it."""
    return f"""
ready{i} AS (
  SELECT sid, corpus, r.i AS pos, coalesce(toks[r.i - 2], 's_1') AS w2, coalesce(toks[r.i - 1], 's_1') AS w1
  FROM fill{i}, unnest(range(1, len(toks) + 1)) AS r(i)
  WHERE toks[r.i] = '[*]' AND coalesce(toks[r.i - 1], '') <> '[*]' AND coalesce(toks[r.i - 2], '') <> '[*]'
),
found{i} AS (
  SELECT sid, map(list(pos), list(coalesce(a.token, o.token, t.w))) AS f FROM ready{i} x
  LEFT JOIN after_two a USING (corpus, w2, w1) LEFT JOIN after_one o USING (corpus, w1) JOIN top_uni t USING (corpus) GROUP BY sid
),
fill{i + 1} AS (
  SELECT sid, corpus, CASE WHEN f IS NULL THEN toks ELSE list_transform(toks, lambda x, j: coalesce(f[j], x)) END AS toks
  FROM fill{i} LEFT JOIN found{i} USING (sid)
)"""


FILL_ROUNDS = 8     # of the SQL twin; the engine goes on until no marker is left


@query("fill_masks", f"""
WITH {SQL_LM}, {_SQL_MODELS}, {_SQL_MASKED}, {SQL_NEXT},
fill0 AS (SELECT sid, model AS corpus, toks FROM masked JOIN models ON models.corpus = masked.lang),
{", ".join(_sql_round(i) for i in range(FILL_ROUNDS))},
twice AS (SELECT sid, corpus, toks AS tokens FROM fill{FILL_ROUNDS}
         UNION ALL SELECT f.sid, m.lang, f.toks FROM fill{FILL_ROUNDS} f JOIN masked m USING (sid) WHERE m.lang <> f.corpus),
{sql_position_probs('twice')},
scores AS (SELECT sid, corpus, sum(log2(p)) AS log_prob, pow(2.0, -avg(log2(p))) AS perplexity FROM pp GROUP BY sid, corpus)
SELECT f.sid, array_to_string(m.toks, ' ') AS masked_sentence, array_to_string(f.toks, ' ') AS filled_sentence,
       array_to_string(list_transform(list_filter(list_zip(m.toks, f.toks), lambda z: z[1] = '[*]'), lambda z: z[2]), ', ') AS predicted_tokens,
       round(s.log_prob, 6) AS log_prob, round(o.log_prob, 6) AS log_prob_other, round(s.perplexity, 6) AS perplexity
FROM fill{FILL_ROUNDS} f JOIN masked m USING (sid) JOIN scores s ON s.sid = f.sid AND s.corpus = f.corpus JOIN scores o ON o.sid = f.sid AND o.corpus = m.lang
""")
def q_fill_masks(spark, sf_dir):
    """Fill every masked sentence of every corpus with another corpus' model, then score it under both (N14) and give
    its perplexity (N8)."""
    s, counts, totals = lm_model(spark, sf_dir, SCORED)
    src = s.filter(F.size("tokens") >= MIN_MASK_TOKENS).join(other_models(s), "corpus")
    masked = N.mask_sentences(src, "tokens", "sid", SEED, MASK_PCT) \
        .select("sid", "masked", F.col("model").alias("corpus"), F.col("corpus").alias("own"))
    return fill_masks(masked, counts, totals, other_col="own")

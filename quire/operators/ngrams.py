"""N-gram language model and collocations.

Models are tables, never driver dictionaries:

* ``counts``  (corpus, n, gram, cnt)   -- gram is the blank-joined token string
* ``totals``  (corpus, total, vocab)   -- padded tokens and distinct unigrams

All n-gram orders are counted within blocks of sentences and added up by one
``groupBy``, instead of three jobs.  Scoring looks up the distinct grams of each
block in the counts table by a single join, so neither the positions nor the
boundary grams (``s_1``, ``s_1 s_1``), which every position would ask for, are
shuffled (see :mod:`.gram_blocks`).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quire.operators.frequent_grams import FrequentGrams
from quire.operators.gram_blocks import COUNTS, gram_counts, position_counts
from quire.session import written

# --- fixed values that must equal the reference ---------------------------
BOS = "s_1"                      # start mark (twice before a sentence)
EOS = "s_2"                      # end mark
LAMBDA_UNI, LAMBDA_BI, LAMBDA_TRI = 0.99, 0.003, 0.007
# ---------------------------------------------------------------------------


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def lm_pad(tokens) -> Column:
    """N1 (model form): s_1 s_1 tokens s_2."""
    return F.concat(F.array(F.lit(BOS), F.lit(BOS)), _c(tokens), F.array(F.lit(EOS)))


def colloc_pad(tokens, n: int) -> Column:
    """N1 (collocation form): (n-1) x s_1, tokens, s_2."""
    return F.concat(F.array_repeat(F.lit(BOS), n - 1), _c(tokens), F.array(F.lit(EOS)))


def ngrams_of(padded, n: int) -> Column:
    """All contiguous n-grams of an array, as blank-joined strings."""
    p = _c(padded)
    last = F.size(p) - n + 1
    return F.when(last < 1, F.array().cast("array<string>")).otherwise(
        F.transform(F.sequence(F.lit(1), last), lambda i: F.array_join(F.slice(p, i, n), " ")))


def check_order(n: int) -> None:
    if n not in (1, 2, 3):
        raise ValueError(f"n-grams of order {n!r} are not counted, only 1, 2 and 3")


# --------------------------------------------------------------------------
# model fit
# --------------------------------------------------------------------------

def ngram_counts(sentences: DataFrame, tokens_col: str = "tokens",
                 corpus_col: str = "corpus", begins: str | None = None) -> DataFrame:
    """(corpus, n, gram, cnt) for n = 1, 2, 3 with s_1 s_1 ... s_2 padding;
    counted within blocks of sentences, then added up by gram.  With ``begins``
    the longer grams are those that begin with this token: all that a model
    tells of contexts that begin with it."""
    d = sentences.select(F.col(corpus_col).alias("corpus"), F.col(tokens_col).alias("tokens")).filter(F.col("tokens").isNotNull())
    return gram_counts(d, BOS, EOS, begins)


def lm_totals(sentences: DataFrame, tokens_col: str = "tokens",
              corpus_col: str = "corpus") -> DataFrame:
    """(corpus, total, vocab) -- both include the boundary marks."""
    total = (sentences.groupBy(F.col(corpus_col).alias("corpus"))
             .agg(F.sum(F.size(tokens_col) + 3).cast("bigint").alias("total")))
    vocab = (sentences.select(F.col(corpus_col).alias("corpus"), F.explode(lm_pad(tokens_col)).alias("w"))
             .groupBy("corpus").agg(F.count_distinct("w").alias("vocab")))
    return total.join(vocab, "corpus")


def totals_from_counts(counts: DataFrame) -> DataFrame:
    """N4 from an existing count table (no second pass over the corpus)."""
    return (counts.filter(F.col("n") == 1).groupBy("corpus")
            .agg(F.sum("cnt").cast("bigint").alias("total"), F.count(F.lit(1)).alias("vocab")))


# --------------------------------------------------------------------------
# scoring
# --------------------------------------------------------------------------

def smoothed(cnt, context_cnt, vocab) -> Column:
    """The Laplace-smoothed share (cnt + 1) / (context_cnt + vocab) of one order."""
    return (cnt + 1) / (context_cnt + vocab)


def interpolated(p1, p2, p3) -> Column:
    """The smoothed shares of the three orders under their fixed weights."""
    return F.lit(LAMBDA_UNI) * _c(p1) + F.lit(LAMBDA_BI) * _c(p2) + F.lit(LAMBDA_TRI) * _c(p3)


def _interpolate(c1, c2, d2, c3, d3, total, vocab) -> Column:
    return interpolated(smoothed(c1, total, vocab), smoothed(c2, d2, vocab), smoothed(c3, d3, vocab))


def position_probabilities(sentences: DataFrame, counts: DataFrame, totals: DataFrame,
                           id_col: str = "sid", tokens_col: str = "tokens",
                           model_col: str = "corpus") -> DataFrame:
    """(sid, corpus, pos, token, p1, p2, p3, p) for every scored position (index >= 3 of
    the 1-based padded list) of every sentence under the model named in
    ``model_col``: the N5 terms of the three orders and their N6 sum.

    Sentences are scored in blocks (see :mod:`.gram_blocks`): a block's distinct
    grams are looked up in the count table by one join, and their counts go
    back to the block, where each position reads those of its unigram, bigram
    and trigram and of the contexts before it.
    """
    return _terms(sentences, counts, totals, id_col, tokens_col, model_col, ["token"])


def _terms(sentences: DataFrame, counts: DataFrame, totals: DataFrame, id_col: str, tokens_col: str, model_col: str,
           keep: list[str]) -> DataFrame:
    s = sentences.select(F.col(id_col).alias("sid"), F.col(model_col).alias("corpus"), F.col(tokens_col).alias("tokens"))
    lists = position_counts(s, counts, BOS, EOS, bool(keep))
    each = F.posexplode(F.arrays_zip(*[F.col(c).alias(c) for c in (*keep, *COUNTS)])).alias("at", "x")
    per = lists.select("sid", "corpus", each).select("sid", "corpus", (F.col("at") + 3).alias("pos"), "x.*")
    per = per.join(F.broadcast(totals.select("corpus", "total", "vocab")), "corpus")
    terms = per.select("sid", "corpus", "pos", *keep,
                       smoothed(F.col("c1"), F.col("total"), F.col("vocab")).alias("p1"),
                       smoothed(F.col("c2"), F.col("d2"), F.col("vocab")).alias("p2"),
                       smoothed(F.col("c3"), F.col("d3"), F.col("vocab")).alias("p3"))
    return terms.withColumn("p", interpolated("p1", "p2", "p3"))


def sentence_scores(sentences: DataFrame, counts: DataFrame, totals: DataFrame,
                    id_col: str = "sid", tokens_col: str = "tokens",
                    model_col: str = "corpus") -> DataFrame:
    """N7 + N8: (sid, corpus, log_prob, perplexity) per sentence and model."""
    pp = _terms(sentences, counts, totals, id_col, tokens_col, model_col, [])
    return (pp.groupBy("sid", "corpus")
            .agg(F.sum(F.log2("p")).alias("log_prob"), F.avg(F.log2("p")).alias("avg_log2"),
                 F.count(F.lit(1)).alias("positions"))
            .select("sid", "corpus", "log_prob",
                    F.when(F.col("positions") == 0, F.lit(float("inf")))
                    .otherwise(F.pow(F.lit(2.0), -F.col("avg_log2"))).alias("perplexity")))


def context_of_prefix(prefix_tokens) -> Column:
    """The last two tokens of s_1 s_1 + prefix, as struct(w2, w1)."""
    p = F.concat(F.array(F.lit(BOS), F.lit(BOS)), _c(prefix_tokens))
    return F.struct(F.element_at(p, -2).alias("w2"), F.element_at(p, -1).alias("w1"))


def model_tables(counts: DataFrame, totals: DataFrame) -> dict[str, DataFrame]:
    """Split the count table once into the keyed tables the predictors use:
    uni(corpus, w, c1), bi(corpus, w1, w, c2), tri(corpus, w2, w1, w, c3),
    ctx3(corpus, ctx3, d3) and totals."""
    uni = counts.filter(F.col("n") == 1).select("corpus", F.col("gram").alias("w"), F.col("cnt").alias("c1"))
    bi = counts.filter(F.col("n") == 2).select("corpus", F.split("gram", " ").alias("g"), F.col("gram").alias("ctx3"),
                                               F.col("cnt").alias("c2"))
    bi = bi.select("corpus", F.col("g")[0].alias("w1"), F.col("g")[1].alias("w"), "ctx3", "c2")
    tri = counts.filter(F.col("n") == 3).select("corpus", F.split("gram", " ").alias("g"), F.col("cnt").alias("c3"))
    tri = tri.select("corpus", F.col("g")[0].alias("w2"), F.col("g")[1].alias("w1"), F.col("g")[2].alias("w"), "c3")
    return {"uni": uni, "bi": bi.drop("ctx3"), "tri": tri,
            "ctx3": bi.select("corpus", "ctx3", F.col("c2").alias("d3")),
            "totals": totals.select("corpus", "total", "vocab")}


class NextTokens:
    """The most probable next token of every context, as look-up tables: after_two(corpus, w2, w1, token, p) for the
    contexts seen, after_one(corpus, w1, token, p) for words that follow another one than any seen, after_none(corpus,
    token, p) for words the corpus does not have."""

    def __init__(self, after_two: DataFrame, after_one: DataFrame, after_none: DataFrame):
        self.after_two, self.after_one, self.after_none = after_two, after_one, after_none


def next_token_index(counts: DataFrame, totals: DataFrame) -> NextTokens:
    """N12 for all contexts at once, by aggregations over the count tables.

    A candidate w scores A(w) + B(w1, w) + C(w2, w1, w) (unigram, bigram,
    trigram terms).  Without a seen bigram B is constant, so among those the
    most frequent token wins; without a seen trigram C is constant, so among
    those the winner of A + B does.  So the best after (w2, w1) is the best of
    the seen trigrams' last tokens and the best after w1 alone, which in turn
    is the best of the seen bigrams' last tokens and the most frequent token.
    Each step is a minimum of (-score, token), which aggregates before the
    shuffle: no context meets the vocabulary, and a frequent word is no hot
    task.  Ties: smaller token.  Boundary marks are never candidates.
    """
    t = model_tables(counts, totals)
    words = t["uni"].filter(~F.col("w").isin(BOS, EOS))
    size = F.broadcast(t["totals"])                       # one row per corpus
    d2 = t["uni"].select("corpus", F.col("w").alias("w1"), F.col("c1").alias("d2"))
    ctx = t["ctx3"].select("corpus", F.split("ctx3", " ").alias("g"), "d3")
    ctx = ctx.select("corpus", F.col("g")[0].alias("w2"), F.col("g")[1].alias("w1"), "d3").filter(F.col("w1") != EOS)

    def p(c2, d2_, c3, d3_) -> Column:
        return _interpolate(F.col("c1"), c2, d2_, c3, d3_, F.col("total"), F.col("vocab"))

    def best(score: Column, token: str = "w") -> Column:
        return F.min(F.struct((-score).alias("s"), F.col(token).alias("token")))

    zero = F.lit(0)
    most = words.groupBy("corpus").agg(F.min(F.struct((-F.col("c1")).alias("n"), F.col("w").alias("token"))).alias("x"))
    most = written(most.join(size, "corpus").select("corpus", F.col("x.token").alias("token"), (-F.col("x.n")).alias("c1"), "total", "vocab"))
    after_none = most.select("corpus", "token", p(zero, zero, zero, zero).alias("p"))

    pairs = t["bi"].join(words, ["corpus", "w"]).join(d2, ["corpus", "w1"]).join(size, "corpus")
    pairs = written(pairs.select("corpus", "w1", "w", "c1", "c2", "d2", "total", "vocab"))
    seen = pairs.groupBy("corpus", "w1").agg(best(p(F.col("c2"), F.col("d2"), zero, zero)).alias("x"))
    one = d2.filter(F.col("w1") != EOS).join(seen, ["corpus", "w1"], "left").join(F.broadcast(most), "corpus")
    # the score is the one in a context that was never seen: it differs from A + B by a constant
    one = one.select("corpus", "w1", F.least(F.col("x"), F.struct((-p(zero, F.col("d2"), zero, zero)).alias("s"), "token")).alias("x"), "d2", "vocab")
    after_one = written(one.select("corpus", "w1", F.col("x.token").alias("token"), (-F.col("x.s")).alias("p"), "vocab"))

    # written between its two shuffles, so that only one of them lies on disk at a time
    triples = written(t["tri"].join(pairs, ["corpus", "w1", "w"]).select("corpus", "w2", "w1", "w", "c1", "c2", "d2", "c3"))
    triples = triples.join(ctx, ["corpus", "w2", "w1"]).join(F.broadcast(most.select("corpus", "total", "vocab")), "corpus")
    last = triples.groupBy("corpus", "w2", "w1").agg(best(p(F.col("c2"), F.col("d2"), F.col("c3"), F.col("d3"))).alias("x"))
    two = ctx.join(last, ["corpus", "w2", "w1"], "left").join(after_one, ["corpus", "w1"])
    # from the constant of a context never seen to the constant of this one
    other = F.col("p") - LAMBDA_TRI / F.col("vocab") + LAMBDA_TRI / (F.col("d3") + F.col("vocab"))
    two = two.select("corpus", "w2", "w1", F.least(F.col("x"), F.struct((-other).alias("s"), F.col("token"))).alias("x"))
    after_two = written(two.select("corpus", "w2", "w1", F.col("x.token").alias("token"), (-F.col("x.s")).alias("p")))
    return NextTokens(after_two, after_one.drop("vocab"), after_none)


def look_up_next(contexts: DataFrame, index: NextTokens) -> DataFrame:
    """``contexts`` (corpus, w2, w1, ...) with ``token`` and ``p``; the index is first cut down to the contexts asked for."""
    two = index.after_two.join(contexts.select("corpus", "w2", "w1"), ["corpus", "w2", "w1"], "left_semi")
    one = index.after_one.join(contexts.select("corpus", "w1"), ["corpus", "w1"], "left_semi")
    found = (contexts.join(two, ["corpus", "w2", "w1"], "left")
             .join(one.withColumnsRenamed({"token": "__t1", "p": "__p1"}), ["corpus", "w1"], "left")
             .join(F.broadcast(index.after_none.withColumnsRenamed({"token": "__t0", "p": "__p0"})), "corpus", "left"))
    return found.select(*contexts.columns, F.coalesce("token", "__t1", "__t0").alias("token"), F.coalesce("p", "__p1", "__p0").alias("p"))


def best_next_token(contexts: DataFrame, counts: DataFrame, totals: DataFrame) -> DataFrame:
    """Most probable next token for each distinct (corpus, w2, w1); a corpus without a model has none."""
    ctx = contexts.select("corpus", "w2", "w1").distinct()
    found = look_up_next(ctx, next_token_index(counts, totals))
    return found.filter(F.col("token").isNotNull()).select("corpus", "w2", "w1", "token", "p")


# --------------------------------------------------------------------------
# collocations
# --------------------------------------------------------------------------

def with_ngrams(df: DataFrame, tokens_col: str, sizes: Sequence[int], prefix: str = "__g") -> DataFrame:
    """Add one column of blank-joined n-grams per size, built by Spark ML's
    ``NGram`` transformer (a compiled per-row function; the equivalent
    higher-order ``transform(sequence(...), slice ...)`` is interpreted and
    several times slower)."""
    from pyspark.ml.feature import NGram
    for n in sizes:
        df = NGram(n=n, inputCol=tokens_col, outputCol=f"{prefix}{n}").transform(df)
    return df


def _interior_grams(df: DataFrame, tokens_col: str, sizes: Sequence[int], keep: Sequence[str]) -> DataFrame:
    """Rows ``(*keep, n, gram)`` for the grams that hold no padding mark.

    With (n-1) start marks and one end mark, the grams free of marks are
    exactly the n-grams of the unpadded tokens, so no padding is built.  A
    literal mark token inside the text (impossible with the regex
    tokenizer, possible with others) is still excluded, per gram."""
    marks = F.array(F.lit(BOS), F.lit(EOS))
    d = with_ngrams(df.select(*keep, tokens_col), tokens_col, sizes)
    d = d.withColumn("__has_mark", F.arrays_overlap(F.col(tokens_col), marks))
    tagged = F.concat(*[F.arrays_zip(F.array_repeat(F.lit(n), F.size(f"__g{n}")).alias("n"),
                                     F.col(f"__g{n}").alias("gram")) for n in sizes])
    x = d.select(*keep, "__has_mark", F.explode(tagged).alias("x"))
    x = x.select(*keep, "__has_mark", F.col("x.n").alias("n"), F.col("x.gram").alias("gram"))
    marked = F.col("__has_mark") & F.arrays_overlap(F.split("gram", " "), marks)
    return x.filter(~F.coalesce(F.when(F.col("__has_mark"), marked), F.lit(False))).drop("__has_mark")


def document_ngram_counts(sentences: DataFrame, sizes: Sequence[int] = (2,), tokens_col: str = "tokens",
                          corpus_col: str = "corpus", doc_col: str = "doc_id") -> tuple[DataFrame, DataFrame]:
    """Per-document counts of the grams free of padding marks, and the
    per-document gram totals (which do count the padded grams).

    With (n-1) start marks and one end mark a sentence of L tokens has
    L + 1 padded n-grams whatever n is, so the totals come from the token
    counts, without building padded grams.  Returns
    ``(doc_grams(corpus, n, doc_id, gram, cnt), doc_totals(corpus, doc_id, doc_total))``.
    """
    s = sentences.select(F.col(corpus_col).alias("corpus"), F.col(doc_col).alias("doc_id"),
                         F.col(tokens_col).alias("t"))
    doc_totals = s.groupBy("corpus", "doc_id").agg(F.sum(F.size("t") + 1).cast("bigint").alias("doc_total"))
    g = _interior_grams(s, "t", sizes, ["corpus", "doc_id"])
    doc_grams = g.groupBy("corpus", "n", "doc_id", "gram").agg(F.count(F.lit(1)).alias("cnt"))
    return doc_grams, doc_totals


def frequent_ngrams(sentences: DataFrame, sizes: Sequence[int], threshold: int, doc_col: str | None = None, named: bool = False) -> FrequentGrams:
    """The grams of ``sentences(corpus, t, ...)`` that reach ``threshold`` and hold no padding mark (see
    :mod:`.frequent_grams`).  Without ``doc_col`` the sentences are dealt by all their columns, and documents mean nothing."""
    doc = F.xxhash64(*sentences.columns) if doc_col is None else F.col(doc_col)
    return FrequentGrams(sentences.select("corpus", doc.alias("doc"), F.col("t").alias("tokens")), sizes, threshold, (BOS, EOS), named)


def collocations(sentences: DataFrame, sizes: Sequence[int] = (2,), k: int = 10, threshold: int = 5,
                 metric: str = "frequency", tokens_col: str = "tokens",
                 corpus_col: str = "corpus", doc_col: str = "doc_id") -> DataFrame:
    """Top-k collocations per (corpus, n) by frequency or mean TF-IDF.

    Output (corpus, n, rank, gram, score).  Frequency score = corpus count;
    TF-IDF score = mean
    over the documents holding the gram of (cnt / document grams) *
    ln((N + 1) / (df + 1)), N = documents of the corpus.  Grams holding a
    padding mark never qualify; the top-k per (corpus, n) keeps only k rows
    per group before the final shuffle (window group limit).
    """
    if metric not in ("frequency", "tfidf"):
        raise ValueError(f"metric {metric!r} is neither 'frequency' nor 'tfidf'")
    s = sentences.select(F.col(corpus_col).alias("corpus"), *([F.col(doc_col).alias("doc_id")] if doc_col in sentences.columns else []),
                         F.col(tokens_col).alias("t"))
    if metric == "frequency":
        g = (frequent_ngrams(s, sizes, threshold).totals()
             .select("corpus", "n", "gram", F.col("total_cnt").cast("double").alias("score")))
    else:
        f = frequent_ngrams(s, sizes, threshold, "doc_id", named=True)
        n_docs = f.sentences.select("corpus", "doc").distinct().groupBy("corpus").agg(F.count(F.lit(1)).alias("n_docs"))
        g = (f.totals()
             .join(n_docs, "corpus")
             .select("corpus", "n", "gram",
                     # rounded before ranking: the last bits of a sum depend on the partitioning
                     F.round(F.col("sum_tf") / F.col("df")
                             * F.log((F.col("n_docs") + 1) / (F.col("df") + 1)), 9).alias("score")))
    w = Window.partitionBy("corpus", "n").orderBy(F.desc("score"), F.asc("gram"))
    return (g.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)
            .select("corpus", F.col("n").cast("bigint").alias("n"),
                    F.col("rank").cast("bigint").alias("rank"), "gram", "score"))


def mask_sentences(df: DataFrame, tokens_col: str, sid, seed, pct: float = 10.0,
                   marker: str = "[*]", out_col: str = "masked") -> DataFrame:
    """Replace max(1, int(len * pct / 100)) seeded positions by ``marker``.

    In-row: the k-th smallest position hash is the threshold, so no shuffle.
    Hashes and threshold are produced by a generator so that the optimizer
    cannot inline the sort into the per-token lambda.
    """
    t = F.col(tokens_col)
    sid_c = F.col(sid) if isinstance(sid, str) else sid
    k = F.greatest(F.lit(1), F.floor(F.size(t) * F.lit(float(pct)) / 100)).cast("int")
    h = F.transform(t, lambda _x, i: F.md5(F.concat_ws("-", F.lit(str(seed)), sid_c.cast("string"),
                                                       i.cast("string"))))
    d = df.withColumn("__h", h)
    d = d.select("*", F.inline(F.array(F.struct(
        F.element_at(F.sort_array("__h"), F.greatest(k, F.lit(1))).alias("__thr")))))
    z = F.arrays_zip(t.alias("t"), F.col("__h").alias("h"))
    masked = F.transform(z, lambda e: F.when(e["h"] <= F.col("__thr"), F.lit(marker)).otherwise(e["t"]))
    return d.withColumn(out_col, F.when(F.size(t) == 0, t).otherwise(masked)).drop("__h", "__thr")

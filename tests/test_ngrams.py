"""Language-model operators against a brute-force model on small corpora,
plus the error cases."""

import math
from collections import Counter

import pytest
from pyspark.sql import functions as F

from quire.operators import generate as G
from quire.operators import ngrams as N
from quire.operators.fill import fill_masks

CORPUS = [
    "the cat sat on the mat",
    "the dog sat on the log",
    "a cat and a dog",
    "the cat ate the fish",
    "on the mat the cat sat",
]


class Brute:
    """Plain-Python trigram model with the same rules (test oracle)."""

    def __init__(self, sentences):
        self.c = Counter()
        self.total = 0
        for s in sentences:
            t = ["s_1", "s_1"] + s.split() + ["s_2"]
            self.total += len(t)
            for i in range(len(t)):
                self.c[(t[i],)] += 1
                if i >= 1:
                    self.c[(t[i - 1], t[i])] += 1
                if i >= 2:
                    self.c[(t[i - 2], t[i - 1], t[i])] += 1
        self.vocab = [k[0] for k in self.c if len(k) == 1]
        self.V = len(self.vocab)

    def p(self, w2, w1, w):
        p1 = (self.c[(w,)] + 1) / (self.total + self.V)
        p2 = (self.c[(w1, w)] + 1) / (self.c.get((w1,), 0) + self.V)
        p3 = (self.c[(w2, w1, w)] + 1) / (self.c.get((w2, w1), 0) + self.V)
        return 0.99 * p1 + 0.003 * p2 + 0.007 * p3

    def best(self, w2, w1):
        cands = [w for w in self.vocab if w not in ("s_1", "s_2")]
        return sorted(cands, key=lambda w: (-self.p(w2, w1, w), w))[0]

    def logprob(self, tokens):
        t = ["s_1", "s_1"] + tokens + ["s_2"]
        return sum(math.log2(self.p(t[i - 2], t[i - 1], t[i])) for i in range(2, len(t)))

    def fill(self, masked):
        toks = list(masked)
        for i, x in enumerate(toks):
            if x == "[*]":
                t = ["s_1", "s_1"] + toks[:i]
                toks[i] = self.best(t[-2], t[-1])
        return toks


@pytest.fixture(scope="module")
def model(spark):
    s = spark.createDataFrame([(i, "m", x.split()) for i, x in enumerate(CORPUS)],
                              "sid long, corpus string, tokens array<string>")
    counts = N.ngram_counts(s)
    return s, counts, N.totals_from_counts(counts), Brute(CORPUS)


def test_counts_and_totals(model):
    s, counts, totals, b = model
    got = {(r["n"], r["gram"]): r["cnt"] for r in counts.collect()}
    exp = {(len(k), " ".join(k)): v for k, v in b.c.items()}
    assert got == exp
    t = totals.first()
    assert (t["total"], t["vocab"]) == (b.total, b.V)


def test_sentence_scores(model):
    s, counts, totals, b = model
    r = {x["sid"]: x["log_prob"] for x in N.sentence_scores(s, counts, totals).collect()}
    for i, x in enumerate(CORPUS):
        assert r[i] == pytest.approx(b.logprob(x.split()), rel=1e-12)


def test_best_next_token_matches_full_scan(spark, model):
    s, counts, totals, b = model
    words = sorted(set(" ".join(CORPUS).split())) + ["s_1", "unseen"]
    ctx = spark.createDataFrame([("m", a, c) for a in words for c in words], "corpus string, w2 string, w1 string")
    got = {(r["w2"], r["w1"]): r["token"] for r in N.best_next_token(ctx, counts, totals).collect()}
    for (a, c), tok in got.items():
        assert tok == b.best(a, c), (a, c)
    assert len(got) == len(words) ** 2


def test_fill_masks_matches_sequential_fill(spark, model):
    s, counts, totals, b = model
    masked = [["[*]", "[*]", "sat", "[*]", "the", "[*]"], ["the", "[*]", "[*]", "[*]"], ["a", "cat"],
              ["zebra", "[*]", "quokka", "ibis", "[*]"]]           # contexts outside the vocabulary
    df = spark.createDataFrame([(i, m, "m") for i, m in enumerate(masked)],
                               "sid long, masked array<string>, corpus string")
    out = {r["sid"]: r for r in fill_masks(df, counts, totals).collect()}
    for i, m in enumerate(masked):
        exp = b.fill(m)
        assert out[i]["filled_sentence"] == " ".join(exp)
        assert out[i]["log_prob"] == pytest.approx(round(b.logprob(exp), 6), abs=1e-6)


def test_top_k_candidates_exact(spark, model):
    s, counts, totals, b = model
    ctx = spark.createDataFrame([("m", "s_1", "s_1"), ("m", "the", "cat"), ("m", "zzz", "yyy")],
                                "corpus string, w2 string, w1 string")
    full = G.next_token_distribution(ctx, counts, totals)
    exp = G.top_k(full, ["corpus", "w2", "w1"], 3, renormalise=False)
    got = G.top_k_candidates(ctx, counts, totals, 3)
    key = lambda r: (r["w2"], r["w1"], r["rank"], r["token"])
    assert sorted(map(key, got.collect())) == sorted(map(key, exp.collect()))


def test_distribution_sums_to_one_and_strategies(spark, model):
    s, counts, totals, b = model
    ctx = spark.createDataFrame([("m", "s_1", "s_1")], "corpus string, w2 string, w1 string")
    d = G.next_token_distribution(ctx, counts, totals)
    keys = ["corpus", "w2", "w1"]
    # boundary marks are not candidates, so the mass is below one
    assert d.agg(F.sum("p")).first()[0] < 1.0
    k = G.top_k(d, keys, 3)
    assert k.agg(F.sum("p")).first()[0] == pytest.approx(1.0)
    n = G.nucleus(d, keys, 0.5)
    assert n.agg(F.sum("p")).first()[0] == pytest.approx(1.0)
    t = G.temperature_and_repetition(d, keys, 0.7, 1.2, F.array(F.lit("the")))
    assert t.agg(F.sum("p")).first()[0] == pytest.approx(1.0)
    g = G.greedy_choice(d, keys).first()["token"]
    assert g == b.best("s_1", "s_1")


def test_generate_text_lengths(spark, model):
    s, counts, totals, b = model
    prompts = spark.createDataFrame([(1, "m", ["the"]), (2, "m", [])], "pid long, corpus string, tokens array<string>")
    out = {r["pid"]: r["tokens"] for r in G.generate_text(prompts, counts, totals, 4, "top_k", 3).collect()}
    assert len(out[1]) == 5 and len(out[2]) == 4
    assert all(t in b.vocab for t in out[1] + out[2])
    greedy = {r["pid"]: r["tokens"] for r in G.generate_text(prompts, counts, totals, 2, "greedy").collect()}
    assert greedy[2][0] == b.best("s_1", "s_1")


def test_errors(spark, model):
    s, counts, totals, b = model
    with pytest.raises(ValueError, match="order 4"):
        N.check_order(4)
    with pytest.raises(ValueError, match="'pmi'"):
        N.collocations(s.withColumn("doc_id", F.lit(1)), metric="pmi")
    with pytest.raises(ValueError, match="Unknown strategy"):
        G.generate_text(s.select(F.col("sid").alias("pid"), "corpus", "tokens"), counts, totals, 1, "beam")


def test_mask_counts(spark):
    df = spark.createDataFrame([(1, ["w"] * 25), (2, ["w"] * 3), (3, ["w"] * 9)], "sid long, t array<string>")
    r = {x["sid"]: sum(1 for y in x["masked"] if y == "[*]")
         for x in N.mask_sentences(df, "t", "sid", 42, 10).collect()}
    assert r == {1: 2, 2: 1, 3: 1}                     # max(1, int(len * 10 / 100))

"""Sampling without distributions against full scans of the vocabulary, and the rank helper against a sort."""

import hashlib

import pytest
from pyspark.sql import functions as F

from quire.operators import generate as G
from quire.operators import ngrams as N
from quire.operators.ranking import range_rank

from test_ngrams import CORPUS, Brute

OTHER = ["one fish two fish", "red fish blue fish one", "two red two blue"]


@pytest.fixture(scope="module")
def model(spark):
    rows = [(f"{c}{i}", c, x.split()) for c, texts in (("m", CORPUS * 3), ("f", OTHER)) for i, x in enumerate(texts)]
    s = spark.createDataFrame(rows, "sid string, corpus string, tokens array<string>")
    counts = N.ngram_counts(s)
    return counts, N.totals_from_counts(counts), {"m": Brute(CORPUS * 3), "f": Brute(OTHER)}


def uniform(*parts):
    return int(hashlib.md5("-".join(map(str, parts)).encode()).hexdigest()[:13], 16) / 16 ** 13


def full_scan(b, toks, history, k, p, temperature, penalty):
    """(token, share) kept after (w2, w1), best first, from the whole vocabulary."""
    w2, w1 = (["s_1", "s_1"] + toks)[-2:]
    rows = [(b.p(w2, w1, w) ** (1 / temperature) / (penalty if w in history else 1), b.c[(w,)], w) for w in b.vocab if w not in ("s_1", "s_2")]
    rows = [(s, w) for s, _, w in sorted(rows, key=lambda r: (-r[0], -r[1], r[2]))][:k]
    total, kept, before = sum(s for s, _ in rows), [], 0.0
    for s, w in rows:
        if p is None or before / total <= p:
            kept.append((w, s))
        before += s
    total = sum(s for _, s in kept)
    return [(w, s / total) for w, s in kept]


def extended(b, pid, toks, until, seed, k, p, temperature, penalty, random_start):
    toks, n = list(toks), len(toks)
    if random_start and not toks:
        words = sorted((w for w in b.vocab if w not in ("s_1", "s_2")), key=lambda w: (-b.c[(w,)], w))
        toks.append(words[int(uniform(seed, pid, "start") * len(words))])
    while len(toks) < until:
        u, cum, kept = uniform(seed, pid, len(toks) - n), 0.0, full_scan(b, toks, toks, k, p, temperature, penalty)
        for w, share in kept:
            cum += share
            if cum >= u:
                break
        toks.append(w)
    return toks


PROMPTS = [(i, c, t) for c in ("m", "f") for i, t in ((f"{c}1", ["the", "cat"]), (f"{c}2", []), (f"{c}3", ["zebra"]), (f"{c}4", ["fish", "two", "one", "a"]),
                                                     (f"{c}5", "a b c d e f g h i j k".split()))]


@pytest.mark.parametrize("k,p,temperature,penalty", [(4, 0.9, 0.7, 1.2), (None, 0.8, 1.0, 1.0), (None, 0.6, 0.7, 1.5), (3, None, 2.0, 3.0), (1, None, 1.0, 1.0),
                                                     (None, None, 1.3, 1.2)])
def test_extend_text_is_a_full_scan(spark, model, k, p, temperature, penalty):
    counts, totals, brute = model
    prompts = spark.createDataFrame(PROMPTS + [("x1", "unknown corpus", ["one"])], "pid string, corpus string, tokens array<string>")
    got = {r["pid"]: r["tokens"] for r in G.extend_text(prompts, counts, totals, 7, k, p, temperature, penalty, seed=9).collect()}
    assert got.pop("x1") == ["one"]
    for pid, c, toks in PROMPTS:
        assert got[pid] == extended(brute[c], pid, toks, 7, 9, k, p, temperature, penalty, True), pid


@pytest.mark.parametrize("strategy,k,p", [("greedy", 1, None), ("top_k", 3, None), ("nucleus", None, 0.8)])
def test_strategies(spark, model, strategy, k, p):
    counts, totals, brute = model
    prompts = spark.createDataFrame(PROMPTS, "pid string, corpus string, tokens array<string>")
    got = {r["pid"]: r["tokens"] for r in G.generate_text(prompts, counts, totals, 2, strategy, 3, seed=3).collect()}
    for pid, c, toks in PROMPTS:
        assert got[pid] == extended(brute[c], pid, toks, len(toks) + 2, 3, k, p, 1.0, 1.0, False), pid


def test_nucleus_sizes(spark, model):
    counts, totals, brute = model
    words = ["s_1", "the", "cat", "fish", "zebra"]
    ctx = spark.createDataFrame([(c, a, b) for c in brute for a in words for b in words], "corpus string, w2 string, w1 string")
    for r in G.nucleus_sizes(ctx, counts, totals, 0.7, 0.8).collect():
        rows = full_scan(brute[r["corpus"]], [r["w2"], r["w1"]], [], None, None, 0.8, 1.0)
        kept = full_scan(brute[r["corpus"]], [r["w2"], r["w1"]], [], None, 0.7, 0.8, 1.0)
        assert r["kept"] == len(kept) and r["share"] == pytest.approx(sum(s for _, s in rows[:len(kept)]))


def test_bad_settings(spark, model):
    counts, totals, _ = model
    prompts = spark.createDataFrame(PROMPTS, "pid string, corpus string, tokens array<string>")
    for bad in ({"k": 0}, {"p": 0.0}, {"p": 1.5}, {"temperature": 0.0}, {"penalty": -1.0}):
        with pytest.raises(ValueError):
            G.extend_text(prompts, counts, totals, 5, **bad)


def test_range_rank(spark):
    rows = [(i, "a" if i % 3 else "b", i * 7919 % 13) for i in range(500)] + [(500, None, 1)]
    df = spark.createDataFrame(rows, "id long, g string, x long").repartition(5)
    got = {r["id"]: r["rank"] for r in range_rank(df, [F.col("x").desc(), F.col("id").asc()]).collect()}
    assert got == {r[0]: n for n, r in enumerate(sorted(rows, key=lambda r: (-r[2], r[0])), 1)}
    got = {r["id"]: r["rank"] for r in range_rank(df.filter("g is not null"), [F.col("x").asc(), F.col("id").asc()], ["g"]).collect()}
    for g in "ab":
        assert {i: n for i, n in got.items() if rows[i][1] == g} == {
            r[0]: n for n, r in enumerate(sorted((r for r in rows if r[1] == g), key=lambda r: (r[2], r[0])), 1)}
    assert range_rank(df.limit(0), [F.col("id").asc()]).count() == 0


def test_counts_that_begin_with_the_mark(spark):
    """N11 at the sentence start needs every token and the grams after the mark; no other gram is counted."""
    s = spark.createDataFrame([("a", ["x", "y"]), ("a", ["x", "z", "x"]), ("b", ["y", "s_1", "x"]), (None, ["x"])], "corpus string, tokens array<string>")
    rows = {tuple(r) for r in N.ngram_counts(s).collect()}
    assert {tuple(r) for r in N.ngram_counts(s, begins=N.BOS).collect()} == {
        r for r in rows if r[1] == 1 or r[2].split(" ")[0] == N.BOS}


def test_nucleus_of_a_large_context_is_cut_in_ranges(spark):
    """N21 by ranges: the same tokens as one running sum, nulls in the keys too, and no window over a whole context."""
    rows = [(c, "x", f"t{i:04d}", float(1 + i * 7 % 97)) for c in ("a", None) for i in range(2000)]
    total = sum(r[3] for r in rows) / 2
    d = spark.createDataFrame([(c, x, t, p / total) for c, x, t, p in rows], "corpus string, w1 string, token string, p double")
    got = {(r.corpus, r.token): r.p for r in G.nucleus(d, ["corpus", "w1"], 0.5).collect()}
    cum, kept = 0.0, []
    for _, _, t, p in sorted((r for r in rows if r[0] == "a"), key=lambda r: (-r[3], r[2])):
        if cum <= 0.5:
            kept.append((t, p))
        cum += p / total
    mass = sum(p for _, p in kept)
    assert {k: round(v, 12) for k, v in got.items()} == {(c, t): round(p / mass, 12) for c in ("a", None) for t, p in kept}

"""Scoring by blocks: distinct grams are asked for once, and sentences of one id and model count as one."""

import math
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from quire.operators import ngrams as N
from quire.operators.gram_blocks import Grams, _buckets, _text_hashes, _words_asked, asked, mean_vectors, position_counts

ROWS = [("a", "x", ["le", "chat", "dort"]), ("b", "x", ["le", "chat", "mange", "le", "chat"]), ("c", "y", ["the", "cat"]), ("d", "y", [])]


def _brute(rows, model):
    counts, out = {n: Counter() for n in (1, 2, 3)}, {}
    for _, corpus, t in rows:
        p = ["s_1", "s_1", *t, "s_2"]
        for n in (1, 2, 3):
            counts[n].update((corpus, *p[i:i + n]) for i in range(len(p) - n + 1))
    for sid, corpus, t in rows:
        m = model(corpus)
        total = sum(c for k, c in counts[1].items() if k[0] == m)
        vocab = sum(k[0] == m for k in counts[1])
        p = ["s_1", "s_1", *t, "s_2"]
        for i in range(2, len(p)):
            g = (m, *p[i - 2:i + 1])
            p1 = (counts[1][m, p[i]] + 1) / (total + vocab)
            p2 = (counts[2][m, *p[i - 1:i + 1]] + 1) / (counts[1][m, p[i - 1]] + vocab)
            p3 = (counts[3][g] + 1) / (counts[2][g[:3]] + vocab)
            out[sid, i + 1] = p[i], p1, p2, p3
    return out


def test_positions_equal_brute_force_under_both_models(spark):
    s = spark.createDataFrame(ROWS, "sid string, corpus string, tokens array<string>")
    counts = N.ngram_counts(s)
    for model in (lambda c: c, lambda c: "x" if c == "y" else "y"):
        asked_of = s.withColumn("model", F.when(F.lit(model("x") == "x"), F.col("corpus")).otherwise(F.when(F.col("corpus") == "x", "y").otherwise("x")))
        got = N.position_probabilities(asked_of, counts, N.totals_from_counts(counts), model_col="model").collect()
        expected = _brute(ROWS, model)
        assert {(r["sid"], r["pos"]) for r in got} == set(expected) and len(got) == len(expected)
        for r in got:
            token, *p = expected[r["sid"], r["pos"]]
            assert r["token"] == token
            assert all(math.isclose(r[k], x) for k, x in zip(("p1", "p2", "p3"), p))


def test_repeated_ids_are_one_sentence(spark):
    twice = spark.createDataFrame(ROWS[:2] + ROWS[:1] + [("b", "x", ["le"])], "sid string, corpus string, tokens array<string>")
    counts = N.ngram_counts(twice)
    got = N.position_probabilities(twice, counts, N.totals_from_counts(counts)).orderBy("sid", "pos").collect()
    assert [r["pos"] for r in got] == [3, 4, 5, 6, 3, 4, 5, 6, 7, 8]
    assert [r["token"] for r in got if r["sid"] == "b"] == ["le", "s_2", "mange", "le", "chat", "s_2"]


def test_a_block_asks_once_for_each_gram():
    def table(copies):
        return pa.table({"block": pa.array([0] * copies, pa.int64()), "sid": [str(i) for i in range(copies)],
                         "corpus": ["x"] * copies, "tokens": pa.array([["a", "b", "a", "b"]] * copies, pa.list_(pa.string()))})
    ask = asked("s_1", "s_2")
    assert ask(table(1000)).drop(["i"]) == ask(table(1)).drop(["i"])


def test_mean_vectors_of_repeated_ids_and_unknown_words(spark):
    s = spark.createDataFrame([("a", ["x", "y", "x"]), ("b", ["nowhere"]), ("c", None), ("d", ["y"]), ("d", ["x"])],
                              "sid string, tokens array<string>")
    v = spark.createDataFrame([("x", [1.0, 0.0]), ("y", [4.0, 3.0]), ("z", [9.0, 9.0])], "word string, vec array<double>")
    got = sorted((r["sid"], r["n_known"], r["mean"]) for r in mean_vectors(s, v, 2).collect())
    assert got == [("a", 3, [2.0, 1.0]), ("b", 0, [0.0, 0.0]), ("c", 0, [0.0, 0.0]), ("d", 2, [2.5, 1.5]), ("d", 2, [2.5, 1.5])]


def test_a_block_asks_once_for_each_word():
    t = pa.table({"block": pa.array([0] * 500, pa.int64()), "tokens": pa.array([["a", "b", "a"]] * 500, pa.list_(pa.string()))})
    assert _words_asked(t).column("word").to_pylist() == ["a", "b"]


def test_counts_meet_by_text_whatever_the_tokens_are(spark):
    """A gram's bucket is that of its text; null grams are counted as one and never found."""
    rows = [("a", "x", ["a b", "c"]), ("b", "x", ["a", "b c"]), ("c", "x", [None, "c"]), ("d", None, ["c", ""]), ("e", "y", ["é", "é", "é"])]
    s = spark.createDataFrame(rows, "sid string, corpus string, tokens array<string>")
    expected = Counter()
    for _, corpus, t in rows:
        p = ["s_1", "s_1", *t, "s_2"]
        for n in (1, 2, 3):
            for i in range(len(p) - n + 1):
                g = p[i:i + n]
                expected[corpus, n, None if None in g else " ".join(g)] += 1
    counts = N.ngram_counts(s)
    got = counts.collect()
    assert len(got) == len(expected) and {(r["corpus"], r["n"], r["gram"]): r["cnt"] for r in got} == dict(expected)
    lists = {r["sid"]: r.asDict() for r in position_counts(s, counts, "s_1", "s_2", True).collect()}
    assert set(lists) == {"a", "b", "c", "e"}
    assert lists["a"]["c2"] == [1, 2, 2] and lists["a"]["c3"] == [1, 2, 2] and lists["a"]["d3"] == [3, 1, 2]
    assert lists["c"]["c1"] == [0, 2, 3] and lists["c"]["c2"] == [0, 0, 2] and lists["c"]["token"] == [None, "c", "s_2"]


def test_hashes_of_joined_texts_follow_from_their_parts():
    g = Grams(pa.array(["x", "x"]), pa.array([["to", "be", "", "ü"], ["be"]]), "s_1", "s_2")
    corpus, n, gram = g.rows()
    codes = np.zeros(len(gram), np.uint64) + _text_hashes(pa.array(["x"]))[0][0]
    assert (_buckets(codes, _text_hashes(gram)[0], 97) == g.buckets(97)).all() and len(set(g.buckets(97).tolist())) > 5


def test_rows_of_grams_are_not_shuffled(spark):
    """blocks and buckets exchange a few packed tables, not a row per gram or sentence."""
    s = spark.createDataFrame([(str(i), "x", [f"w{i}", f"v{i % 7}", f"u{i % 11}"]) for i in range(300)], "sid string, corpus string, tokens array<string>")
    plan = N.ngram_counts(s)._jdf.queryExecution().optimizedPlan().toString()
    assert "FlatMapGroupsInArrow" in plan and "Aggregate" not in plan

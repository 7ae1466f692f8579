"""TF-IDF by packed buckets of terms and ids (findings F16, F17, F18 of round 4)."""

import math
from collections import Counter, defaultdict

import pytest

from quire.operators import features as FT

ROWS = [("a", "the cat the dog"), ("b", "cat dog cat"), ("b", "the end"), (None, "cat cat"), (None, "dog"), ("c", None), ("d", "x")]


@pytest.mark.parametrize("block", [1 << 20, 3])
def test_statistics_and_weights_equal_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(FT, "BLOCK_TOKENS", block)
    batch = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(batch)
    spark.conf.set(batch, "2")
    try:
        _statistics_and_weights(spark)
    finally:
        spark.conf.set(batch, before)


def _statistics_and_weights(spark):
    docs = spark.createDataFrame(ROWS, "id string, text string").coalesce(1)
    tf = FT.term_frequencies(docs, "id", "text")
    rows = [(r["id"], r["term"], r["tf"]) for r in tf.collect()]
    df, total = Counter(t for _, t, _ in rows), Counter()
    for _, t, n in rows:
        total[t] += n
    got = FT.term_statistics(tf).collect()
    assert len(got) == len(df) and {r["term"]: (r["df"], r["total_cnt"]) for r in got} == {t: (df[t], total[t]) for t in df}
    vocab = spark.createDataFrame([("cat", 1.5), ("dog", 2.0), ("the", 1.0)], "term string, idf double")
    idf, square = {"cat": 1.5, "dog": 2.0, "the": 1.0}, defaultdict(float)
    kept = [(i, t, (1 + math.log(n)) * idf[t]) for i, t, n in rows if t in idf]
    for i, _, w in kept:
        square[i] += w * w                     # rows of one id, or of none, have one length
    expected = sorted((str(i), t, round(w / math.sqrt(square[i]), 9)) for i, t, w in kept)
    w = FT.tfidf_transform(docs, vocab, "id", "text", tf=tf)
    assert sorted((str(r["id"]), r["term"], round(r["weight"], 9)) for r in w.collect()) == expected
    assert dict(w.dtypes) == {"id": "string", "term": "string", "weight": "double"}


def test_no_row_per_term_is_shuffled(spark):
    docs = spark.createDataFrame(ROWS, "id string, text string")
    vocab = spark.createDataFrame([("cat", 1.5)], "term string, idf double")
    for d in (FT.term_statistics(FT.term_frequencies(docs, "id", "text")), FT.tfidf_transform(docs, vocab, "id", "text")):
        plan = d._jdf.queryExecution().optimizedPlan().toString()
        assert "FlatMapGroupsInArrow" in plan and "Aggregate" not in plan and "Window" not in plan
    empty = docs.limit(0)
    assert FT.tfidf_fit(empty, "id", "text").count() == 0 and FT.tfidf_transform(empty, vocab, "id", "text").count() == 0

"""Grams that reach a count, against plain counting."""

from collections import Counter, defaultdict

import pytest

from quire.operators import frequent_grams as FG
from quire.operators import ngrams as N

MARKS = ("s_1", "s_2")
ROWS = [("a", 1, "x y z x y".split()), ("a", 1, "x y".split()), ("a", 2, "x y z s_1 x y".split()), ("a", None, "x y".split()),
        ("b", 1, "x y é".split()), ("b", 2, ["x y", "z"]), ("b", 3, ["x", "y z"]), (None, 4, "x y z".split()), ("b", 5, []), ("b", 6, None),
        ("b", 7, ["y", None, "y"]), ("a", 3, ["s_1 q", "r", "s_2"]), ("a", 4, ["s_1 q", "r"])]


def plain(sizes):
    by = defaultdict(Counter)
    for corpus, doc, t in ROWS:
        t = ["null" if w is None else w for w in t or []]
        for n in sizes:
            for i in range(len(t) - n + 1):
                g = " ".join(t[i:i + n])
                if not (set(t) & set(MARKS) and set(g.split(" ")) & set(MARKS)):
                    by[corpus, n, g][doc] += 1
    return by


@pytest.fixture(scope="module")
def sentences(spark):
    return spark.createDataFrame(ROWS, "corpus string, doc_id int, t array<string>")


@pytest.mark.parametrize("threshold", [1, 2, 3])
@pytest.mark.parametrize("block_tokens", [8, 1 << 20])
def test_totals_and_documents(sentences, monkeypatch, threshold, block_tokens):
    monkeypatch.setattr(FG, "BLOCK_TOKENS", block_tokens)
    monkeypatch.setattr(FG, "BUCKET_HASHES", 7)
    sizes = (1, 2, 3)
    kept = {k: c for k, c in plain(sizes).items() if sum(c.values()) >= threshold}
    f = N.frequent_ngrams(sentences, sizes, threshold, "doc_id")
    assert {(r.corpus, r.n, r.gram): (r.total_cnt, r.df) for r in f.totals().collect()} == {k: (sum(c.values()), len(c)) for k, c in kept.items()}
    per = Counter((k[0], d) for k, c in kept.items() for d in c if k[0] is not None)
    assert {(r.corpus, r.doc): r.n_grams for r in f.per_document().collect()} == per
    counts = {(k[0], d, k[1], k[2]): (n, len(c)) for k, c in kept.items() for d, n in c.items() if k[0] is not None}
    assert {(r.corpus, r.doc, r.n, r.gram): (r.cnt, r.df) for r in f.document_counts().collect()} == counts


def test_no_row_per_occurrence(sentences):
    """Rare grams stay in their blocks: only what can reach the count leaves them as text."""
    f = N.frequent_ngrams(sentences, (2,), 4, "doc_id")
    assert {(r.corpus, r.gram) for r in f.candidates().collect()} == {("a", "x y")}


def test_nothing_there(spark):
    none = spark.createDataFrame([], "corpus string, doc_id int, t array<string>")
    assert N.frequent_ngrams(none, (2, 3), 2, "doc_id").totals().collect() == []

"""Lexical search, pivot search and importance resampling against brute force, on odd rows too."""

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from llm_tables import SMALL, odd_docs  # noqa: F401

LAST = float("inf")
LAST_KEY = "~"


@pytest.fixture(scope="module")
def items(spark):
    return spark.createDataFrame([(1, "word1 word2 word2 Word60 w5"), (2, None), (3, "!!!"), (4, "nowhere"), (5, "three SHORT words x"),
                                  (5, "three SHORT words x"), (6, "dup row text"), (None, "word60 other")], "item_id long, text string")


@pytest.fixture(params=["small", "odd", "empty"])
def table(request, spark, odd_docs):  # noqa: F811
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    return {"small": docs, "odd": odd_docs, "empty": docs.limit(0)}[request.param]


def terms(text, pattern=rb"[0-9A-Za-z\x80-\xff]+"):
    return [w.decode() for w in re.findall(pattern, (text or "").encode().lower())]


def ranked(docs, items, k):
    """(item, rank, doc, score) by scoring every document for every item."""
    docs = [(d, Counter(terms(t))) for d, t in docs]
    docs = [(d, c) for d, c in docs if c]
    n_docs, n_terms = len(docs), sum(sum(c.values()) for _, c in docs)
    df = Counter(t for _, c in docs for t in c)
    out = []
    for item, text in {(i, t) for i, t in items if t is not None}:
        scores = []
        for d, c in docs:
            m = 75 + 25 * sum(c.values()) * n_docs // n_terms
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10 ** 9 * c[t] // (1000 * c[t] + 12 * m)) for t in terms(text) if c[t])
            if s > 0:
                scores.append((-s, LAST if d is None else d))
        out += [(item, r, None if d == LAST else d, -s) for r, (s, d) in enumerate(sorted(scores)[:k], 1)]
    return Counter(out)


@pytest.mark.parametrize("part_bytes", [1 << 24, 2000])
def test_op11_ranks(table, items, part_bytes):
    from quire.llm.nra_search import rank_documents
    got = rank_documents(table, items, k=5, part_bytes=part_bytes, block_bytes=30)
    want = ranked([(r["doc_id"], r["text"]) for r in table.collect()], [tuple(r) for r in items.collect()], 5)
    assert Counter((r["item_id"], r["rank"], r["doc_id"], r["score"]) for r in got.collect()) == want


def test_op11_any_id_and_clashing_columns(spark, items):
    from quire.llm.nra_search import rank_documents
    rows = [(f"d{i % 7}", f"word1 word{i % 5} w{i}", 1, 2, 3) for i in range(60)] + [(None, "word1 word2", 1, 2, 3)] * 20
    docs = spark.createDataFrame(rows, "key string, text string, id int, score int, rank int")
    got = rank_documents(docs, items, k=9, id_col="key", part_bytes=100)
    assert got.columns == ["item_id", "rank", "key", "score", "item_key"]
    want = ranked([(LAST_KEY if r[0] is None else r[0], r[1]) for r in rows], [tuple(r) for r in items.collect()], 9)
    assert Counter((r["item_id"], r["rank"], LAST_KEY if r["key"] is None else r["key"], r["score"]) for r in got.collect()) == want


@pytest.mark.parametrize("seed", range(6))
def test_nra_reads_only_until_settled(seed):
    from quire.llm.nra_search import nra
    rng = np.random.default_rng(seed)
    n, k = 300, 7
    total, lists = np.zeros(n, np.int64), []
    for _ in range(9):
        docs = rng.choice(n, rng.integers(1, n), replace=False).astype(np.int32)
        impacts = np.sort(rng.integers(1, 9, len(docs)))[::-1].astype(np.int32)
        weight = int(rng.choice([1, 5, 100, 10_000]))
        total[docs] += impacts.astype(np.int64) * weight
        lists.append((docs, impacts, weight))
    order = np.lexsort((np.arange(n), -total))
    for floor in (0, int(total[order[k - 1]]), int(total[order[2]]), int(total.max()) + 1):
        want = [d for d in order if total[d] >= max(1, floor)][:k]
        found, score = nra(lists, n, k, floor)
        assert found.tolist() == want and score.tolist() == total[want].tolist()
    found, score = nra(lists, n, k, 0, steps=1)
    assert (score <= total[found]).all()


def best_vectors(rows, k):
    whole = [(i, [math.floor(1024 * x) for x in v]) for i, v in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for q, v in {(i, tuple(v)) for i, v in whole if i is not None and i % 100 == 0}:
        scores = sorted((-sum(a * b for a, b in zip(v, w)), LAST if i is None else i) for i, w in whole if i != q)
        out += [(q, r, None if i == LAST else i, -s) for r, (s, i) in enumerate(scores[:k], 1)]
    return Counter(out)


@pytest.mark.parametrize("kind", ["small", "odd", "copies", "empty"])
def test_op12_top_k(spark, kind):
    from quire.llm.pivot_search import exact_top_k
    rng = np.random.default_rng(5)
    if kind == "small":
        rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{SMALL}/embeddings.parquet").collect()]
    elif kind == "odd":
        rows = [(0, [1.0, -2.0, 0.5]), (100, None), (200, [1.0, None, 0.0]), (300, [float("nan"), 0.0, 0.0]), (400, [float("inf"), 0.0, 0.0]), (1, [0.1, 0.2, 0.3]),
                (1, [0.1, 0.2, 0.3]), (None, [0.1, 0.2, 0.3]), (None, [3.0, -3.0, 1.0]), (500, []), (2, [5.0]), (600, [1e5, 2e5, -1e5]), (600, [1e5, 2e5, -1e5]), (700, [-1.0] * 3)]
    elif kind == "copies":
        rows = [(i, [0.25, -0.5, 1.0]) for i in range(700)] + [(i, rng.normal(size=3).tolist()) for i in range(700, 1000)]
    else:
        rows = []
    table = spark.createDataFrame([(i, v, 1, 2) for i, v in rows], "vec_id long, embedding array<double>, score int, d int")
    got = exact_top_k(table, k=4, n_pivots=5, block_numbers=20)
    assert Counter((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in got.collect()) == best_vectors(rows, 4)


def test_op12_stops_early():
    from quire.llm import pivot_search as P
    rng = np.random.default_rng(1)
    centre = rng.integers(-3000, 3000, (12, 8))
    rows = (centre[rng.integers(0, 12, 5000)] + rng.integers(-40, 40, (5000, 8))).astype(np.int64)
    pivots = P.choose_pivots(rows[:500], 24)
    d = P._distances(rows, pivots)
    block = P.QueryBlock(np.arange(5), rows[:5], d[:5], 3)
    block.look_at(np.arange(5000), rows, d)
    for i in range(5):
        score = rows @ rows[i]
        score[i] = score.min() - 1
        order = np.lexsort((np.arange(5000), -score))[:3]
        assert block.best[i][1].tolist() == order.tolist() and block.best[i][0].tolist() == score[order].tolist()
    assert block.evaluated < 0.5 * 5 * 5000


def importance(docs, target, percent=25):
    pattern = rb"[0-9a-z\x80-\xff]+"

    def features(text):
        w = terms(text, pattern)
        return len(w), Counter(zlib.crc32(g.encode()) % 10000 for g in w + [f"{a} {b}" for a, b in zip(w, w[1:])])
    docs = [(d, *features(t)) for d, t in docs]
    s, t = Counter(), Counter()
    for _, _, c in docs:
        s.update(c)
    for x in target:
        t.update(features(x)[1])
    s_all, t_all = sum(s.values()), sum(t.values())
    rows = []
    for d, n, c in docs:
        total = sum(v * math.floor(1000 * math.log((t[b] + 1.0) * (s_all + 10000.0) / ((s[b] + 1.0) * (t_all + 10000.0)))) for b, v in c.items())
        weight = total // sum(c.values()) if c else 0
        h = int(hashlib.sha256(f"7:{'' if d is None else d}".encode()).hexdigest()[:8], 16)
        rows.append((d, n, sum(c.values()), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    may = sorted((r for r in rows if r[1] >= 20), key=lambda r: (-r[4], LAST if r[0] is None else r[0]))
    take = percent * len(may) // 100
    out = [(*r, rank + 1 if rank < take else None) for rank, r in enumerate(may)] + [(*r, None) for r in rows if r[1] < 20]
    return Counter((d, f, w, s, r) for d, _, f, w, s, r in out)


@pytest.mark.parametrize("percent", [25, 100])
def test_op13_scores(spark, table, percent):
    from quire.llm.importance import importance_scores, resample
    target = spark.read.parquet(f"{SMALL}/benchmark.parquet")
    got = importance_scores(table, target, percent=percent)
    want = importance([(r["doc_id"], r["text"]) for r in table.collect()], [r["text"] for r in target.collect()], percent)
    assert Counter((r["doc_id"], r["n_features"], r["weight"], r["score"], r["rank"]) for r in got.collect()) == want
    if percent == 25:
        drawn = {d for d, *_, r in want if r is not None and d is not None}
        assert {r["doc_id"] for r in resample(table, target).collect()} == drawn


def test_op13_without_target_and_with_long_grams(spark):
    from quire.llm.importance import batch_features, importance_scores
    import pyarrow as pa
    docs = spark.createDataFrame([("a", "One two, three " * 9), (None, "x" * 300 + " é ünü " + "y" * 5000)], "doc_id string, text string")
    got = {r["doc_id"]: r["n_features"] for r in importance_scores(docs, docs.limit(0)).collect()}
    assert got == {"a": 53, None: 7}
    texts = ["One two three\tfour", None, "", "five", "é" * 400 + " five six seven " + "z" * 70]
    for _, _, n_words, of, found in batch_features(pa.array(texts), max_words=3, buckets=997):
        want = Counter()
        for row, t in enumerate(texts):
            w = terms(t, rb"[0-9a-z\x80-\xff]+")
            assert n_words[row] == len(w)
            want.update((row, zlib.crc32(" ".join(w[i:i + n]).encode()) % 997) for n in (1, 2, 3) for i in range(len(w) - n + 1))
        assert Counter(zip(of.tolist(), found.tolist())) == want


def test_parts_of_the_index_have_row_groups_of_their_own(spark):
    """a task that reads or writes several parts holds one of them."""
    import pyarrow.parquet as pq

    from quire.llm.nra_search import build_index
    docs = spark.createDataFrame([(i, " ".join(f"w{i}x{j}" for j in range(60_000))) for i in range(12)], "doc_id long, text string").coalesce(1)
    index = build_index(docs, part_bytes=1 << 20)
    groups = [pq.ParquetFile(f).metadata for f in (x.removeprefix("file://").removeprefix("file:") for x in index.parts.inputFiles())]
    assert sum(m.num_rows for m in groups) > 4
    assert all(m.row_group(i).num_rows <= 5 for m in groups for i in range(m.num_row_groups)) and max(m.num_row_groups for m in groups) > 2

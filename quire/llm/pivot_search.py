"""Exact top-k search by inner product with a pivot table.

A vector becomes integers, floor(scale * x).  For integer vectors q and x,
q . x = (|q|^2 + |x|^2 - d(q, x)^2) / 2, so a lower bound on the distance d is
an upper bound on the score.  Many pivots p are chosen once (farthest-first
over a bounded sample: the ``SAMPLE`` rows with the least hash of their id),
and the pivot table holds each row's distance to every pivot.  By the triangle
inequality d(q, x) >= max over p of |d(q, p) - d(x, p)|.

Queries travel to the rows in blocks of bounded size, rows stay where the
table's partitions put them.  A task goes through its rows tile by tile; for
each query it takes the tile's rows in the order of their bounds and stops at
the first whose bound is under the k-th best score so far: what follows cannot
be among the k best.  It returns its k best for each query once, at its end;
a window merges the tasks' answers.  Bounds are widened by more than the
rounding of doubles, and a row whose bound equals the k-th score is still
evaluated, so ties go to the smaller id exactly.

Odd input: null vectors and vectors with a null, infinite or NaN component
take no part; an empty vector scores 0; a shorter vector counts as if its
missing components were 0.  Ids are integers; a null id is never a query and
comes last among equal scores.  A query's own rows are those with its id;
repeated query rows (equal id and vector) are one query, other repeated rows
stay candidates of their own; one id with several vectors is a query for each,
told apart by ``query_key``.  Scores are 64-bit integers.  No rows: no result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quire.llm.common import discard, materialise, share, shared

SCALE = 1024
#: rows among which pivots are chosen, and how many are chosen
SAMPLE, PIVOTS = 2048, 64
#: numbers (components and pivot distances) of one block of queries
BLOCK_NUMBERS = 1 << 20
#: rows of the table that are bounded against a block at a time, and rows evaluated at a time
TILE, STEP = 4096, 128
_LAST = np.iinfo(np.int64).max


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """Rows of a list column as int64, filled up with 0."""
    sizes = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    out = np.zeros((len(column), width), np.int64)
    out[np.repeat(np.arange(len(column)), sizes), np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    return out


def _dot(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a @ b.T of integers; by doubles while they hold every partial sum exactly."""
    most = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * a.shape[1]
    if most < 2.0 ** 53:
        return np.rint(a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    return a @ b.T


def _distances(rows: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    out = np.empty((len(rows), len(pivots)))
    for j, p in enumerate(pivots.astype(np.float64)):
        out[:, j] = np.sqrt(((rows - p) ** 2).sum(axis=1))
    return out


def choose_pivots(sample: np.ndarray, n: int) -> np.ndarray:
    """Farthest-first: each pivot is the sample's row farthest from those chosen; fewer if the sample has no more distinct rows."""
    if not len(sample):
        return sample
    chosen, rows = [0], sample.astype(np.float64)
    far = ((rows - rows[0]) ** 2).sum(axis=1)
    while len(chosen) < n and far.max() > 0:
        chosen.append(int(far.argmax()))
        far = np.minimum(far, ((rows - rows[chosen[-1]]) ** 2).sum(axis=1))
    return sample[chosen]


def integer_vectors(vectors: DataFrame, id_col: str, vector_col: str, scale: int = SCALE) -> DataFrame:
    """(id long, v array<long>) of the rows whose vectors have no null and only finite components."""
    v = F.col("v")
    whole = v.isNotNull() & F.forall(v, lambda x: F.coalesce(F.abs(x) < float("inf"), F.lit(False)))
    return (vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("v"))
            .where(whole).select("id", F.transform(v, lambda x: F.floor(x * F.lit(float(scale))).cast("long")).alias("v")))


def pivot_table(rows: DataFrame, pivots: np.ndarray, width: int) -> DataFrame:
    """``rows`` with ``key`` (a hash of the vector) and ``d``, their distances to the pivots."""
    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, len(batch), TILE):
                part = batch.slice(a, TILE)
                d = _distances(_matrix(part.column(2), width), pivots)
                lists = pa.ListArray.from_arrays(pa.array(np.arange(len(part) + 1, dtype=np.int32) * len(pivots)), pa.array(d.ravel()))
                yield pa.RecordBatch.from_arrays([*part.columns, lists], names=["id", "key", "v", "d"])
    return rows.select("id", F.xxhash64("v").alias("key"), "v").mapInArrow(measure, "id long, key long, v array<long>, d array<double>")


class QueryBlock:
    """Queries of a block, and the k best rows that one task has found for each."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, distances: np.ndarray, k: int):
        self.ids, self.vectors, self.distances, self.k = ids, vectors, distances, k
        self.norms = _norms(vectors)
        self.best = [(np.zeros(0, np.int64), np.zeros(0, np.int64))] * len(ids)
        self.evaluated = 0

    def least(self, i: int) -> float:
        score = self.best[i][0]
        return float(score[-1]) if len(score) == self.k else -np.inf

    def look_at(self, ids: np.ndarray, rows: np.ndarray, distances: np.ndarray) -> None:
        norms = _norms(rows)
        for i in range(len(self.ids)):
            lower = np.zeros(len(ids))
            for j in range(distances.shape[1]):
                np.maximum(lower, np.abs(distances[:, j] - self.distances[i, j]), out=lower)
            both = self.norms[i] + norms
            bound = (both - lower * lower) / 2 + 1.0 + both * 1e-9
            self._search(i, bound, ids, rows)

    def _search(self, i: int, bound: np.ndarray, ids: np.ndarray, rows: np.ndarray) -> None:
        open_ = np.flatnonzero((bound >= self.least(i)) & (ids != self.ids[i]))
        open_ = open_[np.argsort(-bound[open_], kind="stable")]
        for a in range(0, len(open_), STEP):
            at = open_[a:a + STEP]
            if bound[at[0]] < self.least(i):
                break
            score = _dot(rows[at], self.vectors[i:i + 1])[:, 0]
            self.evaluated += len(at)
            may = score >= self.least(i)
            if may.any():
                score, found = np.concatenate([self.best[i][0], score[may]]), np.concatenate([self.best[i][1], ids[at[may]]])
                order = np.lexsort((found, -score))[:self.k]
                self.best[i] = (score[order], found[order])

    def answers(self) -> pa.RecordBatch:
        sizes = [len(s) for s, _ in self.best]
        nothing = [np.zeros(0, np.int64)]
        return pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(np.arange(len(sizes)), sizes)), pa.array(np.concatenate(nothing + [f for _, f in self.best])),
             pa.array(np.concatenate(nothing + [s for s, _ in self.best]))], names=["q", "found", "score"])


def _norms(rows: np.ndarray) -> np.ndarray:
    return (rows.astype(np.float64) ** 2).sum(axis=1)


def _block_answers(table: DataFrame, queries: pa.Table, k: int, width: int) -> DataFrame:
    """(q, found, score): each task's k best rows for each query of one block."""
    n = len(queries)
    d = np.array(queries.column("d").combine_chunks().flatten().to_numpy(zero_copy_only=False)).reshape(n, -1)
    block = QueryBlock(queries.column("id").to_numpy(), _matrix(queries.column("v").combine_chunks(), width), d, k)
    sent = share(table.sparkSession, block)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = shared(sent)
        for batch in batches:
            for a in range(0, len(batch), TILE):
                part = batch.slice(a, TILE)
                distances = part.column(2).flatten().to_numpy(zero_copy_only=False).reshape(len(part), -1)
                block.look_at(part.column(0).to_numpy(zero_copy_only=False), _matrix(part.column(1), width), distances)
        yield block.answers()
    answers = (table.select(F.coalesce("id", F.lit(int(_LAST))).alias("id"), "v", "d")
               .mapInArrow(search, "q long, found long, score long"))
    return answers, sent


def exact_top_k(vectors: DataFrame, is_query: Column | None = None, k: int = 10, id_col: str = "vec_id", vector_col: str = "embedding",
                scale: int = SCALE, n_pivots: int = PIVOTS, block_numbers: int = BLOCK_NUMBERS) -> DataFrame:
    """(query_id, rank, ``id_col``, score, query_key): the ``k`` rows with the highest inner products for each query.

    ``is_query`` is a condition on the column ``id``; by default ids divisible by 100.
    """
    spark = vectors.sparkSession
    rows = materialise(integer_vectors(vectors, id_col, vector_col, scale), "vectors")
    width = rows.agg(F.max(F.size("v"))).first()[0] or 0
    sample = rows.orderBy(F.xxhash64("id", "v")).limit(SAMPLE).select("v").toArrow().column("v").combine_chunks()
    pivots = choose_pivots(_matrix(sample, width), n_pivots)
    table = materialise(pivot_table(rows, pivots, width), "pivots")
    asked = table.where(F.col("id").isNotNull() & (is_query if is_query is not None else F.col("id") % 100 == 0)).dropDuplicates(["id", "key"])
    blocks = max(1, -(-asked.count() * (width + len(pivots)) // block_numbers))
    asked = materialise(asked.withColumn("block", F.pmod(F.xxhash64("id", "key"), F.lit(blocks))), "queries")
    out = None
    for b in range(blocks):
        queries = asked.where(F.col("block") == b).select("id", "key", "v", "d").orderBy("id", "key").toArrow()
        if not len(queries):
            continue
        answers, sent = _block_answers(table, queries, k, width)
        order = Window.partitionBy("q").orderBy(F.col("score").desc(), F.col("found").asc())
        names = spark.createDataFrame(list(zip(range(len(queries)), queries.column("id").to_pylist(), queries.column("key").to_pylist())),
                                      "q long, query_id long, query_key long")
        best = (answers.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).join(names, "q")
                .select("query_id", F.col("rank").cast("int").alias("rank"),
                        F.when(F.col("found") != int(_LAST), F.col("found")).alias(id_col), "score", "query_key"))
        best = materialise(best, f"best{b}")               # the block's work is done before its broadcast goes
        discard(sent)
        out = best if out is None else out.unionByName(best)
    if out is None:
        out = spark.createDataFrame([], f"query_id long, rank int, {id_col} long, score long, query_key long")
    return out

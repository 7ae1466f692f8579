"""Ranked lexical search with no random access (NRA) over impact-sorted lists.

Index.  One scan cuts the documents of each task into parts of about
``PART_BYTES`` of text; a part is one row with its own vocabulary and, for each
term, the list of its documents, written as a row group of its own, so that a
task holds one part whatever it reads.  Corpus figures (documents, terms, document
frequencies) are sums over the parts; with them a second scan, over the index
only, turns each posting into its impact and sorts every list by impact,
highest first.  Documents are never shuffled.

Search.  Items travel to the parts in blocks of bounded size.  Within a part
the lists of an item are read in step, from high impacts down, never by
document: each document has a lower bound (what was read of it) and an upper
bound (plus the largest unread impact of each list it was not yet seen in).
Reading stops when every document whose upper bound reaches the least score
that still counts has equal bounds: then membership, ties and final scores
are all settled.  That least score is the k-th best lower bound, or ``floor``
if higher: a first pass reads the top of the lists only and returns a few lower
bounds from each part, whose k-th best over all parts holds for the second.

Odd input: a null or term-less document is in no list and not counted; a null
or term-less item, or one none of whose terms occur, has no row.  Ids may have
any type that sorts; null ids come last among equal scores.  Repeated document
rows are documents of their own; item rows with equal id and text are one item,
one id with several texts is an item for each, told apart by ``item_key``.
Very long texts make a part of their own, their words are counted one by one.
Only the named columns are read, so other columns cannot clash.
"""

from __future__ import annotations

import re
from array import array
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quire.llm import kernel as K
from quire.llm.common import bound_batches, discard, materialise, share, shared

PART_BYTES = 16 << 20
#: a part ends at so many documents, too
PART_DOCS = 1 << 16
#: bytes of the texts of one block of items
BLOCK_BYTES = 4 << 20
#: impacts fall by this factor from one reading step to the next
FALL = 4
#: steps of the first pass
FIRST_STEPS = 2

_WORD = re.compile(rb"[0-9A-Za-z\x80-\xff]+")
_LONG_TEXT = 4 << 20


def _terms(text: bytes) -> Counter:
    if len(text) > _LONG_TEXT:
        return Counter(m.group() for m in _WORD.finditer(text))
    return Counter(_WORD.findall(text))


def _lists(values: np.ndarray, starts: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(starts, pa.int32()), pa.array(values, kind))


class _Part:
    """Documents of one part while it is filled."""

    def __init__(self):
        self.ids, self.sizes, self.bytes = [], [], 0
        self.vocabulary: defaultdict = defaultdict()
        self.vocabulary.default_factory = self.vocabulary.__len__
        self.terms, self.times = array("i"), array("q")

    def add(self, id_, text: bytes) -> None:
        counts = _terms(text)
        if counts:
            self.ids.append(id_)
            self.sizes.append(len(counts))
            self.terms.extend(map(self.vocabulary.__getitem__, counts))
            self.times.extend(counts.values())
            self.bytes += len(text)

    def row(self, id_type: pa.DataType) -> pa.RecordBatch:
        """Lists in the order of terms, documents numbered by id."""
        ids = pa.array(self.ids, id_type)
        by_id = pc.array_sort_indices(ids, null_placement="at_end").to_numpy()
        number = np.empty(len(by_id), np.int32)
        number[by_id] = np.arange(len(by_id), dtype=np.int32)
        term, tf = np.frombuffer(self.terms, np.int32), np.frombuffer(self.times, np.int64)
        doc = np.repeat(number, self.sizes)
        length = np.bincount(doc, weights=tf, minlength=len(by_id)).astype(np.int64)
        order = np.lexsort((doc, term))
        df = np.bincount(term, minlength=len(self.vocabulary)).astype(np.int32)
        words = pa.array([w.decode("utf-8", "replace") for w in self.vocabulary], pa.string())
        one = np.array([0, len(by_id)])
        each, all_ = np.array([0, len(df)]), np.array([0, len(term)])
        return pa.RecordBatch.from_arrays(
            [pa.ListArray.from_arrays(pa.array([0, len(by_id)], pa.int32()), ids.take(pa.array(by_id))), _lists(length, one, pa.int64()),
             pa.ListArray.from_arrays(pa.array([0, len(df)], pa.int32()), words), _lists(df, each, pa.int32()),
             _lists(doc[order], all_, pa.int32()), _lists(tf[order], all_, pa.int64()),
             pa.array([len(by_id)], pa.int64()), pa.array([int(tf.sum())], pa.int64())],
            names=["ids", "lengths", "terms", "df", "docs", "tf", "n_docs", "n_terms"])


def _parts(id_type: pa.DataType, part_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = _Part()
        for batch in batches:
            for a, b, buf, offsets in K.text_slices(batch.column(1)):
                raw, ends = buf.tobytes().lower(), offsets.tolist()        # bytes: A-Z only
                for id_, i, j in zip(batch.column(0).slice(a, b - a).to_pylist(), ends, ends[1:]):
                    part.add(id_, raw[i:j])
                    if part.bytes >= part_bytes or len(part.ids) >= PART_DOCS:
                        yield part.row(id_type)
                        part = _Part()
        if part.ids:
            yield part.row(id_type)
    return run


def _impacts(n_docs: int, n_terms: int):
    """Postings to impacts, each list sorted by impact, highest first, then by document."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(len(batch)):
                ids, length, terms, df, doc, tf = (batch.column(j).slice(i, 1).flatten() for j in range(6))
                length, df, doc, tf = (x.to_numpy() for x in (length, df, doc, tf))
                m = 75 + 25 * length * n_docs // n_terms
                impact = 1_000_000_000 * tf // (1000 * tf + 12 * m[doc])
                order = np.lexsort((doc, -impact, np.repeat(np.arange(len(df)), df)))
                one = pa.array([0, len(terms)], pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(i, 1), pa.ListArray.from_arrays(one, terms), _lists(df, np.array([0, len(df)]), pa.int32()),
                     _lists(doc[order], np.array([0, len(doc)]), pa.int32()), _lists(impact[order], np.array([0, len(doc)]), pa.int32())],
                    names=["ids", "terms", "df", "docs", "impacts"])
    return run


class Index:
    """Impact-sorted lists by part, and the corpus' figures."""

    def __init__(self, parts: DataFrame, frequencies: DataFrame, n_docs: int, id_type: str):
        self.parts, self.frequencies, self.n_docs, self.id_type = parts, frequencies, n_docs, id_type


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_bytes: int = PART_BYTES) -> Index:
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).where(F.col("text").isNotNull())
    id_type = rows.dtypes[0][1]
    arrow_type = rows.limit(0).toArrow().schema.field(0).type
    forward = materialise(rows.mapInArrow(
        _parts(arrow_type, part_bytes), f"ids array<{id_type}>, lengths array<long>, terms array<string>, df array<int>, docs array<int>, "
        "tf array<long>, n_docs long, n_terms long"), "forward", large_rows=True)
    n_docs, n_terms = forward.agg(F.coalesce(F.sum("n_docs"), F.lit(0)), F.coalesce(F.sum("n_terms"), F.lit(0))).first()
    parts = materialise(forward.drop("n_docs", "n_terms").mapInArrow(
        _impacts(n_docs, n_terms), f"ids array<{id_type}>, terms array<string>, df array<int>, docs array<int>, impacts array<int>"), "impacts", large_rows=True)
    return Index(parts, parts.select("terms", "df"), n_docs, id_type)


def _items(index: Index, items: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(item_key, item, terms array<struct<term, weight>>, size) of the items with a term of the index that weighs something."""
    base = (items.select(F.col(id_col).alias("item"), F.col(text_col).cast("string").alias("text")).where(F.col("text").isNotNull())
            .dropDuplicates(["item", "text"]))
    base = base.withColumn("item_key", F.xxhash64(F.col("item"), F.col("text")))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, buf, offsets in K.text_slices(batch.column(2)):
                raw, ends = buf.tobytes().lower(), offsets.tolist()
                counts = [_terms(raw[i:j]) for i, j in zip(ends, ends[1:])]
                at = pa.array(np.repeat(np.arange(a, b), [len(c) for c in counts]))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(at), batch.column(1).take(at), pa.array([w.decode("utf-8", "replace") for c in counts for w in c], pa.string()),
                     pa.array([n for c in counts for n in c.values()], pa.int64())], names=["item_key", "item", "term", "times"])
    asked = base.select("item_key", "item", "text").mapInArrow(count, f"item_key long, item {base.dtypes[0][1]}, term string, times long")
    asked = materialise(asked, "itemterms")
    df = (index.frequencies.select(F.explode(F.arrays_zip("terms", "df")).alias("t")).select(F.col("t.terms").alias("term"), F.col("t.df").alias("df"))
          .join(asked.select("term").distinct(), "term", "left_semi").groupBy("term").agg(F.sum("df").alias("df")))
    weight = F.floor(1000 * F.log((2 * F.lit(index.n_docs) + 2) / (2 * F.col("df") + 1))).cast("long")
    return (asked.join(df, "term").withColumn("weight", F.col("times") * weight).where("weight > 0")
            .groupBy("item_key", "item").agg(F.collect_list(F.struct("term", "weight")).alias("terms"), F.sum(F.length("term")).alias("size")))


def nra(lists: list[tuple[np.ndarray, np.ndarray, int]], n_docs: int, k: int, floor: int, steps: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(documents, scores): the k best of a part with a score of at least ``floor``, best first, equal scores by number.

    ``lists`` hold documents, impacts (falling) and the weight of each term.  With ``steps``, reading ends after so many
    and the scores are lower bounds.
    """
    floor = max(floor, 1)
    lower, seen = np.zeros(n_docs, np.int64), np.zeros((len(lists), n_docs), bool)
    at = [0] * len(lists)
    unread = np.array([w * int(g[0]) for _, g, w in lists], np.int64)     # the largest impact not read yet
    alive = np.arange(n_docs)
    while True:
        if int(unread.sum()) == 0:
            break
        cut = max(1, int(unread.max()) // FALL)
        for i in np.flatnonzero(unread >= cut):
            docs, impacts, w = lists[i]
            end = len(impacts) - int(np.searchsorted(impacts[::-1], -(-cut // w), side="left"))
            read = docs[at[i]:end]
            lower[read] += impacts[at[i]:end].astype(np.int64) * w
            seen[i, read] = True
            at[i] = end
            unread[i] = w * int(impacts[end]) if end < len(impacts) else 0
        if steps is not None:
            steps -= 1
            if steps <= 0:
                break
        low = lower[alive]
        least = max(floor, int(np.partition(low, len(low) - k)[len(low) - k])) if len(low) >= k else floor
        rest = unread @ ~seen[:, alive]                                  # what may still come, at most
        may = low + rest >= least
        alive = alive[may]
        if not rest[may].any():                                           # also when nothing is left
            break
    low = lower[alive]
    good = low >= floor
    alive, low = alive[good], low[good]
    order = np.lexsort((alive, -low))[:k]
    return alive[order], low[order]


def _search(sent, k: int, id_type: pa.DataType, quota: int | None):
    """Each part's best for each item of a block: final ones, or with ``quota`` the best lower bounds of the first steps."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, block = shared(sent)
        words = pa.array(vocabulary, pa.string())
        for batch in batches:
            for i in range(len(batch)):
                ids, terms, df, docs, impacts = (batch.column(j).slice(i, 1).flatten() for j in range(5))
                ends = np.cumsum(df.to_numpy())
                starts = ends - df.to_numpy()
                place = pc.index_in(words, value_set=terms).fill_null(-1).to_numpy()
                docs, impacts = docs.to_numpy(), impacts.to_numpy()
                item, found, score = [], [], []
                for number, (term, weight, floor) in enumerate(block):
                    here = [(place[t], w) for t, w in zip(term, weight) if place[t] >= 0]
                    lists = [(docs[starts[p]:ends[p]], impacts[starts[p]:ends[p]], w) for p, w in here]
                    if not lists:
                        continue
                    d, s = nra(lists, len(ids), k if quota is None else quota, floor, None if quota is None else FIRST_STEPS)
                    item.append(np.full(len(d), number))
                    found.append(d)
                    score.append(s)
                if item:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.concatenate(item).astype(np.int64)), ids.take(pa.array(np.concatenate(found))), pa.array(np.concatenate(score))],
                        names=["item", "id", "score"])
    return run


def rank_documents(docs: DataFrame, items: DataFrame, k: int = 20, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
                   item_text_col: str = "text", block_bytes: int = BLOCK_BYTES, part_bytes: int = PART_BYTES) -> DataFrame:
    """(``item_col``, rank, ``id_col``, score, item_key): the ``k`` documents with the highest scores above 0 for each item."""
    spark = docs.sparkSession
    bound_batches(spark)
    index = build_index(docs, id_col, text_col, part_bytes)
    id_type = index.parts.limit(0).toArrow().schema.field(0).type.value_type
    asked = materialise(_items(index, items, item_col, item_text_col), "items")
    item_type = dict(asked.dtypes)["item"]
    size, n_parts = asked.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0], index.parts.count()
    blocks = max(1, -(-size // block_bytes))
    quota = min(k, max(1, -(-2 * k // max(1, n_parts))))
    out = None
    for b in range(blocks):
        here = asked.where(F.pmod("item_key", F.lit(blocks)) == b).orderBy("item_key").collect()
        if not here:
            continue
        vocabulary = sorted({t["term"] for r in here for t in r["terms"]})
        number = {t: n for n, t in enumerate(vocabulary)}
        block = [([number[t["term"]] for t in r["terms"]], [t["weight"] for t in r["terms"]], 0) for r in here]
        schema = f"item long, id {index.id_type}, score long"
        first = share(spark, (vocabulary, block))
        best = Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("id").asc_nulls_last())
        floors = dict(index.parts.mapInArrow(_search(first, k, id_type, quota), schema).withColumn("r", F.row_number().over(best))
                      .where(F.col("r") == k).select("item", "score").collect())
        sent = share(spark, (vocabulary, [(t, w, floors.get(n, 0)) for n, (t, w, _) in enumerate(block)]))
        names = spark.createDataFrame([(n, r["item"], r["item_key"]) for n, r in enumerate(here)], f"item long, _item {item_type}, item_key long")
        ranked = (index.parts.mapInArrow(_search(sent, k, id_type, None), schema).withColumn("rank", F.row_number().over(best))
                  .where(F.col("rank") <= k).join(names, "item")
                  .select(F.col("_item").alias(item_col), F.col("rank").cast("int").alias("rank"), F.col("id").alias(id_col), "score", "item_key"))
        ranked = materialise(ranked, f"ranked{b}")         # the block's work is done before its broadcasts go
        discard(first)
        discard(sent)
        out = ranked if out is None else out.unionByName(ranked)
    if out is None:
        out = spark.createDataFrame([], f"{item_col} {item_type}, rank int, {id_col} {index.id_type}, score long, item_key long")
    return out

"""Removal of repeated long spans by compaction of a token de Bruijn graph.

The edges of the graph are the runs of 50 consecutive words (k-mers of words),
its nodes the 49 words that two neighbouring edges share.

1. Each task reads its texts' edges in order and compacts them while nothing
   can branch: consecutive edges with the same least 16-word anchor form one
   path piece (start, end, anchor, 128-bit key of its words).  There are about
   17 edges to a piece, and equal content has equal pieces.
2. A join on the anchor keeps the pieces whose anchor lies in several
   documents; a join on the piece key finds the first document of each path.
   Every later copy of a whole path is repeated text.
3. Where a path branches (copies start, stop or differ inside a piece), the
   first copies of its pieces are opened again: their source coordinates lead
   back to the texts, each single edge gets its own 128-bit key, and a join
   finds the first document of each edge.
4. The source coordinates of all repeated edges merge to spans per document.

Every aggregation has partial minima, so a passage in a third of all documents
costs each task one row.

Edge cases: null, empty and short texts lose nothing; a null id counts as
smaller than every id; rows that repeat an id never remove one another's words
and each gets its own result; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.llm import kernel as K
from quire.llm.common import id_key, key_to_id, materialise
from quire.llm.packing import pack_texts, unpack

#: words of an anchor, the unit that selects path pieces
ANCHOR = 16
_LOW = np.uint64((1 << 20) - 1)
_SECOND = np.uint64(0xE7037ED1A0B428DB)


class _Ranges:
    """128-bit keys of word ranges, from running sums."""

    def __init__(self, words: np.ndarray):
        self.power, self.inverse = K._power_tables(len(words) + 1)
        self.sums = []
        for w in (words, K.mix64(words ^ _SECOND)):
            total = np.zeros(len(w) + 1, np.uint64)
            np.cumsum(w * self.power[:len(w)], out=total[1:])
            self.sums.append(total)

    def keys(self, start: np.ndarray, end: np.ndarray) -> list[np.ndarray]:
        size = (end - start).astype(np.uint64)
        return [K.mix64((t[end] - t[start]) * self.inverse[start] + size).view(np.int64) for t in self.sums]


def _sliding_least(x: np.ndarray, width: int) -> np.ndarray:
    """Least value of each run of ``width`` entries, by prefix and suffix minima of blocks."""
    n = len(x)
    rows = -(-n // width)
    pad = np.full(rows * width, np.uint64(0xFFFFFFFFFFFFFFFF))
    pad[:n] = x
    block = pad.reshape(rows, width)
    before = np.minimum.accumulate(block, axis=1).ravel()
    after = np.minimum.accumulate(block[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(after[:n - width + 1], before[width - 1:n])


def path_pieces(buf: np.ndarray, offsets: np.ndarray, window: int):
    """(row, first edge, last edge, anchor, key, key) of every path piece; edges count words of their row."""
    starts, ends, first = K.word_spans(buf, offsets)
    words = K.word_hashes(buf, starts, ends, lower=False)
    if len(words) < window:
        return None
    anchor = min(ANCHOR, window)
    mers = K.run_hashes(words, anchor)
    place = np.arange(len(mers), dtype=np.uint64)
    least = _sliding_least((mers & ~_LOW) | (place & _LOW), window - anchor + 1)
    edge = np.arange(len(least))
    at = edge + (((least & _LOW).astype(np.int64) - edge) & int(_LOW))
    row = np.searchsorted(first, edge, side="right") - 1
    inside = edge + window <= first[row + 1]
    edge, at, row = edge[inside], at[inside], row[inside]
    if len(edge) == 0:
        return None
    fresh = np.ones(len(edge), bool)
    fresh[1:] = (at[1:] != at[:-1]) | (row[1:] != row[:-1])
    head = np.flatnonzero(fresh)
    tail = np.append(head[1:], len(edge)) - 1
    s, e, r = edge[head], edge[tail], row[head]
    key = _Ranges(words).keys(s, e + window)
    return r, s - first[r], e - first[r], mers[at[head]].view(np.int64), key[0], key[1]


_EDGE = "id long, tid long, s int, k1 long, k2 long"
_PIECE = "id long, tid long, s int, e int, anchor long, k1 long, k2 long"


def _pieces(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, tids = batch.column("id"), batch.column("tid")
            for a, b, buf, offsets in K.text_slices(batch.column("text")):
                found = path_pieces(buf, offsets, window)
                if found is None:
                    continue
                row = pa.array(found[0] + a)
                cols = [ids.take(row), tids.take(row), pa.array(found[1], pa.int32()), pa.array(found[2], pa.int32()),
                        *(pa.array(x, pa.int64()) for x in found[3:])]
                yield pa.RecordBatch.from_arrays(cols, names=["id", "tid", "s", "e", "anchor", "k1", "k2"])
    return run


def _edges(window: int):
    """Single edges of the pieces (spans) that the joined texts hold."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                raw = np.frombuffer(unpack(batch.column("packed")[i].as_py()), np.uint8)
                starts, ends, _ = K.word_spans(raw, np.array([0, len(raw)]))
                words = K.word_hashes(raw, starts, ends, lower=False)
                p = np.unique(np.concatenate([np.arange(x["s"], x["e"] + 1) for x in batch.column("spans")[i].as_py()]))
                key = _Ranges(words).keys(p, p + window)
                n = len(p)
                yield pa.RecordBatch.from_arrays(
                    [pa.repeat(batch.column("id")[i], n), pa.repeat(batch.column("tid")[i], n), pa.array(p, pa.int32()),
                     pa.array(key[0], pa.int64()), pa.array(key[1], pa.int64())], names=["id", "tid", "s", "k1", "k2"])
    return run


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        n_words, n_removed, kept = [], [], []
        for packed, spans in zip(batch.column("packed"), batch.column("spans")):
            words = unpack(packed.as_py()).split()
            drop = np.zeros(len(words) + 1, np.int64)
            for x in spans.as_py() or ():
                drop[x["s"]] += 1
                drop[min(x["e"], len(words))] -= 1
            gone = np.cumsum(drop)[:-1] > 0
            n_words.append(len(words)), n_removed.append(int(gone.sum()))
            kept.append(b" ".join([w for w, g in zip(words, gone.tolist()) if not g] if gone.any() else words))
        yield pa.RecordBatch.from_arrays(
            [batch.column("id"), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()),
             pa.array(kept, pa.binary()).cast(pa.string()), pa.array([hashlib.sha256(x).hexdigest() for x in kept])],
            names=["id", "n_words", "n_removed", "kept_text", "kept_sha256"])


def repeated_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 50) -> DataFrame:
    """(id, tid, s, e): word spans, end exclusive, of ``window`` or more words that start in an earlier document too."""
    base = docs.select(id_key(id_col).alias("id"), F.xxhash64(text_col).alias("tid"), F.col(text_col).cast("string").alias("text"))
    pieces = materialise(base.mapInArrow(_pieces(window), _PIECE), "pieces")
    several = (pieces.groupBy("anchor").agg(F.min("id").alias("lo"), F.max("id").alias("hi")).where("lo <> hi").select("anchor"))
    shared = materialise(pieces.join(several, "anchor"), "paths")
    first = shared.groupBy("k1", "k2").agg(F.min("id").alias("first"))
    judged = materialise(shared.join(first, ["k1", "k2"]), "judged")
    whole = judged.where("id > first").select("id", "tid", "s", (F.col("e") + window).alias("e"))
    heads = judged.where("id = first")
    branching = heads.groupBy("anchor").agg(F.min("id").alias("lo"), F.max("id").alias("hi")).where("lo <> hi").select("anchor")
    opened = (heads.join(branching, "anchor").groupBy("id", "tid").agg(F.collect_set(F.struct("s", "e")).alias("spans")))
    sources = pack_texts(base).join(opened.hint("shuffle_hash"), ["id", "tid"]).dropDuplicates(["id", "tid"])
    edges = materialise(sources.select("id", "tid", "packed", "spans").mapInArrow(_edges(window), _EDGE), "edges")
    early = edges.groupBy("k1", "k2").agg(F.min("id").alias("first"), F.max("id").alias("last")).where("first <> last")
    single = edges.join(early.select("k1", "k2", "first"), ["k1", "k2"]).where("id > first").select(
        "id", "tid", "s", (F.col("s") + window).alias("e"))
    return whole.union(single)


def remove_repeated_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 50) -> DataFrame:
    """One row per document: id_col, n_words, n_removed, kept_text (kept words joined by one space), kept_sha256."""
    spans = (repeated_spans(docs, id_col, text_col, window).groupBy("id", "tid")
             .agg(F.collect_list(F.struct("s", "e")).alias("spans")))
    base = docs.select(id_key(id_col).alias("id"), F.xxhash64(text_col).alias("tid"), F.col(text_col).cast("string").alias("text"))
    rows = pack_texts(base).join(spans.hint("shuffle_hash"), ["id", "tid"], "left").select("id", "packed", "spans")
    out = rows.mapInArrow(_cut, "id long, n_words long, n_removed long, kept_text string, kept_sha256 string")
    return out.select(key_to_id("id").alias(id_col), "n_words", "n_removed", "kept_text", "kept_sha256")

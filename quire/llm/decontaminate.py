"""Benchmark decontamination: size-partitioned MinHash containment search, verified exactly.

A short item inside a long document has a tiny Jaccard similarity with it, so
plain MinHash cannot find it.  Items are therefore partitioned by the size of
their shingle sets (powers of two), and for each partition a document is read
as consecutive blocks of half the partition's largest size: against a block
the similarity of an item is large again.  A block that shares one of the
MinHash coordinates with an item makes a candidate; a candidate is verified by
exact containment of the item's shingles in the whole document.

With coordinates K and blocks of B shingles an item of q > B shingles that the
document contains to 75 % is missed with probability below exp(-K * 0.6)
(K = 24: one in a million), however its shingles are scattered, as the
similarities of the blocks add up.  Items of up to eight shingles use blocks
of one shingle, which finds every one of them.

The items are cut into blocks of a bounded number of bytes; each block is sent
to the tasks once and held against all documents in one pass without a
shuffle.  More items mean more passes, never a larger broadcast.

Edge cases: null and empty texts contain nothing, items without words are
contained in nothing; an item of fewer words than a shingle is one shingle of
its own length; items that repeat an id are joined by id only in the result;
an empty table on either side gives an empty result (or, for the filter, all
documents).
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.llm import kernel as K
from quire.llm.common import id_key, key_to_id, share, shared

COORDINATES = 24
#: shingles of the smallest blocks; the partitions' blocks are 1 and this times a power of two
LEAST_BLOCK = 8
#: bytes of item shingles in one broadcast block (an item is never split)
ITEM_BLOCK_BYTES = 8 << 20
_HASH = np.uint32(0x9E3779B1)


def _places(shingles: np.ndarray) -> np.ndarray:
    return (K.mix64(shingles ^ np.uint64(0x8EBC6AF09C88C6E3)) >> np.uint64(32)).astype(np.uint32)


def _permuted(places: np.ndarray, j: int) -> np.ndarray:
    v = places + np.uint32(j)
    for shift, factor in ((16, 0x7FEB352D), (15, 0x846CA68B)):
        v ^= v >> np.uint32(shift)
        v *= np.uint32(factor)
    v ^= v >> np.uint32(16)
    return v


class _Lookup:
    """Values to items: a bit map first, then a sorted array."""

    def __init__(self, values: np.ndarray, items: np.ndarray):
        order = np.argsort(values, kind="stable")
        self.values, self.items = values[order], items[order]
        self.shift = np.uint32(32 - max(16, min(24, (16 * len(values)).bit_length())))
        self.bits = np.zeros(1 << (32 - int(self.shift)), bool)
        self.bits[self._slot(values)] = True

    def _slot(self, values):
        return (values.astype(np.uint32) * _HASH) >> self.shift

    def find(self, values: np.ndarray) -> Iterator[tuple[int, int]]:
        """(position, item) of every value that some item has."""
        for at in np.flatnonzero(self.bits[self._slot(values)]).tolist():
            lo = np.searchsorted(self.values, values[at], side="left")
            hi = np.searchsorted(self.values, values[at], side="right")
            for item in self.items[lo:hi].tolist():
                yield at, item


class ItemIndex:
    """The items of one block: their shingle sets, and look-ups by size partition."""

    def __init__(self, items: list[tuple[int, int, np.ndarray]], shingle_words: int):
        """items: (item id, words, sorted distinct shingles)."""
        self.words = shingle_words
        self.ids = [i for i, _, _ in items]
        self.sets = [x for _, _, x in items]
        self.short: dict[int, _Lookup] = {}
        self.single: _Lookup | None = None
        self.by_block: dict[int, list[_Lookup]] = {}
        short, single, parts = defaultdict(list), [], defaultdict(list)
        for n, (_, words, x) in enumerate(items):
            if 0 < words < shingle_words:
                short[words].append(n)
            elif 0 < len(x) <= LEAST_BLOCK:
                single.append(n)
            elif len(x):
                parts[1 << ((len(x) - 1).bit_length() - 1)].append(n)
        for w, own in short.items():
            self.short[w] = self._members(own)
        if single:
            self.single = self._members(single)
        for block, own in parts.items():
            places = [_places(self.sets[n]) for n in own]
            self.by_block[block] = [
                _Lookup(np.array([_permuted(p, j).min() for p in places], np.uint32), np.array(own)) for j in range(COORDINATES)]

    def _members(self, own: list[int]) -> _Lookup:
        return _Lookup(np.concatenate([_places(self.sets[n]) for n in own]),
                       np.concatenate([np.full(len(self.sets[n]), n) for n in own]))

    def candidates(self, words: np.ndarray, first: np.ndarray, runs: np.ndarray) -> dict[int, set[int]]:
        """Items that may be contained, by row; ``words`` and ``runs`` of several rows, rows starting at ``first``."""
        found: dict[int, set[int]] = defaultdict(set)

        def put(lo, hi, item):
            a, b = np.searchsorted(first, [lo, max(lo, hi - 1)], side="right") - 1
            for row in range(int(a), int(b) + 1):
                found[row].add(item)

        for n, lookup in self.short.items():
            for at, item in lookup.find(_places(K.run_hashes(words, n))):
                put(at, at + 1, item)
        places = _places(runs)
        if self.single:
            for at, item in self.single.find(places):
                put(at, at + 1, item)
        if self.by_block and len(places):
            pad = -len(places) % LEAST_BLOCK
            for j in range(COORDINATES):
                v = _permuted(places, j)
                if pad:
                    v = np.append(v, np.full(pad, 0xFFFFFFFF, np.uint32))
                least, size = v.reshape(-1, LEAST_BLOCK).min(axis=1), LEAST_BLOCK
                for block in sorted(self.by_block):
                    while size < block:
                        if len(least) % 2:
                            least = np.append(least, np.uint32(0xFFFFFFFF))
                        least, size = np.minimum(least[::2], least[1::2]), size * 2
                    for at, item in self.by_block[block][j].find(least):
                        put(at * block, min((at + 1) * block, len(places)), item)
        return found

    def contained(self, column: pa.Array, percent: int) -> Iterator[tuple[int, int, int]]:
        """(row, item number, shingles found) of every verified containment in a text column."""
        for a, _, buf, offsets in K.text_slices(column):
            starts, ends, first = K.word_spans(buf, offsets)
            words = K.word_hashes(buf, starts, ends, lower=True)
            runs = K.run_hashes(words, self.words)
            for row, items in sorted(self.candidates(words, first, runs).items()):
                lo, hi = int(first[row]), int(first[row + 1])
                own = np.unique(runs[lo:max(lo, hi - self.words + 1)])
                for item in sorted(items):
                    x = self.sets[item]
                    if len(x) == 1 and self.short:      # one shingle, perhaps of its own length
                        hit = max(int(np.isin(x, own)[0]), *(int(np.isin(x, K.run_hashes(words[lo:hi], n))[0]) for n in self.short))
                    else:
                        hit = int(np.isin(x, own, assume_unique=True).sum())
                    if 100 * hit >= percent * len(x):
                        yield row + a, item, hit


def _item_rows(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_words, sets = [], []
            for _, _, buf, offsets in K.text_slices(batch.column("text")):
                starts, ends, first = K.word_spans(buf, offsets)
                h = K.word_hashes(buf, starts, ends, lower=True)
                for lo, hi in zip(first[:-1], first[1:]):
                    n_words.append(int(hi - lo)), sets.append(K.shingles_of(h[lo:hi], words).tobytes())
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(n_words, pa.int64()), pa.array(sets, pa.binary())],
                                             names=["id", "words", "shingles"])
    return run


def item_blocks(items: DataFrame, id_col: str, text_col: str, words: int, block_bytes: int) -> Iterator[ItemIndex]:
    """The items as indexes of at most about ``block_bytes`` of shingles each."""
    rows = (items.select(id_key(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
            .mapInArrow(_item_rows(words), "id long, words long, shingles binary"))
    total = rows.agg(F.sum(F.octet_length("shingles") + 64)).first()[0] or 0
    blocks = max(1, -(-total // block_bytes))
    for b in range(blocks):
        own = rows.where(F.pmod(F.xxhash64("id"), F.lit(blocks)) == b).collect()
        if own:
            yield ItemIndex([(r["id"], r["words"], np.frombuffer(r["shingles"], np.uint64)) for r in own], words)


def contaminated(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_id_col: str = "item_id",
                 item_text_col: str = "text", words: int = 5, percent: int = 75, block_bytes: int = ITEM_BLOCK_BYTES) -> DataFrame:
    """(id_col, item_id_col, item_shingles, found_shingles, containment) of every item that a document contains."""
    spark = docs.sparkSession
    base = docs.select(id_key(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    schema = "id long, item long, item_shingles long, found_shingles long"
    out = spark.createDataFrame([], schema)
    for index in item_blocks(items, item_id_col, item_text_col, words, block_bytes):
        sent = share(spark, index)

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            index = shared(sent)
            for batch in batches:
                hits = list(index.contained(batch.column("text"), percent))
                ids = batch.column("id").take(pa.array([h[0] for h in hits], pa.int64()))
                yield pa.RecordBatch.from_arrays(
                    [ids, pa.array([index.ids[h[1]] for h in hits], pa.int64()),
                     pa.array([len(index.sets[h[1]]) for h in hits], pa.int64()), pa.array([h[2] for h in hits], pa.int64())],
                    names=["id", "item", "item_shingles", "found_shingles"])

        out = out.union(base.mapInArrow(run, schema))
    return out.select(key_to_id("id").alias(id_col), key_to_id("item").alias(item_id_col), "item_shingles", "found_shingles",
                      (F.col("found_shingles") / F.col("item_shingles")).alias("containment"))


def drop_contaminated(docs: DataFrame, items: DataFrame, text_col: str = "text", item_id_col: str = "item_id",
                      item_text_col: str = "text", words: int = 5, percent: int = 75, block_bytes: int = ITEM_BLOCK_BYTES) -> DataFrame:
    """``docs`` without the rows whose text contains an item; one pass for each block of items, no shuffle."""
    spark, text_at = docs.sparkSession, docs.columns.index(text_col)
    for index in item_blocks(items, item_id_col, item_text_col, words, block_bytes):
        sent = share(spark, index)

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            index = shared(sent)
            for batch in batches:
                clean = np.ones(batch.num_rows, bool)
                clean[[h[0] for h in index.contained(batch.column(text_at), percent)]] = False
                yield batch.filter(pa.array(clean))

        docs = docs.mapInArrow(run, docs.schema)
    return docs

"""N-grams of blocks of sentences as numbers.

A block is some ten thousand sentences in one task.  Its distinct words are
numbered, bigrams are pairs of word numbers and trigrams pairs of a bigram's
and a word's, so NumPy finds a block's distinct grams without building a string
per position.  Only distinct grams leave a block as text: with their counts to
be added up, or as questions for their counts in a model, which come back as
numbers in the order of the questions.

Grams are dealt out by a hash of their text.  What a block has for one bucket of
grams travels as one compressed table, and so do the sentences that a block
gathers: shuffles hold a few large values, not a row per gram.

The numbers depend on what a block holds and not on its order, so a block that
is read again gets the same ones.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.session import written

cloudpickle.register_pickle_by_value(sys.modules[__name__])      # tasks need no copy of the library

#: padded tokens of one block
BLOCK_TOKENS = 1 << 20
#: buckets of grams that are counted, and grams of one bucket where their number is known
COUNT_BUCKETS, BUCKET_GRAMS = 1024, 1 << 20
_BASE, _MIX, _BLANK = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xFF51AFD7ED558CCD), np.uint64(32)


def _one(column) -> pa.Array:
    return column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column


def _sorted_codes(values: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The distinct values in order and each value's place among them."""
    coded = _one(values).dictionary_encode(null_encoding="encode")
    order = pc.sort_indices(coded.dictionary).to_numpy()
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    return coded.dictionary.take(pa.array(order)), place[coded.indices.to_numpy()]


def _powers(n: int) -> np.ndarray:
    return np.concatenate([np.ones(1, np.uint64), np.cumprod(np.full(n, _BASE))])


def _text_hashes(values: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Each text's bytes as the digits of a number, and how many they are (0 and 0: null): the hash of a joined text follows
    from those of its parts."""
    a = values.cast(pa.string()).fill_null("")
    if not len(a):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    offsets = np.frombuffer(a.buffers()[1], np.int32)[a.offset:a.offset + len(a) + 1].astype(np.int64)
    data = np.frombuffer(a.buffers()[2] or b"", np.uint8)[offsets[0]:offsets[-1]].astype(np.uint64)
    offsets -= offsets[0]
    size = np.diff(offsets)
    data *= _powers(int(size.max()))[np.repeat(offsets[1:], size) - 1 - np.arange(len(data))]
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(data)])
    return sums[offsets[1:]] - sums[offsets[:-1]], size


def _buckets(corpus: np.ndarray, gram: np.ndarray, n: int) -> np.ndarray:
    """The buckets of grams by the hashes of corpus and gram."""
    h = gram + corpus * _MIX
    h = (h ^ (h >> np.uint64(33))) * _MIX
    return ((h ^ (h >> np.uint64(33))) % np.uint64(n)).astype(np.int32)


def _pack(t: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, t.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as w:
        w.write_table(t)
    return sink.getvalue().to_pybytes()


def _unpack(column: pa.Array) -> list[pa.Table]:
    return [pa.ipc.open_stream(x.as_buffer()).read_all() for x in column]


def _dealt(t: pa.Table, by: np.ndarray) -> Iterator[tuple[int, pa.Table]]:
    """The rows of each number in ``by``, in their order."""
    order = np.argsort(by, kind="stable")
    own, first = np.unique(by[order], return_index=True)
    t = t.take(pa.array(order)).combine_chunks()
    for b, i, j in zip(own.tolist(), first.tolist(), [*first[1:].tolist(), len(by)]):
        yield b, t.slice(i, j - i)


def _packed_batches(kind: str, parts: Iterator[tuple[int, pa.Table]], **also: int) -> Iterator[pa.RecordBatch]:
    """(``kind``, also..., packed), a row per part, 4 MB or so at a time."""
    numbers, blobs, size = [], [], 0

    def batch() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(numbers, pa.int64()), *[pa.array([v] * len(numbers), pa.int64()) for v in also.values()],
                                           pa.array(blobs, pa.binary())], names=[kind, *also, "packed"])
    for b, t in parts:
        numbers.append(b)
        blobs.append(_pack(t))
        size += len(blobs[-1])
        if size >= 1 << 22:
            yield batch()
            numbers, blobs, size = [], [], 0
    if numbers:
        yield batch()


class Grams:
    """The unigrams, bigrams and trigrams of padded sentences; ``start`` holds each sentence's first place.

    ``of[n]`` is, by place, the number of the gram of order n that ends there (-1: none does).
    Gram numbers of all orders run on: ``first[n]`` is the first of order n.
    """

    def __init__(self, corpora: pa.Array, tokens: pa.Array, bos: str, eos: str):
        tokens = _one(tokens)
        flat = pa.concat_arrays([tokens.flatten().cast(pa.string()), pa.array([bos, eos], pa.string())])
        self.words, ids = _sorted_codes(flat)
        self.corpora, corpus = _sorted_codes(corpora)
        self.lengths = tokens.value_lengths().to_numpy().astype(np.int64)
        size = self.lengths + 3
        end = np.cumsum(size)
        self.start, total = end - size, int(end[-1]) if len(end) else 0
        word, inside = np.empty(total, np.int64), np.ones(total, bool)
        for place, mark in ((self.start, ids[-2]), (self.start + 1, ids[-2]), (end - 1, ids[-1])):
            word[place], inside[place] = mark, False
        word[inside] = ids[:-2]
        self.keys, self.counts, self.of = [], [], {}
        one = self._number(np.repeat(corpus, size) * len(self.words) + word, np.ones(total, bool))
        later = np.ones(total, bool)
        later[self.start] = False
        two = self._number(np.roll(one, 1) * len(self.keys[0]) + one, later)
        later = later.copy()
        later[self.start + 1] = False
        three = self._number(np.roll(two, 1) * len(self.keys[0]) + one, later)
        self.first = np.concatenate([[0], np.cumsum([len(k) for k in self.keys])])
        self.of = {n: np.where(g < 0, -1, g + self.first[n - 1]) for n, g in ((1, one), (2, two), (3, three))}

    def _number(self, key: np.ndarray, there: np.ndarray) -> np.ndarray:
        keys, at, counts = np.unique(key[there], return_inverse=True, return_counts=True)
        self.keys.append(keys)
        self.counts.append(counts)
        out = np.full(len(key), -1, np.int64)
        out[there] = at
        return out

    def beginning(self, word: str) -> None:
        """Leaves out the grams of two and three tokens that do not begin with ``word``."""
        k1, k2, k3 = self.keys
        n, at = max(len(k1), 1), pc.index(self.words, word).as_py()
        first = k1[k2 // n] % len(self.words)
        two, three = first == at, first[k3 // n] == at
        # trigrams are told by their bigrams, of which those that begin with the word are left
        self.keys = [k1, k2[two], (np.cumsum(two) - 1)[k3[three] // n] * n + k3[three] % n]
        self.counts = [self.counts[0], self.counts[1][two], self.counts[2][three]]

    def buckets(self, buckets: int) -> np.ndarray:
        """The bucket of every distinct gram, in the order of their numbers: that of its text, whatever its tokens are."""
        k1, k2, k3 = self.keys
        n = max(len(k1), 1)
        digits, size = _text_hashes(self.words)
        power, null = _powers(int(size.max(initial=0)) + 1), self.words.is_null().to_numpy(zero_copy_only=False)
        word = k1 % len(self.words)
        digits, size, null = digits[word], size[word], null[word]

        def joined(head: np.ndarray, last: np.ndarray) -> np.ndarray:
            return head * power[size[last] + 1] + _BLANK * power[size[last]] + digits[last]
        two, no_two = joined(digits[k2 // n], k2 % n), null[k2 // n] | null[k2 % n]
        three, no_three = joined(two[k3 // n], k3 % n), no_two[k3 // n] | null[k3 % n]
        gram = np.where(np.concatenate([null, no_two, no_three]), np.uint64(0), np.concatenate([digits, two, three]))
        corpus = _text_hashes(self.corpora)[0][k1 // len(self.words)]
        return _buckets(np.concatenate([corpus, corpus[k2 % n], corpus[k3 % n]]), gram, buckets)

    def rows(self) -> tuple[pa.Array, pa.Array, pa.Array]:
        """(corpus, n, gram) of every distinct gram, in the order of their numbers."""
        k1, k2, k3 = self.keys
        words, n = self.words.take(pa.array(k1 % len(self.words))), max(len(k1), 1)
        two = pc.binary_join_element_wise(words.take(pa.array(k2 // n)), words.take(pa.array(k2 % n)), " ")
        three = pc.binary_join_element_wise(two.take(pa.array(k3 // n)), words.take(pa.array(k3 % n)), " ")
        corpus = k1 // len(self.words)
        corpus = np.concatenate([corpus, corpus[k2 % n], corpus[k3 % n]])
        return (self.corpora.take(pa.array(corpus)), pa.array(np.repeat([1, 2, 3], [len(k) for k in self.keys]).astype(np.int32)),
                pa.concat_arrays([words, two, three]))


def counted(bos: str, eos: str, begins: str | None = None) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """(corpus, tokens) -> (bucket, packed (corpus, n, gram, cnt)), added up within each block; all single tokens, and the longer
    grams that begin with ``begins`` (None: all)."""
    def count(block: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = pa.Table.from_batches(block)
        g = Grams(t.column("corpus"), t.column("tokens"), bos, eos)
        if begins is not None:
            g.beginning(begins)
        out = pa.Table.from_arrays([*g.rows(), pa.array(np.concatenate(g.counts).astype(np.int64))], names=["corpus", "n", "gram", "cnt"])
        yield from _packed_batches("bucket", _dealt(out, g.buckets(COUNT_BUCKETS)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, size = [], 0
        for batch in batches:
            block.append(batch)
            size += len(batch.column("tokens").flatten()) + 3 * len(batch)
            if size >= BLOCK_TOKENS:
                yield from count(block)
                block, size = [], 0
        if size:
            yield from count(block)
    return run


def _added_up(t: pa.Table) -> pa.Table:
    """What all blocks have counted for a bucket -> (corpus, n, gram, cnt), each gram once."""
    held, size = [], 0
    for part in _unpack(t.column("packed")):
        held.append(part)
        size += len(part)
        if size >= 4 * BLOCK_TOKENS:
            held, size = [_sums(held)], 0
    return _sums(held)


def _sums(parts: list[pa.Table]) -> pa.Table:
    t = pa.concat_tables(parts)
    return t.group_by(["corpus", "n", "gram"]).aggregate([("cnt", "sum")]).select(["corpus", "n", "gram", "cnt_sum"]).rename_columns(["corpus", "n", "gram", "cnt"])


def gram_counts(sentences: DataFrame, bos: str, eos: str, begins: str | None = None) -> DataFrame:
    """``sentences(corpus, tokens)`` -> (corpus, n, gram, cnt): counted within blocks, then added up bucket by bucket."""
    g = sentences.mapInArrow(counted(bos, eos, begins), "bucket long, packed binary")
    return g.groupBy("bucket").applyInArrow(_added_up, f"corpus {dict(sentences.dtypes)['corpus']}, n int, gram string, cnt long")


def asked(bos: str, eos: str, buckets: int | None = None) -> Callable[[pa.Table], pa.Table]:
    """A block (block, sid, corpus, tokens) -> the counts it needs (block, i, corpus, n, gram[, bucket])."""
    def run(t: pa.Table) -> pa.Table:
        g = Grams(t.column("corpus"), t.column("tokens"), bos, eos)
        corpus, n, gram = g.rows()
        block = pa.array(np.full(len(n), t.column("block")[0].as_py(), np.int64))
        out = pa.Table.from_arrays([block, pa.array(np.arange(len(n), dtype=np.int32)), corpus, n, gram], names=["block", "i", "corpus", "n", "gram"])
        return out if buckets is None else out.append_column("bucket", pa.array(g.buckets(buckets)))
    return run


#: what a block and a bucket tell each other
TOLD = pa.schema([("bucket", pa.int64()), ("block", pa.int64()), ("packed", pa.binary())])


def _block(t: pa.Table) -> pa.Table:
    rows = pa.concat_tables(_unpack(t.column("packed"))).combine_chunks()
    return rows.append_column("block", pa.array(np.full(len(rows), t.column("block")[0].as_py(), np.int64)))


def _questions(bos: str, eos: str, buckets: int) -> Callable[[pa.Table], pa.Table]:
    """A block (block, packed (sid, corpus, tokens)) -> what it asks of each bucket (bucket, block, packed (corpus, n, gram))."""
    def run(t: pa.Table) -> pa.Table:
        need = asked(bos, eos, buckets)(_block(t))
        parts = _dealt(need.select(["corpus", "n", "gram"]), need.column("bucket").to_numpy())
        return pa.Table.from_batches(list(_packed_batches("bucket", parts, block=t.column("block")[0].as_py())), TOLD)
    return run


def _model(buckets: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """(corpus, n, gram, cnt) -> (bucket, packed (corpus, n, gram, cnt))."""
    def deal(held: list[tuple[pa.RecordBatch, np.ndarray]]) -> Iterator[pa.RecordBatch]:
        t = pa.Table.from_batches([b for b, _ in held])
        yield from _packed_batches("bucket", _dealt(t, np.concatenate([b for _, b in held])))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            corpora, corpus = _sorted_codes(batch.column("corpus"))
            held.append((batch, _buckets(_text_hashes(corpora)[0][corpus], _text_hashes(batch.column("gram"))[0], buckets)))
            size += len(batch)
            if size >= BLOCK_TOKENS:
                yield from deal(held)
                held, size = [], 0
        if size:
            yield from deal(held)
    return run


def _found(need: pa.Table, have: pa.Table) -> pa.Table:
    """What the blocks ask of a bucket, and the model's part of it -> (bucket, block, packed (cnt)), in the order asked; 0: not there."""
    if not len(need):
        return TOLD.empty_table()
    questions = _unpack(need.column("packed"))
    parts = [pa.concat_tables(questions), *([pa.concat_tables(_unpack(have.column("packed")))] if len(have) else [])]
    codes = {}
    for name in ("corpus", "gram"):
        both = pa.chunked_array([c for t in parts for c in t.column(name).chunks], parts[0].schema.field(name).type)
        codes[name] = _one(both).dictionary_encode().indices.fill_null(-1).to_numpy().astype(np.int64)
    n = np.concatenate([t.column("n").to_numpy() for t in parts])
    key = (codes["corpus"] * 4 + n) * (int(codes["gram"].max(initial=0)) + 1) + codes["gram"]
    key[(codes["corpus"] < 0) | (codes["gram"] < 0)] = -1               # a null is not equal to anything
    own, asked_ = key[len(parts[0]):], key[:len(parts[0])]
    cnt = parts[1].column("cnt").to_numpy()[own >= 0] if len(have) else np.zeros(0, np.int64)
    own = own[own >= 0]
    order = np.argsort(own)
    own, cnt = own[order], cnt[order]
    at = np.searchsorted(own, asked_)
    hit = at < len(own)
    hit[hit] = own[at[hit]] == asked_[hit]
    answer = np.zeros(len(asked_), np.int64)
    answer[hit] = cnt[at[hit]]
    ends = np.cumsum([len(q) for q in questions])
    blobs = [_pack(pa.table({"cnt": answer[e - len(q):e]})) for q, e in zip(questions, ends)]
    return pa.Table.from_arrays([need.column("bucket"), need.column("block"), pa.array(blobs, pa.binary())], schema=TOLD)


COUNTS = ("c1", "c2", "c3", "d2", "d3")


def answered(bos: str, eos: str, with_tokens: bool, buckets: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """A block and its counts (bucket, block, packed (cnt)) -> a row per (sid, corpus) with a list of each of ``COUNTS`` over its
    scored positions."""
    def run(t: pa.Table, found: pa.Table) -> pa.Table:
        names = ["sid", "corpus", *(["token"] if with_tokens else []), *COUNTS]
        if not len(t):
            return pa.table({})
        t = _block(t)
        g = Grams(t.column("corpus"), t.column("tokens"), bos, eos)
        cnt = np.zeros(g.first[-1] + 1, np.int64)            # the last: no such gram
        order = np.argsort(g.buckets(buckets), kind="stable")      # as the questions were put
        by_bucket = np.argsort(found.column("bucket").to_numpy())
        answers = _unpack(found.column("packed"))
        cnt[order] = np.concatenate([np.zeros(0, np.int64), *[answers[i].column("cnt").to_numpy() for i in by_bucket.tolist()]])
        c = {n: cnt[g.of[n]] for n in (1, 2, 3)}
        later = np.ones(len(c[1]), bool)
        later[g.start], later[g.start + 1] = False, False
        at = np.flatnonzero(later)
        keys, same = zip(t.column("sid").to_pylist(), t.column("corpus").to_pylist()), {}
        row = np.array([same.setdefault(k, len(same)) for k in keys])
        lists = {"c1": c[1][at], "c2": c[2][at], "c3": c[3][at], "d2": c[1][at - 1], "d3": c[2][at - 1]}
        lengths, ids, corpora = g.lengths + 1, t.column("sid"), t.column("corpus")
        if with_tokens:
            word = (g.keys[0] % len(g.words))[g.of[1]]
            lists["token"] = word[at]
        if len(same) < len(row):
            # sentences of one id and model are one, with the larger count at each place
            all_ = np.arange(len(later))
            size = g.lengths + 3
            idx = all_ - np.repeat(g.start, size)
            x = {"row": np.repeat(row, size), "idx": idx, "c1": c[1], "c2": c[2], "c3": c[3]} | ({"token": word} if with_tokens else {})
            x = pd.DataFrame(x)[idx > 0].groupby(["row", "idx"], sort=True).max().reset_index()
            x["d2"], x["d3"] = x.c1.shift(fill_value=0), x.c2.shift(fill_value=0)
            x = x[x.idx > 1]
            lists, lengths = {k: x[k].to_numpy() for k in lists}, np.bincount(x.row, minlength=len(same))
            first = pa.array(np.unique(row, return_index=True)[1])
            ids, corpora = ids.take(first), corpora.take(first)
        offsets = pa.array(np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32))
        values = {k: g.words.take(pa.array(v)) if k == "token" else pa.array(v) for k, v in lists.items()}
        return pa.Table.from_arrays([ids, corpora, *[pa.ListArray.from_arrays(offsets, values[k]) for k in names[2:]]], names=names)
    return run


def position_counts(sentences: DataFrame, counts: DataFrame, bos: str, eos: str, with_tokens: bool) -> DataFrame:
    """``sentences(sid, corpus, tokens)`` and ``counts(corpus, n, gram, cnt)`` -> (sid, corpus, [token,] c1, c2, c3, d2, d3) with lists
    over the scored positions.  A block's distinct grams meet the counts, not its positions."""
    s = sentences.filter(F.col("tokens").isNotNull() & F.col("corpus").isNotNull())
    size = s.agg(F.sum(F.size("tokens") + 3)).first()[0] or 0
    n, buckets = -(-size // BLOCK_TOKENS) or 1, -(-3 * size // BUCKET_GRAMS) or 1
    kinds = dict(s.dtypes)
    s = s.select(F.pmod(F.xxhash64("sid", "corpus"), F.lit(n)).alias("block"), "sid", "corpus", "tokens").mapInArrow(_by_block, "block long, packed binary")
    need = s.groupBy("block").applyInArrow(_questions(bos, eos, buckets), "bucket long, block long, packed binary")
    have = counts.select(F.col("corpus").cast(kinds["corpus"]).alias("corpus"), F.col("n").cast("int").alias("n"), "gram", F.col("cnt").cast("long").alias("cnt"))
    have = have.mapInArrow(_model(buckets), "bucket long, packed binary")
    # written, so that the questions' shuffles are gone before the answers are dealt out
    found = written(need.groupBy("bucket").cogroup(have.groupBy("bucket")).applyInArrow(_found, "bucket long, block long, packed binary"))
    out = f"sid {kinds['sid']}, corpus {kinds['corpus']}, {'token array<string>, ' if with_tokens else ''}" + ", ".join(f"{c} array<long>" for c in COUNTS)
    return s.groupBy("block").cogroup(found.groupBy("block")).applyInArrow(answered(bos, eos, with_tokens, buckets), out)


def _by_block(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(block, ...) -> (block, packed (...)), a block's rows of some million tokens together."""
    def deal(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = pa.Table.from_batches(held)
        yield from _packed_batches("block", _dealt(t.drop_columns(["block"]), t.column("block").to_numpy()))
    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += len(batch.column("tokens").flatten()) + 3 * len(batch)
        if size >= 2 * BLOCK_TOKENS:
            yield from deal(held)
            held, size = [], 0
    if size:
        yield from deal(held)


def _words(t: pa.Table) -> tuple[pa.Array, np.ndarray]:
    return _sorted_codes(_one(t.column("tokens")).flatten())


#: numbers of the vectors that are added up at a time
TILE_NUMBERS = 1 << 21


def _means(dim: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """A block (sid, tokens) and the vectors of its words (i, vec) -> (sid, n_known, mean)."""
    def run(t: pa.Table, found: pa.Table) -> pa.Table:
        codes = _words(t)[1]
        same: dict = {}
        row = np.array([same.setdefault(k, len(same)) for k in t.column("sid").to_pylist()])
        place, n = np.full(int(codes.max(initial=0)) + 1, -1), len(found)
        place[found.column("i").to_numpy()] = np.arange(n)
        vectors = _one(found.column("vec")).flatten().to_numpy(zero_copy_only=False).reshape(n, -1) if n else np.zeros((0, dim))
        at, owner = place[codes], np.repeat(row, _one(t.column("tokens")).value_lengths().to_numpy())
        at, owner = at[at >= 0], owner[at >= 0]
        known, total = np.bincount(owner, minlength=len(same)), np.zeros((len(same), dim))
        order = np.argsort(owner, kind="stable")
        at, owner = at[order], owner[order]
        for a in range(0, len(at), TILE_NUMBERS // dim):
            own, first = np.unique(owner[a:a + TILE_NUMBERS // dim], return_index=True)
            total[own] += np.add.reduceat(vectors[at[a:a + TILE_NUMBERS // dim]], first, axis=0)
        mean = (total / np.maximum(known, 1)[:, None])[row]
        offsets = pa.array(np.arange(len(row) + 1, dtype=np.int32) * dim)
        return pa.table({"sid": _one(t.column("sid")), "n_known": pa.array(known[row].astype(np.int64)),
                         "mean": pa.ListArray.from_arrays(offsets, pa.array(mean.ravel()))})
    return run


def _words_asked(t: pa.Table) -> pa.Table:
    words = _words(t)[0]
    return pa.table({"block": pa.array(np.full(len(words), t.column("block")[0].as_py(), np.int64)),
                     "i": pa.array(np.arange(len(words), dtype=np.int32)), "word": words})


def mean_vectors(sentences: DataFrame, word_vectors: DataFrame, dim: int) -> DataFrame:
    """``sentences(sid, tokens)`` and ``word_vectors(word, vec)``, each word once -> (sid, n_known, mean): a row per row, over all
    known words of its sid (0 of them: zeros)."""
    s = sentences.select("sid", F.coalesce("tokens", F.array().cast("array<string>")).alias("tokens"))
    size = s.agg(F.sum(F.size("tokens") + 3)).first()[0] or 0
    n = -(-size // BLOCK_TOKENS) or 1
    s = s.select(F.pmod(F.xxhash64("sid"), F.lit(n)).alias("block"), "sid", "tokens").repartition(n, "block")
    need = s.groupBy("block").applyInArrow(_words_asked, "block long, i int, word string")
    v = word_vectors.filter(F.col("vec").isNotNull()).select("word", F.col("vec").cast("array<double>").alias("vec"))
    found = need.join(v, "word").select("block", "i", "vec").repartition(n, "block")
    return s.groupBy("block").cogroup(found.groupBy("block")).applyInArrow(_means(dim), f"sid {dict(s.dtypes)['sid']}, n_known long, mean array<double>")

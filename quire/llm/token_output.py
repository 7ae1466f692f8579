"""Token ids in training order: fixed-stride binary shards under a keyed permutation.

1. Tokenise and pack: each task turns its documents into token ids, puts an end
   mark after each and cuts the stream into sequences of a fixed length (the
   last one of a task is padded with end marks).  Sequences are written once,
   compressed, so everything after reads settled data.
2. Number the sequences densely (counts per packing task, prefix-summed) and
   give each a global slot by a keyed Feistel permutation of [0, N): a balanced
   network over the next even power of two, walked until it lands below N.
3. Partition by ranges of slots and write each shard sequentially: slot s is
   bytes [(s mod S) * stride, ...) of shard s div S, so a trainer that stopped
   at slot s resumes with one seek.  Shards are written under a task-attempt
   name and then renamed: a task that is run again writes the same bytes to
   the same place, and a partial file never has a shard's name.

Edge cases: null and empty texts are a lone end mark; texts of any length span
as many sequences as they need; rows that repeat are output each; a null id
appears as null in the sequence's list; an empty table writes no shard and
gives an empty result.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quire.llm import kernel as K
from quire.llm.common import materialise, share, shared, shared_path
from quire.llm.packing import packer, unpack

VOCABULARY = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"
#: the split pattern that belongs to the vocabulary file (fixed value)
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
SEQUENCE, SHARD, KEY = 2048, 4096, 0x5EED_0F_DA7A
CACHED_PIECES = 1 << 20
#: sequences lie on disk twice, written and shuffled: a tenth of a millisecond each for a twentieth less of both
PACK_LEVEL = 6
#: bytes of text that are cut into tokens at a time
SLICE_BYTES = 1 << 20


def load_ranks(path: str) -> dict[bytes, int]:
    """Token bytes to ids of a vocabulary file (base64 token and id per line)."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


class PieceTokenizer:
    """Byte-pair tokens of whole batches, each distinct piece of text encoded once.

    A piece starts at a single space between two characters that are neither
    white space nor, by their bytes, possibly so.  The split pattern always
    breaks there, so the tokens of a text are those of its pieces.
    """

    def __init__(self, ranks: dict[bytes, int]):
        import tiktoken
        self.end = max(ranks.values()) + 1
        self.encode = tiktoken.Encoding("pieces", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        self.keys = np.zeros(0, np.uint64)
        self.begin, self.size, self.ids = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint16)

    def _piece_starts(self, buf: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        n = len(buf)
        plain = (buf > 0x20) & (buf < 0x7F)
        lead = (buf >= 0xC3) & (buf <= 0xDF)               # U+00C0 to U+07FF hold no white space
        ok = np.zeros(n, bool)
        if n > 2:
            before = plain.copy()
            before[1:] |= lead[:-1]
            ok[1:-1] = (buf[1:-1] == 0x20) & before[:-2] & (plain | lead)[2:]
        first = offsets[:-1][offsets[:-1] < offsets[1:]]
        ok[first] = True
        last = offsets[1:-1]
        edge = last[(last > 0) & (last <= n)] - 1           # a space that ends a row has no character after it
        ok[edge[~np.isin(edge, first)]] = False
        return np.flatnonzero(ok)

    def tokens(self, buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all rows, an end mark after each, and the number of ids per row."""
        starts = self._piece_starts(buf, offsets)
        ends = np.append(starts[1:], len(buf))
        h = K.word_hashes(buf, starts, ends, lower=False)
        keys, at, inverse = np.unique(h, return_index=True, return_inverse=True)
        place = np.searchsorted(self.keys, keys)
        place[place == len(self.keys)] = 0
        new = np.flatnonzero(self.keys[place] != keys) if len(self.keys) else np.arange(len(keys))
        if len(new):
            raw = buf.tobytes()
            lists = [self.encode(raw[i:j].decode("utf-8")) for i, j in zip(starts[at[new]].tolist(), ends[at[new]].tolist())]
            size = np.array([len(x) for x in lists], np.int64)
            ids = np.fromiter((t for x in lists for t in x), np.uint16, int(size.sum()))
            if len(self.keys) + len(new) > CACHED_PIECES and len(new) < len(keys):
                self.keys = np.zeros(0, np.uint64)         # start the store anew with this batch
                return self.tokens(buf, offsets)
            if len(self.keys) == 0:
                self.begin, self.size, self.ids = self.begin[:0], self.size[:0], self.ids[:0]
            begin = np.concatenate([self.begin, np.cumsum(size) - size + len(self.ids)])
            all_keys, self.size, self.ids = np.concatenate([self.keys, keys[new]]), np.concatenate([self.size, size]), np.concatenate([self.ids, ids])
            order = np.argsort(all_keys, kind="stable")   # two sorted runs
            self.keys, self.begin, self.size = all_keys[order], begin[order], self.size[order]
            place = np.searchsorted(self.keys, keys)
        piece = place[inverse]
        size, begin = self.size[piece], self.begin[piece]
        row = np.searchsorted(offsets, starts, side="right") - 1
        per_row = np.bincount(row, weights=size, minlength=len(offsets) - 1).astype(np.int64) + 1
        out = np.full(int(per_row.sum()), self.end, np.uint16)
        put = np.cumsum(size) - size + row                 # one end mark for each earlier row
        step = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
        out[np.repeat(put, size) + step] = self.ids[np.repeat(begin, size) + step]
        return out, per_row


_SEQUENCES = "part int, seq int, n_tokens int, doc_ids array<long>, tokens binary"


def _pack(ranks, length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer, pack = PieceTokenizer(shared(ranks)), packer(PACK_LEVEL)
        part, seq = TaskContext.get().partitionId(), 0
        held, held_docs = np.zeros(0, np.uint16), []        # the open sequence and (id, tokens of it so far)

        def rows(cut: list[tuple[np.ndarray, int, list]]):
            nonlocal seq
            numbers = range(seq, seq + len(cut))
            seq += len(cut)
            return pa.RecordBatch.from_arrays(
                [pa.array([part] * len(cut), pa.int32()), pa.array(numbers, pa.int32()), pa.array([n for _, n, _ in cut], pa.int32()),
                 pa.array([d for _, _, d in cut], pa.list_(pa.int64())), pa.array([pack(x.astype("<u2").tobytes()) for x, _, _ in cut], pa.binary())],
                names=["part", "seq", "n_tokens", "doc_ids", "tokens"])

        for batch in batches:
            ids = batch.column("id").to_pylist()
            for a, b, buf, offsets in K.text_slices(batch.column("text"), SLICE_BYTES):
                got, per_row = tokenizer.tokens(buf, offsets)
                flat = np.concatenate([held, got])
                owners = held_docs + list(zip(ids[a:b], per_row.tolist()))
                last = np.cumsum([n for _, n in owners])
                first = last - [n for _, n in owners]
                whole = len(flat) // length
                cut = []
                for k in range(whole):
                    lo, hi = np.searchsorted(last, k * length, side="right"), np.searchsorted(first, (k + 1) * length, side="left")
                    cut.append((flat[k * length:(k + 1) * length], length, [d for d, _ in owners[lo:hi]]))
                if cut:
                    yield rows(cut)
                done = whole * length
                held = flat[done:]
                held_docs = [(d, int(l - max(f, done))) for (d, _), f, l in zip(owners, first.tolist(), last.tolist()) if l > done]
        if len(held):
            yield rows([(np.append(held, np.full(length - len(held), tokenizer.end, np.uint16)), len(held), [d for d, _ in held_docs])])
    return run


def feistel_slots(index: np.ndarray, n: int, key: int, rounds: int = 6) -> np.ndarray:
    """Keyed permutation of [0, n): a balanced Feistel network with cycle-walking."""
    half = max(1, ((max(n, 2) - 1).bit_length() + 1) // 2)
    mask = np.uint64((1 << half) - 1)
    keys = K.mix64(np.arange(1, rounds + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(key))
    out = index.astype(np.uint64)
    todo = np.arange(len(out))
    while len(todo):
        left, right = out[todo] >> np.uint64(half), out[todo] & mask
        for k in keys:
            left, right = right, left ^ (K.mix64(right + k) & mask)
        out[todo] = (left << np.uint64(half)) | right
        todo = todo[out[todo] >= n]
    return out.astype(np.int64)


def _slots(n: int, key: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            slot = feistel_slots(batch.column("index").to_numpy(), n, key)
            yield pa.RecordBatch.from_arrays([pa.array(slot), *batch.columns[1:]], names=["slot", *batch.schema.names[1:]])
    return run


def _write(path: str, per_shard: int):
    """Writes each shard of a partition sorted by slot; gives one row per sequence."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs
        system, root = fs.FileSystem.from_uri(path)
        attempt = TaskContext.get().taskAttemptId()
        shard, out = None, None

        def close():
            if out is not None:
                out.close()
                name = f"{root}/shard-{shard:06d}.bin"
                if system.get_file_info(name).type != fs.FileType.NotFound:
                    system.delete_file(name)               # an earlier attempt's, with the same bytes
                system.move(f"{name}.{attempt}", name)

        for batch in batches:
            slots, hashes = batch.column("slot").to_numpy(), []
            for i, slot in enumerate(slots.tolist()):
                if slot // per_shard != shard:
                    close()
                    shard = slot // per_shard
                    out = system.open_output_stream(f"{root}/shard-{shard:06d}.bin.{attempt}")
                raw = unpack(batch.column("tokens")[i].as_py())
                out.write(raw)
                hashes.append(hashlib.sha256(raw).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column("slot"), pa.array(slots // per_shard), pa.array(slots % per_shard), batch.column("n_tokens"),
                 batch.column("doc_ids"), pa.array(hashes, pa.string())],
                names=["slot", "shard", "position", "n_tokens", "doc_ids", "sha256"])
        close()
    return run


def write_training_order(docs: DataFrame, path: str | None = None, id_col: str = "doc_id", text_col: str = "text",
                         vocabulary: str = VOCABULARY, length: int = SEQUENCE, per_shard: int = SHARD, key: int = KEY) -> DataFrame:
    """Writes shards and an index below ``path`` (default: a folder in the shared one); returns the index.

    One row per sequence: slot, shard, position (in the shard), n_tokens (without
    padding), doc_ids (in order), sha256 of its bytes.  Ids are little-endian
    unsigned 16-bit; a vocabulary of more ids is refused.
    """
    spark = docs.sparkSession
    path = path or shared_path(spark, "shards")
    ranks = load_ranks(vocabulary)
    if max(ranks.values()) + 1 > 0xFFFF:
        raise ValueError("the vocabulary needs more than 16 bits")
    base = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    packed = materialise(base.mapInArrow(_pack(share(spark, ranks), length), _SEQUENCES), "sequences")
    parts = packed.groupBy("part").agg(F.count("*").alias("n"))        # one row per packing task
    parts = materialise(parts.withColumn("before", F.sum("n").over(Window.orderBy("part")) - F.col("n")), "parts")
    total = parts.agg(F.sum("n")).first()[0] or 0
    shards = -(-total // per_shard)
    tasks = max(1, min(shards, 100_000))
    rows = (packed.join(parts, "part").select((F.col("before") + F.col("seq")).alias("index"), "n_tokens", "doc_ids", "tokens")
            .mapInArrow(_slots(total, key), "slot long, n_tokens int, doc_ids array<long>, tokens binary"))
    task = F.floor(F.floor(F.col("slot") / per_shard) * tasks / F.lit(max(1, shards))).cast("int")
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(folder)
    index = (rows.repartitionById(tasks, task).sortWithinPartitions("slot").mapInArrow(
        _write(path if "://" in path else f"file://{path}" if path.startswith("/") else path.replace("file:/", "file:///", 1), per_shard),
        "slot long, shard long, position long, n_tokens int, doc_ids array<long>, sha256 string"))
    index.write.parquet(f"{path}/index")
    return spark.read.parquet(f"{path}/index")

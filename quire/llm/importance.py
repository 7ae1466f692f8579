"""Target-distribution importance resampling on hashed n-gram features.

Documents are drawn with weights that make their hashed n-grams look like those
of a target table.  Both passes over the texts use batch concatenation: the
texts of a slice are joined with separator sentinels, one regex pass finds all
words, ``searchsorted`` over the documents' offsets tells whose word each is
and masks the n-grams that would cross from one document into the next, and
``bincount`` adds up buckets.  The CRC of an n-gram comes from its words' CRCs
by the combination rule of CRC-32, so no n-gram is ever built as a string.

1. Bucket counts of documents and target: at most ``buckets`` rows from each task.
2. Gains (one number per bucket, an array of ``buckets`` numbers: the only
   broadcast) are averaged over each document's features.
3. The draw is a rank over scores: rows per band of scores are counted (the
   range of scores bounds the number of bands), which tells the band of the last
   drawn document and each band's offset; only rows of those bands are sorted,
   band by band.

Odd input: a null or word-less text has no feature, weight 0 and is never
drawn; ids may have any type, a null id counts as the empty string in the
noise and comes last among equal scores; repeated rows are rows of their own
and rank one after the other; empty tables give no rows (documents) or gains
from the documents alone (target).  Columns other than the two named ones are
not read, so their names cannot clash.  A text longer than a slice is a slice.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quire.llm import kernel as K
from quire.llm.common import discard, materialise, share, shared

BUCKETS = 10_000
MAX_WORDS = 2
SEED = 7
SLICE_BYTES = 1 << 20
#: width of the bands of scores; a score is a mean of gains (under 1000 * ln(2 ** 64) either way) plus noise
#: between -3,110 and 22,200, so there are fewer than 30,000 bands
BAND = 4

_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
_SEPARATOR = b"\x00"


def _shift_tables() -> np.ndarray:
    """[k, j, v]: the CRC register of byte v at place j, moved on by 2 ** k zero bytes."""
    step = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        step = np.where(step & 1, np.uint32(0xEDB88320) ^ (step >> np.uint32(1)), step >> np.uint32(1))
    place = np.arange(4, dtype=np.uint32)[:, None] * np.uint32(8)
    register = np.arange(256, dtype=np.uint32)[None, :] << place
    tables = [step[register & 0xFF] ^ (register >> np.uint32(8))]
    for _ in range(31):
        tables.append(_move(tables[-1], tables[-1]))
    return np.stack(tables)


def _move(table: np.ndarray, crc: np.ndarray) -> np.ndarray:
    return table[0][crc & 0xFF] ^ table[1][crc >> np.uint32(8) & 0xFF] ^ table[2][crc >> np.uint32(16) & 0xFF] ^ table[3][crc >> np.uint32(24)]


_SHIFT = _shift_tables()
_BLANK = np.uint32(zlib.crc32(b" "))


def _append(crc: np.ndarray, next_crc: np.ndarray, next_size: np.ndarray) -> np.ndarray:
    """CRC of first + blank + next, from the CRC of each part."""
    out = _move(_SHIFT[0], crc) ^ _BLANK
    for k in range(int(next_size.max(initial=0)).bit_length()):
        at = np.flatnonzero(next_size >> k & 1)
        out[at] = _move(_SHIFT[k], out[at])
    return out ^ next_crc


def batch_features(column: pa.Array, max_words: int = MAX_WORDS, buckets: int = BUCKETS) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
    """(first row, end row, words of each row, row of each feature, bucket of each feature) for slices of a text column."""
    for a, b, buf, offsets in K.text_slices(column, SLICE_BYTES):
        raw = buf.tobytes().lower()                       # bytes: A-Z only
        ends = offsets.tolist()
        joined = _SEPARATOR.join([raw[i:j] for i, j in zip(ends, ends[1:])])
        first = offsets[:-1] + np.arange(b - a)           # where each document starts in the joined bytes
        starts, words = [], []
        for m in _WORD.finditer(joined):
            starts.append(m.start())
            words.append(m.group())
        crc = np.fromiter(map(zlib.crc32, words), np.uint32, len(words))
        size = np.fromiter(map(len, words), np.int64, len(words))
        of = np.searchsorted(first, np.array(starts, np.int64), side="right") - 1
        owners, found, run = [of], [crc % np.uint32(buckets)], crc
        for n in range(2, max_words + 1):
            if len(crc) < n:
                break
            run = _append(run[:-1], crc[n - 1:], size[n - 1:])
            same = of[n - 1:] == of[:len(of) - n + 1]     # first and last word in one document
            owners.append(of[n - 1:][same])
            found.append(run[same] % np.uint32(buckets))
        yield a, b, np.bincount(of, minlength=b - a), np.concatenate(owners), np.concatenate(found)


def bucket_counts(rows: DataFrame, text_col: str = "text", max_words: int = MAX_WORDS, buckets: int = BUCKETS) -> np.ndarray:
    """How many features of all texts fall into each bucket; one row per bucket reaches the driver."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for *_, found in batch_features(batch.column(0), max_words, buckets):
                total += np.bincount(found, minlength=buckets)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["bucket", "n"])
    each = rows.select(F.col(text_col).cast("string").alias("text")).mapInArrow(count, "bucket long, n long")
    out = np.zeros(buckets, np.int64)
    for r in each.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[r["bucket"]] = r["n"]
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 * ln) of the smoothed ratio of target to source share, bucket by bucket."""
    s_all, t_all, n = float(source.sum()), float(target.sum()), len(source)
    return np.array([math.floor(1000 * math.log((t + 1.0) * (s_all + n) / ((s + 1.0) * (t_all + n))))
                     for s, t in zip(source.tolist(), target.tolist())], np.int64)


def _weights(rows: DataFrame, sent: Broadcast, max_words: int, id_type: str) -> DataFrame:
    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gain = shared(sent)
        for batch in batches:
            for a, b, n_words, of, found in batch_features(batch.column(1), max_words, len(gain)):
                n = np.bincount(of, minlength=b - a)
                total = np.zeros(b - a, np.int64)
                np.add.at(total, of, gain[found])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), pa.array(n_words.astype(np.int64)), pa.array(n.astype(np.int64)),
                     pa.array(total // np.maximum(n, 1))], names=["id", "n_words", "n_features", "weight"])
    return rows.mapInArrow(weigh, f"id {id_type}, n_words long, n_features long, weight long")


def importance_scores(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text", target_text_col: str = "text",
                      percent: int = 25, least_words: int = 20, seed: int = SEED, max_words: int = MAX_WORDS, buckets: int = BUCKETS) -> DataFrame:
    """(``id_col``, n_features, weight, score, rank, n_words) of every document.

    ``weight`` is the floored mean gain of its features, ``score`` adds seeded
    Gumbel noise, and ``rank`` counts the ``percent`` % highest scores among the
    documents with at least ``least_words`` words (null: not drawn).
    """
    gain = gains(bucket_counts(docs, text_col, max_words, buckets), bucket_counts(target, target_text_col, max_words, buckets))
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    noise = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit(""))), 256), 1, 8), 16, 10).cast("long")
    noise = F.floor(-1000 * F.log(-F.log((noise + 0.5) / 4294967296.0))).cast("long")
    sent = share(docs.sparkSession, gain)
    scored = materialise(_weights(rows, sent, max_words, rows.dtypes[0][1]).withColumn("score", F.col("weight") + noise), "scores")
    discard(sent)
    band = F.floor(F.col("score") / BAND).cast("long")
    may = F.col("n_words") >= least_words
    counts = dict(scored.where(may).groupBy(band.alias("band")).agg(F.count("*").alias("n")).collect())
    take, before, offsets = percent * sum(counts.values()) // 100, 0, []
    for b in sorted(counts, reverse=True):
        if before >= take:
            break
        offsets.append((b, before))
        before += counts[b]
    least = offsets[-1][0] if offsets else None
    drawn = may & (band >= F.lit(least)) if offsets else F.lit(False)
    inside = F.row_number().over(Window.partitionBy("band").orderBy(F.col("score").desc(), F.col("id").asc_nulls_last()))
    ranked = (scored.where(drawn).withColumn("band", band)
              .join(F.broadcast(scored.sparkSession.createDataFrame(offsets, "band long, before long")), "band")
              .withColumn("rank", F.col("before") + inside)
              .withColumn("rank", F.when(F.col("rank") <= take, F.col("rank"))))
    out = ranked.select(*scored.columns, "rank").unionByName(scored.where(~drawn).withColumn("rank", F.lit(None).cast("long")))
    return out.select(F.col("id").alias(id_col), "n_features", "weight", "score", "rank", "n_words")


def resample(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """The drawn rows of ``docs`` themselves (ids must be unique and not null)."""
    drawn = importance_scores(docs, target, id_col, **options).where(F.col("rank").isNotNull())
    return docs.join(drawn.select(id_col), id_col, "left_semi")

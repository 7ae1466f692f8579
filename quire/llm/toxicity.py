"""Toxicity by two class-conditional Kneser-Ney models that share their backoff counts.

The units are the bytes of a word between two boundaries, predicted from up to
five bytes before them, so an inflected or rare expression is scored through
the parts that it shares with seen ones.

Training, all as Spark aggregations over every labelled row of the training
folds: counts of distinct words by class, counts of their byte n-grams, and
for each lower order the Kneser-Ney continuation counts (of how many different
bytes a gram follows).  The lowest order is counted over both classes together
and shared.  Probabilities interpolate from there upwards:
``p(w | h) = (max(c(hw) - D, 0) + D * n(h) * p(w | h')) / c(h)``.

The model holds, for each counted gram, the logarithm of the ratio of its two
probabilities and, for each context, that of its two backoff weights; no gram
is left out.  Up to ``MODEL_GRAMS`` grams it is sent to the tasks, which score
in one map.  A larger one stays in tables: the grams of the corpus' distinct
words are joined with them, and the words' ratios with the texts.

A text's score is its log-likelihood ratio divided by its length, put through
a rising curve, the share of toxic rows by ratio, that is fitted on a training
fold left out of the counts.  It assumes no shape: a few texts far out (junk,
rare languages) flatten a logistic curve of a small table to below 0.5.

Edge cases: null and empty texts get the share of toxic rows in the training
labels; if one class has no training row every score is 0; a null label is no
label; several labels of one id count as the largest; rows that repeat an id
are scored each for itself; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from quire.llm import kernel as K
from quire.llm.common import materialise, share, shared

ORDER = 6
DISCOUNT = 0.75
#: most grams (and contexts) of a model that is sent to all tasks; a larger one is joined
MODEL_GRAMS = 1 << 20
#: added to a text's length before its log-likelihood ratio is divided by it, so a few words prove little
SHORT_BYTES = 200
#: labels up to this number are sent to all tasks; more are joined by a shuffle
BROADCAST_LABELS = 2_000_000
#: folds of crc32(id) mod 5: 0 is held out, 1 fits the curve, the rest is counted
HELD_OUT, CURVE = 0, 1
SCORE_BYTES = 1 << 20
CACHED_WORDS = 1 << 18
_BINS = 10000.0
_LEN = 56


def fold_of(id_col: str):
    return F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(5)).cast("int")


def _distinct_words(buf, offsets):
    """hash, start, end of the distinct words of a slice, the inverse, and the rows' first words."""
    starts, ends, first = K.word_spans(buf, offsets)
    h = K.word_hashes(buf, starts, ends, lower=True)
    keys, at, inverse = np.unique(h, return_index=True, return_inverse=True)
    return keys, starts[at], ends[at], inverse, first


def _word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        toxic = batch.column("toxic").to_numpy(zero_copy_only=False) > 0
        for a, b, buf, offsets in K.text_slices(batch.column("text"), SCORE_BYTES):
            keys, s, e, inverse, first = _distinct_words(buf, offsets)
            of_toxic = np.repeat(toxic[a:b], np.diff(first))
            t = np.bincount(inverse, weights=of_toxic, minlength=len(keys)).astype(np.int64)
            n = np.bincount(inverse, minlength=len(keys)).astype(np.int64)
            lowered = K._LOWER[buf].tobytes()
            words = pa.array([lowered[i:j] for i, j in zip(s.tolist(), e.tolist())], pa.binary())
            yield pa.RecordBatch.from_arrays([words, pa.array(t), pa.array(n - t)], names=["word", "t", "o"])


def _padded(words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Flat bytes of the words between boundaries, each byte's place in its word, and each byte's word."""
    flat = np.frombuffer(b"".join(b" " + w + b" " for w in words), np.uint8).astype(np.uint64)
    size = np.array([len(w) + 2 for w in words], np.int64)
    start = np.cumsum(size) - size
    owner = np.repeat(np.arange(len(words)), size)
    return flat, np.arange(len(flat)) - start[owner], owner


def _gram_keys(flat: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """(order, key of the gram that ends at each byte) for orders 1 to ORDER."""
    key = np.zeros(len(flat), np.uint64)
    for m in range(1, ORDER + 1):
        key[m - 1:] |= flat[:len(flat) - m + 1] << np.uint64(8 * (m - 1))
        yield m, key | np.uint64(m << _LEN)


def _grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of the longest gram that ends at each byte of each word."""
    for batch in batches:
        words = batch.column("word").to_pylist()
        if not words:
            continue
        flat, place, owner = _padded(words)
        longest = np.zeros(len(flat), np.uint64)
        for m, key in _gram_keys(flat):
            longest = np.where(place >= m - 1, key, longest)
        here = place > 0
        keys, inverse = np.unique(longest[here], return_inverse=True)
        cols = [np.bincount(inverse, weights=batch.column(c).to_numpy()[owner[here]], minlength=len(keys)).astype(np.int64) for c in "to"]
        yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(cols[0]), pa.array(cols[1])], names=["key", "t", "o"])


def _with_order(key, m: int):
    """The last ``m`` bytes of a key as a gram of order ``m``."""
    return key.bitwiseAND(F.lit((1 << 8 * m) - 1)).bitwiseOR(F.lit(m << _LEN))


@dataclass
class ToxicityModel:
    """Sorted gram keys with log ratios, sorted context keys with log backoff ratios, curve, prior.

    ``tables``: (grams, contexts) as tables of key and value instead, if they are too many to send.
    """
    keys: np.ndarray
    values: np.ndarray
    contexts: np.ndarray
    backoffs: np.ndarray
    #: ratios and their shares of toxic rows; the sign of the ratio decides where too few rows give a curve
    curve: tuple[np.ndarray, np.ndarray] = (np.array([-0.1, 0.1]), np.array([0.0, 1.0]))
    prior: float = 0.0
    tables: tuple[DataFrame, DataFrame] | None = None

    def __post_init__(self):
        self._cache = (np.zeros(0, np.uint64), np.zeros(0, np.float64))

    @staticmethod
    def _get(keys, values, wanted):
        at = np.searchsorted(keys, wanted)
        at[at == len(keys)] = 0
        hit = keys[at] == wanted if len(keys) else np.zeros(len(wanted), bool)
        return hit, (values[at] if len(keys) else np.zeros(len(wanted)))

    def _word_ratios(self, words: list[bytes]) -> np.ndarray:
        flat, place, owner = _padded(words)
        grams = dict(_gram_keys(flat))
        total = np.zeros(len(flat))
        open_ = np.flatnonzero(place > 0)
        for m in range(ORDER, 1, -1):
            now = open_[place[open_] >= m - 1]
            hit, value = self._get(self.keys, self.values, grams[m][now])
            total[now[hit]] += value[hit]
            missed = now[~hit]
            context = ((grams[m][missed] & np.uint64((1 << _LEN) - 1)) >> np.uint64(8)) | np.uint64((m - 1) << _LEN)
            known, weight = self._get(self.contexts, self.backoffs, context)
            total[missed] += np.where(known, weight, 0.0)
            open_ = np.concatenate([missed, open_[place[open_] < m - 1]])
        return np.bincount(owner, weights=total, minlength=len(words))

    def ratios(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Length-normalised log-likelihood ratio, and the number of words, of each row."""
        ratio, n_words = np.zeros(len(column)), np.zeros(len(column), np.int64)
        for a, b, buf, offsets in K.text_slices(column, SCORE_BYTES):
            keys, s, e, inverse, first = _distinct_words(buf, offsets)
            known, value = self._get(*self._cache, keys)
            new = np.flatnonzero(~known)
            if len(new):
                lowered = K._LOWER[buf].tobytes()
                value = value.copy()
                value[new] = self._word_ratios([lowered[i:j] for i, j in zip(s[new].tolist(), e[new].tolist())])
                old = self._cache if len(self._cache[0]) + len(new) <= CACHED_WORDS else (keys[:0], value[:0])
                merged, at = np.unique(np.concatenate([old[0], keys[new]]), return_index=True)
                self._cache = (merged, np.concatenate([old[1], value[new]])[at])
            of = np.repeat(np.arange(b - a), np.diff(first))
            size = np.bincount(of, weights=(e - s + 1)[inverse], minlength=b - a)
            ratio[a:b] = np.bincount(of, weights=value[inverse], minlength=b - a) / (size + SHORT_BYTES)
            n_words[a:b] = np.diff(first)
        return ratio, n_words

    def scores(self, column: pa.Array) -> np.ndarray:
        if not len(self.keys):
            return np.zeros(len(column))
        ratio, n = self.ratios(column)
        return np.where(n > 0, np.interp(ratio, *self.curve), self.prior)


def _kneser_ney(grams: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(grams, contexts): key and value of all orders above the shared one, from counts of longest grams."""
    level = grams.where(F.shiftright("key", _LEN) == ORDER)
    levels = {ORDER: level}
    for m in range(ORDER - 1, 0, -1):
        below = level.groupBy(_with_order(F.col("key"), m).alias("key")).agg(
            F.sum((F.col("t") > 0).cast("long")).alias("t"), F.sum((F.col("o") > 0).cast("long")).alias("o"))
        level = below.unionByName(grams.where(F.shiftright("key", _LEN) == m)) if m > 1 else below
        level = levels[m] = materialise(level, f"order{m}")
    both = levels[1].withColumn("n", F.col("t") + F.col("o"))
    total = both.agg(F.sum("n")).first()[0] or 1
    lower = both.select("key", (F.col("n") / total).alias("pt"), (F.col("n") / total).alias("po"))
    kept, contexts = [], []
    for m in range(2, ORDER + 1):
        context = F.shiftright(F.col("key").bitwiseAND(F.lit((1 << 8 * m) - 1)), 8).bitwiseOR(F.lit(m - 1 << _LEN))
        rows = levels[m].select("key", "t", "o", context.alias("ctx"), _with_order(F.col("key"), m - 1).alias("suffix"))
        sums = rows.groupBy("ctx").agg(F.sum("t").alias("ct"), F.sum("o").alias("co"),
                                       F.sum((F.col("t") > 0).cast("long")).alias("nt"), F.sum((F.col("o") > 0).cast("long")).alias("no"))
        sums = (sums.withColumn("wt", F.when(F.col("ct") > 0, DISCOUNT * F.col("nt") / F.col("ct")).otherwise(1.0))
                .withColumn("wo", F.when(F.col("co") > 0, DISCOUNT * F.col("no") / F.col("co")).otherwise(1.0)))
        p = (rows.join(sums, "ctx").join(lower.select(F.col("key").alias("suffix"), F.col("pt").alias("qt"), F.col("po").alias("qo")), "suffix")
             .withColumn("pt", F.when(F.col("ct") > 0, F.greatest(F.col("t") - DISCOUNT, F.lit(0.0)) / F.col("ct")).otherwise(0.0) + F.col("wt") * F.col("qt"))
             .withColumn("po", F.when(F.col("co") > 0, F.greatest(F.col("o") - DISCOUNT, F.lit(0.0)) / F.col("co")).otherwise(0.0) + F.col("wo") * F.col("qo")))
        lower = materialise(p.select("key", "pt", "po", F.log(F.col("pt") / F.col("po")).alias("value")), f"kn{m}")
        kept.append(lower.select("key", "value"))
        contexts.append(sums.select(F.col("ctx").alias("key"), F.log(F.col("wt") / F.col("wo")).alias("value")))
    def together(parts):
        out = parts[0]
        for x in parts[1:]:
            out = out.unionByName(x)
        return out
    return together(kept), together(contexts)


def _sorted(table: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Keys and values of all rows, by key."""
    got = table.select("key", "value").toArrow()
    keys = got.column("key").to_numpy().astype(np.int64).view(np.uint64)
    order = np.argsort(keys)
    return keys[order], got.column("value").to_numpy()[order]


def _words_of_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The words of (k1, k2, text), once for each text: hash, times, bytes with a boundary; the first of a text has one = 1."""
    for batch in batches:
        for a, b, buf, offsets in K.text_slices(batch.column("text"), SCORE_BYTES):
            keys, s, e, inverse, first = _distinct_words(buf, offsets)
            of = np.repeat(np.arange(b - a), np.diff(first))
            pair, times = np.unique(of * max(1, len(keys)) + inverse, return_counts=True)
            row, word = np.divmod(pair, max(1, len(keys)))
            one = np.diff(row, prepend=-1) > 0
            yield pa.RecordBatch.from_arrays(
                [batch.column("k1").take(pa.array(row + a)), batch.column("k2").take(pa.array(row + a)), pa.array(keys[word].view(np.int64)),
                 pa.array(times.astype(np.int64)), pa.array((e - s + 1)[word].astype(np.int64)), pa.array(one.astype(np.int64))],
                names=["k1", "k2", "w", "times", "size", "one"])


def _grams_of_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The longest gram that ends at each byte of each distinct word of a slice: hash of the word, key, times."""
    for batch in batches:
        for _, _, buf, offsets in K.text_slices(batch.column("text"), SCORE_BYTES):
            keys, s, e, _, _ = _distinct_words(buf, offsets)
            if not len(keys):
                continue
            lowered = K._LOWER[buf].tobytes()
            flat, place, owner = _padded([lowered[i:j] for i, j in zip(s.tolist(), e.tolist())])
            longest = np.zeros(len(flat), np.uint64)
            for m, key in _gram_keys(flat):
                longest = np.where(place >= m - 1, key, longest)
            here = place > 0
            yield pa.RecordBatch.from_arrays([pa.array(keys[owner[here]].view(np.int64)), pa.array(longest[here].view(np.int64)),
                                              pa.array(place[here].astype(np.int32))], names=["w", "key", "place"])


def _joined_ratios(texts: DataFrame, tables: tuple[DataFrame, DataFrame]) -> DataFrame:
    """(k1, k2, ratio): what ``ToxicityModel.ratios`` gives, of each (k1, k2, text) with a word, by joins with the tables."""
    used = materialise(texts.select("text").mapInArrow(_grams_of_words, "w long, key long, place int").distinct(), "wordgrams")
    values, backoffs = tables
    low = "(key & (shiftleft(1L, 8 * m) - 1L))"
    tried = (used.select("key").distinct().select("key", F.explode(F.sequence(F.lit(2), F.shiftright("key", _LEN).cast("int"))).alias("m"))
             .select("key", "m", F.expr(f"{low} | shiftleft(cast(m as long), {_LEN})").alias("gram"),
                     F.expr(f"shiftright({low}, 8) | shiftleft(cast(m - 1 as long), {_LEN})").alias("ctx")))
    tried = (tried.join(values.select(F.col("key").alias("gram"), "value"), "gram", "left")
             .join(backoffs.select(F.col("key").alias("ctx"), F.col("value").alias("weight")), "ctx", "left"))
    orders = range(2, ORDER + 1)
    each = tried.groupBy("key").agg(*[F.max(F.when(F.col("m") == m, F.col(c))).alias(f"{c}{m}") for m in orders for c in ("value", "weight")])
    ratio = F.lit(0.0)
    for m in orders:
        ratio = F.coalesce(F.col(f"value{m}"), F.coalesce(F.col(f"weight{m}"), F.lit(0.0)) + ratio)
    words = materialise(used.join(each.select("key", ratio.alias("ratio")), "key").groupBy("w").agg(F.sum("ratio").alias("ratio")), "words")
    pairs = texts.select("k1", "k2", "text").mapInArrow(_words_of_texts, "k1 long, k2 long, w long, times long, size long, one long")
    sums = pairs.join(words, "w").groupBy("k1", "k2").agg(
        F.sum(F.col("ratio") * F.col("times")).alias("s"), F.sum(F.col("size") * F.col("times")).alias("l"), F.sum("one").alias("n"))
    return sums.select("k1", "k2", ((F.col("s") / F.col("n")) / (F.col("l") / F.col("n") + SHORT_BYTES)).alias("ratio"))


def _with_ratio(rows: DataFrame, text_col: str, tables: tuple[DataFrame, DataFrame]) -> DataFrame:
    """``rows`` with ``_quire_ratio``, null where a text has no word; equal texts are equal to the joins."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    keys = [F.xxhash64(text), F.xxhash64(F.lit(1), text)]
    ratios = _joined_ratios(rows.select(keys[0].alias("k1"), keys[1].alias("k2"), text.alias("text")), tables)
    ratios = ratios.select(F.col("k1").alias("_quire_k1"), F.col("k2").alias("_quire_k2"), F.col("ratio").alias("_quire_ratio"))
    return (rows.withColumns({"_quire_k1": keys[0], "_quire_k2": keys[1]}).join(ratios, ["_quire_k1", "_quire_k2"], "left")
            .select(*rows.columns, "_quire_ratio"))


def _fit_curve(bins: list[tuple[float, int, int]]) -> tuple[np.ndarray, np.ndarray]:
    """Rising curve through (ratio, toxic rows, other rows): neighbours are pooled while a lower ratio has the larger share."""
    pools: list[list[float]] = []                 # toxic rows, all rows, sum of ratios
    for x, t, o in sorted(bins):
        pools.append([t, t + o, x * (t + o)])
        while len(pools) > 1 and pools[-2][0] * pools[-1][1] >= pools[-1][0] * pools[-2][1]:
            last = pools.pop()
            pools[-1] = [a + b for a, b in zip(pools[-1], last)]
    t, n, x = np.array(pools, float).T
    return x / n, t / n


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
        model_grams: int = MODEL_GRAMS) -> ToxicityModel:
    """Model from every labelled document of the training folds."""
    known = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("_id")).agg(
        F.max(F.col(label_col).cast("int")).alias("toxic"))
    if labels.count() <= BROADCAST_LABELS:
        known = F.broadcast(known)
    rows = (docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("text"), fold_of(id_col).alias("fold"))
            .where(F.col("fold") != HELD_OUT).join(known, "_id").select("text", "toxic", "fold"))
    words = (rows.where(F.col("fold") != CURVE).select("text", "toxic").mapInArrow(_word_counts, "word binary, t long, o long")
             .groupBy("word").agg(F.sum("t").alias("t"), F.sum("o").alias("o")))
    grams = materialise(words.mapInArrow(_grams, "key long, t long, o long").groupBy("key").agg(
        F.sum("t").alias("t"), F.sum("o").alias("o")), "grams")
    seen = grams.agg(F.sum("t"), F.sum("o")).first()
    if not seen[0] or not seen[1]:
        return ToxicityModel(*(np.zeros(0, k) for k in (np.uint64, np.float32) * 2))
    values, backoffs = _kneser_ney(grams)
    backoffs = materialise(backoffs, "backoffs")
    if max(values.count(), backoffs.count()) <= model_grams:
        model = ToxicityModel(*_sorted(values), *_sorted(backoffs))
        sent = share(docs.sparkSession, model)
    else:
        model = ToxicityModel(*(np.zeros(0, k) for k in (np.uint64, np.float64) * 2), tables=(values, backoffs))

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared(sent)
        for batch in batches:
            ratio, n = model.ratios(batch.column("text"))
            keep = pa.array(n > 0)
            yield pa.RecordBatch.from_arrays([pa.array(np.clip(np.rint(ratio * _BINS), -100000, 100000).astype(np.int64)), batch.column("toxic")],
                                             names=["bin", "toxic"]).filter(keep)

    curve = rows.where(F.col("fold") == CURVE).select("text", "toxic")
    if model.tables:
        ratio = F.rint(F.col("_quire_ratio") * _BINS)
        curve = (_with_ratio(curve, "text", model.tables).where("_quire_ratio is not null")
                 .select(F.greatest(F.lit(-100000), F.least(F.lit(100000), ratio)).cast("long").alias("bin"), "toxic"))
    else:
        curve = curve.mapInArrow(measure, "bin long, toxic int")
    bins = curve.groupBy("bin").agg(F.sum((F.col("toxic") > 0).cast("long")).alias("t"), F.count("*").alias("n")).collect()
    bins = [(r["bin"] / _BINS, r["t"], r["n"] - r["t"]) for r in bins]
    if sum(b[1] for b in bins) and sum(b[2] for b in bins):
        model.curve = _fit_curve(bins)
        model.prior = sum(b[1] for b in bins) / sum(b[1] + b[2] for b in bins)
    return model


def _score_column(sent, text_at: int, column: str, least: float | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared(sent)
        for batch in batches:
            score = model.scores(batch.column(text_at))
            if least is not None:
                yield batch.filter(pa.array(score < least))
            else:
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(score)], names=[*batch.schema.names, column])
    return run


def _joined_score(docs: DataFrame, model: ToxicityModel, text_col: str, column: str) -> DataFrame:
    x, p, prior = *model.curve, model.prior

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ratio = batch.column(batch.num_columns - 1)
            value = np.interp(ratio.fill_null(0.0).to_numpy(zero_copy_only=False), x, p)
            value = np.where(ratio.is_valid().to_numpy(zero_copy_only=False), value, prior)
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(value)], names=[*batch.schema.names[:-1], column])
    schema = StructType([*docs.schema.fields, StructField(column, DoubleType())])
    return _with_ratio(docs, text_col, model.tables).mapInArrow(run, schema)


def score(docs: DataFrame, model: ToxicityModel, text_col: str = "text", column: str = "score") -> DataFrame:
    """``docs`` with a score from 0 to 1 (higher: toxic is likelier); a map over the rows, or joins if the model is in tables.

    A column of ``docs`` that is named like the score is replaced.
    """
    docs = docs.drop(column)
    if model.tables:
        return _joined_score(docs, model, text_col, column)
    sent = share(docs.sparkSession, model)
    at = docs.columns.index(text_col)
    schema = StructType([*docs.schema.fields, StructField(column, DoubleType())])
    return docs.mapInArrow(_score_column(sent, at, column, None), schema)


def drop_toxic(docs: DataFrame, model: ToxicityModel, text_col: str = "text", least: float = 0.5) -> DataFrame:
    """``docs`` without the rows that score ``least`` or more, all columns as they are; a map, or joins if the model is in tables."""
    if model.tables:
        return _joined_score(docs, model, text_col, "_quire_score").where(F.col("_quire_score") < least).drop("_quire_score")
    sent = share(docs.sparkSession, model)
    return docs.mapInArrow(_score_column(sent, docs.columns.index(text_col), "", least), docs.schema)

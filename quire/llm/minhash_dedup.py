"""Near-duplicate documents by circulant MinHash, banding and exact Jaccard verification.

1. One pass hashes every text to its set of word shingles, a key of the set and
   the band keys of a circulant MinHash signature (two permutations, one of
   them shifted circularly, generate all coordinates).  Texts with equal sets
   become one class; from here on copies cost nothing, however many there are.
2. Classes that share a band key are linked with the class of that bucket that
   shares most keys with others, as an original does with its copies (a star,
   never all pairs); each link is confirmed on the full shingle sets.
3. Buckets whose other members still hold several components are compared block
   by block, those with the same members once: an inverted index of a block's shingles counts what a text has in common with
   all others at once, and a link joins two components for the rest of the
   block.  So no pair that banding found is given up because the star's centre
   was not its partner, and a block returns links, fewer than it has rows,
   never its pairs.
4. Components come from star contraction of the confirmed links.

Missed links: a pair at similarity 0.75 shares none of the 32 bands of four
coordinates with probability (1 - 0.75^4)^32, below 6 in a million.

Edge cases: null or empty texts and texts of white space have no shingles and
are linked with nothing; fewer words than a shingle make one shingle of the
whole sequence; an id may stand for several texts (null ids do), so a document
is its id and its text: rows that repeat both are one document; a null id counts
as the id "null" and loses every tie; an empty table gives an empty result.
"""

from __future__ import annotations

from collections import OrderedDict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.llm import kernel as K
from quire.llm.common import NULL_ID, id_key, key_to_id, materialise
from quire.llm.graph import components
from quire.llm.packing import pack_texts, unpack

#: bands, and signature coordinates of each band
BANDS, ROWS = 32, 4
#: rows of one block when a bucket with several components is compared
BLOCK = 512
#: bytes of shingle sets a verifying task keeps for reuse
CACHE_BYTES = 64 << 20

_SKETCH = "id long, tid long, n_shingles long, cls long, bands array<long>"


def set_key(shingles: np.ndarray) -> int:
    """64-bit key of a shingle set."""
    spread = K.mix64(shingles ^ np.uint64(0xA0761D6478BD642F))
    return int(K.mix64(np.array([spread.sum(dtype=np.uint64) + np.uint64(len(shingles))])).view(np.int64)[0])


def _sketches(words: int, bands: int):
    """Each 64-bit entry of ``bands`` holds four coordinates of the signature, 16 bits each."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cls, size, keys = [], [], []
            for _, x in K.shingle_sets(batch.column("text"), words):
                size.append(len(x))
                if len(x) == 0:
                    cls.append(None), keys.append([])
                    continue
                s = K.circulant_signature(x, bands * ROWS) * np.uint32(0x9E3779B1) >> np.uint32(16)
                cls.append(set_key(x)), keys.append(s.astype(np.uint16).view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("tid"), pa.array(size, pa.int64()), pa.array(cls, pa.int64()), pa.array(keys, pa.list_(pa.int64()))],
                names=["id", "tid", "n_shingles", "cls", "bands"])
    return run


class _Sets:
    """Shingle sets of packed texts, the latest kept up to a bound of bytes."""

    def __init__(self, words: int, percent: int):
        self.words, self.percent, self.held = words, percent, 0
        self.cache: OrderedDict[int, np.ndarray] = OrderedDict()

    def get(self, cls: int, packed: bytes) -> np.ndarray:
        if cls in self.cache:
            self.cache.move_to_end(cls)
            return self.cache[cls]
        _, x = next(K.shingle_sets(pa.array([unpack(packed)], pa.large_binary()), self.words))
        self.cache[cls] = x
        self.held += x.nbytes
        while self.held > CACHE_BYTES and len(self.cache) > 2:
            self.held -= self.cache.popitem(last=False)[1].nbytes
        return x

    def linked(self, a: np.ndarray, b: np.ndarray) -> bool:
        """100 * |both| >= percent * |either|"""
        if 100 * min(len(a), len(b)) < self.percent * max(len(a), len(b)):
            return False
        both = len(np.intersect1d(a, b, assume_unique=True))
        return 100 * both >= self.percent * (len(a) + len(b) - both)


def _verify(words: int, percent: int):
    """Keeps the linked pairs of (u, v, tu, tv)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sets = _Sets(words, percent)
        for batch in batches:
            us, vs = batch.column("u").to_pylist(), batch.column("v").to_pylist()
            tu, tv = batch.column("tu"), batch.column("tv")
            keep = [i for i, (u, v) in enumerate(zip(us, vs))
                    if sets.linked(sets.get(u, tu[i].as_py()), sets.get(v, tv[i].as_py()))]
            yield pa.RecordBatch.from_arrays(
                [pa.array([us[i] for i in keep], pa.int64()), pa.array([vs[i] for i in keep], pa.int64())], names=["u", "v"])
    return run


def _across(words: int, percent: int):
    """Links between components inside one block pair of one bucket (no annotations: Spark would read them)."""
    def run(t):
        cls, comp, side = (t.column(c).to_numpy() for c in ("cls", "comp", "side"))
        texts = pa.array([unpack(x.as_py()) for x in t.column("packed")], pa.large_binary())
        sets = [x for _, x in K.shingle_sets(texts, words)]
        size = np.array([len(x) for x in sets])
        _, column = np.unique(np.concatenate(sets), return_inverse=True)
        rows = np.repeat(np.arange(len(sets)), size)[np.argsort(column, kind="stable")]
        begin = np.append(0, np.cumsum(np.bincount(column)))
        own = np.append(0, np.cumsum(size))
        _, group = np.unique(comp, return_inverse=True)
        links = []
        for i in np.flatnonzero(side != 2).tolist():
            other = (side != 1) & (group != group[i])
            if not other.any():
                continue
            both = np.bincount(np.concatenate([rows[begin[c]:begin[c + 1]] for c in column[own[i]:own[i + 1]].tolist()]), minlength=len(sets))
            for j in np.flatnonzero(other & (100 * both >= percent * (size + size[i] - both))).tolist():
                if group[j] != group[i]:
                    links.append((min(cls[i], cls[j]), max(cls[i], cls[j])))
                    group[group == group[j]] = group[i]
        u, v = zip(*links) if links else ((), ())
        return pa.table({"u": pa.array(u, pa.int64()), "v": pa.array(v, pa.int64())})
    return run


def _confirmed(pairs: DataFrame, texts: DataFrame, words: int, percent: int) -> DataFrame:
    t = texts.select("cls", "packed")
    with_u = pairs.join(t.select(F.col("cls").alias("u"), F.col("packed").alias("tu")), "u")
    with_both = with_u.join(t.select(F.col("cls").alias("v"), F.col("packed").alias("tv")), "v")
    return with_both.select("u", "v", "tu", "tv").mapInArrow(_verify(words, percent), "u long, v long")


def _text_key(text_col: str):
    return F.xxhash64(F.col(text_col).cast("string"))


def near_duplicate_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5,
                           percent: int = 75, bands: int = BANDS) -> tuple[DataFrame, DataFrame]:
    """(sketches, links): one row per document (id, tid, n_shingles, cls), and the confirmed links u < v between classes."""
    base = docs.select(id_key(id_col).alias("id"), _text_key(text_col).alias("tid"), F.col(text_col).cast("string").alias("text"))
    sketches = materialise(base.mapInArrow(_sketches(words, bands), _SKETCH), "sketch")
    classes = materialise(sketches.where("cls is not null").groupBy("cls")
                          .agg(F.min(F.struct("id", "tid")).alias("least"), F.first("bands").alias("bands")), "classes")
    members = classes.select(F.posexplode("bands").alias("band", "word"), "cls").select(
        F.xxhash64("band", "word").alias("key"), "cls")
    sizes = members.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    member = materialise(members.join(sizes, "key"), "members")
    central = member.groupBy("cls").agg(F.sum("n").alias("shared"))
    member = materialise(member.join(central, "cls"), "members")
    hubs = member.groupBy("key").agg(F.max(F.struct("shared", "cls")).alias("hub")).select("key", F.col("hub.cls").alias("hub"))
    led = materialise(member.join(hubs, "key").where("cls <> hub").select("key", "cls", "hub"), "led")
    star = materialise(led.select(F.least("hub", "cls").alias("u"), F.greatest("hub", "cls").alias("v")).distinct(), "star")
    wanted = star.select(F.col("u").alias("cls")).union(star.select(F.col("v").alias("cls"))).distinct()
    # of each class, the text of its least id and text hash; equal texts of a repeated id count once
    texts = materialise(pack_texts(base).join(classes.join(wanted, "cls").select("cls", "least.id", "least.tid"), ["id", "tid"])
                        .groupBy("cls").agg(F.first("packed").alias("packed")), "texts")
    links = materialise(_confirmed(star, texts, words, percent), "links")
    # the star has compared every hub with its whole bucket, and buckets with the same other members ask the same thing
    state = led.join(components(links).withColumnRenamed("node", "cls"), "cls", "left").select(
        "key", "cls", F.coalesce("root", "cls").alias("comp"))
    mixed = (state.groupBy("key").agg(F.min("comp").alias("a"), F.max("comp").alias("b"), F.count("*").alias("n"),
                                      F.sum(F.xxhash64("cls").cast("decimal(20,0)")).alias("members"))
             .where("a <> b").groupBy("members", "n").agg(F.min("key").alias("key"))
             .select("key", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks")))
    open_rows = (state.join(mixed, "key").join(texts, "cls")
                 .withColumn("block", F.pmod(F.xxhash64("cls"), F.col("blocks")).cast("int")))
    part = (open_rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
            .select("key", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "cls", "comp", "packed",
                    F.when(F.col("block") == F.col("other"), 0).when(F.col("block") < F.col("other"), 1).otherwise(2).alias("side")))
    # by number: few bytes are much work here, so adaptive execution must not put them into one task
    tasks = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    more = part.repartition(tasks, "key", "i", "j").groupBy("key", "i", "j").applyInArrow(_across(words, percent), "u long, v long").distinct()
    return sketches, links.unionByName(materialise(more, "links"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5, percent: int = 75) -> DataFrame:
    """One row per document: id_col, n_shingles, component_id (least id reachable), kept (id = component_id)."""
    sketches, links = near_duplicate_classes(docs, id_col, text_col, words, percent)
    roots = components(links)
    rows = (sketches.join(roots, sketches["cls"] == roots["node"], "left")
            .select("id", "n_shingles", F.coalesce("root", "cls").alias("comp")))
    least = rows.where("comp is not null").groupBy("comp").agg(
        F.min(F.when(F.col("id") != F.lit(NULL_ID), F.col("id"))).alias("low"))
    out = rows.join(least, "comp", "left").withColumn("component", F.coalesce("low", "id"))
    return out.select(key_to_id("id").alias(id_col), "n_shingles", key_to_id("component").alias("component_id"),
                      (F.col("id") == F.col("component")).alias("kept"))


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5, percent: int = 75) -> DataFrame:
    """``docs`` without the documents whose group holds a smaller one (by id, null last, then text hash), repeated rows once."""
    sketches, links = near_duplicate_classes(docs, id_col, text_col, words, percent)
    rows = (sketches.join(components(links), F.col("cls") == F.col("node"), "left")
            .select("id", "tid", F.coalesce("root", "cls").alias("comp")))
    least = rows.where("comp is not null").groupBy("comp").agg(F.min(F.struct(F.col("id") == F.lit(NULL_ID), "id", "tid")).alias("low"))
    kept = (rows.join(least, "comp", "left").where("comp is null or (id = low.id and tid = low.tid)")
            .select(F.col("id").alias("_quire_id"), F.col("tid").alias("_quire_tid")).distinct())
    keys = ["_quire_id", "_quire_tid"]
    # repeated rows first: their partial aggregation leaves no large group to a task
    return (docs.withColumns({"_quire_id": id_key(id_col), "_quire_tid": _text_key(text_col)}).dropDuplicates(keys)
            .join(kept, keys, "left_semi").select(*docs.columns))

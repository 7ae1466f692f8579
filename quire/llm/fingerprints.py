"""Document fingerprints by I-Match with randomised lexicons; DataFrame functions only.

The lexicon keeps the terms within a band of inverse document frequency.  Its
size has a bound that does not grow with the number of documents: terms in at
least one of 2000 documents number at most 2000 times the mean count of
distinct terms of a document.  So it is sent to all tasks, and the terms of a
document, which already lie in one partition, are matched there: a first pass
counts them, a second gathers the few (16 to 32 on average) that fall into the
subsets of the document's level.

A fingerprint holds one hash for each of 32 randomised subsets of the lexicon at two
densities: the document's distinct terms of the subset are sorted by their 64-bit
hashes, and the sorted list is hashed.  Beside them stands a hash of all in-band
terms, which may be thousands: that one is the sum of its terms' hashes, the
same in every order, and serves only to tell equal sets.  Densities halve
from level to level; a document uses the level at which it has between half a
term and one term per subset, and the next sparser one, so that texts of any
length lose a similar share of hashes to an edit, and texts whose numbers of
terms differ less than twofold share a level.  Likeness is the share of subset
hashes that agree, among those that either text has, at the shared levels.

Edge cases: a null text is empty; texts without an in-band term are alike only
if they have the same terms; a null id counts as smaller than every id, and rows
without an id are spread by their texts, so that many of them are no hot key; rows
that repeat an id are one document for the order (that of the least hash
stands for it) and each get their own row; a single document is followed by
itself; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quire.llm.common import NULL_ID, id_key, key_to_id, materialise

#: the band of inverse document frequency, as shares of documents
LEAST_SHARE, MOST_SHARE = 1 / 2000, 0.5
CELLS = 32
#: a row: its partition (the id, or the text's hash where that is null), its id and its text's hash
KEY = ("place", "id", "tid")
_SPACES = r"[\x20\x09-\x0D]+"


def _terms(text: Column) -> Column:
    return F.array_distinct(F.array_remove(F.split(F.lower(text), _SPACES), ""))


def _row_key(place: str, id_: str, tid: str) -> Column:
    """The row's place and id, its partition, as join keys; its text's hash is a condition beside them, so rows need not move again."""
    return (F.col("place") == F.col(place)) & (F.col("id") == F.col(id_)) & (F.col("tid").bitwiseXOR(F.col(tid)) == 0)


def lexicon(texts: DataFrame, text_col: str = "text") -> DataFrame:
    """(term): 64-bit hashes of the in-band terms, counted over all documents."""
    counts = texts.select(F.explode(_terms(F.col(text_col))).alias("t")).groupBy(F.xxhash64("t").alias("term")).agg(F.count("*").alias("df"))
    n = texts.count()
    return counts.where((F.col("df") >= LEAST_SHARE * n) & (F.col("df") <= max(1.0, MOST_SHARE * n))).select("term")


def _next_ids(ids: DataFrame) -> DataFrame:
    """(id, need, next): each id's successor, the first after the last, by buckets of about equal size."""
    cuts = ids.agg(F.percentile_approx("id", [i / 256 for i in range(1, 256)], 10_000)).first()[0] or []
    cuts = F.array(*[F.lit(int(c)) for c in sorted(set(cuts))]) if cuts else F.array().cast("array<bigint>")
    rows = ids.withColumn("bucket", F.size(F.filter(cuts, lambda c: c < F.col("id"))))
    inner = rows.withColumn("next", F.lead("id").over(Window.partitionBy("bucket").orderBy("id")))
    firsts = rows.groupBy("bucket").agg(F.min("id").alias("first"))       # at most 256 rows
    order = Window.orderBy("bucket")
    after = F.coalesce(F.lead("first").over(order), F.min("first").over(Window.partitionBy()))
    return (inner.join(F.broadcast(firsts.select("bucket", after.alias("after"))), "bucket")
            .select("id", "need", F.coalesce("next", "after").alias("next")))


def _level(n: Column) -> Column:
    return F.greatest(F.lit(5), F.floor(F.log2(F.greatest(n, F.lit(1)).cast("double"))).cast("int") + 1)


def _as_text(p: str) -> Column:
    return F.concat_ws("-", F.lower(F.hex(f"{p}.base")), F.col(f"{p}.level").cast("string"),
                       *(F.array_join(F.col(f"{p}.{x}").cast("array<string>"), ".") for x in ("lo", "hi")))


def likeness(a: Column, b: Column) -> Column:
    """Share of agreeing subset hashes of two fingerprints, 0 to 1; 1 for equal in-band terms."""
    def share(x, y):
        place = lambda z: F.transform(z, lambda c: F.shiftright(c, 16))
        either = F.size(F.array_union(place(x), place(y)))
        return F.struct(F.size(F.array_intersect(x, y)).alias("agree"), either.alias("either"))
    gap = a["level"] - b["level"]
    same = F.array(share(a["lo"], b["lo"]), share(a["hi"], b["hi"]))
    parts = F.when(gap == 0, same).when(gap == 1, F.array(share(a["lo"], b["hi"]))).when(gap == -1, F.array(share(a["hi"], b["lo"])))
    total = F.aggregate(parts, F.struct(F.lit(0).alias("agree"), F.lit(0).alias("either")),
                        lambda t, x: F.struct((t["agree"] + x["agree"]).alias("agree"), (t["either"] + x["either"]).alias("either")),
                        lambda t: F.when(t["either"] > 0, t["agree"] / t["either"]).otherwise(0.0))
    return F.when(a["base"] == b["base"], F.lit(1.0)).otherwise(F.coalesce(total, F.lit(0.0)))


def _first_piece(base: DataFrame, id_: int, length: int) -> str:
    """The first ``length`` characters of one document."""
    of = base.where(F.col("id") == id_)
    return of.agg(F.min(F.struct("tid", F.left("text", F.lit(length)).alias("piece"))).alias("p")).first()["p"]["piece"]


def _edited(base: DataFrame, follow: DataFrame, need: Column) -> tuple[DataFrame, Callable[[DataFrame], DataFrame]]:
    """(place, id, tid, text, edited), and what adds each row's ``next`` to a table by (place, id).  Both joins read one shuffle of the texts, by (place, id).

    The document of the null ids and the one it follows are looked up by themselves, one text each, since its rows lie spread.
    """
    wanted = follow.select(F.col("id").alias("pid"), F.col("need").alias("wanted"), "next", "next_place")
    piece = (wanted.join(base, (F.col("next_place") == F.col("place")) & (F.col("next") == F.col("id"))).groupBy("pid", "next")
             .agg(F.min(F.struct("tid", F.expr("left(text, wanted)").alias("piece"))).alias("p")).select("pid", "p.piece"))
    apart = follow.where((F.col("id") == NULL_ID) | (F.col("next") == NULL_ID)).collect()        # two rows at most
    paste, following = F.col("piece"), F.col("follower")
    for r in apart:
        paste = F.when(F.col("id") == r["id"], F.lit(_first_piece(base, r["next"], r["need"]))).otherwise(paste)
        following = F.when(F.col("id") == r["id"], F.lit(r["next"])).otherwise(following)
    rows = base.join(piece, (F.col("place") == F.col("pid")) & (F.col("id") == F.col("pid")), "left")
    rows = rows.select("place", "id", "tid", "text", need.alias("need"), paste.alias("paste"))
    rows = rows.select("place", "id", "tid", "text", F.expr("concat(left(text, char_length(text) - need), left(paste, need))").alias("edited"))
    after = follow.select(F.col("id").alias("leader"), F.col("next").alias("follower"))
    return rows, lambda t: t.join(after, (F.col("place") == F.col("leader")) & (F.col("id") == F.col("leader")), "left").withColumn("next", following)


def _subset_hashes(terms: Column, mask: Column) -> Column:
    """One number per subset that holds a term: the subset's place and 16 bits of the hash of its sorted terms."""
    cells = F.array_distinct(F.transform(terms, lambda t: t.bitwiseAND(mask)))
    return F.sort_array(F.transform(cells, lambda c: (c * 65536 + F.xxhash64(F.filter(terms, lambda t: t.bitwiseAND(mask) == c))
                                                      .bitwiseAND(F.lit(0xFFFF))).cast("int")))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id_col, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    base = docs.select(id_key(id_col).alias("id"), text.alias("text")).withColumn("tid", F.xxhash64("text"))
    base = base.withColumn("place", F.when(F.col("id") == NULL_ID, F.col("tid")).otherwise(F.col("id")))
    words = F.broadcast(materialise(lexicon(base), "lexicon").withColumnRenamed("term", "in_band"))
    need = F.floor(F.char_length("text") / 4).cast("int")
    # the successor is written twice, as its place and its id: known as one column, the optimiser would filter the texts by place = id
    follow = materialise(_next_ids(base.groupBy("id").agg(F.max(need).alias("need"))).withColumn("next_place", F.col("next")), "next")
    rows, with_next = _edited(base, follow, need)

    def versions(*more):
        return F.explode(F.array(*(F.struct(F.lit(w).alias("which"), F.col(c).alias("t"), *(F.col(f"{m}{w}").alias(m) for m in more))
                                   for w, c in enumerate(("text", "edited"))))).alias("v")

    # first pass: number and hash of the terms; the empty term in each list counts the rows that repeat a text
    each = rows.select(*KEY, versions()).select(*KEY, F.col("v.which").alias("which"), F.explode(
        F.concat(_terms(F.col("v.t")), F.array(F.lit("")))).alias("t"))
    each = each.select(*KEY, "which", F.xxhash64("t").alias("term"), (F.col("t") == "").alias("mark")).join(
        words, F.col("term") == F.col("in_band"), "left")
    part = F.xxhash64(F.lit(1), "term").bitwiseAND(F.lit((1 << 40) - 1))

    def facts_of(w):
        mine = F.col("which") == w
        band = mine & F.col("in_band").isNotNull()
        return (F.count(F.when(mine & F.col("mark"), 1)).alias(f"m{w}"), F.count(F.when(band, 1)).alias(f"n{w}"),
                F.coalesce(F.sum(F.when(band, part)), F.lit(0)).alias(f"s{w}"), F.sum(F.when(mine, part)).alias(f"a{w}"))
    stats = each.groupBy(*KEY).agg(*facts_of(0), *facts_of(1))
    for w in (0, 1):
        n = F.col(f"n{w}") / F.col(f"m{w}")
        total = F.when(F.col(f"n{w}") > 0, F.col(f"s{w}")).otherwise(F.col(f"a{w}"))
        stats = stats.withColumn(f"level{w}", _level(n)).withColumn(f"base{w}", F.xxhash64(n, total / F.col(f"m{w}")))
    stats = stats.select(F.col("place").alias("splace"), F.col("id").alias("sid"), F.col("tid").alias("stid"), "level0", "level1", "base0", "base1",
                         F.expr("shiftleft(1L, level0) - 1").alias("mask0"), F.expr("shiftleft(1L, level1) - 1").alias("mask1"))
    # second pass: the in-band terms that lie in a subset of the level
    mask = F.col("mask")
    picked = (rows.join(stats.select("splace", "sid", "stid", "mask0", "mask1"), _row_key("splace", "sid", "stid"))
              .select(*KEY, versions("mask"))
              .select(*KEY, F.col("v.which").alias("which"), F.col("v.mask").alias("mask"), F.explode(_terms(F.col("v.t"))).alias("t"))
              .select(*KEY, "which", "mask", F.xxhash64("t").alias("term")).where(F.col("term").bitwiseAND(mask) < CELLS)
              .join(words, F.col("term") == F.col("in_band")))
    few = picked.groupBy(*KEY).agg(*(F.collect_set(F.when(F.col("which") == w, F.col("term"))).alias(f"set{w}") for w in (0, 1)))
    few = few.select(F.col("place").alias("fplace"), F.col("id").alias("fid"), F.col("tid").alias("ftid"),
                     *(F.sort_array(f"set{w}").alias(f"terms{w}") for w in (0, 1)))
    facts = rows.select(*KEY, F.char_length("text").cast("long").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"))
    full = (facts.join(stats, _row_key("splace", "sid", "stid"))
            .join(few, _row_key("fplace", "fid", "ftid"), "left"))
    full = with_next(full)

    def print_of(w):
        terms, mask = F.coalesce(f"terms{w}", F.array().cast("array<bigint>")), F.col(f"mask{w}")
        sparse = F.filter(terms, lambda t: t.bitwiseAND(mask * 2 + 1) < CELLS)
        return F.struct(F.col(f"base{w}").alias("base"), F.col(f"level{w}").alias("level"),
                        _subset_hashes(terms, mask).alias("lo"), _subset_hashes(sparse, mask).alias("hi"))
    full = materialise(full.select("id", "tid", "next", "n_chars", "edited_sha256", print_of(0).alias("own"), print_of(1).alias("edited")), "prints")
    after = full.groupBy(F.col("id").alias("next")).agg(F.min(F.struct("tid", "own")).alias("n")).select("next", F.col("n.own").alias("after"))
    return full.join(after, "next").select(
        key_to_id("id").alias(id_col), "n_chars", "edited_sha256", _as_text("own").alias("fingerprint"), _as_text("edited").alias("edited_fingerprint"),
        likeness(F.col("own"), F.col("edited")).alias("near_edited"), likeness(F.col("own"), F.col("after")).alias("near_next"))

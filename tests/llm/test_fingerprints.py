"""Fingerprints and their likeness against a plain version that hashes sorted terms in Python."""

import math
import random
import re
from collections import Counter

import pytest
import xxhash

from llm_tables import SMALL, odd_docs  # noqa: F401
from quire.llm.fingerprints import CELLS, LEAST_SHARE, MOST_SHARE, fingerprints

WORDS = 2 ** 64


def signed(h):
    return h - WORDS if h >= WORDS // 2 else h


def hash_text(t):
    return signed(xxhash.xxh64(t.encode(), seed=42).intdigest())


def chain(*parts):
    h = 42
    for p in parts:
        h = xxhash.xxh64(p, seed=h).intdigest()
    return signed(h)


def long_bytes(v):
    return v.to_bytes(8, "little", signed=True)


def double_bytes(v):
    import struct
    return struct.pack("<d", v)


def terms_of(text):
    return {hash_text(w) for w in re.split(r"[\x20\x09-\x0D]+", text.lower()) if w}


def print_of(text, lexicon):
    terms = terms_of(text)
    band = terms & lexicon
    part = lambda t: chain((1).to_bytes(4, "little"), long_bytes(t)) & ((1 << 40) - 1)
    level = max(5, int(math.floor(math.log2(max(len(band), 1)))) + 1)
    mask = (1 << level) - 1
    base = chain(double_bytes(float(len(band))), double_bytes(float(sum(map(part, band or terms | {hash_text('')})))))      # every list of terms ends with an empty one

    def subsets(keep):
        cells = {}
        for t in sorted(keep):
            cells.setdefault(t & mask, []).append(t)
        return sorted(c * 65536 + (chain(*map(long_bytes, ts)) & 0xFFFF) for c, ts in cells.items() if c < CELLS)
    lo = subsets(band)
    hi = subsets(t for t in band if t & (2 * mask + 1) < CELLS)
    return base, level, lo, hi


def as_text(p):
    base, level, lo, hi = p
    return "-".join([f"{base % WORDS:x}", str(level), ".".join(map(str, lo)), ".".join(map(str, hi))])


def like(a, b):
    if a[0] == b[0]:
        return 1.0
    pairs = {0: [(a[2], b[2]), (a[3], b[3])], 1: [(a[2], b[3])], -1: [(a[3], b[2])]}.get(a[1] - b[1], [])
    agree = sum(len(set(x) & set(y)) for x, y in pairs)
    either = sum(len({c >> 16 for c in x} | {c >> 16 for c in y}) for x, y in pairs)
    return agree / either if either else 0.0


def brute(rows):
    """Rows (doc_id, text) -> Counter of the operator's rows; of rows that share an id the least text hash stands for it."""
    rows = [(d, t or "") for d, t in rows]
    df = Counter(t for _, text in rows for t in terms_of(text))
    n = len(rows)
    lexicon = {t for t, c in df.items() if LEAST_SHARE * n <= c <= max(1.0, MOST_SHARE * n)}
    order = sorted({d for d, _ in rows}, key=lambda d: (d is not None, d or 0))
    first = {d: min((t for e, t in rows if e == d), key=hash_text) for d in order}
    out = Counter()
    for d, text in rows:
        after = first[order[(order.index(d) + 1) % len(order)]]
        k = len(text) // 4
        mine, edit, nxt = (print_of(x, lexicon) for x in (text, text[:len(text) - k] + after[:k], after))
        out[(d, len(text), as_text(mine), as_text(edit), round(like(mine, edit), 9), round(like(mine, nxt), 9))] += 1
    return out


def got(df):
    return Counter((r["doc_id"], r["n_chars"], r["fingerprint"], r["edited_fingerprint"], round(r["near_edited"], 9), round(r["near_next"], 9))
                   for r in fingerprints(df).collect())


def test_against_plain_version(spark, odd_docs):
    small = spark.read.parquet(f"{SMALL}/documents.parquet")
    for df in (small, odd_docs):
        assert got(df) == brute([(r["doc_id"], r["text"]) for r in df.collect()])


@pytest.mark.parametrize("ids", ["a third null", "all null", "one document", "one null document"])
def test_null_ids(spark, ids):
    rng = random.Random(5)
    text = lambda: " ".join(rng.choice("abcdefghijklmnopqrstuvwxyz") + str(rng.randrange(40)) for _ in range(rng.randrange(60)))
    rows = [(None if ids == "all null" or i % 3 == 0 else i, text()) for i in range(240)]
    rows = {"one document": [(7, "one two three four")], "one null document": [(None, "one two three four")]}.get(ids, rows + rows[:30])
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert got(df) == brute(rows)

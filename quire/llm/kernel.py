"""Vectorised word and shingle hashing of Arrow text batches.

Spark partitions and shuffles; these functions run inside its tasks over one
Arrow batch and never see more than one slice of it (or one long text).
Words are the maximal runs of bytes other than 0x20 and 0x09-0x0D.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U64 = np.uint64
_M1, _M2 = U64(0xFF51AFD7ED558CCD), U64(0xC4CEB9FE1A85EC53)
_BASE = 0x9E3779B97F4A7C15 | 1
_BASE_INV = pow(_BASE, -1, 1 << 64)
_SHINGLE = U64(0xD6E8FEB86659FD93)

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32

#: slices of a batch that are hashed at a time, in bytes of text
SLICE_BYTES = 1 << 20


def mix64(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser."""
    x = x ^ (x >> U64(33))
    x *= _M1
    x ^= x >> U64(33)
    x *= _M2
    x ^= x >> U64(33)
    return x


_BYTE_CODE = mix64(np.arange(1, 257, dtype=U64) * U64(0x2545F4914F6CDD1D))
_powers: list[np.ndarray] = [np.ones(1, U64), np.ones(1, U64)]


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) < n:
        size = 1 << max(16, (n - 1).bit_length())
        for slot, base in ((0, _BASE), (1, _BASE_INV)):
            steps = np.full(size, base, U64)
            steps[0] = 1
            _powers[slot] = np.cumprod(steps, dtype=U64)
    return _powers[0], _powers[1]


def text_slices(column: pa.Array, max_bytes: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) of consecutive rows with about ``max_bytes`` of UTF-8 (null: empty)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary()).fill_null(b"")
    n = len(column)
    if n == 0:
        return
    _, off, data = column.buffers()
    offsets = np.frombuffer(off, dtype=np.int64)[column.offset:column.offset + n + 1]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    a = 0
    while a < n:
        b = int(np.searchsorted(offsets, offsets[a] + max_bytes, side="right")) - 1
        b = min(n, max(a + 1, b))
        yield a, b, raw[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a]
        a = b


def word_spans(buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte starts and ends of all words, and the first word index of each row (one more at the end)."""
    word = ~_SPACE[buf]
    n = len(buf)
    start, end = word.copy(), np.empty(n, bool)
    if n:
        start[1:] &= ~word[:-1]
        end[:-1] = word[:-1] & ~word[1:]
        end[-1] = word[-1]
        inner = offsets[1:-1]
        inner = inner[(inner > 0) & (inner < n)]
        start[inner] = word[inner]
        end[inner - 1] = word[inner - 1]
    starts, ends = np.flatnonzero(start), np.flatnonzero(end) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def word_hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool) -> np.ndarray:
    """64-bit hash of each word: a polynomial over its bytes, independent of its place, then mixed."""
    out = np.empty(len(starts), U64)
    a = 0
    while a < len(starts):
        base = starts[a]
        b = max(a + 1, int(np.searchsorted(ends, base + SLICE_BYTES, side="right")))
        part = buf[base:ends[b - 1]]
        power, inverse = _power_tables(len(part) + 1)
        codes = _BYTE_CODE[_LOWER[part] if lower else part]
        codes *= power[:len(part)]
        total = np.zeros(len(part) + 1, U64)
        np.cumsum(codes, out=total[1:])
        s, e = starts[a:b] - base, ends[a:b] - base
        out[a:b] = mix64((total[e] - total[s]) * inverse[s] + (e - s).astype(U64) * _M2)
        a = b
    return out


def run_hashes(words: np.ndarray, n: int, factor: np.uint64 = _SHINGLE) -> np.ndarray:
    """Hash of each run of ``n`` consecutive words (ends of rows are not looked at)."""
    m = len(words) - n + 1
    if m <= 0:
        return np.zeros(0, U64)
    total = words[:m].copy()
    for j in range(1, n):
        total *= factor
        total += words[j:j + m]
    return mix64(total + U64(n))


def shingles_of(words: np.ndarray, n: int = 5) -> np.ndarray:
    """Sorted distinct ``n``-word shingles of one text; fewer words: the whole sequence as one; none: empty."""
    if len(words) == 0:
        return np.zeros(0, U64)
    return np.unique(run_hashes(words, min(n, len(words))))


def shingle_sets(column: pa.Array, n: int = 5, lower: bool = True) -> Iterator[tuple[int, np.ndarray]]:
    """(row, sorted distinct shingles) of each row of a text column."""
    for a, b, buf, offsets in text_slices(column):
        starts, ends, first = word_spans(buf, offsets)
        words = word_hashes(buf, starts, ends, lower)
        runs = run_hashes(words, n)
        for row in range(a, b):
            lo, hi = int(first[row - a]), int(first[row - a + 1])
            if hi - lo >= n:
                yield row, np.unique(runs[lo:hi - n + 1])
            else:
                yield row, shingles_of(words[lo:hi], n)


def circulant_signature(shingles: np.ndarray, k: int, seed: int = 1) -> np.ndarray:
    """Circulant MinHash: ``k`` coordinates from two permutations of a ring of 2**32 places.

    The first permutation (sigma) spreads the shingles over the ring; the
    second (pi) is one fixed bijection of the ring, read at places shifted by
    0, 1, ..., k - 1 (mod 2**32): coordinate j is min over x of pi(sigma(x) + j).
    """
    place = (mix64(shingles ^ U64(seed * 0x5851F42D4C957F2D & (1 << 64) - 1)) >> U64(32)).astype(np.uint32)
    shift = np.arange(k, dtype=np.uint32)[:, None]
    best = np.full(k, 0xFFFFFFFF, np.uint32)
    for a in range(0, len(place), 1024):
        v = place[None, a:a + 1024] + shift
        t = v >> np.uint32(16)
        v ^= t
        v *= np.uint32(0x7FEB352D)
        np.right_shift(v, np.uint32(15), out=t)
        v ^= t
        v *= np.uint32(0x846CA68B)
        np.right_shift(v, np.uint32(16), out=t)
        v ^= t
        np.minimum(best, v.min(axis=1), out=best)
    return best

"""Vectorised text helpers for Arrow batches: words, word hashes and rolling word windows.

A batch is one byte buffer with document offsets, as Arrow keeps a string column.
Everything here is numpy over that buffer; no per-word Python objects are made.
Words are maximal runs of bytes other than 0x20 and 0x09-0x0D.  That equals splitting
the code points, as UTF-8 continuation bytes are all above 0x7F.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash

U64 = np.uint64
_rng = np.random.default_rng(20240607)
#: Random odd multipliers and byte values: fixed by the seed, alike in every process.
_BYTE = _rng.integers(1, 2**64 - 1, 256, dtype=U64)
_BYTE_LOWER = _BYTE.copy()
_BYTE_LOWER[65:91] = _BYTE[97:123]
_BASE = 0x9E3779B97F4A7C15 | 1
_BASE_INV = pow(_BASE, -1, 2**64)
#: Bytes hashed at once; bounds the working memory whatever the text's length (some 32 bytes each, and 16 kept in a worker).
_SEGMENT = 1 << 17
#: Longest word in bytes that is hashed by prefix sums.
LONG = 40
_powers: dict[int, np.ndarray] = {}


def _power(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64, kept for the usual segment length."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        steps = np.full(max(n, _SEGMENT + 1), base, dtype=U64)
        steps[0] = 1
        have = np.cumprod(steps, dtype=U64)
        if n <= 4 * _SEGMENT:
            _powers[base] = have
    return have[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser, so that every output bit depends on every input bit."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U64(27))
    x = x * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def buffer_of(col) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and document offsets (one more than documents) of a string column; null counts as empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type):
        kind, off_type = col.type, np.int64
    else:
        kind, off_type = col.type, np.int32
    if len(col) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    if col.null_count:
        col = col.fill_null("" if "string" in str(kind) else b"")
    _, offs, data = col.buffers()
    offsets = np.frombuffer(offs, off_type, len(col) + 1, col.offset * np.dtype(off_type).itemsize).astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0]:offsets[-1]], offsets - offsets[0]


def word_spans(buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte of every word, and per document the index of its first word (one more than documents)."""
    n = len(buf)
    if n == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    solid = ~((buf == 32) | ((buf >= 9) & (buf <= 13)))
    before = np.empty(n, bool)
    before[0] = False
    before[1:] = solid[:-1]
    cut = offsets[:-1][offsets[:-1] < n]
    before[cut] = False
    starts = np.flatnonzero(solid & ~before)
    after = np.empty(n, bool)
    after[-1] = False
    after[:-1] = solid[1:]
    after[cut[cut > 0] - 1] = False
    ends = np.flatnonzero(solid & ~after) + 1
    return starts, ends, np.searchsorted(starts, offsets, side="left")


def word_hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool = False) -> np.ndarray:
    """A 64-bit hash of each word's bytes (A-Z folded if lower).

    Words of up to LONG bytes are hashed as polynomials modulo 2^64, all at once by prefix sums over bounded segments;
    there the low bits that texts built to collide can cancel are few.  Longer words, for which such a polynomial can be
    made to vanish, are hashed one by one with XXH3."""
    out = np.empty(len(starts), U64)
    table = _BYTE_LOWER if lower else _BYTE
    i = 0
    while i < len(starts):
        j = max(i + 1, int(np.searchsorted(ends, starts[i] + _SEGMENT, side="right")))
        lo, hi = int(starts[i]), int(ends[j - 1])
        sums = np.zeros(hi - lo + 1, U64)
        np.cumsum(table[buf[lo:hi]] * _power(_BASE, hi - lo), out=sums[1:])
        s, e = starts[i:j] - lo, ends[i:j] - lo
        h = (sums[e] - sums[s]) * _power(_BASE_INV, hi - lo + 1)[s]
        out[i:j] = mix(h + (e - s).astype(U64))
        i = j
    for n in np.flatnonzero(ends - starts > LONG):
        word = buf[starts[n]:ends[n]].tobytes()
        out[n] = xxhash.xxh3_64_intdigest(word.lower() if lower else word, seed=LONG)
    return out


def rolling(values: np.ndarray, k: int, seed: int) -> np.ndarray:
    """A hash of every k consecutive values, as if all stood in one document; see inside()."""
    n = len(values) - k + 1
    if n <= 0:
        return np.zeros(0, U64)
    base = U64((_BASE * (2 * seed + 3)) & (2**64 - 1) | 1)
    acc = np.zeros(n, U64)
    for j in range(k):
        acc *= base
        acc += values[j:j + n]
    return mix(acc ^ U64(seed * 0x2545F4914F6CDD1D & (2**64 - 1)))


def inside(first: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions where a window of k words fits in one document, and the document of each.

    first: per document the index of its first word, one more than documents."""
    counts = np.maximum(np.diff(first) - k + 1, 0)
    doc = np.repeat(np.arange(len(counts)), counts)
    total = int(counts.sum())
    at = np.arange(total) - np.repeat(np.cumsum(counts) - counts, counts) + first[:-1][doc]
    return at, doc

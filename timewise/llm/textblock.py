"""Vectorised helpers over blocks of whole texts (used inside Arrow tasks).

A block is a run of consecutive texts laid out in one byte array.  Words are
maximal runs of bytes other than space and 0x09-0x0D; UTF-8 continuation
bytes never fall in that class, so bytes and code points agree on the cuts.
All hashes are 64-bit with wrap-around arithmetic; equality of hashes that
decides a result is verified by the callers where a collision could matter.
"""
from __future__ import annotations

import numpy as np
import pyarrow as pa

_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_INV = np.uint64(pow(int(_BASE), -1, 1 << 64))
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_pow: dict[str, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (bijective)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i for i in 0..n (odd base, so invertible)."""
    if len(_pow.get("b", ())) <= n:
        m = 1 << max(16, int(n).bit_length())
        b, v = np.ones(m, np.uint64), np.ones(m, np.uint64)
        b[1:] = _BASE
        v[1:] = _INV
        _pow["b"], _pow["v"] = np.cumprod(b, dtype=np.uint64), np.cumprod(v, dtype=np.uint64)
    return _pow["b"][:n + 1], _pow["v"][:n + 1]


def prefix_hash(data: np.ndarray) -> np.ndarray:
    """P with P[i] = sum of (byte+1) * base**j over j < i."""
    b, _ = powers(len(data))
    out = np.empty(len(data) + 1, np.uint64)
    out[0] = 0
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * b[:-1], out=out[1:])
    return out


def span_hash(p: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Polynomial hash of each span, the same wherever the span stands."""
    _, v = powers(len(p) - 1)
    return (p[end] - p[start]) * v[start]


def release() -> None:
    """Hand freed memory back: a worker outlives its task, and what it keeps
    is missing to the others of its executor."""
    import ctypes
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):      # not glibc
        pass


def lean(run, rows: int = 2000):
    """A batch function that gets its batches in slices of ``rows`` rows, so
    that what it builds for one stays small, and cleans up behind itself."""
    def wrapped(batches):
        def slices():
            for b in batches:
                for i in range(0, b.num_rows, rows):
                    yield b.slice(i, rows)
        try:
            yield from run(slices())
        finally:
            release()
    return wrapped


def lean_group(run):
    """The same for a function of one whole group."""
    def wrapped(table):
        try:
            return run(table)
        finally:
            release()
    return wrapped


def lean_pair(run):
    """The same for a function of two groups of one key."""
    def wrapped(left, right):
        try:
            return run(left, right)
        finally:
            release()
    return wrapped


def blocks(texts: pa.Array, limit: int = 1 << 19):
    """Yield (first row, bytes, offsets) for runs of rows of about ``limit``
    bytes; a longer single text is a block of its own."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    n = len(texts)
    if n == 0:
        return
    if not pa.types.is_large_string(texts.type):
        texts = texts.cast(pa.large_string())
    bufs = texts.buffers()
    offs = np.frombuffer(bufs[1], np.int64, n + 1, texts.offset * 8)
    data = np.frombuffer(bufs[2], np.uint8) if bufs[2] is not None and bufs[2].size else np.empty(0, np.uint8)
    i = 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(offs, offs[i] + limit, "right")) - 1)
        j = min(j, n)
        yield i, data[offs[i]:offs[j]], offs[i:j + 1] - offs[i]
        i = j


def word_spans(data: np.ndarray, offs: np.ndarray):
    """(start, end, row) of every word of a block."""
    n = len(data)
    if n == 0:
        z = np.empty(0, np.int64)
        return z, z, z
    ink = np.empty(n + 2, bool)
    ink[0] = ink[-1] = False
    np.logical_not(SPACE[data], out=ink[1:-1])
    edge = ink[1:] != ink[:-1]          # edge[i]: a word starts or ends before byte i
    inner = offs[1:-1]
    inner = inner[(inner > 0) & (inner < n)]
    cut = inner[ink[inner] & ink[inner + 1]]   # a word cut by a text boundary
    at = np.flatnonzero(edge)
    if len(cut):
        cut = np.unique(cut)
        at = np.sort(np.concatenate([at, cut, cut]), kind="stable")
    start, end = at[0::2], at[1::2]
    row = np.searchsorted(offs, start, "right") - 1
    return start, end, row


def shingle_hashes(data: np.ndarray, offs: np.ndarray, k: int = 5):
    """Hashes of the k-word shingles of each row of a block, in order, and
    the row of each; A-Z are lower-cased first.  A row with 1..k-1 words has
    its whole word sequence as one shingle, a row without words none."""
    low = LOWER[data]
    start, end, row = word_spans(low, offs)
    if len(start) == 0:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    w = mix(span_hash(prefix_hash(low), start, end) + (end - start).astype(np.uint64))
    mult = np.uint64(0xD6E8FEB86659FD93)
    n = len(w)
    h, r = np.empty(0, np.uint64), np.empty(0, np.int64)
    if n >= k:
        ok = row[k - 1:] == row[:n - k + 1]
        first = np.flatnonzero(ok)
        h = w[first]
        for j in range(1, k):
            h = mix(h * mult + w[first + j])
        r = row[first]
    counts = np.bincount(row, minlength=len(offs) - 1)
    short = np.flatnonzero((counts > 0) & (counts < k))
    if len(short):
        at = np.concatenate([[0], np.cumsum(counts)])[short]
        hs = w[at].copy()
        for j in range(1, k - 1):
            more = counts[short] > j
            hs[more] = mix(hs[more] * mult + w[at[more] + j])
        hs = mix(hs ^ (counts[short].astype(np.uint64) * mult))
        h, r = np.concatenate([h, hs]), np.concatenate([r, short])
        order = np.argsort(r, kind="stable")
        h, r = h[order], r[order]
    return h, r


def shingle_sets(data: np.ndarray, offs: np.ndarray, k: int = 5) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each row of a block."""
    h, r = shingle_hashes(data, offs, k)
    cut = np.searchsorted(r, np.arange(len(offs)))
    out = []
    for a, b in zip(cut[:-1], cut[1:]):
        s = np.sort(h[a:b])
        if len(s) > 1:
            keep = np.empty(len(s), bool)
            keep[0] = True
            np.not_equal(s[1:], s[:-1], out=keep[1:])
            s = s[keep]
        out.append(s)
    return out

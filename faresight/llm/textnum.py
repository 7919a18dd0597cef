"""Vectorised helpers on UTF-8 text inside Arrow tasks (numpy only)."""

from __future__ import annotations

import ctypes

import numpy as np
import pyarrow as pa

U64 = np.uint64
_rng = np.random.default_rng(20240607)
_BYTE = _rng.integers(1, 2**63, 256, dtype=np.uint64) | U64(1)
_COMBINE = _rng.integers(1, 2**63, 64, dtype=np.uint64) | U64(1)
_BASE = 0x9E3779B97F4A7C15
_IBASE = pow(_BASE, -1, 2**64)
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
SEPARATOR = np.zeros(256, dtype=bool)
SEPARATOR[[0x20, 9, 10, 11, 12, 13]] = True
BLOCK = 1 << 19
_powers = [np.ones(1, dtype=np.uint64), np.ones(1, dtype=np.uint64)]


def release() -> None:
    """Give freed memory of this worker back to the system; workers outlive their tasks."""
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):
        pass        # another C library: nothing to do


_caches: dict = {}


def keeps(module: str, clear) -> None:
    """Note what a module's tasks keep in a worker between them, and how to drop it."""
    _caches[module] = clear


def only(module: str) -> None:
    """Drop what other modules keep: a worker that goes on with another operator needs it no more."""
    for name, clear in _caches.items():
        if name != module:
            clear()
    release()


def tidy(run):
    """An Arrow task that drops other operators' caches and releases its memory when it ends."""
    def task(batches):
        only(run.__module__)
        try:
            yield from run(batches)
        finally:
            release()
    return task


def mix(x: np.ndarray) -> np.ndarray:
    """64-bit finaliser (a bijection that spreads every input bit)."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE**i and BASE**-i modulo 2**64 for i < n."""
    if len(_powers[0]) < n:
        m = max(n, BLOCK + 1)
        for k, b in enumerate((_BASE, _IBASE)):
            f = np.full(m, b, dtype=np.uint64)
            f[0] = 1
            _powers[k] = np.cumprod(f, dtype=np.uint64)
    return _powers[0][:n], _powers[1][:n]


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string or binary column (null counts as empty)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    kind = pa.large_binary()
    if pa.types.is_string(column.type) or pa.types.is_large_string(column.type):
        column = column.cast(pa.large_string())
    column = column.cast(kind)
    if column.null_count:
        column = column.fill_null(b"")
    _, off, data = column.buffers()
    offsets = np.frombuffer(off, dtype=np.int64)[column.offset:column.offset + len(column) + 1]
    return np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8), offsets


def groups(offsets: np.ndarray, limit: int = BLOCK):
    """Consecutive document ranges of at most ``limit`` bytes (one document at least)."""
    d, n = 0, len(offsets) - 1
    while d < n:
        e = int(np.searchsorted(offsets, offsets[d] + limit, side="right")) - 1
        e = min(max(e, d + 1), n)
        yield d, e
        d = e


def words(data: np.ndarray, offsets: np.ndarray, lower: bool = True):
    """(start, end, 64-bit hash) of every word ``[^\\x20\\x09-\\x0D]+`` of the documents
    ``offsets[d]..offsets[d + 1]``, and the words' offsets by document."""
    a = data[offsets[0]:offsets[-1]]
    bounds = offsets - offsets[0]
    n = len(a)
    if n == 0:
        z = np.zeros(0, np.int64)
        return z, z, np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64)
    sep = SEPARATOR[a]
    first = np.empty(n, bool)
    first[0] = True
    first[1:] = sep[:-1]
    last = np.empty(n, bool)
    last[-1] = True
    last[:-1] = sep[1:]
    inner = bounds[(bounds > 0) & (bounds < n)]
    first[inner] = True
    last[inner - 1] = True
    word = ~sep
    start = np.flatnonzero(word & first)
    end = np.flatnonzero(word & last) + 1
    out = np.empty(len(start), np.uint64)
    w = 0
    while w < len(start):  # blocks that end between words keep the powers' table small
        e = int(np.searchsorted(end, start[w] + BLOCK, side="right"))
        e = max(e, w + 1)
        lo, hi = int(start[w]), int(end[e - 1])
        b = a[lo:hi]
        if lower:
            b = LOWER[b]
        p, ip = powers(hi - lo)
        c = np.zeros(hi - lo + 1, np.uint64)
        np.cumsum(_BYTE[b] * p, out=c[1:])
        out[w:e] = (c[end[w:e] - lo] - c[start[w:e] - lo]) * ip[start[w:e] - lo]
        w = e
    return start + offsets[0], end + offsets[0], mix(out), np.searchsorted(start, bounds)


def sequence_hash(h: np.ndarray, k: int) -> np.ndarray:
    """Hash of every k consecutive word hashes."""
    n = len(h) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    s = np.full(n, k, dtype=np.uint64)
    for j in range(k):
        s += h[j:j + n] * _COMBINE[j]
    return mix(s)


def shingle_sets(h: np.ndarray, offsets: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct k-word shingle hashes by document, and their offsets. A document of
    fewer words has its whole sequence as one shingle, one without words none."""
    every = sequence_hash(h, k)
    parts, sizes = [], np.zeros(len(offsets), np.int64)
    for d in range(len(offsets) - 1):
        lo, hi = int(offsets[d]), int(offsets[d + 1])
        m = hi - lo
        if m >= k:
            s = np.sort(every[lo:hi - k + 1])
            keep = np.empty(len(s), bool)
            keep[0] = True
            np.not_equal(s[1:], s[:-1], out=keep[1:])
            s = s[keep]
        elif m:
            s = sequence_hash(h[lo:hi], m)
        else:
            continue
        parts.append(s)
        sizes[d + 1] = len(s)
    return (np.concatenate(parts) if parts else np.zeros(0, np.uint64)), np.cumsum(sizes)


def binaries(values: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """Binary column of the bytes of ``values[offsets[d]:offsets[d + 1]]``."""
    off = pa.py_buffer((np.asarray(offsets, np.int64) * values.dtype.itemsize).tobytes())
    return pa.Array.from_buffers(pa.large_binary(), len(offsets) - 1, [None, off, pa.py_buffer(np.ascontiguousarray(values).tobytes())]).cast(pa.binary())

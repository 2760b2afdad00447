"""Vectorised text kernels over UTF-8 buffers (numpy, executor side).

A *chunk* is several documents laid end to end in one ``uint8`` buffer with an
``int64`` offset array.  Hashes are polynomial rolling hashes modulo 2**64 over
random 64-bit symbol values, finished by an invertible mixer, so the hash of
any window costs two prefix-sum look-ups.
"""

from __future__ import annotations

import ctypes
import sys
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa

U64 = np.uint64
_BASES = {"byte": 0x9E3779B97F4A7C15, "word": 0xC2B2AE3D27D4EB4F, "byte check": 0xD6E8FEB86659FD93, "word check": 0xA3EC647659359ACD}
_cache: dict = {}


def powers(kind: str, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64, at least n of each."""
    have = _cache.get(kind)
    if have is None or len(have[0]) < n:
        size = max(n, 1 << 16)
        base = _BASES[kind]
        out = []
        for b in (base, pow(base, -1, 1 << 64)):
            p = np.full(size, b, dtype=U64)
            p[0] = 1
            out.append(np.multiply.accumulate(p))
        have = _cache[kind] = tuple(out)
    return have


def byte_values(kind: str = "byte") -> np.ndarray:
    """256 fixed random odd 64-bit symbol values."""
    if ("values", kind) not in _cache:
        x = mix(np.arange(1, 257, dtype=U64) * U64(0xD1342543DE82EF95) + U64(_BASES[kind] if kind != "byte" else 0))
        _cache["values", kind] = x | U64(1)
    return _cache["values", kind]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (xor-shift and multiply)."""
    x = x ^ (x >> U64(30))
    x *= U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


def prefix(values: np.ndarray, kind: str) -> np.ndarray:
    """Prefix sums of values[i] * base**i; entry i covers the first i values."""
    out = np.zeros(len(values) + 1, dtype=U64)
    np.cumsum(values * powers(kind, len(values))[0][: len(values)], out=out[1:])
    return out


def rolling(pre: np.ndarray, length: int, kind: str) -> np.ndarray:
    """Mixed hash of every window of ``length`` symbols, from prefix sums."""
    n = len(pre) - 1 - length + 1
    if n <= 0:
        return np.zeros(0, dtype=U64)
    return mix((pre[length:] - pre[:n]) * powers(kind, n)[1][:n])


def windows_hash(pre: np.ndarray, starts: np.ndarray, length: int, kind: str) -> np.ndarray:
    """rolling() at some starts only."""
    if not len(starts):
        return np.zeros(0, dtype=U64)
    return mix((pre[starts + length] - pre[starts]) * powers(kind, len(pre))[1][starts])


def spans_hash(pre: np.ndarray, starts: np.ndarray, ends: np.ndarray, kind: str) -> np.ndarray:
    """Mixed hash of each [start, end) span, from prefix sums; length counts."""
    if not len(starts):
        return np.zeros(0, dtype=U64)
    inv = powers(kind, len(pre))[1]
    return mix((pre[ends] - pre[starts]) * inv[starts] + (ends - starts).astype(U64) * U64(0xA0761D6478BD642F))


def arrow_buffer(column) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of an Arrow string or binary array; a null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = pa.concat_arrays(column.chunks) if column.num_chunks != 1 else column.chunk(0)
    if column.null_count:
        column = column.fill_null("" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"")
    column = column.cast(pa.large_binary())
    off = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    raw = column.buffers()[2]
    data = np.frombuffer(raw, dtype=np.uint8) if raw is not None and raw.size else np.zeros(0, np.uint8)
    return data[off[0] : off[-1]] if len(off) else data, off - (off[0] if len(off) else 0)


def give_back() -> None:
    """Returns memory that Arrow and the C library keep for later to the system."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None) if sys.platform == "linux" else None
    if trim:
        trim(0)


def tidy(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """run, giving memory back before each batch and at its end: Python workers live on
    between tasks, and what one keeps adds to all that its executor takes."""

    def fed(batches: Iterator) -> Iterator:
        for batch in batches:
            yield batch
            del batch
            give_back()

    def tidied(batches: Iterator) -> Iterator:
        yield from run(fed(batches))
        give_back()

    return tidied


def chunks(off: np.ndarray, size: int = 1 << 20):
    """(first, last) document ranges of about ``size`` bytes each."""
    first, n = 0, len(off) - 1
    while first < n:
        last = max(first + 1, int(np.searchsorted(off, off[first] + size, side="right")) - 1)
        yield first, min(last, n)
        first = last


#: space and the ASCII control blanks 0x09-0x0D
BLANK = np.zeros(256, dtype=bool)
BLANK[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20


def word_spans(buf: np.ndarray, off: np.ndarray, gap: np.ndarray = BLANK) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of words, and for each document its first word's index
    (one more entry at the end).  Words never cross documents."""
    inside = ~gap[buf]
    start = inside.copy()
    start[1:] &= ~inside[:-1]
    end = inside.copy()
    end[:-1] &= ~inside[1:]
    cut = off[:-1][off[:-1] < off[1:]]
    start[cut] |= inside[cut]
    last = off[1:][off[:-1] < off[1:]] - 1
    end[last] |= inside[last]
    starts = np.flatnonzero(start)
    ends = np.flatnonzero(end) + 1
    return starts, ends, np.searchsorted(starts, off)


def word_hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, kind: str = "byte") -> np.ndarray:
    """A 64-bit hash of each word's bytes."""
    return spans_hash(prefix(byte_values(kind)[buf], kind), starts, ends, kind)


def sliding(values: np.ndarray, width: int, op=np.minimum) -> np.ndarray:
    """op over every window of ``width`` values, by doubling."""
    out, have = values, 1
    while have * 2 <= width:
        out = op(out[:-have], out[have:])
        have *= 2
    if have < width:
        out = op(out[: len(out) - (width - have)], out[width - have :])
    return out


def inside(n: int, off: np.ndarray, length: int) -> np.ndarray:
    """For each of n - length + 1 window starts: lies the window in one document?"""
    m = n - length + 1
    if m <= 0:
        return np.zeros(0, dtype=bool)
    edge = np.zeros(n + 1, dtype=np.int8)
    for a, b in ((off[:-1], off[1:] - length + 1),):
        keep = b > a
        np.add.at(edge, a[keep], 1)
        np.add.at(edge, b[keep], -1)
    return np.cumsum(edge[:m], dtype=np.int8) > 0


def cover(starts: np.ndarray, length: int, n: int) -> np.ndarray:
    """Which of n positions lie in [s, s + length) for a start s (bool mask of
    starts, shorter than or as long as n)."""
    edge = np.zeros(n + length + 1, dtype=np.int32)
    at = np.flatnonzero(starts)
    edge[at] += 1
    edge[at + length] -= 1
    return np.cumsum(edge[:n]) > 0


def runs(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of maximal runs of True."""
    edge = np.diff(np.concatenate(([0], mask.view(np.int8), [0])))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)

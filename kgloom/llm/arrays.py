"""Text columns as numpy arrays: bytes, words, rolling hashes, packed sets.

All helpers work on one bounded Arrow table (a bucket of documents), inside a
Spark task.
"""

from __future__ import annotations

import ctypes
import sys

import numpy as np
import pyarrow as pa

U64 = np.uint64

#: Whitespace of the word rule ``[^\x20\x09-\x0D]+``.
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 9, 10, 11, 12, 13]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

_rng = np.random.Generator(np.random.PCG64(20240117))
_BYTE = _rng.integers(1, 2**63, 256, dtype=np.uint64) * U64(2) + U64(1)
_BASE = {0: 0x9E3779B97F4A7C15, 1: 0xD1342543DE82EF95}
_powers: dict[tuple[int, bool], np.ndarray] = {}


def steady_memory() -> None:
    """Let arrays of over 1 MB go back to the system when they are freed.

    By default glibc keeps freed arrays of up to 32 MB in the process, so a worker
    that is reused holds the most that any of its tasks needed.
    """
    if sys.platform == "linux":
        mallopt = getattr(ctypes.CDLL(None), "mallopt", None)
        if mallopt is not None:
            mallopt(-3, 1 << 20)  # M_MMAP_THRESHOLD


def _power(which: int, inverse: bool, n: int) -> np.ndarray:
    """base**i (or its inverse) for i < n, modulo 2**64."""
    have = _powers.get((which, inverse))
    if have is None or len(have) < n:
        base = pow(_BASE[which], -1, 2**64) if inverse else _BASE[which]
        steps = np.full(max(n, 1 << 16), base, U64)
        steps[0] = 1
        have = np.multiply.accumulate(steps)
        if n <= 1 << 23:
            _powers[which, inverse] = have
    return have[:n]


CHUNK = 1 << 15


def mix(h: np.ndarray, seed: int = 0) -> np.ndarray:
    """A bijective scrambling of 64-bit values, in chunks that stay in the cache."""
    out = np.empty(len(h), U64)
    add = U64((0x9E3779B97F4A7C15 * (seed + 1)) % 2**64)
    for a in range(0, len(h), CHUNK):
        x = h[a : a + CHUNK] + add
        x ^= x >> U64(30)
        x *= U64(0xBF58476D1CE4E5B9)
        x ^= x >> U64(27)
        x *= U64(0x94D049BB133111EB)
        out[a : a + CHUNK] = x ^ (x >> U64(31))
    return out


def rolling(data: np.ndarray, size: int) -> np.ndarray:
    """Hash of every `size` bytes in a row, by its first byte, as span_hash gives it."""
    n = len(data) - size + 1
    out = np.empty(max(0, n), U64)
    for a in range(0, n, CHUNK):
        b = min(n, a + CHUNK)
        pre = prefix(_BYTE[data[a : b + size - 1]], 0)
        out[a:b] = mix((pre[size:] - pre[:-size]) * _power(0, True, b - a))
    return out


def prefix(values: np.ndarray, which: int) -> np.ndarray:
    out = np.zeros(len(values) + 1, U64)
    np.cumsum(values * _power(which, False, len(values)), out=out[1:])
    return out


def span_hash(pre: np.ndarray, starts: np.ndarray, ends: np.ndarray, which: int) -> np.ndarray:
    """Hashes of values[start:end], equal for equal content at any place."""
    inv = _power(which, True, len(pre))
    return mix((pre[ends] - pre[starts]) * inv[starts])


def word_hash(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int = 0) -> np.ndarray:
    """Hashes of the disjoint, ascending spans data[start:end].

    The sum of a scrambled value for each (place in the span, byte): no pattern of
    bytes makes two different spans cancel, as powers of one base modulo 2**64 do.
    """
    sums, carry = np.zeros(len(data) + 1, U64), U64(0)
    begin = np.zeros(len(data), np.int64)
    begin[starts] = starts
    np.maximum.accumulate(begin, out=begin)
    for a in range(0, len(data), CHUNK):
        b = min(len(data), a + CHUNK)
        place = (np.arange(a, b) - begin[a:b]).astype(U64)
        np.cumsum(mix((place << U64(8)) | data[a:b], 5 + seed), out=sums[a + 1 : b + 1])
        sums[a + 1 : b + 1] += carry
        carry = sums[b]
    return mix(sums[ends] - sums[starts] + (ends - starts).astype(U64), seed)


def text_bytes(column) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column laid end to end and the offsets; a null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if isinstance(column, pa.ChunkedArray):
        column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], pa.large_string())
    column = column.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(column.buffers()[1], np.int64, len(column) + 1 + column.offset)[column.offset :] if len(column) else np.zeros(1, np.int64)
    if len(column) == 0 or column.buffers()[2] is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    data = np.frombuffer(column.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


class Words:
    """The words of a column of texts: places, documents and hashes."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, lower: bool = False):
        if lower:
            data = _LOWER[data]
        space = _SPACE[data]
        edge = np.zeros(len(data) + 1, bool)
        edge[offsets] = True
        before = np.ones(len(data), bool)
        before[1:] = space[:-1]
        after = np.ones(len(data), bool)
        after[:-1] = space[1:]
        self.starts = np.flatnonzero(~space & (before | edge[:-1]))
        self.ends = np.flatnonzero(~space & (after | edge[1:])) + 1
        #: first word of each document, and one past the last
        self.first = np.searchsorted(self.starts, offsets)
        self.n = np.diff(self.first)
        self.doc = np.repeat(np.arange(len(offsets) - 1), self.n)
        self.data = data
        self.hash = word_hash(data, self.starts, self.ends)

    def windows(self, size: int, seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
        """Start words of the windows of `size` words inside one document, and their hashes (independent ones by seed)."""
        n = len(self.starts)
        if n < size:
            return np.zeros(0, np.int64), np.zeros(0, U64)
        pre = prefix(word_hash(self.data, self.starts, self.ends, seed) if seed else self.hash, 1)
        every = mix((pre[size:] - pre[:-size]) * _power(1, True, n - size + 1))
        same = self.doc[: n - size + 1] == self.doc[size - 1 :]
        return np.flatnonzero(same), every[same]


def member(queries: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Which queries are in the sorted table; a bitmap sieves most of the others."""
    hit = np.zeros(len(queries), bool)
    if not len(table) or not len(queries):
        return hit
    bits = min(24, max(12, int(len(table)).bit_length() + 4))
    shift = U64(64 - bits)
    sieve = np.zeros(1 << bits, bool)
    spread = U64(0x9E3779B97F4A7C15)
    sieve[(table * spread) >> shift] = True
    some = np.flatnonzero(sieve[(queries * spread) >> shift])
    at = np.searchsorted(table, queries[some])
    at[at == len(table)] = 0
    hit[some] = table[at] == queries[some]
    return hit


def runs(sorted_keys: np.ndarray) -> np.ndarray:
    """Where each run of equal keys starts."""
    if not len(sorted_keys):
        return np.zeros(0, np.int64)
    return np.concatenate(([0], np.flatnonzero(sorted_keys[1:] != sorted_keys[:-1]) + 1))


def covered(starts: np.ndarray, ends: np.ndarray, n: int) -> np.ndarray:
    """Which of n places lie in some [start, end)."""
    step = np.zeros(n + 1, np.int64)
    np.add.at(step, starts, 1)
    np.add.at(step, ends, -1)
    return np.cumsum(step[:-1]) > 0


def concat(payloads, dtype) -> tuple[np.ndarray, np.ndarray]:
    """Binary cells as one array, and the length of each."""
    parts = [np.frombuffer(p, dtype) for p in payloads]
    return (np.concatenate(parts) if parts else np.zeros(0, dtype)), np.array([len(p) for p in parts], np.int64)

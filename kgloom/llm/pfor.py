"""Patched frame-of-reference blocks of unsigned integers.

A block holds 128 values: the smallest is subtracted, the rest is packed at the
width that a percentile of the block needs, and larger values go to a list of
exceptions.  The last block is filled up with its own smallest value.  Block:
base (uint32), width, exceptions, two spare bytes; 16 bytes for each bit of
width; positions (uint8) and values (uint32) of the exceptions.
"""

from __future__ import annotations

import numpy as np

BLOCK = 128
PERCENTILE = 90
HEAD = 8


def pack(values: np.ndarray) -> tuple[bytes, np.ndarray]:
    """The blocks, and where each starts."""
    n = -(-len(values) // BLOCK)
    if not n:
        return b"", np.zeros(0, np.uint32)
    full = np.empty(n * BLOCK, np.uint32)
    full[: len(values)] = values
    full[len(values) :] = values[(n - 1) * BLOCK :].min()
    full = full.reshape(n, BLOCK)
    base = full.min(axis=1)
    delta = full - base[:, None]
    rank = BLOCK * PERCENTILE // 100
    width = np.frexp(np.partition(delta, rank, axis=1)[:, rank].astype(np.float64))[1].astype(np.int64)
    odd = delta.astype(np.uint64) >> width[:, None].astype(np.uint64) > 0
    count = odd.sum(axis=1)
    size = HEAD + 16 * width + 5 * count
    start = np.cumsum(size) - size
    out = np.zeros(int(size.sum()), np.uint8)
    out[start[:, None] + np.arange(4)] = base.astype("<u4").view(np.uint8).reshape(n, 4)
    out[start + 4], out[start + 5] = width, count
    for w in np.unique(width[width > 0]):
        some = np.flatnonzero(width == w)
        bits = (delta[some][:, :, None] >> np.arange(w, dtype=np.uint32)) & np.uint32(1)
        out[(start[some] + HEAD)[:, None] + np.arange(16 * w)] = np.packbits(bits.astype(np.uint8).reshape(len(some), -1), axis=1)
    row, spot = np.nonzero(odd)
    nth = np.arange(len(row)) - (np.cumsum(count) - count)[row]
    at = start[row] + HEAD + 16 * width[row]
    out[at + nth] = spot
    out[(at + count[row] + 4 * nth)[:, None] + np.arange(4)] = delta[row, spot].astype("<u4").view(np.uint8).reshape(-1, 4)
    return out.tobytes(), start.astype(np.uint32)


def unpack(blocks: bytes, start: np.ndarray, total: int) -> np.ndarray:
    """The first `total` values of the blocks."""
    raw, start = np.frombuffer(blocks, np.uint8), start.astype(np.int64)
    n = len(start)
    if not n:
        return np.zeros(0, np.uint32)
    base = np.ascontiguousarray(raw[start[:, None] + np.arange(4)]).view("<u4").ravel()
    width, count = raw[start + 4].astype(np.int64), raw[start + 5].astype(np.int64)
    delta = np.zeros((n, BLOCK), np.uint32)
    for w in np.unique(width[width > 0]):
        some = np.flatnonzero(width == w)
        bits = np.unpackbits(raw[(start[some] + HEAD)[:, None] + np.arange(16 * w)], axis=1).reshape(len(some), BLOCK, w)
        value = np.zeros((len(some), BLOCK), np.uint32)
        for k in range(w):
            value |= bits[:, :, k].astype(np.uint32) << np.uint32(k)
        delta[some] = value
    row = np.repeat(np.arange(n), count)
    nth = np.arange(len(row)) - (np.cumsum(count) - count)[row]
    at = start[row] + HEAD + 16 * width[row]
    delta[row, raw[at + nth]] = np.ascontiguousarray(raw[(at + count[row] + 4 * nth)[:, None] + np.arange(4)]).view("<u4").ravel()
    return (delta + base[:, None]).ravel()[:total]

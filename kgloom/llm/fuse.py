"""Binary fuse filters: static sets of 64-bit keys in about nine bits a key.

A key owns one slot in each of three segments in a row, and the xor of its slots
is its fingerprint.  The filter answers yes for every key of the set and, once in
256 times, for another.  It is built once, from a set that never changes.
"""

from __future__ import annotations

import math
import struct

import numpy as np

from .arrays import mix

HEAD = struct.Struct("<QQQ")


def _slots(keys: np.ndarray, seed: int, segments: int, length: int) -> tuple[np.ndarray, np.ndarray]:
    """The three slots of each key, and its fingerprint."""
    h, g = mix(keys, 2 * seed), mix(keys, 2 * seed + 1)
    first = ((h >> np.uint64(32)) * np.uint64(segments)) >> np.uint64(32)
    low = np.uint64(length - 1)
    inside = np.stack((h & low, g & low, (g >> np.uint64(20)) & low), axis=1)
    return ((first[:, None] + np.arange(3, dtype=np.uint64)) * np.uint64(length) + inside).astype(np.int64), (g >> np.uint64(56)).astype(np.uint8)


def _peeled(slots: np.ndarray, size: int) -> list[tuple[np.ndarray, np.ndarray]] | None:
    """Rounds of (keys, the slot that each holds alone); None if some keys never hold a slot alone."""
    n = len(slots)
    held = np.bincount(slots.ravel(), minlength=size)
    sums = np.bincount(slots.ravel(), np.repeat(np.arange(n), 3), size).astype(np.int64)
    front, rounds, done = np.flatnonzero(held == 1), [], 0
    while len(front):
        who, at = np.unique(sums[front], return_index=True)
        rounds.append((who, front[at]))
        done += len(who)
        touched = slots[who].ravel()
        np.subtract.at(held, touched, 1)
        np.subtract.at(sums, touched, np.repeat(who, 3))
        front = np.unique(touched)
        front = front[held[front] == 1]
    return rounds if done == n else None


def build(keys: np.ndarray) -> bytes:
    """The filter of these keys (64-bit, repeats allowed)."""
    keys = np.unique(keys.astype(np.uint64))
    n = max(2, len(keys))
    length = 1 << min(18, int(math.log(n) / math.log(3.33) + 2.25))
    capacity = n * max(1.125, 0.875 + 0.25 * math.log(1e6) / math.log(n))
    segments = max(1, math.ceil(capacity / length) - 2)
    for seed in range(200):
        if seed % 20 == 19:  # small sets may need more room
            segments += 1
        slots, prints = _slots(keys, seed, segments, length)
        rounds = _peeled(slots, (segments + 2) * length)
        if rounds is not None:
            break
    else:
        raise RuntimeError("no seed places all keys")
    cells = np.zeros((segments + 2) * length, np.uint8)
    for who, slot in reversed(rounds):
        cells[slot] = prints[who] ^ np.bitwise_xor.reduce(cells[slots[who]], axis=1)
    return HEAD.pack(seed, segments, length) + cells.tobytes()


def contains(packed: bytes, keys: np.ndarray) -> np.ndarray:
    """Which keys the filter lets through."""
    seed, segments, length = HEAD.unpack_from(packed)
    cells = np.frombuffer(packed, np.uint8, offset=HEAD.size)
    slots, prints = _slots(keys.astype(np.uint64), seed, segments, length)
    return np.bitwise_xor.reduce(cells[slots], axis=1) == prints

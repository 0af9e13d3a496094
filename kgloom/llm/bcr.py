"""Column-wise construction of the Burrows-Wheeler transform and the common
prefixes of a collection of strings.

Round j inserts, for every string of at least j symbols, the suffix of length j.
The transform and the common-prefix column live in two external files that each
round reads once and writes once, front to back.
"""

from __future__ import annotations

import os
import tempfile

import numpy as np


class _Column:
    """A column in two external files: each round reads one and writes the other, in sequence."""

    def __init__(self, folder: str, name: str, dtype):
        self.files = [open(os.path.join(folder, f"{name}.{k}"), "w+b", buffering=0) for k in (0, 1)]
        self.dtype, self.now, self.n = np.dtype(dtype), 0, 0

    def read(self) -> np.ndarray:
        self.files[self.now].seek(0)
        return np.frombuffer(bytearray(self.files[self.now].read(self.n * self.dtype.itemsize)), self.dtype)

    def write(self, values: np.ndarray) -> None:
        self.now, self.n = self.now ^ 1, len(values)
        self.files[self.now].seek(0)
        self.files[self.now].write(values.astype(self.dtype, copy=False).tobytes())

    def close(self) -> None:
        for f in self.files:
            f.close()


def _spread(old: np.ndarray, at_new: np.ndarray, n: int, fill=0) -> np.ndarray:
    out = np.full(n, fill, old.dtype)
    keep = np.ones(n, bool)
    keep[at_new] = False
    out[keep] = old
    return out


def _ordered_by_symbol(bwt: np.ndarray) -> np.ndarray:
    """Places of the symbols of the transform (not of its blanks), by symbol, then place."""
    order = np.argsort(bwt, kind="stable")
    return order[np.searchsorted(bwt[order], 1) :]


def build(strings: list[np.ndarray], folder: str) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Transform, common prefix with the suffix before, and the ranks of each string's suffixes.

    ranks[j][i] is the rank of the suffix of length j of string i (-1 if it has
    none).  Symbols are positive integers.  Ends of strings are smaller than any
    symbol and differ from each other, so a common prefix never runs over an end.
    """
    m = len(strings)
    length = np.array([len(s) for s in strings], np.int64)
    start = np.concatenate(([0], np.cumsum(length)))
    symbols = np.concatenate([np.zeros(0, np.uint16), *strings])
    bwt_file, lcp_file = _Column(folder, "bwt", symbols.dtype), _Column(folder, "lcp", np.uint16)
    bwt_file.write(np.zeros(m, symbols.dtype))
    lcp_file.write(np.zeros(m, np.uint16))
    at = np.arange(m)  # where each string's newest suffix stands
    for j in range(1, int(length.max(initial=0)) + 1):
        active = np.flatnonzero(length >= j)
        bwt, lcp = bwt_file.read(), lcp_file.read()
        place = at[active]
        bwt[place] = symbols[start[active] + length[active] - j]
        order = _ordered_by_symbol(bwt)
        fresh = np.zeros(len(bwt), bool)
        fresh[place] = True
        fresh = fresh[order]
        # neighbours in the new order that start with the same symbol
        same = bwt[order[1:]] == bwt[order[:-1]]
        ask = np.flatnonzero(same & (fresh[1:] | fresh[:-1]))
        low = order[ask] + 1
        by = np.argsort(low, kind="stable")
        pairs = np.empty(2 * len(ask), np.int64)
        pairs[0::2], pairs[1::2] = low[by], order[ask + 1][by] + 1
        least = np.empty(len(ask), np.int64)
        if len(ask):
            least[by] = np.minimum.reduceat(np.append(lcp, 0), pairs)[0::2]
        rank = np.flatnonzero(fresh) + m
        n = len(bwt) + len(active)
        lcp = _spread(lcp, rank, n)
        lcp[ask + 1 + m] = least + 1
        head = np.ones(len(order), bool)
        head[1:] = ~same
        lcp[np.flatnonzero(head & fresh) + m] = 0
        nxt = np.flatnonzero(head[1:] & fresh[:-1]) + 1
        lcp[nxt + m] = 0
        bwt_file.write(_spread(bwt, rank, n))
        lcp_file.write(lcp)
        where = np.empty(len(bwt), np.int64)
        where[order] = np.arange(m, m + len(order))
        at[active] = where[place]
    bwt, lcp = bwt_file.read(), lcp_file.read()
    bwt_file.close()
    lcp_file.close()
    where = np.full(len(bwt), -1, np.int64)
    order = _ordered_by_symbol(bwt)
    where[order] = np.arange(m, m + len(order))
    ranks = [np.arange(m)]
    for j in range(1, int(length.max(initial=0)) + 1):
        ranks.append(np.where(length >= j, where[ranks[-1]], -1))
    return bwt, lcp, ranks


def repeated_starts(strings: list[np.ndarray], least: int) -> list[np.ndarray]:
    """For each string, the starts of its substrings of `least` symbols that also start elsewhere."""
    with tempfile.TemporaryDirectory(prefix="bwt-") as folder:
        _, lcp, ranks = build(strings, folder)
    long = np.append(lcp >= least, False)
    flag = long[:-1] | long[1:]
    found: list[list[int]] = [[] for _ in strings]
    for j in range(len(ranks) - 1, least - 1, -1):
        for i in np.flatnonzero((ranks[j] >= 0) & flag[ranks[j]]):
            found[i].append(len(strings[i]) - j)
    return [np.array(f, np.int64) for f in found]

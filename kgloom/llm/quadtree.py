"""K-squared quadtree (k = 2) over a sparse count matrix.

A square of 2^depth by 2^depth cells is halved both ways until cells remain; a
quadrant without a count has no node.  Nodes of a level are the distinct prefixes
of the cells' Z-order codes, so a tree is a few sorted arrays.
"""

from __future__ import annotations

import numpy as np


def _spread(x: np.ndarray) -> np.ndarray:
    """Bits of x at the even places."""
    x = x.astype(np.uint64)
    for shift, mask in ((16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F), (2, 0x3333333333333333), (1, 0x5555555555555555)):
        x = (x | (x << np.uint64(shift))) & np.uint64(mask)
    return x


class Tree:
    """Counts by (row, column); each cell is given once and is not zero."""

    def __init__(self, row: np.ndarray, column: np.ndarray, count: np.ndarray, side: int):
        self.depth = max(0, int(side - 1).bit_length())
        code = ((_spread(row) << np.uint64(1)) | _spread(column)).astype(np.int64)
        order = np.argsort(code)
        code, self.count = code[order], count[order]
        #: children[level][node * 4 + quadrant]: a node of the next level, or -1 for a quadrant of zeros
        self.children = []
        nodes = [code]
        for _ in range(self.depth):
            nodes.append(np.unique(nodes[-1] >> 2))
        nodes.reverse()
        for upper, lower in zip(nodes[:-1], nodes[1:]):
            child = np.full(4 * len(upper), -1, np.int64)
            child[4 * np.searchsorted(upper, lower >> 2) + (lower & 3)] = np.arange(len(lower))
            self.children.append(child)
        self.root = 0 if len(code) else -1

    def joint(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """For pairs of rows (a[i], b[i]): (i, column, count in a, count in b) of each column where either has a count.

        Both rows descend together; where both meet a quadrant of zeros, the descent ends.
        """
        pair = np.arange(len(a)) if self.root == 0 else np.zeros(0, np.int64)
        left, right = np.zeros(len(pair), np.int64), np.zeros(len(pair), np.int64)
        column = np.zeros(len(pair), np.int64)
        for level, child in enumerate(self.children):
            bit = self.depth - 1 - level
            upper = ((a[pair] >> bit) & 1) << 1, ((b[pair] >> bit) & 1) << 1
            parts = []
            for half in (0, 1):
                step = [np.where(node >= 0, child[4 * np.maximum(node, 0) + up + half], -1) for node, up in zip((left, right), upper)]
                alive = np.flatnonzero((step[0] >= 0) | (step[1] >= 0))
                parts.append((pair[alive], step[0][alive], step[1][alive], 2 * column[alive] + half))
            pair, left, right, column = (np.concatenate(x) for x in zip(*parts))
        counts = [np.where(node >= 0, self.count[np.maximum(node, 0)], 0) if len(self.count) else node for node in (left, right)]
        return pair, column, counts[0], counts[1]

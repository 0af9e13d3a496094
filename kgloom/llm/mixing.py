"""The context-mixing model itself: hashed-context bit predictors, gated mixing, refinement.

A symbol (a byte, or 0 at the end of a text) is coded as eight binary decisions.
For each, predictors of orders 1 to 5, and one of the current word so far, tell
what followed the same context in training; their stretched probabilities are
summed with weights that a gate chooses (bit position, longest context seen,
trust in the word); an adaptive table refines the mixed probability.

A code is one integer: from the highest byte, the last five bytes, nearest first,
a 16-bit hash of what the word holds before those, and the symbol.  A cell is a
fixed set of contexts of three bytes, with all longer contexts that end in them;
it is modelled on its own, in an order that depends on its codes alone, so scores
do not depend on how cells are dealt to tasks.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

from .arrays import _BYTE, _SPACE, mix, prefix, runs, span_hash

U64 = np.uint64
WORD = 6
HIGH = (3, 4, 5, WORD)  # predictors whose counts lie in a cell
INPUTS = len(HIGH) + 3  # those of orders 1 and 2, and a constant
_BREAK = _SPACE.copy()
_BREAK[0] = True
LIMIT = 12.0  # of stretched probabilities
GATES = len(HIGH) * 4
#: Weights of orders 1, 2, 3, 4, 5, of the word and of the constant before anything is learnt.
START = np.array([0.05, 0.1, 0.2, 0.3, 0.4, 0.6, 0.0], np.float32)
RATE, BATCH = 0.4, 2048
BINS = 33


def codes(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The code of every byte and of the end of every document, in order."""
    n_docs = len(offsets) - 1
    size = np.diff(offsets)
    padded = np.zeros(len(data) + 6 * n_docs, np.uint8)
    shift = np.repeat(np.arange(n_docs) * 6 + 5, size)
    padded[np.arange(len(data)) + shift] = data
    wide = np.zeros(len(padded), U64)
    for k in range(6):
        wide[k:] |= padded[: len(padded) - k].astype(U64) << U64(8 * (8 - k) % 64)
    place = np.arange(len(padded))
    word = np.maximum.accumulate(np.where(_BREAK[padded], place + 1, 0))
    word[1:], word[:1] = word[:-1].copy(), 0  # where the word before each symbol starts
    long = np.flatnonzero(word < place - 5)
    wide[long] |= (span_hash(prefix(_BYTE[padded], 0), word[long], long - 5, 0) >> U64(48)) << U64(8)
    keep = np.ones(len(padded), bool)
    first = offsets[:-1] + np.arange(n_docs) * 6
    for k in range(5):
        keep[first + k] = False
    return wide[keep]


def context(code: np.ndarray, order: int) -> np.ndarray:
    """The part of codes that a predictor looks at, with the symbol lowest."""
    out, inside = code & U64(0xFF), np.ones(len(code), bool)
    if order < WORD:
        return out | (code >> U64(64 - 8 * order) << U64(8))
    for k in range(1, 6):
        byte = (code >> U64(64 - 8 * k)) & U64(0xFF)
        inside &= ~_BREAK[byte.astype(np.int64)]
        out[inside] |= byte[inside] << U64(8 * k)
    out[inside] |= (code[inside] & U64(0xFFFF00)) << U64(40)
    return out


def cell_of(code: np.ndarray, cells: int) -> np.ndarray:
    """All contexts that end in the same three bytes have one cell."""
    return (mix(code >> U64(40), 99) % U64(cells)).astype(np.int64)


def pairs_of(code: np.ndarray) -> np.ndarray:
    """Last two bytes and symbol."""
    return (code >> U64(48) << U64(8)) | (code & U64(0xFF))


def _stretch(zeros, ones, prior: float):
    return np.clip(np.log((ones + np.float32(prior)) / (zeros + np.float32(prior))), -LIMIT, LIMIT).astype(np.float32)


def _nodes(counts: np.ndarray, prior: float) -> np.ndarray:
    """Stretched probability of a one by (context, bits so far with a leading one), from counts by symbol."""
    out = np.zeros((len(counts), 256), np.float32)
    level = counts.astype(np.float32)
    for bit in range(7, -1, -1):
        zeros, ones = level[:, 0::2], level[:, 1::2]
        out[:, 1 << bit : 2 << bit] = _stretch(zeros, ones, prior)
        level = zeros + ones
    return out


@dataclass
class Low:
    """Predictors of orders 1 and 2, counted over all training texts: at most 2**24 counts, whatever the corpus."""

    keys: np.ndarray  # sorted: last two bytes and symbol
    counts: np.ndarray

    def __post_init__(self):
        keys = self.keys.astype(np.int64)
        pair, row = np.unique(keys >> 8, return_inverse=True)
        two = np.zeros((len(pair) + 1, 256), np.float32)  # the last row is of pairs that training does not hold
        np.add.at(two, (row, keys & 255), self.counts)
        one = np.zeros((256, 256), np.float32)
        np.add.at(one, (keys >> 16, keys & 255), self.counts)
        self.row = np.full(1 << 16, len(pair), np.int64)
        self.row[pair] = np.arange(len(pair))
        self.one, self.two = _nodes(one, 0.02), _nodes(two, 0.1)


def _paths(low: np.ndarray, count: np.ndarray):
    """For the codes of one order: their sorting, and for a bit the zeros and ones of the node on each code's way."""
    order = np.argsort(low, kind="stable")
    sorted_low, sorted_count = low[order], count[order].astype(np.int64)

    def at(bit: int) -> tuple[np.ndarray, np.ndarray]:
        key = sorted_low >> U64(8 - bit)
        first = runs(key)
        size = np.diff(np.append(first, len(key)))
        one = ((sorted_low >> U64(7 - bit)) & U64(1)).astype(np.int64)
        total = np.add.reduceat(sorted_count, first)
        ones = np.add.reduceat(sorted_count * one, first)
        n0, n1 = np.empty(len(low), np.float32), np.empty(len(low), np.float32)
        n0[order], n1[order] = np.repeat(total - ones, size), np.repeat(ones, size)
        return n0, n1

    return at


def _trust(n: np.ndarray) -> np.ndarray:
    """0 to 3 by how often a context was seen."""
    return (n > 0).astype(np.int64) + (n > 2) + (n > 12)


def _bins(stretched: np.ndarray):
    x = (stretched + LIMIT) * np.float32((BINS - 1) / (2 * LIMIT))
    low = np.minimum(x.astype(np.int64), BINS - 2)
    return low, (x - low).astype(np.float32)


class Mixer:
    """Weights and refinement of one bit position, learnt as codes come."""

    def __init__(self, bit: int):
        self.weights = np.tile(START, (GATES, 1))
        self.steps = np.zeros(GATES)
        self.hits = np.full((1 << bit) * BINS, 4.0)
        self.sums = np.tile(4.0 / (1 + np.exp(-np.linspace(-LIMIT, LIMIT, BINS))), 1 << bit)

    def predict(self, x: np.ndarray, gate: np.ndarray, node: np.ndarray) -> tuple[np.ndarray, ...]:
        stretched = np.clip(np.einsum("ij,ij->i", self.weights[gate], x), -LIMIT, LIMIT)
        plain = 1 / (1 + np.exp(-stretched))
        low, part = _bins(stretched)
        at = node * BINS + low
        own = (self.sums[at] / self.hits[at]) * (1 - part) + (self.sums[at + 1] / self.hits[at + 1]) * part
        return np.clip((plain + own) / 2, 1e-6, 1 - 1e-6), plain, at, part

    def learn(self, x: np.ndarray, gate: np.ndarray, node: np.ndarray, one: np.ndarray, share: np.ndarray) -> None:
        """One step along the mean gradient of every gate, ever smaller; the table counts what came of each bin."""
        _, plain, at, part = self.predict(x, gate, node)
        error = (one - plain) * share
        held = np.bincount(gate, share, GATES)
        slope = np.stack([np.bincount(gate, error * x[:, i], GATES) for i in range(INPUTS)], axis=1)
        some = held > 0
        self.steps[some] += 1
        rate = RATE / np.sqrt(self.steps[some]) * np.minimum(1, held[some] / 16)
        self.weights[some] += (rate[:, None] * slope[some] / held[some, None]).astype(np.float32)
        for place, weight in ((at, (1 - part) * share), (at + 1, part * share)):
            self.hits += np.bincount(place, weight, len(self.hits))
            self.sums += np.bincount(place, weight * one, len(self.sums))


def cell_log2(code: np.ndarray, count: np.ndarray, low: Low) -> np.ndarray:
    """log2 probability of the symbol of each distinct code of one cell; count is its occurrences in training.

    Codes come in an order by the hash of their context, twice.  First weights and
    refinement are learnt from training codes, each seen as if one occurrence of it
    were not in the counts.  Then codes are scored batch by batch, and learning
    goes on after each batch.  All codes of a context are in one batch, so the
    probabilities of its symbols sum to 1.
    """
    order = np.lexsort((code, mix(code >> U64(8), 7)))
    code, count = code[order], count[order]
    first = runs(code >> U64(8))
    cuts = np.append(first[np.unique(np.searchsorted(first, np.arange(0, len(code), BATCH), side="right") - 1)], len(code))
    symbol, last = (code & U64(0xFF)).astype(np.int64), (code >> U64(56)).astype(np.int64)
    pair = low.row[(code >> U64(48)).astype(np.int64)]
    paths = [_paths(context(code, k), count) for k in HIGH]
    known = (count > 0).astype(np.float32)
    share = count.astype(np.float32)
    total = np.zeros(len(code))
    for bit in range(8):
        one = ((symbol >> (7 - bit)) & 1).astype(np.float32)
        node = symbol >> (8 - bit)
        full, less = np.zeros((len(code), INPUTS), np.float32), np.zeros((len(code), INPUTS), np.float32)
        full[:, 0], full[:, 1] = low.one[last, node + (1 << bit)], low.two[pair, node + (1 << bit)]
        full[:, -1] = 0.3
        less[:, (0, 1, -1)] = full[:, (0, 1, -1)]
        longest, without = np.zeros(len(code), np.int64), np.zeros(len(code), np.int64)
        for i, at in enumerate(paths):
            n0, n1 = at(bit)
            full[:, i + 2] = _stretch(n0, n1, 0.4)
            seen = _trust(n0 + n1)
            n0 -= known * (1 - one)
            n1 -= known * one
            less[:, i + 2] = _stretch(n0, n1, 0.4)
            before = _trust(n0 + n1)
            if i < len(HIGH) - 1:
                longest[seen > 0], without[before > 0] = i + 1, i + 1
        gate, gate_less = longest * 4 + seen, without * 4 + before
        mixer = Mixer(bit)
        for scoring in (False, True):
            for b in map(slice, cuts[:-1], cuts[1:]):
                if scoring:
                    p = mixer.predict(full[b], gate[b], node[b])[0]
                    total[b] += np.log2(np.where(one[b] > 0, p, 1 - p))
                mixer.learn(less[b], gate_less[b], node[b], one[b], share[b])
    out = np.empty(len(code))
    out[order] = total
    return out

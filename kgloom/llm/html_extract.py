"""HTML extraction: a linear-chain conditional random field over the leaf blocks of a page.

A block's features are the tags around it, the words of their classes and ids,
and the shape of its text; neighbouring labels are tied by transition weights.
Trained by maximum likelihood on the labelled pages, decoded by Viterbi.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import labelled_pages
from .html_blocks import FEATURES, Block, blocks, slot

PAGES, STEPS, L2 = 700, 160, 2e-4
#: Cells of the tables that pages of like length are decoded in at once.
CELLS = 1 << 17


@lru_cache(maxsize=1 << 14)
def _around(bits: int, leaf: str) -> tuple[int, ...]:
    """Feature slots of the elements around a block."""
    raw = np.frombuffer(bits.to_bytes(FEATURES // 8, "little"), np.uint8)
    return tuple(np.flatnonzero(np.unpackbits(raw, bitorder="little")).tolist()) + (slot(f"leaf:{leaf}"), slot("bias"))


def features(page: list[Block]) -> list[tuple[int, ...]]:
    out = []
    for k, b in enumerate(page):
        n, words = len(b.text), b.text.count(" ") + 1
        share = 2 if b.linked > 0.6 * n else int(b.linked > 0.2 * n)
        shape = (f"words:{words.bit_length()}", f"links:{share}", f"end:{b.text[-1] in '.?!:'}", f"place:{'first' if not k else 'last' if k == len(page) - 1 else 'mid'}", f"mark:{'©' in b.text}")
        out.append(_around(b.around.bits, b.around.leaf) + tuple(slot(f) for f in shape))
    return out


def _padded(pages: list[list[tuple[int, ...]]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Feature slots end to end, the block of each, and a page x block table of block numbers (-1: none)."""
    size = [len(p) for p in pages]
    number = np.full((len(pages), max(size, default=0)), -1)
    number[np.arange(number.shape[1])[None, :] < np.array(size)[:, None]] = np.arange(sum(size))
    each = [f for p in pages for f in p]
    return np.fromiter((x for f in each for x in f), np.int64), np.repeat(np.arange(len(each)), [len(f) for f in each]), number


@dataclass(frozen=True)
class Model:
    emission: np.ndarray  # FEATURES x 2
    transition: np.ndarray  # 2 x 2

    def scores(self, slots: np.ndarray, block: np.ndarray, n: int) -> np.ndarray:
        return np.stack([np.bincount(block, self.emission[slots, k], n) for k in (0, 1)], axis=1)

    def decode(self, pages: list[list[tuple[int, ...]]]) -> list[np.ndarray]:
        """The likeliest labels of each page's blocks; pages of like length are decoded together."""
        order = sorted(range(len(pages)), key=lambda k: len(pages[k]))
        out: list[np.ndarray] = [np.zeros(0, np.int8)] * len(pages)
        lo = 0
        while lo < len(order):
            hi = lo + 1
            while hi < len(order) and (hi + 1 - lo) * len(pages[order[hi]]) <= CELLS:
                hi += 1
            for k, labels in zip(order[lo:hi], self._decoded([pages[k] for k in order[lo:hi]])):
                out[k] = labels
            lo = hi
        return out

    def _decoded(self, pages: list[list[tuple[int, ...]]]) -> list[np.ndarray]:
        slots, block, number = _padded(pages)
        n, width = int(number.max(initial=-1)) + 1, number.shape[1]
        score = np.vstack((self.scores(slots, block, n), np.zeros((1, 2))))
        there = number >= 0
        best, back = np.zeros((len(pages), 2)), np.zeros((len(pages), width, 2), np.int8)
        for k in range(width):
            if not k:
                best = score[number[:, 0]]
                continue
            ways = best[:, :, None] + self.transition[None]
            back[:, k] = ways.argmax(1)
            best = np.where(there[:, k, None], ways.max(1) + score[number[:, k]], best)
        out = [np.zeros(len(p), np.int8) for p in pages]
        last = there.sum(1) - 1
        label = best.argmax(1)
        for k in range(width - 1, -1, -1):
            for i in np.flatnonzero(last >= k):
                out[i][k] = label[i]
                label[i] = back[i, k, label[i]]
        return out


def _gradient(w: np.ndarray, t: np.ndarray, slots, block, number, gold):
    """Log-likelihood per page and its slope, by forward and backward sums over all pages at once."""
    n_pages, width = number.shape
    n = int(number.max()) + 1
    score = np.vstack((np.stack([np.bincount(block, w[slots, k], n) for k in (0, 1)], axis=1), np.zeros((1, 2))))[number]
    there = number >= 0
    add = lambda x, axis: np.logaddexp.reduce(x, axis=axis)
    ahead, behind = np.zeros((n_pages, width, 2)), np.zeros((n_pages, width, 2))
    ahead[:, 0] = score[:, 0]
    for k in range(1, width):
        ahead[:, k] = np.where(there[:, k, None], add(ahead[:, k - 1, :, None] + t[None], 1) + score[:, k], ahead[:, k - 1])
    for k in range(width - 2, -1, -1):
        behind[:, k] = np.where(there[:, k + 1, None], add(t[None] + (behind[:, k + 1] + score[:, k + 1])[:, None, :], 2), 0)
    z = add(ahead[:, -1], 1)
    node = np.exp(ahead + behind - z[:, None, None])[there]
    pair = np.exp(ahead[:, :-1, :, None] + t[None, None] + (score + behind)[:, 1:, None, :] - z[:, None, None, None]) * there[:, 1:, None, None]
    flat = np.eye(2)[gold]
    error = flat - node
    slope_w = np.stack([np.bincount(slots, error[block, k], FEATURES) for k in (0, 1)], axis=1)
    table = np.zeros((n_pages, width, 2))
    table[there] = flat
    slope_t = np.einsum("pka,pkb->ab", table[:, :-1], table[:, 1:]) - pair.sum((0, 1))
    return slope_w / n_pages, slope_t / n_pages


@lru_cache(maxsize=2)
def train(pages: int = PAGES, steps: int = STEPS) -> Model:
    """Fit on so many labelled pages."""
    cut = []
    for seed in range(pages):
        page = blocks(labelled_pages.page(seed))
        labels = [int(b.text.startswith(labelled_pages.IN)) for b in page]
        for b in page:
            b.text = b.text.replace(labelled_pages.IN, "").replace(labelled_pages.OUT, "") or "-"
        if page:
            cut.append((features(page), labels))
    slots, block, number = _padded([f for f, _ in cut])
    gold = np.array([x for _, labels in cut for x in labels])
    w, t = np.zeros((FEATURES, 2)), np.zeros((2, 2))
    square_w, square_t, speed_w, speed_t = np.zeros_like(w), np.zeros_like(t), np.zeros_like(w), np.zeros_like(t)
    for step in range(1, steps + 1):  # Adam
        for value, slope, speed, square in zip((w, t), _gradient(w, t, slots, block, number, gold), (speed_w, speed_t), (square_w, square_t)):
            slope = slope - L2 * value
            speed += 0.1 * (slope - speed)
            square += 0.02 * (slope * slope - square)
            value += 0.1 * (speed / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.98**step)) + 1e-8)
    return Model(w, t)


def main_text(pages: list[str | None], model: Model) -> list[str]:
    cut = [blocks(p) for p in pages]
    labels = model.decode([features(p) for p in cut])
    return ["\n".join(b.text for b, x in zip(p, own) if x) for p, own in zip(cut, labels)]


def _extracted(model: Model, at_once: int):
    def extract(batches):
        for batch in batches:
            for a in range(0, batch.num_rows, at_once):
                some = batch.slice(a, at_once)
                texts = main_text(some.column(2).to_pylist(), model)
                yield pa.RecordBatch.from_arrays([some.column(0), some.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    return extract


def extract_pages(pages: DataFrame, model: Model | None = None, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", at_once: int = 200) -> DataFrame:
    """page_id, url, text and n_chars, a row for each page.

    Blocks labelled as the article, white space in each made one blank, joined by
    line ends.  A null or empty page, or one without such blocks, has an empty
    text.  Rows may repeat; other columns are ignored.
    """
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))
    return rows.mapInArrow(_extracted(model or train(), at_once), "page_id long, url string, text string, n_chars long")

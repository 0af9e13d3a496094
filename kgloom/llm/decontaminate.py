"""Benchmark decontamination: q-gram lemma filtering and banded alignment.

A place in a text within k edits of a benchmark item of m characters shares at
least m - q + 1 - k*q q-grams with it, all on k + 1 neighbouring diagonals.  Shared
q-grams are counted in overlapping bands of diagonals; bands that reach the bound
are verified by an alignment inside the band.  Characters are the bytes of the
text with letters A-Z lower-cased and white space runs as one blank.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .arrays import _LOWER, _SPACE, member, rolling, text_bytes
from .pretokens import slices

U64 = np.uint64
Q, RATE, WINDOW = 12, 0.06, 128
BATCH_BYTES = 16 << 20
RESULT = "doc_id long, item_id long, edits int, item_chars int"


def normalised(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    space = _SPACE[data]
    keep = np.ones(len(data), bool)
    keep[1:] = ~(space[1:] & space[:-1])
    keep[offsets[:-1][np.diff(offsets) > 0]] = True
    total = np.concatenate(([0], np.cumsum(keep)))
    return np.where(space, np.uint8(32), _LOWER[data])[keep], total[offsets]


def alignment(item: np.ndarray, text: np.ndarray, low: int, width: int, most: int) -> int:
    """Fewest edits between the item and any stretch of text, on the diagonals low .. low + width - 1."""
    far = most + 1
    lanes = np.arange(width)
    padded = np.concatenate((np.full(max(0, -low), 256, np.int16), text.astype(np.int16), np.full(max(0, low + width + len(item) - len(text)) + 1, 256, np.int16)))
    at = max(0, low)  # column 0 of the band, in the padded text
    row = np.where((lanes + low >= 0) & (lanes + low <= len(text)), 0, far)
    for i, symbol in enumerate(item.tolist()):
        step = row + (padded[at + i : at + i + width] != symbol)
        step[:-1] = np.minimum(step[:-1], row[1:] + 1)
        row = np.minimum.accumulate(step - lanes) + lanes
        column = lanes + low + i + 1
        row = np.where((column >= 0) & (column <= len(text)), row, far)
        if row.min() > most:
            return far
    return int(row.min())


@dataclass
class Items:
    """A batch of benchmark items with the index of their q-grams."""

    ids: list[int]
    texts: list[np.ndarray]
    q: int
    rate: float

    def __post_init__(self):
        m = np.array([len(t) for t in self.texts], np.int64)
        self.length = m
        self.most = np.minimum(np.floor(self.rate * m), np.maximum(0, (m - self.q) // self.q)).astype(np.int64)
        self.bound = m - self.q + 1 - self.most * self.q
        spans = [rolling(t, self.q) for t in self.texts]
        h = np.concatenate([np.zeros(0, U64), *spans])
        item = np.repeat(np.arange(len(spans)), [len(s) for s in spans])
        place = np.concatenate([np.zeros(0, np.int64), *(np.arange(len(s)) for s in spans)])
        order = np.argsort(h, kind="stable")
        self.grams, self.item, self.place = h[order], item[order], place[order]
        self.distinct = np.unique(h)
        # a region of an item's length and edits has its bound in hits; some WINDOW of it has this part
        self.dense = int(np.ceil(self.bound / np.ceil((m + self.most) / WINDOW)).min(initial=1))

    def found(self, text: np.ndarray, hits: np.ndarray, grams: np.ndarray) -> dict[int, int]:
        """Items within their edit budget of some place in the text, and the fewest edits."""
        lo, hi = np.searchsorted(self.grams, grams, "left"), np.searchsorted(self.grams, grams, "right")
        n = hi - lo
        entry = np.repeat(lo - (np.cumsum(n) - n), n) + np.arange(n.sum())
        item, diagonal = self.item[entry], np.repeat(hits, n) - self.place[entry]
        wide = self.most[item] + 1
        band = np.floor_divide(diagonal, wide)
        both = np.concatenate((np.stack((item, band), 1), np.stack((item, band - 1), 1)))
        pairs, count = np.unique(both, axis=0, return_counts=True)
        out: dict[int, int] = {}
        for k, b in pairs[count >= self.bound[pairs[:, 0]]].tolist():
            if out.get(k) == 0:
                continue
            most, w = int(self.most[k]), int(self.most[k]) + 1
            edits = alignment(self.texts[k], text, b * w - most, 2 * w + 2 * most, most)
            if edits <= most:
                out[k] = min(edits, out.get(k, edits))
        return out


def _matches(items: Items):
    def match(batches):
        rows: dict[str, list] = {k: [] for k in ("doc_id", "item_id", "edits", "item_chars")}
        for batch in batches:
            all_data, all_offsets = text_bytes(batch.column("text"))
            ids = batch.column("doc_id").to_pylist()
            for a, b in slices(all_offsets, 1 << 20):
                data, offsets = normalised(all_data[all_offsets[a] : all_offsets[b]], all_offsets[a : b + 1] - all_offsets[a])
                h = rolling(data, items.q)
                hit = member(h, items.distinct)
                total = np.concatenate(([0], np.cumsum(hit)))
                at = np.flatnonzero(hit)
                if not len(at):
                    continue
                # enough hits in the window that starts, or the one that ends, at or around a hit
                thick = total[np.minimum(at + WINDOW, len(hit))] - total[at] >= items.dense
                near = np.zeros(len(hit) + 1, np.int64)
                np.add.at(near, at[thick], 1)
                np.add.at(near, np.minimum(at[thick] + WINDOW, len(hit)), -1)
                doc = np.unique(np.searchsorted(offsets, np.flatnonzero(np.cumsum(near[:-1]) > 0), side="right") - 1)
                for d in doc.tolist():
                    x, y = int(offsets[d]), int(offsets[d + 1])
                    own = at[(at >= x) & (at + items.q <= y)]
                    for k, edits in items.found(data[x:y], own - x, h[own]).items():
                        for name, value in zip(rows, (ids[a + d], items.ids[k], edits, int(items.length[k]))):
                            rows[name].append(value)
        yield pa.RecordBatch.from_pydict(rows, schema=pa.schema([("doc_id", pa.int64()), ("item_id", pa.int64()), ("edits", pa.int32()), ("item_chars", pa.int32())]))

    return match


def contaminated(docs: DataFrame, benchmark: DataFrame, q: int = Q, rate: float = RATE, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id") -> DataFrame:
    """doc_id, item_id, edits, item_chars: every document that holds an item within its edit budget.

    The budget of an item of m characters is floor(rate * m) edits, or less for
    items so short that the bound would be under one q-gram.  Items under q
    characters, and null items, match nothing; null or empty texts neither.
    Rows that repeat an id are searched each; a null id stays null.

    The index of the items goes out with the tasks.  Its size is checked: items
    beyond BATCH_BYTES of text go in batches, each a pass over the documents.
    """
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    given = benchmark.select(F.col(item_col).cast("long").alias("item_id"), F.col(text_col).alias("text")).where(F.octet_length("text") >= q)
    total = given.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    batches = max(1, math.ceil(total / BATCH_BYTES))
    out = None
    for k in range(batches):
        rows = given.where(F.pmod(F.xxhash64("item_id"), F.lit(batches)) == k).toArrow().sort_by([("item_id", "ascending"), ("text", "ascending")])
        data, offsets = normalised(*text_bytes(rows["text"]))
        pairs = [(i, data[a:b].copy()) for i, a, b in zip(rows["item_id"].to_pylist(), offsets, offsets[1:]) if b - a >= q]
        found = texts.mapInArrow(_matches(Items([i for i, _ in pairs], [t for _, t in pairs], q, rate)), RESULT)
        out = found if out is None else out.union(found)
    return out.groupBy("doc_id", "item_id").agg(F.min("edits").alias("edits"), F.min("item_chars").alias("item_chars"))

"""Toxicity: a linear classifier over character n-grams scaled by naive Bayes log-count ratios.

Fitted on a bounded sample of labelled rows: document frequencies of hashed
n-grams in either class give each its log-count ratio; the most telling ones are
kept; a logistic regression weighs presence times ratio.  Scoring looks at every
n-gram of a whole text.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .arrays import _LOWER, text_bytes
from .pretokens import slices

U64 = np.uint64
SIZES = (3, 4, 5, 6)
BITS = 20


@dataclass(frozen=True)
class Model:
    """Weights (ratio times coefficient) of hashed n-grams, and the intercept."""

    features: np.ndarray
    weights: np.ndarray
    intercept: float

    def table(self) -> np.ndarray:
        full = np.zeros(1 << BITS)
        full[self.features] = self.weights
        return full


def _grams(data: np.ndarray):
    """For each size, the hash of the n-gram at every byte; letters A-Z in lower case."""
    code = np.zeros(len(data), U64)
    low = _LOWER[data].astype(U64)
    for k in range(max(SIZES)):
        if k >= len(data):
            return
        code[: len(data) - k] |= low[k:] << U64(8 * k)
        if k + 1 in SIZES:
            some = code[: len(data) - k]
            yield k + 1, ((some * U64(0x9E3779B97F4A7C15) + U64(k + 1)) * U64(0xD1342543DE82EF95)) >> U64(64 - BITS)


def _pairs(data: np.ndarray, offsets: np.ndarray, wanted: np.ndarray | None) -> np.ndarray:
    """Sorted distinct (document << BITS | feature) with wanted features."""
    found = []
    for size, h in _grams(data):
        at = np.arange(len(h)) if wanted is None else np.flatnonzero(wanted[h])
        doc = np.searchsorted(offsets, at, side="right") - 1
        inside = at + size <= offsets[doc + 1]
        found.append((doc[inside].astype(U64) << U64(BITS)) | h[at[inside]])
    return np.unique(np.concatenate(found)) if found else np.zeros(0, U64)


def _logistic(row: np.ndarray, col: np.ndarray, value: np.ndarray, y: np.ndarray, n_col: int, l2: float, steps: int) -> tuple[np.ndarray, float]:
    """Logistic regression with an L2 penalty by Adam, whose steps suit rare columns as well as common ones."""
    n = len(y)
    w, speed, square = np.zeros(n_col + 1), np.zeros(n_col + 1), np.zeros(n_col + 1)
    for step in range(1, steps + 1):
        margin = np.bincount(row, value * w[col], n) + w[-1]
        error = 1 / (1 + np.exp(-margin)) - y
        slope = np.append(np.bincount(col, value * error[row], n_col), error.sum()) / n
        slope[:-1] += l2 * w[:-1]
        speed += 0.1 * (slope - speed)
        square += 0.01 * (slope * slope - square)
        rate = 0.03 * (1 - step / (steps + 1))
        w -= rate * speed / (1 - 0.9**step) / (np.sqrt(square / (1 - 0.99**step)) + 1e-10)
    return w[:-1], float(w[-1])


def fit(texts: pa.ChunkedArray, toxic: np.ndarray, share: float, features: int = 4096, l2: float = 1e-4, steps: int = 250) -> Model:
    """`share`: the part of toxic rows among all labelled ones, which the intercept is set back to."""
    n1 = int(toxic.sum())
    n0 = len(toxic) - n1
    prior = float(np.log((share + 1e-3) / (1 - share + 1e-3)))
    if not n1 or not n0:
        return Model(np.zeros(0, np.int64), np.zeros(0), prior)
    data, offsets = text_bytes(texts)
    counts = np.zeros((2, 1 << BITS))
    for a, b in slices(offsets, 1 << 18):
        pairs = _pairs(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], None)
        kind = toxic[a:b][(pairs >> U64(BITS)).astype(np.int64)]
        for k in (0, 1):
            counts[k] += np.bincount((pairs[kind == k] & U64((1 << BITS) - 1)).astype(np.int64), minlength=1 << BITS)
    rate = (counts + 1) / (np.array([[n0], [n1]]) + 2)
    ratio = np.log(rate[1] / rate[0])
    both = counts.sum(0) / (n0 + n1)
    telling = np.abs(counts[1] / n1 - counts[0] / n0) / np.sqrt((both + 1e-9) * (1 - both + 1e-9) * (1 / n0 + 1 / n1))
    telling[counts.sum(0) < 3] = 0
    keep = np.sort(np.argsort(-telling, kind="stable")[:features])
    keep = keep[telling[keep] > 3]
    wanted = np.zeros(1 << BITS, bool)
    wanted[keep] = True
    rows, cols = [], []
    for a, b in slices(offsets, 1 << 20):
        pairs = _pairs(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], wanted)
        rows.append((pairs >> U64(BITS)).astype(np.int64) + a)
        cols.append(np.searchsorted(keep, (pairs & U64((1 << BITS) - 1)).astype(np.int64)))
    row, col = np.concatenate(rows), np.concatenate(cols)
    w, bias = _logistic(row, col, ratio[keep][col], toxic.astype(float), len(keep), l2, steps)
    return Model(keep, w * ratio[keep], bias + prior - float(np.log(n1 / n0)))


def train(docs: DataFrame, labels: DataFrame, most: int = 2000, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> Model:
    """Learn from at most `most` labelled rows of each class, those with the smallest hash of the id."""
    key = F.col(id_col).cast("long")
    marked = labels.select(key.alias("doc_id"), F.col(label_col).cast("int").alias("toxic")).where("toxic IN (0, 1) AND doc_id IS NOT NULL").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    counts = dict(marked.groupBy("toxic").count().collect())
    total = sum(counts.values())
    chosen = [marked.where(F.col("toxic") == k).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most) for k in (0, 1)]
    sample = chosen[0].unionByName(chosen[1])  # at most 2 * most ids
    rows = docs.select(key.alias("doc_id"), F.col(text_col).alias("text")).join(F.broadcast(sample), "doc_id").select("text", "toxic").toArrow()
    return fit(rows["text"], rows["toxic"].to_numpy().astype(np.int64), counts.get(1, 0) / total if total else 0.0)


def _scores(model: Model, name: str = "score"):
    def score(batches):
        table = model.table()
        wanted = table != 0
        for batch in batches:
            data, offsets = text_bytes(batch.column(batch.num_columns - 1))
            for a, b in slices(offsets, 1 << 20):
                pairs = _pairs(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], wanted)
                margin = np.bincount((pairs >> U64(BITS)).astype(np.int64), table[(pairs & U64((1 << BITS) - 1)).astype(np.int64)], b - a) + model.intercept
                out = batch.slice(a, b - a)
                yield pa.RecordBatch.from_arrays([*out.columns[:-1], pa.array(1 / (1 + np.exp(-np.clip(margin, -500, 500))), pa.float64())], names=[*out.schema.names[:-1], name])

    return score


def score(docs: DataFrame, model: Model, keep: list[str], text_col: str = "text", name: str = "score") -> DataFrame:
    """Columns `keep` and the score (0 to 1) as column `name`, a row for each input row.

    A null or empty text has no n-gram and gets the score of the intercept.
    Without labels of both classes all rows get the share of toxic labels.
    """
    if name in keep:
        raise ValueError(f"a column {name!r} is already kept")
    given = docs.select(*[F.col(c) for c in keep], F.col(text_col).alias(name))
    schema = T.StructType([*given.schema.fields[:-1], T.StructField(name, T.DoubleType())])
    return given.mapInArrow(_scores(model, name), schema)


"""LM scoring by online logistic context mixing, with a unigram word score beside it.

Every bucket of documents sends what it holds once: its distinct codes (context
and symbol) and words, with counts over training documents.  Partitions add the
counts up over the whole corpus; those of codes then model their cells and score
every code that any bucket asked for; each bucket gets the counts of its words
and the scores of its codes back.  All that grows with the corpus stays in
partitions.  Only the counts of the two lowest orders go through the driver:
they have 2**24 possible keys, whatever the corpus.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import mixing
from .arrays import Words, runs, text_bytes
from .buckets import ANSWER, Layout, bucketed, ordered
from .pretokens import slices

U64 = np.uint64
CELL_BYTES = 1 << 19
WORD, CODE, PAIR = 0, 1, 2
PAIR_PARTS = 16
COUNTS = "kind int, part long, bucket long, payload binary"
TOTALS = "n_distinct long, n_total long, payload binary"
RESULT = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double, bits_per_byte double"
SCHEMA = pa.schema([("kind", pa.int32()), ("part", pa.int64()), ("bucket", pa.int64()), ("payload", pa.binary())])


def _table(rows: list[tuple], schema: pa.Schema) -> pa.Table:
    if not rows:
        return schema.empty_table()
    return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


def _counted(keys: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys, kind="stable")
    at = runs(keys[order])
    return keys[order][at], np.add.reduceat(weight[order], at) if len(at) else np.zeros(0, np.int64)


def _pack(keys: np.ndarray, counts: np.ndarray) -> bytes:
    """Keys and counts byte plane by byte plane, compressed."""
    planes = [np.ascontiguousarray(x.view(np.uint8).reshape(-1, 8).T).tobytes() for x in (keys.astype(U64), counts.astype(np.int64))]
    return zstandard.compress(b"".join(planes), 1)


def _unpack(payload: bytes) -> tuple[np.ndarray, np.ndarray]:
    planes = np.frombuffer(zstandard.decompress(payload), np.uint8).reshape(2, 8, -1)
    keys, counts = (np.ascontiguousarray(p.T).reshape(-1) for p in planes)
    return keys.view(U64), counts.view(np.int64)


def _split(part: np.ndarray):
    """Ranges of equal partitions; `part` is sorted."""
    at = np.append(runs(part), len(part))
    return zip(part[at[:-1]].tolist(), at, at[1:])


def _surveyed(parts: int):
    """Words and pair codes of training texts, counted batch by batch."""

    def survey(batches):
        for batch in batches:
            data, offsets = text_bytes(batch.column(0))
            for a, b in slices(offsets):
                own, at = data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]
                words, n = np.unique(Words(own, at, lower=True).hash, return_counts=True)
                part = (words % U64(parts)).astype(np.int64)
                order = np.argsort(part, kind="stable")
                rows = [(WORD, p, 0, _pack(words[order][x:y], n[order][x:y])) for p, x, y in _split(part[order])]
                pairs, n = np.unique(mixing.pairs_of(mixing.codes(own, at)), return_counts=True)
                part = (pairs % U64(PAIR_PARTS)).astype(np.int64)
                order = np.argsort(part, kind="stable")
                rows += [(PAIR, p, 0, _pack(pairs[order][x:y], n[order][x:y])) for p, x, y in _split(part[order])]
                yield from _table(rows, SCHEMA).to_batches()

    return survey


def _totals(table: pa.Table) -> pa.Table:
    got = [_unpack(c) for c in table["payload"].to_pylist()]
    keys, counts = _counted(*(np.concatenate(x) for x in zip(*got)))
    word = table["kind"][0].as_py() == WORD
    return pa.table({
        "n_distinct": pa.array([len(keys) if word else 0], pa.int64()), "n_total": pa.array([int(counts.sum()) if word else 0], pa.int64()),
        "payload": pa.array([None if word else _pack(keys, counts)], pa.binary()),
    })


def _word_sets(words: Words, parts: int):
    """Distinct word hashes of a bucket in the order in which they are sent and answered."""
    h, back = np.unique(words.hash, return_inverse=True)
    order = np.argsort(h % U64(parts), kind="stable")
    place = np.empty(len(h), np.int64)
    place[order] = np.arange(len(h))
    return h[order], place[back]


def _part_of(code: np.ndarray, cells: int, parts: int) -> np.ndarray:
    return mixing.cell_of(code, cells) % parts


def _gathered(parts: int, cells: int):
    def gather(table: pa.Table) -> pa.Table:
        table = ordered(table)
        bucket = table["bucket"][0].as_py()
        learnt = np.array(table["learnt"].to_pylist(), bool)
        words = Words(*text_bytes(table["text"]), lower=True)
        keys, place = _word_sets(words, parts)
        counts = np.bincount(place, learnt[words.doc].astype(float), len(keys)).astype(np.int64)
        rows = [(WORD, p, bucket, _pack(keys[a:b], counts[a:b])) for p, a, b in _split((keys % U64(parts)).astype(np.int64))]
        found = []
        for kind in (True, False):
            texts = table["text"].take(pa.array(np.flatnonzero(learnt == kind)))
            code, n = np.unique(mixing.codes(*text_bytes(texts)), return_counts=True)
            found.append((code, n if kind else np.zeros(len(n), np.int64)))
        code, n = _counted(*(np.concatenate(x) for x in zip(*found)))
        part = _part_of(code, cells, parts)
        order = np.argsort(part, kind="stable")
        code, n = code[order], n[order]
        rows += [(CODE, p, bucket, _pack(code[a:b], n[a:b])) for p, a, b in _split(part[order])]
        return _table(rows, SCHEMA)

    return gather


def _answered(cells: int, low):
    """Training counts of the words, and log2 probabilities of the codes, that each bucket sent."""

    def answer(table: pa.Table) -> pa.Table:
        kind, part = table["kind"][0].as_py(), table["part"][0].as_py()
        buckets, cells_in = table["bucket"].to_pylist(), table["payload"].to_pylist()
        got = [_unpack(c) for c in cells_in]
        distinct, total = _counted(*(np.concatenate(x) for x in zip(*got)))
        if kind == CODE:
            cell = mixing.cell_of(distinct, cells)
            order = np.argsort(cell, kind="stable")
            total = total[order]
            values = np.empty(len(distinct), np.float16)
            for _, a, b in _split(cell[order]):
                values[order[a:b]] = mixing.cell_log2(distinct[order[a:b]], total[a:b], low.value)
        else:
            values = total
        return pa.table({
            "bucket": pa.array(buckets, pa.int64()), "part": pa.array([part] * len(buckets), pa.int64()), "kind": pa.array([kind] * len(buckets), pa.int32()),
            "payload": pa.array([values[np.searchsorted(distinct, k)].tobytes() for k, _ in got], pa.binary()),
        })

    return answer


def _scored(parts: int, cells: int, n_train: int, n_distinct: int, n_ends: int):
    def score(table: pa.Table, answers: pa.Table) -> pa.Table:
        table = ordered(table)
        data, offsets = text_bytes(table["text"])
        n_docs = len(offsets) - 1
        words = Words(data, offsets, lower=True)
        _, place = _word_sets(words, parts)
        told = sorted(zip(answers["kind"].to_pylist(), answers["part"].to_pylist(), answers["payload"].to_pylist()))
        get = lambda kind, dtype: np.concatenate([np.zeros(0, dtype), *(np.frombuffer(c, dtype) for k, _, c in told if k == kind)])
        c = get(WORD, np.int64)[place]
        floor = n_train + 0.1 * (n_distinct + 1)
        log = lambda x: np.log10((x + 0.1) / floor)
        base = np.bincount(words.doc, log(c), n_docs) + log(n_ends)
        seen = np.bincount(words.doc, c > 0, n_docs).astype(np.int64) + int(n_ends > 0)
        code, back = np.unique(mixing.codes(data, offsets), return_inverse=True)
        each = np.empty(len(code))
        each[np.argsort(_part_of(code, cells, parts), kind="stable")] = get(CODE, np.float16)
        bits = np.add.reduceat(each[back], offsets[:-1] + np.arange(n_docs)) if n_docs else np.zeros(0)
        return pa.table({
            "doc_id": table["doc_id"], "held_out": pa.array(~np.array(table["learnt"].to_pylist(), bool)), "n_tokens": pa.array(words.n + 1, pa.int64()), "n_known": pa.array(seen, pa.int64()),
            "train_tokens": pa.array(np.full(n_docs, n_train), pa.int64()), "base_score": pa.array(base), "score": pa.array(bits * np.log10(2)), "bits_per_byte": pa.array(-bits / np.maximum(1, np.diff(offsets))),
        })

    return score


def score_texts(docs: DataFrame, held_out: Column, cell_bytes: int = CELL_BYTES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Score every text by a model of the texts that are not held out.

    Counts cover all training texts, and mixing weights are learnt from all their
    codes.  `cell_bytes` of text, on average, share the weights of one cell.
    Returns doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score
    (log10 probability of the bytes and the end) and bits_per_byte.  Scores
    depend on the texts and `cell_bytes` alone, not on partitions.

    A null or empty text is its end alone.  Rows with the same id are separate.
    Where held_out is null (a null id), the text is trained on.  Without
    training texts every count is 0 and the score falls back to even odds.
    """
    layout = Layout(docs, text_col)
    parts, cells = layout.parts, max(1, math.ceil(layout.total / cell_bytes))
    learnt = ~F.coalesce(held_out, F.lit(False))
    training = docs.where(learnt).select(F.col(text_col).alias("text"))
    totals = training.mapInArrow(_surveyed(parts), COUNTS).groupBy("kind", "part").applyInArrow(_totals, TOTALS)
    n_train = n_distinct = 0
    pairs, counts = [np.zeros(0, U64)], [np.zeros(0, np.int64)]
    for r in totals.toLocalIterator():  # two numbers for each partition, and 2**24 pair codes at most
        n_train, n_distinct = n_train + r.n_total, n_distinct + r.n_distinct
        if r.payload is not None:
            for found, new in zip((pairs, counts), _unpack(bytes(r.payload))):
                found.append(new)
    n_ends = training.count()
    n_train, n_distinct = n_train + n_ends, n_distinct + int(n_ends > 0)
    pairs, counts = np.concatenate(pairs), np.concatenate(counts)
    order = np.argsort(pairs)
    low = docs.sparkSession.sparkContext.broadcast(mixing.Low(pairs[order], counts[order]))
    texts = bucketed(docs, layout, id_col, text_col, learnt.alias("learnt"))
    sets = texts.groupBy("bucket").applyInArrow(_gathered(parts, cells), COUNTS)
    answers = sets.groupBy("kind", "part").applyInArrow(_answered(cells, low), ANSWER)
    return texts.groupBy("bucket").cogroup(answers.groupBy("bucket")).applyInArrow(_scored(parts, cells, n_train, n_distinct, n_ends), RESULT)

"""Suffix-array dedup by column-wise construction over many documents.

A string of 400 bytes that occurs twice holds the same smallest 64-byte hash at
the same place both times.  So documents are cut into runs of 400-byte windows
that share this anchor, and runs of one anchor meet in one partition.  Runs
whose anchor occurs once hold nothing repeated and are left out.  In each
partition the suffixes of the rest are sorted by `bcr.build`, one symbol of each
run a round; a symbol is a block of 16 bytes, cut in step with the anchor.
Neighbours with a long common prefix give the places of repeated windows.

An anchor with very many runs (a short line that a third of the documents hold)
would gather them all in one partition.  The windows of such runs are dealt one
by one instead, each to the partition of its own hash; a bucket sends a window
twice at most, and is told which of its windows occur twice in all.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from .arrays import covered, member, mix, rolling, runs, steady_memory, text_bytes
from .bcr import repeated_starts
from .buckets import ANSWER, Layout, answer_rows, bucketed, flagged_set, looked_up, ordered, place, repeated_answer, set_rows, split_hash

U64 = np.uint64
ANCHOR = 64
#: Bytes in a symbol of the construction.
BLOCK = 16
#: An anchor that has MANY_RUNS runs in one bucket, or runs in over MANY_BUCKETS buckets, is crowded.
MANY_RUNS, MANY_BUCKETS = 32, 512
#: Bits of a place in a bucket; the rest of a word are the first bits of a hash.
PLACE_BITS = 32
RUN = "part long, anchor long, bucket long, places binary, shift int, text binary"
SPAN = "bucket long, doc int, spans binary"
RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept string"


def _sliding_min(x: np.ndarray, w: int) -> np.ndarray:
    """Smallest of each w values in a row, by block-wise running minima."""
    n = len(x)
    pad = np.full(-n % w, np.iinfo(x.dtype).max, x.dtype)
    blocks = np.concatenate((x, pad)).reshape(-1, w)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    back = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[: n - w + 1], ahead[w - 1 : n])


def anchored_runs(data: np.ndarray, offsets: np.ndarray, length: int, anchor: int):
    """Runs of windows with the same leftmost smallest anchor: document, first window, windows, anchor, hash."""
    none = np.zeros(0, np.int64)
    if len(data) < length:
        return none, none, none, none, np.zeros(0, U64)
    h = rolling(data, anchor)
    bits = U64(PLACE_BITS)  # the same for every bucket, so that equal windows have equal anchors wherever they are
    if len(data) >> PLACE_BITS:
        raise ValueError(f"a bucket of {len(data)} bytes: texts of 4 GiB are not supported")
    least = _sliding_min(((h >> bits) << bits) | np.arange(len(h), dtype=U64), length - anchor + 1)
    spot = (least & ((U64(1) << bits) - U64(1))).astype(np.int64)
    size = np.diff(offsets)
    valid = np.zeros(len(data) + 1, np.int64)
    has = size >= length
    np.add.at(valid, offsets[:-1][has], 1)
    np.add.at(valid, offsets[1:][has] - length + 1, -1)
    starts = np.flatnonzero(np.cumsum(valid[: len(least)]) > 0)
    spot = spot[starts]
    new = np.ones(len(starts), bool)  # windows of two documents are never in a row
    new[1:] = (spot[1:] != spot[:-1]) | (starts[1:] - starts[:-1] != 1)
    at = np.flatnonzero(new)
    first, spot = starts[at], spot[at]
    return np.searchsorted(offsets, first, side="right") - 1, first, np.diff(np.append(at, len(starts))), spot, h[spot]


def _anchor_sets(length: int, anchor: int, parts: int, many: int):
    def sets(table: pa.Table) -> pa.Table:
        steady_memory()
        table = ordered(table)
        h = anchored_runs(*text_bytes(table["text"]), length, anchor)[4]
        back, count = np.unique(h, return_inverse=True, return_counts=True)[1:]
        return flagged_set(table["bucket"][0].as_py(), h, count[back] >= many, parts)

    return sets


def _window_rows(h: np.ndarray, parts: int, bucket: int) -> pa.Table:
    """Window hashes as rows for their partitions; one that the bucket holds more than once goes twice."""
    values, count = np.unique(h, return_counts=True)
    values = np.repeat(values, np.minimum(count, 2))
    part = split_hash(values, parts)[0]
    order = np.argsort(part, kind="stable")
    rows = set_rows(bucket, part[order], values[order])
    n = rows.num_rows
    return pa.table({
        "part": rows["part"], "anchor": pa.nulls(n, pa.int64()), "bucket": rows["bucket"],
        "places": pa.nulls(n, pa.binary()), "shift": pa.nulls(n, pa.int32()), "text": rows["payload"],
    })


def _repeated_hashes(table: pa.Table) -> pa.Table:
    """Each bucket's window hashes that a partition got at least twice, as spans without a document."""
    cells = [np.frombuffer(c, U64) for c in table["text"].to_pylist()]
    h = np.concatenate(cells)
    who = np.repeat(np.arange(len(cells)), [len(c) for c in cells])
    order = np.argsort(h, kind="stable")
    at = runs(h[order])
    size = np.diff(np.append(at, len(h)))
    again = order[np.repeat(size > 1, size)]
    buckets = np.array(table["bucket"].to_pylist(), np.int64)[who[again]]
    by = np.argsort(buckets, kind="stable")
    answer = answer_rows(0, 0, buckets[by], h[again[by]])
    return pa.table({"bucket": answer["bucket"], "doc": pa.nulls(answer.num_rows, pa.int32()), "spans": answer["payload"]})


def _repeated_runs(length: int, anchor: int, parts: int):
    def cut(table: pa.Table, answers: pa.Table) -> pa.Table:
        schema = pa.schema([("part", pa.int64()), ("anchor", pa.int64()), ("bucket", pa.int64()), ("places", pa.binary()), ("shift", pa.int32()), ("text", pa.binary())])
        if not table.num_rows or not answers.num_rows:
            return schema.empty_table()
        steady_memory()
        table = ordered(table)
        data, offsets = text_bytes(table["text"])
        doc, first, count, spot, h = anchored_runs(data, offsets, length, anchor)
        spots = place(h, parts)
        some = np.flatnonzero(member(spots, looked_up(answers)))
        crowded = np.flatnonzero(member(spots, looked_up(answers, 1)))
        raw = data.tobytes()
        places: dict[bytes, list[int]] = defaultdict(list)  # a run that repeats within the bucket goes out once
        kind: dict[bytes, int] = {}
        for k, a, n, d, o in zip(some.tolist(), first[some].tolist(), count[some].tolist(), doc[some].tolist(), offsets[doc[some]].tolist()):
            text = raw[a : a + n + length - 1]
            places[text] += (d, a - o)
            kind.setdefault(text, k)
        one = np.fromiter(kind.values(), np.int64, len(kind))
        runs_out = pa.table({
            "part": pa.array(split_hash(h[one], parts)[0].astype(np.int64), pa.int64()),
            "anchor": pa.array(h[one].view(np.int64), pa.int64()),
            "bucket": pa.array(np.full(len(one), table["bucket"][0].as_py()), pa.int64()),
            "places": pa.array([np.array(x, np.int64).tobytes() for x in places.values()], pa.binary()),
            "shift": pa.array(spot[one] - first[one], pa.int32()),
            "text": pa.array(list(places), pa.binary()),
        }, schema=schema)
        if not len(crowded):
            return runs_out
        n = count[crowded]
        windows = np.arange(n.sum()) + np.repeat(first[crowded] - (np.cumsum(n) - n), n)
        return pa.concat_tables([runs_out, _window_rows(rolling(data, length)[windows], parts, table["bucket"][0].as_py()).cast(schema)])

    return cut


def _symbols(texts: list[bytes], shift: list[int]) -> list[np.ndarray]:
    """Texts as symbols of BLOCK bytes, cut so that a symbol starts at `shift`; whole symbols only."""
    cut = [np.frombuffer(t, U64, (len(t) - s % BLOCK) // BLOCK * 2, s % BLOCK).reshape(-1, 2) for t, s in zip(texts, shift)]
    both = np.concatenate(cut)
    names = np.unique(mix(both[:, 0]) * U64(0x9FB21C651E98DF25) + mix(both[:, 1], 1), return_inverse=True)[1] + 1
    names = names.astype(np.uint16 if names.max(initial=0) < 1 << 16 else np.uint32)
    return np.split(names, np.cumsum([len(c) for c in cut])[:-1])


def _repeated_windows(texts: list[bytes], shift: list[int], length: int) -> list[np.ndarray]:
    """Starts of the windows of `length` bytes that occur elsewhere in the collection.

    A repeated window has the same anchor at the same place, so its whole symbols
    are repeated too: the sorted suffixes give every place where enough symbols
    in a row repeat.  The few bytes at either end are then compared by the hash
    of the window.
    """
    least = (length - 2 * (BLOCK - 1)) // BLOCK
    rows, places, hashes = [], [], []
    for i, starts in enumerate(repeated_starts(_symbols(texts, shift), least)):
        if len(starts):
            first = starts * BLOCK + shift[i] % BLOCK
            near = np.unique((first[:, None] - np.arange(BLOCK)).ravel())
            near = near[(near >= 0) & (near + length <= len(texts[i]))]
            rows.append(np.full(len(near), i))
            places.append(near)
            hashes.append(rolling(np.frombuffer(texts[i], np.uint8), length)[near])
    if not rows:
        return [np.zeros(0, np.int64)] * len(texts)
    row, at = np.concatenate(rows), np.concatenate(places)
    _, back, count = np.unique(np.concatenate(hashes), return_inverse=True, return_counts=True)
    same = count[back] > 1
    row, at = row[same], at[same]
    return np.split(at, np.searchsorted(row, np.arange(1, len(texts))))


def _repeated_spans(length: int, batch: int):
    def find(table: pa.Table) -> pa.Table:
        windows = table.filter(pc.is_null(table["anchor"]))
        table = table.filter(pc.is_valid(table["anchor"]))
        texts = table["text"].to_pylist()
        by_anchor: dict[int, dict[bytes, int]] = defaultdict(dict)
        copies: dict[bytes, int] = defaultdict(int)
        places = [np.frombuffer(p, np.int64).reshape(-1, 2) for p in table["places"].to_pylist()]
        for a, t, s, p in zip(table["anchor"].to_pylist(), texts, table["shift"].to_pylist(), places):
            by_anchor[a][t] = s
            copies[t] += len(p)
        spans: dict[bytes, list[tuple[int, int]]] = {t: [(0, len(t))] for t, n in copies.items() if n > 1}
        waiting: dict[bytes, int] = {}

        def work() -> None:
            for t, at in zip(waiting, _repeated_windows(list(waiting), list(waiting.values()), length)):
                if copies[t] == 1 and len(at):
                    cuts = np.concatenate(([0], np.flatnonzero(np.diff(at) > length) + 1, [len(at)]))
                    spans[t] = [(int(at[a]), int(at[b - 1]) + length) for a, b in zip(cuts, cuts[1:])]
            waiting.clear()

        for group in by_anchor.values():
            if len(group) > 1:
                if waiting and len(waiting) + len(group) > batch:
                    work()
                waiting.update(group)
        if waiting:
            work()
        out: dict[tuple[int, int], list[int]] = defaultdict(list)
        for t, b, p in zip(texts, table["bucket"].to_pylist(), places):
            for x, y in spans.get(t, ()):
                for d, s in p.tolist():
                    out[b, d] += (s + x, s + y)
        keys = list(out)
        found = pa.table({"bucket": pa.array([k[0] for k in keys], pa.int64()), "doc": pa.array([k[1] for k in keys], pa.int32()), "spans": pa.array([np.array(out[k], np.int64).tobytes() for k in keys], pa.binary())})
        return pa.concat_tables([found, _repeated_hashes(windows)]) if windows.num_rows else found

    return find


def _removed(texts: bool, length: int):
    def remove(table: pa.Table, found: pa.Table) -> pa.Table:
        steady_memory()
        table = ordered(table)
        spans: dict[int, list[np.ndarray]] = defaultdict(list)
        again: list[np.ndarray] = []
        if found.num_rows:
            for d, cell in zip(found["doc"].to_pylist(), found["spans"].to_pylist()):
                if d is None:
                    again.append(np.frombuffer(cell, U64))
                else:
                    spans[d].append(np.frombuffer(cell, np.int64))
        if again:
            data, offsets = text_bytes(table["text"])
            at = np.flatnonzero(member(rolling(data, length), np.unique(np.concatenate(again))))
            doc = np.searchsorted(offsets, at, side="right") - 1
            inside = at + length <= offsets[doc + 1]
            at, doc = (at - offsets[doc])[inside], doc[inside]
            starts = runs(doc)
            for a, b in zip(starts, np.append(starts[1:], len(doc))):
                spans[int(doc[a])].append(np.stack((at[a:b], at[a:b] + length), axis=1).ravel())
        rows: dict[str, list] = {k: [] for k in ("n_bytes", "n_removed", "n_spans", "kept_sha256", "kept")}
        for i, text in enumerate(table["text"].to_pylist()):
            raw, lost, n = (text or "").encode(), 0, 0
            rows["n_bytes"].append(len(raw))
            if i in spans:
                flat = np.concatenate(spans[i])
                gone = covered(flat[0::2], flat[1::2], len(raw))
                lost = int(gone.sum())
                n = int((gone & ~np.concatenate(([False], gone[:-1]))).sum())
                raw = np.frombuffer(raw, np.uint8)[~gone].tobytes()
            rows["n_removed"].append(lost)
            rows["n_spans"].append(n)
            rows["kept_sha256"].append(hashlib.sha256(raw).hexdigest())
            rows["kept"].append(raw.decode(errors="ignore") if texts else None)
        return pa.table({"doc_id": table["doc_id"], **{k: pa.array(v, pa.string() if k.startswith("kept") else pa.int64()) for k, v in rows.items()}})

    return remove


def dedup_suffixes(docs: DataFrame, length: int = 400, anchor: int = ANCHOR, batch: int = 700, id_col: str = "doc_id", text_col: str = "text", texts: bool = True, many: tuple[int, int] = (MANY_RUNS, MANY_BUCKETS)) -> DataFrame:
    """Remove every byte covered by a string of `length` bytes that also starts anywhere else.

    Texts are UTF-8 bytes; a match lies within one document; strings are judged
    on the input.  Returns doc_id, n_bytes, n_removed, n_spans (maximal removed
    runs), kept_sha256 of the kept bytes, and kept, those as text without characters
    that were cut in two (null unless `texts`).

    A null or empty text has no bytes; a null id is a document like any other;
    rows that repeat an id or a whole row are separate documents, so repeated
    rows of at least `length` bytes lose everything.  An empty table gives no rows.
    """
    layout = Layout(docs, text_col)
    parts = layout.parts
    texts_in = bucketed(docs, layout, id_col, text_col)
    sets = texts_in.groupBy("bucket").applyInArrow(_anchor_sets(length, anchor, parts, many[0]), "part long, bucket long, payload binary")
    repeated = sets.groupBy("part").applyInArrow(lambda t: repeated_answer(t, False, many[1]), ANSWER)
    found = texts_in.groupBy("bucket").cogroup(repeated.groupBy("bucket")).applyInArrow(_repeated_runs(length, anchor, parts), RUN)
    spans = found.groupBy("part").applyInArrow(_repeated_spans(length, batch), SPAN)
    return texts_in.groupBy("bucket").cogroup(spans.groupBy("bucket")).applyInArrow(_removed(texts, length), RESULT)

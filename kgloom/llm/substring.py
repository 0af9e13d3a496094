"""Substring dedup: fixed-block anchors.

Every document's words are cut into non-overlapping blocks of half a window.
Whatever repeats for a whole window holds one such block entirely, so blocks
are the index, and every rolling block-long window is a probe of it.  Probes
that hit (and indexed blocks that were hit) are extended window by window to
the maximal exact repeats; all but the first occurrence of a window is removed.
"""

from __future__ import annotations

import hashlib
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .arrays import Words, covered, concat, member, runs, text_bytes
from .buckets import ANSWER, Layout, answer_rows, bucketed, flagged_set, looked_up, ordered, place, repeated_answer, split_hash

U64 = np.uint64
RESULT = "doc_id long, n_words long, n_removed long, kept_sha256 string, kept string"


def _anchor_sets(block: int, parts: int):
    def sets(table: pa.Table) -> pa.Table:
        table = ordered(table)
        words = Words(*text_bytes(table["text"]))
        at, h = words.windows(block)
        aligned = (at - words.first[words.doc[at]]) % block == 0
        return flagged_set(table["bucket"][0].as_py(), h, aligned, parts)

    return sets


def _candidate_sets(block: int, window: int, parts: int):
    """Windows around hit probes: hash and the smallest document of this bucket that holds it."""

    def sets(table: pa.Table, answers: pa.Table) -> pa.Table:
        schema = pa.schema([("part", pa.int64()), ("bucket", pa.int64()), ("payload", pa.binary())])
        if not table.num_rows or not answers.num_rows:
            return schema.empty_table()
        table = ordered(table)
        words = Words(*text_bytes(table["text"]))
        at, h = words.windows(block)
        hits = np.zeros(len(words.starts) + 1, np.int64)
        hits[1:][at[member(place(h, parts), looked_up(answers))]] = 1
        hits = np.cumsum(hits)
        at, h = words.windows(window)
        check = _check(words, window)
        some = hits[at + window - block + 1] > hits[at]
        at, h, check = at[some], h[some], check[some]
        ids = np.array([-(1 << 62) if i is None else i for i in table["doc_id"].to_pylist()], np.int64)
        part, _ = split_hash(h, parts)
        order = np.lexsort((at, check, h, part))
        h, check, part, doc = h[order], check[order], part[order], ids[words.doc[at[order]]]
        first = _runs2(h, check)
        multi = np.diff(np.append(first, len(h))) > 1
        cell = np.zeros(len(first), [("h", U64), ("check", np.uint32), ("doc", np.int64), ("multi", np.bool_)])
        cell["h"], cell["check"], cell["doc"], cell["multi"] = h[first], check[first], doc[first], multi
        part = part[first]
        cuts = runs(part)
        ends = np.append(cuts[1:], len(part))
        return pa.table({
            "part": pa.array(part[cuts].astype(np.int64), pa.int64()),
            "bucket": pa.array(np.full(len(cuts), table["bucket"][0].as_py()), pa.int64()),
            "payload": pa.array([_pack(cell[a:b]) for a, b in zip(cuts, ends)], pa.binary()),
        }, schema=schema)

    return sets


def _check(words: Words, window: int) -> np.ndarray:
    """32 more bits of every window from other word hashes: with them, 96 bits stand for a window."""
    return (words.windows(window, 1)[1] >> U64(32)).astype(np.uint32)


def _runs2(h: np.ndarray, check: np.ndarray) -> np.ndarray:
    """Where each run of equal (h, check) starts."""
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (check[1:] != check[:-1])
    return np.flatnonzero(new)


def _pack(cell: np.ndarray) -> bytes:
    """Column by column: equal high bytes lie together, and the shuffle compresses them."""
    n = np.array([len(cell)], np.int64).tobytes()
    planes = cell["doc"].copy().view(np.uint8).reshape(-1, 8).T.copy()
    return n + cell["h"].tobytes() + cell["check"].tobytes() + planes.tobytes() + np.packbits(cell["multi"]).tobytes()


def _unpack(payload: bytes) -> tuple[np.ndarray, ...]:
    n = int(np.frombuffer(payload, np.int64, 1)[0])
    h = np.frombuffer(payload, U64, n, 8)
    check = np.frombuffer(payload, np.uint32, n, 8 + 8 * n)
    planes = np.frombuffer(payload, np.uint8, 8 * n, 8 + 12 * n).reshape(8, n)
    multi = np.unpackbits(np.frombuffer(payload, np.uint8, -1, 8 + 20 * n), count=n).astype(bool) if n else np.zeros(0, bool)
    return h, check, np.ascontiguousarray(planes.T).view(np.int64).ravel(), multi


#: A window as it is answered.
WINDOW = np.dtype([("h", U64), ("check", np.uint32)])


def _first_owner(table: pa.Table) -> pa.Table:
    """Kind 1: the window starts earlier in another bucket. Kind 0: it is first here, and repeats here."""
    buckets = np.array(table["bucket"].to_pylist(), np.int64)
    cells = [_unpack(c) for c in table["payload"].to_pylist()]
    owner = np.repeat(buckets, [len(c[0]) for c in cells])
    h, check, doc, multi = (np.concatenate([c[k] for c in cells]) for k in range(4))
    order = np.lexsort((doc, check, h))
    h, check, owner, multi = h[order], check[order], owner[order], multi[order]
    first = np.zeros(len(h), bool)
    first[_runs2(h, check)] = True
    answer = np.zeros(len(h), WINDOW)
    answer["h"], answer["check"] = h, check
    part, out = table["part"][0].as_py(), []
    for kind, which in ((1, ~first), (0, first & multi)):
        by = np.argsort(owner[which], kind="stable")
        out.append(answer_rows(part, kind, owner[which][by], answer[which][by]))
    return pa.concat_tables(out)


def _told(h: np.ndarray, check: np.ndarray, answers: np.ndarray) -> np.ndarray:
    """Which windows are among the answers: by hash, and by hash and check together."""
    both = lambda x, c: x * U64(0xD1342543DE82EF95) + c.astype(U64)
    hit = member(h, np.sort(answers["h"]))
    some = np.flatnonzero(hit)
    hit[some] = member(both(h[some], check[some]), np.sort(both(answers["h"], answers["check"])))
    return hit


def _removed(window: int, texts: bool):
    def remove(table: pa.Table, answers: pa.Table) -> pa.Table:
        table = ordered(table)
        words = Words(*text_bytes(table["text"]))
        at, h = words.windows(window)
        gone = np.zeros(len(at), bool)
        if answers.num_rows:
            kinds = np.array(answers["kind"].to_pylist())
            cells = answers["payload"].to_pylist()
            check = _check(words, window)
            get = lambda k: concat([cells[i] for i in np.flatnonzero(kinds == k)], WINDOW)[0]
            gone = _told(h, check, get(1))
            here = np.flatnonzero(_told(h, check, get(0)))
            order = here[np.lexsort((here, check[here], h[here]))]
            late = np.ones(len(here), bool)
            late[_runs2(h[order], check[order])] = False
            gone[order[late]] = True
        drop = covered(at[gone], at[gone] + window, len(words.starts))
        lost = np.add.reduceat(np.append(drop, False).astype(np.int64), words.first[:-1]) * (words.n > 0) if table.num_rows else words.n
        digests, kept = [], []
        for i, text in enumerate(table["text"].to_pylist()):
            own = (text or "").encode().split()
            if lost[i]:
                own = compress(own, ~drop[words.first[i] : words.first[i + 1]])
            rest = b" ".join(own)
            digests.append(hashlib.sha256(rest).hexdigest())
            kept.append(rest.decode() if texts else None)
        return pa.table({"doc_id": table["doc_id"], "n_words": pa.array(words.n, pa.int64()), "n_removed": pa.array(lost, pa.int64()), "kept_sha256": pa.array(digests, pa.string()), "kept": pa.array(kept, pa.string())})

    return remove


def dedup_substrings(docs: DataFrame, window: int = 20, id_col: str = "doc_id", text_col: str = "text", texts: bool = True) -> DataFrame:
    """Remove every word covered by a window of `window` words that also starts earlier.

    Earlier: a smaller id, or an earlier start in the same document; windows are
    judged on the input.  Returns doc_id, n_words, n_removed, kept_sha256 and the
    kept text (null unless `texts`), a row for each input row.

    A null or empty text has no words.  A null id counts as the smallest.  Rows
    with the same id are ordered by text.  An empty table gives no rows; other
    columns are ignored.
    """
    block = (window + 1) // 2
    layout = Layout(docs, text_col)
    parts = layout.parts
    texts_in = bucketed(docs, layout, id_col, text_col)
    sets = texts_in.groupBy("bucket").applyInArrow(_anchor_sets(block, parts), "part long, bucket long, payload binary")
    hits = sets.groupBy("part").applyInArrow(lambda t: repeated_answer(t, True), ANSWER)
    windows = texts_in.groupBy("bucket").cogroup(hits.groupBy("bucket")).applyInArrow(_candidate_sets(block, window, parts), "part long, bucket long, payload binary")
    firsts = windows.groupBy("part").applyInArrow(_first_owner, ANSWER)
    return texts_in.groupBy("bucket").cogroup(firsts.groupBy("bucket")).applyInArrow(_removed(window, texts), RESULT)

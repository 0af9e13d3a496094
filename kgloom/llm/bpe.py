"""Byte-level BPE encoding and decoding by recursive queries over token positions.

A partition's distinct words become rows (word, position, token).  A recursive
query joins neighbours with the merge table and contracts, in every word at
once, the leftmost pair of least rank, until no word has a pair that merges.
An ordered aggregation of the vocabulary's bytes decodes the result.

The query keeps the rows of all rounds, about n * n / 2 for a word of n bytes.
So a call gets words of ROWS_AT_ONCE such rows at most, and a word of over LONG
bytes is contracted in the same order by a heap of its pairs instead.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import os
import tempfile
from functools import lru_cache

import duckdb
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .arrays import text_bytes
from .pretokens import WordTable, slices

RESULT = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string, ids binary"

#: One round contracts one pair in every word that still has one.  A row is a token
#: with its neighbour to the right: where that stands, what it is, what the two merge to.
ENCODE = """
WITH RECURSIVE step(w, round, pos, after, tok, next_tok, pair) AS (
    SELECT s.w, 0, s.pos, s.after, s.tok, s.next_tok, m.id
    FROM symbols s LEFT JOIN merges m ON m.k = s.tok::BIGINT << 32 | s.next_tok
  UNION ALL
    SELECT s.w, s.round, s.pos, s.after, s.tok, s.next_tok, CASE WHEN s.fresh THEN m.id ELSE s.pair END
    FROM (SELECT t.w, t.round + 1 AS round, t.pos, t.pair, t.pos = best.pos OR t.after = best.pos AS fresh,
                 CASE WHEN t.pos = best.pos THEN best.id ELSE t.tok END AS tok,
                 CASE WHEN t.pos = best.pos THEN gone.after ELSE t.after END AS after,
                 CASE WHEN t.pos = best.pos THEN gone.next_tok WHEN t.after = best.pos THEN best.id ELSE t.next_tok END AS next_tok
          FROM step t
          JOIN (SELECT w, least & 4294967295 AS pos, least >> 32 AS id, gone
                FROM (SELECT w, min((pair::BIGINT << 32) | pos) AS least, arg_min(after, (pair::BIGINT << 32) | pos) AS gone
                      FROM step WHERE pair IS NOT NULL GROUP BY w)) best ON best.w = t.w
          JOIN step gone ON gone.w = best.w AND gone.pos = best.gone
          WHERE t.pos <> best.gone) s
    LEFT JOIN merges m ON m.k = CASE WHEN s.fresh THEN s.tok::BIGINT << 32 | s.next_tok END
),
done AS (SELECT w, max(round) AS round FROM step GROUP BY w)
SELECT w, list(tok ORDER BY pos) AS ids FROM step JOIN done USING (w, round) GROUP BY w ORDER BY w
"""
DECODE = """
SELECT t.w, string_agg(v.hex, '' ORDER BY t.pos) AS hex
FROM tokens t JOIN vocab v ON v.id = t.tok GROUP BY t.w ORDER BY t.w
"""
WORDS_AT_ONCE = 20_000
ROWS_AT_ONCE = 2_000_000
LONG = 512


def contracted(tok: list[int], merges: dict[tuple[int, int], int]) -> list[int]:
    """Tokens of one word once no pair merges, the leftmost pair of least rank first."""
    n = len(tok)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    heap = [(merges[p], i, *p) for i, p in enumerate(zip(tok, tok[1:])) if p in merges]
    heapq.heapify(heap)
    while heap:
        merged, i, a, b = heapq.heappop(heap)
        j = after[i]
        if tok[i] != a or j == n or tok[j] != b:  # one of the two has merged since
            continue
        tok[i], tok[j] = merged, -1
        after[i] = k = after[j]
        if k < n:
            before[k] = i
        for x, y in ((before[i], i), (i, k)):
            if x >= 0 and y < n and (tok[x], tok[y]) in merges:
                heapq.heappush(heap, (merges[tok[x], tok[y]], x, tok[x], tok[y]))
    return [t for t in tok if t >= 0]


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in lines if line.strip())}


class Codec:
    """A tokenizer's ranks as tables of an in-process DuckDB."""

    def __init__(self, ranks: dict[bytes, int]):
        self.symbol = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        cuts = [(ranks[t[:k]], ranks[t[k:]], i) for t, i in ranks.items() for k in range(1, len(t)) if t[:k] in ranks and t[k:] in ranks]
        self.merges = {(a, b): c for a, b, c in cuts}
        a, b, c = (pa.array(x, pa.int32()) for x in zip(*cuts)) if cuts else (pa.array([], pa.int32()),) * 3
        self.db = duckdb.connect(config={"threads": 1, "memory_limit": "250MB", "temp_directory": os.path.join(tempfile.gettempdir(), "bpe")})
        for name, table in (("merges", pa.table({"k": pa.array((np.array(a, np.int64) << 32) | np.array(b, np.int64)), "id": c})), ("vocab", pa.table({"id": pa.array(list(ranks.values()), pa.int32()), "hex": [t.hex() for t in ranks]}))):
            self.db.register("given", table)
            self.db.execute(f"CREATE TABLE {name} AS SELECT * FROM given")
            self.db.unregister("given")

    def _rows(self, query: str, name: str, lengths: np.ndarray, tok: np.ndarray) -> list:
        start = np.cumsum(lengths) - lengths
        pos = np.arange(len(tok)) - np.repeat(start, lengths)
        last = pos == np.repeat(lengths, lengths) - 1
        self.db.register(name, pa.table({
            "w": pa.array(np.repeat(np.arange(len(lengths)), lengths), pa.int32()),
            "pos": pa.array(pos, pa.int32()),
            "after": pa.array(pos + 1, pa.int32(), mask=last),
            "tok": pa.array(tok, pa.int32()),
            "next_tok": pa.array(np.append(tok[1:], 0), pa.int32(), mask=last),
        }))
        found = self.db.sql(query).to_arrow_table()
        self.db.unregister(name)
        return found.column(1).to_pylist()

    def encode(self, words: list[bytes]) -> list[list[int]]:
        """Ids of each (not empty) word."""
        size = np.array([len(w) for w in words], np.int64)
        out: list[list[int]] = [[]] * len(words)
        for i in np.flatnonzero(size > LONG).tolist():
            out[i] = contracted(self.symbol[np.frombuffer(words[i], np.uint8)].tolist(), self.merges)
        short = np.flatnonzero(size <= LONG)
        rows = np.cumsum(size[short] * (size[short] + 1) // 2)
        a = 0
        while a < len(short):
            most = int(np.searchsorted(rows, (rows[a - 1] if a else 0) + ROWS_AT_ONCE, side="right"))
            some = short[a : min(a + WORDS_AT_ONCE, max(a + 1, most))].tolist()
            for i, ids in zip(some, self._rows(ENCODE, "symbols", size[some], self.symbol[np.frombuffer(b"".join(words[i] for i in some), np.uint8)])):
                out[i] = ids
            a += len(some)
        return out

    def decode(self, words: list[list[int]]) -> list[bytes]:
        """Bytes of each (not empty) list of ids."""
        out: list[bytes] = []
        for a in range(0, len(words), WORDS_AT_ONCE):
            some = words[a : a + WORDS_AT_ONCE]
            out += map(bytes.fromhex, self._rows(DECODE, "tokens", np.array([len(w) for w in some]), np.array([i for w in some for i in w], np.int32)))
        return out


@lru_cache(maxsize=2)
def _codec(path: str) -> tuple[Codec, WordTable]:
    codec = Codec(read_ranks(path))
    return codec, WordTable(codec.encode, codec.decode)


def _encoded(path: str, keep_ids: bool):
    def encode(batches):
        table = _codec(path)[1]
        for batch in batches:
            data, offsets = text_bytes(batch.column("text"))
            for a, b in slices(offsets):
                ids, n, back, size = table.encode(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
                raw, end = ids.astype("<u4").tobytes(), np.concatenate(([0], np.cumsum(n))) * 4
                text, stop = back.tobytes(), np.concatenate(([0], np.cumsum(size)))
                cells = [raw[x:y] for x, y in zip(end, end[1:])]
                yield pa.RecordBatch.from_pydict({
                    "doc_id": batch.column("doc_id").slice(a, b - a),
                    "n_tokens": pa.array(n, pa.int64()),
                    "ids_sha256": pa.array([hashlib.sha256(c).hexdigest() for c in cells], pa.string()),
                    "decoded_sha256": pa.array([hashlib.sha256(text[x:y]).hexdigest() for x, y in zip(stop, stop[1:])], pa.string()),
                    "ids": pa.array(cells if keep_ids else [None] * (b - a), pa.binary()),
                })

    return encode


def encode_texts(docs: DataFrame, ranks_path: str, id_col: str = "doc_id", text_col: str = "text", ids: bool = True) -> DataFrame:
    """Encode every text by the merge ranks of a file and decode the ids again.

    Returns doc_id, n_tokens, ids_sha256 (of little-endian unsigned 32-bit ids),
    decoded_sha256 and the ids as such bytes (null unless `ids`), a row for each
    input row.  A null or empty text has no tokens.  No special tokens: their
    strings are ordinary text.  Rows may repeat; other columns are ignored.
    `ranks_path` is a file that every executor can open.
    """
    return docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].alias("text")).mapInArrow(_encoded(ranks_path, ids), RESULT)

"""Token ids in binary files: patched frame-of-reference blocks with an index.

Documents are sorted by id over range partitions; each partition writes one file
of segments.  A segment holds whole documents, about SEGMENT ids: their ids and
lengths, the start of every block, and the blocks.  Segments are self-contained,
so readers split a file anywhere between them.
"""

from __future__ import annotations

import os
import re
import uuid
import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .arrays import text_bytes
from .buckets import Layout, shared_dir
from .pfor import pack, unpack
from .pretokens import WordTable, slices

SEGMENT = 1 << 18
#: file and segment give the order; doc_ids are int64, lengths uint32, blocks_at uint32
SEGMENT_ROW = "file long, segment long, n_ids long, doc_ids binary, no_id binary, lengths binary, blocks_at binary, blocks binary"
DOCUMENT = "file long, segment long, doc_id long, local long, n_tokens long, ids_crc32 long, ids binary"


class _Encoder:
    """The library's ids of whole texts, taken word by word where a text holds no added token.

    The library finds its added tokens before it looks for words, so a text that
    holds the string of one is given to it whole.
    """

    def __init__(self, whole, table: WordTable):
        self.whole, self.table = whole, table
        self.added = [t.content.encode() for t in whole.get_added_tokens_decoder().values()]

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all documents end to end and their number in each."""
        ids, n = self.table.encode(data, offsets)[:2]
        raw = data.tobytes()
        docs = sorted({int(np.searchsorted(offsets, m.start(), side="right")) - 1 for t in self.added for m in re.finditer(re.escape(t), raw)})
        if docs:
            texts = [raw[offsets[i] : offsets[i + 1]].decode() for i in docs]
            cells = np.split(ids, np.cumsum(n)[:-1])
            for i, found in zip(docs, self.whole.encode_batch(texts, add_special_tokens=False)):
                cells[i] = np.array(found.ids, ids.dtype)
            ids, n = np.concatenate(cells), np.array([len(c) for c in cells], n.dtype)
        return ids, n


@lru_cache(maxsize=2)
def _words(path: str) -> _Encoder:
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True
    table = WordTable(lambda words: [e.ids for e in tokenizer.encode_batch_fast([w.decode() for w in words], add_special_tokens=False)])
    return _Encoder(Tokenizer.from_file(path), table)


def _segments(path: str, end_id: int):
    def write(batches):
        table, file, number = _words(path), TaskContext.get().partitionId(), 0
        ids_held, docs_held = [], []

        def row():
            nonlocal number
            ids = np.concatenate(ids_held)
            docs = [d for d, _ in docs_held]
            blocks, at = pack(ids)
            lengths = np.concatenate([n for _, n in docs_held]).astype(np.uint32)
            names = pa.concat_arrays(docs)
            out = pa.RecordBatch.from_pydict({
                "file": pa.array([file], pa.int64()), "segment": pa.array([number], pa.int64()), "n_ids": pa.array([len(ids)], pa.int64()),
                "doc_ids": pa.array([names.fill_null(0).to_numpy().tobytes()], pa.binary()), "no_id": pa.array([np.asarray(names.is_null()).tobytes()], pa.binary()),
                "lengths": pa.array([lengths.tobytes()], pa.binary()), "blocks_at": pa.array([at.tobytes()], pa.binary()), "blocks": pa.array([blocks], pa.binary()),
            })
            ids_held.clear()
            docs_held.clear()
            number += 1
            return out

        for batch in batches:
            data, offsets = text_bytes(batch.column("text"))
            for a, b in slices(offsets, 1 << 20):
                ids, n = table.encode(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
                ends = np.cumsum(n)
                ids_held.append(np.insert(ids, ends, np.uint32(end_id)))
                docs_held.append((batch.column("doc_id").slice(a, b - a), n + 1))
                if sum(map(len, ids_held)) >= SEGMENT:
                    yield row()
        if docs_held:
            yield row()

    return write


def _documents(keep_ids: bool):
    def read(batches):
        for batch in batches:
            for r in batch.to_pylist():
                lengths = np.frombuffer(r["lengths"], np.uint32).astype(np.int64)
                raw = unpack(r["blocks"], np.frombuffer(r["blocks_at"], np.uint32), r["n_ids"]).astype("<u4").tobytes()
                ends = np.cumsum(lengths)
                cells = [raw[4 * a : 4 * b] for a, b in zip((ends - lengths).tolist(), ends.tolist())]
                n = len(lengths)
                yield pa.RecordBatch.from_pydict({
                    "file": pa.array([r["file"]] * n, pa.int64()), "segment": pa.array([r["segment"]] * n, pa.int64()),
                    "doc_id": pa.array(np.frombuffer(r["doc_ids"], np.int64), pa.int64(), mask=np.frombuffer(r["no_id"], bool)),
                    "local": pa.array(ends - lengths, pa.int64()), "n_tokens": pa.array(lengths, pa.int64()),
                    "ids_crc32": pa.array([zlib.crc32(c) for c in cells], pa.int64()), "ids": pa.array(cells if keep_ids else [None] * n, pa.binary()),
                })

    return read


def write_token_files(docs: DataFrame, tokenizer_path: str, out: str, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Write the ids of every text, each closed by `end_id`, in ascending id order.

    A null or empty text has only the end id.  A null id comes first; rows that
    share an id are ordered by text.  An empty table writes an empty store.
    """
    rows = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].alias("text"))
    files = Layout(rows, "text").parts
    key = F.col("doc_id").asc_nulls_first()
    rows = rows.repartitionByRange(files, key).sortWithinPartitions(key, F.col("text").asc_nulls_first())
    rows.mapInArrow(_segments(tokenizer_path, end_id), SEGMENT_ROW).write.parquet(out)


def read_token_files(spark: SparkSession, path: str, ids: bool = True) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens, ids_crc32 and the ids as uint32 bytes."""
    segments = spark.read.schema(SEGMENT_ROW).parquet(path)
    # one number for each file and segment; a window within a file, then the files' totals
    sizes = segments.select("file", "segment", "n_ids")
    within = sizes.withColumn("before", F.expr("coalesce(sum(n_ids) OVER (PARTITION BY file ORDER BY segment ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)"))
    total, bases = 0, []
    for file, n in sizes.groupBy("file").agg(F.sum("n_ids")).orderBy("file").collect():  # a row for each file
        bases.append((file, total))
        total += n
    base = spark.createDataFrame(bases, "file long, base long")
    starts = within.join(base, "file").select("file", "segment", (F.col("base") + F.col("before")).alias("first"))
    found = segments.mapInArrow(_documents(ids), DOCUMENT)
    return found.join(starts, ["file", "segment"]).select("doc_id", (F.col("first") + F.col("local")).alias("start"), "n_tokens", "ids_crc32", "ids")


def store_path(spark: SparkSession) -> str:
    """A new folder in the shared one."""
    return f"{shared_dir(spark)}/token-ids-{uuid.uuid4().hex}"

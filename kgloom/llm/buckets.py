"""Exchange of compact hash sets between buckets of documents.

Several operators ask of every window of every text "does this also occur
elsewhere?".  Shuffling a row for each window would move many times the input,
and a frequent window would gather in one task.  Here documents are dealt into
buckets of a few MB by a hash of their id.  A bucket sends each distinct hash
once, as packed integers, one row for each hash partition; the partition
answers each bucket with the hashes that matter to it.  A window that a third
of all rows hold is one entry for each bucket at most, whatever its count.
"""

from __future__ import annotations

import math
import tempfile

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .arrays import runs

U64 = np.uint64
BUCKET_BYTES = 3 << 20
PART_BYTES = 16 << 20
ANSWER = "bucket long, part long, kind int, payload binary"
SET = "part long, bucket long, payload binary"


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share; in local mode a local one is set where the session has none."""
    context = spark.sparkContext
    if not spark.conf.get("spark.checkpoint.dir", None) and not context.getCheckpointDir():
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="kgloom-checkpoint-"))
    return context.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir")


def cut(df: DataFrame) -> DataFrame:
    """Lineage ends here: the rows are in the shared folder, so lost executors cost nothing."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


class Layout:
    """How many buckets and partitions a corpus of so many bytes needs."""

    def __init__(self, docs: DataFrame, text: str = "text", bucket_bytes: int = BUCKET_BYTES, part_bytes: int = PART_BYTES):
        total = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
        least = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
        least = min(least, max(1, math.ceil(total / (1 << 16))))
        self.total = total
        self.buckets = max(least, math.ceil(total / bucket_bytes))
        self.parts = max(least, math.ceil(total / part_bytes))


PACKED = "bucket long, rows binary"


def _packed(batches):
    """A batch's rows of each bucket as one compressed Arrow stream."""
    options = pa.ipc.IpcWriteOptions(compression="zstd")
    for batch in batches:
        bucket = batch.column(0).to_numpy()
        order = np.argsort(bucket, kind="stable")
        at = runs(bucket[order])
        rows = pa.Table.from_batches([batch.select(batch.schema.names[1:])]).take(pa.array(order))
        cells = []
        for a, b in zip(at, np.append(at[1:], len(order))):
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, rows.schema, options=options) as out:
                out.write_table(rows.slice(a, b - a).combine_chunks())
            cells.append(sink.getvalue().to_pybytes())
        yield pa.RecordBatch.from_pydict({"bucket": pa.array(bucket[order][at], pa.int64()), "rows": pa.array(cells, pa.binary())})


def bucketed(docs: DataFrame, layout: Layout, id_col: str = "doc_id", text_col: str = "text", *more) -> DataFrame:
    """Packed rows of doc_id, text (and more columns) by bucket. Rows without an id are dealt by their text."""
    key = F.xxhash64(F.coalesce(F.col(id_col).cast("long"), F.xxhash64(F.col(text_col))))
    rows = docs.select(F.pmod(key, F.lit(layout.buckets)).alias("bucket"), F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), *more)
    return rows.mapInArrow(_packed, PACKED)


def ordered(table: pa.Table) -> pa.Table:
    """A bucket's documents by id (null first), then text: the same order each time the bucket is read."""
    bucket = table["bucket"][0]
    rows = pa.concat_tables([pa.ipc.open_stream(cell).read_all() for cell in table["rows"].to_pylist()])
    rows = rows.take(pc.sort_indices(rows, [("doc_id", "ascending"), ("text", "ascending")], null_placement="at_start"))
    return rows.append_column("bucket", pa.repeat(bucket, rows.num_rows))


def set_rows(bucket: int, part: np.ndarray, values: np.ndarray) -> pa.Table:
    """One row for each partition with values; `part` is sorted."""
    at = runs(part)
    ends = np.append(at[1:], len(part))
    return pa.table({
        "part": pa.array(part[at].astype(np.int64), pa.int64()),
        "bucket": pa.array(np.full(len(at), bucket, np.int64), pa.int64()),
        "payload": pa.array([values[a:b].tobytes() for a, b in zip(at, ends)], pa.binary()),
    })


def answer_rows(part: int, kind: int, buckets: np.ndarray, values: np.ndarray) -> pa.Table:
    """One row for each bucket that gets values; `buckets` is sorted."""
    at = runs(buckets)
    ends = np.append(at[1:], len(buckets))
    return pa.table({
        "bucket": pa.array(buckets[at].astype(np.int64), pa.int64()),
        "part": pa.array(np.full(len(at), part, np.int64), pa.int64()),
        "kind": pa.array(np.full(len(at), kind, np.int32), pa.int32()),
        "payload": pa.array([values[a:b].tobytes() for a, b in zip(at, ends)], pa.binary()),
    })


def split_hash(h: np.ndarray, parts: int) -> tuple[np.ndarray, np.ndarray]:
    """Partition number and a 30-bit key of a 64-bit hash, from different bits."""
    return (h >> U64(34)) % U64(parts), h & U64((1 << 30) - 1)


def place(h: np.ndarray, parts: int) -> np.ndarray:
    """Partition and key as one integer, as answers are looked up."""
    part, key = split_hash(h, parts)
    return (part << U64(32)) | key


def flagged_set(bucket: int, h: np.ndarray, flag: np.ndarray, parts: int) -> pa.Table:
    """Distinct keys of a bucket with two bits: held more than once here; flagged somewhere here."""
    packed = np.sort((place(h, parts) << U64(1)) | flag.astype(U64))
    at = runs(packed >> U64(1))
    ends = np.append(at[1:], len(packed))
    last = packed[ends - 1] if len(packed) else packed
    keys = last >> U64(1)
    multi = (ends - at > 1).astype(U64)
    values = (((keys & U64((1 << 30) - 1)) << U64(2)) | (multi << U64(1)) | (last & U64(1))).astype(np.uint32)
    return set_rows(bucket, keys >> U64(32), values)


def repeated_answer(table: pa.Table, need_flag: bool, crowd: int | None = None) -> pa.Table:
    """For one partition of flagged sets: each bucket's keys that occur at least twice in all
    (and are flagged somewhere, where that is asked).  With `crowd`, those that are flagged
    somewhere or held by more buckets than that are the second kind of answer."""
    buckets = np.array(table["bucket"].to_pylist(), np.int64)
    order = np.argsort(buckets, kind="stable")
    cells = table["payload"].to_pylist()
    values = [np.frombuffer(cells[i], np.uint32) for i in order]
    owner = np.repeat(np.arange(len(order), dtype=U64), [len(v) for v in values])
    v = np.concatenate(values).astype(U64) if values else np.zeros(0, U64)
    packed = np.sort((v << U64(32)) | owner)
    key = packed >> U64(34)
    at = runs(key)
    size = np.diff(np.append(at, len(packed)))
    flags = np.bitwise_or.reduceat((packed >> U64(32)) & U64(3), at) if len(at) else np.zeros(0, U64)
    keep = (size > 1) | ((flags & U64(2)) > 0)
    if need_flag:
        keep &= (flags & U64(1)) > 0
    crowded = keep & ((size > crowd) | ((flags & U64(1)) > 0)) if crowd is not None else np.zeros(len(at), bool)
    answers = []
    for kind, which in enumerate((keep & ~crowded, crowded)[: 1 if crowd is None else 2]):
        some = packed[np.repeat(which, size)]
        who = (some & U64(0xFFFFFFFF)).astype(np.int64)
        by = np.argsort(who, kind="stable")
        answers.append(answer_rows(table["part"][0].as_py(), kind, buckets[order][who[by]], (some >> U64(34))[by].astype(np.uint32)))
    return pa.concat_tables(answers)


def looked_up(answers: pa.Table, kind: int = 0) -> np.ndarray:
    """Sorted places (partition and key) of one kind of answer to a bucket."""
    out = [(U64(p) << U64(32)) | np.frombuffer(c, np.uint32).astype(U64) for p, k, c in zip(answers["part"].to_pylist(), answers["kind"].to_pylist(), answers["payload"].to_pylist()) if k == kind] if answers.num_rows else []
    return np.sort(np.concatenate(out)) if out else np.zeros(0, U64)

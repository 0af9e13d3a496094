"""Embedding near-dedup: random-hyperplane sign hashing in several tables,
exact cosine verification, distributed connected components.

Equal vectors of a label are one class.  Each table deals the classes out by the
signs of its hyperplanes; within a bucket all cosines are computed as products of
blocks.  A pair that meets in several tables counts in the first.  A bucket sends
counts and a spanning forest of its links, never the pairs.
"""

from __future__ import annotations

import math
import struct

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import components
from .buckets import cut

TABLES, PLANES, SEED, BLOCK = 12, 16, 11, 1024
PART_ROWS = 20_000
SIGNED = "table_no int, cell binary, rep long, m long, signs binary, vector binary"
#: What a cell's vectors have in common, byte for byte: label, length, table, signs.
CELL = "<qiiq"
FOUND = "a long, b long, n long"


def _signed(tables: int, planes: int, seed: int):
    def sign(batches):
        for batch in batches:
            out = {k: [] for k in ("table_no", "cell", "rep", "m", "signs", "vector")}
            labels, reps, counts = (batch.column(k).to_pylist() for k in ("label", "rep", "m"))
            size = np.array(batch.column("size").to_pylist())
            values = batch.column("embedding").to_pylist()
            for dim in np.unique(size):
                some = np.flatnonzero(size == dim)
                x = np.array([values[i] for i in some], np.float64)
                unit = x / np.sqrt((x * x).sum(1))[:, None]
                normals = np.random.default_rng([seed, int(dim)]).standard_normal((int(dim), tables * planes))
                key = ((unit @ normals > 0).reshape(-1, tables, planes) * (1 << np.arange(planes))).sum(2).astype(np.int64)
                for i, u, k in zip(some, unit, key):
                    for t in range(tables):
                        out["table_no"].append(t)
                        out["cell"].append(struct.pack(CELL, labels[i], int(dim), t, int(k[t])))
                        out["rep"].append(reps[i])
                        out["m"].append(counts[i])
                        out["signs"].append(k.astype(np.int32).tobytes())
                        out["vector"].append(u.tobytes())
            yield pa.RecordBatch.from_pydict(out, schema=pa.schema([("table_no", pa.int32()), ("cell", pa.binary()), ("rep", pa.int64()), ("m", pa.int64()), ("signs", pa.binary()), ("vector", pa.binary())]))

    return sign


def _forest(near: np.ndarray) -> np.ndarray:
    """Smallest index reachable from each row of a symmetric relation."""
    low = np.arange(len(near))
    while True:
        new = np.minimum(low, np.where(near, low[None, :], len(near)).min(1))
        new = new[new]
        if (new == low).all():
            return low
        low = new


def _verified(least: float):
    def verify(table: pa.Table) -> pa.Table:
        i, j, block, table_no, rep, m = (table[k].to_numpy() for k in ("i", "j", "block", "table_no", "rep", "m"))
        cell = table["cell"].combine_chunks().dictionary_encode().indices.to_numpy()  # a number for each different cell
        order = np.lexsort((rep, j, i, cell))
        cell, i, j, block, table_no, rep, m = (x[order] for x in (cell, i, j, block, table_no, rep, m))
        signs, vectors = table["signs"].to_pylist(), table["vector"].to_pylist()
        at = np.flatnonzero(np.concatenate(([True], (cell[1:] != cell[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1]))))
        a, b, n = [], [], []
        for lo, hi in zip(at, np.append(at[1:], len(cell))):
            if hi - lo < 2:
                continue
            some = order[lo:hi]
            x = np.frombuffer(b"".join([vectors[k] for k in some])).reshape(hi - lo, -1)
            s = np.frombuffer(b"".join([signs[k] for k in some]), np.int32).reshape(hi - lo, -1)
            near = x @ x.T >= least
            np.fill_diagonal(near, False)
            if i[lo] != j[lo]:  # two blocks of a large bucket: pairs across them only
                near &= block[lo:hi, None] != block[None, lo:hi]
            if not near.any():
                continue
            own = rep[lo:hi]
            r, c = np.nonzero(near)
            first = np.argmax(s[r] == s[c], axis=1) == table_no[lo]
            count = np.bincount(r, np.where(first, m[lo:hi][c], 0), hi - lo).astype(np.int64)
            low = _forest(near)
            a += own.tolist()
            b += own[low].tolist()
            n += count.tolist()
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64()), "n": pa.array(n, pa.int64())})

    return verify


def link_embeddings(vectors: DataFrame, least: float = 0.98, tables: int = TABLES, planes: int = PLANES, seed: int = SEED, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """vec_id, n_links (vectors linked directly), component_id (smallest id reachable), kept.

    Two vectors with the same label link when their cosine is `least` or more.
    Vectors that are null, empty, zero, or hold a null or a value that is not
    finite, rows with a null label or a null id, and vectors of different length
    link with nothing; such a row is its own component.  Rows that repeat an id
    are separate vectors of one node.  An empty table gives no rows.
    """
    spark = vectors.sparkSession
    v = F.col("embedding")
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("embedding"), F.col(label_col).cast("long").alias("label"))
    usable = F.coalesce(
        F.col("vec_id").isNotNull() & F.col("label").isNotNull() & (F.size(v) > 0) & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0), F.lit(False)
    )
    rows = rows.select("vec_id", "embedding", "label", usable.alias("usable"), F.when(usable, F.md5(F.concat_ws(",", "label", v))).alias("content"))
    classes = rows.where("usable").groupBy("content").agg(F.min("vec_id").alias("rep"), F.count("*").alias("m"), F.first("embedding").alias("embedding"), F.first("label").alias("label"))
    classes = cut(classes)
    shown = classes.select("rep", "m", "label", "embedding", F.size("embedding").alias("size")).repartition(spark.sparkContext.defaultParallelism)
    signed = cut(shown.mapInArrow(_signed(tables, planes, seed), SIGNED))
    held = signed.groupBy("cell").agg(F.count("*").alias("held"))
    blocks = F.ceil(F.col("held") / BLOCK).cast("int")
    dealt = signed.join(held.where("held > 1"), "cell").withColumn("block", F.pmod(F.xxhash64("rep"), blocks).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
    dealt = dealt.select("table_no", "cell", "rep", "m", "signs", "vector", "block", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"))
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(signed.count() / PART_ROWS))
    found = cut(dealt.withColumn("part", F.pmod(F.xxhash64("cell", "i", "j"), F.lit(parts))).groupBy("part").applyInArrow(_verified(least), FOUND))
    counts = found.groupBy(F.col("a").alias("rep")).agg(F.sum("n").alias("n"))
    groups = components(found.select("a", "b")).withColumnRenamed("node", "rep")
    links = classes.select("content", "rep", "m").join(counts, "rep", "left").join(groups, "rep", "left")
    links = links.select("content", (F.col("m") - 1 + F.coalesce("n", F.lit(0))).alias("n_links"), F.coalesce("component", "rep").alias("component_id"))
    out = rows.join(links, "content", "left").select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component_id", "vec_id").alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))

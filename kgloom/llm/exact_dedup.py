"""Exact dedup of arriving batches against immutable snapshots.

A batch's own copies are grouped first: one class for each text.  The classes of
a snapshot lie in a table bucketed by digest, and static binary fuse filters, one
for each slice of its digests, stand before it.  The digests of an arriving batch
are screened by those filters; only digests that pass are joined with the exact
buckets, where the bytes of both texts are compared.  Texts cross the network
once, when their batch is grouped; copies within an input partition do not.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Callable, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import fuse
from .buckets import cut, shared_dir

#: Digests that a filter holds, or that one probe of it asks for.
FILTER_KEYS = 1 << 17


def sha256(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


class Snapshot:
    """One class for each text of a batch: key, keep_id, group_size, text; never changed once written."""

    def __init__(self, classes: DataFrame):
        spark = classes.sparkSession
        name = f"exact_{uuid.uuid4().hex}"
        buckets = int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
        classes.write.bucketBy(buckets, "key").option("path", f"{shared_dir(spark)}/{name}").option("compression", "zstd").saveAsTable(name)
        self.classes = spark.table(name)
        self._filters: tuple[DataFrame, int] | None = None

    def filters(self) -> tuple[DataFrame, int]:
        """slice, filter: a filter for each slice of the digests, and the number of slices."""
        if self._filters is None:
            slices = max(1, math.ceil(self.classes.count() / FILTER_KEYS))
            keys = self.classes.select(F.xxhash64("key").alias("h")).withColumn("slice", F.pmod("h", F.lit(slices)))
            self._filters = cut(keys.groupBy("slice").applyInArrow(_built, "slice long, filter binary")), slices
        return self._filters

    def screened(self, keys: DataFrame) -> DataFrame:
        """The digests (`key`, each once) that the filters let through: all that the snapshot holds, and one in 256 others."""
        filters, slices = self.filters()
        pieces = max(1, math.ceil(keys.count() / (slices * FILTER_KEYS)))
        h = F.xxhash64("key")
        asked = keys.select("key", h.alias("h"), F.pmod(h, F.lit(slices)).alias("slice"), F.pmod(F.shiftright(h, 40), F.lit(pieces)).alias("piece"))
        offered = filters.withColumn("piece", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(pieces - 1).cast("long"))))
        return asked.groupBy("slice", "piece").cogroup(offered.groupBy("slice", "piece")).applyInArrow(_probed, "key binary")


def _built(table: pa.Table) -> pa.Table:
    return pa.table({"slice": table["slice"].slice(0, 1), "filter": pa.array([fuse.build(table["h"].to_numpy().view(np.uint64))], pa.binary())})


def _probed(asked: pa.Table, offered: pa.Table) -> pa.Table:
    if not asked.num_rows or not offered.num_rows:
        return asked.select(["key"]).slice(0, 0)
    return asked.select(["key"]).filter(pa.array(fuse.contains(offered["filter"][0].as_py(), asked["h"].to_numpy().view(np.uint64))))


def grouped(rows: DataFrame) -> DataFrame:
    """The classes of a batch (key, doc_id, text): copies are counted within each input partition before the shuffle."""
    classes = rows.groupBy("key").agg(F.max("doc_id").alias("keep_id"), F.count("*").alias("group_size"), F.collect_set("text").alias("texts"))
    clash = F.raise_error(F.lit("digest clash"))
    return classes.select("key", "keep_id", "group_size", F.when(F.size("texts") == 1, F.col("texts")[0]).otherwise(clash.cast("string")).alias("text"))


def arrived(snapshots: Sequence[Snapshot], batch: Snapshot) -> tuple[DataFrame, DataFrame]:
    """What an arriving batch changes: (key, new_id, new_size) of classes that a snapshot holds, and the batch's other classes."""
    known = None
    for old in snapshots:
        passed = batch.classes.join(old.screened(batch.classes.select("key")), "key").select("key", F.col("keep_id").alias("new_id"), F.col("group_size").alias("new_size"), F.col("text").alias("new_text"))
        met = old.classes.select("key", "text").join(passed, "key")
        same = F.when(F.col("text") == F.col("new_text"), F.col("new_size")).otherwise(F.raise_error(F.lit("digest clash")).cast("long"))
        met = met.select("key", "new_id", same.alias("new_size"))
        known = met if known is None else known.unionByName(met)
    known = cut(known)
    return known, batch.classes.join(known.select("key"), "key", "left_anti")


def _totals(rows: DataFrame, arrivals: Sequence[Column]) -> DataFrame:
    """key, keep_id, group_size over all batches."""
    snapshots, totals = [], None
    for n, condition in enumerate(arrivals):
        batch = Snapshot(grouped(rows.where(condition)))
        fresh = batch.classes
        if snapshots:
            known, fresh = arrived(snapshots, batch)
            old = totals.join(known, "key", "left")
            totals = old.select("key", F.greatest("keep_id", "new_id").alias("keep_id"), (F.col("group_size") + F.coalesce("new_size", F.lit(0))).alias("group_size"))
            if n + 1 < len(arrivals):
                batch = Snapshot(fresh)
                fresh = batch.classes
        snapshots.append(batch)
        narrow = fresh.select("key", "keep_id", "group_size")
        totals = narrow if totals is None else cut(totals.unionByName(narrow))
    return totals


def dedup_exact(docs: DataFrame, arrivals: Sequence[Column] | None = None, digest: Callable[[Column], Column] = sha256, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, keep_id, group_size, kept and text_sha256 of every row.

    Texts are equal when their bytes are; a null text counts as empty.  Of equal
    texts the row with the largest id stays.  A null id is smaller than any: it is
    kept only where no row of the text has an id, and keep_id is null there.  Rows
    that repeat an id are rows of their own in group_size and stand or fall
    together.  An empty table gives no rows; other columns are ignored.

    `arrivals` says which rows came in which batch (conditions that part all rows;
    two halves by hash of the id if not given).  If two texts ever share a digest,
    the bytes show it, and the work is done again with whole texts as keys.
    """
    sha = F.sha2(F.col("text"), 256)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    if arrivals is None:
        arrivals = [F.pmod(F.xxhash64("doc_id"), F.lit(2)) == half for half in (0, 1)]
    keyed = rows.withColumn("key", digest(F.col("text")))
    try:
        totals = _totals(keyed, arrivals)
    except Exception as e:
        if "digest clash" not in str(e):
            raise
        keyed = rows.withColumn("key", F.col("text").cast("binary"))
        totals = _totals(keyed, arrivals)
    out = keyed.select("key", "doc_id", sha.alias("text_sha256")).join(totals, "key")
    return out.select("doc_id", "keep_id", "group_size", F.expr("doc_id <=> keep_id").alias("kept"), "text_sha256")

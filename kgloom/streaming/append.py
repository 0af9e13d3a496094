"""Incremental append of edge and evidence files: the same result as one batch over all of them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..operators.edges import KEY, ordered_distinct
from ..sources.store import EVIDENCE_KEY
from .keyed import KeyedTable


def edge_table(spark: SparkSession, uri: str, cuts: int = 256) -> KeyedTable:
    """First position and highest credibility of each edge and source."""
    merge = lambda rows: rows.groupBy(*KEY, "source").agg(F.min("pos").alias("pos"), F.max("credibility").alias("credibility"))
    return KeyedTable(spark, uri, KEY, merge, cuts)


def evidence_table(spark: SparkSession, uri: str, columns: list[str], cuts: int = 256) -> KeyedTable:
    """The last row of each evidence key by position (of ties the largest values)."""
    rest = [c for c in columns if c not in (*EVIDENCE_KEY, "pos")]

    def merge(rows: DataFrame) -> DataFrame:
        last = rows.groupBy(*EVIDENCE_KEY).agg(F.max(F.struct("pos", *rest)).alias("l"))
        return last.select(*EVIDENCE_KEY, "l.*")

    return KeyedTable(spark, uri, EVIDENCE_KEY, merge, cuts)


def append_files(table: KeyedTable, files: str, schema: StructType, progress: str, columns: list[str], files_a_batch: int = 1) -> None:
    """Fold every new file into the table, some files a micro-batch."""
    stream = table.spark.readStream.schema(schema).option("maxFilesPerTrigger", files_a_batch).parquet(files).select(*columns)
    stream.writeStream.foreachBatch(table.fold).option("checkpointLocation", progress).trigger(availableNow=True).start().awaitTermination()


def append_edges(spark: SparkSession, files: str, schema: StructType, store: str, progress: str, cuts: int = 256) -> None:
    """Fold every new file of edges into the store; appending in any number of batches gives what merge_edges gives."""
    append_files(edge_table(spark, store, cuts), files, schema, progress, [*KEY, "source", "pos", "credibility"])


def append_evidence(spark: SparkSession, files: str, schema: StructType, store: str, progress: str, cuts: int = 256) -> None:
    """Fold every new file of evidence (with `pos`) into the store."""
    columns = [f.name for f in schema.fields]
    append_files(evidence_table(spark, store, columns, cuts), files, schema, progress, columns)


def current(spark: SparkSession, store: str, batch: int | None = None) -> DataFrame:
    """Edges of the store, one row each."""
    kept = edge_table(spark, store).current(batch)
    return kept.groupBy(*KEY).agg(ordered_distinct("source", "pos").alias("source"), F.max("credibility").alias("credibility"))

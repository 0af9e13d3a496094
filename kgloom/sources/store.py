"""A graph kept as Parquet under one root: nodes/, edges/, evidence/, features/.

Writes go to a new folder that then takes the table's place by two renames: a job
that dies leaves the old table, and between the renames there is none for a moment.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.schema import NODE_TYPES, relation, xref_columns
from ..operators.edges import dedup_edges

EDGE_COLUMNS = ("x_id", "x_type", "y_id", "y_type", "relation", "display_relation", "source")
#: What identifies an evidence row, what it must have, and its other texts.
EVIDENCE_KEY = ("relation", "x_id", "y_id", "evidence_type", "source", "source_dataset", "source_record_id", "paper_id", "dataset_id", "study_id", "predicate")
EVIDENCE_REQUIRED = ("relation", "x_id", "x_type", "y_id", "y_type", "evidence_type", "source", "source_dataset", "source_record_id")
EVIDENCE_TEXT = (
    "edge_key", "relation", "x_id", "x_type", "y_id", "y_type", "evidence_type", "source", "source_dataset", "source_record_id", "paper_id", "dataset_id", "study_id",
    "direction", "confidence_interval", "predicate", "text_span", "section", "extraction_method", "license", "release", "created_at",
)
EVIDENCE_NUMBERS = ("evidence_score", "effect_size", "p_value")
#: Columns that hold no text.
COLUMN_TYPES = {"credibility": "long", **dict.fromkeys((*EVIDENCE_NUMBERS, "score", "gene_effect", "expression", "tpm", "e2g_score", "max_phase", "max_clinical_trial_phase"), "double"), "expression_level": "long", **dict.fromkeys(("is_essential", "is_approved", "has_been_withdrawn", "black_box_warning"), "boolean")}


def last_of(df: DataFrame, keys: list[str], batch: str, pos: str) -> DataFrame:
    """The last row of each key by batch and position; rows with a null key go."""
    w = Window.partitionBy(*keys).orderBy(F.desc(batch), F.desc(pos))
    whole = df.where(" AND ".join(f"`{k}` IS NOT NULL" for k in keys))
    return whole.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


@dataclass(frozen=True)
class KGRoot:
    spark: SparkSession
    uri: str

    def path(self, layer: str, name: str) -> str:
        return f"{self.uri}/{layer}/{name}.parquet"

    def _fs(self):
        jvm = self.spark._jvm
        where = jvm.org.apache.hadoop.fs.Path(self.uri)
        return where.getFileSystem(self.spark._jsc.hadoopConfiguration()), jvm.org.apache.hadoop.fs.Path

    def tables(self, layer: str) -> list[str]:
        fs, path = self._fs()
        where = path(f"{self.uri}/{layer}")
        return sorted(s.getPath().getName().removesuffix(".parquet") for s in fs.listStatus(where) if s.getPath().getName().endswith(".parquet")) if fs.exists(where) else []

    def read(self, layer: str, name: str, columns: list[str] | None = None) -> DataFrame:
        """Columns that a table lacks are null, of the type that such a column has."""
        df = self.spark.read.option("mergeSchema", True).parquet(self.path(layer, name))
        return df if columns is None else df.select([F.col(c) if c in df.columns else F.lit(None).cast(COLUMN_TYPES.get(c, "string")).alias(c) for c in columns])

    def bounded(self, layer: str, name: str, keys: list[str], limit: int, offset: int = 0) -> DataFrame:
        if not 0 < limit <= 10_000:
            raise ValueError("limit must be 1 to 10,000")
        return self.read(layer, name).orderBy(*keys).offset(offset).limit(limit)

    def _swap(self, df: DataFrame, layer: str, name: str) -> None:
        fs, path = self._fs()
        tag = uuid.uuid4().hex
        fresh, own, old = path(f"{self.uri}/{layer}/_new-{tag}"), path(self.path(layer, name)), path(f"{self.uri}/{layer}/_old-{tag}")
        df.write.parquet(fresh.toString())
        held = fs.exists(own)
        if held and not fs.rename(own, old) or not fs.rename(fresh, own):
            raise OSError(f"could not replace {own}")
        if held:
            fs.delete(old, True)

    def _with_old(self, df: DataFrame, layer: str, name: str, append: bool) -> DataFrame:
        """Rows of the table as batch 0 and new rows as batch 1; `_pos` orders the rows of a batch."""
        new = df if "_pos" in df.columns else df.withColumn("_pos", F.xxhash64(*df.columns))
        new = new.withColumn("_batch", F.lit(1))
        if not append or name not in self.tables(layer):
            return new
        old = self.read(layer, name)
        return old.withColumns({"_pos": F.xxhash64(*old.columns), "_batch": F.lit(0)}).unionByName(new, allowMissingColumns=True)

    def write_nodes(self, name: str, df: DataFrame, append: bool = False) -> None:
        """One node for each id: the last by batch and `_pos` (where absent, an order by content)."""
        if "id" not in df.columns:
            raise ValueError("nodes need an id")
        if name in NODE_TYPES:
            if missing := [c for c in xref_columns(name) if c not in df.columns]:
                raise ValueError(f"nodes/{name} lack {missing}")
            df = df.withColumns({c: F.col(c).cast("string") for c in ("id", *xref_columns(name))})
        kept = last_of(self._with_old(df.drop("node_type"), "nodes", name, append), ["id"], "_batch", "_pos")
        self._swap(kept.drop("_batch", "_pos"), "nodes", name)

    def save_nodes(self, name: str, df: DataFrame) -> None:
        """Nodes of an ingest appended; the type's cross-references that the ingest does not know are null."""
        self.write_nodes(name, df.withColumns({c: F.lit(None).cast("string") for c in xref_columns(name) if c not in df.columns} or {"id": F.col("id")}), append=True)

    def write_edges(self, name: str, df: DataFrame, append: bool = False) -> None:
        """One edge for each key, as `dedup_edges` makes it."""
        if missing := [c for c in (*EDGE_COLUMNS, "credibility") if c not in df.columns]:
            raise ValueError(f"edges lack {missing}")
        rows = self._with_old(df, "edges", name, append).withColumn("pos", F.struct("_batch", "_pos"))
        self._swap(dedup_edges(rows.drop("_batch", "_pos")), "edges", name)

    def write_evidence(self, name: str, df: DataFrame, append: bool = False) -> None:
        """All 25 columns, texts never null, edge key recomputed; the last row of each evidence key stays.

        A missing required column, an unknown relation, rows of another relation or
        ends of other types than the relation's are errors.
        """
        have = set(df.columns)
        if missing := [c for c in EVIDENCE_REQUIRED if c not in have]:
            raise ValueError(f"evidence/{name} lacks {missing}")
        spec = relation(name)
        bad = df.agg(F.count_if(F.col("relation") != name).alias("relation"), F.count_if(F.col("x_type") != spec.source).alias("x_type"), F.count_if(F.col("y_type") != spec.target).alias("y_type")).first()
        if wrong := [c for c, n in bad.asDict().items() if n]:
            raise ValueError(f"evidence/{name} has rows with another {wrong}")
        texts = {c: F.coalesce(F.col(c).cast("string"), F.lit("")) if c in have else F.lit("") for c in EVIDENCE_TEXT}
        numbers = {c: F.col(c).cast("double") if c in have else F.lit(None).cast("double") for c in EVIDENCE_NUMBERS}
        texts["edge_key"] = F.concat_ws("|", texts["relation"], texts["x_id"], texts["y_id"])
        full = df.select(*[v.alias(k) for k, v in (texts | numbers).items()], *[c for c in ("_pos",) if c in have])
        self._swap(last_of(self._with_old(full, "evidence", name, append), list(EVIDENCE_KEY), "_batch", "_pos").drop("_batch", "_pos"), "evidence", name)

    def remove_source(self, name: str, source: str) -> int:
        """Drop the edges of one source; rows without a source stay.  Returns how many went."""
        df = self.read("edges", name)
        gone = df.where(F.col("source") == source).count()
        if gone:
            self._swap(df.where(~F.col("source").eqNullSafe(source)), "edges", name)
        return gone

    def catalog(self) -> DataFrame:
        """Layer, table, rows, files and a hash of the schema."""
        out = None
        for layer in ("nodes", "edges", "evidence", "features"):
            for name in self.tables(layer):
                df = self.read(layer, name)
                one = df.select(F.input_file_name().alias("file")).groupBy("file").count().agg(F.coalesce(F.sum("count"), F.lit(0)).alias("n_rows"), F.count("*").alias("n_files"))
                one = one.select(F.lit(layer).alias("layer"), F.lit(name).alias("name"), "n_rows", "n_files", F.sha2(F.lit(df.schema.json()), 256).alias("schema_sha256"))
                out = one if out is None else out.unionByName(one)
        return out if out is not None else self.spark.createDataFrame([], "layer string, name string, n_rows long, n_files long, schema_sha256 string")

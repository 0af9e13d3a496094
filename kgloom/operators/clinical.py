"""Clinical indications as evidence of treatment edges, and warnings held against contraindications without promoting them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .hot import split_join

RELATION, DATASET = "molecule_treats_disease", "clinical_indication"
#: What a clinical stage is worth; the release; prefixes of ids that name a molecule.
STAGES = {"APPROVAL": 1.0, "PREAPPROVAL": 0.95, "PHASE_3": 0.85, "PHASE_2_3": 0.80, "PHASE_2": 0.70, "PHASE_1_2": 0.55, "PHASE_1": 0.45, "EARLY_PHASE_1": 0.35, "IND": 0.30, "PRECLINICAL": 0.20, "UNKNOWN": 0.10}
RELEASE = "OpenTargets Platform 26.03"
MOLECULE_IDS = "^(DB|CTD:|CHEMBL)"


def disease_id(c: Column) -> Column:
    """EFO_1, MONDO_1 and HP_1 with a colon; other ids trimmed; empty for null."""
    text = F.trim(F.coalesce(c, F.lit("")))
    return F.when(text.rlike("^(EFO|MONDO|HP)_"), F.regexp_replace(text, "^([A-Z]+)_", "$1:")).otherwise(text)


def first_list_text(c: Column, prefix: str | None = None, limit: int = 12) -> Column:
    """The first entries of a list (that start with a prefix, in any case), joined by `;`; blanks are none."""
    kept = F.filter(F.coalesce(c, F.array().cast("array<string>")), lambda v: (F.coalesce(v, F.lit("")) != "") & (F.lower(v).startswith(prefix.lower()) if prefix else F.lit(True)))
    return F.array_join(F.slice(kept, 1, limit), ";")


def molecule_ids(molecules: DataFrame) -> DataFrame:
    """molecule_id, chembl_id, source_name: a molecule's cross-references that name it (DrugBank, CTD, ChEMBL), and its own id."""
    each = molecules.select(F.col("id").alias("chembl_id"), F.explode("crossReferences").alias("x")).select("chembl_id", F.col("x.source").alias("source_name"), F.explode("x.ids").alias("molecule_id"))
    own = molecules.select(F.col("id").alias("chembl_id"), F.lit("ChEMBL").alias("source_name"), F.col("id").alias("molecule_id"))
    return each.unionByName(own).where(F.col("molecule_id").rlike(MOLECULE_IDS)).select("molecule_id", "chembl_id", "source_name").distinct()


def clinical_matches(edges: DataFrame, molecules: DataFrame, indications: DataFrame, rows: int = 200_000) -> DataFrame:
    """Treatment edges with the clinical indications of their molecule and disease; a molecule of very many rows is split on both sides."""
    ids = molecule_ids(molecules)
    told = indications.where("drugId IS NOT NULL AND diseaseId IS NOT NULL").select(
        F.col("id").alias("clinical_indication_id"), F.col("drugId").alias("chembl_id"), disease_id(F.col("diseaseId")).alias("y_id"), F.col("diseaseId").alias("ot_disease_id"), "maxClinicalStage",
        F.coalesce(F.array_join("clinicalReportIds", ";"), F.lit("")).alias("clinical_report_ids"), F.coalesce(F.array_join(F.filter("clinicalReportIds", lambda r: F.lower(r).startswith("nct")), ";"), F.lit("")).alias("nct_ids"),
    )
    named = edges.join(ids, edges["x_id"] == ids["molecule_id"]).drop("molecule_id").withColumnRenamed("source", "canonical_source").withColumnRenamed("source_name", "mapping_source")
    return split_join(named, told, ["chembl_id", "y_id"], rows)


def clinical_evidence(matches: DataFrame) -> DataFrame:
    """Evidence rows of matched edges; of rows with one key the largest values stay."""
    stage = F.coalesce(F.nullif("maxClinicalStage", F.lit("")), F.lit("UNKNOWN"))
    worth = F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for kv in STAGES.items() for x in kv]), stage), F.lit(0.1))
    part = lambda name, c: F.concat(F.lit(f"{name}="), F.coalesce(c, F.lit("")))
    some = lambda name, c: F.when(F.col(c) != "", part(name, F.col(c)))
    record = F.concat_ws(":", F.lit("OpenTargets:clinical_indication"), F.nullif(F.trim("clinical_indication_id"), F.lit("")))
    rows = matches.select(
        F.concat_ws("|", F.lit(RELATION), "x_id", "y_id").alias("edge_key"), F.lit(RELATION).alias("relation"), "x_id", F.lit("molecule").alias("x_type"), "y_id", F.lit("disease").alias("y_type"), F.lit("clinical_indication").alias("evidence_type"),
        F.lit("OpenTargets").alias("source"), F.lit(DATASET).alias("source_dataset"), record.alias("source_record_id"), F.lit("OpenTargets:26.03:clinical_indication").alias("dataset_id"), F.col("nct_ids").alias("study_id"), worth.alias("evidence_score"),
        F.lit("positive_indication").alias("direction"), F.concat(F.lit("clinical indication; stage="), stage).alias("predicate"),
        F.concat_ws(" | ", part("clinical_stage", F.col("maxClinicalStage")), part("chembl_id", F.col("chembl_id")), part("ot_disease_id", F.col("ot_disease_id")), some("nct_ids", "nct_ids"), some("clinical_report_ids", "clinical_report_ids")).alias("text_span"),
        F.lit("clinical_indication").alias("section"), F.lit("source_exact_edge_match_via_xref").alias("extraction_method"), F.lit("OpenTargets Platform terms").alias("license"), F.lit(RELEASE).alias("release"),
    )
    key = ["relation", "x_id", "y_id", "source_dataset", "source_record_id", "study_id", "predicate"]
    rest = [c for c in rows.columns if c not in key]
    return rows.groupBy(*key).agg(F.max(F.struct(*rest)).alias("r")).select([F.col(c) if c in key else F.col(f"r.{c}") for c in rows.columns])


def coverage(edges: DataFrame, evidence: DataFrame) -> DataFrame:
    """One row: evidence rows, edges with and without evidence, evidence keys without an edge."""
    key = F.concat_ws("|", "relation", "x_id", "y_id")
    have = edges.select(key.alias("edge_key")).distinct().withColumn("edge", F.lit(1))
    told = evidence.groupBy("edge_key").agg(F.count("*").alias("rows"))
    both = have.join(told, "edge_key", "full")
    return both.agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("n_evidence"), F.count_if(F.col("edge").isNotNull() & F.col("rows").isNotNull()).alias("n_supported"), F.count_if(F.col("rows").isNull()).alias("n_unsupported"), F.count_if(F.col("edge").isNull()).alias("n_without_edge"))


def warning_summary(warnings: DataFrame) -> DataFrame:
    """Warnings by type, and how many say what."""
    return warnings.groupBy("warningType").agg(F.count("*").alias("n_rows"), F.count("efoId").alias("n_with_efo"), F.count("efoIdForWarningClass").alias("n_with_class_efo"), F.count("description").alias("n_with_description"))


def warning_overlap(edges: DataFrame, molecules: DataFrame, warnings: DataFrame) -> DataFrame:
    """One row: pairs of contraindication edges and warnings of one molecule and disease, and edges among them.  None of it is evidence."""
    ids = molecule_ids(molecules)
    told = warnings.select(F.explode("chemblIds").alias("chembl_id"), disease_id(F.coalesce("efoId", "efoIdForWarningClass")).alias("y_id"))
    met = edges.join(ids, edges["x_id"] == ids["molecule_id"]).join(told, ["chembl_id", "y_id"])
    return met.agg(F.count("*").alias("n_rows"), F.count_distinct(F.concat_ws("|", "relation", "x_id", "y_id")).alias("n_edges"))

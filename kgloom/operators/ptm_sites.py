"""Modification sites of proteins from nested protein entries: site nodes, edges, evidence by paper, disease candidates, and what was left out for what."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.ids import first_reason

SOURCE, DATASET, RELATION = "UniProtKB", "reviewed_human_ptm_features", "protein_has_ptm_site"
#: Features that are modifications; words of a modification and its PSI-MOD term, and of a residue and its letter, the first that fits.
TYPES = ("Modified residue", "Lipidation", "Glycosylation", "Disulfide bond")
MODIFICATIONS = (
    ("phospho", "MOD:00696"), ("acetyl", "MOD:00394"), ("methyl", "MOD:00427"), ("ubiquitin", "MOD:01148"), ("sumoyl", "MOD:01149"), ("glycosyl", "MOD:00693"), ("n-linked", "MOD:00693"), ("o-linked", "MOD:00693"), ("palmitoyl", "MOD:00115"),
    ("myristoyl", "MOD:00114"), ("farnesyl", "MOD:00435"), ("geranylgeranyl", "MOD:00436"), ("disulfide", "MOD:00689"),
)
RESIDUES = (("serine", "S"), ("threonine", "T"), ("tyrosine", "Y"), ("lysine", "K"), ("arginine", "R"), ("cysteine", "C"), ("asparagine", "N"), ("glutamine", "Q"), ("histidine", "H"), ("aspartate", "D"), ("glutamate", "E"))
#: Words and ids of diseases in a site's description.
DISEASE = r"(?i)\b(disease|syndrome|cancer|carcinoma|tumou?r|phenotype|pathogenic|pathology|defect|deficiency|mim\b|omim\b|efo[:_]|hp[:_]|mondo[:_])"
DISEASE_ID = r"(?i)\b((?:EFO|HP|MONDO)[:_][0-9]{7}|(?:MIM|OMIM)[: ]?[0-9]{6})\b"
ENTRY = (
    "primaryAccession string, sequence struct<value:string>, features array<struct<type:string,featureId:string,description:string,location:struct<start:struct<value:string,modifier:string>,end:struct<value:string,modifier:string>>,"
    "evidences:array<struct<evidenceCode:string,source:string,id:string>>>>, comments array<struct<commentType:string>>"
)


def clean(c: Column) -> Column:
    return F.trim(F.coalesce(c.cast("string"), F.lit("")))


def slug(c: Column) -> Column:
    found = F.lower(F.regexp_replace(F.regexp_replace(F.trim(c), "[^A-Za-z0-9]+", "_"), "^_+|_+$", ""))
    return F.when(found == "", F.lit("ptm")).otherwise(found)


def named(text: Column, words: tuple[tuple[str, str], ...]) -> Column:
    """What the first of some words in a text stands for; empty if none is there."""
    out = F.when(F.contains(text, F.lit(words[0][0])), words[0][1])
    for word, value in words[1:]:
        out = out.when(F.contains(text, F.lit(word)), value)
    return out.otherwise("")


def context(sequence: Column, position: Column, flank: int = 7) -> Column:
    """A residue with its flanks, clamped at both ends; empty where it lies outside."""
    start = F.greatest(F.lit(1), position - flank)
    stop = F.least(F.length(sequence), position + flank)
    return F.when((position >= 1) & (position <= F.length(sequence)), F.substr(sequence, start.cast("int"), (stop - start + 1).cast("int"))).otherwise("")


def _piped(items: Column) -> Column:
    return F.array_join(F.array_sort(F.array_distinct(F.filter(items, lambda x: x != ""))), "|")


def protein_of(proteins: DataFrame) -> DataFrame:
    """accession and protein: the smallest node that names an accession (several are joined by |)."""
    each = proteins.where("id IS NOT NULL").select(F.trim("id").alias("protein"), F.explode(F.split("uniprot_id", r"\|")).alias("accession")).withColumn("accession", F.trim("accession")).where("accession <> ''")
    return each.groupBy("accession").agg(F.min("protein").alias("protein"))


def ptm_sites(entries: DataFrame, proteins: DataFrame, release: str = "", flank: int = 7, check_residue: bool = False) -> dict[str, DataFrame]:
    """`sites`, `edges`, `evidence`, `candidates` of diseases, `rejected` features by reason, and `counts`.

    A site needs exact places and a protein node.  With `check_residue`, one whose
    description names another residue than the sequence has there is rejected too.
    A site id that several features have is one node, with the smallest values.
    """
    rows = entries.select(clean(F.col("primaryAccession")).alias("accession"), clean(F.col("sequence.value")).alias("sequence"), F.exists(F.coalesce("comments", F.array().cast("array<struct<commentType:string>>")), lambda c: F.upper(clean(c["commentType"])) == "DISEASE").alias("ill"), F.explode("features").alias("f"))
    rows = rows.withColumn("feature_type", clean(F.col("f.type"))).where(F.col("feature_type").isin(*TYPES))
    number = lambda c: c.try_cast("long")
    start = number(F.col("f.location.start.value"))
    rows = rows.withColumns({
        "position": start, "end_position": F.coalesce(number(F.col("f.location.end.value")), start), "location_modifier": _piped(F.array(clean(F.col("f.location.start.modifier")), clean(F.col("f.location.end.modifier")))),
        "description": clean(F.col("f.description")), "feature_id": clean(F.col("f.featureId")),
    })
    told = F.coalesce("f.evidences", F.array().cast("array<struct<evidenceCode:string,source:string,id:string>>"))
    pmid = lambda e: F.when(F.lower(clean(e["source"])) == "pubmed", F.when(clean(e["id"]).rlike(r"^\d+$"), F.concat(F.lit("PMID:"), clean(e["id"]))).otherwise(clean(e["id"]))).otherwise("")
    hint = named(F.lower("description"), RESIDUES)
    inside = (F.col("position") >= 1) & (F.col("position") <= F.length("sequence"))
    there = F.substr("sequence", F.col("position").cast("int"), F.lit(1))
    rows = rows.withColumns({
        "evidence_codes": _piped(F.transform(told, lambda e: clean(e["evidenceCode"]))), "pmids": _piped(F.transform(told, pmid)), "residue": F.when(inside, there).otherwise(hint), "sequence_context": context(F.col("sequence"), F.col("position"), flank),
        "psi_mod_id": named(F.lower(F.concat_ws(" ", "description", "feature_type")), MODIFICATIONS), "hint": hint,
    })
    span = F.when(F.col("position") == F.col("end_position"), F.col("position").cast("string")).otherwise(F.concat_ws("-", F.col("position").cast("string"), F.col("end_position").cast("string")))
    suffix = F.substring(slug(F.coalesce(F.nullif("feature_id", F.lit("")), F.nullif("description", F.lit("")), "feature_type")), 1, 80)
    rows = rows.join(protein_of(proteins), "accession", "left").withColumn("id", F.concat_ws(":", F.lit("PTMSITE"), "accession", slug(F.col("feature_type")), span, suffix))
    exact = F.col("position").isNotNull() & F.col("end_position").isNotNull() & F.col("location_modifier").isin("", "EXACT")
    differs = F.lit(check_residue) & inside & (F.col("hint") != "") & (F.col("hint") != F.upper(there))
    marked = rows.withColumn("reason", first_reason((~exact, "no_exact_position"), (F.col("protein").isNull(), "missing_protein_mapping"), (differs, "residue_differs_from_sequence")))
    good = marked.where("reason IS NULL").withColumn("modification_type", F.when(F.col("description") != "", F.col("description")).otherwise(F.col("feature_type")))
    kept = ["accession", "protein", "feature_type", "modification_type", "psi_mod_id", "residue", "position", "end_position", "location_modifier", "sequence_context", "feature_id", "description", "evidence_codes", "pmids"]
    sites = good.groupBy("id").agg(F.min(F.struct(*kept)).alias("s")).select("id", *[F.col(f"s.{c}") for c in kept]).withColumnsRenamed({"accession": "uniprot_accession", "protein": "protein_id"}).withColumns({"isoform": F.lit("canonical"), "source": F.lit(SOURCE), "source_release": F.lit(release)})
    edges = good.select(F.col("protein").alias("x_id"), F.lit("protein").alias("x_type"), F.col("id").alias("y_id"), F.lit("ptm_site").alias("y_type"), F.lit(RELATION).alias("relation")).distinct()
    edges = edges.select("*", F.lit("has PTM site").alias("display_relation"), F.lit(f"{SOURCE}/{release}").alias("source"), F.lit(3).cast("long").alias("credibility"))
    record = F.coalesce(F.nullif("feature_id", F.lit("")), F.concat_ws(":", "accession", "feature_type", F.col("position").cast("string"), "description"))
    papers = F.filter(F.split("pmids", r"\|"), lambda p: p != "")
    every = good.withColumn("record", record).withColumn("paper", F.explode(F.concat(F.array(F.lit("")), papers)))
    more = ["accession", "residue", "position", "end_position", "modification_type", "psi_mod_id", "evidence_codes", "sequence_context"]
    evidence = every.select(
        F.concat_ws("|", F.lit(RELATION), "protein", "id").alias("edge_key"), F.lit(RELATION).alias("relation"), F.col("protein").alias("x_id"), F.lit("protein").alias("x_type"), F.col("id").alias("y_id"), F.lit("ptm_site").alias("y_type"),
        F.when(F.col("paper") == "", "database_record").otherwise("paper").alias("evidence_type"), F.lit(SOURCE).alias("source"), F.lit(DATASET).alias("source_dataset"), F.concat_ws(":", "record", F.nullif("paper", F.lit(""))).alias("source_record_id"),
        F.col("paper").alias("paper_id"), F.col("feature_type").alias("predicate"), F.lit(release).alias("release"), *more,
    )
    own = ["relation", "x_id", "y_id", "evidence_type", "source_record_id", "paper_id"]
    rest = [c for c in evidence.columns if c not in own]
    evidence = evidence.groupBy(*own).agg(F.max(F.struct(*rest)).alias("e")).select([F.col(c) if c in own else F.col(f"e.{c}") for c in evidence.columns])
    ids = F.transform(F.regexp_extract_all("description", F.lit(DISEASE_ID), F.lit(1)), lambda i: F.translate(F.upper(i), "_", ":"))
    candidates = good.where(F.col("description").rlike(DISEASE)).select(
        F.col("id").alias("ptm_site_id"), F.col("accession").alias("uniprot_accession"), F.col("protein").alias("protein_id"), "feature_type", "residue", "position", "description", F.lit("feature_description").alias("candidate_kind"),
        _piped(ids).alias("disease_or_phenotype_id"), "pmids", F.coalesce(F.nullif("feature_id", F.lit("")), "id").alias("source_record_id"), F.lit("candidate_only_requires_manual_review_explicit_site_level_assertion").alias("decision"),
    ).distinct()
    rejected = marked.where("reason IS NOT NULL").select("accession", "feature_type", "description", "position", "residue", "hint", "reason")
    counts = marked.groupBy(F.coalesce("reason", F.lit("accepted")).alias("outcome")).agg(F.count("*").alias("n"), F.count_if("ill").alias("n_of_entries_with_disease_comments"))
    return {"sites": sites, "edges": edges, "evidence": evidence, "candidates": candidates, "rejected": rejected, "counts": counts}

"""Variants that evidence backs: records that name a variant, and credible sets joined with the evidence and the genes of their loci."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.ids import normalize_curie
from ..functions.records import variant_id
from .hot import split_join
from .ingest import SOURCE, distinct_nodes, edge, lacking, scored, stub_nodes

#: Datatypes whose records back a variant; the dataset of genome-wide loci.
VARIANT_TYPES = ("genetic_association", "ot_genetics_portal", "gwas_credible_sets", "gene_burden", "eva", "eva_somatic", "clingen", "uniprot_variants", "somatic_mutation", "intogen")
LOCUS_DATASET, LOCUS_SOURCE = "evidence_gwas_credible_sets", "gwas_credible_sets"
#: The largest exponent of a p-value and the least gene score that count.
P_EXPONENT, GENE_SCORE = -8, 0.75


def significant(exponent: Column, most: int = P_EXPONENT) -> Column:
    """A p-value that is unknown or small enough by its exponent."""
    value = exponent.try_cast("double")
    return value.isNull() | (value <= most)


def best_of(df: DataFrame, key: list[str]) -> DataFrame:
    """One edge for each key: the highest credibility, then the smallest values."""
    rest = [c for c in df.columns if c not in key]
    best = F.struct((-F.col("credibility")).alias("_c"), *rest)
    return df.groupBy(*key).agg(F.min(best).alias("b")).select(*[F.col(c) if c in key else F.col(f"b.{c}") for c in df.columns])


def _mutations(rows: DataFrame) -> DataFrame:
    """Variant nodes: an rs id is the dbSNP reference, any other the gnomAD one."""
    rs = F.when(F.col("v").startswith("rs"), F.col("v"))
    return rows.select(F.col("v").alias("id"), F.lit(None).cast("string").alias("hgvs"), rs.alias("clinvar_id"), F.when(rs.isNull(), F.col("v")).alias("gnomad_id"), F.col("v").alias("name"), F.concat(F.lit(f"{SOURCE}/"), "origin").alias("source"))


def _disease_edges(rows: DataFrame) -> DataFrame:
    source = F.concat(F.lit(f"{SOURCE}/"), "origin")
    return rows.select(*edge(F.col("v"), "mutation", F.col("d"), "disease", "mutation_associated_disease", "associated disease", source, scored(F.col("score"), F.col("kind")), score=F.round("score", 4), datatype=F.col("kind"), studyLocusId=F.col("locus")))


def _records(rows: DataFrame, relation: str, y: str, y_type: str, dataset: Column, key: Column, **more: Column) -> DataFrame:
    """Evidence rows beside the edges."""
    return rows.select(
        F.lit(relation).alias("relation"), F.col("v").alias("x_id"), F.lit("mutation").alias("x_type"), F.col(y).alias("y_id"), F.lit(y_type).alias("y_type"), F.lit("database_record").alias("evidence_type"), F.lit(SOURCE).alias("source"),
        dataset.alias("source_dataset"), key.alias("source_record_id"), F.round("score", 4).alias("evidence_score"), F.col("kind").alias("predicate"), F.coalesce("locus", F.lit("")).alias("study_id"), *[c.alias(k) for k, c in more.items()],
    ).distinct()


def named_variants(evidence: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Records (column dataset) that name a variant, and the diseases of all records of the right types, with or without one."""
    df = lacking(evidence, datatypeId="string", datasourceId="string", score="double")
    rows = df.where(F.col("dataset") != LOCUS_DATASET).withColumn("kind", F.trim("datatypeId")).where(F.col("kind").isin(*VARIANT_TYPES))
    rows = rows.select(normalize_curie(F.col("diseaseId")).alias("d"), variant_id(df).alias("v"), "kind", F.trim(F.coalesce(F.nullif("datasourceId", F.lit("")), F.col("kind"))).alias("origin"), F.coalesce("score", F.lit(0.0)).alias("score"), F.lit(None).cast("string").alias("locus"), "dataset")
    rows = rows.where("d IS NOT NULL AND d <> ''")
    return rows.where("v IS NOT NULL"), rows.select("d")


def locus_variants(credible: DataFrame, evidence: DataFrame, exponent: int = P_EXPONENT, rows: int = 200_000) -> DataFrame:
    """Variants of significant credible sets with the diseases of their locus; a locus with very many variants or records is split on both sides."""
    c = lacking(credible, pValueExponent="int", pValueMantissa="double", beta="double", studyId="string")
    c = c.where(F.col("studyLocusId").isNotNull() & F.col("variantId").isNotNull() & significant(F.col("pValueExponent"), exponent))
    c = c.select(F.col("studyLocusId").cast("string").alias("locus"), F.trim("variantId").alias("v"), (F.col("pValueMantissa") * F.pow(F.lit(10.0), F.col("pValueExponent"))).alias("p_value"), F.col("beta").alias("effect_size"), F.col("studyId").alias("study")).where("v <> ''")
    e = lacking(evidence, datatypeId="string", datasourceId="string", score="double", resourceScore="double")
    told = F.coalesce(F.nullif("score", F.lit(0.0)), F.nullif("resourceScore", F.lit(0.0)), F.lit(0.0))
    e = e.where((F.col("dataset") == LOCUS_DATASET) & F.col("studyLocusId").isNotNull() & F.col("diseaseId").isNotNull() & (F.coalesce("datasourceId", F.lit(LOCUS_SOURCE)) == LOCUS_SOURCE))
    e = e.select(F.col("studyLocusId").cast("string").alias("locus"), normalize_curie(F.col("diseaseId")).alias("d"), F.coalesce(F.nullif("datatypeId", F.lit("")), F.lit(LOCUS_SOURCE)).alias("kind"), F.coalesce(F.nullif("datasourceId", F.lit("")), F.lit("ot_genetics_portal")).alias("origin"), told.alias("score"))
    return split_join(c, e.where("d IS NOT NULL AND d <> ''"), ["locus"], rows)


def locus_genes(credible: DataFrame, l2g: DataFrame, exponent: int = P_EXPONENT, least: float = GENE_SCORE, rows: int = 200_000) -> DataFrame:
    """Variants of significant credible sets with the genes that their locus is scored for."""
    c = lacking(credible, pValueExponent="int").where(F.col("studyLocusId").isNotNull() & F.col("variantId").isNotNull() & significant(F.col("pValueExponent"), exponent))
    c = c.select(F.col("studyLocusId").cast("string").alias("locus"), F.trim("variantId").alias("v")).where("v <> ''").distinct()
    g = l2g.where(F.col("studyLocusId").isNotNull() & F.col("geneId").isNotNull() & (F.coalesce("score", F.lit(0.0)) >= least))
    g = g.select(F.col("studyLocusId").cast("string").alias("locus"), F.trim("geneId").alias("g"), F.col("score").cast("double").alias("score")).where("g <> ''")
    return split_join(c, g, ["locus"], rows).withColumn("kind", F.lit("l2g"))


def evidence_backed_variants(
    evidence: DataFrame, credible: DataFrame | None = None, l2g: DataFrame | None = None, diseases: DataFrame | None = None, genes: DataFrame | None = None,
    exponent: int = P_EXPONENT, least: float = GENE_SCORE, rows: int = 200_000,
) -> dict[str, DataFrame]:
    """Variant nodes, their disease and gene edges, the evidence for both, and stubs for diseases and genes that no node table has.

    Plain consequences without a disease make no row.  Disease stubs also stand for
    records without a usable variant.  Disease edges are one for each pair, source
    and datatype; gene edges one for each pair and locus.
    """
    plain, seen = named_variants(evidence)
    every, nodes = _disease_edges(plain), _mutations(plain)
    record = F.concat_ws(":", "origin", "d", "v", "kind")
    told = _records(plain, "mutation_associated_disease", "d", "disease", F.col("dataset"), record, p_value=F.lit(None).cast("double"), effect_size=F.lit(None).cast("double"))
    out: dict[str, DataFrame] = {}
    if credible is not None:
        loci = locus_variants(credible, evidence, exponent, rows)
        every, nodes, seen = every.unionByName(_disease_edges(loci)), nodes.unionByName(_mutations(loci)), seen.union(loci.select("d"))
        told = told.unionByName(_records(loci, "mutation_associated_disease", "d", "disease", F.lit(LOCUS_DATASET), F.concat_ws(":", "locus", record), p_value=F.col("p_value"), effect_size=F.col("effect_size")))
        if l2g is not None:
            scored_genes = locus_genes(credible, l2g, exponent, least, rows)
            linked = scored_genes.select(*edge(F.col("v"), "mutation", F.col("g"), "gene", "mutation_associated_gene", "associated gene", f"{SOURCE}/l2g", scored(F.col("score"), F.col("kind")), score=F.round("score", 4), datatype=F.col("kind"), studyLocusId=F.col("locus")))
            out["mutation_associated_gene"] = best_of(linked, ["x_id", "y_id", "relation", "source", "datatype", "studyLocusId"])
            out["evidence/mutation_associated_gene"] = _records(scored_genes, "mutation_associated_gene", "g", "gene", F.lit("l2g_prediction"), F.concat_ws(":", "locus", "v", "g"))
            out["gene"] = stub_nodes(scored_genes.select(F.col("g").alias("id")), genes, f"{SOURCE}/l2g")
    known = None if diseases is None else diseases.select(F.coalesce(normalize_curie(F.col("id")), F.col("id")).alias("id"))
    stubs = stub_nodes(seen.select(F.col("d").alias("id")), known, f"{SOURCE}/evidence")
    stubs = stubs.withColumns({"mondo_id": F.when(F.col("id").startswith("MONDO:"), F.col("id")), "hp_id": F.when(F.col("id").startswith("HP:"), F.col("id"))})
    return out | {"mutation": distinct_nodes(nodes), "mutation_associated_disease": best_of(every, ["x_id", "y_id", "relation", "source", "datatype"]), "evidence/mutation_associated_disease": told, "disease": stubs}

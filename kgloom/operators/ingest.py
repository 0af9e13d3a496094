"""Nested source tables to nodes, edges and evidence of the graph.

Every function takes the source as a DataFrame and gives named DataFrames: a
node type's rows, or a relation's.  Columns that a source lacks count as null.
Of rows with one key the best stays: the highest credibility, then the smallest
values; where a rule says which comes last, that one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.ids import credibility_from_score, normalize_curie

SOURCE = "OpenTargets"
#: Fixed value: the release whose records evidence rows name.
RELEASE = "26.03"
#: Datatypes by what their rows say; datatypes whose score counts for credibility.
DRUG_TYPES = ("known_drug", "chembl", "cancer_biomarkers")
PATHWAY_TYPES = ("reactome", "progeny", "slapenrich", "affected_pathway")
GENE_TYPES = (
    "genetic_association", "somatic_mutation", "ot_genetics_portal", "intogen", "crispr_screen", "l2g", "eva", "eva_somatic", "clingen", "cancer_gene_census", "gene2phenotype", "orphanet",
    "uniprot_variants", "phenodigm", "literature", "europepmc", "sysbio", "expression_atlas", "genetic_literature", "animal_model", "rna_expression", "gene_burden", "gwas_credible_sets", "crispr",
)
SCORED_TYPES = ("genetic_association", "animal_model", "known_drug", "clinical_trial")
#: Id prefixes of diseases that an ontology backs.
DISEASE_PREFIXES = "^(EFO:|MONDO:|Orphanet:|HP:|DOID:)"


def text(c) -> Column:
    """Trimmed text, blanks as null."""
    return F.nullif(F.trim(F.col(c) if isinstance(c, str) else c), F.lit(""))


def lacking(df: DataFrame, **types: str) -> DataFrame:
    """df with null columns for those it has not."""
    return df.withColumns({c: F.lit(None).cast(t) for c, t in types.items() if c not in df.columns}) if set(types) - set(df.columns) else df


def edge(x: Column, x_type: str, y: Column, y_type: str, relation: str, display, source, credibility, **extra: Column) -> list[Column]:
    lit = lambda v: v if isinstance(v, Column) else F.lit(v)
    return [x.alias("x_id"), F.lit(x_type).alias("x_type"), y.alias("y_id"), F.lit(y_type).alias("y_type"), F.lit(relation).alias("relation"), lit(display).alias("display_relation"), lit(source).alias("source"), lit(credibility).cast("long").alias("credibility"), *[c.alias(n) for n, c in extra.items()]]


def distinct_edges(df: DataFrame) -> DataFrame:
    """One row for each pair, relation and source."""
    key = ["x_id", "y_id", "relation", "source"]
    rest = [c for c in df.columns if c not in key]
    best = F.struct((-F.col("credibility")).alias("_c"), *rest)
    return df.groupBy(*key).agg(F.min(best).alias("b")).select(*[F.col(c) if c in key else F.col(f"b.{c}") for c in df.columns])


def distinct_nodes(df: DataFrame) -> DataFrame:
    rest = [c for c in df.columns if c != "id"]
    return df.where("id IS NOT NULL AND id <> ''").groupBy("id").agg(F.min(F.struct(*rest)).alias("b")).select("id", "b.*")


def stub_nodes(ids: DataFrame, known: DataFrame | None, source: str) -> DataFrame:
    """Minimal nodes for ids (id, and a name where there is one) that no node table has."""
    named = ids if "name" in ids.columns else ids.withColumn("name", F.col("id"))
    found = named.where("id IS NOT NULL AND id <> ''").groupBy("id").agg(F.min("name").alias("name"))
    found = found.select("id", F.coalesce("name", "id").alias("name"), F.lit(source).alias("source"))
    return found if known is None else found.join(known.select("id"), "id", "left_anti")


def _first(items: Column, keep, what) -> Column:
    """`what` of the first item of a list that `keep` holds for."""
    return F.get(F.transform(F.filter(F.coalesce(items, F.array()), keep), what), F.lit(0))


def targets(df: DataFrame) -> dict[str, DataFrame]:
    """Genes with cross-references; transcripts and proteins (of repeated ids the last by gene and place); what encodes what."""
    genes = df.withColumn("id", F.trim("id")).where(F.col("id").startswith("ENSG"))
    uniprot = F.coalesce(
        _first(F.col("proteinIds"), lambda p: (p["source"] == "uniprot_swissprot") & (p["id"] != ""), lambda p: p["id"]), _first(F.col("proteinIds"), lambda p: p["source"].startswith("uniprot") & (p["id"] != ""), lambda p: p["id"])
    )
    xref = lambda *names: _first(F.col("dbXrefs"), lambda x: x["source"].isin(*names) & (x["id"] != ""), lambda x: F.trim(x["id"]))
    rows = genes.select(
        "id", F.coalesce(text("approvedSymbol"), F.lit("")).alias("name"), F.coalesce(text("approvedName"), F.lit("")).alias("description"), xref("NCBIGene", "EntrezGene").alias("ncbi_gene_id"), xref("HGNC").alias("hgnc_id"),
        uniprot.alias("uniprot_id"), F.coalesce(text("approvedSymbol"), F.lit("")).alias("gene_name"), F.lit(SOURCE).alias("source"), "transcripts",
    )
    each = rows.select("id", "uniprot_id", F.posexplode("transcripts").alias("place", "t")).select("id", "uniprot_id", "place", text("t.transcriptId").alias("transcript"), text("t.translationId").alias("protein"), text("t.uniprotId").alias("own"), text("t.biotype").alias("biotype"))
    last = F.struct("id", "place")
    is_t, is_p = F.col("transcript").startswith("ENST"), F.col("protein").startswith("ENSP")
    transcripts = each.where(is_t).groupBy(F.col("transcript").alias("id")).agg(F.max_by(F.struct(F.col("id").alias("ensembl_gene_id"), F.when(is_p, F.col("protein")).alias("protein_id")), last).alias("l")).select("id", F.col("id").alias("name"), "l.*", F.lit(SOURCE).alias("source"))
    proteins = each.where(is_p).groupBy(F.col("protein").alias("id")).agg(F.max_by(F.struct(F.col("id").alias("ensembl_gene_id"), F.coalesce("own", "uniprot_id").alias("uniprot_id")), last).alias("l")).select("id", F.col("id").alias("name"), "l.*", F.lit(SOURCE).alias("source"))
    has = each.where(is_t).select(*edge(F.col("id"), "gene", F.col("transcript"), "transcript", "gene_has_transcript", "has transcript", f"{SOURCE}/target", 3, transcript_biotype=F.coalesce("biotype", F.lit(""))))
    encodes = each.where(is_t & is_p).select(*edge(F.col("transcript"), "transcript", F.col("protein"), "protein", "transcript_encodes_protein", "encodes protein", f"{SOURCE}/target", 3))
    return {"gene": rows.drop("transcripts"), "transcript": transcripts, "protein": proteins, "gene_has_transcript": has, "transcript_encodes_protein": encodes}


def orthologs(df: DataFrame, cross_species: bool = False) -> dict[str, DataFrame]:
    """High-confidence orthologs of human genes; only on request, since their ends are no part of the human graph."""
    if not cross_species:
        raise ValueError("orthologs are staged only on request: pass cross_species=True")
    if "homologues" not in df.columns:
        raise ValueError("the source has no homologues")
    human = df.select(F.trim("id").alias("id"), text("approvedSymbol").alias("symbol"), F.explode("homologues").alias("h")).where(F.col("id").startswith("ENSG"))
    sure = F.lower(F.trim(F.col("h.isHighConfidence").cast("string"))).isin("1", "true", "t", "yes")
    rows = human.withColumn("y", F.trim("h.targetGeneId")).where(F.trim("h.homologyType").startswith("ortholog_") & sure & F.col("y").startswith("ENS") & (F.col("y") != F.col("id")))
    found = distinct_edges(rows.select(*edge(F.col("id"), "gene", F.col("y"), "gene", "gene_ortholog_gene", "ortholog of", f"{SOURCE}/target.homologues", 3, homology_type=F.trim("h.homologyType"), species_id=text("h.speciesId"))))
    ends = rows.select("id", F.coalesce("symbol", "id").alias("name")).union(rows.select("y", F.coalesce(text("h.targetGeneSymbol"), F.col("y"))))
    return {"gene": stub_nodes(ends, None, f"{SOURCE}/target.homologues"), "gene_ortholog_gene": found}


def diseases(df: DataFrame) -> dict[str, DataFrame]:
    """Diseases with the first cross-reference of each kind, and their hierarchy without self parents."""
    own = F.coalesce(normalize_curie(F.col("id")), F.trim("id"))

    def pick(*starts: str, cut: str = "") -> Column:
        found = _first(F.col("dbXRefs"), lambda x: F.trim(x).rlike("^(" + "|".join(starts) + "):"), lambda x: F.trim(x))
        return F.replace(found, F.lit(cut), F.lit("")) if cut else found

    nodes = df.select(
        own.alias("id"), F.coalesce(text("name"), F.lit("")).alias("name"), F.coalesce(text("description"), F.lit("")).alias("description"), pick("MONDO").alias("mondo_id"), pick("OMIM", cut="OMIM:").alias("omim_id"), pick("DOID").alias("doid_id"),
        pick("ICD10", cut="ICD10:").alias("icd10_code"), pick("MeSH", "MESH").alias("mesh_id"), pick("HP").alias("hp_id"), F.lit(SOURCE).alias("source"),
    )
    parents = df.select(own.alias("child"), F.explode("parents").alias("p")).withColumn("p", F.coalesce(normalize_curie(F.col("p")), F.trim("p"))).where("p <> '' AND p <> child")
    return {"disease": nodes, "disease_subtype_of_disease": parents.select(*edge(F.col("child"), "disease", F.col("p"), "disease", "disease_subtype_of_disease", "subtype of", SOURCE, 3))}


def molecules(df: DataFrame) -> dict[str, DataFrame]:
    df = lacking(df, maximumClinicalTrialPhase="double", maximumClinicalStage="double", isApproved="boolean", hasBeenWithdrawn="boolean", blackBoxWarning="boolean")
    xref = lambda *names: _first(F.col("crossReferences"), lambda x: F.lower(x["source"]).isin(*names) & (F.size(x["ids"]) > 0), lambda x: F.get(x["ids"], F.lit(0)))
    flag = lambda c: F.coalesce(F.col(c), F.lit(False)).alias
    rows = df.withColumn("id", F.trim("id")).where(F.col("id").startswith("CHEMBL"))
    return {"molecule": rows.select(
        "id", F.coalesce(text("name"), F.lit("")).alias("name"), flag("isApproved")("is_approved"), F.coalesce("maximumClinicalTrialPhase", "maximumClinicalStage").alias("max_clinical_trial_phase"), flag("hasBeenWithdrawn")("has_been_withdrawn"),
        flag("blackBoxWarning")("black_box_warning"), text("inchiKey").alias("inchikey"), xref("drugbank").alias("drugbank_id"), xref("pubchem", "pubchemcid", "pubchem_cid").alias("pubchem_cid"), xref("cas", "cas_rn").alias("cas_rn"), text("canonicalSmiles").alias("smiles"), F.lit(SOURCE).alias("source"),
    )}


def scored(score: Column, datatype: Column) -> Column:
    """Credibility of one record: 2 for a score of 0.75 of a datatype that counts, else 1."""
    return F.when((score >= 0.75) & datatype.isin(*SCORED_TYPES), 2).otherwise(1)


def interactions(df: DataFrame) -> dict[str, DataFrame]:
    """Protein pairs in canonical order, without blanks and self loops, one for each source."""
    rows = df.select(text("intA").alias("a"), text("intB").alias("b"), F.coalesce("scoring", F.lit(0.0)).alias("s"), F.coalesce(text("sourceDatabase"), F.lit(SOURCE)).alias("db")).where("a IS NOT NULL AND b IS NOT NULL AND a <> b")
    found = rows.select(*edge(F.least("a", "b"), "protein", F.greatest("a", "b"), "protein", "protein_interacts_protein", "interacts with", F.concat(F.lit(f"{SOURCE}/"), "db"), scored(F.col("s"), F.lit("genetic_association")), score=F.round("s", 4)))
    return {"protein_interacts_protein": distinct_edges(found)}


def evidence(df: DataFrame, genes: DataFrame | None = None, pathways: DataFrame | None = None, release: str = RELEASE) -> dict[str, DataFrame]:
    """Records of all evidence datasets (column dataset) routed by datatype to gene, molecule and pathway edges.

    Genes and pathways that no given node table has become stubs, pathways under the
    name that a record gives them.
    """
    df = lacking(df, drugId="string", reactionId="string", reactionName="string", pathways="array<struct<id:string,name:string>>")
    blank = F.lit("")
    kind, target = F.coalesce(text("datatypeId"), blank), F.trim("targetId")
    rows = df.select(
        target.alias("t"), normalize_curie(F.col("diseaseId")).alias("d"), kind.alias("kind"), F.coalesce(text("datasourceId"), kind).alias("origin"), F.round(F.coalesce("score", F.lit(0.0)), 4).alias("score"), scored(F.col("score"), kind).alias("cred"),
        F.coalesce(text("drugId"), F.when(target.startswith("CHEMBL"), target)).alias("drug"), "pathways", text("reactionId").alias("reaction"), text("reactionName").alias("reaction_name"), "dataset",
    ).where("t <> '' AND d IS NOT NULL")
    source = F.concat(F.lit(f"{SOURCE}/"), "origin")
    is_drug, is_path = F.col("kind").isin(*DRUG_TYPES), F.col("kind").isin(*PATHWAY_TYPES)
    treats = rows.where(is_drug & F.col("drug").isNotNull()).select(*edge(F.col("drug"), "molecule", F.col("d"), "disease", "molecule_treats_disease", "indication", source, F.col("cred"), score=F.col("score")))
    named = lambda i, n: F.struct(i.alias("id"), n.alias("name"))
    ours = lambda items: F.filter(items, lambda p: p["id"].startswith("R-HSA-"))
    listed = F.transform(F.coalesce("pathways", F.array().cast("array<struct<id:string,name:string>>")), lambda p: named(F.trim(p["id"]), text(p["name"])))
    told = ours(F.concat(listed, F.array(named(F.col("reaction"), F.col("reaction_name")))))
    told = F.when(F.size(told) == 0, ours(F.array(named(F.col("t"), F.lit(None).cast("string"))))).otherwise(told)
    paths = rows.where(is_path).withColumn("path", F.explode(told)).withColumns({"p": F.col("path.id"), "pathway_name": F.col("path.name")})
    involves = paths.select(*edge(F.col("p"), "pathway", F.col("d"), "disease", "disease_involves_pathway", "involved in disease", source, F.col("cred"), score=F.col("score"), pathway_name=F.col("pathway_name")))
    own = rows.where(~is_drug & F.col("t").startswith("ENSG"))
    strength = F.when(F.col("kind").isin(*GENE_TYPES, *PATHWAY_TYPES), F.col("cred")).otherwise(1)
    linked = own.select(*edge(F.col("t"), "gene", F.col("d"), "disease", "disease_associated_gene", "associated disease", source, strength, score=F.col("score")))
    base = F.concat_ws(":", "origin", "d", "t", "kind")
    record = lambda frame, relation, x, x_type, key: frame.select(
        F.lit(relation).alias("relation"), x.alias("x_id"), F.lit(x_type).alias("x_type"), F.col("d").alias("y_id"), F.lit("disease").alias("y_type"), F.lit("database_record").alias("evidence_type"), F.lit(SOURCE).alias("source"),
        F.col("dataset").alias("source_dataset"), key.alias("source_record_id"), F.col("score").alias("evidence_score"), F.col("kind").alias("predicate"), F.lit(release).alias("release"),
    )
    stubs = stub_nodes(paths.select(F.col("p").alias("id"), F.col("pathway_name").alias("name")), pathways, f"{SOURCE}/evidence")
    return {
        "molecule_treats_disease": distinct_edges(treats), "disease_involves_pathway": distinct_edges(involves), "disease_associated_gene": distinct_edges(linked),
        "evidence/disease_associated_gene": record(own, "disease_associated_gene", F.col("t"), "gene", base), "evidence/disease_involves_pathway": record(paths, "disease_involves_pathway", F.col("p"), "pathway", F.concat_ws(":", base, "p")),
        "gene": stub_nodes(own.select(F.col("t").alias("id")), genes, f"{SOURCE}/evidence"), "pathway": stubs.withColumn("reactome_id", F.col("id")),
    }


def indications(df: DataFrame) -> dict[str, DataFrame]:
    """Approved indications (3), and indications by phase (4: 3, 3: 2, else 1)."""
    rows = df.withColumn("id", F.trim("id")).where(F.col("id").startswith("CHEMBL"))
    approved = rows.select("id", F.explode("approvedIndications").alias("d")).select("id", normalize_curie(F.col("d")).alias("d"), F.lit("approved indication").alias("display"), F.lit(3).alias("c"), F.lit(None).cast("double").alias("phase"))
    each = rows.select("id", F.explode("indications").alias("i")).withColumn("phase", F.coalesce(F.col("i.maxPhaseForIndication").cast("double"), F.lit(0.0)))
    tried = each.select("id", normalize_curie(F.col("i.disease")).alias("d"), F.concat(F.lit("indication (phase "), F.format_string("%.0f", "phase"), F.lit(")")).alias("display"), F.when(F.col("phase") >= 4, 3).when(F.col("phase") >= 3, 2).otherwise(1).alias("c"), "phase")
    every = approved.unionByName(tried).where("d IS NOT NULL")
    return {"molecule_treats_disease": every.select(*edge(F.col("id"), "molecule", F.col("d"), "disease", "molecule_treats_disease", F.col("display"), f"{SOURCE}/indication", F.col("c"), max_phase=F.col("phase")))}


def mechanisms(df: DataFrame) -> dict[str, DataFrame]:
    """Molecules and the genes they target: all pairs of a record's molecules and targets."""
    rows = df.select(F.explode("chemblIds").alias("m"), "targets", text("actionType").alias("action"), text("mechanismOfAction").alias("label")).select(F.trim("m").alias("m"), F.explode("targets").alias("g"), "action", "label").withColumn("g", F.trim("g"))
    rows = rows.where(F.col("m").startswith("CHEMBL") & F.col("g").startswith("ENSG"))
    return {"molecule_targets_gene": rows.select(*edge(F.col("m"), "molecule", F.col("g"), "gene", "molecule_targets_gene", F.coalesce("label", "action", F.lit("targets")), SOURCE, 3, action_type=F.coalesce("action", F.lit(""))))}


def essentiality(df: DataFrame, dataset: str) -> dict[str, DataFrame]:
    """Cell lines of screens, and what screens measure: dependency, expression, tissue, disease, and what the dataset holds."""
    genes = df.select(F.trim("id").alias("gene"), "geneEssentiality").where(F.col("gene").startswith("ENSG"))
    each = genes.select("gene", F.explode("geneEssentiality").alias("e")).select("gene", F.col("e.isEssential").alias("essential"), F.explode("e.depMapEssentiality").alias("m"))
    tissue = normalize_curie(F.col("m.tissueId"))
    each = each.withColumn("tissue", F.when(tissue.startswith("UBERON:"), tissue))
    d = normalize_curie(F.col("s.diseaseCellLineId"))
    screens = each.select("gene", "essential", "tissue", F.explode("m.screens").alias("s")).select("gene", "essential", "tissue", text("s.depmapId").alias("line"), text("s.cellLineName").alias("name"), F.when(d.rlike(DISEASE_PREFIXES), d).alias("disease"), F.col("s.geneEffect").alias("effect"), F.col("s.expression").alias("expression")).where("line IS NOT NULL")
    measured = lambda c: F.col(c).isNotNull() & ~F.isnan(F.col(c).cast("double"))
    depmap, inside = f"{SOURCE}/DepMap", f"{SOURCE}/target_essentiality"
    link = lambda rows, y, y_type, relation, display, **extra: distinct_edges(rows.select(*edge(F.col("line"), "cell_line", F.col(y), y_type, relation, display, depmap, 3, **extra)))
    holds = lambda rows, y, y_type: distinct_edges(rows.where(F.col(y).isNotNull()).select(*edge(F.lit(dataset), "dataset", F.col(y), y_type, f"dataset_contains_{y_type}", f"contains {y_type.replace('_', ' ')}", inside, 3)))
    return {
        "cell_line": distinct_nodes(screens.select(F.col("line").alias("id"), F.col("name").alias("ccle_name"), F.lit(None).cast("string").alias("cosmic_id"), F.col("disease").alias("efo_id"), F.coalesce("name", "line").alias("name"), F.lit(inside).alias("source"))),
        "cell_line_gene_essentiality": link(screens.where(measured("effect") | F.col("essential").isNotNull()), "gene", "gene", "cell_line_gene_essentiality", "gene essentiality", gene_effect=F.col("effect"), is_essential=F.col("essential")),
        "cell_line_expresses_gene": link(screens.where(measured("expression")), "gene", "gene", "cell_line_expresses_gene", "expresses gene", expression=F.col("expression")),
        "cell_line_derived_from_tissue": link(screens.where("tissue IS NOT NULL"), "tissue", "tissue", "cell_line_derived_from_tissue", "derived from tissue"),
        "cell_line_associated_disease": link(screens.where("disease IS NOT NULL"), "disease", "disease", "cell_line_associated_disease", "associated disease"),
        "dataset_contains_cell_line": holds(screens, "line", "cell_line"), "dataset_contains_gene": holds(genes, "gene", "gene"), "dataset_contains_tissue": holds(each, "tissue", "tissue"), "dataset_contains_disease": holds(screens, "disease", "disease"),
    }


def disease_phenotypes(df: DataFrame, diseases: DataFrame | None = None, phenotypes: DataFrame | None = None) -> dict[str, DataFrame]:
    """Phenotypes of diseases, negated rows dropped; credibility by the strongest evidence (TAS or PCS 3, IEA 2, else 1).

    Diseases and phenotypes that no given node table has become stubs.
    """
    rows = df.where(F.col("disease").startswith("MONDO_") & F.col("phenotype").startswith("HP_") & ~F.exists(F.coalesce("evidence", F.array()), lambda e: F.coalesce(e["qualifierNot"], F.lit(False))))
    has = lambda *kinds: F.exists("evidence", lambda e: e["evidenceType"].isin(*kinds))
    found = rows.select(*edge(F.translate("disease", "_", ":"), "disease", F.translate("phenotype", "_", ":"), "phenotype", "disease_has_phenotype", "has phenotype", f"{SOURCE}/HPO", F.when(has("TAS", "PCS"), 3).when(has("IEA"), 2).otherwise(1)))
    linked = distinct_edges(found)
    ill = stub_nodes(linked.select(F.col("x_id").alias("id")), diseases, f"{SOURCE}/HPO").withColumn("mondo_id", F.col("id"))
    return {"disease_has_phenotype": linked, "disease": ill, "phenotype": stub_nodes(linked.select(F.col("y_id").alias("id")), phenotypes, f"{SOURCE}/HPO")}


def expression(df: DataFrame, proteins: DataFrame, genes: DataFrame | None = None) -> dict[str, DataFrame]:
    """Expression by tissue and cell type, projected from genes to their proteins (id, ensembl_gene_id) for cell types."""
    each = df.where(F.col("id").startswith("ENSG")).select("id", F.explode("tissues").alias("t")).select("id", F.col("t.efo_code").alias("code"), F.col("t.rna.value").cast("double").alias("tpm"), F.col("t.rna.level").cast("long").alias("level"))
    extra = {"tpm": F.col("tpm"), "expression_level": F.col("level")}
    tissue, cell = each.where(F.col("code").startswith("UBERON_")), each.where(F.col("code").startswith("CL_"))
    of_gene = lambda rows, x, kind: distinct_edges(rows.select(*edge(x, kind, F.col("id"), "gene", f"{kind}_expresses_gene", "expresses", f"{SOURCE}/HPA", 3, **extra)))
    projected = cell.join(proteins.select(F.col("id").alias("protein"), F.col("ensembl_gene_id").alias("id")), "id")
    return {
        "tissue_expresses_gene": of_gene(tissue, F.translate("code", "_", ":"), "tissue"), "cell_type_expresses_gene": of_gene(cell, F.col("code"), "cell_type"),
        "cell_type_expresses_protein": distinct_edges(projected.select(*edge(F.col("code"), "cell_type", F.col("protein"), "protein", "cell_type_expresses_protein", "expresses", f"{SOURCE}/HPA;projected_via_protein_node_xref", 3, gene_id=F.col("id"), **extra))),
        "gene": stub_nodes(df.select("id").where(F.col("id").startswith("ENSG")), genes, f"{SOURCE}/expression"),
    }


def biosamples(df: DataFrame) -> dict[str, DataFrame]:
    node = lambda start, own: distinct_nodes(df.where(F.col("biosampleId").startswith(start)).select(own.alias("id"), text("biosampleName").alias("name"), F.lit(SOURCE).alias("source")))
    return {"cell_type": node("CL_", F.col("biosampleId")), "tissue": node("UBERON_", F.translate("biosampleId", "_", ":"))}


def level_credibility(level: Column) -> Column:
    """Clinical annotation levels: 1A, 1B give 3; 2A, 2B give 2; others 1."""
    return F.when(F.trim(level).isin("1A", "1B"), 3).when(F.trim(level).isin("2A", "2B"), 2).otherwise(1)


def pharmacogenomics(df: DataFrame, mutations: DataFrame | None = None) -> dict[str, DataFrame]:
    rows = df.where("variantId <> ''").select("variantId", "variantRsId", "evidenceLevel", text("pgxCategory").alias("category"), F.coalesce("datasourceId", F.lit(SOURCE)).alias("origin"), F.explode("drugs").alias("d")).where(F.col("d.drugId").startswith("CHEMBL"))
    found = rows.select(*edge(F.col("variantId"), "mutation", F.col("d.drugId"), "molecule", "mutation_affects_molecule_response", "affects response to", F.concat(F.lit(f"{SOURCE}/"), "origin"), level_credibility(F.col("evidenceLevel")), pgx_category=F.col("category")))
    names = rows.select(F.col("variantId").alias("id"), F.trim("variantRsId").alias("name"))
    return {"mutation_affects_molecule_response": distinct_edges(found), "mutation": stub_nodes(names, mutations, f"{SOURCE}/pharmacogenomics"), "molecule": stub_nodes(rows.select(F.col("d.drugId").alias("id")), None, f"{SOURCE}/pharmacogenomics")}


def _consequences(df: DataFrame) -> DataFrame:
    return df.where("variantId <> ''").select("variantId", F.explode("transcriptConsequences").alias("c"))


def protein_changes(df: DataFrame, proteins: DataFrame, canonical: bool = False) -> DataFrame:
    """Variants that change a protein, by the accession's protein (id, uniprot_id); an accession that several have goes to the smallest id."""
    owner = proteins.where("uniprot_id <> ''").groupBy(F.col("uniprot_id").alias("u")).agg(F.min("id").alias("protein"))
    rows = _consequences(df)
    rows = rows.where(F.coalesce("c.isEnsemblCanonical", F.lit(False))) if canonical else rows
    rows = rows.where(text("c.aminoAcidChange").isNotNull() & (F.col("c.aminoAcidChange") != "nan")).select("variantId", F.col("c.aminoAcidChange").alias("change"), F.explode("c.uniprotAccessions").alias("u")).where("u <> ''").join(owner, "u")
    return distinct_edges(rows.select(*edge(F.col("variantId"), "mutation", F.col("protein"), "protein", "mutation_causes_protein_change", "causes protein change", SOURCE, 3, amino_acid_change=F.col("change"), uniprot_id=F.col("u"))))


def variants(df: DataFrame, proteins: DataFrame) -> dict[str, DataFrame]:
    """Mutations, and the genes, transcripts and proteins of their canonical consequences."""
    nodes = df.select(F.col("variantId").alias("id"), F.col("hgvsId").alias("hgvs"), F.get("rsIds", F.lit(0)).alias("clinvar_id"), F.col("variantId").alias("gnomad_id"), F.coalesce("hgvsId", "variantId").alias("name"), F.lit(SOURCE).alias("source"))
    canonical = _consequences(df).where(F.coalesce("c.isEnsemblCanonical", F.lit(False)))
    link = lambda c, start, kind, relation, display: distinct_edges(canonical.where(F.col(f"c.{c}").startswith(start)).select(*edge(F.col("variantId"), "mutation", F.col(f"c.{c}"), kind, relation, display, SOURCE, 3)))
    return {
        "mutation": distinct_nodes(nodes), "mutation_in_gene": link("targetId", "ENSG", "gene", "mutation_in_gene", "in gene"), "mutation_affects_transcript": link("transcriptId", "ENST", "transcript", "mutation_affects_transcript", "affects transcript"),
        "mutation_causes_protein_change": protein_changes(df, proteins, canonical=True),
    }


def locus_links(credible: DataFrame, scored_loci: DataFrame, at_least: float) -> DataFrame:
    """Lead and other variants of credible sets (studyLocusId, variantId, locus) with the genes and diseases their locus is scored for."""
    every = credible.select("studyLocusId", "variantId").union(credible.select("studyLocusId", F.explode("locus.variantId"))).where("variantId <> ''").distinct()
    return every.join(scored_loci.where(F.col("score") >= at_least), "studyLocusId").groupBy("variantId", "geneId", "diseaseId").agg(F.max("score").alias("score"), F.count_distinct("studyLocusId").alias("n_loci"))


def enhancers(df: DataFrame) -> dict[str, DataFrame]:
    """Enhancers and what they regulate or are active in; credibility by score (0.5, 0.9)."""
    rows = df.where("intervalId <> ''").withColumn("origin", F.concat(F.lit(f"{SOURCE}/"), F.coalesce("datasourceId", F.lit("E2G")))).withColumn("c", credibility_from_score(F.expr("try_cast(score AS double)"), 0.5, 0.9))
    active = lambda start, kind, display: distinct_edges(rows.where(F.col("biosampleId").startswith(start)).select(*edge(F.col("intervalId"), "enhancer", normalize_curie(F.col("biosampleId")), kind, f"enhancer_active_in_{kind}", display, F.col("origin"), F.col("c"))))
    return {
        "enhancer": distinct_nodes(rows.select(F.col("intervalId").alias("id"), "chromosome", "start", "end", F.col("intervalId").alias("name"), F.col("origin").alias("source"))),
        "enhancer_regulates_gene": distinct_edges(rows.where(F.col("geneId").startswith("ENSG")).select(*edge(F.col("intervalId"), "enhancer", F.col("geneId"), "gene", "enhancer_regulates_gene", "regulates", F.col("origin"), F.col("c"), e2g_score=F.col("score")))),
        "enhancer_active_in_tissue": active("UBERON_", "tissue", "active in tissue"), "enhancer_active_in_cell_type": active("CL_", "cell_type", "active in cell type"),
    }


def gene_ontology(terms: DataFrame, annotated: DataFrame) -> dict[str, DataFrame]:
    """Terms as pathways, and the genes annotated with them."""
    own = F.coalesce(normalize_curie(F.col("id")), F.col("id"))
    nodes = terms.select(own.alias("id"), F.when(own.startswith("GO:"), own).alias("go_id"), F.lit(None).cast("string").alias("kegg_id"), F.col("label").alias("name"), F.lit(f"{SOURCE}/go").alias("source"))
    each = annotated.where(F.col("id").startswith("ENSG")).select("id", F.explode("go").alias("g")).withColumn("term", F.coalesce(normalize_curie(F.col("g.id")), F.col("g.id"))).where(F.col("term").startswith("GO:"))
    return {"pathway": distinct_nodes(nodes), "pathway_contains_gene": each.select(*edge(F.col("term"), "pathway", F.col("id"), "gene", "pathway_contains_gene", "contains gene", f"{SOURCE}/go", 3, predicate=F.coalesce("g.evidence", F.lit("")), aspect=F.coalesce("g.aspect", F.lit(""))))}

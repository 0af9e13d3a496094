"""Node types and relations of the graph: what every table must hold, and which ends a relation joins."""

from __future__ import annotations

from typing import NamedTuple

#: Node types, the ontology of their ids, and the cross-reference columns of their tables.
NODE_TYPES = {
    "gene": ("Ensembl", ("ncbi_gene_id", "hgnc_id", "uniprot_id", "gene_name")),
    "transcript": ("Ensembl", ("ensembl_gene_id", "protein_id", "refseq_mrna", "ccds_id")),
    "protein": ("Ensembl Protein", ("ensembl_gene_id", "uniprot_id", "refseq_protein", "pdb_ids")),
    "disease": ("EFO", ("mondo_id", "omim_id", "doid_id", "icd10_code", "mesh_id", "hp_id")),
    "cell_type": ("CL", ("uberon_id", "mesh_id")),
    "tissue": ("UBERON", ("bto_id", "mesh_id", "fma_id")),
    "molecule": ("ChEMBL", ("drugbank_id", "pubchem_cid", "cas_rn", "inchikey", "smiles")),
    "phenotype": ("HP", ("mondo_id", "efo_id", "mp_id", "mesh_id")),
    "pathway": ("Reactome", ("go_id", "kegg_id")),
    "mutation": ("dbSNP", ("hgvs", "clinvar_id", "gnomad_id")),
    "organism": ("NCBI Taxonomy", ("gbif_id",)),
    "cell_line": ("Cellosaurus", ("ccle_name", "cosmic_id", "efo_id")),
    "paper": ("PubMed", ("doi", "pmc_id", "arxiv_id")),
    "dataset": ("DOI / UUID", ()),
    "enhancer": ("ENCODE", ("ensembl_regulatory_id", "encode_experiment_id")),
}
#: Node types that only say where a fact comes from; relations with such an end are no part of the training graph.
PROVENANCE_TYPES = frozenset({"paper", "dataset"})


class Relation(NamedTuple):
    name: str
    source: str
    target: str
    kind: str
    direct: bool


#: Relations as name, source type, target type, kind, and whether the link is direct.
_RELATIONS = """
    gene_has_transcript gene transcript central_dogma direct
    transcript_encodes_protein transcript protein central_dogma direct
    mutation_in_gene mutation gene genetic direct
    mutation_associated_gene mutation gene genetic indirect
    mutation_affects_transcript mutation transcript genetic direct
    mutation_causes_protein_change mutation protein genetic direct
    mutation_overlaps_enhancer mutation enhancer genetic indirect
    mutation_associated_disease mutation disease genetic indirect
    mutation_associated_phenotype mutation phenotype genetic indirect
    gene_associated_phenotype gene phenotype phenotype_assoc indirect
    mutation_affects_molecule_response mutation molecule pharmacological indirect
    gene_ortholog_gene gene gene genetic direct
    enhancer_regulates_gene enhancer gene regulatory indirect
    enhancer_regulates_transcript enhancer transcript regulatory direct
    gene_coexpressed_gene gene gene expression indirect
    tissue_expresses_gene tissue gene expression direct
    tissue_expresses_protein tissue protein expression direct
    cell_type_expresses_gene cell_type gene expression direct
    cell_type_expresses_protein cell_type protein expression direct
    cell_line_expresses_gene cell_line gene experimental direct
    cell_line_expresses_protein cell_line protein experimental direct
    cell_line_gene_essentiality cell_line gene experimental indirect
    gene_interacts_gene gene gene physical indirect
    tf_regulates_gene gene gene regulatory direct
    tf_binds_enhancer gene enhancer regulatory direct
    transcript_interacts_protein transcript protein physical direct
    transcript_interacts_gene transcript gene regulatory indirect
    protein_interacts_protein protein protein physical direct
    pathway_contains_gene pathway gene pathway indirect
    pathway_contains_protein pathway protein pathway indirect
    pathway_child_of_pathway pathway pathway ontological direct
    molecule_in_pathway molecule pathway pathway indirect
    molecule_targets_gene molecule gene pharmacological direct
    molecule_targets_protein molecule protein pharmacological direct
    molecule_treats_disease molecule disease pharmacological indirect
    molecule_contraindicates_disease molecule disease pharmacological indirect
    molecule_synergizes_molecule molecule molecule pharmacological indirect
    molecule_parent_of_molecule molecule molecule ontological direct
    cell_type_responds_to_molecule cell_type molecule pharmacological indirect
    cell_line_responds_to_molecule cell_line molecule experimental direct
    molecule_associated_phenotype molecule phenotype pharmacological indirect
    disease_associated_gene gene disease disease_assoc direct
    disease_associated_protein protein disease disease_assoc direct
    disease_involves_pathway pathway disease disease_assoc direct
    disease_manifests_in_tissue disease tissue disease_assoc indirect
    disease_subtype_of_disease disease disease ontological direct
    disease_comorbid_disease disease disease epidemiological indirect
    disease_has_phenotype disease phenotype phenotype_assoc direct
    phenotype_observed_in_tissue tissue phenotype phenotype_assoc direct
    phenotype_subtype_of_phenotype phenotype phenotype ontological direct
    tissue_subtype_of_tissue tissue tissue ontological direct
    cell_type_found_in_tissue cell_type tissue ontological direct
    cell_type_involved_in_disease cell_type disease disease_assoc indirect
    cell_type_subtype_of_cell_type cell_type cell_type ontological direct
    cell_line_models_disease cell_line disease experimental indirect
    cell_line_derived_from_cell_type cell_line cell_type experimental direct
    cell_line_derived_from_tissue cell_line tissue experimental direct
    cell_line_from_organism cell_line organism metadata direct
    organism_has_gene organism gene genetic direct
    organism_has_tissue organism tissue ontological direct
    paper_produced_dataset paper dataset metadata direct
    paper_cites_paper paper paper literature direct
    dataset_contains_disease dataset disease metadata direct
    dataset_contains_molecule dataset molecule metadata direct
    dataset_contains_cell_type dataset cell_type metadata direct
    dataset_contains_cell_line dataset cell_line metadata direct
    dataset_contains_tissue dataset tissue metadata direct
"""
RELATIONS = {r[0]: Relation(*r[:4], r[4] == "direct") for r in map(str.split, _RELATIONS.strip().splitlines())}


def relations_between(source: str, target: str) -> list[str]:
    return [r.name for r in RELATIONS.values() if (r.source, r.target) == (source, target)]


def disconnected() -> frozenset[str]:
    """Relations that are kept as metadata and stay out of the training graph."""
    return frozenset(r.name for r in RELATIONS.values() if {r.source, r.target} & PROVENANCE_TYPES)


def xref_columns(node_type: str) -> tuple[str, ...]:
    if node_type not in NODE_TYPES:
        raise ValueError(f"unknown node type {node_type!r}")
    return NODE_TYPES[node_type][1]


def relation(name: str) -> Relation:
    if name not in RELATIONS:
        raise ValueError(f"unknown relation {name!r}")
    return RELATIONS[name]

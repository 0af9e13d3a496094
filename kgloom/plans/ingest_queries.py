"""Ingest of nested sources that are built from the driver's tables.

A source's records are flat selections that Spark and SQL read alike.  Spark
nests them as the source would hold them and ingests that; the SQL states what
comes out, from the flat records.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import ingest as I
from ..sources.tables import table
from .queries import query

_GENE = "CASE WHEN l_partkey % 10 = 9 THEN 'LRG_' || l_partkey ELSE ' ENSG' || l_partkey END"
#: name: table, condition, columns
FLAT: dict[str, tuple[str, str, dict[str, str]]] = {
    "gene": ("part", "true", {"id": "CASE WHEN p_partkey % 10 = 9 THEN 'LRG_' || p_partkey ELSE ' ENSG' || p_partkey END", "symbol": "CASE WHEN p_size % 7 = 0 THEN ' ' ELSE upper(p_name) END", "pk": "p_partkey", "size": "p_size"}),
    "transcript": ("lineitem", "true", {"id": _GENE, "k": "l_orderkey * 10 + l_linenumber", "q": "l_quantity", "transcript": "CASE WHEN l_linenumber = 7 THEN 'NM_' || l_orderkey ELSE 'ENST' || l_orderkey END", "protein": "CASE WHEN l_linenumber % 2 = 0 THEN 'ENSP' || (l_orderkey - l_orderkey % 2) WHEN l_linenumber = 3 THEN 'NP_1' ELSE '' END", "own": "CASE WHEN l_suppkey % 3 = 0 THEN 'Q' || l_suppkey ELSE ' ' END"}),
    "homologue": ("lineitem", "l_linenumber <= 3", {"id": _GENE, "kind": "CASE l_returnflag WHEN 'A' THEN 'ortholog_one2one' WHEN 'R' THEN 'ortholog_one2many' ELSE 'within_species_paralog' END", "sure": "CASE l_suppkey % 4 WHEN 0 THEN '1' WHEN 1 THEN 'TRUE' WHEN 2 THEN 'false' END", "target": "CASE WHEN l_orderkey % 5 = 0 THEN 'FBgn' || l_orderkey WHEN l_orderkey % 5 = 1 THEN 'ENSG' || l_partkey ELSE 'ENSMUSG' || l_orderkey END", "species": "l_linenumber || ''"}),
    "disease": ("customer", "true", {"id": "CASE c_custkey % 3 WHEN 0 THEN 'EFO_' || c_custkey WHEN 1 THEN ' MONDO_' || c_custkey ELSE 'Orphanet_' || c_custkey END", "name": "c_name", "k": "c_custkey", "parent": "CASE WHEN c_custkey % 3 = 0 AND c_custkey % 2 = 0 THEN 'EFO:' || c_custkey WHEN c_nationkey % 5 = 0 THEN '' ELSE 'EFO_' || c_nationkey END"}),
    "molecule": ("part", "true", {"id": "CASE WHEN p_partkey % 6 = 5 THEN 'DRUG' || p_partkey ELSE 'CHEMBL' || p_partkey END", "name": "p_name", "k": "p_partkey", "size": "p_size"}),
    "interaction": ("lineitem", "true", {"a": "CASE WHEN l_linenumber = 7 THEN ' ' ELSE 'P' || (l_partkey % 40) END", "b": "'P' || (l_suppkey % 40)", "score": "CASE WHEN l_linenumber = 6 THEN NULL ELSE l_discount * 10 END", "db": "CASE l_returnflag WHEN 'A' THEN 'intact' WHEN 'R' THEN 'string' END"}),
    "record": (
        "lineitem", "true",
        {"t": "CASE l_linenumber WHEN 1 THEN 'CHEMBL' || l_suppkey WHEN 2 THEN 'R-HSA-' || l_suppkey WHEN 3 THEN '' ELSE 'ENSG' || l_partkey END", "d": "CASE WHEN l_orderkey % 9 = 0 THEN 'nan' ELSE 'EFO_' || (l_orderkey % 50) END",
         "kind": "CASE l_orderkey % 7 WHEN 0 THEN 'known_drug' WHEN 1 THEN 'affected_pathway' WHEN 2 THEN 'genetic_association' WHEN 3 THEN 'literature' WHEN 4 THEN 'animal_model' WHEN 5 THEN 'clinical_trial' ELSE 'reactome' END",
         "origin": "CASE l_returnflag WHEN 'A' THEN 'chembl' WHEN 'R' THEN 'eva' ELSE '' END", "score": "l_discount * 10", "drug": "CASE WHEN l_suppkey % 2 = 0 THEN 'CHEMBL' || l_partkey ELSE '' END", "path": "CASE l_suppkey % 3 WHEN 0 THEN 'R-HSA-' || l_partkey WHEN 1 THEN 'WP' || l_partkey END", "path_name": "CASE WHEN l_partkey % 2 = 0 THEN 'Path ' || l_partkey END", "reaction": "CASE WHEN l_suppkey % 5 = 0 THEN 'R-HSA-' || l_orderkey ELSE '' END", "reaction_name": "CASE WHEN l_orderkey % 3 = 0 THEN 'Reaction ' || l_orderkey END", "dataset": "'evidence_' || l_linestatus"},
    ),
    "indication": ("lineitem", "l_linenumber <= 4", {"id": "CASE WHEN l_suppkey % 4 = 3 THEN 'X' || l_partkey ELSE 'CHEMBL' || l_partkey END", "d": "CASE WHEN l_orderkey % 8 = 0 THEN '' ELSE 'MONDO_' || l_orderkey END", "approved": "l_linestatus = 'O'", "phase": "CASE WHEN l_linenumber = 4 THEN NULL ELSE l_orderkey % 5 END"}),
    "screen": (
        "lineitem", "l_linenumber <= 3",
        {"id": _GENE, "essential": "CASE l_linestatus WHEN 'O' THEN true END", "tissue": "CASE l_returnflag WHEN 'A' THEN 'UBERON_' || l_suppkey WHEN 'R' THEN 'CL_1' END", "line": "CASE WHEN l_orderkey % 10 = 0 THEN '' ELSE 'ACH-' || (l_orderkey % 60) END",
         "disease": "CASE l_orderkey % 3 WHEN 0 THEN 'SIDM' || l_orderkey WHEN 1 THEN 'MONDO_' || (l_orderkey % 20) END", "effect": "CASE WHEN l_linenumber = 1 THEN NULL ELSE l_tax END", "expression": "CASE WHEN l_linenumber = 2 THEN NULL ELSE l_discount END"},
    ),
    "phenotype": ("lineitem", "l_linenumber <= 3", {"disease": "CASE WHEN l_suppkey % 10 = 0 THEN 'EFO_' || l_partkey ELSE 'MONDO_' || l_partkey END", "phenotype": "CASE WHEN l_orderkey % 11 = 0 THEN 'MP_1' ELSE 'HP_' || (l_orderkey - l_orderkey % 4) END", "kind": "CASE l_returnflag WHEN 'A' THEN 'TAS' WHEN 'R' THEN 'IEA' ELSE 'ICE' END", "negated": "CASE WHEN l_quantity > 45 THEN true WHEN l_quantity > 40 THEN false END"}),
    "expression": ("lineitem", "true", {"id": "CASE WHEN l_partkey % 10 = 9 THEN 'LRG_1' ELSE 'ENSG' || l_partkey END", "code": "CASE l_linenumber % 3 WHEN 0 THEN 'UBERON_' || l_suppkey WHEN 1 THEN 'CL_' || l_suppkey ELSE 'EFO_1' END", "tpm": "CASE WHEN l_linenumber = 4 THEN NULL ELSE l_quantity END", "level": "CASE WHEN l_linenumber > 2 THEN l_linenumber END"}),
    "sample": ("supplier", "true", {"id": "CASE s_suppkey % 3 WHEN 0 THEN 'UBERON_' || s_suppkey WHEN 1 THEN 'CL_' || s_suppkey ELSE 'EFO_' || s_suppkey END", "name": "s_name"}),
    "response": ("lineitem", "l_linenumber <= 4", {"variant": "CASE WHEN l_orderkey % 12 = 0 THEN '' ELSE '1_' || l_orderkey || '_A_T' END", "rs": "CASE WHEN l_orderkey % 2 = 0 THEN 'rs' || l_orderkey END", "level": "CASE l_orderkey % 5 WHEN 0 THEN '1A' WHEN 1 THEN ' 1B' WHEN 2 THEN '2A' WHEN 3 THEN '3' END", "category": "CASE WHEN l_orderkey % 3 = 0 THEN '' ELSE 'efficacy' END", "drug": "CASE WHEN l_suppkey % 4 = 0 THEN '' ELSE 'CHEMBL' || l_partkey END"}),
    "consequence": (
        "lineitem", "true",
        {"variant": "CASE WHEN l_orderkey % 30 = 0 THEN '' ELSE '2_' || l_orderkey || '_G_C' END", "k": "l_orderkey", "canonical": "CASE l_linenumber % 3 WHEN 0 THEN true WHEN 1 THEN false END", "gene": "CASE WHEN l_partkey % 10 = 9 THEN 'LRG_1' ELSE 'ENSG' || l_partkey END",
         "transcript": "CASE WHEN l_suppkey % 5 = 0 THEN 'NM_1' ELSE 'ENST' || l_partkey END", "change": "CASE l_returnflag WHEN 'A' THEN 'V' || l_linenumber WHEN 'R' THEN ' ' END", "u": "CASE WHEN l_suppkey % 2 = 0 THEN 'U' || (l_partkey - l_partkey % 2) ELSE '' END"},
    ),
    "uniprot": ("part", "true", {"id": "'ENSP' || p_partkey", "u": "CASE WHEN p_size % 3 = 0 THEN '' ELSE 'U' || (p_partkey - p_partkey % 2) END", "gene": "'ENSG' || p_partkey"}),
    "interval": (
        "lineitem", "true",
        {"id": "CASE WHEN l_orderkey % 20 = 0 THEN '' ELSE 'EH38E' || (l_orderkey - l_orderkey % 3) END", "gene": "CASE WHEN l_partkey % 10 = 9 THEN 'LRG_1' ELSE 'ENSG' || l_partkey END", "sample": "CASE l_linenumber % 3 WHEN 0 THEN 'UBERON_' || l_suppkey WHEN 1 THEN 'CL_' || l_suppkey END", "score": "CASE WHEN l_linenumber = 7 THEN NULL ELSE l_discount * 10 END", "origin": "CASE l_returnflag WHEN 'A' THEN 'E2G' WHEN 'R' THEN 'epiraction' END"},
    ),
    "term": ("supplier", "true", {"id": "CASE s_suppkey % 4 WHEN 3 THEN 'KEGG:' || s_suppkey WHEN 2 THEN 'GO_' || s_suppkey ELSE 'GO:' || s_suppkey END", "label": "s_name"}),
    "annotation": ("lineitem", "l_linenumber <= 2", {"id": "CASE WHEN l_partkey % 10 = 9 THEN 'LRG_1' ELSE 'ENSG' || l_partkey END", "term": "CASE l_suppkey % 4 WHEN 3 THEN 'KEGG:' || l_suppkey WHEN 2 THEN 'GO_' || l_suppkey ELSE 'GO:' || l_suppkey END", "evidence": "l_returnflag", "aspect": "l_linestatus"}),
    "locus": ("lineitem", "true", {"locus": "'L' || l_orderkey", "variant": "CASE WHEN l_suppkey % 7 = 0 THEN '' ELSE '3_' || l_partkey || '_C_G' END", "lead": "l_linenumber = 1"}),
    "locus_score": ("orders", "true", {"studyLocusId": "'L' || o_orderkey", "geneId": "'ENSG' || (o_custkey % 100)", "diseaseId": "'EFO:' || (o_custkey % 30)", "score": "(o_orderkey % 20) / 20.0"}),
}


def _flat(spark: SparkSession, d: str, name: str) -> DataFrame:
    source, where, columns = FLAT[name]
    return table(spark, d, source).where(where).selectExpr(*[f"{e} AS `{c}`" for c, e in columns.items()])


def _cte(*names: str) -> str:
    out = []
    for name in names:
        source, where, columns = FLAT[name]
        out.append(f"{name} AS (SELECT " + ", ".join(f'{e} AS "{c}"' for c, e in columns.items()) + f" FROM {source} WHERE {where})")
    return "WITH " + ", ".join(out)


def _nested(df: DataFrame, key: str, name: str, **fields: str) -> DataFrame:
    """One row for each key with a sorted list of structs."""
    item = F.struct(*[F.col(c).alias(f) for f, c in fields.items()])
    return df.groupBy(key).agg(F.array_sort(F.collect_list(item)).alias(name))


def _edges(found: dict[str, DataFrame], *relations: str) -> DataFrame:
    out = None
    for r in relations:
        one = found[r].select("relation", "x_id", "y_id", "source", "credibility")
        out = one if out is None else out.unionAll(one)
    return out


def _targets(spark: SparkSession, d: str) -> DataFrame:
    genes, t = _flat(spark, d, "gene"), _flat(spark, d, "transcript")
    nested = _nested(t, "id", "transcripts", order="k", q="q", transcriptId="transcript", translationId="protein", uniprotId="own").withColumn("transcripts", F.transform("transcripts", lambda x: x.dropFields("order", "q").withField("biotype", F.lit("protein_coding"))))
    size = F.col("size")
    xref = lambda s, i: F.struct(F.lit(s).alias("source"), i.alias("id"))
    proteins = F.array(xref("uniprot_trembl", F.concat(F.lit("T"), "pk")), xref("uniprot_swissprot", F.when(size % 3 == 0, F.concat(F.lit("S"), "pk")).otherwise("")), xref("ensembl_PRO", F.lit("E")))
    xrefs = F.array(xref("HGNC", F.when(size % 4 == 0, "").otherwise(F.concat(F.lit(" H"), "pk"))), xref("HGNC", F.lit("H0")), xref("EntrezGene", F.col("pk").cast("string")))
    return genes.join(nested, "id", "left").select("id", F.col("symbol").alias("approvedSymbol"), F.lit("a gene").alias("approvedName"), F.when(size % 11 > 0, proteins).alias("proteinIds"), xrefs.alias("dbXrefs"), "transcripts")


@query(f"{_cte('gene')} SELECT trim(id) AS id, trim(symbol) AS name, pk::VARCHAR AS ncbi_gene_id, CASE WHEN size % 4 = 0 THEN 'H0' ELSE 'H' || pk END AS hgnc_id, CASE WHEN size % 11 = 0 THEN NULL WHEN size % 3 = 0 THEN 'S' || pk ELSE 'T' || pk END AS uniprot_id FROM gene WHERE trim(id) LIKE 'ENSG%'")
def q_ingest_target_genes(spark: SparkSession, d: str) -> DataFrame:
    return I.targets(_targets(spark, d))["gene"].select("id", "name", "ncbi_gene_id", "hgnc_id", "uniprot_id")


_PLACED = f"""{_cte('gene', 'transcript')}, p AS (SELECT trim(t.id) AS gene, CASE WHEN size % 11 = 0 THEN NULL WHEN size % 3 = 0 THEN 'S' || pk ELSE 'T' || pk END AS gene_uniprot, nullif(trim(transcript), '') AS transcript, nullif(trim(protein), '') AS protein, nullif(trim(own), '') AS own,
  trim(t.id) || chr(1) || lpad((row_number() OVER (PARTITION BY t.id ORDER BY k, q, transcript, protein, own))::VARCHAR, 6, '0') AS place FROM transcript t JOIN gene g ON g.id = t.id WHERE trim(t.id) LIKE 'ENSG%')"""


@query(f"{_PLACED} SELECT 'transcript' AS node_type, transcript AS id, arg_max(gene, place) AS ensembl_gene_id, nullif(arg_max(CASE WHEN protein LIKE 'ENSP%' THEN protein ELSE '' END, place), '') AS other FROM p WHERE transcript LIKE 'ENST%' GROUP BY transcript UNION ALL SELECT 'protein', protein, arg_max(gene, place), nullif(arg_max(coalesce(own, gene_uniprot, ''), place), '') FROM p WHERE protein LIKE 'ENSP%' GROUP BY protein")
def q_ingest_target_products(spark: SparkSession, d: str) -> DataFrame:
    found = I.targets(_targets(spark, d))
    one = lambda kind, other: found[kind].select(F.lit(kind).alias("node_type"), "id", "ensembl_gene_id", F.col(other).alias("other"))
    return one("transcript", "protein_id").unionAll(one("protein", "uniprot_id"))


@query(f"{_PLACED} SELECT 'gene_has_transcript' AS relation, gene AS x_id, transcript AS y_id, 'OpenTargets/target' AS source, 3 AS credibility FROM p WHERE transcript LIKE 'ENST%' UNION ALL SELECT 'transcript_encodes_protein', transcript, protein, 'OpenTargets/target', 3 FROM p WHERE transcript LIKE 'ENST%' AND protein LIKE 'ENSP%'")
def q_ingest_target_edges(spark: SparkSession, d: str) -> DataFrame:
    return _edges(I.targets(_targets(spark, d)), "gene_has_transcript", "transcript_encodes_protein")


@query(f"{_cte('homologue')} SELECT DISTINCT 'gene_ortholog_gene' AS relation, trim(id) AS x_id, target AS y_id, 'OpenTargets/target.homologues' AS source, 3 AS credibility FROM homologue WHERE trim(id) LIKE 'ENSG%' AND kind LIKE 'ortholog_%' AND lower(sure) IN ('1', 'true') AND target LIKE 'ENS%' AND target <> trim(id)")
def q_ingest_orthologs(spark: SparkSession, d: str) -> DataFrame:
    source = _nested(_flat(spark, d, "homologue"), "id", "homologues", homologyType="kind", isHighConfidence="sure", targetGeneId="target", targetGeneSymbol="target", speciesId="species").withColumn("approvedSymbol", F.lit(""))
    return _edges(I.orthologs(source, cross_species=True), "gene_ortholog_gene")


def _diseases(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("k").cast("string")
    xrefs = F.array(F.concat(F.lit("OMIM:"), k), F.when(F.col("k") % 2 == 0, F.concat(F.lit("MONDO:"), k)), F.lit("MONDO:0"), F.concat(F.lit("MESH:"), k), F.concat(F.lit("MeSH:"), k), F.concat(F.lit(" ICD10:"), k), F.lit("UMLS:1"))
    return _flat(spark, d, "disease").select("id", "name", F.lit(None).cast("string").alias("description"), F.when(F.col("k") % 5 > 0, F.array_compact(xrefs)).alias("dbXRefs"), F.array("parent").alias("parents"))


@query(f"{_cte('disease')}, c AS (SELECT replace(trim(id), '_', ':') AS own, replace(parent, '_', ':') AS up, * FROM disease) SELECT own AS id, name, CASE WHEN k % 5 > 0 THEN CASE WHEN k % 2 = 0 THEN 'MONDO:' || k ELSE 'MONDO:0' END END AS mondo_id, CASE WHEN k % 5 > 0 THEN k::VARCHAR END AS omim_id, CASE WHEN k % 5 > 0 THEN 'MESH:' || k END AS mesh_id, CASE WHEN k % 5 > 0 THEN k::VARCHAR END AS icd10_code, CASE WHEN up <> '' AND up <> own THEN up END AS parent FROM c")
def q_ingest_diseases(spark: SparkSession, d: str) -> DataFrame:
    found = I.diseases(_diseases(spark, d))
    return found["disease"].select("id", "name", "mondo_id", "omim_id", "mesh_id", "icd10_code").join(found["disease_subtype_of_disease"].select(F.col("x_id").alias("id"), F.col("y_id").alias("parent")), "id", "left")


@query(f"{_cte('molecule')} SELECT id, name, size % 2 = 0 AND size % 3 > 0 AS is_approved, CASE WHEN size % 5 = 0 THEN NULL ELSE (size % 4)::DOUBLE END AS phase, 'DB' || k AS drugbank_id, CASE WHEN size % 2 = 0 THEN 'C' || k END AS pubchem_cid FROM molecule WHERE id LIKE 'CHEMBL%'")
def q_ingest_molecules(spark: SparkSession, d: str) -> DataFrame:
    size, k = F.col("size"), F.col("k").cast("string")
    ref = lambda source, *ids: F.struct(F.lit(source).alias("source"), F.array(*ids).cast("array<string>").alias("ids"))
    refs = F.array(ref("DrugBank", F.concat(F.lit("DB"), k), F.lit("DB0")), F.when(size % 2 == 0, ref("PubChem", F.concat(F.lit("C"), k))).otherwise(ref("pubchem")), ref("wikipedia", k))
    source = _flat(spark, d, "molecule").select("id", "name", F.when(size % 3 > 0, size % 2 == 0).alias("isApproved"), F.when(size % 5 > 0, (size % 4).cast("double")).alias("maximumClinicalStage"), F.lit("").alias("inchiKey"), F.lit("C").alias("canonicalSmiles"), refs.alias("crossReferences"))
    return I.molecules(source)["molecule"].select("id", "name", "is_approved", F.col("max_clinical_trial_phase").alias("phase"), "drugbank_id", "pubchem_cid")


@query(f"{_cte('interaction')}, p AS (SELECT least(trim(a), b) AS x_id, greatest(trim(a), b) AS y_id, 'OpenTargets/' || coalesce(db, 'OpenTargets') AS source, coalesce(score, 0) AS s FROM interaction WHERE trim(a) <> '' AND trim(a) <> b) SELECT 'protein_interacts_protein' AS relation, x_id, y_id, source, max(CASE WHEN s >= 0.75 THEN 2 ELSE 1 END) AS credibility FROM p GROUP BY ALL")
def q_ingest_interactions(spark: SparkSession, d: str) -> DataFrame:
    source = _flat(spark, d, "interaction").select(F.col("a").alias("intA"), F.col("b").alias("intB"), F.col("score").alias("scoring"), F.col("db").alias("sourceDatabase"))
    return _edges(I.interactions(source), "protein_interacts_protein")


_RECORD = f"""{_cte('record')}, r AS (SELECT t, replace(d, '_', ':') AS d, kind, coalesce(nullif(origin, ''), kind) AS origin, CASE WHEN score >= 0.75 AND kind IN ('genetic_association', 'animal_model', 'known_drug', 'clinical_trial') THEN 2 ELSE 1 END AS c,
    coalesce(nullif(drug, ''), CASE WHEN t LIKE 'CHEMBL%' THEN t END) AS drug, list_filter([struct_pack(id := path, name := path_name), struct_pack(id := reaction, name := reaction_name)], lambda p: p.id LIKE 'R-HSA-%') AS told, score, dataset FROM record WHERE t <> '' AND d <> 'nan'),
  w AS (SELECT * EXCLUDE (said), said.id AS p, said.name AS name FROM (SELECT *, unnest(CASE WHEN len(told) > 0 THEN told WHEN t LIKE 'R-HSA-%' THEN [struct_pack(id := t, name := NULL)] ELSE [] END) AS said FROM r WHERE kind IN ('affected_pathway', 'reactome')))"""


def _records(spark: SparkSession, d: str) -> DataFrame:
    return _flat(spark, d, "record").select(F.col("t").alias("targetId"), F.col("d").alias("diseaseId"), F.col("kind").alias("datatypeId"), F.col("origin").alias("datasourceId"), "score", F.col("drug").alias("drugId"), F.array(F.struct(F.col("path").alias("id"), F.col("path_name").alias("name"))).alias("pathways"), F.col("reaction").alias("reactionId"), F.col("reaction_name").alias("reactionName"), "dataset")


@query(f"""{_RECORD} SELECT 'molecule_treats_disease' AS relation, drug AS x_id, d AS y_id, 'OpenTargets/' || origin AS source, max(c) AS credibility FROM r WHERE kind = 'known_drug' AND drug IS NOT NULL GROUP BY ALL
  UNION ALL SELECT 'disease_involves_pathway', p, d, 'OpenTargets/' || origin, max(c) FROM w GROUP BY ALL
  UNION ALL SELECT 'disease_associated_gene', t, d, 'OpenTargets/' || origin, max(CASE WHEN kind = 'clinical_trial' THEN 1 ELSE c END) FROM r WHERE kind <> 'known_drug' AND t LIKE 'ENSG%' GROUP BY ALL""")
def q_ingest_evidence_edges(spark: SparkSession, d: str) -> DataFrame:
    return _edges(I.evidence(_records(spark, d)), "molecule_treats_disease", "disease_involves_pathway", "disease_associated_gene")


@query(f"{_RECORD} SELECT 'disease_associated_gene' AS relation, concat_ws(':', origin, d, t, kind) AS source_record_id, dataset AS source_dataset, count(*) AS n, round(max(score), 4) AS best FROM r WHERE kind <> 'known_drug' AND t LIKE 'ENSG%' GROUP BY ALL UNION ALL SELECT 'disease_involves_pathway', concat_ws(':', origin, d, t, kind, p), dataset, count(*), round(max(score), 4) FROM w GROUP BY ALL")
def q_ingest_evidence_records(spark: SparkSession, d: str) -> DataFrame:
    found = I.evidence(_records(spark, d))
    every = found["evidence/disease_associated_gene"].unionByName(found["evidence/disease_involves_pathway"])
    return every.groupBy("relation", "source_record_id", "source_dataset").agg(F.count("*").alias("n"), F.max("evidence_score").alias("best"))


@query(f"{_RECORD} SELECT 'gene' AS node_type, t AS id, t AS name FROM r WHERE kind <> 'known_drug' AND t LIKE 'ENSG%' AND t NOT IN (SELECT 'ENSG' || p_partkey FROM part WHERE p_size > 20) GROUP BY t UNION ALL SELECT 'pathway', p, coalesce(min(name), p) FROM w WHERE p NOT IN (SELECT 'R-HSA-' || s_suppkey FROM supplier WHERE s_nationkey > 12) GROUP BY p")
def q_ingest_evidence_stubs(spark: SparkSession, d: str) -> DataFrame:
    known = table(spark, d, "part").where("p_size > 20").selectExpr("'ENSG' || p_partkey AS id")
    paths = table(spark, d, "supplier").where("s_nationkey > 12").selectExpr("'R-HSA-' || s_suppkey AS id")
    found = I.evidence(_records(spark, d), known, paths)
    return found["gene"].select(F.lit("gene").alias("node_type"), "id", "name").unionAll(found["pathway"].select(F.lit("pathway"), "id", "name"))


@query(f"{_cte('indication')} SELECT id AS x_id, replace(d, '_', ':') AS y_id, CASE WHEN approved THEN 'approved indication' ELSE 'indication (phase ' || coalesce(phase, 0) || ')' END AS display_relation, CASE WHEN approved OR phase >= 4 THEN 3 WHEN phase >= 3 THEN 2 ELSE 1 END AS credibility FROM indication WHERE id LIKE 'CHEMBL%' AND d <> ''")
def q_ingest_indications(spark: SparkSession, d: str) -> DataFrame:
    rows = _flat(spark, d, "indication")
    approved = rows.where("approved").groupBy("id").agg(F.collect_list("d").alias("approvedIndications"))
    source = approved.join(_nested(rows.where("NOT approved"), "id", "indications", disease="d", maxPhaseForIndication="phase"), "id", "full")
    return I.indications(source)["molecule_treats_disease"].select("x_id", "y_id", "display_relation", "credibility")


@query("SELECT 'CHEMBL' || l_partkey AS x_id, 'ENSG' || l_suppkey AS y_id, CASE l_returnflag WHEN 'A' THEN 'blocks it' WHEN 'R' THEN 'INHIBITOR' ELSE 'targets' END AS display_relation, CASE l_returnflag WHEN 'R' THEN 'INHIBITOR' ELSE '' END AS action_type FROM lineitem WHERE l_partkey % 4 <> 3 AND l_suppkey % 3 > 0 UNION ALL SELECT 'CHEMBL0', 'ENSG' || l_suppkey, CASE l_returnflag WHEN 'A' THEN 'blocks it' WHEN 'R' THEN 'INHIBITOR' ELSE 'targets' END, CASE l_returnflag WHEN 'R' THEN 'INHIBITOR' ELSE '' END FROM lineitem WHERE l_suppkey % 3 > 0")
def q_ingest_mechanisms(spark: SparkSession, d: str) -> DataFrame:
    source = table(spark, d, "lineitem").selectExpr(
        "array(CASE WHEN l_partkey % 4 = 3 THEN 'D' ELSE 'CHEMBL' || l_partkey END, ' CHEMBL0') AS chemblIds", "array(CASE WHEN l_suppkey % 3 = 0 THEN 'TG1' ELSE 'ENSG' || l_suppkey END) AS targets", "CASE l_returnflag WHEN 'R' THEN 'INHIBITOR' END AS actionType", "CASE l_returnflag WHEN 'A' THEN 'blocks it' END AS mechanismOfAction"
    )
    return I.mechanisms(source)["molecule_targets_gene"].select("x_id", "y_id", "display_relation", "action_type")


_SCREEN = f"""{_cte('screen')}, s AS (SELECT trim(id) AS gene, essential, CASE WHEN tissue LIKE 'UBERON%' THEN replace(tissue, '_', ':') END AS tissue, nullif(line, '') AS line, CASE WHEN disease LIKE 'MONDO%' THEN replace(disease, '_', ':') END AS disease, effect, expression FROM screen WHERE trim(id) LIKE 'ENSG%'), m AS (SELECT * FROM s WHERE line IS NOT NULL),
  e AS (SELECT DISTINCT 'cell_line_gene_essentiality' AS relation, line AS x_id, gene AS y_id FROM m WHERE effect IS NOT NULL OR essential IS NOT NULL UNION ALL SELECT DISTINCT 'cell_line_expresses_gene', line, gene FROM m WHERE expression IS NOT NULL UNION ALL SELECT DISTINCT 'cell_line_derived_from_tissue', line, tissue FROM m WHERE tissue IS NOT NULL
    UNION ALL SELECT DISTINCT 'cell_line_associated_disease', line, disease FROM m WHERE disease IS NOT NULL UNION ALL SELECT DISTINCT 'dataset_contains_cell_line', 'DS', line FROM m UNION ALL SELECT DISTINCT 'dataset_contains_gene', 'DS', gene FROM s UNION ALL SELECT DISTINCT 'dataset_contains_tissue', 'DS', tissue FROM s WHERE tissue IS NOT NULL UNION ALL SELECT DISTINCT 'dataset_contains_disease', 'DS', disease FROM m WHERE disease IS NOT NULL)"""


@query(f"{_SCREEN} SELECT relation, x_id, y_id, CASE WHEN relation LIKE 'dataset%' THEN 'OpenTargets/target_essentiality' ELSE 'OpenTargets/DepMap' END AS source, 3 AS credibility FROM e")
def q_ingest_essentiality(spark: SparkSession, d: str) -> DataFrame:
    rows = _flat(spark, d, "screen").select("id", "essential", "tissue", F.struct(F.col("line").alias("depmapId"), F.lit("n").alias("cellLineName"), F.col("disease").alias("diseaseCellLineId"), F.col("effect").alias("geneEffect"), "expression").alias("screen"))
    models = rows.groupBy("id", "essential", "tissue").agg(F.collect_list("screen").alias("screens")).groupBy("id", "essential").agg(F.collect_list(F.struct(F.col("tissue").alias("tissueId"), "screens")).alias("models"))
    source = models.groupBy("id").agg(F.collect_list(F.struct(F.col("essential").alias("isEssential"), F.col("models").alias("depMapEssentiality"))).alias("geneEssentiality"))
    found = I.essentiality(source, "DS")
    return _edges(found, *[r for r in found if r != "cell_line"])


@query(f"{_cte('phenotype')}, g AS (SELECT disease, phenotype, bool_or(coalesce(negated, false)) AS no, max(CASE kind WHEN 'TAS' THEN 3 WHEN 'IEA' THEN 2 ELSE 1 END) AS c FROM phenotype GROUP BY ALL) SELECT 'disease_has_phenotype' AS relation, replace(disease, '_', ':') AS x_id, replace(phenotype, '_', ':') AS y_id, 'OpenTargets/HPO' AS source, c AS credibility FROM g WHERE NOT no AND disease LIKE 'MONDO%' AND phenotype LIKE 'HP%'")
def q_ingest_disease_phenotypes(spark: SparkSession, d: str) -> DataFrame:
    source = _flat(spark, d, "phenotype").groupBy("disease", "phenotype").agg(F.collect_list(F.struct(F.col("kind").alias("evidenceType"), F.col("negated").alias("qualifierNot"))).alias("evidence"))
    return _edges(I.disease_phenotypes(source), "disease_has_phenotype")


@query(f"""{_cte('expression', 'uniprot')}, x AS (SELECT *, id AS gene FROM expression WHERE id LIKE 'ENSG%') SELECT DISTINCT 'tissue_expresses_gene' AS relation, replace(code, '_', ':') AS x_id, gene AS y_id, 'OpenTargets/HPA' AS source, 3 AS credibility FROM x WHERE code LIKE 'UBERON%'
  UNION ALL SELECT DISTINCT 'cell_type_expresses_gene', code, gene, 'OpenTargets/HPA', 3 FROM x WHERE code LIKE 'CL%' UNION ALL SELECT DISTINCT 'cell_type_expresses_protein', code, u.id, 'OpenTargets/HPA;projected_via_protein_node_xref', 3 FROM x JOIN uniprot u ON u.gene = x.gene WHERE code LIKE 'CL%'""")
def q_ingest_expression(spark: SparkSession, d: str) -> DataFrame:
    rna = _flat(spark, d, "expression").select("id", F.struct(F.col("code").alias("efo_code"), F.struct(F.col("tpm").alias("value"), "level").alias("rna")).alias("t"))
    proteins = _flat(spark, d, "uniprot").select("id", F.col("gene").alias("ensembl_gene_id"))
    return _edges(I.expression(rna.groupBy("id").agg(F.collect_list("t").alias("tissues")), proteins), "tissue_expresses_gene", "cell_type_expresses_gene", "cell_type_expresses_protein")


@query(f"{_cte('sample')} SELECT DISTINCT CASE WHEN id LIKE 'CL%' THEN 'cell_type' ELSE 'tissue' END AS node_type, CASE WHEN id LIKE 'CL%' THEN id ELSE replace(id, '_', ':') END AS id, name FROM sample WHERE id LIKE 'CL%' OR id LIKE 'UBERON%'")
def q_ingest_biosamples(spark: SparkSession, d: str) -> DataFrame:
    found = I.biosamples(_flat(spark, d, "sample").select(F.col("id").alias("biosampleId"), F.col("name").alias("biosampleName")))
    one = lambda kind: found[kind].select(F.lit(kind).alias("node_type"), "id", "name")
    return one("cell_type").unionAll(one("tissue"))


def _responses(spark: SparkSession, d: str) -> DataFrame:
    rows = _flat(spark, d, "response").select(F.col("variant").alias("variantId"), F.col("rs").alias("variantRsId"), F.col("level").alias("evidenceLevel"), F.col("category").alias("pgxCategory"), F.lit("pharmgkb").alias("datasourceId"), F.struct(F.col("drug").alias("drugId"), F.lit("x").alias("drugFromSource")).alias("drug"))
    return rows.groupBy(*[c for c in rows.columns if c != "drug"]).agg(F.collect_list("drug").alias("drugs"))


@query(f"{_cte('response')} SELECT 'mutation_affects_molecule_response' AS relation, variant AS x_id, drug AS y_id, 'OpenTargets/pharmgkb' AS source, max(CASE WHEN trim(level) IN ('1A', '1B') THEN 3 WHEN level IN ('2A', '2B') THEN 2 ELSE 1 END) AS credibility FROM response WHERE variant <> '' AND drug <> '' GROUP BY ALL")
def q_ingest_pharmacogenomics(spark: SparkSession, d: str) -> DataFrame:
    return _edges(I.pharmacogenomics(_responses(spark, d)), "mutation_affects_molecule_response")


@query(f"{_cte('response')} SELECT variant AS id, coalesce(min(rs), variant) AS name FROM response WHERE variant <> '' AND drug <> '' GROUP BY variant")
def q_ingest_response_stubs(spark: SparkSession, d: str) -> DataFrame:
    return I.pharmacogenomics(_responses(spark, d))["mutation"].select("id", "name")


_CHANGED = f"""{_cte('consequence', 'uniprot')}, o AS (SELECT u, min(id) AS protein FROM uniprot WHERE u <> '' GROUP BY u)"""


def _variants(spark: SparkSession, d: str) -> DataFrame:
    rows = _flat(spark, d, "consequence").select("variant", "k", F.struct(F.col("canonical").alias("isEnsemblCanonical"), F.col("gene").alias("targetId"), F.col("transcript").alias("transcriptId"), F.col("change").alias("aminoAcidChange"), F.array("u").alias("uniprotAccessions")).alias("c"))
    return rows.groupBy(F.col("variant").alias("variantId"), "k").agg(F.collect_list("c").alias("transcriptConsequences")).withColumns({"hgvsId": F.when(F.col("k") % 2 == 0, F.concat(F.lit("hg"), "k")), "rsIds": F.when(F.col("k") % 3 == 0, F.array(F.concat(F.lit("rs"), "k")))})


def _proteins(spark: SparkSession, d: str) -> DataFrame:
    return _flat(spark, d, "uniprot").select("id", F.col("u").alias("uniprot_id"))


@query(f"""{_CHANGED} SELECT DISTINCT 'mutation_in_gene' AS relation, variant AS x_id, gene AS y_id, 'OpenTargets' AS source, 3 AS credibility FROM consequence WHERE variant <> '' AND canonical AND gene LIKE 'ENSG%' UNION ALL SELECT DISTINCT 'mutation_affects_transcript', variant, transcript, 'OpenTargets', 3 FROM consequence WHERE variant <> '' AND canonical AND transcript LIKE 'ENST%'
  UNION ALL SELECT DISTINCT 'mutation_causes_protein_change', variant, protein, 'OpenTargets', 3 FROM consequence JOIN o USING (u) WHERE variant <> '' AND canonical AND trim(change) <> ''""")
def q_ingest_variants(spark: SparkSession, d: str) -> DataFrame:
    return _edges(I.variants(_variants(spark, d), _proteins(spark, d)), "mutation_in_gene", "mutation_affects_transcript", "mutation_causes_protein_change")


@query(f"{_cte('consequence')} SELECT DISTINCT variant AS id, CASE WHEN k % 2 = 0 THEN 'hg' || k ELSE variant END AS name, CASE WHEN k % 3 = 0 THEN 'rs' || k END AS clinvar_id FROM consequence WHERE variant <> ''")
def q_ingest_mutations(spark: SparkSession, d: str) -> DataFrame:
    return I.variants(_variants(spark, d), _proteins(spark, d))["mutation"].select("id", "name", "clinvar_id")


@query(f"{_CHANGED} SELECT DISTINCT 'mutation_causes_protein_change' AS relation, variant AS x_id, protein AS y_id, 'OpenTargets' AS source, 3 AS credibility FROM consequence JOIN o USING (u) WHERE variant <> '' AND trim(change) <> ''")
def q_ingest_protein_changes(spark: SparkSession, d: str) -> DataFrame:
    return _edges({"p": I.protein_changes(_variants(spark, d), _proteins(spark, d))}, "p")


@query(f"{_cte('locus', 'locus_score')} SELECT variant AS \"variantId\", \"geneId\", \"diseaseId\", max(score) AS score, count(DISTINCT locus) AS n_loci FROM locus JOIN locus_score ON \"studyLocusId\" = locus WHERE variant <> '' AND score >= 0.5 GROUP BY ALL")
def q_locus_links(spark: SparkSession, d: str) -> DataFrame:
    rows = _flat(spark, d, "locus")
    lead = rows.where("lead").groupBy("locus").agg(F.min("variant").alias("variantId"))
    sets = rows.groupBy("locus").agg(F.collect_list(F.struct(F.col("variant").alias("variantId"))).alias("in")).join(lead, "locus", "left").select(F.col("locus").alias("studyLocusId"), "variantId", F.col("in").alias("locus"))
    return I.locus_links(sets, _flat(spark, d, "locus_score").withColumn("score", F.col("score").cast("double")), 0.5)


_INTERVAL = f"{_cte('interval')}, i AS (SELECT *, 'OpenTargets/' || coalesce(origin, 'E2G') AS source, CASE WHEN coalesce(score, 0) <= 0.5 THEN 1 WHEN score <= 0.9 THEN 2 ELSE 3 END AS c FROM interval WHERE id <> '')"


@query(f"{_INTERVAL} SELECT 'enhancer_regulates_gene' AS relation, id AS x_id, gene AS y_id, source, max(c) AS credibility FROM i WHERE gene LIKE 'ENSG%' GROUP BY ALL UNION ALL SELECT CASE WHEN sample LIKE 'CL%' THEN 'enhancer_active_in_cell_type' ELSE 'enhancer_active_in_tissue' END, id, replace(sample, '_', ':'), source, max(c) FROM i WHERE sample IS NOT NULL GROUP BY ALL")
def q_ingest_enhancers(spark: SparkSession, d: str) -> DataFrame:
    source = _flat(spark, d, "interval").select(F.col("id").alias("intervalId"), F.col("gene").alias("geneId"), F.col("sample").alias("biosampleId"), F.lit("1").alias("chromosome"), F.lit(1).alias("start"), F.lit(2).alias("end"), "score", F.col("origin").alias("datasourceId"))
    return _edges(I.enhancers(source), "enhancer_regulates_gene", "enhancer_active_in_tissue", "enhancer_active_in_cell_type")


@query(f"{_cte('term', 'annotation')} SELECT 'pathway' AS kind, replace(id, '_', ':') AS id, label AS other, '' AS evidence FROM term UNION ALL SELECT 'edge', replace(term, '_', ':'), id, evidence || aspect FROM annotation WHERE id LIKE 'ENSG%' AND term LIKE 'GO%'")
def q_ingest_gene_ontology(spark: SparkSession, d: str) -> DataFrame:
    found = I.gene_ontology(_flat(spark, d, "term"), _nested(_flat(spark, d, "annotation"), "id", "go", id="term", evidence="evidence", aspect="aspect"))
    return found["pathway"].select(F.lit("pathway").alias("kind"), "id", F.col("name").alias("other"), F.lit("").alias("evidence")).unionAll(found["pathway_contains_gene"].select(F.lit("edge"), "x_id", "y_id", F.concat("predicate", "aspect")))

"""Variants backed by evidence, over the driver's tables.

Line items stand for records and credible sets, orders for the evidence of a
locus and, twice, for gene scores.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import variants as V
from ..sources.tables import table
from .queries import query

#: name: table and columns, read alike by both engines
FLAT = {
    "record": ("lineitem", {
        "disease": "CASE WHEN l_orderkey % 9 = 0 THEN 'nan' WHEN l_orderkey % 9 = 1 THEN 'HP_' || (l_orderkey % 40) ELSE 'MONDO_' || (l_orderkey % 70) END",
        "kind": "CASE l_suppkey % 5 WHEN 0 THEN ' eva' WHEN 1 THEN 'literature' WHEN 2 THEN 'genetic_association' WHEN 3 THEN 'clingen' ELSE 'intogen' END",
        "origin": "CASE l_returnflag WHEN 'A' THEN 'clinvar' WHEN 'R' THEN '' END", "score": "l_discount * 10", "dataset": "'evidence_' || l_linestatus",
        "own": "CASE l_linenumber WHEN 1 THEN ' rs' || l_partkey WHEN 2 THEN '' WHEN 3 THEN 'nan' END", "listed": "CASE l_linenumber WHEN 2 THEN 'rs' || l_suppkey WHEN 4 THEN ' ' END", "inside": "CASE WHEN l_linenumber > 2 AND l_linenumber < 7 THEN '1_' || l_partkey || '_A_C' END",
    }),
    "credible": ("lineitem", {
        "locus": "CASE WHEN l_orderkey % 31 = 0 THEN NULL ELSE 'L' || l_orderkey END", "variant": "CASE WHEN l_suppkey % 7 = 0 THEN ' ' WHEN l_suppkey % 7 = 1 THEN 'rs' || l_partkey ELSE '3_' || l_partkey || '_C_G' END",
        "exponent": "CASE WHEN l_linenumber = 5 THEN NULL ELSE -3 * l_linenumber END", "beta": "l_tax",
    }),
    "said": ("orders", {
        "locus": "'L' || o_orderkey", "disease": "CASE WHEN o_custkey % 11 = 0 THEN NULL ELSE 'EFO_' || (o_custkey % 30) END", "kind": "CASE o_orderstatus WHEN 'O' THEN 'genetic_association' WHEN 'F' THEN '' END",
        "origin": "CASE o_orderkey % 3 WHEN 0 THEN 'gwas_credible_sets' WHEN 1 THEN 'other' END", "score": "CASE WHEN o_orderkey % 4 = 0 THEN 0.0 ELSE (o_orderkey % 20) / 20.0 END", "resource": "CASE WHEN o_orderkey % 8 = 0 THEN 0.8 END",
    }),
    "gene_score": ("orders", {"locus": "'L' || o_orderkey", "gene": "CASE WHEN o_custkey % 13 = 0 THEN ' ' ELSE 'ENSG' || (o_custkey % 100) END", "score": "CASE WHEN o_orderkey % 6 = 0 THEN NULL ELSE (o_orderkey % 20) / 20.0 END"}),
}


def _flat(spark: SparkSession, d: str, name: str) -> DataFrame:
    source, columns = FLAT[name]
    return table(spark, d, source).selectExpr(*[f"{e} AS `{c}`" for c, e in columns.items()])


def _found(spark: SparkSession, d: str) -> dict[str, DataFrame]:
    score = F.col("score").cast("double").alias("score")
    plain = _flat(spark, d, "record").select(
        F.col("disease").alias("diseaseId"), F.col("kind").alias("datatypeId"), F.col("origin").alias("datasourceId"), score, "dataset", F.col("own").alias("variantId"), F.array("listed").alias("rsIds"), F.array(F.struct(F.lit("x").alias("studyId"), F.col("inside").alias("leadVariantId"))).alias("locus"),
    )
    of_loci = _flat(spark, d, "said").select(F.col("locus").alias("studyLocusId"), F.col("disease").alias("diseaseId"), F.col("kind").alias("datatypeId"), F.col("origin").alias("datasourceId"), score, F.col("resource").cast("double").alias("resourceScore"), F.lit(V.LOCUS_DATASET).alias("dataset"))
    credible = _flat(spark, d, "credible").select(F.col("locus").alias("studyLocusId"), F.col("variant").alias("variantId"), F.col("exponent").alias("pValueExponent"), "beta", F.lit(2.0).alias("pValueMantissa"))
    genes = _flat(spark, d, "gene_score").select(F.col("locus").alias("studyLocusId"), F.col("gene").alias("geneId"), score)
    diseases = table(spark, d, "nation").selectExpr("'MONDO_' || n_nationkey AS id")
    known = table(spark, d, "nation").selectExpr("'ENSG' || n_nationkey AS id")
    return V.evidence_backed_variants(plain.unionByName(of_loci, allowMissingColumns=True), credible, genes, diseases, known)


_CTES = "WITH " + ", ".join(f"{name} AS (SELECT " + ", ".join(f'{e} AS "{c}"' for c, e in columns.items()) + f" FROM {source})" for name, (source, columns) in FLAT.items())
_ROWS = f"""{_CTES},
p AS (SELECT replace(disease, '_', ':') AS d, coalesce(nullif(nullif(trim(own), ''), 'nan'), nullif(trim(listed), ''), inside) AS v, trim(kind) AS kind, coalesce(nullif(origin, ''), trim(kind)) AS origin, score::DOUBLE AS score, dataset, '' AS locus
      FROM record WHERE trim(kind) <> 'literature' AND disease <> 'nan'),
c AS (SELECT locus, trim(variant) AS v, beta, 2.0 * power(10.0, exponent) AS p_value FROM credible WHERE locus IS NOT NULL AND trim(variant) <> '' AND (exponent IS NULL OR exponent <= -8)),
e AS (SELECT locus, replace(disease, '_', ':') AS d, coalesce(nullif(kind, ''), 'gwas_credible_sets') AS kind, coalesce(origin, 'ot_genetics_portal') AS origin, coalesce(nullif(score, 0), nullif(resource, 0), 0)::DOUBLE AS score
      FROM said WHERE disease IS NOT NULL AND coalesce(origin, 'gwas_credible_sets') = 'gwas_credible_sets'),
l AS (SELECT d, v, kind, origin, score, 'evidence_gwas_credible_sets' AS dataset, locus, beta, p_value FROM c JOIN e USING (locus)),
b AS (SELECT d, v, kind, origin, score, dataset, locus, NULL::DOUBLE AS beta, NULL::DOUBLE AS p_value FROM p WHERE v IS NOT NULL UNION ALL SELECT * FROM l),
g AS (SELECT DISTINCT locus, v, trim(gene) AS g, score::DOUBLE AS score FROM c JOIN gene_score USING (locus) WHERE trim(gene) <> '' AND score >= 0.75),
w AS (SELECT *, CASE WHEN score >= 0.75 AND kind IN ('genetic_association', 'animal_model', 'known_drug', 'clinical_trial') THEN 2 ELSE 1 END AS c FROM b)"""


@query(f"""{_ROWS} SELECT 'mutation_associated_disease' AS relation, v AS x_id, d AS y_id, 'OpenTargets/' || origin AS source, kind AS datatype, '' AS locus, max(c) AS credibility FROM w GROUP BY ALL
  UNION ALL SELECT 'mutation_associated_gene', v, g, 'OpenTargets/l2g', 'l2g', locus, 1 FROM g""")
def q_variant_edges(spark: SparkSession, d: str) -> DataFrame:
    found = _found(spark, d)
    one = lambda r, locus: found[r].select("relation", "x_id", "y_id", "source", "datatype", locus.alias("locus"), "credibility")
    return one("mutation_associated_disease", F.lit("")).unionAll(one("mutation_associated_gene", F.col("studyLocusId")))


@query(f"""{_ROWS} SELECT DISTINCT 'mutation_associated_disease' AS relation, v AS x_id, d AS y_id, CASE WHEN locus = '' THEN '' ELSE locus || ':' END || concat_ws(':', origin, d, v, kind) AS source_record_id, dataset AS source_dataset, locus AS study_id, round(score, 4) AS evidence_score, beta AS effect_size, round(log10(p_value), 6) AS log_p FROM b
  UNION ALL SELECT 'mutation_associated_gene', v, g, concat_ws(':', locus, v, g), 'l2g_prediction', locus, round(score, 4), NULL, NULL FROM g""")
def q_variant_evidence(spark: SparkSession, d: str) -> DataFrame:
    found = _found(spark, d)
    ill, gene = found["evidence/mutation_associated_disease"], found["evidence/mutation_associated_gene"]
    both = ill.unionByName(gene, allowMissingColumns=True)
    return both.select("relation", "x_id", "y_id", "source_record_id", "source_dataset", "study_id", "evidence_score", "effect_size", F.round(F.log10("p_value"), 6).alias("log_p"))


@query(f"""{_ROWS} SELECT 'mutation' AS node_type, v AS id, CASE WHEN v LIKE 'rs%' THEN v END AS xref, min('OpenTargets/' || origin) AS source FROM b GROUP BY v
  UNION ALL SELECT 'disease', d, CASE WHEN d LIKE 'MONDO:%' OR d LIKE 'HP:%' THEN d END, 'OpenTargets/evidence' FROM (SELECT d FROM p UNION SELECT d FROM l) WHERE d NOT IN (SELECT 'MONDO:' || n_nationkey FROM nation)
  UNION ALL SELECT 'gene', g, NULL, 'OpenTargets/l2g' FROM g WHERE g NOT IN (SELECT 'ENSG' || n_nationkey FROM nation) GROUP BY g""")
def q_variant_nodes(spark: SparkSession, d: str) -> DataFrame:
    found = _found(spark, d)
    one = lambda kind, xref: found[kind].select(F.lit(kind).alias("node_type"), "id", xref.alias("xref"), "source")
    return one("mutation", F.col("clinvar_id")).unionAll(one("disease", F.coalesce("mondo_id", "hp_id"))).unionAll(one("gene", F.lit(None).cast("string")))

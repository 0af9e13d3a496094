"""Modification sites: suppliers stand for protein entries, line items for their features."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import ptm_sites as P
from ..sources.tables import table
from .queries import query

_SEQUENCE = "translate(repeat(md5('s' || s_suppkey), 4), '0123456789abcdef', 'STYKRCNQHDESTYKR')"
_FEATURE = {
    "accession": "'P' || l_suppkey", "type": "CASE l_linenumber WHEN 1 THEN 'Modified residue' WHEN 2 THEN 'Lipidation' WHEN 3 THEN 'Glycosylation' WHEN 4 THEN 'Disulfide bond' WHEN 5 THEN 'Chain' ELSE 'Modified residue' END",
    "feature_id": "CASE WHEN l_quantity < 10 THEN 'PRO_' || (l_partkey % 50) || '_' || (l_orderkey % 6) ELSE '' END",
    "description": "CASE l_orderkey % 6 WHEN 0 THEN 'Phosphoserine' WHEN 1 THEN 'N6-acetyllysine; in MONDO_0000123 disease' WHEN 2 THEN 'S-palmitoyl cysteine' WHEN 3 THEN '' WHEN 4 THEN 'Phosphotyrosine' ELSE 'odd' END",
    "start": "CASE WHEN l_quantity = 50 THEN NULL ELSE '' || (l_partkey % 140) END", "stop": "CASE WHEN l_quantity = 49 THEN '' || (l_partkey % 140 + 3) WHEN l_quantity = 48 THEN NULL ELSE '' || (l_partkey % 140) END",
    "modifier": "CASE WHEN l_quantity = 47 THEN 'UNKNOWN' WHEN l_quantity > 30 THEN 'EXACT' END", "code": "'ECO:' || l_linenumber", "paper": "CASE WHEN l_returnflag = 'A' THEN '' || l_orderkey END",
}


def _found(spark: SparkSession, d: str, check: bool = False) -> dict[str, DataFrame]:
    rows = table(spark, d, "lineitem").selectExpr(*[f"{e} AS `{c}`" for c, e in _FEATURE.items()])
    end = lambda c, m: F.struct(F.col(c).alias("value"), m.alias("modifier"))
    told = F.array(F.struct(F.col("code").alias("evidenceCode"), F.when(F.col("paper").isNotNull(), "PubMed").alias("source"), F.col("paper").alias("id")))
    feature = F.struct("type", F.col("feature_id").alias("featureId"), "description", F.struct(end("start", F.col("modifier")).alias("start"), end("stop", F.col("modifier")).alias("end")).alias("location"), told.alias("evidences"))
    features = rows.groupBy("accession").agg(F.collect_list(feature).alias("features"))
    entries = table(spark, d, "supplier").selectExpr("'P' || s_suppkey AS primaryAccession", f"named_struct('value', {_SEQUENCE}) AS sequence", "array(named_struct('commentType', CASE WHEN s_nationkey > 12 THEN 'disease' END)) AS comments").join(features, F.col("primaryAccession") == F.col("accession")).drop("accession")
    proteins = table(spark, d, "supplier").where("s_suppkey % 5 > 0").selectExpr("'ENSP' || (s_suppkey % 60) AS id", "'P' || s_suppkey || '|Q' || s_suppkey AS uniprot_id")
    return P.ptm_sites(entries, proteins, "r", check_residue=check)


_SLUG = lambda c: f"lower(regexp_replace(regexp_replace({c}, '[^A-Za-z0-9]+', '_', 'g'), '^_+|_+$', '', 'g'))"
_RULES = f"""WITH r AS (SELECT {", ".join(f'{e} AS "{c}"' for c, e in _FEATURE.items())}, l_suppkey AS k FROM lineitem),
s AS (SELECT s_suppkey AS k, {_SEQUENCE} AS seq, CASE WHEN s_suppkey % 5 > 0 THEN 'ENSP' || (s_suppkey % 60) END AS protein FROM supplier),
f AS (SELECT accession, type AS feature_type, feature_id, description, try_cast(start AS BIGINT) AS position, coalesce(try_cast(stop AS BIGINT), try_cast(start AS BIGINT)) AS end_position, coalesce(modifier, '') AS modifier, code, paper, seq, protein,
  CASE WHEN description LIKE '%serine%' THEN 'S' WHEN description LIKE '%tyrosine%' THEN 'Y' WHEN description LIKE '%lysine%' THEN 'K' WHEN description LIKE '%cysteine%' THEN 'C' ELSE '' END AS hint FROM r JOIN s USING (k) WHERE type <> 'Chain'),
g AS (SELECT *, CASE WHEN position BETWEEN 1 AND len(seq) THEN seq[position] ELSE hint END AS residue, CASE WHEN position BETWEEN 1 AND len(seq) THEN seq[greatest(1, position - 7):least(len(seq), position + 7)] ELSE '' END AS around,
  CASE WHEN description LIKE 'Phospho%' THEN 'MOD:00696' WHEN description LIKE '%acetyl%' THEN 'MOD:00394' WHEN feature_type = 'Glycosylation' THEN 'MOD:00693' WHEN description LIKE '%palmitoyl%' THEN 'MOD:00115' WHEN feature_type LIKE 'Disulfide%' THEN 'MOD:00689' ELSE '' END AS psi,
  concat_ws(':', 'PTMSITE', accession, {_SLUG("feature_type")}, CASE WHEN position = end_position THEN position::VARCHAR ELSE position || '-' || end_position END, substr({_SLUG("coalesce(nullif(feature_id, ''), nullif(description, ''), feature_type)")}, 1, 80)) AS id,
  CASE WHEN position IS NULL OR modifier = 'UNKNOWN' THEN 'no_exact_position' WHEN protein IS NULL THEN 'missing_protein_mapping' END AS reason FROM f),
h AS (SELECT *, CASE WHEN reason IS NULL AND position BETWEEN 1 AND len(seq) AND hint <> '' AND hint <> residue THEN 'residue_differs_from_sequence' ELSE reason END AS strict FROM g)"""


@query(f"{_RULES} SELECT id, min(protein) AS protein_id, min(position) AS position, min(end_position) AS end_position, min(residue) AS residue, min(around) AS sequence_context FROM g WHERE reason IS NULL GROUP BY id")
def q_ptm_sites(spark: SparkSession, d: str) -> DataFrame:
    return _found(spark, d)["sites"].select("id", "protein_id", "position", "end_position", "residue", "sequence_context")


@query(f"""{_RULES}, e AS (SELECT protein, id, coalesce(nullif(feature_id, ''), concat_ws(':', accession, feature_type, position, description)) AS record, paper, psi FROM g WHERE reason IS NULL)
SELECT protein AS x_id, id AS y_id, 'database_record' AS evidence_type, record AS source_record_id, max(psi) AS psi_mod_id FROM e GROUP BY ALL UNION ALL SELECT protein, id, 'paper', record || ':PMID:' || paper, max(psi) FROM e WHERE paper IS NOT NULL GROUP BY protein, id, record, paper""")
def q_ptm_evidence(spark: SparkSession, d: str) -> DataFrame:
    return _found(spark, d)["evidence"].select("x_id", "y_id", "evidence_type", "source_record_id", "psi_mod_id")


@query(f"{_RULES} SELECT coalesce(strict, 'accepted') AS outcome, count(*) AS n FROM h GROUP BY 1")
def q_ptm_counts(spark: SparkSession, d: str) -> DataFrame:
    return _found(spark, d, check=True)["counts"].select("outcome", "n")


@query(f"{_RULES} SELECT DISTINCT id AS ptm_site_id, position, 'MONDO:0000123' AS disease_or_phenotype_id, coalesce(nullif(feature_id, ''), id) AS source_record_id, CASE WHEN paper IS NULL THEN '' ELSE 'PMID:' || paper END AS pmids FROM g WHERE reason IS NULL AND description LIKE '%disease%'")
def q_ptm_disease_candidates(spark: SparkSession, d: str) -> DataFrame:
    return _found(spark, d)["candidates"].select("ptm_site_id", "position", "disease_or_phenotype_id", "source_record_id", "pmids")

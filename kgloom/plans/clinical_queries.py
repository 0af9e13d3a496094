"""Clinical evidence: parts stand for molecules, orders for indications and warnings, line items for edges."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import clinical as C
from ..sources.tables import table
from .queries import query

_EDGE = {"x_id": "CASE l_linenumber % 3 WHEN 0 THEN 'DB' || l_partkey WHEN 1 THEN 'CHEMBL' || l_partkey ELSE 'CTD:' || l_partkey END", "y_id": "CASE WHEN l_suppkey % 2 = 0 THEN 'EFO:' ELSE 'MONDO:' END || (l_orderkey % 9)", "source": "l_returnflag"}
_INDICATION = {
    "id": "CASE WHEN o_orderkey % 10 = 0 THEN ' ' ELSE 'i' || o_orderkey END", "drug": "CASE WHEN o_orderkey % 11 > 0 THEN 'CHEMBL' || (o_orderkey % 2000 + 1) END", "disease": "CASE o_custkey % 3 WHEN 0 THEN 'EFO_' || (o_custkey % 9) WHEN 1 THEN ' MONDO_' || (o_custkey % 9) END",
    "stage": "CASE o_orderpriority WHEN '1-URGENT' THEN 'APPROVAL' WHEN '2-HIGH' THEN 'PHASE_2' WHEN '3-MEDIUM' THEN 'ODD' WHEN '5-LOW' THEN '' END", "report": "CASE WHEN o_orderkey % 4 = 0 THEN 'nct' || o_orderkey WHEN o_orderkey % 4 = 1 THEN 'EMA' END", "warning": "o_orderstatus",
}


def _frames(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    edges = table(spark, d, "lineitem").selectExpr("'molecule_treats_disease' AS relation", *[f"{e} AS {c}" for c, e in _EDGE.items()])
    xref = lambda name, start: f"named_struct('source', '{name}', 'ids', array(concat('{start}', p_partkey), NULL))"
    molecules = table(spark, d, "part").selectExpr("concat('CHEMBL', p_partkey) AS id", f"CASE WHEN p_partkey % 7 > 0 THEN array({xref('drugbank', 'DB')}, {xref('ctd', 'CTD:')}, {xref('wiki', 'W')}) END AS crossReferences")
    orders = table(spark, d, "orders").selectExpr(*[f"{e} AS {c}" for c, e in _INDICATION.items()])
    indications = orders.select("id", F.col("drug").alias("drugId"), F.col("disease").alias("diseaseId"), F.col("stage").alias("maxClinicalStage"), F.array("report", F.lit("x")).alias("clinicalReportIds"))
    warnings = orders.select(F.array("drug").alias("chemblIds"), F.col("disease").alias("efoId"), F.when(F.col("stage").isNotNull(), "EFO_1").alias("efoIdForWarningClass"), F.col("warning").alias("warningType"), F.nullif("stage", F.lit("")).alias("description"))
    return edges, molecules, indications, warnings


_MATCH = f"""WITH e AS (SELECT {", ".join(f"{x} AS {c}" for c, x in _EDGE.items())} FROM lineitem), i AS (SELECT {", ".join(f"{x} AS {c}" for c, x in _INDICATION.items())} FROM orders),
m AS (SELECT 'CHEMBL' || p_partkey AS chembl, unnest(CASE WHEN p_partkey % 7 > 0 THEN ['DB' || p_partkey, 'CTD:' || p_partkey, 'CHEMBL' || p_partkey] ELSE ['CHEMBL' || p_partkey] END) AS mol FROM part),
c AS (SELECT trim(id) AS id, drug, disease, replace(trim(disease), '_', ':') AS y, stage, CASE WHEN report LIKE 'nct%' THEN report ELSE '' END AS nct, concat_ws(';', report, 'x') AS reports FROM i WHERE drug IS NOT NULL AND disease IS NOT NULL),
w AS (SELECT e.*, c.* FROM e JOIN m ON mol = x_id JOIN c ON c.drug = chembl AND c.y = y_id),
v AS (SELECT DISTINCT x_id, y_id, CASE WHEN id = '' THEN 'OpenTargets:clinical_indication' ELSE 'OpenTargets:clinical_indication:' || id END AS record, nct, 'clinical indication; stage=' || coalesce(nullif(stage, ''), 'UNKNOWN') AS predicate, CASE stage WHEN 'APPROVAL' THEN 1.0 WHEN 'PHASE_2' THEN 0.7 ELSE 0.1 END::DOUBLE AS score,
  max(concat_ws(' | ', 'clinical_stage=' || coalesce(stage, ''), 'chembl_id=' || drug, 'ot_disease_id=' || disease, CASE WHEN nct <> '' THEN 'nct_ids=' || nct END, 'clinical_report_ids=' || reports)) OVER (PARTITION BY x_id, y_id, id, nct, coalesce(nullif(stage, ''), 'UNKNOWN')) AS span FROM w)"""


@query(f"{_MATCH} SELECT x_id, y_id, record AS source_record_id, nct AS study_id, predicate, score AS evidence_score, span AS text_span FROM v")
def q_clinical_evidence(spark: SparkSession, d: str) -> DataFrame:
    edges, molecules, indications, _ = _frames(spark, d)
    found = C.clinical_evidence(C.clinical_matches(edges, molecules, indications))
    return found.select("x_id", "y_id", "source_record_id", "study_id", "predicate", "evidence_score", "text_span")


@query(f"{_MATCH} SELECT (SELECT count(*) FROM v) AS n_evidence, (SELECT count(DISTINCT x_id || '|' || y_id) FROM v) AS n_supported, (SELECT count(DISTINCT x_id || '|' || y_id) FROM e) - (SELECT count(DISTINCT x_id || '|' || y_id) FROM v) AS n_unsupported, 0::BIGINT AS n_without_edge")
def q_clinical_coverage(spark: SparkSession, d: str) -> DataFrame:
    edges, molecules, indications, _ = _frames(spark, d)
    return C.coverage(edges, C.clinical_evidence(C.clinical_matches(edges, molecules, indications)))


@query(f"{_MATCH} SELECT warning AS \"warningType\", count(*) AS n_rows, count(disease) AS n_with_efo, count(*) FILTER (stage IS NOT NULL) AS n_with_class_efo, count(nullif(stage, '')) AS n_with_description FROM i GROUP BY 1")
def q_warning_summary(spark: SparkSession, d: str) -> DataFrame:
    return C.warning_summary(_frames(spark, d)[3])


@query(f"{_MATCH}, a AS (SELECT drug, replace(trim(coalesce(disease, CASE WHEN stage IS NOT NULL THEN 'EFO_1' END)), '_', ':') AS y FROM i WHERE drug IS NOT NULL) SELECT count(*) AS n_rows, count(DISTINCT x_id || '|' || y_id) AS n_edges FROM e JOIN m ON mol = x_id JOIN a ON a.drug = chembl AND a.y = y_id")
def q_warning_overlap(spark: SparkSession, d: str) -> DataFrame:
    edges, molecules, _, warnings = _frames(spark, d)
    return C.warning_overlap(edges, molecules, warnings)

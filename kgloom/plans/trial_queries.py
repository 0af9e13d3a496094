"""Trials whose records are customers, linked to the edges of orders."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import trials as T
from ..sources.tables import table
from .queries import query

_NCT = "'NCT' || lpad('' || c_custkey, 8, '0')"
_STATUS = "CASE c_custkey % 5 WHEN 0 THEN 'COMPLETED' WHEN 1 THEN 'Recruiting' WHEN 2 THEN 'TERMINATED' WHEN 3 THEN 'WITHDRAWN' ELSE 'OTHER' END"
_WHY = "CASE WHEN c_custkey % 7 = 0 THEN 'Slow accrual' WHEN c_custkey % 7 = 1 THEN 'adverse events' WHEN c_custkey % 7 = 2 THEN 'futility' ELSE '' END"


def _index(spark: SparkSession, d: str) -> DataFrame:
    record = f"""to_json(named_struct('protocolSection', named_struct('identificationModule', named_struct('briefTitle', c_name), 'statusModule', named_struct('overallStatus', {_STATUS}, 'whyStopped', {_WHY}),
      'designModule', named_struct('phases', array('P' || (c_custkey % 3), 'P9'), 'enrollmentInfo', named_struct('count', c_custkey)), 'conditionsModule', named_struct('conditions', array(c_mktsegment, '', 'x')),
      'armsInterventionsModule', named_struct('interventions', array(named_struct('name', ' drug  ' || c_nationkey, 'type', 'DRUG'), named_struct('name', 'nan', 'type', 'A'))),
      'outcomesModule', named_struct('primaryOutcomes', array(named_struct('measure', 'm' || c_nationkey, 'timeFrame', '1 y'))), 'referencesModule', named_struct('references', array(named_struct('pmid', '' || c_custkey))))))"""
    return T.trial_index(table(spark, d, "customer").where("c_custkey % 4 > 0").selectExpr(f"{_NCT} AS nct_id", f"{record} AS json"))


def _evidence(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "orders").selectExpr("'molecule_treats_disease|C' || (o_orderkey % 300) || '|E' || (o_custkey % 20) AS edge_key", "'C' || (o_orderkey % 300) AS x_id", "'E' || (o_custkey % 20) AS y_id", "'nct' || lpad('' || o_custkey, 8, '0') || ';' || 'NCT' || lpad('' || (o_orderkey % 1500), 8, '0') AS study_id")
    return rows


_CTES = f"""WITH i AS (SELECT {_NCT} AS nct_id, c_name, {_STATUS} AS status, {_WHY} AS why, 'P' || (c_custkey % 3) || '; P9' AS phase, c_custkey, c_mktsegment || '; x' AS conditions, 'drug ' || c_nationkey AS drug, 'm' || c_nationkey AS endpoint,
  CASE WHEN c_custkey % 7 = 1 THEN 'safety_failure_or_harm' WHEN c_custkey % 7 = 0 THEN 'terminated_business_funding_or_feasibility' WHEN c_custkey % 7 = 2 THEN 'failed_efficacy_or_endpoint' WHEN c_custkey % 5 = 2 THEN 'terminated_unknown_reason' WHEN c_custkey % 5 = 3 THEN 'withdrawn_unknown_reason'
    WHEN c_custkey % 5 = 1 THEN 'active_or_recruiting_unknown_outcome' WHEN c_custkey % 5 = 0 THEN 'completed_outcome_unknown' ELSE 'unknown_trial_trajectory' END AS class FROM customer WHERE c_custkey % 4 > 0),
l AS (SELECT DISTINCT 'molecule_treats_disease|C' || (o_orderkey % 300) || '|E' || (o_custkey % 20) AS edge_key, unnest(['NCT' || lpad('' || o_custkey, 8, '0'), 'NCT' || lpad('' || (o_orderkey % 1500), 8, '0')]) AS nct_id FROM orders)"""


@query(f"{_CTES} SELECT nct_id, c_name AS brief_title, status AS overall_status, class AS trajectory_class, phase, c_custkey::BIGINT AS enrollment_count, conditions, drug AS intervention_names, 'A; DRUG' AS intervention_types, 'type=DRUG | name=' || drug || '; type=A' AS intervention_details, 'measure=' || endpoint || ' | time_frame=1 y' AS primary_outcome_text, 1 AS primary_endpoint_count, 'PMID:' || c_custkey AS publication_ids FROM i")
def q_trial_index(spark: SparkSession, d: str) -> DataFrame:
    return _index(spark, d).select("nct_id", "brief_title", "overall_status", "trajectory_class", "phase", "enrollment_count", "conditions", "intervention_names", "intervention_types", "intervention_details", "primary_outcome_text", "primary_endpoint_count", "publication_ids")


@query(f"{_CTES} SELECT edge_key, 'ClinicalTrials.gov:' || nct_id AS source_record_id, class AS direction, 'PMID:' || c_custkey AS paper_id, 'nct_id=' || nct_id || ' | status=' || status || ' | phase=' || phase || ' | trajectory=' || class || ' | sponsor= | conditions=' || conditions || ' | interventions=' || drug || ' | primary_endpoints=' || endpoint || ' | why_stopped=' || why AS text_span FROM l JOIN i USING (nct_id)")
def q_trial_evidence(spark: SparkSession, d: str) -> DataFrame:
    return T.trial_evidence(T.trial_links(_evidence(spark, d)), _index(spark, d)).select("edge_key", "source_record_id", "direction", "paper_id", "text_span")


@query(f"""{_CTES}, t AS (SELECT nct_id, 'brief_title: ' || c_name || chr(10) || 'conditions: ' || conditions || chr(10) || 'intervention_details: type=DRUG | name=' || drug || '; type=A' || chr(10) || 'primary_outcome_text: measure=' || endpoint || ' | time_frame=1 y' || CASE WHEN why <> '' THEN chr(10) || 'why_stopped: ' || why ELSE '' END AS text, why FROM i)
SELECT nct_id, sha256(text) AS source_text_hash, length(text) AS source_text_length, '["brief_title","conditions","intervention_details","primary_outcome_text"' || CASE WHEN why <> '' THEN ',"why_stopped"]' ELSE ']' END AS source_field_inventory FROM t""")
def q_trial_texts(spark: SparkSession, d: str) -> DataFrame:
    return T.trial_texts(_index(spark, d)).select("nct_id", "source_text_hash", "source_text_length", "source_field_inventory")


@query(f"""{_CTES}, f AS (SELECT 'links without trial' AS failure, (SELECT count(*) FROM l ANTI JOIN i USING (nct_id)) AS n UNION ALL SELECT 'trials without link', (SELECT count(*) FROM i ANTI JOIN l USING (nct_id)) UNION ALL SELECT 'links without edge', (SELECT count(*) FROM l WHERE edge_key LIKE '%|C7|%')
  UNION ALL SELECT 'evidence without edge', (SELECT count(*) FROM l JOIN i USING (nct_id) WHERE edge_key LIKE '%|C7|%')) SELECT * FROM f WHERE n > 0""")
def q_trial_failures(spark: SparkSession, d: str) -> DataFrame:
    """Checks over trials of which some have no link, and edges of which one molecule's are missing."""
    index, links = _index(spark, d), T.trial_links(_evidence(spark, d))
    edges = _evidence(spark, d).where("x_id <> 'C7'").select(F.lit(T.RELATION).alias("relation"), "x_id", "y_id").distinct()
    return T.trial_failures(edges, links, index, T.trial_evidence(links, index), T.trial_texts(index))

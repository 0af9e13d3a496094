"""Complexes whose records are orders and whose participants are line items."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import complexes as C
from ..sources.shared import cut
from ..sources.tables import table
from .queries import query

#: A participant of the complex of an order: a protein, another order's complex (eight times smaller, or on a cycle), or something else.
_PART = """CASE WHEN l_linenumber = 1 AND l_orderkey >= 8 THEN 'CPX-' || CAST(floor(l_orderkey / 8) AS BIGINT) || '(' || (l_suppkey % 3) || ')' WHEN l_linenumber = 2 AND l_orderkey % 64 = 0 THEN 'CPX-' || (l_orderkey * 8) || '(1)'
 WHEN l_linenumber = 3 AND l_partkey % 5 = 0 THEN 'CPX-' || l_orderkey WHEN l_linenumber = 4 THEN 'CHEBI:' || l_partkey || '(1)' WHEN l_linenumber = 5 THEN 'uniprotkb:P' || (100000 + l_partkey % 400) ELSE 'P' || (100000 + l_partkey % 400) || '(' || (l_suppkey % 4) || ')' END"""
_TAXON = "CASE WHEN o_custkey % 20 = 0 THEN '10090' ELSE '9606' END"


def _records(spark: SparkSession, d: str) -> DataFrame:
    parts = table(spark, d, "lineitem").selectExpr("l_orderkey", f"{_PART} AS part").groupBy("l_orderkey").agg(F.array_join(F.array_sort(F.collect_set("part")), "|").alias("parts"))
    orders = table(spark, d, "orders").join(parts, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    return orders.selectExpr("'CPX-' || o_orderkey AS `#Complex ac`", f"CASE WHEN o_orderstatus = 'O' THEN '-' ELSE o_orderpriority END AS `{C.NAME}`", f"{_TAXON} AS `{C.TAXON}`", f"parts AS `{C.MOLECULES}`", "'pubmed:' || o_custkey AS `Cross references`")


def _proteins(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "part").selectExpr("'ENSP' || (p_partkey % 450) AS id", "'P' || (100000 + p_partkey % 450 - CASE WHEN p_partkey % 450 % 30 = 1 THEN 1 ELSE 0 END) AS uniprot_id")


def _found(spark: SparkSession, d: str) -> dict[str, DataFrame]:
    return C.complexes(_records(spark, d), _proteins(spark, d))


_RULES = f"""WITH RECURSIVE t AS (SELECT DISTINCT l_orderkey AS k, {_PART} AS raw FROM lineitem JOIN orders ON o_orderkey = l_orderkey WHERE {_TAXON} = '9606'),
p AS (SELECT 'CPX-' || k AS complex, raw, regexp_extract(raw, '^(?:[a-zA-Z]+:)?([^()]+)', 1) AS id, regexp_extract(raw, '\\(([0-9]*)\\)', 1) AS n, CASE WHEN raw LIKE 'CPX%' THEN 'complex_portal' WHEN raw LIKE 'CHEBI%' THEN 'chebi' ELSE 'uniprotkb' END AS space FROM t),
m AS (SELECT acc, min(node) AS node, count(DISTINCT node) AS nodes, string_agg(DISTINCT node, '|' ORDER BY node) AS listed FROM (SELECT 'ENSP' || (p_partkey % 450) AS node, 'P' || (100000 + p_partkey % 450 - CASE WHEN p_partkey % 450 % 30 = 1 THEN 1 ELSE 0 END) AS acc FROM part) GROUP BY acc),
w AS (SELECT p.*, node, coalesce(listed, '') AS listed, CASE WHEN space = 'complex_portal' AND id = complex THEN 'nested_complex_self_reference' WHEN space = 'chebi' THEN 'unsupported_participant_namespace' WHEN space = 'uniprotkb' AND node IS NULL THEN 'uniprot_unmapped_to_protein_node'
  WHEN space = 'uniprotkb' AND nodes > 1 THEN 'uniprot_maps_to_multiple_protein_nodes' END AS reason FROM p LEFT JOIN m ON acc = id AND space = 'uniprotkb')"""


@query(f"""{_RULES} SELECT 'protein_part_of_protein_complex' AS relation, node AS x_id, complex AS y_id, raw, n AS stoichiometry FROM w WHERE reason IS NULL AND space = 'uniprotkb' UNION ALL SELECT 'protein_complex_part_of_protein_complex', id, complex, raw, n FROM w WHERE reason IS NULL AND space = 'complex_portal'""")
def q_complex_evidence(spark: SparkSession, d: str) -> DataFrame:
    return _found(spark, d)["all_evidence"].select("relation", "x_id", "y_id", F.split_part("source_record_id", F.lit("|"), F.lit(2)).alias("raw"), "stoichiometry")


@query(f"{_RULES} SELECT complex AS source_complex_id, id AS source_participant_id, space AS source_participant_namespace, reason, listed AS candidate_protein_ids FROM w WHERE reason IS NOT NULL")
def q_complex_rejects(spark: SparkSession, d: str) -> DataFrame:
    return _found(spark, d)["rejected"].select("source_complex_id", "source_participant_id", "source_participant_namespace", "reason", "candidate_protein_ids")


_FLAT = f"""{_RULES}, s AS (SELECT id AS part, complex AS whole, sum(CASE WHEN n <> '' AND n <> '0' THEN n::BIGINT END) AS times, count(*) FILTER (n IN ('', '0')) > 0 AS vague FROM w WHERE reason IS NULL AND space = 'complex_portal' GROUP BY ALL),
r(part, whole) AS (SELECT part, whole FROM s UNION SELECT r.part, s.whole FROM r JOIN s ON s.part = r.whole), c AS (SELECT part, whole FROM s WHERE (whole, part) IN (SELECT part, whole FROM r)),
f(protein, place, depth, copies) AS (SELECT node, complex, 1, CASE WHEN n <> '' AND n <> '0' THEN n::BIGINT END FROM w WHERE reason IS NULL AND space = 'uniprotkb' UNION ALL SELECT protein, whole, depth + 1, copies * CASE WHEN NOT vague THEN times END FROM f JOIN s ON part = place WHERE (part, whole) NOT IN (SELECT part, whole FROM c))"""


@query(f"{_FLAT} SELECT protein AS x_id, place AS y_id, min(depth) AS depth, CASE WHEN count(*) FILTER (copies IS NULL) = 0 THEN sum(copies)::BIGINT END AS copies FROM f GROUP BY ALL")
def q_complex_members(spark: SparkSession, d: str) -> DataFrame:
    every = cut(_found(spark, d)["all_evidence"].select("relation", "x_id", "y_id", "stoichiometry"))  # tokens are read once
    return C.flattened(every.where(F.col("relation") == C.MEMBER), every.where(F.col("relation") == C.NESTED))[0]


@query(f"{_FLAT} SELECT part, whole FROM c")
def q_complex_cycles(spark: SparkSession, d: str) -> DataFrame:
    return C.nesting_cycles(_found(spark, d)["nested_edges"])

"""Causal features and disease operands of evidence that line items stand for."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import causal_features as C
from ..operators import disease_operands as D
from ..sources.tables import table
from .queries import query

#: relation: columns of its evidence, read alike by both engines
_ENDS = {"source": "'s' || l_linestatus", "source_dataset": "CASE l_suppkey % 3 WHEN 0 THEN 'reviewed_human_disease_comments' WHEN 1 THEN 'humsavar_missense_variants' ELSE 'other' END", "source_record_id": "'R' || (l_suppkey % 5) || ':PMID:' || l_linenumber"}
FLAT = {
    "molecule_targets_gene": {"x_id": "'CHEMBL' || l_partkey", "y_id": "'ENSG' || (l_suppkey % 10)", "action_type": "CASE l_linenumber WHEN 1 THEN ' inhibitor' WHEN 2 THEN 'Partial Agonist' WHEN 3 THEN '' WHEN 4 THEN 'weird' WHEN 5 THEN 'BINDING AGENT' ELSE 'BLOCKER' END", "predicate": "CASE WHEN l_returnflag = 'A' THEN 'opener' END"},
    "disease_associated_protein": {"x_id": "'ENSP' || l_partkey", "y_id": "'EFO:' || (l_suppkey % 5)", "mechanism": "CASE l_linenumber WHEN 1 THEN 'Loss-of function' WHEN 2 THEN 'gain of function' WHEN 3 THEN 'odd' END", "effect_direction": "CASE WHEN l_linenumber = 4 THEN 'Protection' WHEN l_linenumber = 5 THEN 'risk' END", "direction": "CASE WHEN l_returnflag = 'A' THEN 'risk' END", "inheritance": "CASE WHEN l_linenumber = 6 THEN 'X-linked' END"},
    "mutation_associated_disease": {"x_id": "'rs' || l_partkey", "y_id": "'EFO:' || (l_suppkey % 5)", "effect_allele": "CASE WHEN l_linenumber < 4 THEN l_returnflag END", "beta": "CASE l_linenumber WHEN 1 THEN '0.5' WHEN 2 THEN 'x' WHEN 3 THEN '-2' END", "direction": "CASE WHEN l_linenumber = 1 THEN 'risk' WHEN l_linenumber = 2 THEN 'protective' WHEN l_linenumber = 3 THEN 'risk' END"},
    "mutation_affects_molecule_response": {"x_id": "'rs' || l_partkey", "y_id": "'CHEMBL' || (l_suppkey % 5)", "pgx_category": "CASE l_linenumber WHEN 1 THEN 'Efficacy' WHEN 2 THEN 'PK' WHEN 3 THEN 'odd' END", "direction": "CASE l_linenumber WHEN 1 THEN 'increased efficacy' WHEN 4 THEN 'decreased_efficacy' WHEN 5 THEN 'sensitive' END", "disease_context": "CASE WHEN l_returnflag = 'R' THEN 'EFO:' || l_linenumber END"},
}


def _evidence(spark: SparkSession, d: str, relation: str) -> DataFrame:
    x, y, _ = C.RELATIONS[relation]
    columns = {"relation": f"'{relation}'", "x_type": f"'{x}'", "y_type": f"'{y}'"} | _ENDS | FLAT[relation]
    return table(spark, d, "lineitem").selectExpr(*[f"{e} AS `{c}`" for c, e in columns.items()])


def _edges(evidence: DataFrame) -> DataFrame:
    return evidence.select("relation", "x_id", "x_type", "y_id", "y_type").distinct()


def _rows(relation: str, normal: dict[str, str], raw: list[str], usable: str) -> str:
    """SQL of normalised rows (n), of assertions (a) and of edges (e): sets of values, conflicts and counts."""
    columns = _ENDS | FLAT[relation]
    sets = ", ".join(f"list_distinct(flatten(list({c}))) AS {c}" for c in normal)
    told = ", ".join(f"count(*) FILTER (len(list_filter({c}, lambda v: v <> 'unknown')) > 0) AS n_{c}" for c in normal)
    return f"""WITH r AS (SELECT {", ".join(f'{e} AS "{c}"' for c, e in columns.items())} FROM lineitem),
n AS (SELECT x_id, y_id, concat_ws('|', x_id, y_id, source, source_dataset, CASE WHEN source_dataset = 'reviewed_human_disease_comments' THEN split_part(source_record_id, ':PMID:', 1) ELSE source_record_id END) AS aid, concat_ws('|', {", ".join(f"coalesce(trim({c}), '')" for c in raw)}) AS said, {", ".join(f"{e} AS {c}" for c, e in normal.items())} FROM r),
a AS (SELECT x_id, y_id, aid, count(DISTINCT said) > 1 AS bad, bool_or({usable}) AS counted, {", ".join(f"coalesce(list(DISTINCT {c}) FILTER ({c} <> ''), []) AS {c}" for c in normal)} FROM n GROUP BY x_id, y_id, aid),
e AS (SELECT x_id, y_id, bool_or(bad) AS bad, count(*) FILTER (counted) AS evidence_count, {sets}, {told} FROM a GROUP BY x_id, y_id)"""


def _state(values: str, n: str, odds: str) -> str:
    return f"CASE WHEN bad THEN 'conflicting' WHEN {n} = 0 THEN 'unknown' WHEN {odds} THEN 'conflicting' WHEN {n} = 1 THEN 'single' ELSE 'consensus' END"


_json = lambda c: f"CASE WHEN len({c}) = 0 THEN '[]' ELSE '[\"' || array_to_string(list_sort({c}), '\",\"') || '\"]' END"
_action = "upper(coalesce(nullif(trim(action_type), ''), nullif(trim(predicate), ''), ''))"
_effect = lambda c: f"CASE lower(coalesce(nullif(trim({c}), ''), '')) WHEN 'risk' THEN 'risk' WHEN 'protective' THEN 'protective' WHEN 'protection' THEN 'protective' ELSE '' END"


@query(f"""{_rows("molecule_targets_gene", {"action": f"CASE {_action} WHEN 'INHIBITOR' THEN 'inhibitor' WHEN 'PARTIAL AGONIST' THEN 'agonist' WHEN 'BINDING AGENT' THEN 'binder_unknown_effect' WHEN 'BLOCKER' THEN 'blocker' WHEN 'OPENER' THEN 'activator' ELSE '' END", "sign": f"CASE WHEN {_action} IN ('INHIBITOR', 'BLOCKER') THEN 'negative' WHEN {_action} IN ('PARTIAL AGONIST', 'OPENER') THEN 'positive' WHEN {_action} = 'BINDING AGENT' THEN 'unknown' ELSE '' END"}, ["coalesce(nullif(trim(action_type), ''), predicate)"], "action <> ''")}
SELECT x_id, y_id, {_json("action")} AS action_types, {_json("sign")} AS action_direction, {_state("action", "n_action", "list_contains(sign, 'positive') AND list_contains(sign, 'negative')")} AS action_status, evidence_count FROM e""")
def q_action_features(spark: SparkSession, d: str) -> DataFrame:
    ev = _evidence(spark, d, "molecule_targets_gene")
    return C.materialised(_edges(ev), ev, "molecule_targets_gene")[0].select("x_id", "y_id", "action_types", "action_direction", "action_status", "evidence_count")


@query(f"""{_rows("disease_associated_protein", {"mechanism": "CASE mechanism WHEN 'Loss-of function' THEN 'loss_of_function' WHEN 'gain of function' THEN 'gain_of_function' ELSE '' END", "effect": _effect("coalesce(effect_direction, direction)"), "inheritance": "CASE WHEN inheritance = 'X-linked' THEN 'x_linked' ELSE '' END", "support": "CASE source_dataset WHEN 'reviewed_human_disease_comments' THEN 'source_backed_disease_assertion' WHEN 'humsavar_missense_variants' THEN 'source_backed_variant_disease_assertion' ELSE 'source_backed_association' END"}, ["mechanism", "coalesce(effect_direction, direction)", "inheritance"], "true")}
SELECT x_id, y_id, {_json("mechanism")} AS causal_mechanisms, {_state("mechanism", "n_mechanism", "len(mechanism) > 1")} AS mechanism_status, {_json("effect")} AS effect_directions, {_state("effect", "n_effect", "len(effect) > 1")} AS effect_direction_status, {_json("inheritance")} AS inheritance_modes,
  CASE WHEN len(support) = 1 THEN support[1] ELSE 'mixed_source_backed_assertions' END AS causal_support_level, evidence_count FROM e""")
def q_disease_features(spark: SparkSession, d: str) -> DataFrame:
    ev = _evidence(spark, d, "disease_associated_protein")
    out = C.materialised(_edges(ev), ev, "disease_associated_protein")[0]
    return out.select("x_id", "y_id", "causal_mechanisms", "mechanism_status", "effect_directions", "effect_direction_status", "inheritance_modes", "causal_support_level", "evidence_count")


@query(f"""{_rows("mutation_associated_disease", {"allele": "coalesce(effect_allele, '')", "beta": "coalesce(try_cast(beta AS DOUBLE)::VARCHAR, '')", "effect": _effect("direction")}, ["effect_allele", "beta", "direction"], "effect_allele IS NOT NULL OR beta <> '' OR effect <> ''").replace("bool_or(effect_allele IS NOT NULL OR beta <> '' OR effect <> '')", "bool_or(allele <> '' OR beta <> '' OR effect <> '')")}
SELECT x_id, y_id, {_json("allele")} AS effect_alleles, '[' || array_to_string(list_sort(list_transform(beta, lambda b: b::DOUBLE)), ',') || ']' AS beta, {_json("effect")} AS effect_directions, {_state("effect", "n_effect", "len(effect) > 1")} AS association_status, evidence_count FROM e""")
def q_mutation_features(spark: SparkSession, d: str) -> DataFrame:
    ev = _evidence(spark, d, "mutation_associated_disease")
    return C.materialised(_edges(ev), ev, "mutation_associated_disease")[0].select("x_id", "y_id", "effect_alleles", "beta", "effect_directions", "association_status", "evidence_count")


_CATEGORY = "CASE lower(pgx_category) WHEN 'efficacy' THEN 'efficacy' WHEN 'pk' THEN 'metabolism_pk' ELSE '' END"
_DIRECTION = "coalesce(replace(direction, ' ', '_'), '')"


@query(f"""{_rows("mutation_affects_molecule_response", {"category": _CATEGORY, "response": _DIRECTION, "context": "coalesce(disease_context, '')", "assertion": f"CASE WHEN {_CATEGORY} <> '' THEN {_CATEGORY} ELSE {_DIRECTION} END"}, ["pgx_category", "direction", "disease_context"], "category <> '' OR response <> ''")}
SELECT x_id, y_id, {_json("category")} AS response_categories, {_json("response")} AS response_directions, {_state("assertion", "n_assertion", "list_contains(response, 'increased_efficacy') AND list_contains(response, 'decreased_efficacy')")} AS response_status, {_state("context", "n_context", "len(context) > 1")} AS disease_context_status, evidence_count FROM e""")
def q_response_features(spark: SparkSession, d: str) -> DataFrame:
    ev = _evidence(spark, d, "mutation_affects_molecule_response")
    return C.materialised(_edges(ev), ev, "mutation_affects_molecule_response")[0].select("x_id", "y_id", "response_categories", "response_directions", "response_status", "disease_context_status", "evidence_count")


_OPERAND = {
    "relation": "'disease_associated_protein'", "x_id": "'ENSP' || l_partkey", "x_type": "'protein'", "y_id": "'EFO:' || (l_suppkey % 5)", "y_type": "'disease'", "edge_key": "'disease_associated_protein|ENSP' || l_partkey || '|EFO:' || (l_suppkey % 5)",
    "source_dataset": "CASE l_linenumber % 3 WHEN 0 THEN 'reviewed_human_disease_comments' WHEN 1 THEN 'humsavar_missense_variants' ELSE 'other' END", "source": "CASE WHEN l_quantity = 50 THEN 'X' WHEN l_linenumber % 3 = 0 THEN 'UniProtKB' ELSE 'UniProtKB/humsavar' END",
    "source_record_id": "'VAR_' || l_orderkey", "release": "CASE WHEN l_quantity = 49 THEN ' ' ELSE '2024' END", "materialization_assertion_id": "'a' || (l_orderkey % 40)", "disease_source_id": "CASE WHEN l_quantity = 48 THEN '' ELSE 'DI' END",
    "variant_ft_id": "CASE WHEN l_quantity = 47 THEN NULL WHEN l_quantity = 46 THEN 'VAR_0' ELSE 'VAR_' || l_orderkey END", "isoform": "CASE WHEN l_quantity = 45 THEN '2' ELSE 'canonical' END", "uniprot_accession": "'P'",
    "mapping_confidence": "CASE WHEN l_quantity = 44 THEN 'near' ELSE 'exact_uniprot_accession_to_existing_protein_node;exact_disease_xref_to_existing_disease_node' END",
    "disease_description": "CASE WHEN l_quantity < 20 THEN 'A disease due to a gain-of-function defect' ELSE 'A disease' END", "variant_category": "CASE WHEN l_quantity < 25 THEN 'LP/P' ELSE 'US' END",
}
_CHECKED = f"""WITH r AS (SELECT {", ".join(f'{e} AS "{c}"' for c, e in _OPERAND.items())}, l_quantity AS q FROM lineitem),
t AS (SELECT *, CASE WHEN source_dataset = 'other' THEN 'unsupported_source_family_or_mapping' WHEN q = 49 THEN 'missing_source_provenance' WHEN q = 50 THEN 'source_family_mismatch' WHEN q = 48 THEN 'missing_disease_context' WHEN q = 47 AND source_dataset LIKE 'hum%' THEN 'missing_exact_variant_identity'
  WHEN q = 45 THEN 'mixed_or_noncanonical_isoform' WHEN q = 44 THEN 'ambiguous_or_inexact_mapping' WHEN q = 46 AND source_dataset LIKE 'hum%' THEN 'variant_source_record_mismatch' WHEN NOT (CASE WHEN source_dataset LIKE 'hum%' THEN q < 25 ELSE q < 20 END) THEN 'no_eligible_explicit_operand' ELSE '' END AS why FROM r),
o AS (SELECT *, CASE WHEN why = '' AND source_dataset LIKE 'rev%' THEN 'gain_of_function' ELSE '' END AS m, CASE WHEN why = '' THEN 'risk' ELSE '' END AS w FROM t)"""


def _operand_evidence(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "lineitem").selectExpr(*[f"{e} AS `{c}`" for c, e in _OPERAND.items()])


def _operand_edges(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    ev = _operand_evidence(spark, d)
    return (*D.materialised_operands(_edges(ev), ev), ev)


@query(f"""{_CHECKED}, a AS (SELECT x_id, y_id, materialization_assertion_id AS id, count(DISTINCT m) > 1 AS mx, max(m) AS m, count(DISTINCT w) > 1 AS wx, max(w) AS w FROM o GROUP BY ALL),
e AS (SELECT x_id, y_id, bool_or(mx) AS mx, count(*) FILTER (m <> '') AS mn, bool_or(wx) AS wx, count(*) FILTER (w <> '') AS wn FROM a GROUP BY ALL),
s AS (SELECT x_id, y_id, CASE WHEN mn > 0 THEN '["gain_of_function"]' ELSE '[]' END AS causal_mechanisms, CASE WHEN mx THEN 'conflicting' WHEN mn = 0 THEN 'unknown' WHEN mn = 1 THEN 'single' ELSE 'consensus' END AS mechanism_status,
  CASE WHEN wn > 0 THEN '["risk"]' ELSE '[]' END AS effect_directions, CASE WHEN wx THEN 'conflicting' WHEN wn = 0 THEN 'unknown' WHEN wn = 1 THEN 'single' ELSE 'consensus' END AS effect_direction_status FROM e)
SELECT *, mechanism_status IN ('single', 'consensus') AND effect_direction_status IN ('single', 'consensus') AS both_operands_known FROM s""")
def q_operand_edges(spark: SparkSession, d: str) -> DataFrame:
    return _operand_edges(spark, d)[0].select("x_id", "y_id", *D.EDGE)


@query(f"""{_CHECKED}, f AS (SELECT CASE WHEN source_dataset LIKE 'rev%' THEN 'UniProtKB_reviewed_disease_comment' WHEN source_dataset LIKE 'hum%' THEN 'UniProtKB_humsavar' ELSE 'unsupported' END AS operand_source_family, materialization_assertion_id AS id, min(why) AS operand_reject_reason, count(*) AS n FROM o GROUP BY 1, 2)
SELECT operand_source_family, operand_reject_reason, count(*) AS n_assertions, sum(n)::BIGINT AS n_rows FROM f GROUP BY 1, 2""")
def q_operand_inventory(spark: SparkSession, d: str) -> DataFrame:
    return D.operand_inventory(_operand_edges(spark, d)[1])


@query(f"""{_CHECKED}, v AS (SELECT DISTINCT x_id, y_id, edge_key FROM o WHERE x_id LIKE '%7') SELECT edge_key, 'effect_direction_status' AS field, 'changed' AS staged, CASE WHEN count(DISTINCT w) FILTER (bad) > 0 OR bool_or(bad) THEN 'conflicting' WHEN count(*) FILTER (w <> '') = 0 THEN 'unknown' WHEN count(*) FILTER (w <> '') = 1 THEN 'single' ELSE 'consensus' END AS expected
FROM v JOIN (SELECT x_id, y_id, materialization_assertion_id, max(w) AS w, count(DISTINCT w) > 1 AS bad FROM o GROUP BY ALL) USING (x_id, y_id) GROUP BY edge_key""")
def q_operand_mismatches(spark: SparkSession, d: str) -> DataFrame:
    """Edges whose staged state was overwritten, found by the recomputation."""
    edges, _, ev = _operand_edges(spark, d)
    changed = edges.withColumn("effect_direction_status", F.when(F.col("x_id").endswith("7"), "changed").otherwise(F.col("effect_direction_status")))
    return D.operand_mismatches(changed, ev)

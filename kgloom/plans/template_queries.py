"""The named composition templates over relations that are read from the driver's tables.

A relation is a selection that Spark and SQL read alike; the templates' SQL states each
template's joins and gates for the values that occur in these relations.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import templates as T
from ..sources.tables import table
from .queries import ORACLE_SQL, query

_GENE, _DISEASE = "'g:' || (l_partkey - l_partkey % 3)", "'d:' || (l_orderkey % 100 - l_orderkey % 4)"
_MECHANISM = {
    "causal_mechanism": "CASE l_returnflag WHEN 'A' THEN 'gain_of_function' WHEN 'R' THEN 'Loss_of_Function' END", "effect_direction": "CASE WHEN l_suppkey % 7 = 0 THEN 'conflicting' WHEN l_linestatus = 'O' THEN 'risk' ELSE 'protective' END",
    "causal_support": "CASE l_suppkey % 4 WHEN 0 THEN 'causal' WHEN 1 THEN 'validated_causal' WHEN 2 THEN 'associative' END", "tissue": "CASE l_suppkey % 3 WHEN 0 THEN 'liver' WHEN 1 THEN 'kidney' END",
}
_ACTION = {"action_type": "CASE p_size % 4 WHEN 0 THEN 'inhibitor' WHEN 1 THEN 'agonist' WHEN 2 THEN 'Agonist' ELSE 'binder' END", "action_direction": "CASE p_size % 6 WHEN 0 THEN 'decrease' WHEN 1 THEN 'increase' WHEN 2 THEN 'increase' END", "tissue": "CASE p_partkey % 3 WHEN 0 THEN 'Liver' WHEN 1 THEN 'kidney' END"}
_ISOFORM = "CASE l_returnflag WHEN 'A' THEN 'iso1' WHEN 'R' THEN 'iso2' END"
#: relation: table, condition, ends, fields
RELATIONS: dict[str, tuple[str, str, str, str, dict[str, str]]] = {
    "gene_has_transcript": ("part", "p_size % 10 <> 9", "'g:' || (p_partkey - p_partkey % 3)", "'t:' || p_partkey", {"assembly": "CASE p_size % 7 WHEN 0 THEN 'GRCh37' WHEN 1 THEN NULL ELSE 'GRCh38' END", "source": "'ensembl'"}),
    "transcript_encodes_protein": ("part", "p_size % 3 <> 0", "'t:' || p_partkey", "'p:' || p_partkey", {"isoform_id": "CASE p_size % 5 WHEN 1 THEN 'iso1' END", "assembly": "'GRCh38'", "source": "'uniprot'"}),
    "mutation_affects_transcript": ("lineitem", "l_linenumber <= 3", "'m:' || l_orderkey", "'t:' || l_partkey", {"assembly": "CASE l_returnflag WHEN 'A' THEN 'GRCh37' WHEN 'R' THEN 'grch38' END", "source": "l_returnflag"}),
    "mutation_causes_protein_change": ("lineitem", "l_linenumber > 3", "'m:' || l_orderkey", "'p:' || l_partkey", {"isoform_id": _ISOFORM, "tissue": "CASE l_linestatus WHEN 'O' THEN 'liver' END", "source": "l_returnflag"}),
    "mutation_associated_disease": (
        "orders", "true", "'m:' || o_orderkey", "'d:' || (o_custkey - o_custkey % 4)",
        {"source": "o_orderstatus", "tissue": "CASE o_orderkey % 3 WHEN 0 THEN 'liver' WHEN 1 THEN 'Kidney' END", "effect_direction": "CASE o_orderkey % 4 WHEN 0 THEN 'risk' WHEN 1 THEN 'protective' WHEN 2 THEN 'conflicting' END",
         "pathogenicity": "CASE o_orderpriority WHEN '1-URGENT' THEN 'Pathogenic' WHEN '2-HIGH' THEN 'likely pathogenic' WHEN '3-MEDIUM' THEN 'benign' WHEN '4-NOT SPECIFIED' THEN '[\"pathogenic\",\"benign\"]' END"},
    ),
    "disease_has_phenotype": ("customer", "true", "'d:' || (c_custkey - c_custkey % 4)", "'h:' || c_nationkey", {"source": "CASE c_custkey % 3 WHEN 0 THEN 'F' WHEN 1 THEN 'hpo' END", "tissue": "CASE c_custkey % 4 WHEN 0 THEN 'liver' WHEN 1 THEN 'kidney' END"}),
    "mutation_associated_phenotype": ("lineitem", "l_linenumber = 1", "'m:' || l_orderkey", "'h:' || l_suppkey % 25", {"source": "l_returnflag"}),
    "cell_type_found_in_tissue": ("supplier", "true", "'c:' || s_suppkey", "'u:' || s_nationkey", {"population": "CASE s_suppkey % 2 WHEN 0 THEN 'eur' END", "source": "'cl'"}),
    "cell_type_expresses_gene": ("lineitem", "l_linenumber = 2", "'c:' || l_suppkey", _GENE, {"population": "CASE l_returnflag WHEN 'A' THEN 'EUR' WHEN 'R' THEN 'afr' END", "source": "l_returnflag"}),
    "tissue_expresses_protein": ("lineitem", "l_linenumber = 4", "'u:' || l_suppkey % 25", "'p:' || l_partkey", {"isoform_id": _ISOFORM}),
    "cell_type_expresses_protein": ("lineitem", "l_linenumber = 5", "'c:' || l_suppkey", "'p:' || l_partkey", {"isoform_id": _ISOFORM}),
    "cell_line_expresses_protein": ("lineitem", "l_linenumber = 6", "'l:' || l_suppkey", "'p:' || l_partkey", {"isoform_id": _ISOFORM}),
    "disease_associated_protein": ("lineitem", "l_linenumber = 3", "'p:' || l_partkey", _DISEASE, {"isoform_id": _ISOFORM, "source": "l_returnflag"} | _MECHANISM),
    "disease_associated_gene": ("lineitem", "l_linenumber = 2", _GENE, _DISEASE, {"protein_id": "CASE WHEN l_suppkey % 2 = 0 THEN 'P:' || l_partkey END", "pathway_native_support": "CASE WHEN l_suppkey % 9 = 0 THEN 'True' END", "source": "l_returnflag"} | _MECHANISM),
    "molecule_targets_gene": ("part", "p_size % 2 = 0", "'x:' || p_partkey % 500", "'g:' || (p_partkey - p_partkey % 3)", _ACTION),
    "molecule_targets_protein": ("part", "p_size % 4 < 3", "'x:' || p_partkey % 500", "'p:' || p_partkey", _ACTION),
    "pathway_contains_gene": ("lineitem", "l_linenumber = 7", "'w:' || l_suppkey", _GENE, {"source": "CASE WHEN l_suppkey % 5 = 0 THEN 'A' WHEN l_suppkey % 5 = 1 THEN NULL ELSE 'go' END"}),
    "pathway_contains_protein": ("lineitem", "l_linenumber = 7", "'w:' || l_suppkey", "'p:' || l_partkey", {"source": "'reactome'"}),
    "disease_manifests_in_tissue": ("customer", "true", "'d:' || (c_custkey - c_custkey % 4)", "'u:' || c_custkey % 25", {"source": "CASE c_custkey % 5 WHEN 0 THEN 'f' WHEN 1 THEN 'hpo' ELSE 'ot' END", "tissue": "CASE c_custkey % 3 WHEN 0 THEN 'liver' END"}),
    "phenotype_observed_in_tissue": ("supplier", "true", "'u:' || s_suppkey % 25", "'h:' || s_nationkey", {"source": "'hpa'"}),
    "mutation_associated_gene": ("lineitem", "l_linenumber = 1", "'m:' || l_orderkey", _GENE, {"attribution_mode": "CASE l_suppkey % 3 WHEN 0 THEN 'Containment' WHEN 1 THEN 'l2g' END", "functional_mechanism": "CASE l_returnflag WHEN 'R' THEN 'loss_of_function' WHEN 'N' THEN 'gain_of_function' END"}),
    "mutation_affects_molecule_response": (
        "orders", "true", "'m:' || o_orderkey", "'x:' || o_custkey % 500",
        {"disease_context": "CASE o_orderkey % 3 WHEN 0 THEN 'D:' || (o_custkey - o_custkey % 4) WHEN 1 THEN 'd:1' END", "response_category": "CASE o_orderpriority WHEN '1-URGENT' THEN 'Efficacy' WHEN '2-HIGH' THEN 'efficacy' WHEN '3-MEDIUM' THEN 'toxicity' END", "response_direction": "CASE o_orderstatus WHEN 'O' THEN 'benefit' WHEN 'F' THEN 'Sensitivity' ELSE 'resistant' END"},
    ),
}


def relation_frame(spark: SparkSession, d: str, name: str) -> DataFrame:
    source, where, x, y, fields = RELATIONS[name]
    return table(spark, d, source).where(where).selectExpr(f"{x} AS x_id", f"{y} AS y_id", f"'{name}' AS relation", *[f"{e} AS {f}" for f, e in fields.items()])


class _Frames(dict):
    """Relations by name, each read when it is asked for."""

    def __init__(self, spark: SparkSession, d: str):
        super().__init__()
        self.spark, self.d = spark, d

    def __missing__(self, name: str) -> DataFrame:
        self[name] = relation_frame(self.spark, self.d, name)
        return self[name]


def _frames(spark: SparkSession, d: str) -> dict[str, DataFrame]:
    return _Frames(spark, d)


def _cte(name: str) -> str:
    source, where, x, y, fields = RELATIONS[name]
    return f"{name} AS (SELECT {x} AS x_id, {y} AS y_id, '{name}|' || {x} || '|' || {y} AS k" + "".join(f", {e} AS {f}" for f, e in fields.items()) + f" FROM {source} WHERE {where})"


def _compatible(roles: dict[str, str], fields=T.CONTEXT_FIELDS) -> str:
    """For scalars: no field says conflicting, and no two say different things."""
    rules = ["true"]
    for f in fields:
        have = [a for a, name in roles.items() if f in RELATIONS[name][4]]
        rules += [f"coalesce(lower({a}.{f}), '') <> 'conflicting'" for a in have]
        rules += [f"coalesce(lower({a}.{f}) = lower({b}.{f}), true)" for i, a in enumerate(have) for b in have[i + 1 :]]
    return "(" + " AND ".join(rules) + ")"


_EACH = "SELECT x_id, y_id, member_id, anchor_id, count(*) AS support_multiplicity, min(hash) AS derivation_hash, arg_min(supports, hash) AS supports FROM h GROUP BY ALL"


def _sql(name: str, roles: dict[str, str], on: str, x: str, y: str, where: str = "true", member: str = "''", anchor: str = "''", last: str = "") -> str:
    relations = ", ".join(_cte(r) for r in dict.fromkeys(roles.values()))
    keys = ", ".join(f"{a}.k" for a in roles)
    return f"""WITH {relations}, p AS (SELECT {x} AS x_id, {y} AS y_id, {member} AS member_id, {anchor} AS anchor_id, array_to_string(list_sort(list_distinct([{keys}])), ';') AS supports FROM {on} WHERE {where}),
  h AS (SELECT *, sha256(concat_ws('|', '{name}', x_id, y_id, supports, '')) AS hash FROM p) {last or _EACH}"""


_MAPPED = "transcript_encodes_protein e JOIN gene_has_transcript g ON g.y_id = e.x_id AND " + _compatible({"e": "transcript_encodes_protein", "g": "gene_has_transcript"}, T.MAPPING_FIELDS)
_FREE = "lower(a.source) <> lower(b.source)"
_OK = "lower(replace(b.pathogenicity, ' ', '_')) IN ('pathogenic', 'likely_pathogenic')"
_SEEN = "(SELECT DISTINCT x_id, y_id, k FROM {0}) c"


def _gene_sql(name: str, relation: str, end: str, protein: str) -> str:
    roles = {"a": relation, "e": "transcript_encodes_protein", "g": "gene_has_transcript"}
    x, y = ("g.x_id", "a.y_id") if end == "x" else ("a.x_id", "g.x_id")
    return _sql(name, roles, f"{relation} a JOIN ({_MAPPED}) ON e.y_id = a.{protein}", x, y, _compatible(roles, T.MAPPING_FIELDS))


def _variant_sql(name: str, end: str, gene: bool) -> str:
    two = {"a": "mutation_causes_protein_change", "b": end}
    roles = {"a": two["a"], "e": "transcript_encodes_protein", "g": "gene_has_transcript", "b": end} if gene else two
    on = f"mutation_causes_protein_change a JOIN {end} b ON b.x_id = a.x_id" + (f" JOIN ({_MAPPED}) ON e.y_id = a.y_id" if gene else "")
    where = _compatible(two) + (f" AND {_OK}" if end.endswith("disease") else "") + (" AND " + _compatible(roles, T.MAPPING_FIELDS) if gene else "")
    return _sql(name, roles, on, "g.x_id" if gene else "a.y_id", "b.y_id", where)


def _signed_sql(name: str, kind: str, sign: str, last: str = "") -> str:
    roles = {"a": f"molecule_targets_{kind}", "b": f"disease_associated_{kind}"}
    action = "CASE lower(a.action_type) WHEN 'inhibitor' THEN -1 WHEN 'agonist' THEN 1 END"
    turn = "CASE a.action_direction WHEN 'decrease' THEN -1 WHEN 'increase' THEN 1 END"
    disease = "CASE lower(b.causal_mechanism) WHEN 'gain_of_function' THEN 1 WHEN 'loss_of_function' THEN -1 END * CASE b.effect_direction WHEN 'risk' THEN 1 WHEN 'protective' THEN -1 END"
    where = f"coalesce({turn} = {action}, true) AND {action} * {disease} {sign} 0 AND b.causal_support IN ('causal', 'validated_causal') AND lower(a.tissue) = lower(b.tissue)"
    return _sql(name, roles, f"{roles['a']} a JOIN {roles['b']} b ON b.x_id = a.y_id", "a.x_id", "b.y_id", where, last=last)


_MD, _HP = {"a": "mutation_associated_disease", "b": "disease_has_phenotype"}, {"a": "disease_has_phenotype", "b": "disease_manifests_in_tissue"}
_TO_GENE = {"a": "mutation_affects_transcript", "g": "gene_has_transcript"}
_CELL = {"a": "cell_type_found_in_tissue", "b": "cell_type_expresses_gene"}
_ALLELE = {"a": "molecule_targets_gene", "b": "mutation_associated_gene", "c": "mutation_associated_disease"}
_RESPONSE = {"a": "mutation_associated_disease", "b": "mutation_affects_molecule_response"}
_SQL = {
    "mutation_transcript_gene_attribution_v2": lambda n: _sql(n, _TO_GENE, "mutation_affects_transcript a JOIN gene_has_transcript g ON g.y_id = a.y_id", "a.x_id", "g.x_id", _compatible(_TO_GENE, T.MAPPING_FIELDS)),
    "mutation_protein_gene_attribution_v2": lambda n: _gene_sql(n, "mutation_causes_protein_change", "y", "y_id"),
    "mutation_disease_phenotype_candidate_v2": lambda n: _sql(n, _MD, "mutation_associated_disease a JOIN disease_has_phenotype b ON b.x_id = a.y_id", "a.x_id", "b.y_id", f"{_compatible(_MD)} AND {_FREE}", anchor="a.y_id"),
    "mutation_disease_phenotype_triangle_v2": lambda n: _sql(n, _MD | {"c": "mutation_associated_phenotype"}, "mutation_associated_disease a JOIN disease_has_phenotype b ON b.x_id = a.y_id JOIN " + _SEEN.format("mutation_associated_phenotype") + " ON c.x_id = a.x_id AND c.y_id = b.y_id", "a.x_id", "b.y_id", f"{_compatible(_MD)} AND {_FREE}", anchor="a.y_id"),
    "cell_type_tissue_gene_existential_v2": lambda n: _sql(n, _CELL, "cell_type_found_in_tissue a JOIN cell_type_expresses_gene b ON b.x_id = a.x_id", "a.y_id", "b.y_id", _compatible(_CELL)),
    "mutation_protein_disease_candidate_v2": lambda n: _variant_sql(n, "mutation_associated_disease", False),
    "mutation_protein_gene_disease_candidate_v2": lambda n: _variant_sql(n, "mutation_associated_disease", True),
    "mutation_protein_gene_phenotype_candidate_v2": lambda n: _variant_sql(n, "mutation_associated_phenotype", True),
    "tissue_protein_to_gene_expression_v2": lambda n: _gene_sql(n, "tissue_expresses_protein", "y", "y_id"),
    "cell_type_protein_to_gene_expression_v2": lambda n: _gene_sql(n, "cell_type_expresses_protein", "y", "y_id"),
    "cell_line_protein_to_gene_expression_v2": lambda n: _gene_sql(n, "cell_line_expresses_protein", "y", "y_id"),
    "protein_disease_to_gene_disease_v2": lambda n: _gene_sql(n, "disease_associated_protein", "x", "x_id"),
    "gene_disease_to_protein_disease_strict_v2": lambda n: _sql(n, {"a": "disease_associated_gene", "e": "transcript_encodes_protein", "g": "gene_has_transcript"}, f"disease_associated_gene a JOIN ({_MAPPED}) ON g.x_id = a.x_id", "e.y_id", "a.y_id", "lower(a.protein_id) = e.y_id"),
    "pathway_associated_member_feature_v2": lambda n: _sql(n, {"a": "pathway_contains_gene", "b": "disease_associated_gene"}, "pathway_contains_gene a JOIN disease_associated_gene b ON b.x_id = a.y_id", "a.x_id", "b.y_id", member="a.y_id"),
    "pathway_associated_protein_member_feature_v2": lambda n: _sql(n, {"a": "pathway_contains_protein", "b": "disease_associated_protein"}, "pathway_contains_protein a JOIN disease_associated_protein b ON b.x_id = a.y_id", "a.x_id", "b.y_id", member="a.y_id"),
    "disease_phenotype_tissue_localization_v2": lambda n: _sql(n, _HP, "disease_has_phenotype a JOIN disease_manifests_in_tissue b ON b.x_id = a.x_id", "b.y_id", "a.y_id", f"{_compatible(_HP)} AND {_FREE}", anchor="a.x_id"),
    "disease_phenotype_tissue_triangle_v2": lambda n: _sql(n, _HP | {"c": "phenotype_observed_in_tissue"}, "disease_has_phenotype a JOIN disease_manifests_in_tissue b ON b.x_id = a.x_id JOIN " + _SEEN.format("phenotype_observed_in_tissue") + " ON c.x_id = b.y_id AND c.y_id = a.y_id", "b.y_id", "a.y_id", f"{_compatible(_HP)} AND {_FREE}", anchor="a.x_id"),
    "signed_gene_target_treatment_v2": lambda n: _signed_sql(n, "gene", "<"),
    "signed_protein_target_treatment_v2": lambda n: _signed_sql(n, "protein", "<"),
    "signed_gene_target_contraindication_v2": lambda n: _signed_sql(n, "gene", ">"),
    "signed_protein_target_contraindication_v2": lambda n: _signed_sql(n, "protein", ">"),
    "allelic_triangulation_treatment_v2": lambda n: _sql(
        n, _ALLELE, "molecule_targets_gene a JOIN mutation_associated_gene b ON b.y_id = a.y_id JOIN mutation_associated_disease c ON c.x_id = b.x_id", "a.x_id", "c.y_id",
        "coalesce(lower(b.attribution_mode), '') <> 'containment' AND " + _compatible(_ALLELE) + " AND (CASE WHEN lower(a.action_type) = 'inhibitor' AND coalesce(a.action_direction, 'decrease') = 'decrease' THEN -1 WHEN lower(a.action_type) = 'agonist' AND coalesce(a.action_direction, 'increase') = 'increase' THEN 1 END)"
        " * CASE b.functional_mechanism WHEN 'loss_of_function' THEN -1 WHEN 'gain_of_function' THEN 1 END * CASE c.effect_direction WHEN 'risk' THEN 1 WHEN 'protective' THEN -1 END < 0",
    ),
    "pharmacogenomic_efficacy_treatment_v2": lambda n: _sql(n, _RESPONSE, "mutation_associated_disease a JOIN mutation_affects_molecule_response b ON b.x_id = a.x_id", "b.y_id", "a.y_id", f"lower(b.response_category) = 'efficacy' AND lower(b.response_direction) IN ('benefit', 'sensitivity') AND lower(b.disease_context) = a.y_id AND {_compatible(_RESPONSE)}"),
}


def _registered(name: str):
    def run(spark: SparkSession, d: str) -> DataFrame:
        return T.candidates(name, _frames(spark, d)).select("x_id", "y_id", "member_id", "anchor_id", "support_multiplicity", "derivation_hash", F.concat_ws(";", "supports").alias("supports"))

    run.__name__ = "q_" + name.removesuffix("_v2")
    run.__module__ = __name__
    return run


for _name, _make in _SQL.items():
    query(_make(_name))(_registered(_name))

_PATHWAY = f"""WITH {_cte("pathway_contains_gene")}, {_cte("disease_associated_gene")}, n AS (SELECT x_id, count(*) AS size FROM pathway_contains_gene GROUP BY 1),
  p AS (SELECT a.x_id, b.y_id, a.y_id AS member, [a.k, b.k] AS keys, coalesce({_FREE}, false) AS free, b.pathway_native_support IS NOT NULL AS native, lower(b.source) AS source FROM pathway_contains_gene a JOIN disease_associated_gene b ON b.x_id = a.y_id),
  m AS (SELECT x_id, y_id, member, bool_or(native) AS native, bool_or(free) AS free, array_to_string(list_sort(list_distinct(list(source) FILTER (free))), ',') AS sources FROM p GROUP BY ALL),
  g AS (SELECT x_id, y_id, bool_or(native) AS native, count(*) FILTER (free) AS n_free, count(*) AS n_all, list(DISTINCT sources) FILTER (free) AS sets FROM m GROUP BY ALL),
  r AS (SELECT g.*, size, len(list_filter(coalesce(sets, []), lambda s: len(list_filter(sets, lambda t: NOT list_has_any(string_split(s, ','), string_split(t, ',')))) > 0)) > 0 AS disjoint FROM g JOIN n USING (x_id)),
  v AS (SELECT *, CASE WHEN size > 90 THEN 'pathway_fanout' WHEN n_free < 2 AND NOT native THEN 'insufficient_independent_members' WHEN NOT disjoint AND NOT native THEN 'source_commonality_or_circularity' END AS reason FROM r)"""


@query(f"{_PATHWAY} SELECT x_id, y_id, CASE WHEN native THEN n_all ELSE n_free END AS associated_member_count, size AS pathway_size, array_to_string((SELECT list_sort(list_distinct(flatten(list(keys)))) FROM p WHERE p.x_id = v.x_id AND p.y_id = v.y_id AND (v.native OR p.free)), ';') AS supports FROM v WHERE reason IS NULL")
def q_pathway_disease_candidate(spark: SparkSession, d: str) -> DataFrame:
    found = T.candidates("pathway_disease_candidate_v2", _frames(spark, d), most=90)
    return found.select("x_id", "y_id", "associated_member_count", "pathway_size", F.concat_ws(";", "supports").alias("supports"))


@query(f"{_PATHWAY} SELECT reason, count(*) AS n FROM v WHERE reason IS NOT NULL GROUP BY 1")
def q_pathway_disease_rejects(spark: SparkSession, d: str) -> DataFrame:
    return T.paths_of("pathway_disease_candidate_v2", _frames(spark, d), most=90)[1].groupBy("reason").agg(F.count("*").alias("n"))


_WHY = """CASE WHEN pathogenicity IS NULL THEN 'unknown_pathogenicity' WHEN pathogenicity LIKE '[%' THEN 'conflicting_pathogenicity' WHEN pathogenicity = 'benign' THEN 'non_pathogenic_benign' WHEN NOT ({0}) THEN 'context_mismatch' END"""


@query(f"WITH {_cte('mutation_causes_protein_change')}, {_cte('mutation_associated_disease')} SELECT {_WHY.format(_compatible({'a': 'mutation_causes_protein_change', 'b': 'mutation_associated_disease'}))} AS reason, count(*) AS n FROM mutation_causes_protein_change a JOIN mutation_associated_disease b ON b.x_id = a.x_id GROUP BY 1 HAVING reason IS NOT NULL")
def q_pathogenicity_rejects(spark: SparkSession, d: str) -> DataFrame:
    return T.paths_of("mutation_protein_disease_candidate_v2", _frames(spark, d))[1].groupBy("reason").agg(F.count("*").alias("n"))


@query(_signed_sql("signed_gene_target_treatment_v2", "gene", "<", "SELECT x_id, y_id, hash AS derivation_hash FROM h ORDER BY hash LIMIT 20"))
def q_paths_bounded(spark: SparkSession, d: str) -> DataFrame:
    return T.bounded(T.paths_of("signed_gene_target_treatment_v2", _frames(spark, d))[0], 20)[0].select("x_id", "y_id", "derivation_hash")


@query(f"WITH f AS ({ORACLE_SQL['q_mutation_disease_phenotype_candidate']}), {_cte('mutation_associated_phenotype')}, s AS (SELECT DISTINCT 'm:' || o_orderkey AS x_id, 'h:' || o_custkey % 25 AS y_id FROM orders) SELECT CASE WHEN o.x_id IS NOT NULL THEN 'canonical_observed_overlap' WHEN s.x_id IS NOT NULL THEN 'staged_source_native_overlap' ELSE 'new' END AS reason, count(*) AS n FROM f LEFT JOIN (SELECT DISTINCT x_id, y_id FROM mutation_associated_phenotype) o USING (x_id, y_id) LEFT JOIN s USING (x_id, y_id) GROUP BY 1")
def q_unobserved_candidates(spark: SparkSession, d: str) -> DataFrame:
    r = _frames(spark, d)
    staged = table(spark, d, "orders").selectExpr("'m:' || o_orderkey AS x_id", "'h:' || o_custkey % 25 AS y_id")
    new, gone = T.unobserved(T.candidates("mutation_disease_phenotype_candidate_v2", r), r["mutation_associated_phenotype"], staged)
    return new.select(F.lit("new").alias("reason")).unionAll(gone).groupBy("reason").agg(F.count("*").alias("n"))


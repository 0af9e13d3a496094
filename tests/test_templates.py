"""Named composition templates: the gates on small premises, and some registered queries against their SQL."""

import duckdb
import pytest
from pyspark.sql import functions as F

from kgloom.operators import templates as T
from kgloom.plans import queries as Q
from kgloom.plans import template_queries as TQ

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ["q_mutation_protein_gene_disease_candidate", "q_disease_phenotype_tissue_triangle", "q_signed_gene_target_treatment", "q_pathway_disease_candidate", "q_allelic_triangulation_treatment", "q_unobserved_candidates"])
def test_matches_sql(spark, name):
    con = duckdb.connect()
    for t in ("part", "lineitem", "orders", "customer", "supplier"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    got = Q.QUERIES[name](spark, SF)
    names = sorted(got.columns)
    want = con.execute(f"SELECT {', '.join(names)} FROM ({Q.ORACLE_SQL[name]})").fetchall()
    assert want and sorted(map(str, map(tuple, got.select(names).collect()))) == sorted(map(str, want))


def test_every_template_has_a_query():
    assert {f"q_{n.removesuffix('_v2')}" for n in T.TEMPLATES} <= set(Q.QUERIES)
    assert {r for _, _, _, _, fields in TQ.RELATIONS.values() for r in fields} >= {"tissue", "assembly", "population"}


def test_values_of_scalars_and_lists(spark):
    given = [("Liver ",), ('["b", "A", "a", null, " "]',), ("[broken",), ("",), (None,), ("[1, 2]",)]
    assert [r[0] for r in spark.createDataFrame(given, "c string").select(T.values(F.col("c"))).collect()] == [["liver"], ["a", "b"], ["[broken"], [], [], ["1", "2"]]


def test_evidence_fills_and_contradicts(spark):
    edges = spark.createDataFrame([("r", "a", "b", "liver"), ("r", "a", "c", "liver"), ("r", "a", "d", None), ("r", "a", "e", None)], "relation string, x_id string, y_id string, tissue string")
    evidence = spark.createDataFrame([("r", "a", "b", "liver", "s1", "x"), ("r", "a", "c", "lung", "s2", "x"), ("r", "a", "d", "lung", "s3", "x"), ("r", "a", "d", "lung", "s4", "y")], "relation string, x_id string, y_id string, tissue string, study_id string, population string")
    got = {r.y_id: (r.tissue_status, r.population, r.population_status, r.evidence_ids) for r in T.with_evidence(edges, evidence).collect()}
    assert got == {"b": (None, "x", None, ["s1"]), "c": ("conflicting", "x", None, ["s2"]), "d": (None, None, "conflicting", ["s3", "s4"]), "e": (None, None, None, [])}


def test_signs(spark):
    cols = "x_id string, y_id string, relation string, action_type string, action_direction string, causal_mechanism string, effect_direction string, mechanism_status string"
    rows = [("a", "1", "r", "inhibitor", "decrease", "gain_of_function", "risk", None), ("a", "2", "r", "inhibitor", "increase", "gain_of_function", "protective", None), ("a", "3", "r", "binder", None, "loss_of_function", "odd", None), ("a", "4", "r", None, None, "loss_of_function", "risk", "conflicting")]
    p = T.Paths.of("a", spark.createDataFrame(rows, cols))
    got = {r[0]: tuple(r[1:]) for r in p.df.select("a.y_id", *p.action_sign("a"), *p.disease_sign("a")).collect()}
    assert got == {"1": ("known", -1, "known", 1), "2": ("conflicting", None, "known", -1), "3": ("unknown", None, "unknown", None), "4": ("unknown", None, "conflicting", None)}


def test_nothing_is_new_without_an_inventory(spark):
    found = spark.createDataFrame([("a", "b")], "x_id string, y_id string")
    new, gone = T.unobserved(found, None, None)
    assert new.count() == 0 and [r.reason for r in gone.collect()] == ["canonical_target_inventory_missing"]


def test_member_features_are_folded_before_they_meet(spark):
    rows = [("r", "w1", "g1", "Liver", "a"), ("r", "w1", "g1", "Liver", "b"), ("r", "w2", "g1", None, "a"), ("r", "w2", None, None, "a"), ("r", "w3", "g3", None, "a")]
    a = spark.createDataFrame(rows, "relation string, x_id string, y_id string, tissue string, source string").withColumn("relation", F.lit("pathway_contains_gene"))
    b = spark.createDataFrame([("g1", "d1", "kidney")] * 3 + [("g1", "d2", None), ("g3", "d2", "[\"Liver\",\"lung\"]")], "x_id string, y_id string, tissue string").withColumn("relation", F.lit("disease_associated_gene"))
    keyed = lambda df: df.withColumn("edge_key", F.concat_ws("|", "relation", "x_id", "y_id"))  # noqa: E731  (edges with keys are not folded)
    name = "pathway_associated_member_feature_v2"
    one, other = (T.candidates(name, {"pathway_contains_gene": f(a), "disease_associated_gene": f(b)}) for f in (lambda df: df, keyed))
    text = lambda df: sorted(map(str, map(tuple, df.select(sorted(df.columns)).collect())))
    assert sorted(one.columns) == sorted(other.columns) and text(one) == text(other)
    assert {(r.x_id, r.y_id): (r.support_multiplicity, len(r.derivation_hashes)) for r in one.collect()} == {("w1", "d1"): (6, 6), ("w1", "d2"): (2, 2), ("w2", "d1"): (3, 3), ("w2", "d2"): (1, 1), ("w3", "d2"): (1, 1)}
    after = Q.QUERIES["q_pathway_associated_member_feature"](spark, SF)._jdf.queryExecution().executedPlan().toString().split("Join")[0]
    assert "Aggregate" not in after and "Exchange" not in after  # what the join gives is neither sorted nor shuffled


@pytest.mark.parametrize("kind", ["gene", "protein"])
def test_signs_are_worked_out_after_premises_are_dealt(spark, kind):
    plan = Q.QUERIES[f"q_signed_{kind}_target_treatment"](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    below = [line.split("Exchange")[0] for line in plan[plan.index("RepartitionByExpression") :].splitlines() if "Filter" in line]
    assert below and not any("array_except" in line or "arrays_overlap" in line for line in below)


def test_pathway_members_are_not_grouped_after_they_meet(spark):
    cols = "relation string, x_id string, y_id string, source string"
    inside = spark.createDataFrame([("m", "w1", "g1", "go"), ("m", "w1", "g1", "A"), ("m", "w1", "g2", "go"), ("m", "w2", "g1", "go"), ("m", "w3", "g3", None), ("m", "w1", None, "go")], cols)
    told = spark.createDataFrame([("d", "g1", "d1", "A", None), ("d", "g1", "d1", "N", None), ("d", "g2", "d1", "R", None), ("d", "g2", "d1", "go", None), ("d", "g3", "d2", None, "Yes")], f"{cols}, pathway_native_support string")
    relations = {"pathway_contains_gene": inside, "disease_associated_gene": told}
    got = {(r.x_id, r.y_id): (r.associated_member_count, r.pathway_size, r.supports, r.support_multiplicity) for r in T.candidates("pathway_disease_candidate_v2", relations, most=4).collect()}
    assert got == {("w1", "d1"): (2, 4, ["d|g1|d1", "d|g2|d1", "m|w1|g1", "m|w1|g2"], 1), ("w3", "d2"): (1, 1, ["d|g3|d2", "m|w3|g3"], 1)}
    assert [r.reason for r in T.paths_of("pathway_disease_candidate_v2", relations, most=4)[1].collect()] == ["insufficient_independent_members"]
    plan = Q.QUERIES["q_pathway_disease_candidate"](spark, SF)._jdf.queryExecution().optimizedPlan().toString().split("Join")[0]
    assert plan.count("Aggregate") == 1  # by pairs only

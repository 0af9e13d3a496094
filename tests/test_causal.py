"""Causal features and disease operands: every value of the fixed maps, states against a plain version, recomputation that finds a change."""

import itertools
import json
import random

import pytest
from pyspark.sql import functions as F

from kgloom.functions.fingerprint import added, digest_sums, fingerprint, table_fingerprint
from kgloom.operators import causal_features as C
from kgloom.operators import disease_operands as D

ENDS = {r: (x, y) for r, (x, y, _) in C.RELATIONS.items()}


def table(spark, relation, rows):
    """Evidence rows from dicts; ends and provenance are filled in."""
    x, y = ENDS[relation]
    full = [{"relation": relation, "x_id": "x1", "x_type": x, "y_id": "y1", "y_type": y, "source": "s", "source_dataset": "d", "source_record_id": f"r{k}"} | r for k, r in enumerate(rows)]
    names = list(dict.fromkeys(itertools.chain.from_iterable(full)))
    return spark.createDataFrame([tuple(None if r.get(n) is None else str(r[n]) for n in names) for r in full], ", ".join(f"`{n}` string" for n in names))


def one(spark, relation, rows):
    ev = table(spark, relation, rows)
    edges = ev.select("relation", "x_id", "x_type", "y_id", "y_type").distinct()
    return C.materialised(edges, ev, relation)


def test_every_action(spark):
    rows = [{"action_type": a.lower() if k % 2 else f" {a} ", "x_id": f"m{k}"} for k, a in enumerate(C.ACTIONS)] + [{"action_type": "", "predicate": "Opener", "x_id": "m90"}, {"action_type": "stabiliser", "x_id": "m91"}]
    edges, ev = one(spark, "molecule_targets_gene", rows)
    found = {r["x_id"]: r for r in edges.collect()}
    for k, values in enumerate(C.ACTIONS.values()):
        r = found[f"m{k}"]
        assert tuple(json.loads(r[c])[0] for c in ("action_types", "action_direction", "target_modulation")) == values and r["action_status"] == "single" and r["evidence_count"] == 1
    assert found["m90"]["action_types"] == '["activator"]' and (found["m91"]["action_types"], found["m91"]["action_status"], found["m91"]["evidence_count"]) == ("[]", "unknown", 0)
    assert {r["causal_feature_contract_version"] for r in ev.collect()} == {C.CONTRACT}


@pytest.mark.parametrize("values, column, source", [(C.SIGNIFICANCE, "normalized_clinical_significance", "clinical_significance"), ({m: m for m in C.MECHANISMS}, "normalized_causal_mechanism", "mechanism"), ({"risk": "risk", "Protective": "protective", "protection": "protective"}, "normalized_effect_direction", "direction")])
def test_every_word_of_a_disease(spark, values, column, source):
    _, ev = one(spark, "disease_associated_gene", [{source: f" {v} "} for v in values])
    assert sorted(r[column] for r in ev.collect()) == sorted(values.values())


def test_words_that_no_map_has(spark):
    _, ev = one(spark, "disease_associated_gene", [{"clinical_significance": "Risk-Factor / odd", "mechanism": "weird", "inheritance": "X-Linked  recessive", "variant_category": "LB/B"}, {"variant_category": "us"}, {"variant_category": "odd"}])
    assert sorted((r["normalized_clinical_significance"], r["normalized_causal_mechanism"], r["normalized_inheritance_mode"]) for r in ev.collect()) == [("", "", ""), ("risk_factor_odd", "", "x_linked_recessive"), ("uncertain_significance", "", "")]


def test_every_response(spark):
    rows = [{"pgx_category": k.upper(), "x_id": f"a{i}"} for i, k in enumerate(C.CATEGORIES)] + [{"response_direction": v.replace("_", " "), "x_id": f"b{i}"} for i, v in enumerate(C.RESPONSES)]
    edges, _ = one(spark, "mutation_affects_molecule_response", rows)
    found = {r["x_id"]: r for r in edges.collect()}
    assert [json.loads(found[f"a{i}"]["response_categories"])[0] for i in range(len(C.CATEGORIES))] == list(C.CATEGORIES.values())
    assert [json.loads(found[f"b{i}"]["response_directions"])[0] for i in range(len(C.RESPONSES))] == list(C.RESPONSES)
    assert {r["response_status"] for r in found.values()} == {"single"}


@pytest.mark.parametrize("pair", C.OPPOSITES)
def test_opposite_responses_conflict(spark, pair):
    edges, _ = one(spark, "mutation_affects_molecule_response", [{"response_direction": v} for v in pair] + [{"response_direction": v, "x_id": "z"} for v in (pair[0], "sensitive" if pair[0] != "sensitive" else "increased_efficacy")])
    assert {r["x_id"]: r["response_status"] for r in edges.collect()} == {"x1": "conflicting", "z": "consensus"}


def test_states_of_actions(spark):
    rows = [{"action_type": a, "source_record_id": r, "x_id": x} for x, a, r in (("same", "inhibitor", "1"), ("same", "Blocker", "2"), ("odds", "agonist", "1"), ("odds", "antagonist", "2"), ("twice", "agonist", "1"), ("twice", "agonist", "1"), ("self", "agonist", "1"), ("self", "opener", "1"), ("none", "binding agent", "1"))]
    edges, ev = one(spark, "molecule_targets_protein", rows)
    assert {r["x_id"]: (r["action_status"], r["evidence_count"]) for r in edges.collect()} == {"same": ("consensus", 2), "odds": ("conflicting", 2), "twice": ("single", 1), "self": ("conflicting", 1), "none": ("single", 1)}
    assert {r["x_id"] for r in ev.where("materialization_assertion_conflict").collect()} == {"self"}


def test_papers_of_one_comment_are_one_assertion(spark):
    rows = [{"source_dataset": C.COMMENTS, "source_record_id": f"P1:PMID:{k}", "mechanism": "loss of function"} for k in (1, 2)] + [{"source_dataset": "other", "source_record_id": f"P1:PMID:{k}", "mechanism": "loss of function", "x_id": "o"} for k in (1, 2)]
    edges, _ = one(spark, "disease_associated_protein", rows)
    assert {r["x_id"]: (r["mechanism_status"], r["evidence_count"], r["causal_support_level"]) for r in edges.collect()} == {"x1": ("single", 1, "source_backed_disease_assertion"), "o": ("consensus", 2, "source_backed_association")}


def test_numbers_of_mutations(spark):
    edges, _ = one(spark, "mutation_associated_disease", [{"beta": "0.5", "odds_ratio": "x", "effect_direction": "risk"}, {"beta": "-1", "oddsRatio": "2", "effect_direction": "protection"}, {"beta": "NaN", "effect_direction": "risk"}, {"beta": "0.50", "germline_somatic": "Germ line"}])
    r = edges.first()
    assert (r["beta"], r["odds_ratio"], r["effect_directions"], r["association_status"], r["germline_somatic"], r["evidence_count"]) == ("[-1.0,0.5]", "[2.0]", '["protective","risk"]', "conflicting", '["germ_line"]', 4)


def test_edges_without_evidence_and_errors(spark):
    ev = table(spark, "molecule_targets_gene", [{"action_type": "opener"}])
    edges = spark.createDataFrame([("molecule_targets_gene", "x1", "molecule", "y1", "gene"), ("molecule_targets_gene", "x2", "molecule", "y1", "gene")], "relation string, x_id string, x_type string, y_id string, y_type string")
    out, rows = C.materialised(edges, ev, "molecule_targets_gene")
    lone = out.where("x_id = 'x2'").first()
    assert (lone["action_types"], lone["action_status"], lone["evidence_count"]) == ("[]", "unknown", 0)
    assert [tuple(r) for r in C.staged_failures(out, rows, "molecule_targets_gene").collect()] == [("edges without evidence", 1)]
    spoilt = out.withColumn("action_status", F.lit("maybe")).withColumn("y_type", F.lit("protein"))
    assert {r["failure"] for r in C.staged_failures(spoilt, rows.withColumn("edge_key", F.lit("k")), "molecule_targets_gene").collect()} == {"edges: another end", "edges: no state in action_status", "evidence: edge key", "evidence without edge", "edges without evidence"}
    with pytest.raises(ValueError):
        C.materialised(edges.withColumn("action_types", F.lit("")), ev, "molecule_targets_gene")
    with pytest.raises(ValueError):
        C.normalised(ev.drop("source"), "molecule_targets_gene")
    with pytest.raises(ValueError):
        C.normalised(ev, "gene_has_transcript")
    for bad in (ev.withColumn("y_type", F.lit("protein")), ev.withColumn("source", F.lit(" ")), ev.withColumn("relation", F.lit("other")), ev.withColumn("edge_key", F.lit("other"))):
        with pytest.raises(Exception, match="molecule_targets_gene has"):
            C.normalised(bad, "molecule_targets_gene").select("x_id").collect()


PHRASE = "A Disorder due to a gain-of-function defect of it."
GOOD = {"source_dataset": C.COMMENTS, "source": "UniProtKB", "release": "1", "disease_source_id": "DI1", "isoform": "canonical", "uniprot_accession": "P1", "mapping_confidence": f"x;{D.EXACT[1]};{D.EXACT[0]}", "disease_description": PHRASE, "materialization_assertion_id": "a1", "edge_key": "disease_associated_protein|x1|y1"}
SEEN = GOOD | {"source_dataset": D.VARIANTS, "source": "UniProtKB/humsavar", "source_record_id": "VAR_1", "variant_ft_id": "VAR_1", "variant_category": "lp/p", "materialization_assertion_id": "a2"}
REASONS = [
    (GOOD, ""), (SEEN, ""), (GOOD | {"source_dataset": "other"}, "unsupported_source_family_or_mapping"), (GOOD | {"release": None}, "missing_source_provenance"), (GOOD | {"source": "X"}, "source_family_mismatch"), (GOOD | {"disease_source_id": " "}, "missing_disease_context"),
    (SEEN | {"variant_ft_id": None}, "missing_exact_variant_identity"), (GOOD | {"isoform": "2"}, "mixed_or_noncanonical_isoform"), (GOOD | {"mapping_confidence": D.EXACT[0]}, "ambiguous_or_inexact_mapping"), (GOOD | {"uniprot_accession": None}, "ambiguous_or_inexact_mapping"),
    (SEEN | {"variant_ft_id": "VAR_2"}, "variant_source_record_mismatch"), (GOOD | {"disease_description": "gain of function"}, "no_eligible_explicit_operand"), (SEEN | {"variant_category": "US"}, "no_eligible_explicit_operand"),
]


def test_every_reject_reason(spark):
    rows = [r | {"materialization_assertion_id": f"a{k}"} for k, (r, _) in enumerate(REASONS)]
    found = {r["materialization_assertion_id"]: r for r in D.operand_assertions(table(spark, D.RELATION, rows)).collect()}
    assert [found[f"a{k}"]["operand_reject_reason"] for k in range(len(REASONS))] == [why for _, why in REASONS]
    assert [(found[f"a{k}"]["mechanism_operand"], found[f"a{k}"]["disease_direction_operand"], found[f"a{k}"]["operand_confidence"]) for k in (0, 1, 2)] == [("gain_of_function", "risk", "direct_explicit"), ("", "risk", "direct_explicit"), ("", "", "unknown")]
    assert json.loads(found["a1"]["operand_mapping_path"]) == {"mapping_confidence": GOOD["mapping_confidence"], "mapping_method": "", "protein_id": "x1", "source_disease_id": "DI1", "source_protein_id": "P1", "target_disease_id": "y1", "variant_id": "VAR_1"}


@pytest.mark.parametrize("phrase, hit", [("disease due to gain of function defect", True), ("disorder  due to an gain-of-function defect", True), ("disease due to gain of function defects", False), ("disease due to loss of function defect", False), ("DISEASE DUE TO A GAIN OF FUNCTION DEFECT", True)])
def test_phrases(spark, phrase, hit):
    found = D.operand_assertions(table(spark, D.RELATION, [GOOD | {"disease_description": phrase}])).first()
    assert (found["mechanism_operand"] == "gain_of_function") == hit


def staged(spark, seed=1):
    rnd = random.Random(seed)
    rows = []
    for k in range(400):
        r = dict(rnd.choice([x for x, _ in REASONS]))
        x = f"x{rnd.randrange(60)}"
        r |= {"x_id": x, "edge_key": f"disease_associated_protein|{x}|y1", "materialization_assertion_id": rnd.choice((f"{x}a", f"{x}b", f"{x}c{k}", "")), "materialization_assertion_conflict": rnd.choice((None, "false", "false", "false", "true" if k % 9 == 0 else "0"))}
        rows.append(r)
    rows += [GOOD | {"x_id": "agree", "edge_key": "disease_associated_protein|agree|y1", "materialization_assertion_id": f"agree{k}", "materialization_assertion_conflict": None} for k in (1, 2)]
    ev = table(spark, D.RELATION, rows)
    edges = ev.select("relation", "x_id", "x_type", "y_id", "y_type").distinct().union(spark.createDataFrame([(D.RELATION, "lone", "protein", "y1", "disease")]))
    return edges, ev, rows


def plain(rows):
    """Edge operands in plain Python."""
    def operands(r):
        why = next(w for x, w in REASONS if all(r.get(k) == v for k, v in x.items() if k not in ("materialization_assertion_id", "edge_key")))
        return ("", "") if why else (("gain_of_function" if r["source_dataset"] == C.COMMENTS else ""), "risk")

    out = {}
    for x in {r["x_id"] for r in rows}:
        own = [r for r in rows if r["x_id"] == x]
        state = []
        for i in (0, 1):
            by = {}
            for r in own:
                by.setdefault(r["materialization_assertion_id"], set()).add(operands(r)[i])
            values = sorted(set().union(*by.values()) - {""})
            ids = {a for a, v in by.items() if a and v - {""}}
            if any(len(v) > 1 for v in by.values()) or any(r["materialization_assertion_conflict"] == "true" for r in own):
                state += [values, "conflicting"]
            elif not ids:
                state += [[], "unknown"]
            else:
                state += [values, "single" if len(ids) == 1 else "consensus"]
        out[x] = tuple(state)
    return out


def test_edge_operands_against_plain_python(spark):
    edges, ev, rows = staged(spark)
    out, _ = D.materialised_operands(edges, ev)
    found = {r["x_id"]: (json.loads(r["causal_mechanisms"]), r["mechanism_status"], json.loads(r["effect_directions"]), r["effect_direction_status"]) for r in out.collect()}
    assert found.pop("lone") == ([], "unknown", [], "unknown")
    assert found == plain(rows) and {s for v in found.values() for s in v[1::2]} == set(C.STATES)


def test_recomputation_finds_one_changed_operand(spark):
    edges, ev, _ = staged(spark, 2)
    out, assertions = D.materialised_operands(edges, ev)
    assert D.operand_mismatches(out, ev).count() == 0
    before, again = D.operand_hash(out).first(), D.operand_hash(out.repartition(7)).first()
    assert before == again and before["n_rows"] == out.count()
    victim = out.where("effect_direction_status = 'single'").orderBy("x_id").first()["x_id"]
    changed = out.withColumn("effect_direction_status", F.when(F.col("x_id") == victim, "consensus").otherwise(F.col("effect_direction_status")))
    assert [tuple(r) for r in D.operand_mismatches(changed, ev).collect()] == [(f"{D.RELATION}|{victim}|y1", "effect_direction_status", "consensus", "single")]
    assert D.operand_hash(changed).first()["fingerprint"] != before["fingerprint"]
    assert D.operand_mismatches(out.where(F.col("x_id") != victim), ev).select("edge_key").distinct().count() == 1
    assert D.operand_inventory(assertions).agg(F.sum("n_rows")).first()[0] == 402


def test_operands_of_wrong_input(spark):
    edges, ev, _ = staged(spark, 3)
    for e, v in ((edges.where("x_id <> 'x1'"), ev), (edges.union(edges), ev), (edges, ev.withColumn("edge_key", F.lit("k"))), (edges.withColumn("x_type", F.lit("gene")), ev)):
        with pytest.raises(Exception):  # noqa: B017
            out, rows = D.materialised_operands(e, v)
            out.collect(), rows.collect()


def test_fingerprints_add_up(spark):
    df = spark.range(100).selectExpr("id", "id % 7 AS k", "CASE WHEN id % 5 = 0 THEN NULL ELSE 'v' || id END AS t")
    whole = table_fingerprint(df).first()
    assert table_fingerprint(df.repartition(9).select("t", "k", "id")).first() == whole
    parts = df.where("id < 30").agg(*digest_sums(df.columns)).union(df.where("id >= 30").agg(*digest_sums(df.columns)))
    assert added(parts, []).select("n_rows", fingerprint().alias("fingerprint")).first() == whole
    assert table_fingerprint(df.withColumn("k", F.when(F.col("id") == 3, 9).otherwise(F.col("k")))).first()["fingerprint"] != whole["fingerprint"]
    assert table_fingerprint(df.limit(0)).first()["n_rows"] == 0


@pytest.mark.parametrize("relation", sorted(C.RELATIONS))
def test_evidence_is_not_joined_for_features(spark, relation):
    ev = table(spark, relation, [{"source_record_id": str(k)} for k in range(3)])
    own = table(spark, relation, [{}]).select("relation", "x_id", "x_type", "y_id", "y_type")
    edges, rows = C.materialised(own, ev, relation)
    assert edges._jdf.queryExecution().optimizedPlan().toString().count("Join ") == 1
    assert edges.first()["evidence_count"] == C.edge_features(rows, relation).first()["evidence_count"]


def test_operands_do_not_join_evidence_rows(spark):
    ev = table(spark, D.RELATION, [GOOD, SEEN, GOOD | {"materialization_assertion_id": None}]).withColumn("edge_key", C.edge_key(D.RELATION))
    own = ev.select("relation", "x_id", "x_type", "y_id", "y_type").distinct()
    edges, assertions = D.materialised_operands(own, ev)
    assert edges._jdf.queryExecution().optimizedPlan().toString().count("Join ") == 2
    assert [tuple(r) for r in edges.select(*D.EDGE).collect()] == [tuple(r) for r in D.edge_operands(assertions).select(*D.EDGE).collect()]
    with pytest.raises(Exception, match="evidence without an edge"):
        D.materialised_operands(own.withColumn("x_id", F.lit("another")), ev)[0].collect()
    with pytest.raises(Exception, match="two edges of one identity"):
        D.materialised_operands(own.union(own), ev)[0].collect()

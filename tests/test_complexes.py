"""Complex records: participants, unique accessions, nesting to any depth with counts, cycles told and left out."""

import json
import random

import pytest
from pyspark.sql import functions as F

from kgloom.operators import complexes as C


@pytest.mark.parametrize("token, namespace, own, count", [
    ("P12345(2)", "uniprotkb", "P12345", "2"), ("P12345-2(0)", "uniprotkb", "P12345-2", "0"), ("CPX-12(1)", "complex_portal", "CPX-12", "1"), ("complex portal:cpx-7", "unknown", "complex portal:cpx-7", ""), ("CHEBI:29105(1)", "chebi", "29105", "1"),
    ("uniprotkb:Q9", "uniprotkb", "Q9", ""), ("[P1,P2](1)", "unknown", "[P1,P2]", "1"), ("a b(1)", "unknown", "a b(1)", ""), ("URS000(1)", "uniprotkb", "URS000", "1"), ("x(1)(2)", "unknown", "x(1)(2)", ""),
])
def test_participants(spark, token, namespace, own, count):
    r = spark.createDataFrame([(token,)], "t string").select(C.participant(F.col("t")).alias("p")).first()["p"]
    assert (r["raw"], r["namespace"], r["id"], r["stoichiometry"]) == (token, namespace, own, count)


COLUMNS = (C.AC, C.NAME, C.TAXON, C.MOLECULES, "Cross references", "Go Annotations", "Description")


def rows(spark, *records):
    return spark.createDataFrame([tuple(r) + (None,) * (len(COLUMNS) - len(r)) for r in records], ", ".join(f"`{c}` string" for c in COLUMNS))


def test_complexes(spark):
    source = rows(spark, ("CPX-1", "One", "9606", "P00001(2)|CPX-2(1)|P00003(1)|P00004|CHEBI:1(1)|CPX-1(1)", 'pubmed:"12"(see)|PMID:7|go:123|99', "GO:1(x)| - "), ("CPX-2", "-", "9606", "uniprotkb:P00001(0)"), ("CPX-3", "m", "10090", "P00001(1)"), ("-", "n", "9606", "P00001(1)"))
    proteins = spark.createDataFrame([("ENSP1", "P00001"), ("ENSP3", "P00003"), ("ENSP4", " P00003 "), ("ENSP5", None)], "id string, uniprot_id string")
    found = C.complexes(source, proteins, "r1")
    assert sorted((r["id"], r["name"], r["go_annotations"]) for r in found["nodes"].collect()) == [("CPX-1", "One", "GO:1(x)"), ("CPX-2", "CPX-2", "")]
    assert json.loads(found["nodes"].where("id = 'CPX-1'").first()["stoichiometry_json"])[:2] == [{"id": "P00001", "namespace": "uniprotkb", "stoichiometry": "2"}, {"id": "CPX-2", "namespace": "complex_portal", "stoichiometry": "1"}]
    assert sorted((r["x_id"], r["y_id"]) for r in found["edges"].collect()) == [("ENSP1", "CPX-1"), ("ENSP1", "CPX-2")]
    assert [(r["x_id"], r["y_id"], r["relation"]) for r in found["nested_edges"].collect()] == [("CPX-2", "CPX-1", C.NESTED)]
    ev = found["evidence"].where("y_id = 'CPX-1'").first()
    assert (ev["source_record_id"], ev["stoichiometry"], ev["pmids"], ev["edge_key"]) == ("CPX-1|P00001(2)", "2", "PMID:12|PMID:7|PMID:99", f"{C.MEMBER}|ENSP1|CPX-1")
    assert sorted((r["source_participant_id"], r["reason"], r["candidate_protein_ids"]) for r in found["rejected"].collect()) == [
        ("1", "unsupported_participant_namespace", ""), ("CPX-1", "nested_complex_self_reference", ""), ("P00003", "uniprot_maps_to_multiple_protein_nodes", "ENSP3|ENSP4"), ("P00004", "uniprot_unmapped_to_protein_node", ""),
    ]
    counts = {(r["what"], r["outcome"]): r["n"] for r in found["counts"].collect()}
    assert counts["complex", "non_human_complex"] == counts["complex", "missing_complex_id"] == 1 and counts["complex", ""] == 2 and counts["participant", ""] == 3


EDGE = "x_id string, y_id string, stoichiometry string"


def slow(members, nested):
    """Copies and depths by walking all ways; nestings on cycles are left out."""
    reach = {(a, b) for a, b, _ in nested}
    while True:
        more = {(a, d) for a, b in reach for c, d in reach if b == c} - reach
        if not more:
            break
        reach |= more
    cycles = {(a, b) for a, b, _ in nested if (b, a) in reach or a == b}
    number = lambda s: int(s) if s.isdigit() and int(s) > 0 else None
    up = {}
    for a, b, s in nested:
        if (a, b) not in cycles:
            up.setdefault(a, []).append((b, number(s)))
    out = {}

    def walk(protein, place, copies, depth):
        held = out.get((protein, place))
        out[protein, place] = (min(depth, held[0]), None if held[1] is None or copies is None else held[1] + copies) if held else (depth, copies)
        for whole, times in up.get(place, ()):
            walk(protein, whole, None if copies is None or times is None else copies * times, depth + 1)

    for p, c, s in members:
        walk(p, c, number(s), 1)
    return out, cycles


def test_flattening_against_walks(spark):
    rnd = random.Random(5)
    members = [(f"p{rnd.randrange(6)}", f"c{rnd.randrange(12)}", rnd.choice(("1", "2", "3", "0", ""))) for _ in range(25)]
    nested = [(f"c{a}", f"c{a + rnd.randrange(1, 4)}", rnd.choice(("1", "2", "2", "0"))) for a in range(9) for _ in range(2)] + [("c11", "c11", "1"), ("c10", "c9", "1"), ("c9", "c10", "2")]
    found, cycles = C.flattened(spark.createDataFrame(members, EDGE), spark.createDataFrame(nested, EDGE))
    want, odd = slow(members, nested)
    assert {(r["x_id"], r["y_id"]): (r["depth"], r["copies"]) for r in found.collect()} == want
    assert {(r["part"], r["whole"]) for r in cycles.collect()} == odd and ("c9", "c10") in odd and ("c11", "c11") in odd


def test_a_chain_of_many_levels(spark):
    nested = spark.createDataFrame([(f"c{k}", f"c{k + 1}", "1") for k in range(12)], EDGE)
    found, cycles = C.flattened(spark.createDataFrame([("p", "c0", "2")], EDGE), nested)
    assert sorted((r["depth"], r["copies"]) for r in found.collect()) == [(k, 2) for k in range(1, 14)] and cycles.count() == 0
    with pytest.raises(RuntimeError):
        C.nesting_cycles(nested, 3)


def test_nestings_on_no_cycle_are_peeled_off(spark):
    """A tree of 12 levels with one cycle at its foot: three rounds are enough, since only the cycle's ways are walked."""
    tree = [(f"t{k // 2}", f"t{k}", "1") for k in range(2, 4096)] + [("a", "b", "1"), ("b", "a", "1"), ("b", "t1", "1"), ("s", "s", "1")]
    found = C.nesting_cycles(spark.createDataFrame(tree, EDGE), 12)
    assert {(r["part"], r["whole"]) for r in found.collect()} == {("a", "b"), ("b", "a"), ("s", "s")}
    assert found._jdf.queryExecution().optimizedPlan().toString().count("Scan ExistingRDD") <= 8


def test_all_evidence_is_both_kinds(spark):
    source = rows(spark, ("CPX-1", "One", "9606", "P00001(2)|CPX-2(1)|P00004|CPX-1(1)"), ("CPX-2", "-", "9606", "uniprotkb:P00001(0)"))
    found = C.complexes(source, spark.createDataFrame([("ENSP1", "P00001")], "id string, uniprot_id string"))
    assert sorted(map(tuple, found["all_evidence"].collect())) == sorted(map(tuple, found["evidence"].unionByName(found["nested_evidence"]).collect())) and found["all_evidence"].count() == 3
    assert {(r["relation"], r["x_id"], r["x_type"], r["y_id"]) for r in found["all_evidence"].collect()} == {(C.MEMBER, "ENSP1", "protein", "CPX-1"), (C.MEMBER, "ENSP1", "protein", "CPX-2"), (C.NESTED, "CPX-2", "protein_complex", "CPX-1")}

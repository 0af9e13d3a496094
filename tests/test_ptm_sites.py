"""Modification sites: ids, contexts at both ends, hints, reasons, papers, disease candidates."""

import pytest
from pyspark.sql import functions as F

from kgloom.operators import ptm_sites as P

SEQUENCE = "MSTKYCRNQH"


def feature(kind="Modified residue", fid=None, text="Phosphoserine", start="2", end="2", modifier="EXACT", told=(("ECO:1", "PubMed", "12"), ("ECO:1", "pubmed", "x"), ("ECO:0", "Other", "9"))):
    return (kind, fid, text, ((start, modifier), (end, modifier)), list(told))


def found(spark, *features, accession="P1", **more):
    entries = spark.createDataFrame([(accession, (SEQUENCE,), list(features), [("DISEASE",)])], P.ENTRY)
    return P.ptm_sites(entries, spark.createDataFrame([("ENSP2", "P1|P9"), ("ENSP1", " P1"), ("ENSP3", None)], "id string, uniprot_id string"), "r1", **more)


def test_a_site_with_its_evidence(spark):
    out = found(spark, feature())
    s = out["sites"].first()
    assert (s["id"], s["protein_id"], s["residue"], s["sequence_context"], s["psi_mod_id"], s["evidence_codes"], s["pmids"]) == ("PTMSITE:P1:modified_residue:2:phosphoserine", "ENSP1", "S", "MSTKYCRNQ", "MOD:00696", "ECO:0|ECO:1", "PMID:12|x")
    assert sorted((r["evidence_type"], r["source_record_id"], r["paper_id"]) for r in out["evidence"].collect()) == [("database_record", "P1:Modified residue:2:Phosphoserine", ""), ("paper", "P1:Modified residue:2:Phosphoserine:PMID:12", "PMID:12"), ("paper", "P1:Modified residue:2:Phosphoserine:x", "x")]
    assert [tuple(r) for r in out["edges"].collect()] == [("ENSP1", "protein", s["id"], "ptm_site", P.RELATION, "has PTM site", "UniProtKB/r1", 3)]
    assert [tuple(r) for r in out["counts"].collect()] == [("accepted", 1, 1)] and out["candidates"].count() == 0


@pytest.mark.parametrize("position, want", [(1, "MST"), (2, "MSTK"), (5, "TKYCR"), (10, "NQH"), (0, ""), (11, "")])
def test_contexts_are_clamped(spark, position, want):
    assert spark.createDataFrame([(SEQUENCE, position)], "s string, p long").select(P.context(F.col("s"), F.col("p"), 2)).first()[0] == want


def test_ids_and_residues(spark):
    out = found(spark, feature(fid="CAR_7 x"), feature("Disulfide bond", text="", start="6", end="9"), feature(start="40", end="40", text="N6-acetyllysine"), feature("Chain"), feature("Glycosylation", text="O-linked (GalNAc) threonine", start="3", end=None))
    sites = {r["id"]: r for r in out["sites"].collect()}
    assert {k: (r["residue"], r["psi_mod_id"], r["modification_type"]) for k, r in sites.items()} == {
        "PTMSITE:P1:modified_residue:2:car_7_x": ("S", "MOD:00696", "Phosphoserine"), "PTMSITE:P1:disulfide_bond:6-9:disulfide_bond": ("C", "MOD:00689", "Disulfide bond"),
        "PTMSITE:P1:modified_residue:40:n6_acetyllysine": ("K", "MOD:00394", "N6-acetyllysine"), "PTMSITE:P1:glycosylation:3:o_linked_galnac_threonine": ("T", "MOD:00693", "O-linked (GalNAc) threonine"),
    }
    assert sites["PTMSITE:P1:modified_residue:40:n6_acetyllysine"]["sequence_context"] == ""


def test_every_reason(spark):
    features = [feature(start=None, end=None), feature(modifier="UNKNOWN"), feature(start="x"), feature(text="Phosphotyrosine"), feature(text="odd"), feature(start="40", end="40")]
    reasons = lambda **more: sorted(r["reason"] for r in found(spark, *features, **more)["rejected"].collect())
    assert reasons() == ["no_exact_position"] * 3 and reasons(check_residue=True) == ["no_exact_position"] * 3 + ["residue_differs_from_sequence"]
    assert reasons(accession="P7").count("missing_protein_mapping") == 3


def test_repeated_sites_and_disease_candidates(spark):
    text = "Phosphoserine; lost in HP:0001250 and mim 123456 disease"
    out = found(spark, feature(text=text), feature(text=text), feature(text="a deficiency", start="3", end="3"))
    assert out["sites"].count() == 2 and out["evidence"].where("evidence_type = 'database_record'").count() == 2
    assert sorted((r["disease_or_phenotype_id"], r["residue"]) for r in out["candidates"].collect()) == [("", "T"), ("HP:0001250|MIM 123456", "S")]

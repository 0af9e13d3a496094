"""Clinical evidence: ids, stages, reports, keys; warnings stay an audit."""

import pytest
from pyspark.sql import functions as F

from kgloom.operators import clinical as C


def frames(spark):
    edges = spark.createDataFrame([("molecule_treats_disease", "DB1", "EFO:1", "a"), ("molecule_treats_disease", "CHEMBL2", "MONDO:2", "b"), ("molecule_treats_disease", "X3", "EFO:1", "c")], "relation string, x_id string, y_id string, source string")
    molecules = spark.createDataFrame([("CHEMBL1", [("drugbank", ["DB1", None]), ("wiki", ["W1"])]), ("CHEMBL2", None)], "id string, crossReferences array<struct<source:string,ids:array<string>>>")
    rows = [("i1", "CHEMBL1", "EFO_1", "PHASE_3", ["NCT1", "x", "nct2"]), ("i1", "CHEMBL1", "EFO_1", "PHASE_3", ["NCT1", "x", "nct2"]), (None, "CHEMBL2", " MONDO_2 ", None, None), ("i3", None, "EFO_1", "IND", []), ("i4", "CHEMBL1", "EFO:1", "ODD", [])]
    return edges, molecules, spark.createDataFrame(rows, "id string, drugId string, diseaseId string, maxClinicalStage string, clinicalReportIds array<string>")


def test_evidence(spark):
    edges, molecules, indications = frames(spark)
    found = C.clinical_evidence(C.clinical_matches(edges, molecules, indications))
    got = sorted((r["edge_key"], r["source_record_id"], r["study_id"], r["evidence_score"], r["predicate"], r["text_span"]) for r in found.collect())
    assert got == [
        ("molecule_treats_disease|CHEMBL2|MONDO:2", "OpenTargets:clinical_indication", "", 0.1, "clinical indication; stage=UNKNOWN", "clinical_stage= | chembl_id=CHEMBL2 | ot_disease_id= MONDO_2 "),
        ("molecule_treats_disease|DB1|EFO:1", "OpenTargets:clinical_indication:i1", "NCT1;nct2", 0.85, "clinical indication; stage=PHASE_3", "clinical_stage=PHASE_3 | chembl_id=CHEMBL1 | ot_disease_id=EFO_1 | nct_ids=NCT1;nct2 | clinical_report_ids=NCT1;x;nct2"),
        ("molecule_treats_disease|DB1|EFO:1", "OpenTargets:clinical_indication:i4", "", 0.1, "clinical indication; stage=ODD", "clinical_stage=ODD | chembl_id=CHEMBL1 | ot_disease_id=EFO:1"),
    ]
    assert tuple(C.coverage(edges, found).first()) == (3, 2, 1, 0)
    assert sorted(map(tuple, C.clinical_evidence(C.clinical_matches(edges, molecules, indications, rows=1)).collect())) == sorted(map(tuple, found.collect()))


@pytest.mark.parametrize("stage, worth", C.STAGES.items())
def test_every_stage(spark, stage, worth):
    edges, molecules, indications = frames(spark)
    found = C.clinical_evidence(C.clinical_matches(edges, molecules, indications.limit(1).withColumn("maxClinicalStage", F.lit(stage))))
    assert found.first()["evidence_score"] == worth


def test_lists_and_ids(spark):
    df = spark.createDataFrame([(["", None, "NCT1", "b", "nct2"],), (None,)], "v array<string>")
    assert [tuple(r) for r in df.select(C.first_list_text(F.col("v")), C.first_list_text(F.col("v"), "nct"), C.first_list_text(F.col("v"), limit=1)).collect()] == [("NCT1;b;nct2", "NCT1;nct2", "NCT1"), ("", "", "")]
    ids = spark.createDataFrame([("EFO_1",), ("HP_2_3",), (" X_1 ",), (None,)], "i string")
    assert [r[0] for r in ids.select(C.disease_id(F.col("i"))).collect()] == ["EFO:1", "HP:2_3", "X_1", ""]


def test_warnings(spark):
    edges, molecules, _ = frames(spark)
    warnings = spark.createDataFrame([(["CHEMBL1", "CHEMBL9"], "EFO_1", None, "Withdrawn", "d"), (["CHEMBL1"], None, "EFO_1", "Withdrawn", None), (["CHEMBL2"], None, None, "Black Box", None)], "chemblIds array<string>, efoId string, efoIdForWarningClass string, warningType string, description string")
    assert tuple(C.warning_overlap(edges, molecules, warnings).first()) == (2, 1)
    assert sorted(map(tuple, C.warning_summary(warnings).collect())) == [("Black Box", 1, 0, 0, 0), ("Withdrawn", 2, 1, 1, 1)]

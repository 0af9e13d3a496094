"""Trials: full and empty records, links, evidence, texts, every check."""

import json

from pyspark.sql import functions as F

from kgloom.operators import trials as T

FULL = {
    "protocolSection": {
        "identificationModule": {"briefTitle": "A trial", "officialTitle": None}, "statusModule": {"overallStatus": "TERMINATED", "whyStopped": "Lack of efficacy", "startDateStruct": {"date": "2020-01"}},
        "sponsorCollaboratorsModule": {"leadSponsor": {"name": "Lab", "class": "OTHER"}, "collaborators": [{"name": "B"}, {}]}, "designModule": {"studyType": "X", "phases": ["PHASE1", "PHASE2"], "designInfo": {"allocation": "R", "maskingInfo": {"masking": "DOUBLE"}}, "enrollmentInfo": {"count": 12, "type": "ACTUAL"}},
        "armsInterventionsModule": {"interventions": [{"name": "a\n b", "type": "DRUG", "description": "d"}, {"type": "BIO"}, {}]}, "outcomesModule": {"primaryOutcomes": [{"measure": "M", "description": "nan", "timeFrame": "1 y"}], "secondaryOutcomes": []},
        "conditionsModule": {"conditions": ["c1", "", "c2"]}, "descriptionModule": {"briefSummary": " two  spaces "}, "referencesModule": {"references": [{"pmid": "7"}, {}]},
    },
    "resultsSection": {"outcomeMeasuresModule": {"outcomeMeasures": [{"title": "T", "type": "PRIMARY"}]}, "adverseEventsModule": {"timeFrame": "2 y"}, "moreInfoModule": {"certainAgreement": "yes"}},
}


def index(spark):
    return T.trial_index(spark.createDataFrame([("NCT00000001", json.dumps(FULL)), ("NCT00000002", "{}"), ("NCT00000003", None)], "nct_id string, json string"))


def test_records(spark):
    rows = {r["nct_id"]: r.asDict() for r in index(spark).collect()}
    r = rows["NCT00000001"]
    assert (r["brief_title"], r["official_title"], r["trajectory_class"], r["phase"], r["masking"], r["enrollment_count"], r["start_date"], r["completion_date"]) == ("A trial", "", "failed_efficacy_or_endpoint", "PHASE1; PHASE2", "DOUBLE", 12, "2020-01", "")
    assert (r["intervention_names"], r["intervention_types"], r["intervention_details"]) == ("a b", "BIO; DRUG", "type=DRUG | name=a b | description=d; type=BIO")
    assert (r["primary_outcome_text"], r["primary_endpoint_count"], r["secondary_endpoint_count"], r["conditions"], r["brief_summary"], r["publication_ids"], r["collaborators"]) == ("measure=M | time_frame=1 y", 1, 0, "c1; c2", "two spaces", "PMID:7", "B")
    assert r["result_summary_text"] == "title=T | type=PRIMARY; adverse_events_timeFrame=2 y; results_certainAgreement=yes"
    for k in ("NCT00000002", "NCT00000003"):
        assert {v for c, v in rows[k].items() if c not in ("nct_id", "source_url", "trajectory_class")} == {"", None, 0} and rows[k]["trajectory_class"] == "unknown_trial_trajectory"


def test_links_evidence_texts_and_checks(spark):
    told = spark.createDataFrame([("molecule_treats_disease|m|d", "m", "d", "nct00000001;NCT00000001 and NCT00000002"), ("molecule_treats_disease|m|d", "m", "d", "NCT00000001"), ("molecule_treats_disease|n|d", "n", "d", "")], "edge_key string, x_id string, y_id string, study_id string")
    links, trials = T.trial_links(told), index(spark)
    assert sorted(r["nct_id"] for r in links.collect()) == ["NCT00000001", "NCT00000002"]
    evidence, texts = T.trial_evidence(links, trials), T.trial_texts(trials)
    e = evidence.where("study_id = 'NCT00000001'").first()
    assert (e["direction"], e["paper_id"], e["source_record_id"]) == ("failed_efficacy_or_endpoint", "PMID:7", "ClinicalTrials.gov:NCT00000001") and e["text_span"].endswith("why_stopped=Lack of efficacy")
    t = texts.where("nct_id = 'NCT00000001'").first()
    assert t["source_text"].startswith("brief_title: A trial\nbrief_summary: two spaces\nconditions: c1; c2") and json.loads(t["source_field_inventory"])[-1] == "result_summary_text"
    edges = spark.createDataFrame([("molecule_treats_disease", "m", "d")], "relation string, x_id string, y_id string")
    told = lambda *a: {r["failure"]: r["n"] for r in T.trial_failures(*a).collect()}
    assert told(edges, links, trials, evidence, texts) == {"trials without link": 1, "empty texts": 2}
    assert told(edges.limit(0), links.union(links), trials.where("nct_id <> 'NCT00000002'"), evidence.union(evidence), texts.withColumn("source_text", F.lit("x"))) == {
        "repeated links": 2, "repeated evidence": 2, "links without edge": 4, "links without trial": 2, "evidence without edge": 4, "evidence without trial": 2, "texts without trial": 1, "trials without link": 1, "text hashes that do not fit": 3, "empty texts": 2,
    }

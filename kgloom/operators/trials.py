"""Trials: nested study records as one flat row each, their links to edges, evidence, text features, and checks of all four."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import nct_ids, trial_class

SOURCE, DATASET, RELATION = "ClinicalTrials.gov", "clinical_trials_gov_api_v2", "molecule_treats_disease"
_DATE, _OUTCOME = "struct<date:string>", "array<struct<measure:string,description:string,timeFrame:string>>"
#: What is read of a study record (JSON).
STUDY = (
    "protocolSection struct<identificationModule:struct<briefTitle:string,officialTitle:string>,"
    f"statusModule:struct<overallStatus:string,whyStopped:string,startDateStruct:{_DATE},primaryCompletionDateStruct:{_DATE},completionDateStruct:{_DATE}>,"
    "sponsorCollaboratorsModule:struct<leadSponsor:struct<name:string,class:string>,collaborators:array<struct<name:string>>>,"
    "designModule:struct<studyType:string,phases:array<string>,designInfo:struct<allocation:string,maskingInfo:struct<masking:string>>,enrollmentInfo:struct<count:bigint,type:string>>,"
    "armsInterventionsModule:struct<interventions:array<struct<name:string,type:string,description:string>>>,"
    f"outcomesModule:struct<primaryOutcomes:{_OUTCOME},secondaryOutcomes:{_OUTCOME}>,conditionsModule:struct<conditions:array<string>>,descriptionModule:struct<briefSummary:string,detailedDescription:string>,"
    "eligibilityModule:struct<eligibilityCriteria:string>,referencesModule:struct<references:array<struct<pmid:string>>>>,"
    "resultsSection struct<outcomeMeasuresModule:struct<outcomeMeasures:array<struct<title:string,description:string,timeFrame:string,type:string>>>,"
    "adverseEventsModule:struct<frequencyThreshold:string,timeFrame:string,description:string>,moreInfoModule:struct<limitationsAndCaveats:string,certainAgreement:string>>"
)
#: Fields that make up a trial's text, in order.
TEXT_FIELDS = ("brief_title", "official_title", "brief_summary", "detailed_description", "conditions", "intervention_details", "primary_outcome_text", "secondary_outcome_text", "eligibility_criteria", "why_stopped", "result_summary_text")


def clean_text(c: Column) -> Column:
    """Text with white space made single; what stands for nothing is empty."""
    text = F.coalesce(c, F.lit(""))
    return F.when(F.lower(text).isin("nan", "none", "<na>"), "").otherwise(F.trim(F.regexp_replace(text, r"\s+", " ")))


def _list(c: Column, kind: str) -> Column:
    return F.coalesce(c, F.array().cast(f"array<{kind}>"))


def joined(items: Column, limit: int) -> Column:
    """The first entries that are not empty, joined by `; `."""
    return F.array_join(F.slice(F.filter(items, lambda v: F.coalesce(v, F.lit("")) != ""), 1, limit), "; ")


def _parts(**fields: Column) -> Column:
    """`label=value | ..` of the fields that say something."""
    return F.concat_ws(" | ", *[F.when(clean_text(c) != "", F.concat(F.lit(f"{k}="), clean_text(c))) for k, c in fields.items()])


def trial_index(studies: DataFrame) -> DataFrame:
    """One flat row a study (nct_id, json).  What a record lacks is empty text or a null number."""
    rows = studies.select("nct_id", F.from_json("json", STUDY).alias("s")).select("nct_id", F.col("s.protocolSection").alias("p"), F.col("s.resultsSection").alias("r"))
    raw = lambda path: F.coalesce(F.col(path).cast("string"), F.lit(""))
    arms = _list(F.col("p.armsInterventionsModule.interventions"), "struct<name:string,type:string,description:string>")
    outcomes = lambda name: _list(F.col(f"p.outcomesModule.{name}"), "struct<measure:string,description:string,timeFrame:string>")
    details = lambda o: _parts(measure=o["measure"], description=o["description"], time_frame=o["timeFrame"])
    measures = _list(F.col("r.outcomeMeasuresModule.outcomeMeasures"), "struct<title:string,description:string,timeFrame:string,type:string>")
    told = F.transform(measures, lambda o: _parts(title=o["title"], description=o["description"], time_frame=o["timeFrame"], type=o["type"]))
    more = F.array(*[_parts(**{f"adverse_events_{k}": F.col(f"r.adverseEventsModule.{k}")}) for k in ("frequencyThreshold", "timeFrame", "description")], *[_parts(**{f"results_{k}": F.col(f"r.moreInfoModule.{k}")}) for k in ("limitationsAndCaveats", "certainAgreement")])
    papers = F.filter(F.transform(_list(F.col("p.referencesModule.references"), "struct<pmid:string>"), lambda x: x["pmid"]), lambda x: F.coalesce(x, F.lit("")) != "")
    date = lambda name: raw(f"p.statusModule.{name}.date")
    status, stopped = raw("p.statusModule.overallStatus"), raw("p.statusModule.whyStopped")
    return rows.select(
        "nct_id", raw("p.identificationModule.briefTitle").alias("brief_title"), raw("p.identificationModule.officialTitle").alias("official_title"), status.alias("overall_status"), stopped.alias("why_stopped"), trial_class(status, stopped).alias("trajectory_class"),
        joined(_list(F.col("p.designModule.phases"), "string"), 8).alias("phase"), raw("p.designModule.studyType").alias("study_type"), raw("p.designModule.designInfo.allocation").alias("allocation"), raw("p.designModule.designInfo.maskingInfo.masking").alias("masking"),
        F.col("p.designModule.enrollmentInfo.count").alias("enrollment_count"), F.col("p.designModule.enrollmentInfo.type").alias("enrollment_type"), date("startDateStruct").alias("start_date"), date("primaryCompletionDateStruct").alias("primary_completion_date"), date("completionDateStruct").alias("completion_date"),
        joined(_list(F.col("p.conditionsModule.conditions"), "string"), 20).alias("conditions"), clean_text(F.col("p.descriptionModule.briefSummary")).alias("brief_summary"), clean_text(F.col("p.descriptionModule.detailedDescription")).alias("detailed_description"),
        joined(F.transform(arms, lambda a: clean_text(a["name"])), 20).alias("intervention_names"), joined(F.array_sort(F.array_distinct(F.transform(arms, lambda a: clean_text(a["type"])))), 20).alias("intervention_types"),
        joined(F.transform(arms, lambda a: _parts(type=a["type"], name=a["name"], description=a["description"])), 20).alias("intervention_details"),
        joined(F.transform(outcomes("primaryOutcomes"), lambda o: o["measure"]), 8).alias("primary_endpoints"), joined(F.transform(outcomes("secondaryOutcomes"), lambda o: o["measure"]), 8).alias("secondary_endpoints"),
        joined(F.transform(outcomes("primaryOutcomes"), details), 12).alias("primary_outcome_text"), joined(F.transform(outcomes("secondaryOutcomes"), details), 12).alias("secondary_outcome_text"),
        F.size(outcomes("primaryOutcomes")).alias("primary_endpoint_count"), F.size(outcomes("secondaryOutcomes")).alias("secondary_endpoint_count"), clean_text(F.col("p.eligibilityModule.eligibilityCriteria")).alias("eligibility_criteria"),
        joined(F.concat(told, more), 20).alias("result_summary_text"), raw("p.sponsorCollaboratorsModule.leadSponsor.name").alias("lead_sponsor"), raw("p.sponsorCollaboratorsModule.leadSponsor.class").alias("lead_sponsor_class"),
        joined(F.transform(_list(F.col("p.sponsorCollaboratorsModule.collaborators"), "struct<name:string>"), lambda c: c["name"]), 12).alias("collaborators"),
        F.array_join(F.slice(F.transform(papers, lambda x: F.concat(F.lit("PMID:"), x)), 1, 20), ";").alias("publication_ids"), F.concat(F.lit("https://clinicaltrials.gov/study/"), "nct_id").alias("source_url"),
    )


def trial_links(evidence: DataFrame) -> DataFrame:
    """Every trial that an evidence row's study_id names, once for each edge."""
    return evidence.where("study_id <> ''").select("edge_key", "x_id", "y_id", F.explode(nct_ids(F.col("study_id"))).alias("nct_id")).distinct()


def trial_evidence(links: DataFrame, index: DataFrame) -> DataFrame:
    """Evidence rows of the linked trials."""
    text = F.concat_ws(" | ", *[F.concat(F.lit(f"{name}="), F.coalesce(F.col(c), F.lit(""))) for name, c in (("nct_id", "nct_id"), ("status", "overall_status"), ("phase", "phase"), ("trajectory", "trajectory_class"), ("sponsor", "lead_sponsor"), ("conditions", "conditions"), ("interventions", "intervention_names"), ("primary_endpoints", "primary_endpoints"), ("why_stopped", "why_stopped"))])
    return links.join(index, "nct_id").select(
        "edge_key", F.lit(RELATION).alias("relation"), "x_id", F.lit("molecule").alias("x_type"), "y_id", F.lit("disease").alias("y_type"), F.lit("clinical_trial_metadata").alias("evidence_type"), F.lit(SOURCE).alias("source"), F.lit(DATASET).alias("source_dataset"),
        F.concat(F.lit(f"{SOURCE}:"), "nct_id").alias("source_record_id"), F.col("publication_ids").alias("paper_id"), F.lit(SOURCE).alias("dataset_id"), F.col("nct_id").alias("study_id"), F.col("trajectory_class").alias("direction"),
        F.concat(F.lit("clinical trial metadata; "), "trajectory_class").alias("predicate"), F.substring(text, 1, 8000).alias("text_span"), F.lit("protocolSection").alias("section"), F.lit("joined_by_nct_id").alias("extraction_method"),
    )


def trial_texts(index: DataFrame) -> DataFrame:
    """One text a trial from the fields that say something, which those are, and its hash."""
    named = F.array(*[F.struct(F.lit(f).alias("f"), clean_text(F.col(f)).alias("v")) for f in TEXT_FIELDS])
    kept = F.filter(named, lambda x: x["v"] != "")
    text = F.array_join(F.transform(kept, lambda x: F.concat_ws(": ", x["f"], x["v"])), "\n")
    return index.select("nct_id", F.col("nct_id").alias("source_feature_key"), text.alias("source_text"), F.to_json(F.transform(kept, lambda x: x["f"])).alias("source_field_inventory"), F.sha2(text, 256).alias("source_text_hash"), F.length(text).alias("source_text_length"))


def trial_failures(edges: DataFrame, links: DataFrame, index: DataFrame, evidence: DataFrame, texts: DataFrame) -> DataFrame:
    """failure and n: repeated keys of each table, links and evidence without an edge or a trial, trials without a text, evidence of another link, hashes that do not fit."""
    key = F.concat_ws("|", "relation", "x_id", "y_id")
    known = edges.select(key.alias("edge_key")).distinct()

    def repeated(df: DataFrame, name: str, *by: str) -> DataFrame:
        return df.groupBy(*by).count().where("count > 1").agg(F.coalesce(F.sum(F.col("count") - 1), F.lit(0)).alias("n")).select(F.lit(f"repeated {name}").alias("failure"), "n")

    def without(df: DataFrame, other: DataFrame, name: str, *by: str) -> DataFrame:
        return df.join(other.select(*by).distinct(), list(by), "left_anti").agg(F.count("*").alias("n")).select(F.lit(name).alias("failure"), "n")

    study = evidence.withColumn("nct_id", F.col("study_id"))
    checks = [
        repeated(links, "links", "edge_key", "nct_id"), repeated(index, "trials", "nct_id"), repeated(evidence, "evidence", "edge_key", "study_id"), repeated(texts, "texts", "nct_id"),
        without(links, known, "links without edge", "edge_key"), without(links, index, "links without trial", "nct_id"), without(evidence, known, "evidence without edge", "edge_key"), without(study, index, "evidence without trial", "nct_id"),
        without(study, links, "evidence without link", "edge_key", "nct_id"), without(index, texts, "trials without text", "nct_id"), without(texts, index, "texts without trial", "nct_id"), without(index, links, "trials without link", "nct_id"),
    ]
    rules = {"text hashes that do not fit": F.sha2("source_text", 256) != F.col("source_text_hash"), "empty texts": F.col("source_text_length") == 0}
    checks += [texts.agg(F.count_if(rule).alias("n")).select(F.lit(name).alias("failure"), "n") for name, rule in rules.items()]
    checks.append(index.agg(F.count_if(~F.col("nct_id").rlike(r"^NCT\d{8}$")).alias("n")).select(F.lit("ids that are no trial's").alias("failure"), "n"))
    out = checks[0]
    for c in checks[1:]:
        out = out.unionByName(c)
    return out.where("n > 0")

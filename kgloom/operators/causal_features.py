"""Causal features of edges from their evidence: normalised values, and per edge what the assertions agree on.

Rows of one assertion that say different things are a conflict.  Evidence is
aggregated by assertion, then by edge, so no group of an edge is held whole.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CONTRACT = "causal-edge-features-v1"
STATES = ("single", "consensus", "conflicting", "unknown")
#: Action of a molecule, and its type, direction and what it does to the target.
ACTIONS = {
    "INHIBITOR": ("inhibitor", "negative", "decrease"), "ANTISENSE INHIBITOR": ("inhibitor", "negative", "decrease"), "RNAI INHIBITOR": ("inhibitor", "negative", "decrease"), "ANTAGONIST": ("antagonist", "negative", "decrease"),
    "ALLOSTERIC ANTAGONIST": ("antagonist", "negative", "decrease"), "INVERSE AGONIST": ("antagonist", "negative", "decrease"), "BLOCKER": ("blocker", "negative", "decrease"), "DEGRADER": ("degrader", "negative", "decrease"),
    "NEGATIVE MODULATOR": ("inhibitor", "negative", "decrease"), "NEGATIVE ALLOSTERIC MODULATOR": ("inhibitor", "negative", "decrease"), "GENE EDITING NEGATIVE MODULATOR": ("inhibitor", "negative", "decrease"),
    "AGONIST": ("agonist", "positive", "increase"), "PARTIAL AGONIST": ("agonist", "positive", "increase"), "ACTIVATOR": ("activator", "positive", "increase"), "POSITIVE MODULATOR": ("activator", "positive", "increase"),
    "POSITIVE ALLOSTERIC MODULATOR": ("activator", "positive", "increase"), "OPENER": ("activator", "positive", "increase"), "BINDING AGENT": ("binder_unknown_effect", "unknown", "binding"),
}
#: Mechanisms, directions of effects and responses, categories of responses, words for significance, support of datasets.
MECHANISMS = ("loss_of_function", "gain_of_function", "dominant_negative", "haploinsufficiency", "dosage_gain", "hypomorphic")
EFFECTS = ("risk", "protective", "protection")
RESPONSES = ("sensitive", "resistant", "increased_efficacy", "decreased_efficacy", "increased_toxicity", "decreased_toxicity", "increased_exposure", "decreased_exposure")
OPPOSITES = (("sensitive", "resistant"), ("increased_efficacy", "decreased_efficacy"), ("increased_toxicity", "decreased_toxicity"), ("increased_exposure", "decreased_exposure"))
CATEGORIES = {"efficacy": "efficacy", "toxicity": "toxicity", "dosage": "dosage", "dose": "dosage", "metabolism/pk": "metabolism_pk", "metabolism_pk": "metabolism_pk", "metabolism": "metabolism_pk", "pk": "metabolism_pk"}
SIGNIFICANCE = {
    "LP/P": "likely_pathogenic_or_pathogenic", "P/LP": "likely_pathogenic_or_pathogenic", "LB/B": "likely_benign_or_benign", "B/LB": "likely_benign_or_benign", "US": "uncertain_significance", "VUS": "uncertain_significance",
    "PATHOGENIC": "pathogenic", "LIKELY PATHOGENIC": "likely_pathogenic", "BENIGN": "benign", "LIKELY BENIGN": "likely_benign", "UNCERTAIN SIGNIFICANCE": "uncertain_significance",
}
SUPPORT = {"reviewed_human_disease_comments": "source_backed_disease_assertion", "humsavar_missense_variants": "source_backed_variant_disease_assertion"}
COMMENTS = "reviewed_human_disease_comments"
REQUIRED = ("relation", "x_id", "x_type", "y_id", "y_type")


def clean(c: Column) -> Column:
    return F.coalesce(F.trim(c.cast("string")), F.lit(""))


def snake(c: Column) -> Column:
    return F.regexp_replace(F.trim(F.translate(F.lower(clean(c)), "/-", "  ")), r"\s+", "_")


def mapped(c: Column, values: dict[str, str], default: Column | str = "") -> Column:
    """The value of a fixed map, else the default."""
    table = F.create_map(*[F.lit(x) for pair in values.items() for x in pair])
    return F.coalesce(F.try_element_at(table, c), default if isinstance(default, Column) else F.lit(default))


def among(c: Column, values: tuple[str, ...]) -> Column:
    return mapped(c, {v: v for v in values})


@dataclass(frozen=True)
class Kind:
    """How one kind of relation is normalised: raw fields by the columns that may hold them, then normalised columns from those."""

    raw: dict[str, tuple[str, ...]]
    normal: Callable[[dict[str, Column]], dict[str, Column]]
    usable: tuple[str, ...]
    numbers: tuple[str, ...] = ()
    extra: dict[str, tuple[str, ...]] = field(default_factory=dict)


def _actions(raw: dict[str, Column]) -> dict[str, Column]:
    upper = F.upper(raw["action"])
    names = ("normalized_action_type", "normalized_action_direction", "normalized_target_modulation")
    return {name: mapped(upper, {k: v[i] for k, v in ACTIONS.items()}) for i, name in enumerate(names)}


def _effect(c: Column) -> Column:
    return mapped(snake(c), {v: "protective" if v == "protection" else v for v in EFFECTS})


def _diseases(raw: dict[str, Column]) -> dict[str, Column]:
    explicit = mapped(F.upper(raw["explicit"]), SIGNIFICANCE, snake(raw["explicit"]))
    return {
        "normalized_causal_mechanism": among(snake(raw["mechanism"]), MECHANISMS), "normalized_effect_direction": _effect(raw["direction"]), "normalized_inheritance_mode": snake(raw["inheritance"]),
        "normalized_clinical_significance": F.when(explicit != "", explicit).otherwise(mapped(F.upper(raw["category"]), SIGNIFICANCE)), "normalized_causal_support_level": mapped(raw["dataset"], SUPPORT, "source_backed_association"),
    }


def _mutations(raw: dict[str, Column]) -> dict[str, Column]:
    number = lambda c: F.nanvl(F.nullif(c, F.lit("")).try_cast("double"), F.lit(None).cast("double"))
    return {
        "normalized_effect_allele": raw["allele"], "normalized_beta": number(raw["beta"]), "normalized_odds_ratio": number(raw["odds_ratio"]), "normalized_effect_direction": _effect(raw["direction"]),
        "normalized_clinical_significance": mapped(F.upper(raw["significance"]), SIGNIFICANCE, snake(raw["significance"])), "normalized_germline_somatic": snake(raw["origin"]),
    }


def _responses(raw: dict[str, Column]) -> dict[str, Column]:
    return {"normalized_response_category": mapped(F.lower(raw["category"]), CATEGORIES), "normalized_response_direction": among(snake(raw["direction"]), RESPONSES), "normalized_disease_context": raw["context"]}


_TARGETS = Kind({"action": ("action_type", "predicate")}, _actions, ("normalized_action_type",))
_ILL = Kind(
    {"mechanism": ("causal_mechanism", "mechanism"), "direction": ("effect_direction", "direction"), "inheritance": ("inheritance_mode", "inheritance"), "significance": ("clinical_significance", "variant_category")}, _diseases,
    ("normalized_causal_mechanism", "normalized_effect_direction", "normalized_inheritance_mode", "normalized_clinical_significance", "normalized_causal_support_level"), extra={"explicit": ("clinical_significance",), "category": ("variant_category",), "dataset": ("source_dataset",)},
)
#: relation: ends and kind
RELATIONS = {
    "molecule_targets_gene": ("molecule", "gene", _TARGETS), "molecule_targets_protein": ("molecule", "protein", _TARGETS), "disease_associated_gene": ("gene", "disease", _ILL), "disease_associated_protein": ("protein", "disease", _ILL),
    "mutation_associated_disease": ("mutation", "disease", Kind(
        {"allele": ("effect_allele",), "beta": ("beta",), "odds_ratio": ("odds_ratio", "oddsRatio"), "direction": ("effect_direction", "direction"), "significance": ("clinical_significance",), "origin": ("germline_somatic", "genetic_origin")}, _mutations,
        ("normalized_effect_allele", "normalized_beta", "normalized_odds_ratio", "normalized_effect_direction", "normalized_clinical_significance", "normalized_germline_somatic"), ("normalized_beta", "normalized_odds_ratio"),
    )),
    "mutation_affects_molecule_response": ("mutation", "molecule", Kind(
        {"category": ("response_category", "pgx_category", "predicate"), "direction": ("response_direction", "direction"), "context": ("disease_id", "disease_context")}, _responses, ("normalized_response_category", "normalized_response_direction"),
    )),
}


def _said(df: DataFrame, columns: tuple[str, ...]) -> Column:
    """The first of these columns that is not blank."""
    there = [F.nullif(clean(F.col(c)), F.lit("")) for c in columns if c in df.columns]
    return F.coalesce(*there, F.lit(""))


def edge_key(relation: str) -> Column:
    return F.concat_ws("|", F.lit(relation), clean(F.col("x_id")), clean(F.col("y_id")))


def _with_assertion(df: DataFrame, columns: list[str]) -> DataFrame:
    """df with the assertion that a row belongs to: by its source's id or record, else by all that these columns hold.

    Records of reviewed comments are cut before their papers.
    """
    have = lambda c: clean(F.col(c)) if c in columns else F.lit("")
    record = F.when((have("source_dataset") == COMMENTS) & F.contains(F.col("_record"), F.lit(":PMID:")), F.substring_index("_record", ":PMID:", 1)).otherwise(F.col("_record"))
    assertion = F.coalesce(F.nullif(have("source_assertion_id"), F.lit("")), F.nullif(F.col("_cut"), F.lit("")))
    named = F.concat_ws("|", *[have(c) for c in ("relation", "x_id", "y_id", "source", "source_dataset")], "_assertion")
    whole = F.sha2(F.to_json(F.struct(*[clean(F.col(c)).alias(c) for c in sorted(columns)])), 256)
    steps = df.withColumn("_record", have("source_record_id")).withColumn("_cut", record).withColumn("_assertion", assertion)
    return steps.withColumn("materialization_assertion_id", F.when(F.col("_assertion").isNotNull(), named).otherwise(whole)).drop("_record", "_cut", "_assertion")


def _checked(df: DataFrame, relation: str, what: str, required: tuple[str, ...]) -> DataFrame:
    """df, whose rows are errors where a required value is blank, the relation another, or an end of another type."""
    if relation not in RELATIONS:
        raise ValueError(f"no causal features for {relation!r}")
    if missing := [c for c in required if c not in df.columns]:
        raise ValueError(f"{what}/{relation} lacks {missing}")
    taken = [c for c in df.columns if c.startswith(("normalized_", "materialization_")) or c == "causal_feature_contract_version"]
    if taken:
        raise ValueError(f"{what}/{relation} already has {taken}")
    source, target, _ = RELATIONS[relation]
    blank = reduce(lambda a, b: a | b, [clean(F.col(c)) == "" for c in required])
    wrong = F.when(blank, "a blank required value").when(clean(F.col("relation")) != relation, "another relation").when((clean(F.col("x_type")) != source) | (clean(F.col("y_type")) != target), "an end of another type")
    if "edge_key" in df.columns:
        wrong = wrong.when(clean(F.col("edge_key")) != edge_key(relation), "an edge key that does not fit")
    failed = F.raise_error(F.concat(F.lit(f"{what}/{relation} has "), "_wrong")).cast("string")
    return df.withColumn("_wrong", wrong).withColumn("x_id", F.when(F.col("_wrong").isNotNull(), failed).otherwise(F.col("x_id"))).drop("_wrong")


def _said_rows(evidence: DataFrame, relation: str) -> DataFrame:
    """Evidence with edge key, assertion, normalised values, and as _payload what its fields say.

    Values are worked out in steps, each once: one projection of all of them is code too large to be compiled.
    """
    rows = _checked(evidence, relation, "evidence", (*REQUIRED, "source", "source_dataset", "source_record_id"))
    kind = RELATIONS[relation][2]
    raw = {k: F.col(f"_said_{k}") for k in kind.raw | kind.extra}
    rows = _with_assertion(rows, evidence.columns).withColumns({f"_said_{k}": _said(evidence, columns) for k, columns in (kind.raw | kind.extra).items()})
    marked = rows.withColumns({"edge_key": edge_key(relation), "_payload": F.struct(*[raw[k].alias(k) for k in kind.raw])} | kind.normal(raw))
    return marked.drop(*[f"_said_{k}" for k in raw])


def _split() -> Column:
    """Whether the rows of one assertion say different things."""
    return F.min("_payload") != F.max("_payload")


def _told_apart(said: DataFrame, evidence: DataFrame) -> DataFrame:
    own = ["edge_key", "materialization_assertion_id"]
    out = said.drop("_payload").join(said.groupBy(*own).agg(_split().alias("materialization_assertion_conflict")), own)
    if "source_assertion_id" not in evidence.columns:
        out = out.withColumn("source_assertion_id", F.col("materialization_assertion_id"))
    return out.withColumn("causal_feature_contract_version", F.lit(CONTRACT))


def normalised(evidence: DataFrame, relation: str) -> DataFrame:
    """Evidence with edge key, assertion, normalised values, and whether its assertion contradicts itself."""
    return _told_apart(_said_rows(evidence, relation), evidence)


def _usable(c: Column, number: bool) -> Column:
    return c.isNotNull() if number else ~c.isin("", "unknown")


def _status(values: Column, n: Column, conflicting: Column) -> Column:
    """State of a feature: its usable values, how many assertions have one, and whether they are at odds."""
    return F.when(F.col("conflict"), "conflicting").when(n == 0, "unknown").when(conflicting, "conflicting").when(n == 1, "single").otherwise("consensus")


def edge_features(evidence: DataFrame, relation: str) -> DataFrame:
    """Features of each edge (edge_key) that has normalised evidence."""
    return _features(evidence, relation, F.bool_or("materialization_assertion_conflict"))


def _features(evidence: DataFrame, relation: str, conflict: Column) -> DataFrame:
    """Features of each edge; conflict is an aggregate of the rows of an assertion."""
    kind = RELATIONS[relation][2]
    columns = {c: c in kind.numbers for c in dict.fromkeys((*kind.normal({k: F.lit("") for k in kind.raw | kind.extra}), *kind.usable))}
    rows = evidence
    if relation == "mutation_affects_molecule_response":
        said = F.when(F.col("normalized_response_category") != "", F.col("normalized_response_category")).otherwise(F.col("normalized_response_direction"))
        rows, columns = rows.withColumn("assertion", said), columns | {"assertion": False}
    counted = reduce(lambda a, b: a | b, [F.bool_or(_usable(F.col(c), columns[c])) for c in kind.usable])
    by_assertion = rows.groupBy("edge_key", "materialization_assertion_id").agg(
        conflict.alias("conflict"), F.coalesce(counted, F.lit(False)).alias("counted"),
        *[F.collect_set(F.col(c) if number else F.nullif(c, F.lit(""))).alias(c) for c, number in columns.items()],
    )
    sets = {c: F.array_sort(F.array_distinct(F.flatten(F.collect_list(c)))) for c in columns}
    told = {c: F.count_if(F.size(F.filter(F.col(c), lambda v: F.lit(True) if columns[c] else v != "unknown")) > 0) for c in columns}
    edges = by_assertion.groupBy("edge_key").agg(F.bool_or("conflict").alias("conflict"), F.count_if("counted").alias("evidence_count"), *[s.alias(c) for c, s in sets.items()], *[n.alias(f"n_{c}") for c, n in told.items()])
    value = lambda c: F.col(f"normalized_{c}")
    known = lambda c: F.filter(value(c), lambda v: v != "unknown")
    many = lambda c: _status(known(c), F.col(f"n_normalized_{c}"), F.size(known(c)) > 1)
    both = lambda c, pairs: reduce(lambda a, b: a | b, [F.array_contains(value(c), x) & F.array_contains(value(c), y) for x, y in pairs])
    text = lambda c: F.to_json(value(c))
    if relation.startswith("molecule_targets_"):
        opposed = both("action_direction", (("positive", "negative"),))
        features = {"action_types": text("action_type"), "action_direction": text("action_direction"), "target_modulation": text("target_modulation"), "action_status": _status(known("action_type"), F.col("n_normalized_action_type"), opposed)}
    elif relation.startswith("disease_associated_"):
        support = value("causal_support_level")
        features = {
            "causal_mechanisms": text("causal_mechanism"), "mechanism_status": many("causal_mechanism"), "effect_directions": text("effect_direction"), "effect_direction_status": many("effect_direction"), "inheritance_modes": text("inheritance_mode"),
            "causal_support_level": F.when(F.size(support) == 0, "unknown").when(F.size(support) == 1, support[0]).otherwise("mixed_source_backed_assertions"),
        }
    elif relation == "mutation_associated_disease":
        features = {
            "effect_alleles": text("effect_allele"), "beta": text("beta"), "odds_ratio": text("odds_ratio"), "effect_directions": text("effect_direction"), "clinical_significance": text("clinical_significance"), "germline_somatic": text("germline_somatic"),
            "association_status": many("effect_direction"),
        }
    else:
        features = {"response_categories": text("response_category"), "response_directions": text("response_direction"), "response_status": _status(F.col("assertion"), F.col("n_assertion"), both("response_direction", OPPOSITES)), "disease_context_status": many("disease_context")}
    return edges.select("edge_key", *[c.alias(k) for k, c in features.items()], "evidence_count")


def materialised(edges: DataFrame, evidence: DataFrame, relation: str) -> tuple[DataFrame, DataFrame]:
    """Edges with their causal features and evidence with its normalised values.

    An edge without evidence has empty lists and unknown states.  A feature column
    that the edges have already is an error.
    """
    said = _said_rows(evidence, relation)
    features = _features(said, relation, _split())  # of the rows as they are read: they need not meet their conflicts first
    added = [c for c in features.columns if c != "edge_key"]
    if taken := [c for c in added if c in edges.columns]:
        raise ValueError(f"edges/{relation} already has {taken}")
    own = _checked(edges, relation, "edges", REQUIRED)
    keyed = own.withColumn("_key", edge_key(relation)).join(features.withColumnRenamed("edge_key", "_key"), "_key", "left").drop("_key")
    blank = {c: F.coalesce(c, F.lit(0).cast("long")) if c == "evidence_count" else F.coalesce(c, F.lit("unknown" if c.endswith(("_status", "_level")) else "[]")) for c in added}
    return keyed.withColumns(blank | {"causal_feature_contract_version": F.lit(CONTRACT)}), _told_apart(said, evidence)


def staged_failures(edges: DataFrame, evidence: DataFrame, relation: str) -> DataFrame:
    """failure and n for a staged relation: blank identities, other relations or ends, states that are none, keys on one side only, other contracts."""
    source, target, _ = RELATIONS[relation]
    states = [c for c in edges.columns if c.endswith("_status")]
    blank = lambda columns: reduce(lambda a, b: a | b, [clean(F.col(c)) == "" for c in columns])
    ends = (clean(F.col("x_type")) != source) | (clean(F.col("y_type")) != target)

    def counts(df: DataFrame, what: str, rules: dict[str, Column]) -> DataFrame:
        one = df.agg(*[F.count_if(rule).alias(k) for k, rule in rules.items()])
        return one.select(F.explode(F.array(*[F.struct(F.lit(f"{what}: {k}").alias("failure"), F.col(k).alias("n")) for k in rules])).alias("r")).select("r.*")

    shared = {"another relation": clean(F.col("relation")) != relation, "another end": ends, "another contract": clean(F.col("causal_feature_contract_version")) != CONTRACT}
    found = counts(edges, "edges", {"blank identity": blank(REQUIRED), **shared, **{f"no state in {c}": ~clean(F.col(c)).isin(*STATES) for c in states}})
    found = found.unionByName(counts(evidence, "evidence", {"blank identity": blank((*REQUIRED, "source", "source_dataset", "source_record_id")), **shared, "edge key": clean(F.col("edge_key")) != edge_key(relation)}))
    here, there = edges.select(edge_key(relation).alias("k")).distinct(), evidence.select(clean(F.col("edge_key")).alias("k")).distinct()
    for name, a, b in (("evidence without edge", there, here), ("edges without evidence", here, there)):
        found = found.unionByName(a.join(b, "k", "left_anti").agg(F.count("*").alias("n")).select(F.lit(name).alias("failure"), "n"))
    return found.where("n > 0")

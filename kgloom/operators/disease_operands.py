"""Mechanism and direction of protein-disease edges from assertions that say them outright, and their independent recomputation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.fingerprint import table_fingerprint
from ..functions.ids import first_reason
from .causal_features import COMMENTS, clean, edge_key

CONTRACT, RELATION, VARIANTS = "disease-causal-operands-v1", "disease_associated_protein", "humsavar_missense_variants"
#: The source of each dataset and its family, what an exact mapping says, the phrase that states a gain of function.
SOURCES = {COMMENTS: ("UniProtKB", "UniProtKB_reviewed_disease_comment"), VARIANTS: ("UniProtKB/humsavar", "UniProtKB_humsavar")}
EXACT = ("exact_uniprot_accession_to_existing_protein_node", "exact_disease_xref_to_existing_disease_node")
GAIN = r"(?i)\b(?:disorder|disease)\s+due\s+to\s+(?:an?\s+)?gain[ -]of[ -]function\s+defect\b"
#: The operands of an assertion and the one value each may have.
OPERAND_VALUES = {"mechanism_operand": "gain_of_function", "disease_direction_operand": "risk"}
OPERANDS = tuple(OPERAND_VALUES)
EDGE = ["causal_mechanisms", "mechanism_status", "effect_directions", "effect_direction_status", "both_operands_known"]


def _have(df: DataFrame):
    return lambda c: clean(F.col(c)) if c in df.columns else F.lit("")


def _truthy(df: DataFrame) -> Column:
    return F.lower(_have(df)("materialization_assertion_conflict")).isin("1", "true", "yes")


def reject_reason(df: DataFrame) -> Column:
    """The first gate that an assertion (with _gain) fails: dataset, provenance, source, disease, variant, isoform, mapping; or that it says nothing outright."""
    have = _have(df)
    dataset, record, variant = have("source_dataset"), have("source_record_id"), have("variant_ft_id")
    source = F.when(dataset == COMMENTS, SOURCES[COMMENTS][0]).when(dataset == VARIANTS, SOURCES[VARIANTS][0])
    mapping = F.split(have("mapping_confidence"), ";")
    exact = F.array_contains(mapping, EXACT[0]) & F.array_contains(mapping, EXACT[1]) & (have("x_id") != "") & (have("uniprot_accession") != "")
    return first_reason(
        (source.isNull(), "unsupported_source_family_or_mapping"), ((have("source") == "") | (record == "") | (have("release") == ""), "missing_source_provenance"), (have("source") != source, "source_family_mismatch"),
        ((have("disease_source_id") == "") | (have("y_id") == ""), "missing_disease_context"), ((dataset == VARIANTS) & ((variant == "") | (record == "")), "missing_exact_variant_identity"),
        (have("isoform") != "canonical", "mixed_or_noncanonical_isoform"), (~exact, "ambiguous_or_inexact_mapping"), ((dataset == VARIANTS) & (record != variant), "variant_source_record_mismatch"),
        (~(F.col("_gain") | _pathogenic(df)), "no_eligible_explicit_operand"),
    )


def _gain(df: DataFrame) -> Column:
    have = _have(df)
    return (have("source_dataset") == COMMENTS) & have("disease_description").rlike(GAIN)


def _pathogenic(df: DataFrame) -> Column:
    have = _have(df)
    return (have("source_dataset") == VARIANTS) & (F.upper(have("variant_category")) == "LP/P")


def _with_operands(evidence: DataFrame) -> DataFrame:
    """Evidence with why it has no operand, its operands, and whether it inherits a conflict (_inherited)."""
    rows = evidence.withColumn("_gain", _gain(evidence))
    rows = rows.withColumn("operand_reject_reason", F.coalesce(reject_reason(evidence), F.lit("")))
    usable = F.col("operand_reject_reason") == ""
    mechanism, direction = OPERAND_VALUES.values()
    return rows.withColumns({"mechanism_operand": F.when(usable & F.col("_gain"), mechanism).otherwise(""), "disease_direction_operand": F.when(usable, direction).otherwise(""), "_inherited": _truthy(evidence)})


def operand_assertions(evidence: DataFrame) -> DataFrame:
    """Evidence with its operands, their support, why it has none, and whether its assertion contradicts itself."""
    have, usable = _have(evidence), F.col("operand_reject_reason") == ""
    family = F.when(have("source_dataset") == COMMENTS, SOURCES[COMMENTS][1]).when(have("source_dataset") == VARIANTS, SOURCES[VARIANTS][1]).otherwise("unsupported")
    path = {"mapping_confidence": "mapping_confidence", "mapping_method": "mapping_method", "protein_id": "x_id", "source_disease_id": "disease_source_id", "source_protein_id": "uniprot_accession", "target_disease_id": "y_id", "variant_id": "variant_ft_id"}
    support = F.when(usable & F.col("_gain"), "explicit_uniprot_disease_causal_phrase").when(usable, "explicit_humsavar_pathogenic_variant_disease").otherwise("unusable")
    rows = _with_operands(evidence).withColumns({
        "operand_source_family": family, "operand_source_record_id": have("source_record_id"), "operand_source_release": have("release"), "operand_mapping_path": F.to_json(F.struct(*[have(c).alias(k) for k, c in path.items()])),
        "operand_support_class": support, "operand_confidence": F.when(usable, "direct_explicit").otherwise("unknown"),
    })
    own = ["edge_key", "materialization_assertion_id"]
    split = rows.groupBy(*own).agg(*[(F.min(c) != F.max(c)).alias(f"_{c}") for c in OPERANDS])
    marked = rows.join(split, own)
    marked = marked.withColumns({f"{c}_conflict": F.col("_inherited") | F.col(f"_{c}") for c in OPERANDS} | {"disease_operand_contract_version": F.lit(CONTRACT)})
    return marked.withColumns({"normalized_causal_mechanism": F.col(OPERANDS[0]), "normalized_effect_direction": F.col(OPERANDS[1])}).drop("_inherited", "_gain", *[f"_{c}" for c in OPERANDS])


def edge_operands(assertions: DataFrame) -> DataFrame:
    """What the assertions of each edge (edge_key) agree on; values never come through a conflict as known."""
    return _edge_states(assertions, {c: F.bool_or(f"{c}_conflict") for c in OPERANDS})


def _edge_states(rows: DataFrame, conflicts: dict[str, Column]) -> DataFrame:
    """States of each edge from rows with operands: by assertion, then by edge; conflicts are aggregates of an assertion's rows.

    An operand has one value or none, so flags stand for it and no set is gathered.
    """
    once = rows.groupBy("edge_key", "materialization_assertion_id").agg(*[F.bool_or(F.col(c) != "").alias(c) for c in OPERANDS], *[x.alias(f"x_{c}") for c, x in conflicts.items()])
    named = F.coalesce(F.col("materialization_assertion_id") != "", F.lit(False))
    found = once.groupBy("edge_key").agg(*[F.bool_or(c).alias(c) for c in OPERANDS], *[F.count_if(F.col(c) & named).alias(f"n_{c}") for c in OPERANDS], *[F.bool_or(f"x_{c}").alias(f"x_{c}") for c in OPERANDS])

    def status(c: str) -> Column:
        return F.when(F.col(f"x_{c}"), "conflicting").when(F.col(f"n_{c}") == 0, "unknown").when(F.col(f"n_{c}") == 1, "single").otherwise("consensus")

    listed = lambda c: F.when(F.col(c) & (F.col(f"x_{c}") | (F.col(f"n_{c}") > 0)), f'["{OPERAND_VALUES[c]}"]').otherwise("[]")
    return _known(found.select("edge_key", listed(OPERANDS[0]).alias("causal_mechanisms"), status(OPERANDS[0]).alias("mechanism_status"), listed(OPERANDS[1]).alias("effect_directions"), status(OPERANDS[1]).alias("effect_direction_status")))


def _known(df: DataFrame) -> DataFrame:
    return df.withColumn("both_operands_known", F.col("mechanism_status").isin("single", "consensus") & F.col("effect_direction_status").isin("single", "consensus"))


def materialised_operands(edges: DataFrame, evidence: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Protein-disease edges with their operands and evidence with its own; evidence whose key is not that of its ends, or of no edge, is an error."""
    for what, df in (("edges", edges), ("evidence", evidence)):
        required = ("relation", "x_id", "x_type", "y_id", "y_type", *(("edge_key", "source", "source_dataset", "source_record_id", "release", "materialization_assertion_id") if what == "evidence" else ()))
        if missing := [c for c in required if c not in df.columns]:
            raise ValueError(f"{what} lacks {missing}")
    odd = lambda df: (clean(F.col("relation")) != RELATION) | (clean(F.col("x_type")) != "protein") | (clean(F.col("y_type")) != "disease")
    error = lambda message: F.raise_error(F.lit(message)).cast("string")
    key = edge_key(RELATION)
    own = edges.withColumn("edge_key", F.when(odd(edges), error("an edge of another relation or type")).otherwise(key))
    counted = own.groupBy("edge_key").agg(F.count("*").alias("_n"))
    rows = evidence.withColumn("edge_key", F.when(odd(evidence), error("evidence of another relation or type")).when(clean(F.col("edge_key")) != key, error("an edge key that does not fit")).otherwise(F.col("edge_key")))
    fitting = lambda df: df.join(counted, "edge_key", "left").withColumn("edge_key", F.when(F.col("_n").isNull(), error("evidence without an edge")).when(F.col("_n") > 1, error("two edges of one identity")).otherwise(F.col("edge_key"))).drop("_n")
    assertions = operand_assertions(fitting(rows))
    named = F.col("materialization_assertion_id").isNotNull()
    told = _with_operands(rows).withColumns({c: F.when(named, F.col(c)).otherwise("") for c in OPERANDS} | {"_inherited": named & F.col("_inherited")})
    states = _edge_states(told, {c: F.bool_or("_inherited") | (F.min(F.col(c) != "") != F.max(F.col(c) != "")) for c in OPERANDS})
    joined = own.join(fitting(states), "edge_key", "left")  # edges meet states, not rows
    fill = {c: F.coalesce(c, F.lit("unknown" if c.endswith("status") else "[]")) for c in EDGE[:4]} | {"both_operands_known": F.coalesce("both_operands_known", F.lit(False))}
    out = joined.withColumns(fill | {"disease_operand_contract_version": F.lit(CONTRACT)})
    return (out if "edge_key" in edges.columns else out.drop("edge_key")), assertions


#: The rules once more as SQL over the raw evidence (view {rows}), for a plan of its own.
_AGAIN = """
WITH a AS (SELECT trim(edge_key) AS k, trim(materialization_assertion_id) AS id, {inherited} AS bad, source_dataset = '{comments}' AS told, source_dataset = '{variants}' AS seen, {text} AS text, {category} AS category,
    coalesce(trim(release), '') <> '' AND coalesce(trim(source_record_id), '') <> '' AND source = CASE source_dataset WHEN '{comments}' THEN 'UniProtKB' WHEN '{variants}' THEN 'UniProtKB/humsavar' END
      AND {isoform} = 'canonical' AND {disease} <> '' AND {accession} <> '' AND contains(';' || {mapping} || ';', ';{protein_map};') AND contains(';' || {mapping} || ';', ';{disease_map};')
      AND (source_dataset <> '{variants}' OR ({variant} <> '' AND {variant} = trim(source_record_id))) AS sound FROM {rows}),
b AS (SELECT *, coalesce(sound AND told AND text RLIKE '{gain}', false) AS gain, coalesce(sound AND seen AND upper(category) = 'LP/P', false) AS harm FROM a),
c AS (SELECT k, id, bool_or(bad) AS bad, bool_or(gain) AS g, bool_and(gain) AS all_g, bool_or(gain OR harm) AS r, bool_and(gain OR harm) AS all_r FROM b GROUP BY k, id),
d AS (SELECT k, bool_or(bad OR g <> all_g) AS gx, bool_or(bad OR r <> all_r) AS rx, bool_or(g) AS any_g, bool_or(r) AS any_r, count_if(g AND id <> '') AS ng, count_if(r AND id <> '') AS nr FROM c GROUP BY k)
SELECT k AS edge_key, CASE WHEN any_g AND (gx OR ng > 0) THEN '["gain_of_function"]' ELSE '[]' END AS causal_mechanisms, CASE WHEN gx THEN 'conflicting' WHEN ng = 0 THEN 'unknown' WHEN ng = 1 THEN 'single' ELSE 'consensus' END AS mechanism_status,
  CASE WHEN any_r AND (rx OR nr > 0) THEN '["risk"]' ELSE '[]' END AS effect_directions, CASE WHEN rx THEN 'conflicting' WHEN nr = 0 THEN 'unknown' WHEN nr = 1 THEN 'single' ELSE 'consensus' END AS effect_direction_status FROM d
"""


def recomputed(evidence: DataFrame) -> DataFrame:
    """Operands of each edge with evidence, by other expressions than those that made them."""
    have = lambda c: f"coalesce(trim({c}), '')" if c in evidence.columns else "''"
    inherited = "lower(coalesce(trim(CAST(materialization_assertion_conflict AS STRING)), '')) IN ('1', 'true', 'yes')" if "materialization_assertion_conflict" in evidence.columns else "false"
    sql = _AGAIN.replace("{rows}", "{evidence}")
    names = {"inherited": inherited, "comments": COMMENTS, "variants": VARIANTS, "text": have("disease_description"), "category": have("variant_category"), "isoform": have("isoform"), "disease": have("disease_source_id"), "accession": have("uniprot_accession"), "mapping": have("mapping_confidence"), "variant": have("variant_ft_id"), "protein_map": EXACT[0], "disease_map": EXACT[1], "gain": GAIN.replace("\\", "\\\\")}
    for k, v in names.items():
        sql = sql.replace(f"{{{k}}}", v)
    return _known(evidence.sparkSession.sql(sql, evidence=evidence))


def operand_mismatches(edges: DataFrame, evidence: DataFrame) -> DataFrame:
    """edge_key, field, staged, expected: where staged edges differ from the recomputation, and edges on one side only."""
    staged = edges.select(edge_key(RELATION).alias("edge_key"), *[F.col(c).cast("string").alias(c) for c in EDGE])
    again = recomputed(evidence).select("edge_key", *[F.col(c).cast("string").alias(c) for c in EDGE])
    blank = {"causal_mechanisms": "[]", "effect_directions": "[]", "mechanism_status": "unknown", "effect_direction_status": "unknown", "both_operands_known": "false"}
    joined = staged.select("edge_key", F.struct(*EDGE).alias("s")).join(again.select("edge_key", F.struct(*EDGE).alias("e")), "edge_key", "full")
    fields = F.array(*[F.struct(F.lit(c).alias("field"), F.col(f"s.{c}").alias("staged"), F.coalesce(F.col(f"e.{c}"), F.lit(blank[c])).alias("expected")) for c in EDGE])
    return joined.select("edge_key", F.explode(fields).alias("f")).select("edge_key", "f.*").where("NOT (staged <=> expected)")


def operand_hash(edges: DataFrame) -> DataFrame:
    """n_rows and fingerprint of the edges' operands, in whatever order."""
    return table_fingerprint(edges.select(edge_key(RELATION).alias("edge_key"), *EDGE))


def operand_inventory(assertions: DataFrame) -> DataFrame:
    """operand_source_family, operand_reject_reason ('' if usable): assertions (each once) and evidence rows."""
    once = assertions.groupBy("operand_source_family", "materialization_assertion_id").agg(F.min("operand_reject_reason").alias("operand_reject_reason"), F.count("*").alias("rows"))
    return once.groupBy("operand_source_family", "operand_reject_reason").agg(F.count("*").alias("n_assertions"), F.sum("rows").alias("n_rows"))

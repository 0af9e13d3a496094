"""Inferred edges by named templates: joins of two to four premises, gates that fail closed, reject reasons.

A premise is an edge row with its context fields as sets of lower-case values.
A field is unknown without a value, conflicting with several, else known.  Each
gate leaves the paths that pass and counts the others by reason.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Fields that say where a fact holds, what a mapping rests on, where a row comes from, which rows support it.
CONTEXT_FIELDS = ("assembly", "organism", "tissue", "biosample", "cell_type", "cell_line", "disease_context", "phenotype_context", "population", "dose", "time", "readout")
MAPPING_FIELDS = ("assembly", "organism", "transcript_id", "isoform_id", "protein_isoform")
SOURCE_FIELDS = ("source", "source_dataset", "study_id", "dataset_id")
EVIDENCE_ID_FIELDS = ("evidence_key", "source_record_id", "study_id", "dataset_id", "paper_id")
#: What counts as support for a pathogenic variant, and why other values do not.
PATHOGENIC = ("pathogenic", "likely_pathogenic", "pathogenic_likely_pathogenic", "reviewed_causal", "causal_reviewed")
NOT_PATHOGENIC = {"benign": "non_pathogenic_benign", "likely_benign": "non_pathogenic_likely_benign", "associative": "noncausal_associative_support", "association": "noncausal_generic_support", "generic": "noncausal_generic_support"}
#: Words with a sign; support that is causal; responses that benefit; attributions too weak to use.
POSITIVE = ("activate", "activation", "agonist", "gain_of_function", "increase", "risk", "positive")
NEGATIVE = ("inhibit", "inhibition", "inhibitor", "antagonist", "loss_of_function", "decrease", "protective", "negative")
CAUSAL = ("causal", "causal_mechanistic", "genetic_causal", "mechanistic", "pathogenic_causal", "validated_causal")
BENEFIT = ("sensitive", "sensitivity", "benefit", "increased_efficacy", "increased_response", "therapeutic_benefit")
WEAK_ATTRIBUTION = ("containment", "genomic_containment", "nearest_gene", "ld_only")
#: SQL text of an empty list.
NO_TEXT = "CAST(array() AS array<string>)"
_OWN = ("x_id", "y_id", "x_type", "y_type", "relation", "edge_key", "evidence_ids")


def values(c: Column, lower: bool = True) -> Column:
    """Sorted distinct values of a scalar or of a JSON list in a string; blanks are none."""
    text = F.trim(c.cast("string"))
    items = F.when(text.startswith("["), F.coalesce(F.from_json(text, "array<string>"), F.array(text))).otherwise(F.array(text))
    clean = F.transform(items, lambda x: F.lower(F.trim(x)) if lower else F.trim(x))
    return F.array_sort(F.array_distinct(F.filter(clean, lambda x: x.isNotNull() & (x != ""))))


#: The same as SQL text of a column {c}; a scalar is not sorted, nor gone through by functions of lists.
_VALUES = (
    "CASE WHEN startswith(trim(CAST({c} AS STRING)), '[') THEN array_sort(array_distinct(filter(transform(coalesce(from_json(trim(CAST({c} AS STRING)), 'array<string>'), array(trim(CAST({c} AS STRING)))), x -> lower(trim(x))), x -> x IS NOT NULL AND x <> '')))"
    " WHEN trim(CAST({c} AS STRING)) <> '' THEN array(lower(trim(CAST({c} AS STRING)))) ELSE CAST(array() AS array<string>) END"
)


def with_evidence(edges: DataFrame, evidence: DataFrame | None = None) -> DataFrame:
    """Edges with an edge key and the ids of their evidence, and with what their evidence says.

    A field that the edge lacks takes the one value of its evidence.  Several values, or one that
    differs from the edge's, make the field conflicting.
    """
    key = F.col("edge_key") if "edge_key" in edges.columns else F.concat_ws("|", "relation", "x_id", "y_id")
    edges = edges.withColumn("edge_key", key)
    none = F.array().cast("array<string>")
    if evidence is None:
        return edges.withColumn("evidence_ids", none)
    named = [c for c in evidence.columns if c not in _OWN]
    filled = lambda c: F.nullif(F.trim(F.col(c).cast("string")), F.lit(""))
    ids = F.array_sort(F.array_distinct(F.flatten(F.collect_list(F.array_compact(F.array(*[filled(c) for c in EVIDENCE_ID_FIELDS if c in evidence.columns])))))).alias("evidence_ids")
    ev_key = F.col("edge_key") if "edge_key" in evidence.columns else F.concat_ws("|", "relation", "x_id", "y_id")
    said = evidence.groupBy(ev_key.alias("edge_key")).agg(ids, *[F.collect_set(filled(c)).alias(f"_e_{c}") for c in named])
    joined = edges.join(said, "edge_key", "left")
    out = {"evidence_ids": F.coalesce("evidence_ids", none)}
    for c in named:
        told = F.coalesce(F.col(f"_e_{c}"), none)
        every = F.array_union(told, F.array(filled(c))) if c in edges.columns else told
        n = F.size(F.array_compact(every))
        own = F.col(f"{c}_status").cast("string") if f"{c}_status" in edges.columns else F.lit(None).cast("string")
        out[f"{c}_status"] = F.when(n > 1, "conflicting").otherwise(own)
        if c not in edges.columns:
            out[c] = F.when(n == 1, F.get(told, F.lit(0)))
    return joined.withColumns(out).drop(*[f"_e_{c}" for c in named])


def _premise(edges: DataFrame) -> tuple[DataFrame, frozenset[str]]:
    if "evidence_ids" not in edges.columns:
        edges = with_evidence(edges)
    fields = [c for c in edges.columns if c not in _OWN]
    return edges.select("x_id", "y_id", "edge_key", "evidence_ids", *[F.expr(_VALUES.format(c=f"`{c}`")).alias(c) for c in fields]), frozenset(fields)


@dataclass
class Paths:
    """Joined premises, each a struct by its role; the fields each has; the reasons of those that left."""

    df: DataFrame
    fields: dict[str, frozenset[str]]
    rejects: list[DataFrame] = field(default_factory=list)

    @classmethod
    def of(cls, role: str, edges: DataFrame) -> Paths:
        df, fields = _premise(edges)
        return cls(df.select(F.struct("*").alias(role)), {role: fields})

    def join(self, role: str, edges: DataFrame, left: str, right: str, how: str = "inner", once: bool = False, keep: str | None = None) -> Paths:
        """Join a premise where left (`role.column`) equals its column; `once`: a pair of its ends counts once.

        `keep` names a column for the key: rows grouped by it among others need no further shuffle.
        """
        df, fields = _premise(edges)
        df = df.dropDuplicates(["x_id", "y_id"]) if once else df
        key = df.select(F.col(right).alias("_k"), F.struct("*").alias(role))
        met = self.df.withColumn("_k", F.col(left)).join(key, "_k", how)
        return Paths(met.withColumnRenamed("_k", keep) if keep else met.drop("_k"), self.fields | {role: fields}, self.rejects)

    def attach(self, other: Paths, left: str, right: str, how: str = "inner") -> Paths:
        """Join other paths."""
        return Paths(self.df.withColumn("_k", F.col(left)).join(other.df.withColumn("_k", F.col(right)), "_k", how).drop("_k"), self.fields | other.fields, self.rejects + other.rejects)

    def decide(self, *rules: tuple[Column, Column | str]) -> Paths:
        """Paths for which no rule holds; the first that does gives the reason."""
        reason = F.lit(None).cast("string")
        for holds, name in reversed(rules):
            reason = F.when(holds, F.lit(name) if isinstance(name, str) else name).otherwise(reason)
        marked = self.df.withColumn("_reason", reason)
        return Paths(marked.where("_reason IS NULL").drop("_reason"), self.fields, [*self.rejects, marked.where("_reason IS NOT NULL").select(F.col("_reason").alias("reason"))])

    # Expressions of fields are written as SQL text: a template has hundreds, and each call from Python costs more than its work.
    def _values(self, role: str, *names: str) -> str:
        have = [f"coalesce({role}.`{n}`, {NO_TEXT})" for n in names if n in self.fields[role]]
        return reduce(lambda x, y: f"array_union({x}, {y})", have) if have else NO_TEXT

    def _state(self, role: str, *names: str) -> str:
        marks, found = self._values(role, *[f"{n}_status" for n in names]), self._values(role, *names)
        has = lambda items, word: f"array_contains({items}, '{word}')" if items != NO_TEXT else "false"
        return f"CASE WHEN {has(marks, 'conflicting')} OR {has(found, 'conflicting')} OR size({found}) > 1 THEN 'conflicting' WHEN size({found}) = 0 OR {has(marks, 'unknown')} THEN 'unknown' ELSE 'known' END"

    def _known(self, role: str, *names: str) -> str:
        return f"CASE WHEN {self._state(role, *names)} = 'known' THEN get({self._values(role, *names)}, 0) END"

    def values(self, role: str, *names: str) -> Column:
        return F.expr(self._values(role, *names))

    def state(self, role: str, *names: str) -> Column:
        return F.expr(self._state(role, *names))

    def known(self, role: str, *names: str) -> Column:
        """The one value of a known field, else null."""
        return F.expr(self._known(role, *names))

    def compatible(self, roles: tuple[str, ...], fields: tuple[str, ...] = CONTEXT_FIELDS) -> Column:
        """No field conflicts, and no field has two different known values."""
        rules = ["true"]
        for f in fields:
            have = [r for r in roles if f in self.fields[r] or f"{f}_status" in self.fields[r]]
            rules += [f"{self._state(r, f)} <> 'conflicting'" for r in have]
            if len(have) > 1:
                rules.append(f"size(array_distinct(array_compact(array({', '.join(self._known(r, f) for r in have)})))) <= 1")
        return F.expr(" AND ".join(rules))

    def sources(self, role: str) -> Column:
        return self.values(role, *SOURCE_FIELDS)

    def independent(self, a: str, b: str) -> Column:
        return (F.size(self.sources(a)) > 0) & (F.size(self.sources(b)) > 0) & ~F.arrays_overlap(self.sources(a), self.sources(b))

    def shares_context(self, a: str, b: str) -> Column:
        """Some context field has the same one value in both."""
        both = [f for f in CONTEXT_FIELDS if f in self.fields[a] and f in self.fields[b]]
        same = [f"size({self._values(a, f)}) = 1 AND {self._values(a, f)} = {self._values(b, f)}" for f in both]
        return F.expr(" OR ".join(same) or "false")

    def sign(self, role: str, *names: str) -> tuple[Column, Column]:
        """State and sign (+1, -1) of fields that hold words with a sign."""
        marks, found = self.values(role, *[f"{n}_status" for n in names]), self.values(role, *names)
        words = lambda ws: F.array(*map(F.lit, ws))
        up, down = F.arrays_overlap(found, words(POSITIVE)), F.arrays_overlap(found, words(NEGATIVE))
        strange = F.size(F.array_except(found, words(POSITIVE + NEGATIVE))) > 0
        conflict = F.array_contains(marks, "conflicting") | F.array_contains(found, "conflicting")
        unknown = (F.size(found) == 0) | F.array_contains(marks, "unknown") | strange
        state = F.when(conflict, "conflicting").when(unknown, "unknown").when(up & down, "conflicting").otherwise("known")
        return state, F.when(state == "known", F.when(up, 1).otherwise(-1))

    def action_sign(self, role: str) -> tuple[Column, Column]:
        """Each field that says anything must agree."""
        mark = self.values(role, "action_status")
        parts = [(F.size(self.values(role, f, f"{f}_status")) > 0, *self.sign(role, f)) for f in ("action_direction", "target_modulation", "action_types", "action_type") if {f, f"{f}_status"} & self.fields[role]]
        some = lambda what: reduce(lambda x, y: x | y, [there & (state == what) for there, state, _ in parts], F.lit(False))
        signs = F.array_distinct(F.array_compact(F.array(*[sign for _, _, sign in parts]))) if parts else F.array().cast("array<int>")
        state = F.when(F.array_contains(mark, "conflicting"), "conflicting").when(F.array_contains(mark, "unknown"), "unknown").when(some("conflicting"), "conflicting").when(some("unknown"), "unknown")
        state = state.when(F.size(signs) > 1, "conflicting").when(F.size(signs) == 0, "unknown").otherwise("known")
        return state, F.when(state == "known", F.get(signs, F.lit(0)))

    def disease_sign(self, role: str) -> tuple[Column, Column]:
        """Mechanism times effect, both known."""
        both = []
        for fields, mark in ((("causal_mechanisms", "causal_mechanism", "pathological_mechanism_sign"), "mechanism_status"), (("effect_directions", "effect_direction"), "effect_direction_status")):
            state, sign = self.sign(role, *fields)
            told = self.values(role, mark)
            state = F.when(F.array_contains(told, "conflicting"), "conflicting").when(F.array_contains(told, "unknown"), "unknown").otherwise(state)
            both.append((state, F.when(state == "known", sign)))
        (s1, v1), (s2, v2) = both
        state = F.when((s1 == "conflicting") | (s2 == "conflicting"), "conflicting").when((s1 == "unknown") | (s2 == "unknown"), "unknown").otherwise("known")
        return state, F.when(state == "known", v1 * v2)

    def not_pathogenic(self, role: str) -> Column:
        """Why a variant's disease support is no use, or null."""
        names = ("pathogenicity", "clinical_significance", "disease_support")
        marks = self.values(role, *[f"{n}_status" for n in names])
        plain = lambda v: F.concat_ws("_", F.filter(F.split(F.translate(F.lower(F.trim(v)), "/-", "  "), r"\s+"), lambda x: x != ""))
        found = F.array_sort(F.array_distinct(F.transform(self.values(role, *names), plain)))
        bad = F.array_except(found, F.array(*map(F.lit, PATHOGENIC)))
        first = F.get(bad, F.lit(0))
        why = reduce(lambda out, kv: out.when(first == kv[0], kv[1]), list(NOT_PATHOGENIC.items())[1:], F.when(first == "benign", NOT_PATHOGENIC["benign"])).otherwise(F.concat(F.lit("nonallowlisted_disease_support_"), first))
        conflict = F.array_contains(marks, "conflicting") | F.array_contains(found, "conflicting")
        unknown = (F.size(found) == 0) | F.array_contains(marks, "unknown") | F.array_contains(found, "unknown")
        return F.when(conflict, "conflicting_pathogenicity").when(unknown, "unknown_pathogenicity").when((F.size(bad) > 0) & (F.size(bad) < F.size(found)), "conflicting_pathogenicity").when(F.size(bad) > 0, why)

    def rows(self, x: str, y: str, roles: tuple[str, ...], member: str | None = None, anchor: str | None = None, **extra: Column) -> DataFrame:
        """One row for each path: its ends, its supports, what tells derived views apart, and extra columns."""
        flat = lambda c: F.array_sort(F.array_distinct(F.flatten(F.array(*[F.col(f"{r}.{c}") for r in roles]))))
        context = {f: reduce(F.array_union, [self.values(r, f) for r in roles]) for f in CONTEXT_FIELDS if any(f in self.fields[r] for r in roles)}
        context = F.to_json(F.struct(*[F.array_sort(v).alias(f) for f, v in sorted(context.items())])) if context else F.lit("{}")
        text = lambda c: F.col(c) if c else F.lit("")  # noqa: E731  (keys of inner joins, so never null; bare, so that Spark still knows how they are dealt)
        return self.df.select(
            F.col(x).alias("x_id"), F.col(y).alias("y_id"), text(member).alias("member_id"), text(anchor).alias("anchor_id"), F.array_sort(F.array_distinct(F.array(*[F.col(f"{r}.edge_key") for r in roles]))).alias("supports"),
            flat("evidence_ids").alias("evidence"), context.alias("context_intersection"), F.to_json(F.array(*[F.struct(f"{r}.x_id", f"{r}.y_id", f"{r}.edge_key") for r in roles])).alias("typed_path"), *[c.alias(n) for n, c in extra.items()],
        )


def _mapping(r: dict[str, DataFrame]) -> Paths:
    """transcript_encodes_protein with gene_has_transcript, compatible as mappings."""
    paths = Paths.of("encoding", r["transcript_encodes_protein"]).join("gene", r["gene_has_transcript"], "encoding.x_id", "y_id")
    return Paths(paths.df.where(paths.compatible(("encoding", "gene"), MAPPING_FIELDS)), paths.fields)


def _transcript_gene(r):
    p = Paths.of("a", r["mutation_affects_transcript"]).join("gene", r["gene_has_transcript"], "a.y_id", "y_id", "left")
    p = p.decide((F.col("gene").isNull(), "missing_mapping"), (~p.compatible(("a", "gene"), MAPPING_FIELDS), "assembly_mismatch"))
    return p, p.rows("a.x_id", "gene.x_id", ("a", "gene"))


def _through_mapping(relation: str, gene_end: str, protein: str = "y_id", missing: bool = True):
    """A fact about a protein as one about its gene; gene_end: which end the gene takes."""

    def build(r):
        p = Paths.of("a", r[relation]).attach(_mapping(r), f"a.{protein}", "encoding.y_id", "left" if missing else "inner")
        rules = [(F.col("encoding").isNull(), "missing_mapping")] if missing else []
        p = p.decide(*rules, (~p.compatible(("a", "encoding", "gene"), MAPPING_FIELDS), "isoform_or_assembly_mismatch"))
        return p, p.rows(*(("gene.x_id", "a.y_id") if gene_end == "x" else ("a.x_id", "gene.x_id")), ("a", "encoding", "gene"))

    return build


def _two_hop(first: str, second: str, triangle: str | None):
    """mutation - disease - phenotype: compatible, from independent sources; or closed by an observed edge."""

    def build(r):
        p = Paths.of("a", r[first]).join("b", r[second], "a.y_id", "x_id", keep="_anchor")
        p = p.decide((~p.compatible(("a", "b")) | ~p.independent("a", "b"), "context_or_source_circularity"))
        if triangle is None:
            return p, p.rows("a.x_id", "b.y_id", ("a", "b"), anchor="_anchor")
        p = p.df.withColumn("_end", F.concat_ws("\0", "a.x_id", "b.y_id")), p
        seen, fields = _premise(r[triangle])
        seen = seen.dropDuplicates(["x_id", "y_id"]).select(F.concat_ws("\0", "x_id", "y_id").alias("_end"), F.struct("*").alias("c"))
        p = Paths(p[0].join(seen, "_end", "left").drop("_end"), p[1].fields | {"c": fields}, p[1].rejects).decide((F.col("c").isNull(), "incomplete_triangle"))
        return p, p.rows("a.x_id", "b.y_id", ("a", "b", "c"), anchor="a.y_id")

    return build


def _same_disease(triangle: str | None):
    """phenotype and tissue of one disease."""

    def build(r):
        p = Paths.of("a", r["disease_has_phenotype"]).join("b", r["disease_manifests_in_tissue"], "a.x_id", "x_id", keep="_anchor")
        p = p.decide((~p.compatible(("a", "b")) | ~p.independent("a", "b"), "context_or_source_circularity"))
        if triangle is None:
            return p, p.rows("b.y_id", "a.y_id", ("a", "b"), anchor="_anchor")
        seen, fields = _premise(r[triangle])
        seen = seen.dropDuplicates(["x_id", "y_id"]).select(F.concat_ws("\0", "x_id", "y_id").alias("_end"), F.struct("*").alias("c"))
        p = Paths(p.df.withColumn("_end", F.concat_ws("\0", "b.y_id", "a.y_id")).join(seen, "_end", "left").drop("_end"), p.fields | {"c": fields}, p.rejects).decide((F.col("c").isNull(), "incomplete_triangle"))
        return p, p.rows("b.y_id", "a.y_id", ("a", "b", "c"), anchor="a.x_id")

    return build


def _cell_type_tissue(r):
    p = Paths.of("a", r["cell_type_found_in_tissue"]).join("b", r["cell_type_expresses_gene"], "a.x_id", "x_id")
    p = p.decide((~p.compatible(("a", "b")), "context_mismatch"))
    return p, p.rows("a.y_id", "b.y_id", ("a", "b"))


def _variant(end: str, gene: bool):
    """A variant's protein, or its gene, with the variant's disease or phenotype."""

    def build(r):
        p = Paths.of("a", r["mutation_causes_protein_change"]).join("b", r[end], "a.x_id", "x_id")
        why = p.not_pathogenic("b")
        rules = [(why.isNotNull(), why)] if end.endswith("disease") else []
        p = p.decide(*rules, (~p.compatible(("a", "b")), "context_mismatch"))
        if not gene:
            return p, p.rows("a.y_id", "b.y_id", ("a", "b"))
        p = p.attach(_mapping(r), "a.y_id", "encoding.y_id", "left")
        p = p.decide((F.col("encoding").isNull(), "missing_mapping"), (~p.compatible(("a", "b", "encoding", "gene"), MAPPING_FIELDS), "isoform_or_assembly_mismatch"))
        return p, p.rows("gene.x_id", "b.y_id", ("a", "encoding", "gene", "b"))

    return build


def _gene_to_protein(r):
    p = Paths.of("a", r["disease_associated_gene"])
    explicit = p.values("a", "protein_id", "protein_isoform", "isoform_id")
    p = p.decide((F.size(explicit) == 0, "missing_isoform_support")).attach(_mapping(r), "a.x_id", "gene.x_id")
    p = Paths(p.df.where(F.array_contains(p.values("a", "protein_id", "protein_isoform", "isoform_id"), F.lower("encoding.y_id"))), p.fields, p.rejects)
    return p, p.rows("encoding.y_id", "a.y_id", ("a", "encoding", "gene"))


def _pathway_member(membership: str, association: str):
    def build(r):
        p = Paths.of("a", r[membership]).join("b", r[association], "a.y_id", "x_id", keep="_member")
        return p, p.rows("a.x_id", "b.y_id", ("a", "b"), member="_member")

    return build


def _folded_members(membership: str, association: str):
    """The same, one row for each pathway, disease and member, with how many paths there are; none where edges bring their own keys or evidence.

    A key made of an edge's relation and ends is the same for all edges of one pair, and so
    is their paths' hash.  So each premise is folded to its pairs of ends before they meet
    and the rows of the join are neither sorted nor shuffled.
    """

    def one(edges: DataFrame, by: str, role: str) -> tuple[DataFrame, frozenset[str]]:
        df, fields = _premise(edges.where(F.col(by).isNotNull()).repartition(by))  # dealt by member once, for folding and for the join
        fields &= set(CONTEXT_FIELDS)
        flat = {c: f"_{role}_{c}" for c in ("x_id", "y_id", *sorted(fields))}
        df = df.groupBy("x_id", "y_id").agg(F.count("*").alias(f"_n_{role}"), *[F.first(c).alias(c) for c in sorted(fields)])
        return df.select(F.col(by).alias("_member"), f"_n_{role}", *[F.col(c).alias(n) for c, n in flat.items()]), fields

    def whole(role: str, relation: str, fields: frozenset[str]) -> Column:
        ends = [F.col(f"_{role}_{c}").alias(c) for c in ("x_id", "y_id", *sorted(fields))]
        return F.struct(*ends, F.concat_ws("|", F.lit(relation), *ends[:2]).alias("edge_key"), F.expr(NO_TEXT).alias("evidence_ids")).alias(role)

    def build(r):
        if {"edge_key", "evidence_ids"} & {*r[membership].columns, *r[association].columns}:
            return None
        (a, of_a), (b, of_b) = one(r[membership], "y_id", "a"), one(r[association], "x_id", "b")
        met = a.join(b, "_member").select("_member", "_n_a", "_n_b", whole("a", membership, of_a), whole("b", association, of_b))
        return Paths(met, {"a": of_a, "b": of_b}).rows("a.x_id", "b.y_id", ("a", "b"), member="_member", support_multiplicity=F.col("_n_a") * F.col("_n_b"))

    return build


def _pathway_disease(r, most: int = 500):
    """A pathway and a disease by two members from disjoint sources, or by native support; no large pathways."""
    size = r["pathway_contains_gene"].groupBy(F.col("x_id").alias("x")).agg(F.count("*").alias("pathway_size"))
    inside = r["pathway_contains_gene"].join(size.withColumnRenamed("x", "x_id"), "x_id")
    associated = r["disease_associated_gene"]
    large = F.col("pathway_size") > most
    pairs = inside.where(large).select(F.col("x_id").alias("x"), F.col("y_id").alias("g")).join(associated.select(F.col("x_id").alias("g"), F.col("y_id").alias("y")), "g").select("x", "y").distinct()
    fanout = pairs.select(F.lit("pathway_fanout").alias("reason"))  # large pathways are counted, none of their members gathered
    # each premise is folded to its pairs of ends, so a member of a pathway and a disease is one row of the join, and the join's rows are not grouped by member
    a, b = (Paths.of(role, df.where(F.col(key).isNotNull()).repartition(key)) for role, df, key in (("a", inside.where(~large), "y_id"), ("b", associated, "x_id")))
    native = F.arrays_overlap(b.values("b", "pathway_native_support"), F.array(F.lit("true"), F.lit("1"), F.lit("yes")))
    fact = lambda p, role: F.struct(F.col(f"{role}.edge_key").alias("key"), F.col(f"{role}.evidence_ids").alias("ids"), p.sources(role).alias("sources")).alias("fact")
    left = a.df.select(F.col("a.y_id").alias("member"), F.col("a.x_id").alias("x"), F.get(F.col("a.pathway_size"), F.lit(0)).cast("long").alias("pathway_size"), fact(a, "a")).groupBy("x", "member").agg(F.max("pathway_size").alias("pathway_size"), F.collect_set("fact").alias("of_a"))
    right = b.df.select(F.col("b.x_id").alias("member"), F.col("b.y_id").alias("y"), native.alias("native"), fact(b, "b")).groupBy("member", "y").agg(F.bool_or("native").alias("native"), F.collect_set("fact").alias("of_b"))
    free = lambda s, t: (F.size(s) > 0) & (F.size(t) > 0) & ~F.arrays_overlap(s, t)
    each = F.flatten(F.transform("of_a", lambda s: F.transform("of_b", lambda t: F.struct(free(s["sources"], t["sources"]).alias("free"), F.array(s["key"], t["key"]).alias("keys"), F.concat(s["ids"], t["ids"]).alias("ids"), t["sources"].alias("sources")))))
    of = lambda rows, c: F.array_distinct(F.flatten(F.transform(rows, lambda x: x[c])))
    met = left.join(right, "member").select("x", "y", "pathway_size", "native", each.alias("each")).withColumn("free_each", F.filter("each", lambda x: x["free"]))
    members = met.select(
        "x", "y", "pathway_size", "native", (F.size("free_each") > 0).alias("free"), F.array_sort(of("free_each", "sources")).alias("sources"), of("free_each", "keys").alias("free_keys"),
        of(F.filter("each", lambda x: ~x["free"]), "keys").alias("bound_keys"), of("each", "ids").alias("ids"),
    )
    listed = lambda c: F.flatten(F.collect_list(c))
    flat = lambda c: F.array_sort(F.array_distinct(c))
    groups = members.groupBy("x", "y").agg(
        F.bool_or("native").alias("native"), F.count_if("free").alias("n_free"), F.count("*").alias("n_all"), F.max("pathway_size").alias("pathway_size"), listed("bound_keys").alias("bound_keys"), listed("free_keys").alias("free_keys"), flat(listed("ids")).alias("evidence"),
        F.collect_set(F.when(F.col("free"), F.col("sources"))).alias("sets"),
    )
    disjoint = F.exists("sets", lambda s: F.exists("sets", lambda t: (F.size(s) > 0) & (F.size(t) > 0) & ~F.arrays_overlap(s, t)))  # distinct source sets of one group
    rules = Paths(groups, {}, [fanout]).decide(((F.col("n_free") < 2) & ~F.col("native"), "insufficient_independent_members"), (~disjoint & ~F.col("native"), "source_commonality_or_circularity"))
    none = F.lit("")
    rows = rules.df.select(
        F.col("x").alias("x_id"), F.col("y").alias("y_id"), none.alias("member_id"), none.alias("anchor_id"), flat(F.when(F.col("native"), F.concat("free_keys", "bound_keys")).otherwise(F.col("free_keys"))).alias("supports"), "evidence",
        F.lit("{}").alias("context_intersection"), F.lit("[]").alias("typed_path"), F.when(F.col("native"), F.col("n_all")).otherwise(F.col("n_free")).alias("associated_member_count"), "pathway_size",
    )
    return rules, rows


def _pathway_disease_pairs(r, most: int = 500):
    """The same: its rows are one for each pair as they are."""
    return _pathway_disease(r, most)[1].withColumn("support_multiplicity", F.lit(1).cast("long"))


def _facts(p: Paths, role: str, fields: tuple[str, ...] = CONTEXT_FIELDS) -> dict[str, Column]:
    """What compatibility asks of one premise, as plain columns: a conflict in any field, each field's one known value and its single value."""
    own = [f for f in fields if f in p.fields[role] or f"{f}_status" in p.fields[role]]
    conflict = " OR ".join(f"{p._state(role, f)} = 'conflicting'" for f in own) or "false"
    single = {f"_{role}_single_{f}": F.expr(f"CASE WHEN size({p._values(role, f)}) = 1 THEN get({p._values(role, f)}, 0) END") for f in own if f in p.fields[role]}
    return {f"_{role}_conflict": F.expr(conflict)} | {f"_{role}_known_{f}": p.known(role, f) for f in own} | single


def _fits(columns: list[str], a: str, b: str, fields: tuple[str, ...] = CONTEXT_FIELDS) -> tuple[Column, Column]:
    """Whether two premises are compatible, and whether they share a context, from their facts."""
    same = lambda kind, otherwise: [f"coalesce(_{a}_{kind}_{f} = _{b}_{kind}_{f}, {otherwise})" for f in fields if {f"_{a}_{kind}_{f}", f"_{b}_{kind}_{f}"} <= set(columns)]
    return F.expr(" AND ".join([f"NOT _{a}_conflict", f"NOT _{b}_conflict", *same("known", "true")])), F.expr(" OR ".join(same("single", "false")) or "false")


def _with_sign(p: Paths, role: str, name: str, *fields: str) -> Paths:
    """Columns _{name}_state and _{name}_sign, each worked out once."""
    up = F.arrays_overlap(p.values(role, *fields), F.array(*map(F.lit, POSITIVE)))
    df = p.df.withColumn(f"_{name}_state", p.sign(role, *fields)[0]).withColumn(f"_{name}_sign", F.when(F.col(f"_{name}_state") == "known", F.when(up, 1).otherwise(-1)))
    return Paths(df, p.fields, p.rejects)


def _worst(states: list[Column]) -> Column:
    """conflicting, unknown or known, the worst of some states."""
    some = lambda what: reduce(lambda x, y: x | y, [s == what for s in states], F.lit(False))
    return F.when(some("conflicting"), "conflicting").when(some("unknown"), "unknown").otherwise("known")


def _marked(told: Column, state: Column) -> Column:
    """A state, overridden by what a status field says."""
    return F.when(F.array_contains(told, "conflicting"), "conflicting").when(F.array_contains(told, "unknown"), "unknown").otherwise(state)


def _action_facts(p: Paths, role: str) -> DataFrame:
    """p.df with _action_state and _action_sign, as `action_sign` says."""
    names = [f for f in ("action_direction", "target_modulation", "action_types", "action_type") if {f, f"{f}_status"} & p.fields[role]]
    mark, there = p.values(role, "action_status"), {f: F.size(p.values(role, f, f"{f}_status")) > 0 for f in names}
    for f in names:
        p = _with_sign(p, role, f, f)
    said = [F.when(there[f], F.col(f"_{f}_state")) for f in names]
    signs = F.array_distinct(F.array_compact(F.array(*[F.when(there[f], F.col(f"_{f}_sign")) for f in names]))) if names else F.array().cast("array<int>")
    df = p.df.withColumn("_signs", signs)
    some = lambda what: reduce(lambda x, y: x | y, [F.coalesce(s == what, F.lit(False)) for s in said], F.lit(False))
    state = F.when(some("conflicting"), "conflicting").when(some("unknown"), "unknown").when(F.size("_signs") > 1, "conflicting").when(F.size("_signs") == 0, "unknown").otherwise("known")
    df = df.withColumn("_action_state", _marked(mark, state))
    return df.withColumn("_action_sign", F.when(F.col("_action_state") == "known", F.get("_signs", F.lit(0))))


def _disease_facts(p: Paths, role: str) -> DataFrame:
    """p.df with _disease_state and _disease_sign, as `disease_sign` says, and _causal_state and _causal."""
    parts = {"mechanism": ("causal_mechanisms", "causal_mechanism", "pathological_mechanism_sign"), "effect": ("effect_directions", "effect_direction")}
    told = {"mechanism": p.values(role, "mechanism_status"), "effect": p.values(role, "effect_direction_status")}
    support = ("causal_support_level", "causal_support")
    causal = {"_causal_state": p.state(role, *support), "_causal": p.known(role, *support)}
    for name, fields in parts.items():
        p = _with_sign(p, role, name, *fields)
    df = p.df.withColumns({f"_{n}_state": _marked(told[n], F.col(f"_{n}_state")) for n in parts})
    df = df.withColumns({"_disease_state": _worst([F.col(f"_{n}_state") for n in parts]), "_product": F.col("_mechanism_sign") * F.col("_effect_sign")} | causal)
    return df.withColumn("_disease_sign", F.when(F.col("_disease_state") == "known", F.col("_product")))


def _signed(protein: bool, harmful: bool):
    """A molecule acts on a target as, or against, the disease does.

    Signs, causal support and known contexts are facts of one premise and worked out
    before the join.  Paths that a sign rejects are counted by a join of those facts
    alone; whole premises meet only where their signs fit.
    """

    def build(r):
        kind = "protein" if protein else "gene"
        # dealt by target as they are read, before fields become lists and facts: the join needs it, and a source of few blocks is not the work of few tasks
        dealt = lambda role, relation, key: Paths.of(role, r[relation].where(F.col(key).isNotNull()).repartition(key))
        a, b = dealt("a", f"molecule_targets_{kind}", "y_id"), dealt("b", f"disease_associated_{kind}", "x_id")
        action, disease = _action_facts(Paths(a.df.withColumn("_target", F.col("a.y_id")), a.fields), "a"), _disease_facts(Paths(b.df.withColumn("_target", F.col("b.x_id")), b.fields), "b")
        acts = F.when(F.col("_action_state") == "conflicting", "conflicting").when(F.col("_action_sign").isNull(), "missing").otherwise("signed")
        left = action.select("a", "_target", acts.alias("_a_class"), F.col("_action_sign").alias("_a_sign"), *[c.alias(n) for n, c in _facts(a, "a").items()])
        known = F.when((F.col("_disease_state") == "conflicting") | (F.col("_causal_state") == "conflicting"), "conflicting").when(F.col("_disease_sign").isNull() | (F.col("_causal_state") != "known"), "missing")
        known = known.when(~F.col("_causal").isin(*CAUSAL), "noncausal").otherwise("signed")
        right = disease.select("b", "_target", known.alias("_b_class"), F.col("_disease_sign").alias("_b_sign"), "_causal", *[c.alias(n) for n, c in _facts(b, "b").items()])
        either = lambda what: (F.col("_a_class") == what) | (F.col("_b_class") == what)
        wanted = 1 if harmful else -1
        reason = F.when(either("conflicting"), "conflicting_sign").when(either("missing"), "missing_sign_or_causal_support").when(either("noncausal"), "noncausal_support")
        reason = reason.when(F.col("_a_sign") * F.col("_b_sign") != wanted, "nonharmful_sign_product" if harmful else "nontherapeutic_sign_product")
        by_sign = left.select("_target", "_a_class", "_a_sign").join(right.select("_target", "_b_class", "_b_sign"), "_target").select(reason.alias("reason")).where("reason IS NOT NULL")
        # one rule over both sides: a rule over one would be worked out, with all it rests on, once more as the source is read
        used = lambda df, role: df.withColumn("_use_" + role, F.when(F.col(f"_{role}_class") == "signed", F.coalesce(f"_{role}_sign", F.lit(0))).otherwise(0))
        good = used(left, "a").join(used(right, "b"), "_target").where(F.col("_use_a") * F.col("_use_b") == wanted)
        compatible, shared = _fits(good.columns, "a", "b")
        p = Paths(good, a.fields | b.fields, [by_sign]).decide((~compatible, "context_mismatch"), (~shared, "missing_shared_context"))
        return p, p.rows("a.x_id", "b.y_id", ("a", "b"), causal_support=F.col("_causal"), sign_product=F.lit(wanted))

    return build


def _allelic(r):
    p = Paths.of("a", r["molecule_targets_gene"]).join("b", r["mutation_associated_gene"], "a.y_id", "y_id").join("c", r["mutation_associated_disease"], "b.x_id", "x_id")
    signs = [p.sign("a", "action_direction", "target_modulation", "action_type"), p.sign("b", "functional_mechanism", "effect_direction"), p.sign("c", "effect_direction", "association_direction")]
    weak = F.arrays_overlap(p.values("b", "attribution_mode", "functional_support"), F.array(*map(F.lit, WEAK_ATTRIBUTION)))
    unsure = reduce(lambda a, b: a | b, [s != "known" for s, _ in signs])
    product = reduce(lambda a, b: a * b, [v for _, v in signs])
    p = p.decide((weak, "containment_or_weak_attribution"), (unsure, "missing_or_conflicting_sign"), (~p.compatible(("a", "b", "c")), "context_mismatch"), (product >= 0, "nontherapeutic_sign_product"))
    return p, p.rows("a.x_id", "c.y_id", ("a", "b", "c"))


def _efficacy(r):
    p = Paths.of("a", r["mutation_associated_disease"]).join("b", r["mutation_affects_molecule_response"], "a.x_id", "x_id")
    parts = [("response_category", "pgx_category"), ("response_direction", "direction"), ("disease_context",)]
    states, (category, direction, disease) = [p.state("b", *f) for f in parts], [p.known("b", *f) for f in parts]
    conflict = reduce(lambda a, b: a | b, [s == "conflicting" for s in states])
    p = p.decide(
        (conflict, "conflicting_direction_or_context"), (F.coalesce(category, F.lit("")) != "efficacy", F.coalesce(category, F.lit("missing_category"))), (~F.coalesce(direction, F.lit("")).isin(*BENEFIT), F.coalesce(direction, F.lit("missing_direction"))),
        (~F.coalesce(disease == F.lower("a.y_id"), F.lit(False)), "missing_or_mismatched_disease_context"), (~p.compatible(("a", "b")), "context_mismatch"),
    )
    return p, p.rows("b.y_id", "a.y_id", ("a", "b"))


@dataclass(frozen=True)
class Template:
    target: str
    epistemic_class: str
    build: Callable
    #: One row for each candidate without making its paths, or None where that cannot be.
    folded: Callable | None = None


OBVIOUS, WEAK, VIEW = "inferred_obvious", "inferred_weak", "coherence_only"
#: Names of the templates, what they infer, and how sure that is.
TEMPLATES = {
    "mutation_transcript_gene_attribution_v2": Template("mutation_associated_gene", OBVIOUS, _transcript_gene),
    "mutation_protein_gene_attribution_v2": Template("mutation_associated_gene", OBVIOUS, _through_mapping("mutation_causes_protein_change", "y")),
    "mutation_disease_phenotype_candidate_v2": Template("mutation_associated_phenotype", WEAK, _two_hop("mutation_associated_disease", "disease_has_phenotype", None)),
    "mutation_disease_phenotype_triangle_v2": Template("mutation_disease_phenotype_coherence", VIEW, _two_hop("mutation_associated_disease", "disease_has_phenotype", "mutation_associated_phenotype")),
    "cell_type_tissue_gene_existential_v2": Template("tissue_expresses_gene", OBVIOUS, _cell_type_tissue),
    "mutation_protein_disease_candidate_v2": Template("disease_associated_protein", WEAK, _variant("mutation_associated_disease", False)),
    "mutation_protein_gene_disease_candidate_v2": Template("disease_associated_gene", WEAK, _variant("mutation_associated_disease", True)),
    "mutation_protein_gene_phenotype_candidate_v2": Template("gene_associated_phenotype", WEAK, _variant("mutation_associated_phenotype", True)),
    "tissue_protein_to_gene_expression_v2": Template("tissue_expresses_gene", OBVIOUS, _through_mapping("tissue_expresses_protein", "y")),
    "cell_type_protein_to_gene_expression_v2": Template("cell_type_expresses_gene", OBVIOUS, _through_mapping("cell_type_expresses_protein", "y")),
    "cell_line_protein_to_gene_expression_v2": Template("cell_line_expresses_gene", OBVIOUS, _through_mapping("cell_line_expresses_protein", "y")),
    "protein_disease_to_gene_disease_v2": Template("disease_associated_gene", OBVIOUS, _through_mapping("disease_associated_protein", "x", "x_id", False)),
    "gene_disease_to_protein_disease_strict_v2": Template("disease_associated_protein", WEAK, _gene_to_protein),
    "pathway_associated_member_feature_v2": Template("pathway_associated_member", VIEW, _pathway_member("pathway_contains_gene", "disease_associated_gene"), _folded_members("pathway_contains_gene", "disease_associated_gene")),
    "pathway_associated_protein_member_feature_v2": Template("pathway_associated_member", VIEW, _pathway_member("pathway_contains_protein", "disease_associated_protein"), _folded_members("pathway_contains_protein", "disease_associated_protein")),
    "pathway_disease_candidate_v2": Template("disease_involves_pathway", WEAK, _pathway_disease, _pathway_disease_pairs),
    "disease_phenotype_tissue_localization_v2": Template("phenotype_observed_in_tissue", WEAK, _same_disease(None)),
    "disease_phenotype_tissue_triangle_v2": Template("disease_phenotype_tissue_coherence", VIEW, _same_disease("phenotype_observed_in_tissue")),
    "signed_gene_target_treatment_v2": Template("molecule_treats_disease", WEAK, _signed(False, False)),
    "signed_protein_target_treatment_v2": Template("molecule_treats_disease", WEAK, _signed(True, False)),
    "signed_gene_target_contraindication_v2": Template("molecule_contraindicates_disease", WEAK, _signed(False, True)),
    "signed_protein_target_contraindication_v2": Template("molecule_contraindicates_disease", WEAK, _signed(True, True)),
    "allelic_triangulation_treatment_v2": Template("molecule_treats_disease", WEAK, _allelic),
    "pharmacogenomic_efficacy_treatment_v2": Template("molecule_treats_disease", WEAK, _efficacy),
}


def _hashed(name: str, rows: DataFrame) -> DataFrame:
    return rows.withColumn("derivation_hash", F.sha2(F.concat_ws("|", F.lit(name), "x_id", "y_id", F.concat_ws(";", "supports"), F.concat_ws(";", "evidence")), 256))


def paths_of(name: str, relations: dict[str, DataFrame], **options) -> tuple[DataFrame, DataFrame]:
    """All paths of a template with their derivation hash, and one row for each rejected path with its reason."""
    found, rows = TEMPLATES[name].build(relations, **options)
    rows = _hashed(name, rows)
    rejects = reduce(DataFrame.unionAll, found.rejects) if found.rejects else rows.select(F.lit("").alias("reason")).limit(0)
    return rows, rejects


def candidates(name: str, relations: dict[str, DataFrame], **options) -> DataFrame:
    """One row for each pair (of a derived view: each pair, member and anchor): the path of the smallest hash, and how many there are."""
    identity, t = ["x_id", "y_id", "member_id", "anchor_id"], TEMPLATES[name]
    what = [F.lit(t.target).alias("relation"), F.lit(name).alias("inference_template_id"), F.lit(t.epistemic_class).alias("epistemic_class")]
    if t.folded and (found := t.folded(relations, **options)) is not None:
        found = _hashed(name, found)
        rest = [c for c in found.columns if c not in (*identity, "support_multiplicity")]
        return found.select(*identity, *rest, "support_multiplicity", F.array_repeat("derivation_hash", F.col("support_multiplicity").cast("int")).alias("derivation_hashes"), *what)
    rows, _ = paths_of(name, relations, **options)
    rest = [c for c in rows.columns if c not in identity]
    # one aggregate a column, so that columns nobody reads are neither made nor shuffled
    first = [(F.min(c) if c == "derivation_hash" else F.min_by(c, "derivation_hash")).alias(c) for c in rest]
    kept = rows.groupBy(*identity).agg(*first, F.count("*").alias("support_multiplicity"), F.array_sort(F.collect_list("derivation_hash")).alias("derivation_hashes"))
    return kept.select(*identity, *rest, "support_multiplicity", "derivation_hashes", *what)


def bounded(rows: DataFrame, most: int) -> tuple[DataFrame, DataFrame]:
    """At most `most` paths, those of the smallest hashes, and how many were over the bound."""
    over = rows.agg(F.greatest(F.count("*") - most, F.lit(0)).alias("n")).select(F.lit("max_paths_bound").alias("reason"), "n")
    return rows.orderBy("derivation_hash").limit(most), over


def unobserved(found: DataFrame, observed: DataFrame | None, staged: DataFrame | None) -> tuple[DataFrame, DataFrame]:
    """Candidates whose pair is neither observed nor staged, and the reasons of the others.

    Without an inventory of observed pairs nothing can be called new: all are rejected.
    """
    if observed is None:
        return found.limit(0), found.select(F.lit("canonical_target_inventory_missing").alias("reason"))
    mark = lambda df, name: df.select("x_id", "y_id", F.lit(True).alias(name)).distinct()
    joined = found.join(mark(observed, "_seen"), ["x_id", "y_id"], "left")
    joined = joined.join(mark(staged, "_staged"), ["x_id", "y_id"], "left") if staged is not None else joined.withColumn("_staged", F.lit(None).cast("boolean"))
    reason = F.when(F.col("_seen"), "canonical_observed_overlap").when(F.col("_staged"), "staged_source_native_overlap")
    return joined.where(reason.isNull()).select(found.columns), joined.where(reason.isNotNull()).select(reason.alias("reason"))

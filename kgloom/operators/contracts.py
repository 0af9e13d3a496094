"""Contracts of tables: counters of what breaks them, and joins and merges that builders share."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.schema import RELATIONS
from .graph_ml import places

#: Letters of sequences by alphabet; feature-context tables by their ends; evidence types that claim no cause.
ALPHABETS = {"dna_iupac": "ACGTRYSWKMBDHVN", "rna_iupac": "ACGURYSWKMBDHVN", "protein_iupac": "ABCDEFGHIJKLMNOPQRSTUVWXYZ*"}
CONTEXT_ENDS = {
    "gene_gene_expression_correlation": ("gene", "gene"), "rna_gene_expression_correlation": ("transcript", "gene"), "gene_disease_association_score": ("gene", "disease"),
    "molecule_disease_association_score": ("molecule", "disease"), "cell_line_gene_expression_feature": ("cell_line", "gene"),
}
NON_CAUSAL = ("correlative", "non_causal", "predictive", "association_score", "candidate_context")
CAUSAL_TYPES = ("causal", "mechanistic", "regulatory", "physical_interaction", "ppi", "direct_binding", "direct_regulation")


def counts(df: DataFrame, **conditions: Column) -> DataFrame:
    return df.agg(F.count("*").alias("n_rows"), *[F.count_if(F.coalesce(c, F.lit(False))).alias(n) for n, c in conditions.items()])


def _joined(*frames: DataFrame) -> DataFrame:
    """One-row frames side by side."""
    keyed = [f.withColumn("_one", F.lit(1)) for f in frames]
    return reduce(lambda a, b: a.join(F.broadcast(b), "_one"), keyed).drop("_one")


def membership(df: DataFrame, id_col: str, nodes: DataFrame) -> DataFrame:
    """Distinct ids, those that no node has, and the share of nodes that are covered."""
    own = df.select(F.col(id_col).alias("id")).distinct().withColumn("own", F.lit(1))
    both = nodes.select("id").distinct().withColumn("node", F.lit(1)).join(own, "id", "full")
    agg = both.agg(F.count("own").alias("unique_nodes"), F.count_if(F.col("node").isNull()).alias("nodes_not_in_endpoint"), F.count("node").alias("endpoint_nodes"), F.count_if(F.col("node").isNotNull() & F.col("own").isNotNull()).alias("_hit"))
    return agg.select("unique_nodes", "nodes_not_in_endpoint", "endpoint_nodes", F.round(F.try_divide(F.col("_hit"), F.col("endpoint_nodes")), 6).alias("coverage"))


def relation_artifacts(edges: DataFrame, evidence: DataFrame, x_nodes: DataFrame, y_nodes: DataFrame) -> DataFrame:
    """Eight counters over the edges and evidence of a relation."""
    key = ["relation", "x_id", "y_id"]
    anything = lambda cs: reduce(lambda a, b: a | b, [F.col(c).isNull() for c in cs])
    e, v = edges.select(key).distinct(), evidence.select(key).distinct()
    one = lambda df, name: df.agg(F.count("*").alias(name))
    return _joined(
        edges.agg((F.count("*") - F.count_distinct(F.struct(*key))).alias("duplicate_edge_identities"), F.count_if(anything([*key, "x_type", "y_type", "source", "credibility"])).alias("null_edge_identity_rows")),
        evidence.agg((F.count("*") - F.count_distinct(F.struct("edge_key", "source_record_id"))).alias("duplicate_evidence_identities"), F.count_if(anything([*key, "edge_key", "x_type", "y_type", "source", "source_record_id"])).alias("null_evidence_identity_rows")),
        one(e.subtract(v), "edges_without_evidence"), one(v.subtract(e), "evidence_without_edge"),
        one(edges.join(x_nodes.select(F.col("id").alias("x_id")), "x_id", "left_anti"), "missing_x_endpoints"), one(edges.join(y_nodes.select(F.col("id").alias("y_id")), "y_id", "left_anti"), "missing_y_endpoints"),
    )


def registry_coverage(present: DataFrame) -> DataFrame:
    """Every registered relation with the rows that a table (name, n_rows) of it has, or that it is missing."""
    spark = present.sparkSession
    known = spark.createDataFrame([(r.name, r.source, r.target) for r in RELATIONS.values()], "name string, x_type string, y_type string")
    return F.broadcast(known).join(present, "name", "left").select("name", "x_type", "y_type", F.coalesce("n_rows", F.lit(0)).alias("n_rows"), F.col("n_rows").isNull().alias("missing"))


def evidence_contract(df: DataFrame, name: str) -> DataFrame:
    """Rows of other relations or with ends of other types, blank required texts, keys that don't fit their parts."""
    spec = RELATIONS[name]
    blank = lambda c: F.coalesce(F.trim(c), F.lit("")) == ""
    return counts(
        df, other_relation=F.col("relation") != name, other_x_type=F.col("x_type") != spec.source, other_y_type=F.col("y_type") != spec.target, blank_source=blank("source") | blank("source_dataset") | blank("source_record_id"),
        wrong_key=F.col("edge_key") != F.concat_ws("|", "relation", "x_id", "y_id"),
    )


def missing_types(edges: DataFrame, nodes: DataFrame, strict: bool = True) -> DataFrame:
    """End types of edges that no node table has, with the edges concerned; `strict`: that is an error."""
    ends = edges.select("relation", F.explode(F.array("x_type", "y_type")).alias("node_type"))
    lost = ends.join(nodes.select("node_type").distinct(), "node_type", "left_anti").groupBy("relation", "node_type").agg(F.count("*").alias("n_ends"))
    if strict and (bad := [r.node_type for r in lost.select("node_type").distinct().orderBy("node_type").limit(20).collect()]):  # 20 types at most
        raise ValueError(f"no nodes of type {bad}")
    return lost


def issues(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Errors and warnings of a graph export: repeated ids, absent ends, self loops."""
    ids = nodes.groupBy("node_type", "id").count().where("count > 1").groupBy("node_type").agg(F.sum("count").alias("n")).select(F.lit("error").alias("severity"), F.concat("node_type", F.lit(".ids_unique")).alias("check"), "n")
    known = nodes.select("node_type", "id").distinct()
    lost = None
    for s in "xy":
        end = known.select(F.col("node_type").alias(f"{s}_type"), F.col("id").alias(f"{s}_id"))
        one = edges.join(end, [f"{s}_type", f"{s}_id"], "left_anti").groupBy("relation").agg(F.count("*").alias("n")).select(F.lit("error").alias("severity"), F.concat("relation", F.lit(f".{s}_endpoint_in_node_map")).alias("check"), "n")
        lost = one if lost is None else lost.unionAll(one)
    loops = edges.where("x_id = y_id").groupBy("relation").agg(F.count("*").alias("n")).select(F.lit("warning").alias("severity"), F.concat("relation", F.lit(".self_loops")).alias("check"), "n")
    return ids.unionAll(lost).unionAll(loops)


def sequence_rows(df: DataFrame, alphabet: str, kind: str, longest: int) -> DataFrame:
    """Sequences without white space, in upper case, with length, checksum and key; of a repeated key one row."""
    clean = df.withColumn("sequence", F.upper(F.regexp_replace(F.coalesce("sequence", F.lit("")), r"\s+", "")))
    keyed = clean.withColumns({"length": F.length("sequence").cast("long"), "checksum_sha256": F.sha2("sequence", 256), "feature_key": F.concat_ws("|", "feature_table", "node_id", "source", "source_record_id", "sequence_kind")})
    rows = keyed.groupBy("feature_key").agg(F.max(F.struct("node_id", "sequence_kind", "sequence", "length", "checksum_sha256")).alias("r"), F.count("*").alias("copies")).select("feature_key", "r.*", "copies")
    return rows.withColumns({"bad_alphabet": ~F.col("sequence").rlike(f"^[{ALPHABETS[alphabet]}]*$"), "bad_kind": F.col("sequence_kind") != kind, "too_long": F.col("length") > longest, "empty": F.col("length") == 0})


def sequence_report(rows: DataFrame, nodes: DataFrame) -> DataFrame:
    flags = {c: F.col(c) for c in ("bad_alphabet", "bad_kind", "too_long", "empty")}
    stats = rows.agg(F.sum(F.col("copies") - 1).alias("duplicates"), F.min("length").alias("min_length"), F.max("length").alias("max_length"))
    return _joined(counts(rows, **flags), stats, membership(rows, "node_id", nodes))


def interval_report(df: DataFrame, nodes: DataFrame) -> DataFrame:
    """Closed intervals from 1, with a strand of +, - or none."""
    bad = (F.col("start") < 1) | (F.col("end") < F.col("start"))
    length = F.col("end") - F.col("start") + 1
    return _joined(counts(df, bad_coordinates=bad, bad_strand=~F.coalesce(F.col("strand").isin("+", "-", "."), F.lit(False))), df.agg(F.min(length).cast("long").alias("min_length"), F.max(length).cast("long").alias("max_length")), membership(df, "node_id", nodes))


def summary_report(df: DataFrame, longest: int, nodes: DataFrame) -> DataFrame:
    text = F.trim(F.coalesce("text", F.lit("")))
    return _joined(counts(df, empty=text == "", too_long=F.length(text) > longest), membership(df, "node_id", nodes))


def fingerprint_checksum(bits: Column, kind: str, radius: int, n_bits: int) -> Column:
    """SHA-256 of a fingerprint's canonical JSON."""
    head = f'{{"fingerprint_format":"sparse_on_bits_uint16_list","fingerprint_kind":"{kind}","n_bits":{n_bits},"on_bits":['
    tail = f'],"radius":{radius},"use_bond_types":true,"use_chirality":false}}'
    return F.sha2(F.concat(F.lit(head), F.array_join(F.transform(F.array_sort(bits), lambda b: b.cast("string")), ","), F.lit(tail)), 256)


def fingerprint_report(df: DataFrame, kind: str, radius: int, n_bits: int) -> DataFrame:
    b = F.col("on_bits")
    return counts(
        df, empty=F.size(b) <= 0, unsorted=b != F.array_sort(F.array_distinct(b)), out_of_range=F.exists(b, lambda x: (x < 0) | (x >= n_bits)), wrong_checksum=F.col("checksum") != fingerprint_checksum(b, kind, radius, n_bits)
    )


def context_report(df: DataFrame, table: str) -> DataFrame:
    """Feature-context rows: ends of the table's types, and evidence that claims no cause."""
    if table not in CONTEXT_ENDS:
        raise ValueError(f"unknown feature-context table {table!r}")
    x, y = CONTEXT_ENDS[table]
    kind = F.lower("evidence_type")
    return counts(df, other_table=F.col("feature_table") != table, other_x_type=F.col("x_type") != x, other_y_type=F.col("y_type") != y, causal=kind.isin(*CAUSAL_TYPES), unsupported=~kind.isin(*CAUSAL_TYPES, *NON_CAUSAL))


def vector_report(df: DataFrame, dim: int, nodes: DataFrame) -> DataFrame:
    """Vectors of one model: size, numbers, zeros, repeated keys, coverage of nodes."""
    v = F.transform("vector", lambda x: x.cast("double"))
    repeated = df.groupBy("node_id").count().agg(F.sum(F.col("count") - 1).alias("duplicates"))
    return _joined(
        counts(df, wrong_dim=F.size("vector") != dim, not_finite=F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))), all_zero=F.forall(v, lambda x: x == 0), no_model=F.coalesce("model", F.lit("")) == ""), repeated, membership(df, "node_id", nodes)
    )


def vector_inventory(df: DataFrame) -> DataFrame:
    """Rows, sizes and models of vectors by node type."""
    return df.groupBy("node_type", "model").agg(F.count("*").alias("n_rows"), F.min(F.size("vector")).alias("min_dim"), F.max(F.size("vector")).alias("max_dim"))


def pooled(df: DataFrame, key: str, weight: Column | None = None) -> DataFrame:
    """Weighted mean of the vectors of each key, of length 1 (all zero stays); plain mean without weights."""
    w = F.lit(1.0) if weight is None else weight.cast("double")
    long = df.select(key, w.alias("_w"), F.posexplode("vector").alias("dim", "value"))
    mean = long.groupBy(key, "dim").agg(F.try_divide(F.sum(F.col("_w") * F.col("value").cast("double")), F.sum("_w")).alias("value"))
    whole = mean.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("dim", "value"))).alias("cells"))  # as long as a vector
    values = F.transform("cells", lambda c: F.coalesce(c["value"], F.lit(0.0)))
    norm = F.sqrt(F.aggregate(values, F.lit(0.0), lambda s, x: s + x * x))
    return whole.select(key, F.transform(values, lambda x: x / F.when(norm > 0, norm).otherwise(1.0)).alias("vector"))


def ordered_digest(df: DataFrame, group: str, order: list[str], value: str, block: int = 1000) -> DataFrame:
    """SHA-256 over the values of each group in order: of blocks of rows first, then of the blocks' digests."""
    own = df.select(group, *[c for c in order if c != group], F.col(value).cast("string").alias("v"))
    rows = places(own, group, order).select(group, "place", "v").withColumn("block", F.floor(F.col("place") / block))
    text = lambda p, v: F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(p, v))), lambda x: x[v]), "\n")
    blocks = rows.groupBy(group, "block").agg(F.sha2(text("place", "v"), 256).alias("h"))
    return blocks.groupBy(group).agg(F.sha2(text("block", "h"), 256).alias("digest"))


def except_both(a: DataFrame, b: DataFrame) -> DataFrame:
    """Distinct rows only in one of two tables of the same columns."""
    side = lambda df, n: df.select(F.lit(n).alias("only_in"), *df.columns)
    return side(a.subtract(b), "a").unionAll(side(b.subtract(a), "b"))


def mirror_pairs(edges: DataFrame) -> DataFrame:
    """Pairs that occur in both directions."""
    pair = edges.where("x_id <> y_id").select(F.least("x_id", "y_id").alias("a"), F.greatest("x_id", "y_id").alias("b"), "x_id").distinct()
    return pair.groupBy("a", "b").agg(F.count("*").alias("n")).where("n = 2").select("a", "b")


def overridden(base: DataFrame, over: DataFrame, key: list[str]) -> DataFrame:
    """All rows of both, those of `over` in the place of base rows with their key."""
    return base.join(over.select(key).distinct(), key, "left_anti").unionByName(over)


def first_of(df: DataFrame, keys: list[str], order: list[str], n: int = 1) -> DataFrame:
    """The first n rows of each key."""
    return df.withColumn("_n", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col("_n") <= n).drop("_n")


def conflicts(df: DataFrame, assertion: str, payload: list[str]) -> DataFrame:
    """Rows with a flag: has their assertion several payloads?"""
    told = df.groupBy(assertion).agg((F.count_distinct(F.struct(*payload)) > 1).alias("conflict"))
    return df.join(told, assertion)


def causal_status(values: Column, conflicting: Column | None = None) -> Column:
    """unknown, single, consensus or conflicting, of the list of an edge's values (one for each assertion)."""
    known = F.filter(values, lambda v: v.isNotNull() & (v != "") & (v != "unknown"))
    clash = F.size(F.array_distinct(known)) > 1
    clash = clash if conflicting is None else clash | conflicting
    return F.when(F.size(known) == 0, "unknown").when(clash, "conflicting").when(F.size(known) == 1, "single").otherwise("consensus")


def token_resolver(nodes: DataFrame, columns: list[str]) -> DataFrame:
    """token -> id over several columns, the first column that has the token; the smallest id among equals."""
    pairs = [F.struct(F.lit(k).alias("order"), F.lower(F.trim(F.col(c).cast("string"))).alias("token")) for k, c in enumerate(columns)]
    long = nodes.select("id", F.explode(F.array(*pairs)).alias("p")).select("id", "p.*").where("token <> ''")
    return long.groupBy("token").agg(F.min(F.struct("order", "id")).alias("m")).select("token", F.col("m.id").alias("id"), F.col("m.order").alias("order"))


def paired(edges: DataFrame, evidence: DataFrame, key: list[str], n: int) -> DataFrame:
    """Edges with at most n of their evidence rows; edges of one key are an error."""
    if not edges.groupBy(*key).count().where("count > 1").isEmpty():
        raise ValueError(f"{key} is no key of the edges")
    return edges.join(first_of(evidence, key, ["record_id"], n), key, "left")

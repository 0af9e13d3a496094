"""Builders of relations from single sources: map the ends, accept or reject with a reason, keep evidence beside the edges."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.ids import clean, first_reason
from .edges import resolver_classes
from .graph_ml import dense_index


def migrated(triples: DataFrame, ids: DataFrame, relations: DataFrame, flipped: list[str]) -> tuple[DataFrame, DataFrame]:
    """Legacy triples under new ids (node_index, id, node_type) and relation names (old, new); flipped relations swap ends.

    Also the old relations without a new name, with their rows.
    """
    named = triples.join(relations, triples["relation"] == relations["old"], "left").drop("old")
    end = lambda s: ids.select(F.col("node_index").alias(f"{s}_index"), F.struct("id", "node_type").alias(s))
    rows = named.where("new IS NOT NULL").join(end("x"), "x_index").join(end("y"), "y_index")
    swap = F.col("relation").isin(flipped)
    a, b = F.when(swap, F.col("y")).otherwise(F.col("x")), F.when(swap, F.col("x")).otherwise(F.col("y"))
    edges = rows.select(a["id"].alias("x_id"), a["node_type"].alias("x_type"), b["id"].alias("y_id"), b["node_type"].alias("y_type"), F.col("new").alias("relation")).distinct()
    return edges, named.where("new IS NULL").groupBy("relation").agg(F.count("*").alias("n"))


def split_measurements(mixed: DataFrame) -> dict[str, DataFrame]:
    """One table of measurements as two relations: expression only where it is measured, dependency where either of its values is."""
    there = lambda c: F.col(c).isNotNull() & ~F.isnan(F.col(c).cast("double"))
    rows = {"cell_line_expresses_gene": mixed.where(there("expression")), "cell_line_gene_essentiality": mixed.where(there("gene_effect") | F.col("is_essential").isNotNull())}
    return {r: df.select("x_id", "y_id", F.lit(r).alias("relation"), "source_record_id").distinct() for r, df in rows.items()}


def hp_id(c: Column) -> Column:
    """HP:1 of HP_1 or HP:1; null for anything else."""
    found = F.regexp_extract(F.trim(c), r"^HP[_:]([0-9]+)$", 1)
    return F.when(found != "", F.concat(F.lit("HP:"), found))


def variant_phenotypes(df: DataFrame, mutations: DataFrame, phenotypes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Variants and their phenotypes where both are known, and one evidence row for each paper (one without, where there is none)."""
    rows = df.select(clean(F.col("variant")).alias("x_id"), hp_id(F.col("phenotype")).alias("y_id"), "literature").where("x_id IS NOT NULL AND y_id IS NOT NULL")
    known = rows.join(mutations.select(F.col("id").alias("x_id")), "x_id", "left_semi").join(phenotypes.select(F.col("id").alias("y_id")), "y_id", "left_semi")
    papers = known.select("x_id", "y_id", F.explode_outer("literature").alias("p")).select("x_id", "y_id", F.coalesce(F.concat(F.lit("PMID:"), F.regexp_extract("p", "([0-9]+)$", 1)), F.lit("")).alias("paper_id")).distinct()
    return known.select("x_id", "y_id").distinct(), papers


def located(df: DataFrame, places: DataFrame, proteins: DataFrame) -> DataFrame:
    """Proteins in components: every label (split at , and ;) of every accession; the highest credibility of a pair.

    A label without a known place gets a local id.
    """
    label = F.explode(F.split("labels", r"[,;]"))
    rows = df.select("accession", label.alias("label"), "credibility").withColumn("label", F.trim("label")).where("label <> ''")
    slug = F.regexp_replace(F.lower("label"), r"[^a-z0-9]+", "-")
    named = rows.join(places, F.lower("label") == places["place"], "left").withColumn("y_id", F.coalesce("place_id", F.concat(F.lit("local:"), slug)))
    return named.join(proteins, "accession").groupBy(F.col("protein").alias("x_id"), "y_id").agg(F.max("credibility").alias("credibility"))


def paralogs(df: DataFrame, genes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Pairs of paralogous known genes in canonical order, and how many rows were rejected for what."""
    known = genes.select(F.col("id"), F.lit(True).alias("known"))
    rows = df.select(F.col("id").alias("a"), F.explode("homologues").alias("h")).select("a", F.col("h.kind").alias("kind"), F.col("h.target").alias("b"))
    rows = rows.join(known.select(F.col("id").alias("a"), F.col("known").alias("has_a")), "a", "left").join(known.select(F.col("id").alias("b"), F.col("known").alias("has_b")), "b", "left")
    why = first_reason((~F.coalesce(F.col("kind").contains("paralog"), F.lit(False)), "not_a_paralog"), (F.coalesce("b", F.lit("")) == "", "missing_target"), (F.col("a") == F.col("b"), "self_pair"), (F.col("has_a").isNull() | F.col("has_b").isNull(), "unknown_endpoint"))
    marked = rows.withColumn("reason", why)
    pairs = marked.where("reason IS NULL").select(F.least("a", "b").alias("x_id"), F.greatest("a", "b").alias("y_id")).distinct()
    return pairs, marked.where("reason IS NOT NULL").groupBy("reason").agg(F.count("*").alias("n"))


def prefixed_columns(df: DataFrame, key: str, prefix: str, word: str) -> DataFrame:
    """Columns with a prefix as rows: how many of a key's values hold a word, and how many there are."""
    columns = [c for c in df.columns if c.startswith(prefix)]
    long = df.select(key, *[F.col(c).cast("string").alias(c) for c in columns]).unpivot([key], columns, "column", "value").where("trim(value) <> ''")
    return long.groupBy(key, F.substring("column", len(prefix) + 1, 1000).alias("name")).agg(F.count("*").alias("n_values"), F.count_if(F.lower("value").contains(word)).alias("n_with_word"))


def strict_pairs(df: DataFrame, a: str, b: str) -> DataFrame:
    """Aliases that stand for one thing on both sides."""
    pairs = df.where(F.col(a).isNotNull() & F.col(b).isNotNull()).select(a, b).distinct()
    only = lambda c: pairs.groupBy(c).count().where("count = 1").select(c)
    return pairs.join(only(a), a, "left_semi").join(only(b), b, "left_semi").select(a, b)


def mapped_targets(df: DataFrame, aliases: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Molecules and the proteins that a component's accession names without doubt; the others by reason."""
    classes = resolver_classes(aliases).select(F.col("alias").alias("accession"), "kind", "first_id")
    rows = df.select("molecule", F.explode("components").alias("accession")).join(classes, "accession", "left")
    why = first_reason((F.col("kind").isNull(), "unmapped"), (F.col("kind") == "ambiguous", "ambiguous"))
    marked = rows.withColumn("reason", why)
    return marked.where("reason IS NULL").select(F.col("molecule").alias("x_id"), F.col("first_id").alias("y_id")).distinct(), marked.where("reason IS NOT NULL").groupBy("reason").agg(F.count_distinct("accession").alias("n"))


def conditions(df: DataFrame, by: list[str], least: int) -> DataFrame:
    """Cells of each condition, null values included, and why a condition is no candidate (all reasons)."""
    counted = df.groupBy(*by).agg(F.count("*").alias("n_cells"))
    reasons = F.array_compact(F.array(*[F.when(F.col(c).isNull(), f"missing_{c}") for c in by], F.when(F.col("n_cells") < least, "too_few_cells")))
    return counted.withColumn("reasons", F.array_join(reasons, ";"))


def additions(found: DataFrame, have: DataFrame, key: str) -> DataFrame:
    """Only rows that a table has not, indexed after its last index by key."""
    new = found.join(have.select(key), key, "left_anti").select(key).distinct()
    last = have.agg(F.coalesce(F.max("node_index"), F.lit(-1)).alias("last")).withColumn("one", F.lit(1))  # one row
    placed = dense_index(new.select(F.lit("new").alias("node_type"), F.col(key).alias("id"))).select(F.col("id").alias(key), "node_index", F.lit(1).alias("one"))
    return placed.join(F.broadcast(last), "one").select(key, (F.col("node_index") + F.col("last") + 1).alias("node_index"))


def projected(expression: DataFrame, mapping: DataFrame, most: int) -> DataFrame:
    """Gene expression as expression of the genes' proteins; more rows than `most` are an error before any is made."""
    sizes = mapping.groupBy("gene").agg(F.count("*").alias("n"))
    rows = expression.join(sizes, "gene").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    if rows > most:
        raise ValueError(f"the projection has {rows} rows, more than {most}")
    return expression.join(mapping, "gene")


def backfilled(edges: DataFrame, dataset: Column) -> DataFrame:
    """An evidence row for each edge that has none, from what the edge says of its source (`A/B` is source and dataset)."""
    part = lambda k: F.split_part("source", F.lit("/"), F.lit(k))
    return edges.select(
        F.concat_ws("|", "relation", "x_id", "y_id").alias("edge_key"), "relation", "x_id", "y_id", F.lit("database_record").alias("evidence_type"), part(1).alias("source"), F.coalesce(F.nullif(part(2), F.lit("")), dataset).alias("source_dataset"),
        F.sha2(F.concat_ws("|", "relation", "x_id", "y_id", "source"), 256).alias("source_record_id"),
    ).distinct()

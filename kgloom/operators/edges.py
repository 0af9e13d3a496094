"""Edge maintenance: dedup with credibility, evidence, remap, audits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

KEY = ("x_id", "y_id", "relation")


def ordered_distinct(value: str, pos: str, sep: str = ",") -> Column:
    """Distinct values in first-seen order, as one text."""
    rows = F.array_sort(F.collect_list(F.struct(pos, value)))
    return F.array_join(F.array_distinct(F.transform(rows, lambda r: r[value])), sep)


EVIDENCE_COLUMNS = ("paper_id", "author_group_key", "raw_score", "datatype")
#: Sources whose edges are established, and datatypes whose score counts.
CURATED_SOURCES = ("drugbank", "chembl_indication", "chembl_moa", "reactome", "go", "mondo", "hpo")
SCORED_DATATYPES = ("genetic_association", "animal_model", "known_drug", "clinical_trial")


def merge_edges(df: DataFrame, pos: str = "pos") -> DataFrame:
    """One row for each edge: its sources in first-seen order and its highest credibility."""
    firsts = df.groupBy(*KEY, "source").agg(F.min(pos).alias(pos), F.max("credibility").alias("credibility"))  # bounded lists below
    return firsts.groupBy(*KEY).agg(ordered_distinct("source", pos).alias("source"), F.max("credibility").alias("credibility"))


def dedup_edges(df: DataFrame, pos: str = "pos") -> DataFrame:
    """One row for each edge: other columns from its first row by `pos`, sources in first-seen order.

    Credibility is scored from the evidence where the table has evidence columns; without them it
    is the highest, or that of the first row where the whole table has one source.
    """
    extra = [c for c in df.columns if c not in (*KEY, "source", "credibility", pos)]
    if set(EVIDENCE_COLUMNS) & set(df.columns):
        missing = {c: F.lit(None).cast("double" if c == "raw_score" else "string") for c in EVIDENCE_COLUMNS if c not in df.columns}
        rows = _dealt((df.withColumns(missing) if missing else df).dropna(subset=list(KEY)), KEY)  # an edge without an end has none to be joined by
        scored = _scored(rows, CURATED_SOURCES, pos, extra)
        sources = rows.groupBy("_edge", "source").agg(F.min(pos).alias(pos)).groupBy("_edge").agg(ordered_distinct("source", pos).alias("source"))
        return scored.join(sources, "_edge").select(*[f"_edge.{c}" for c in KEY], *[F.col(f"f.{c}") for c in extra], "source", "credibility")
    first = df.groupBy(*KEY).agg(F.min_by(F.struct("credibility", *extra), pos).alias("f"), F.max("credibility").alias("highest"))
    sources = df.groupBy(*KEY, "source").agg(F.min(pos).alias(pos)).groupBy(*KEY).agg(ordered_distinct("source", pos).alias("source"))
    out = first.join(sources, list(KEY), "left")
    single = df.agg(F.count_distinct(F.coalesce("source", F.lit("\0"))).alias("n")).select((F.col("n") == 1).alias("single"), F.lit(1).alias("one"))
    credibility = F.when(F.col("single"), F.col("f.credibility")).otherwise(F.col("highest")).alias("credibility")
    return out.withColumn("one", F.lit(1)).join(F.broadcast(single), "one").select(*KEY, *[F.col(f"f.{c}") for c in extra], "source", credibility)  # one row


def evidence_summary(df: DataFrame) -> DataFrame:
    return df.groupBy(*KEY).agg(F.count("*").alias("n_evidence"), F.array_join(F.array_sort(F.collect_set("source")), "; ").alias("sources"), F.max("score").alias("best_score"))


def score_credibility(evidence: DataFrame, curated: tuple[str, ...] = CURATED_SOURCES, key: tuple[str, ...] = KEY, pos: str = "pos") -> DataFrame:
    """3 for a curated source; 2 for two author groups, else papers, else sources, or for a score of 0.75 of a datatype that counts; else 1.

    Of the rows of one paper the best-scored counts, the first among equals; rows
    without a paper are never merged.
    """
    return _scored(_dealt(evidence, key), curated, pos).select(*[f"_edge.{c}" for c in key], "credibility")


def _dealt(rows: DataFrame, key: tuple[str, ...]) -> DataFrame:
    """Rows dealt by _edge, once for all that is asked of an edge; a hash leads its keys, so that sorts rarely compare texts.

    Most edges have a row or two, so nothing is merged before: that would sort all rows once more.
    """
    return rows.withColumn("_edge", F.struct(F.xxhash64(*key).alias("hash"), *key)).drop(*key).repartition("_edge")


def _scored(rows: DataFrame, curated: tuple[str, ...], pos: str, extra: list[str] | None = None) -> DataFrame:
    """_edge, credibility, and `f`: the extra columns of the edge's first row.  Sorted by edge and paper, rows are merged as they pass."""
    rows = rows.withColumn("_paper", F.coalesce(F.nullif(F.trim(F.col("paper_id").cast("string")), F.lit("")), F.concat(F.lit("\0"), F.col(pos).cast("string"))))
    rank = F.struct((-F.coalesce("raw_score", F.lit(float("-inf")))).alias("s"), F.col(pos).alias("p"))
    first = [F.min_by(F.struct(*extra), pos).alias("f"), F.min(pos).alias("p")] if extra else []
    best = rows.groupBy("_edge", "_paper").agg(F.min_by(F.struct("source", "author_group_key", "raw_score", "datatype"), rank).alias("b"), F.bool_or(F.col("source").isin(*curated)).alias("curated"), *first)
    group, named = F.nullif(F.col("b.author_group_key").cast("string"), F.lit("")), ~F.startswith("_paper", F.lit("\0"))
    agg = best.groupBy("_edge").agg(
        F.bool_or("curated").alias("curated"), F.min(group).alias("group"), F.max(group).alias("group_to"), F.count_if(named).alias("papers"), F.min("b.source").alias("source"), F.max("b.source").alias("source_to"),
        F.bool_or((F.col("b.raw_score") >= 0.75) & F.col("b.datatype").isin(*SCORED_DATATYPES)).alias("strong"), *([F.min_by("f", "p").alias("f")] if extra else []),
    )
    # two of a kind: the smallest is not the largest
    spread = F.when(F.col("group").isNotNull(), F.col("group") != F.col("group_to")).when(F.col("papers") > 0, F.col("papers") > 1).otherwise(F.coalesce(F.col("source") != F.col("source_to"), F.lit(False)))
    credibility = F.when(F.col("curated"), 3).when(spread | F.col("strong"), 2).otherwise(1).cast("long").alias("credibility")
    return agg.select("_edge", credibility, *(["f"] if extra else []))


def dangling(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """Per relation: edges and edges with an absent end (counted once)."""
    known = nodes.select("id").distinct()
    x, y = known.select(F.col("id").alias("x_id"), F.lit(1).alias("has_x")), known.select(F.col("id").alias("y_id"), F.lit(1).alias("has_y"))
    joined = edges.join(x, "x_id", "left").join(y, "y_id", "left")
    return joined.groupBy("relation").agg(F.count("*").alias("n_edges"), F.count_if(F.col("has_x").isNull() | F.col("has_y").isNull()).alias("n_dangling"))


def stubs(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """Minimal nodes for the ends that no node table has."""
    ends = edges.select(F.col("x_id").alias("id"), F.col("x_type").alias("node_type")).union(edges.select("y_id", "y_type")).distinct()
    return ends.join(nodes.select("id"), "id", "left_anti")


def point_in_interval(points: DataFrame, intervals: DataFrame, key: str, width: int) -> DataFrame:
    """Points (pos) inside closed intervals (lo, hi) with the same key, by bins of `width`."""
    binned = intervals.withColumn("bin", F.explode(F.sequence(F.floor(F.col("lo") / width), F.floor(F.col("hi") / width))))
    return points.withColumn("bin", F.floor(F.col("pos") / width)).join(binned, [key, "bin"]).where("pos BETWEEN lo AND hi").drop("bin")


def remap(edges: DataFrame, mapping: DataFrame, column: str = "y_id") -> tuple[DataFrame, DataFrame]:
    """Edges with `column` mapped (old, new, status), and those without a clear target."""
    joined = edges.join(mapping.withColumnRenamed("old", column), column, "left").withColumn("status", F.coalesce("status", F.lit("unmapped")))
    return joined.where("status = 'mapped'").withColumn(column, F.col("new")).drop("new", "status"), joined.where("status <> 'mapped'").drop("new")


def collisions(remapped: DataFrame) -> DataFrame:
    """Rank within each edge, best credibility first, then source and position; rank 1 stays."""
    w = Window.partitionBy(*KEY)
    return remapped.withColumn("edge_rank", F.row_number().over(w.orderBy(F.desc_nulls_last("credibility"), F.desc("source"), "pos"))).withColumn("edge_count", F.count("*").over(w))


def composed_paths(ac: DataFrame, cb: DataFrame, rows: int = 200_000) -> DataFrame:
    """Every path a - c - b of two edge tables as an edge a - b: both relations and sources in its names, the middle in its display, the weaker credibility.

    Other columns come from the first edge, then from the second.  A middle of very
    many edges is split on both sides.
    """
    from .hot import split_join

    left = ac.select(F.col("y_id").alias("_mid"), F.struct(*ac.columns).alias("_first"))
    right = cb.select(F.col("x_id").alias("_mid"), F.struct(*cb.columns).alias("_second"))
    own = ("x_id", "x_type", "y_id", "y_type", "relation", "display_relation", "source", "credibility")
    rest = {c: F.col(f"_first.{c}") for c in ac.columns if c not in own} | {c: F.col(f"_second.{c}") for c in cb.columns if c not in (*own, *ac.columns)}
    both = lambda c: F.concat(F.lit("composed:"), F.coalesce(F.col(f"_first.{c}"), F.lit("")), F.lit("+"), F.coalesce(F.col(f"_second.{c}"), F.lit("")))
    weaker = F.least(F.coalesce("_first.credibility", F.lit(1)), F.coalesce("_second.credibility", F.lit(1)))
    return split_join(left, right, ["_mid"], rows).select(
        F.col("_first.x_id").alias("x_id"), F.col("_first.x_type").alias("x_type"), F.col("_second.y_id").alias("y_id"), F.col("_second.y_type").alias("y_type"), both("relation").alias("relation"), F.concat(F.lit("via:"), "_first.y_type", F.lit(":"), "_mid").alias("display_relation"),
        both("source").alias("source"), weaker.cast("long").alias("credibility"), *[c.alias(n) for n, c in rest.items()],
    )


def paired_records(records: DataFrame, others: DataFrame, key: list[str], name: str, other: str) -> DataFrame:
    """Each record (name) with the smallest of the other records (other) that agree with it in all keys; null keys agree with none."""
    least = others.groupBy(*key).agg(F.min(other).alias("_other"))
    return records.join(least, key).groupBy(name).agg(F.min("_other").alias(other))


def union_of_ids(*parts: DataFrame) -> DataFrame:
    """Distinct tokens of one-column tables; those of lists are exploded, null and blank ones left out."""
    out = None
    for part in parts:
        column = part.columns[0]
        each = part.select((F.explode(column) if part.schema[0].dataType.typeName() == "array" else F.col(column)).alias("token"))
        items = each.select(F.col("token").cast("string"))
        out = items if out is None else out.unionAll(items)
    return out.where("trim(token) <> ''").distinct()


def resolver_classes(aliases: DataFrame) -> DataFrame:
    """alias -> unambiguous or ambiguous, with the smallest id; aliases has (alias, id)."""
    agg = aliases.groupBy("alias").agg(F.countDistinct("id").alias("n_ids"), F.min("id").alias("first_id"))
    return agg.withColumn("kind", F.when(F.col("n_ids") == 1, "unambiguous").otherwise("ambiguous"))


def overlaps(a: DataFrame, b: DataFrame, key: str, width: int) -> DataFrame:
    """Pairs of closed intervals (lo, hi) with one key that overlap, by bins of `width`.

    a has lo_a, hi_a and b has lo_b, hi_b.  A pair that shares several bins is
    kept in the first of them.
    """
    bins = lambda lo, hi: F.explode(F.sequence(F.floor(F.col(lo) / width), F.floor(F.col(hi) / width)))
    joined = a.withColumn("bin", bins("lo_a", "hi_a")).join(b.withColumn("bin", bins("lo_b", "hi_b")), [key, "bin"])
    first = F.floor(F.greatest("lo_a", "lo_b") / width)
    return joined.where((F.col("lo_a") <= F.col("hi_b")) & (F.col("lo_b") <= F.col("hi_a")) & (F.col("bin") == first)).drop("bin")

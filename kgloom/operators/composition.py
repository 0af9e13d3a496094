"""Gates and aggregates for edges inferred from paths of two premises.

Context fields are sets: empty is unknown, one value is known, more conflict.
An unknown value never counts as a match, and a conflict always rejects.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def status(values: Column) -> Column:
    return F.when(F.size(values) <= 0, "unknown").when(F.size(values) == 1, "known").otherwise("conflicting")


def with_evidence(evidence: DataFrame, x: str, y: str, fields: dict[str, str], provenance: list[str]) -> DataFrame:
    """One premise for each (x, y): the set of values of each context field, and the set of its provenance."""
    marks = F.array_compact(F.array(*[F.when(F.col(p).isNotNull(), F.concat(F.lit(f"{p}="), F.col(p).cast("string"))) for p in provenance]))
    sets = {name: F.array_sort(F.collect_set(col)) for name, col in fields.items()}
    return evidence.withColumn("_marks", marks).groupBy(F.col(x).alias("x_id"), F.col(y).alias("y_id")).agg(*[c.alias(n) for n, c in sets.items()], F.array_sort(F.array_distinct(F.flatten(F.collect_set("_marks")))).alias("provenance"))


def join_premises(first: DataFrame, second: DataFrame) -> DataFrame:
    """Paths x -> mid -> y; the fields of the premises are prefixed a_ and b_."""
    a = first.select("x_id", F.col("y_id").alias("mid"), *[F.col(c).alias(f"a_{c}") for c in first.columns if c not in ("x_id", "y_id")])
    b = second.select(F.col("x_id").alias("mid"), "y_id", *[F.col(c).alias(f"b_{c}") for c in second.columns if c not in ("x_id", "y_id")])
    return a.join(b, "mid")


def conflicting(field: str) -> Column:
    return (F.size(f"a_{field}") > 1) | (F.size(f"b_{field}") > 1)


def compatible(field: str) -> Column:
    """No conflict, and no two different known values."""
    return ~conflicting(field) & (F.size(F.array_union(f"a_{field}", f"b_{field}")) <= 1)


def shares(field: str) -> Column:
    """Known on both sides, and equal."""
    return (F.size(f"a_{field}") == 1) & (F.col(f"a_{field}") == F.col(f"b_{field}"))


def independent() -> Column:
    return (F.size("a_provenance") > 0) & (F.size("b_provenance") > 0) & ~F.arrays_overlap("a_provenance", "b_provenance")


def derivation(template: str) -> Column:
    return F.sha2(F.concat_ws("|", F.lit(template), "x_id", "mid", "y_id"), 256)


def candidates(paths: DataFrame, template: str) -> DataFrame:
    """One row for each (x, y): number of paths and smallest derivation hash."""
    return paths.groupBy("x_id", "y_id").agg(F.count("*").alias("support"), F.min(derivation(template)).alias("derivation"))


def sign(values: Column, positive: str, negative: str) -> Column:
    """+1 or -1 where one known value says so, else null."""
    return F.when(F.size(values) != 1, None).when(values[0] == positive, 1).when(values[0] == negative, -1)


def signed(paths: DataFrame, a: Column, b: Column) -> DataFrame:
    """Treats where the signs differ, contraindicates where they agree; unknown signs infer nothing."""
    relation = F.when(a * b < 0, "treats").when(a * b > 0, "contraindicates")
    return paths.withColumn("relation", relation).where("relation IS NOT NULL").groupBy("x_id", "y_id", "relation").agg(F.count("*").alias("support"))


def group_candidates(members: DataFrame, most: int = 500) -> DataFrame:
    """(group, y) that two members of a group reach by disjoint sources; members has group, member, y_id, sources.

    Groups of more than `most` members infer nothing, by rule of the template.
    Members with the same sources stand together, so only distinct source sets are compared.
    """
    small = members.select("group", "member").distinct().groupBy("group").count().where(F.col("count") <= most).select("group")
    agg = members.join(small, "group", "left_semi").groupBy("group", "y_id").agg(F.countDistinct("member").alias("n_members"), F.collect_set(F.array_sort("sources")).alias("sets"))
    disjoint = F.exists("sets", lambda a: F.exists("sets", lambda b: (F.size(a) > 0) & (F.size(b) > 0) & ~F.arrays_overlap(a, b)))
    return agg.where(disjoint).select("group", "y_id", "n_members")


def shared_neighbours(edges: DataFrame, anchors: DataFrame) -> DataFrame:
    """For each anchor (x_id) the other x with common y, and how many."""
    e = edges.select("x_id", "y_id").distinct()
    mine = e.join(anchors, "x_id", "left_semi").withColumnRenamed("x_id", "anchor")
    return mine.join(e, "y_id").where("anchor <> x_id").groupBy("anchor", "x_id").agg(F.count("*").alias("support"))

"""Validation counters over tables: each returns rows of counts, never samples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def counters(df: DataFrame, **conditions: Column) -> DataFrame:
    """Number of rows, and of rows that meet each condition."""
    return df.agg(F.count("*").alias("n"), *[F.count_if(c).alias(name) for name, c in conditions.items()])


def marked(df: DataFrame, column: str, known: DataFrame, key: str, name: str) -> DataFrame:
    """df with a flag: does `column` occur as `key` of known?"""
    there = known.select(F.col(key).alias(column)).distinct().withColumn(name, F.lit(True))
    return df.join(there, column, "left").withColumn(name, F.coalesce(name, F.lit(False)))


def excess(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once, and how many rows too many."""
    return df.groupBy(*keys).agg((F.count("*") - 1).alias("excess")).where("excess > 0")


def table_diff(a: DataFrame, b: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """By field: keys only in a, only in b, and fields that differ (nulls are equal)."""
    side = lambda df, s: df.select(key, F.lit(True).alias(f"in_{s}"), *[F.col(f).alias(f"{s}_{f}") for f in fields])
    both = side(a, "a").join(side(b, "b"), key, "full")
    differs = [F.when(F.col("in_a") & F.col("in_b") & ~F.col(f"a_{f}").eqNullSafe(F.col(f"b_{f}")), f) for f in fields]
    kinds = F.array_compact(F.array(F.when(F.col("in_b").isNull(), "only_a"), F.when(F.col("in_a").isNull(), "only_b"), *differs))
    return both.select(F.explode(kinds).alias("difference")).groupBy("difference").agg(F.count("*").alias("n"))


def digest(df: DataFrame, columns: list[str]) -> DataFrame:
    """Rows and a digest that does not depend on their order."""
    text = F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("~")) for c in columns])
    return df.agg(F.count("*").alias("n"), F.sum(F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long")).alias("digest"))


def id_parity(a: DataFrame, b: DataFrame) -> DataFrame:
    """Ids (id) on one side only, and on both."""
    side = lambda df, s: df.select("id").distinct().withColumn(s, F.lit(1))
    both = side(a, "a").join(side(b, "b"), "id", "full")
    where = F.when(F.col("b").isNull(), "only_a").when(F.col("a").isNull(), "only_b").otherwise("both")
    return both.groupBy(where.alias("found")).agg(F.count("*").alias("n"))


def length_audit(df: DataFrame, text: str, window: int, stride: int) -> DataFrame:
    """Lengths, exact quartiles, and how many windows the texts need."""
    n = F.length(text)
    windows = F.when(n == 0, 0).otherwise(F.greatest(F.lit(1), F.ceil((n - window) / stride) + 1))
    q = lambda p: F.percentile(n, F.lit(p))
    return df.where(n.isNotNull()).agg(F.count("*").alias("n"), F.min(n).cast("long").alias("shortest"), F.max(n).cast("long").alias("longest"), q(0.25).alias("p25"), q(0.5).alias("p50"), q(0.75).alias("p75"), F.count_if(n > window).alias("over"), F.sum(windows).cast("long").alias("windows"))

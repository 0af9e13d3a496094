"""Joins whose crowded keys are split on both sides."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _blocks(df: DataFrame, on: list[str], rows: int, name: str) -> DataFrame:
    """Keys with more than so many rows, and into how many blocks they are dealt."""
    return df.groupBy(*on).agg(F.count("*").alias("_n")).where(F.col("_n") > rows).select(*on, F.ceil(F.col("_n") / rows).cast("int").alias(name))


def split_join(left: DataFrame, right: DataFrame, on: list[str], rows: int = 200_000) -> DataFrame:
    """Inner join by `on`; of a key with more than `rows` rows on a side, that side is dealt into blocks and the other repeated for each.

    Blocks are dealt by a hash of the row, so a task that runs again gets the same rows.
    Null keys join nothing.  Columns _a, _b, _i, _j are its own.
    """
    crowded = _blocks(left, on, rows, "_a").join(_blocks(right, on, rows, "_b"), on, "full")
    upto = lambda c: F.explode(F.sequence(F.lit(0), F.coalesce(c, F.lit(1)) - 1))
    dealt = lambda df, c: F.pmod(F.xxhash64(*df.columns), F.coalesce(c, F.lit(1))).cast("int")
    a = left.join(crowded, on, "left").withColumn("_i", dealt(left, "_a")).withColumn("_j", upto("_b")).drop("_a", "_b")
    b = right.join(crowded, on, "left").withColumn("_j", dealt(right, "_b")).withColumn("_i", upto("_a")).drop("_a", "_b")
    return a.join(b, [*on, "_i", "_j"]).drop("_i", "_j")

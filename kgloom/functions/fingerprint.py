"""Fingerprints of tables that add up: of rows in any order, of files, of batches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A row's digest is summed in so many parts of 60 bits.
PARTS = 4


def row_digest(columns: list[str]) -> Column:
    """SHA-256 of a row's values by column name; null and a column that is not there are the same."""
    return F.sha2(F.to_json(F.struct(*[F.col(c) for c in sorted(columns)])), 256)


def digest_sums(columns: list[str]) -> list[Column]:
    """Aggregates whose values add up over parts of a table: rows, and sums of the digests' parts."""
    digest = row_digest(columns)
    part = lambda k: F.conv(F.substring(digest, 15 * k + 1, 15), 16, 10).cast("decimal(38,0)")
    return [F.count("*").alias("n_rows"), *[F.coalesce(F.sum(part(k)), F.lit(0).cast("decimal(38,0)")).alias(f"sum_{k}") for k in range(PARTS)]]


def added(sums: DataFrame, by: list[str]) -> DataFrame:
    """Sums of parts as sums of wholes."""
    return sums.groupBy(*by).agg(F.sum("n_rows").alias("n_rows"), *[F.sum(f"sum_{k}").cast("decimal(38,0)").alias(f"sum_{k}") for k in range(PARTS)])


def fingerprint() -> Column:
    """One hash of the sums."""
    return F.sha2(F.concat_ws("|", F.col("n_rows").cast("string"), *[F.col(f"sum_{k}").cast("string") for k in range(PARTS)]), 256)


def table_fingerprint(df: DataFrame) -> DataFrame:
    """n_rows and fingerprint of a table (one row): equal for equal rows in whatever order and files."""
    return df.agg(*digest_sums(df.columns)).select("n_rows", fingerprint().alias("fingerprint"))

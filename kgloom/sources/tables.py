"""A typed graph over business tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.ids import credibility_from_score


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def node_id(kind: str, key) -> F.Column:
    return F.concat(F.lit(f"{kind}:"), key.cast("string"))


def edges(df: DataFrame, relation: str, x: tuple[str, str], y: tuple[str, str], **extra) -> DataFrame:
    """Edge rows from two key columns; extra columns by name."""
    return df.select(node_id(x[0], F.col(x[1])).alias("x_id"), F.lit(x[0]).alias("x_type"), node_id(y[0], F.col(y[1])).alias("y_id"), F.lit(y[0]).alias("y_type"), F.lit(relation).alias("relation"), *[c.alias(k) for k, c in extra.items()])


def supplies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every assertion that a supplier supplies a part, in source order by `pos`."""
    return edges(
        table(spark, sf_dir, "lineitem"), "supplier_supplies_part", ("supplier", "l_suppkey"), ("part", "l_partkey"),
        source=F.col("l_returnflag"), credibility=credibility_from_score(F.col("l_quantity"), 17, 34), pos=F.col("l_orderkey") * 10 + F.col("l_linenumber"), score=F.col("l_discount"),
    )


def business_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The key relations between the tables."""
    t = lambda n: table(spark, sf_dir, n)
    parts = [
        edges(t("orders"), "customer_places_order", ("customer", "o_custkey"), ("order", "o_orderkey")), edges(t("supplier"), "supplier_in_nation", ("supplier", "s_suppkey"), ("nation", "s_nationkey")),
        edges(t("customer"), "customer_in_nation", ("customer", "c_custkey"), ("nation", "c_nationkey")), edges(t("nation"), "nation_in_region", ("nation", "n_nationkey"), ("region", "n_regionkey")),
        edges(t("lineitem"), "order_contains_part", ("order", "l_orderkey"), ("part", "l_partkey")),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = {"part": "p_partkey", "supplier": "s_suppkey", "customer": "c_custkey", "nation": "n_nationkey", "region": "r_regionkey", "orders": "o_orderkey"}
    out = None
    for name, key in keys.items():
        kind = "order" if name == "orders" else name
        own = table(spark, sf_dir, name).select(node_id(kind, F.col(key)).alias("id"), F.lit(kind).alias("node_type"))
        out = own if out is None else out.unionByName(own)
    return out

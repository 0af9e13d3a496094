"""Graph operators on small tables, the oracle queries, and the incremental append."""

import hashlib
import random

import duckdb
import pytest
from pyspark.sql import functions as F

from kgloom.functions import ids
from kgloom.operators import edges as E
from kgloom.operators import graph_ml as G
from kgloom.operators import sampling as S
from kgloom.plans import queries as Q
from kgloom.streaming import append

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.mark.parametrize("name", [n for n, f in Q.QUERIES.items() if f.__module__ == Q.__name__])
def test_matches_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    got = Q.QUERIES[name](spark, SF)
    cur = con.execute(f"SELECT {', '.join(got.columns)} FROM ({Q.ORACLE_SQL[name]})")
    text = lambda rows: sorted(tuple(f"{float(v):.6g}" if isinstance(v, (int, float)) else str(v) for v in r) for r in rows)
    assert text(map(tuple, got.collect())) == text(cur.fetchall())


def test_curie(spark):
    rows = spark.createDataFrame([(" EFO_1 ",), ("nan",), ("HP:2",), ("XX_3",), (None,), ("OBA_4",), ("GSSO_5",), ("CHEBI_6",)], "x string")
    assert [r[0] for r in rows.select(ids.normalize_curie(F.col("x"))).collect()] == ["EFO:1", None, "HP:2", "XX_3", None, "OBA:4", "GSSO:5", "CHEBI_6"]


def test_credibility(spark):
    rows = [
        ("a", "b", "r", "s1", "1", "g1", 0.1, "known_drug", 1), ("a", "b", "r", "s1", "1", "g1", 0.9, "known_drug", 2), ("a", "c", "r", "s1", None, None, 0.1, None, 1), ("a", "c", "r", "s2", None, None, 0.1, None, 2),
        ("a", "d", "r", "hpo", "1", "g1", 0.0, None, 1), ("a", "e", "r", "s1", "1", "g1", 0.1, None, 1), ("a", "f", "r", "s1", "1", "g1", 0.9, "literature", 1),
        ("a", "g", "r", "go", "1", "g1", 0.1, None, 1), ("a", "g", "r", "s1", "1", "g1", 0.5, None, 2), ("a", "h", "r", "s1", "1", "g1", None, None, 1), ("a", "h", "r", "s2", "2", "g1", None, None, 2), ("a", "i", "r", "s1", "", "", None, None, 1), ("a", "i", "r", "s1", "", "", None, None, 2),
    ]
    df = spark.createDataFrame(rows, "x_id string, y_id string, relation string, source string, paper_id string, author_group_key string, raw_score double, datatype string, pos long")
    # d, g: a curated source counts even where a better row of its paper stands for it; f: the datatype does not count; h: one author group
    assert {r.y_id: r.credibility for r in E.score_credibility(df).collect()} == {"b": 2, "c": 2, "d": 3, "e": 1, "f": 1, "g": 3, "h": 1, "i": 1}


def test_dense_index_without_exchange_reuse(spark):
    spark.conf.set("spark.sql.exchange.reuse", False)
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        found = G.dense_index(spark.range(300_000).select(F.lit("n").alias("node_type"), F.sha2(F.col("id").cast("string"), 256).alias("id")))
        assert tuple(found.agg(F.count_distinct("node_index"), F.min("node_index"), F.max("node_index")).first()) == (300_000, 0, 299_999)
    finally:
        spark.conf.unset("spark.sql.exchange.reuse")
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_unknown_vector_is_an_error(spark):
    with pytest.raises(KeyError):
        G.knn(spark.createDataFrame([(1, [1.0])], "vec_id long, embedding array<double>"), 2, 1)


def test_split_is_exact_and_repeatable(spark):
    df = spark.range(100).select(F.col("id"), (F.col("id") % 2).alias("g"))
    first = G.split(df, "g", "id", 1, 0.2, 0.1)
    assert {(r.g, r.split): r["count"] for r in first.groupBy("g", "split").count().collect()} == {(g, s): n for g in (0, 1) for s, n in (("train", 35), ("valid", 10), ("test", 5))}
    assert first.exceptAll(G.split(df.repartition(7), "g", "id", 1, 0.2, 0.1)).count() == 0


def test_append_in_two_batches_equals_one(spark, tmp_path):
    schema = "x_id string, y_id string, relation string, source string, credibility long, pos long"
    rows = [("a", "b", "r", "s2", 1, 1), ("a", "b", "r", "s1", 3, 2), ("a", "b", "r", "s2", 2, 3), ("a", "c", "r", "s1", 1, 4)]
    df = spark.createDataFrame(rows, schema)
    for k in (0, 1):
        df.where(F.col("pos") % 2 == k).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    append.append_edges(spark, str(tmp_path / "in"), df.schema, str(tmp_path / "store"), str(tmp_path / "progress"))
    got = append.current(spark, str(tmp_path / "store"), 1)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, E.merge_edges(df).collect()))


def test_scored_edges_are_dealt_once_for_all_that_is_asked(spark):
    cols = "x_id string, y_id string, relation string, source string, credibility int, pos long, paper_id string, author_group_key string, raw_score double, datatype string, note string"
    rows = [("a", "b", "r", "s2", 1, 2, "p", "g", 0.1, None, "second"), ("a", "b", "r", "s1", 1, 1, "p", "g", 0.9, "known_drug", "first"), ("a", None, "r", "s1", 1, 4, None, "", None, None, None), ("a", None, "r", None, 1, 3, " ", None, None, None, "x"), ("a", "c", "r", "s1", 1, 5, "p", None, None, None, "y"), ("a", "c", "r", "s1", 1, 6, "q", None, None, None, "z")]
    out = E.dedup_edges(spark.createDataFrame(rows, cols)).select("x_id", "y_id", "source", "credibility", "paper_id", "note")
    assert out._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 2  # one for scores, a narrower one for sources
    assert {tuple(r) for r in out.collect()} == {("a", "b", "s1,s2", 2, "p", "first"), ("a", "c", "s1", 2, "p", "y")}


def test_split_moves_no_rows_and_keeps_those_without_a_group(spark):
    """Each row is held against the last row of its group's shares; shares are those of a plain rank."""
    data = [("a" if k % 3 else None, k) for k in range(900)]
    df = spark.createDataFrame(data, "g string, id long")
    found = G.split(df, "g", "id", 5, 0.2, 0.1)
    assert "Exchange hashpartitioning" not in found._jdf.queryExecution().executedPlan().toString()
    got = {r["id"]: r["split"] for r in found.collect()}
    for group in ("a", None):
        order = sorted((k for g, k in data if g == group), key=lambda k: (hashlib.sha256(f"5|{k}".encode()).hexdigest(), str(k)))
        a, b = int(len(order) * 0.1), int(len(order) * 0.1) + int(len(order) * 0.2)
        assert [got[k] for k in order] == ["test"] * a + ["valid"] * (b - a) + ["train"] * (len(order) - b)


def test_most_similar_are_chosen_before_they_meet_their_names(spark):
    """Pairs are cut to k where they are counted: only those join the names."""
    rnd = random.Random(3)
    edges = sorted({(f"x{rnd.randrange(12)}", f"y{rnd.randrange(30)}") for _ in range(120)})
    found = S.profile_similarity(spark.createDataFrame(edges, "x_id string, y_id string"), 3)
    plan = found._jdf.queryExecution().optimizedPlan().toString().splitlines()
    assert next(k for k, line in enumerate(plan) if "Join " in line) < next(k for k, line in enumerate(plan) if "Window" in line)
    of = {x: {y for a, y in edges if a == x} for x, _ in edges}
    expected = []
    for x in of:
        near = sorted(((-round(len(of[x] & of[o]) / (len(of[x]) * len(of[o])) ** 0.5, 6), o, len(of[x] & of[o])) for o in of if o != x and of[x] & of[o]))[:3]
        expected += [(x, o, common, -cos, n) for n, (cos, o, common) in enumerate(near, 1)]
    assert sorted((r[0], r[1], r[2], r[3], r[4]) for r in found.collect()) == sorted(expected)

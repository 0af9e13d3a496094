"""Attention and mean messages against numpy, a hub in many tasks, weighted prototypes."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from kgloom.operators import messages as M

EDGE = "relation string, src string, dst string"


def graph(seed=0, dim=4, out=3):
    rng = np.random.default_rng(seed)
    nodes = {f"{t}{k}": rng.standard_normal(dim) for t in "ab" for k in range(8)}
    edges = {(r, f"{s}{rng.integers(8)}", f"{d}{rng.integers(8)}") for r, s, d in (("treats", "a", "b"), ("rev_treats", "b", "a"), ("near", "a", "a")) for _ in range(25)}
    linear = {r: (rng.standard_normal((out, dim)), rng.standard_normal(out)) for r in ("treats", "rev_treats", "near")}
    return nodes, sorted(edges), linear, {r: rng.standard_normal(2 * out) for r in linear}


def slow(nodes, edges, linear, attention=None):
    wh = lambda r, n: linear[r][0] @ nodes[n] + linear[r][1]
    out = {}
    for r in linear:
        partner = r.removeprefix("rev_") if r.startswith("rev_") else f"rev_{r}" if f"rev_{r}" in linear else r
        for d in {e[2] for e in edges if e[0] == r}:
            sources = [s for x, s, y in edges if x == r and y == d]
            e = np.array([attention[r] @ np.concatenate((wh(r, s), wh(partner, d))) if attention else 0.0 for s in sources])
            e = np.where(e > 0, e, 0.01 * e)
            alpha = np.exp(e - e.max()) / np.exp(e - e.max()).sum()
            out[d] = out.get(d, 0) + sum(a * wh(r, s) for a, s in zip(alpha, sources))
    return out


@pytest.mark.parametrize("attended", [True, False])
def test_layers_against_numpy(spark, attended):
    nodes, edges, linear, attention = graph()
    attention = attention if attended else None
    got = M.layer(spark.createDataFrame(edges, EDGE).repartition(5), spark.createDataFrame([(k, v.tolist()) for k, v in nodes.items()], "node string, vector array<double>"), M.Weights(linear, attention)).collect()
    want = slow(nodes, edges, linear, attention)
    assert {r["node"] for r in got} == set(want) and all(np.allclose(r["vector"], want[r["node"]]) for r in got)


def test_activation_and_ends_without_features(spark):
    nodes, edges, linear, attention = graph(3)
    features = spark.createDataFrame([(k, v.tolist()) for k, v in nodes.items()], "node string, vector array<double>")
    got = M.layer(spark.createDataFrame([*edges, ("near", "zz", "a1"), ("near", "a1", "zz")], EDGE), features, M.Weights(linear, attention), activate=True).collect()
    want = slow(nodes, edges, linear, attention)
    assert {r["node"] for r in got} == set(want) and all(np.allclose(r["vector"], M.leaky(want[r["node"]])) for r in got)


def test_extreme_logits_do_not_overflow(spark):
    linear, attention = {"near": (np.eye(2) * 1000, np.zeros(2))}, {"near": np.array([1.0, 1.0, 0.0, 0.0])}
    features = spark.createDataFrame([("x", [1.0, 1.0]), ("y", [1.0, 1.0]), ("z", [0.0, 0.0])], "node string, vector array<double>")
    got = M.layer(spark.createDataFrame([("near", "x", "z"), ("near", "y", "z")], EDGE), features, M.Weights(linear, attention)).first()
    assert np.allclose(got["vector"], [1000.0, 1000.0])


def test_a_hub_is_the_work_of_many_tasks(spark):
    n = 1_000_000
    edges = spark.range(0, n, 1, 16).select(F.lit("near").alias("relation"), (F.col("id") % 5000).cast("string").alias("src"), F.lit("hub").alias("dst"))
    features = spark.range(5000).select(F.col("id").cast("string").alias("node"), F.array(F.col("id") / 1000, F.lit(1.0)).alias("vector")).union(spark.createDataFrame([("hub", [0.0, 0.0])]))
    weights = M.Weights({"near": (np.eye(2), np.zeros(2))}, {"near": np.array([1.0, 0.0, 0.0, 0.0])})
    x = np.arange(5000) / 1000
    alpha = np.exp(x - x.max()) / np.exp(x - x.max()).sum()
    got = M.relation_messages(edges, features, weights)
    assert np.allclose(got.first()["vector"], [alpha @ x, 1.0])
    logits = M.attention_logits(edges, features, weights).withColumn("slot", F.lit(0))
    assert logits.count() == n
    parts = logits.select("relation", "dst", "slot", "logit", "wh").mapInArrow(M._combine, M.MERGED)
    assert parts.groupBy(F.spark_partition_id()).count().count() > 1 and parts.count() < n / 1000


def test_weights_have_a_bound():
    with pytest.raises(ValueError):
        M.Weights({"r": (np.zeros((3000, 3000)), np.zeros(3000))})


def test_prototypes(spark):
    rng = np.random.default_rng(1)
    vectors = {f"e{k}": rng.standard_normal(3) for k in range(6)}
    sims = [(a, b, float(rng.integers(-3, 4)) / 3) for a in vectors for b in vectors if a != "e5"]
    sims[1:1] = []
    embeddings = spark.createDataFrame([(k, v.tolist()) for k, v in vectors.items()], "id string, vector array<double>")
    similar = spark.createDataFrame(sims, "entity string, other string, similarity double")
    degrees = spark.createDataFrame([(f"e{k}", k) for k in range(5)], "id string, degree int")

    def proto(a, k):
        best = sorted([(-s, b) for x, b, s in sims if x == a and b != a])[:k]
        total = max(sum(abs(s) for s, _ in best), 1e-12)
        return sum(-s / total * vectors[b] for s, b in best)

    for measure, share in (("rarity", lambda k: 0.7 * np.exp(-0.7 * k) + 0.2), ("avg", lambda k: 0.5), ("heuristics-0.8", lambda k: 0.2), ("100proto", lambda k: 1.0)):
        got = {r["id"]: r["vector"] for r in M.blended_prototypes(similar, embeddings, degrees, 3, measure).collect()}
        for k in range(5):
            c = share(k)
            assert np.allclose(got[f"e{k}"], (1 - c) * vectors[f"e{k}"] + c * proto(f"e{k}", 3))
        assert np.allclose(got["e5"], vectors["e5"])
    with pytest.raises(ValueError):
        M.blended_prototypes(similar, embeddings, degrees, 3, "odd")


def test_a_targets_parts_meet_once(spark):
    nodes, edges, linear, attention = graph(5)
    features = spark.createDataFrame([(k, v.tolist()) for k, v in nodes.items()], "node string, vector array<double>")
    found = M.relation_messages(spark.createDataFrame(edges, EDGE), features, M.Weights(linear, attention))
    assert found._jdf.queryExecution().executedPlan().toString().count("FlatMapGroupsInArrow") == 1

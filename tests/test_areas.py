"""Area splits hit their budget and repeat by seed; ablations by share; areas of one large pool against plain ranks."""

import random

import pytest
from pyspark.sql import functions as F

from kgloom.operators import areas as A
from kgloom.operators import evaluation as V
from kgloom.plans import area_queries

EDGE = "relation string, x_id string, y_id string, x_type string, y_type string"


@pytest.fixture(scope="module")
def graph(spark):
    rnd = random.Random(6)
    rows = {("treats", f"m{rnd.randrange(20)}", f"d{rnd.randrange(30)}", "m", "d") for _ in range(120)} | {("near", f"d{rnd.randrange(30)}", f"d{rnd.randrange(30)}", "d", "d") for _ in range(200)} | {("rev", f"d{rnd.randrange(30)}", f"m{rnd.randrange(20)}", "d", "m") for _ in range(150)}
    return sorted(rows), spark.createDataFrame(sorted(rows), EDGE).cache()


def test_entities_by_reference_and_group(spark):
    t = lambda rows, names: spark.createDataFrame(rows, names)
    found = A.area_entities(
        t([("o2", "o1"), ("o3", "o2"), ("o9", "o8"), ("o1", "o3")], "child string, parent string"), t([("o1",)], "id string"), t([("o2", "d2"), ("o3", "d3"), ("o3", "d33"), ("o9", "d9"), ("o1", "gone")], "ontology_id string, id string"),
        t([("d3", "g1"), ("d9", "g2"), ("gone", "g3")], "member string, id string"), t([(x,) for x in ("d2", "d3", "d33", "d9", "g1", "g2", "g3")], "id string"),
    )
    assert sorted(r["id"] for r in found.collect()) == ["d2", "d3", "d33", "g1", "g3"]


def pairs(df):
    return sorted((r["x_id"], r["y_id"]) for r in df.select("x_id", "y_id").collect())


@pytest.mark.parametrize("share, hops", [(0.2, 2), (0.3, 1), (25, 2)])
def test_the_budget_is_met_and_repeats(spark, graph, share, hops):
    rows, edges = graph
    entities = spark.createDataFrame([("d1",), ("d2",)], "id string")
    around, last = {"d1", "d2"}, {"d1", "d2"}
    for _ in range(hops):
        last = {x for _, x, y, *_ in rows if y in last} - around
        around |= last
    inner = {(r, x, y) for r, x, y, *_ in rows if x in around and y in around}
    own = {(x, y) for r, x, y, *_ in rows if r == "treats" and {x, y} & {"d1", "d2"}}
    n_own = sum(1 for r, x, y, *_ in rows if r == "treats" and {x, y} & {"d1", "d2"})
    budget = share if share > 1 else round(share * len(rows)) - n_own
    one = pairs(A.area_test_pairs(edges, entities, ["treats"], 3, share, hops))
    assert one == pairs(A.area_test_pairs(edges.repartition(7), entities, ["treats"], 3, share, hops))
    assert (one != pairs(A.area_test_pairs(edges, entities, ["treats"], 4, share, hops))) == (budget < len(inner))
    assert own <= set(one) <= own | {(x, y) for _, x, y in inner}
    taken = A.area_test_pairs(edges.where("relation <> 'treats'"), entities, ["none"], 3, budget if budget > 1 else 2, hops)
    assert taken.count() <= max(budget, 2)
    # with a relation for each pair, pairs are edges and the budget is exact
    single = {(x, y): r for r, x, y, *_ in rows}
    alone = spark.createDataFrame([(r, x, y, "", "") for (x, y), r in single.items()], EDGE)
    got = set(pairs(A.area_test_pairs(alone, entities, ["none"], 3, share if share > 1 else 0.1, hops)))
    assert len(got) == (share if share > 1 else round(0.1 * len(single)))


def test_shares_of_the_ball_and_splits(spark, graph):
    rows, edges = graph
    entities = spark.createDataFrame([("d1",)], "id string")
    test = A.area_test_pairs(edges, entities, ["treats"], 3, hops=1, mask=0.5)
    split = A.area_split_full(edges, test)
    assert split.count() == len({(x, y) for _, x, y, *_ in rows}) and pairs(split.where("split = 'test'")) == pairs(test)


def test_ablations(spark, graph):
    rows, edges = graph
    nodes = spark.createDataFrame([("d", f"d{k}") for k in range(30)] + [("m", f"m{k}") for k in range(20)], "node_type string, id string")
    size = {r: sum(x[0] == r for x in rows) for r in ("treats", "near", "rev")}
    count = lambda df: dict(map(tuple, df.groupBy("relation").count().collect()))
    assert count(A.without_share(edges, 30)) == {r: n - int(0.3 * n) for r, n in size.items()}
    for percent in (0, 20, 100, 250):
        more = A.with_random(edges, nodes, percent)
        assert count(more) == {r: n + int(percent / 100 * n) for r, n in size.items()}
    drawn = A.randomised(edges, nodes)
    assert count(drawn) == size and drawn.where("substr(x_id, 1, 1) <> x_type OR substr(y_id, 1, 1) <> y_type").count() == 0
    assert sorted(map(tuple, drawn.collect())) == sorted(map(tuple, A.randomised(edges.repartition(5), nodes).collect())) != sorted(map(tuple, A.randomised(edges, nodes, 7).collect()))
    assert count(A.without_relation(edges.withColumn("relation", F.when(F.col("relation") == "rev", "rev_treats").otherwise(F.col("relation"))), "treats")) == {"near": size["near"]}


def test_areas_by_ranges_equal_areas_by_windows(spark):
    rnd = random.Random(2)
    rows = [(rnd.choice("ab"), rnd.choice((0, 1)), rnd.choice((rnd.random(), 0.5, 0.25))) for _ in range(3000)] + [("c", 1, 0.1), ("c", 1, 0.2), ("d", 0, 0.3)]
    scored = spark.createDataFrame(rows, "pool string, label int, score double").repartition(8)
    tell = lambda df: {r["pool"]: (r["n_pos"], r["n_neg"], round(r["auroc"], 9), round(r["auprc"], 9)) for r in df.collect()}
    assert tell(V.spread_areas(scored, ["pool"])) == tell(V.areas(scored, ["pool"]))


def test_composed_paths(spark):
    from kgloom.operators import edges as E

    edge = "x_id string, x_type string, y_id string, y_type string, relation string, source string, credibility int, "
    first = spark.createDataFrame([("a", "A", "c", "C", "r", "s", 3, "x", 1), ("b", "A", "c", "C", "r", None, None, "y", 2), ("b", "A", "z", "C", "r", "s", 1, "y", 2)], edge + "note string, n int")
    second = spark.createDataFrame([("c", "C", "d", "D", "q", "t", 2, "other", 0.5)], edge + "note string, score double")
    for rows in (1, 100):
        got = sorted(tuple(r) for r in E.composed_paths(first, second, rows).select("x_id", "x_type", "y_id", "y_type", "relation", "display_relation", "source", "credibility", "note", "n", "score").collect())
        assert got == [("a", "A", "d", "D", "composed:r+q", "via:C:c", "composed:s+t", 2, "x", 1, 0.5), ("b", "A", "d", "D", "composed:r+q", "via:C:c", "composed:+t", 1, "y", 2, 0.5)]


def test_names_and_test_entities(spark):
    nodes = spark.createDataFrame([("d", "x", "b"), ("d", "x", "a"), ("d", "y", None), ("m", "x", "c")], "node_type string, id string, name string")
    assert sorted(map(tuple, V.id_names(nodes).collect())) == [("d", 0, "x", "a"), ("d", 1, "y", "y"), ("m", 0, "x", "c")]
    split = spark.createDataFrame([("r", "a", "test"), ("r", "a", "test"), ("r", "b", "train"), ("q", "a", "test")], "relation string, y_id string, split string")
    assert sorted(map(tuple, V.test_entities(split).collect())) == [("q", "a", 1), ("r", "a", 2)]


def test_random_edges_are_not_ranked_and_budgets_end_inside_a_bin(spark, graph, monkeypatch):
    rows, edges = graph
    monkeypatch.setattr(A, "_BIN", 0)  # all rows in one bin
    one = pairs(A.without_share(edges, 30, 3))
    monkeypatch.setattr(A, "_BIN", 4)
    assert one == pairs(A.without_share(edges, 30, 3))
    assert pairs(A.without_share(edges, 0, 3)) == sorted((x, y) for _, x, y, *_ in rows) and pairs(A.without_share(edges, 100, 3)) == []
    nodes = spark.createDataFrame(sorted({(t, i) for _, x, y, a, b in rows for t, i in ((a, x), (b, y))}), "node_type string, id string")
    mixed = edges.withColumn("relation", F.lit("one"))  # three pairs of types in one relation
    monkeypatch.setattr(A, "_RUN", 7)
    kinds = lambda df: {(r["x_type"], r["y_type"]): r["count"] for r in df.groupBy("x_type", "y_type").count().collect()}
    assert kinds(A.randomised(mixed, nodes)) == kinds(mixed)
    assert A.with_random(mixed, nodes, 250).count() == len(rows) + int(2.5 * len(rows))
    # the rows are never sorted or shuffled whole to number them
    plan = A.without_share(edges, 30, 3)._jdf.queryExecution().executedPlan().toString()
    assert "RangePartitioning" not in plan and "rangepartitioning" not in plan and "SortMergeJoin" not in plan


def test_random_ends_do_not_gather_the_index_in_the_driver(spark, graph):
    """The index of nodes grows with the input: however small its guess, the driver does not send it to all tasks."""
    nodes = spark.createDataFrame([("m", f"m{k}") for k in range(20)] + [("d", f"d{k}") for k in range(30)], "node_type string, id string")
    edges = graph[1]
    for drawn in (A.randomised(edges, nodes), A.with_random(edges, nodes, 20)):
        assert drawn._jdf.queryExecution().executedPlan().toString().count("ShuffledHashJoin") >= 2


def test_pairs_are_made_distinct_once_for_both_directions(spark):
    """Line items' pairs are shuffled as numbers, so that both directions read one shuffle."""
    edges = area_queries._tables(spark, "/root/testdata/sf0.001")["edges"]
    plan = edges._jdf.queryExecution().optimizedPlan().toString()
    grouped = [line for line in plan.splitlines() if "Aggregate" in line]
    assert len(grouped) == 3 and all("Aggregate [l_suppkey" in g or "Aggregate [o_custkey" in g for g in grouped)


def test_written_edges_are_not_made_distinct_again(spark):
    """An area split reads edges many times: it reads kept pairs, not line items."""
    kept = lambda written: area_queries._tables(spark, "/root/testdata/sf0.001", written)["edges"]
    assert not any(w in kept(True)._jdf.queryExecution().optimizedPlan().toString() for w in ("Aggregate", "Relation"))
    assert kept(True).exceptAll(kept(False)).isEmpty() and kept(True).count() == kept(False).count()

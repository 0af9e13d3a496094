"""Splits and metrics over the driver's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import edges as E
from ..operators import evaluation as V
from ..sources.tables import business_edges, nodes, supplies, table
from .queries import _BUSINESS, _NODES, _SUPPLIES, query
from .sampling_queries import _DRAW


def _place(key: str, seed: int, by: str = "") -> str:
    return f"row_number() OVER ({by} ORDER BY sha256('{seed}|' || {key})) - 1"


@query(f"WITH c AS (SELECT c_custkey, {_place('c_custkey', 5)} AS place, count(*) OVER () AS n FROM customer), f AS (SELECT *, n // 20 AS size, n % 20 AS extra FROM c), g AS (SELECT *, 3 * size + least(3, extra) AS start, size + CASE WHEN 3 < extra THEN 1 ELSE 0 END AS width FROM f), h AS (SELECT *, CASE WHEN place < start THEN place ELSE place - width END AS rest FROM g) SELECT c_custkey, CASE WHEN place >= start AND place < start + width THEN 'test' WHEN rest < floor((n - width) * 0.9::DOUBLE) THEN 'train' ELSE 'valid' END AS split FROM h")
def q_split_cv_inner(spark: SparkSession, d: str) -> DataFrame:
    return V.cross_fold(table(spark, d, "customer").select("c_custkey"), "c_custkey", 5, 20, 3)


@query(f"WITH p AS (SELECT DISTINCT l_partkey AS id FROM lineitem WHERE l_linenumber = 1), e AS (SELECT id, count(*) AS n_edges FROM (SELECT l_partkey AS id FROM lineitem WHERE l_linenumber = 2 UNION ALL SELECT -l_suppkey - 1 FROM lineitem WHERE l_linenumber = 2) GROUP BY id), c AS (SELECT id, coalesce(n_edges <= 3, false) AS few, count(*) OVER () AS n FROM p LEFT JOIN e USING (id)), k AS (SELECT *, {_place('id', 6)} AS place FROM c WHERE NOT few) SELECT id, 'test' AS split FROM c WHERE few UNION ALL SELECT id, CASE WHEN place < floor(n * 0.7::DOUBLE) THEN 'train' ELSE 'valid' END FROM k")
def q_split_few_neighbours(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "lineitem")
    edges = rows.where("l_linenumber = 2").select(F.col("l_partkey").alias("x_id"), (-F.col("l_suppkey") - 1).alias("y_id"))
    return V.few_neighbours(edges, rows.where("l_linenumber = 1").select(F.col("l_partkey").alias("y_id")), 3, 6, 0.7)


@query(f"WITH c AS (SELECT o_custkey AS id, count(*) <= 8 AS few, count(*) OVER () AS n FROM orders GROUP BY 1), k AS (SELECT *, {_place('id', 6)} AS place FROM c WHERE NOT few) SELECT id, 'test' AS split FROM c WHERE few UNION ALL SELECT id, CASE WHEN place < floor(n * 0.7::DOUBLE) THEN 'train' ELSE 'valid' END FROM k")
def q_split_few_pairs(spark: SparkSession, d: str) -> DataFrame:
    return V.few_pairs(table(spark, d, "orders").select(F.col("o_custkey").alias("y_id")), 8, 6, 0.7)


@query(f"WITH r AS (SELECT o_orderkey, o_orderpriority, {_place('o_orderkey', 9, 'PARTITION BY o_orderpriority')} AS place, count(*) OVER (PARTITION BY o_orderpriority) AS n FROM orders), s AS (SELECT *, CASE WHEN place < floor(n * 0.05::DOUBLE) THEN 'valid' ELSE 'train' END AS split FROM r) SELECT o_orderkey, split FROM s UNION ALL SELECT o_orderkey, 'test' FROM s WHERE split = 'valid'")
def q_split_full_graph(spark: SparkSession, d: str) -> DataFrame:
    return V.full_graph(table(spark, d, "orders").select("o_orderkey", "o_orderpriority"), "o_orderpriority", "o_orderkey", 9).select("o_orderkey", "split")


@query("WITH RECURSIVE t AS (SELECT c_custkey AS id FROM customer WHERE c_custkey = 2 UNION SELECT c_custkey FROM t JOIN customer ON c_custkey // 3 = id AND c_custkey > 0) SELECT o_orderkey, CASE WHEN o_custkey IN (SELECT id FROM t) THEN 'test' ELSE 'train' END AS split FROM orders")
def q_split_area(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "customer")
    parents = c.where("c_custkey > 0").select(F.col("c_custkey").alias("child"), F.floor(F.col("c_custkey") / 3).alias("parent"))
    return V.area_split(table(spark, d, "orders"), parents, c.where("c_custkey = 2").select(F.col("c_custkey").alias("id")), "o_custkey").select("o_orderkey", "split")


_X = "CASE WHEN o_custkey % 4 = 0 THEN 'g' || o_custkey % 16 ELSE 'c' || o_custkey END"


@query(f"WITH t AS (SELECT o_orderkey, {_X} AS x_id, CASE o_orderstatus WHEN 'O' THEN 'rev_treats' WHEN 'F' THEN 'rev_other' ELSE 'treats' END AS relation FROM orders), own AS (SELECT DISTINCT CASE WHEN c_custkey % 4 = 0 THEN 'g' || c_custkey % 16 ELSE 'c' || c_custkey END AS x_id FROM customer WHERE c_nationkey = 3) SELECT o_orderkey, relation FROM t WHERE relation = 'treats' OR (relation = 'rev_treats' AND x_id IN (SELECT x_id FROM own))")
def q_area_test(spark: SparkSession, d: str) -> DataFrame:
    test = table(spark, d, "orders").selectExpr("o_orderkey", f"{_X} AS x_id", "CASE o_orderstatus WHEN 'O' THEN 'rev_treats' WHEN 'F' THEN 'rev_other' ELSE 'treats' END AS relation")
    c = table(spark, d, "customer")
    grouped = c.where("c_custkey % 4 = 0").selectExpr("'g' || c_custkey % 16 AS id", "'c' || c_custkey AS member")
    return V.area_test(test, c.where("c_nationkey = 3").selectExpr("'c' || c_custkey AS id"), grouped, ["treats"]).select("o_orderkey", "relation")


@query(f"WITH {_BUSINESS} SELECT 'kept' AS ablation, relation, count(*) AS n FROM e WHERE relation IN ('customer_in_nation', 'nation_in_region') GROUP BY ALL UNION ALL SELECT 'dropped', relation, count(*) FROM e WHERE relation <> 'order_contains_part' GROUP BY ALL")
def q_ablations(spark: SparkSession, d: str) -> DataFrame:
    e = business_edges(spark, d)
    one = lambda name, df: df.groupBy("relation").agg(F.count("*").alias("n")).select(F.lit(name).alias("ablation"), "relation", "n")
    return one("kept", V.without(e, keep=["customer_in_nation", "nation_in_region"])).unionAll(one("dropped", V.without(e, drop=["order_contains_part"])))


_LINKS = f"l AS (SELECT o_orderkey, o_custkey, {_place('o_orderkey', 3)} AS place, count(*) OVER () AS n FROM orders), s AS (SELECT *, greatest(1, floor(n * 0.1::DOUBLE)) AS held FROM l), k AS (SELECT o_orderkey, o_custkey, CASE WHEN place < held THEN 'test' WHEN place < 2 * held THEN 'valid' ELSE 'train' END AS split FROM s WHERE place < 2 * held + 500)"


def _links(spark: SparkSession, d: str) -> DataFrame:
    return V.link_split(table(spark, d, "orders").select("o_orderkey"), "o_orderkey", 3, most_train=500)


@query(f"WITH {_LINKS} SELECT o_orderkey, split FROM k")
def q_link_split(spark: SparkSession, d: str) -> DataFrame:
    return _links(spark, d)


@query(f"WITH {_LINKS} SELECT o_custkey AS x_id, o_orderkey AS y_id, 'places' AS relation FROM k WHERE split = 'train' UNION ALL SELECT o_orderkey, o_custkey, 'rev_places' FROM k WHERE split = 'train'")
def q_message_edges(spark: SparkSession, d: str) -> DataFrame:
    edges = table(spark, d, "orders").select("o_orderkey", F.col("o_custkey").alias("x_id"), F.col("o_orderkey").alias("y_id"), F.lit("places").alias("relation"))
    return V.message_edges(edges, _links(spark, d), "o_orderkey")


@query(f"WITH {_BUSINESS}, {_NODES}, w AS (SELECT * FROM v WHERE id NOT IN (SELECT 'customer:' || c_custkey FROM customer WHERE c_acctbal < 0)), i AS (SELECT *, row_number() OVER (PARTITION BY node_type ORDER BY id) - 1 AS k FROM w) SELECT relation, x.k AS src, y.k AS dst FROM e JOIN i x ON x.id = x_id AND x.node_type = x_type JOIN i y ON y.id = y_id AND y.node_type = y_type")
def q_index_edges_lenient(spark: SparkSession, d: str) -> DataFrame:
    poor = table(spark, d, "customer").where("c_acctbal < 0").select(F.concat(F.lit("customer:"), "c_custkey").alias("id"))
    return V.indexed_edges(business_edges(spark, d), nodes(spark, d).join(poor, "id", "left_anti"), strict=False)


@query(f"WITH {_BUSINESS}, u AS (SELECT DISTINCT relation, x_id, y_id FROM e) SELECT relation, x_id, y_id, row_number() OVER (PARTITION BY relation ORDER BY x_id || chr(9) || y_id) - 1 AS edge_pos FROM u")
def q_edge_positions(spark: SparkSession, d: str) -> DataFrame:
    return V.edge_positions(business_edges(spark, d))


_VALUE = "round((" + _DRAW.format("'0', 'vector', id, {}") + " % 2001 - 1000) / 1000, 6)"


@query(f"WITH n AS (SELECT o_orderkey AS id FROM orders) SELECT id, vec_id IS NOT NULL AS is_real, CASE WHEN vec_id IS NULL THEN {_VALUE.format(0)} ELSE round(embedding[1]::DOUBLE, 6) END AS first, CASE WHEN vec_id IS NULL THEN {_VALUE.format(3)} ELSE round(embedding[4]::DOUBLE, 6) END AS fourth FROM n LEFT JOIN embeddings ON vec_id = id")
def q_feature_rows(spark: SparkSession, d: str) -> DataFrame:
    n = table(spark, d, "orders").select(F.lit("vector").alias("node_type"), F.col("o_orderkey").alias("id"))
    e = table(spark, d, "embeddings").select(F.col("vec_id").alias("id"), F.transform("embedding", lambda x: x.cast("double")).alias("vector"))
    return V.feature_rows(n, e, 4).select("id", "is_real", F.round(F.col("vector")[0], 6).alias("first"), F.round(F.col("vector")[3], 6).alias("fourth"))


def _areas(entity: str, label: str, score: str) -> str:
    return f"""s AS (SELECT {entity}, CASE WHEN {label} THEN 1 ELSE 0 END AS label, {score} AS score FROM lineitem),
  r AS (SELECT *, count(*) OVER (PARTITION BY {entity.split(' AS ')[-1]} ORDER BY score DESC RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS above, sum(label) OVER (PARTITION BY {entity.split(' AS ')[-1]} ORDER BY score DESC RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS hits,
    rank() OVER (PARTITION BY {entity.split(' AS ')[-1]} ORDER BY score) + (count(*) OVER (PARTITION BY {entity.split(' AS ')[-1]}, score) - 1) / 2 AS mr FROM s),
  g AS (SELECT {entity.split(' AS ')[-1]}, sum(label) AS p, sum(1 - label) AS q, sum(mr) FILTER (label = 1) AS ranks, sum(hits / above) FILTER (label = 1) AS precisions FROM r GROUP BY ALL),
  a AS (SELECT {entity.split(' AS ')[-1]}, CASE WHEN p > 0 AND q > 0 THEN (ranks - p * (p + 1) / 2) / (p * q) ELSE -1 END AS auroc, CASE WHEN p > 0 THEN precisions / p ELSE -1 END AS auprc FROM g)"""


def _scored(spark: SparkSession, d: str, entity: list[str], label, score: str) -> DataFrame:
    return table(spark, d, "lineitem").select(*entity, label.cast("int").alias("label"), F.col(score).alias("score"))


@query(f"WITH {_areas('l_suppkey', chr(39).join(['l_returnflag = ', 'R', '']), 'l_discount')} SELECT l_suppkey, round(auroc, 6) AS auroc, round(auprc, 6) AS auprc FROM a")
def q_areas(spark: SparkSession, d: str) -> DataFrame:
    found = V.areas(_scored(spark, d, ["l_suppkey"], F.col("l_returnflag") == "R", "l_discount"), ["l_suppkey"])
    return found.select("l_suppkey", F.round("auroc", 6).alias("auroc"), F.round("auprc", 6).alias("auprc"))


@query("""WITH s AS (SELECT l_suppkey, l_orderkey * 100000 + l_partkey * 10 + l_linenumber AS id, CASE WHEN l_returnflag = 'R' THEN 1 WHEN l_linestatus = 'F' THEN -1 ELSE 0 END AS label, l_discount AS score FROM lineitem), r AS (SELECT *, row_number() OVER (PARTITION BY l_suppkey ORDER BY score DESC, id DESC) AS place FROM s WHERE label <> -1),
  q AS (SELECT *, sum(label) OVER (PARTITION BY l_suppkey ORDER BY place) / place AS pr FROM r), k AS (SELECT * FROM (VALUES ('10', 10), ('50', 50), ('5%', 37)) v(k, n)),
  g AS (SELECT l_suppkey, k, n, sum(label) AS n_pos, count(*) FILTER (label = 1 AND place <= n) AS hits, coalesce(avg(pr) FILTER (label = 1 AND place <= n), 0) AS ap, coalesce(1 / min(place) FILTER (label = 1 AND place <= n), 0) AS mrr FROM q, k GROUP BY ALL)
  SELECT l_suppkey, n_pos, k, CASE WHEN n_pos > 0 THEN round(hits / n_pos, 6) ELSE -1 END AS recall, CASE WHEN n_pos > 0 THEN round(n / 740, 6) ELSE -1 END AS recall_random, CASE WHEN n_pos > 0 THEN round(hits / (n / 740 * n_pos), 6) ELSE -1 END AS enrichment, CASE WHEN n_pos > 0 THEN round(ap, 6) ELSE -1 END AS ap, CASE WHEN n_pos > 0 THEN round(mrr, 6) ELSE -1 END AS mrr FROM g""")
def q_top_k_metrics(spark: SparkSession, d: str) -> DataFrame:
    label = F.when(F.col("l_returnflag") == "R", 1).when(F.col("l_linestatus") == "F", -1).otherwise(0)
    rows = table(spark, d, "lineitem").select("l_suppkey", (F.col("l_orderkey") * 100000 + F.col("l_partkey") * 10 + F.col("l_linenumber")).alias("id"), label.alias("label"), F.col("l_discount").alias("score"))
    return V.top_k_metrics(rows, "l_suppkey", {"10": 10, "50": 50, "5%": 37}, 740)


_BY_FLAG = _areas("l_returnflag AS name", "l_linestatus = 'O'", "l_tax")


@query(f"WITH {_BY_FLAG}, {_areas(chr(39) + 'micro' + chr(39) + ' AS name', 'l_linestatus = ' + chr(39) + 'O' + chr(39), 'l_tax').replace('s AS (', 's2 AS (', 1).replace('r AS (', 'r2 AS (', 1).replace('FROM s)', 'FROM s2)').replace('g AS (', 'g2 AS (', 1).replace('FROM r GROUP', 'FROM r2 GROUP').replace('a AS (', 'a2 AS (', 1).replace('FROM g)', 'FROM g2)')}, u AS (SELECT * FROM a UNION ALL SELECT * FROM a2 UNION ALL SELECT 'macro', avg(auroc), avg(auprc) FROM a WHERE auroc >= 0) SELECT name, round(auroc, 6) AS auroc, round(auprc, 6) AS auprc FROM u")
def q_micro_macro(spark: SparkSession, d: str) -> DataFrame:
    return V.micro_macro(_scored(spark, d, ["l_returnflag"], F.col("l_linestatus") == "O", "l_tax"), "l_returnflag")


@query(f"WITH {_areas('l_suppkey', chr(39).join(['l_returnflag = ', 'R', '']), 'l_discount')} SELECT 'auroc' AS metric, count(*) AS n, round(avg(auroc), 6) AS mean, round(stddev_pop(auroc), 6) AS std FROM a UNION ALL SELECT 'auprc', count(*), round(avg(auprc), 6), round(stddev_pop(auprc), 6) FROM a")
def q_metric_summary(spark: SparkSession, d: str) -> DataFrame:
    return V.summary(V.areas(_scored(spark, d, ["l_suppkey"], F.col("l_returnflag") == "R", "l_discount"), ["l_suppkey"]), [], ["auroc", "auprc"])


_RUNS = """s AS (SELECT l_returnflag, l_linenumber, CASE WHEN l_linestatus = 'O' THEN 1 ELSE 0 END AS label, l_tax AS score FROM lineitem),
  r AS (SELECT *, count(*) OVER (w ORDER BY score DESC RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS above, sum(label) OVER (w ORDER BY score DESC RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS hits, rank() OVER (w ORDER BY score) + (count(*) OVER (PARTITION BY l_returnflag, l_linenumber, score) - 1) / 2 AS mr FROM s),
  g AS (SELECT l_returnflag, l_linenumber, sum(label) AS p, sum(1 - label) AS q, sum(mr) FILTER (label = 1) AS ranks, sum(hits / above) FILTER (label = 1) AS precisions FROM r GROUP BY ALL), a AS (SELECT l_returnflag, CASE WHEN p > 0 AND q > 0 THEN (ranks - p * (p + 1) / 2) / (p * q) ELSE -1 END AS auroc, CASE WHEN p > 0 THEN precisions / p ELSE -1 END AS auprc FROM g)""".replace("(w ORDER", "(PARTITION BY l_returnflag, l_linenumber ORDER")


@query(f"WITH {_RUNS} SELECT l_returnflag, 'auroc' AS metric, count(*) AS n, round(avg(auroc), 6) AS mean, round(stddev_pop(auroc), 6) AS std FROM a GROUP BY 1 UNION ALL SELECT l_returnflag, 'auprc', count(*), round(avg(auprc), 6), round(stddev_pop(auprc), 6) FROM a GROUP BY 1")
def q_pooled_areas(spark: SparkSession, d: str) -> DataFrame:
    return V.pooled_areas(_scored(spark, d, ["l_returnflag", "l_linenumber"], F.col("l_linestatus") == "O", "l_tax"), ["l_returnflag"], "l_linenumber")


@query("WITH w AS (SELECT vec_id, embedding, 0.7::DOUBLE * exp(-0.7::DOUBLE * (vec_id % 5)) + 0.2::DOUBLE AS c FROM embeddings) SELECT vec_id, round((1 - c) * embedding[1]::DOUBLE + c * embedding[64]::DOUBLE, 6) AS first, round((1 - c) * embedding[5]::DOUBLE + c * embedding[60]::DOUBLE, 6) AS fifth FROM w")
def q_rarity_blend(spark: SparkSession, d: str) -> DataFrame:
    b = V.blended(F.col("embedding"), F.reverse("embedding"), V.rarity(F.col("vec_id") % 5, 0.7))
    return table(spark, d, "embeddings").select("vec_id", F.round(b[0], 6).alias("first"), F.round(b[4], 6).alias("fifth"))


@query(f"WITH c AS (SELECT DISTINCT o_custkey FROM orders WHERE o_orderstatus = 'O'), p AS (SELECT o_custkey, {_place('o_custkey', 4)} AS place, count(*) OVER () AS n FROM c), a AS (SELECT o_orderkey, place, n FROM orders JOIN p USING (o_custkey) WHERE o_orderstatus = 'O' UNION ALL SELECT o_orderkey, {_place('o_orderkey', 4, 'PARTITION BY o_orderpriority')}, count(*) OVER (PARTITION BY o_orderpriority) FROM orders WHERE o_orderstatus <> 'O') SELECT o_orderkey, CASE WHEN place < floor(n * 0.05::DOUBLE) THEN 'test' WHEN place < floor(n * 0.05::DOUBLE) + floor(n * 0.11875::DOUBLE) THEN 'valid' ELSE 'train' END AS split FROM a")
def q_split_entity_and_rest(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderpriority", "o_orderstatus")
    return V.entity_split(o.where("o_orderstatus <> 'O'"), o.where("o_orderstatus = 'O'").select("o_orderkey", "o_custkey"), "o_custkey", 4, 0.11875, 0.05, "o_orderpriority", "o_orderkey")


@query(f"""WITH {_SUPPLIES}, a AS (SELECT x_id, y_id AS c, source, credibility FROM s WHERE pos % 7 = 0), b AS (SELECT x_id AS c, y_id, credibility, relation FROM (SELECT 'part:' || p_partkey AS x_id, 'brand:' || p_brand AS y_id, 1 + p_size % 3 AS credibility, 'part_of_brand' AS relation FROM part))
SELECT x_id, y_id, 'composed:supplier_supplies_part+part_of_brand' AS relation, 'via:part:' || c AS display_relation, 'composed:' || source || '+catalogue' AS source, least(a.credibility, b.credibility)::BIGINT AS credibility FROM a JOIN b USING (c)""")
def q_composed_paths(spark: SparkSession, d: str) -> DataFrame:
    first = supplies(spark, d).where("pos % 7 = 0")
    second = table(spark, d, "part").selectExpr("concat('part:', p_partkey) AS x_id", "'part' AS x_type", "concat('brand:', p_brand) AS y_id", "'brand' AS y_type", "'part_of_brand' AS relation", "'catalogue' AS source", "1 + p_size % 3 AS credibility")
    return E.composed_paths(first, second).select("x_id", "y_id", "relation", "display_relation", "source", "credibility")


@query(f"WITH {_NODES} SELECT node_type, row_number() OVER (PARTITION BY node_type ORDER BY id) - 1 AS node_index, id, upper(id) AS name FROM (SELECT DISTINCT node_type, id FROM v)")
def q_id_names(spark: SparkSession, d: str) -> DataFrame:
    return V.id_names(nodes(spark, d).withColumn("name", F.upper("id")))


@query("SELECT CASE WHEN o_orderkey % 3 = 0 THEN 'treats' ELSE 'near' END AS relation, o_custkey AS entity, count(*) AS n FROM orders WHERE o_orderstatus = 'O' GROUP BY ALL")
def q_test_entities(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "orders").selectExpr("CASE WHEN o_orderkey % 3 = 0 THEN 'treats' ELSE 'near' END AS relation", "o_custkey AS y_id", "CASE o_orderstatus WHEN 'O' THEN 'test' ELSE 'train' END AS split")
    return V.test_entities(rows)

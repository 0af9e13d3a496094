"""Look-ups, composition and validation over the driver's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import ids
from ..operators import composition as C
from ..operators import edges as E
from ..operators import lookups as L
from ..operators import validate as V
from ..sources.tables import business_edges, node_id, nodes, supplies, table
from .queries import _BUSINESS, _NODES, _SUPPLIES, query


@query("SELECT 'part:' || p_partkey AS id, p_name AS name, CASE WHEN p_brand = 'Brand#2' THEN 'brand' WHEN p_name = 'Brand#2' THEN 'name' ELSE 'name_nocase' END AS match_kind, row_number() OVER (ORDER BY 'part:' || p_partkey) AS rank FROM part WHERE p_brand = 'Brand#2' QUALIFY rank <= 20")
def q_resolve_entity(spark: SparkSession, d: str) -> DataFrame:
    parts = table(spark, d, "part").select(node_id("part", F.col("p_partkey")).alias("id"), F.col("p_name").alias("name"), F.col("p_brand").alias("brand"))
    return L.resolve(parts, "Brand#2", ("brand",)).select("id", "name", "match_kind", "rank")


@query("WITH a AS (SELECT 'part:' || p_partkey AS id, 'part' AS node_type, p_name AS name, unnest(list_concat(['part:' || p_partkey, p_name], string_split(p_name, ' '))) AS alias, unnest(range(2 + len(string_split(p_name, ' ')))) AS pos FROM part UNION ALL SELECT 'supplier:' || s_suppkey, 'supplier', s_name, unnest(['supplier:' || s_suppkey, s_name]), unnest([0, 1]) FROM supplier), s AS (SELECT *, CASE WHEN lower(alias) = 're' THEN 0 WHEN starts_with(lower(alias), 're') THEN 1 WHEN contains(lower(alias), 're') THEN 2 END AS score FROM a), m AS (SELECT * FROM s WHERE score IS NOT NULL QUALIFY row_number() OVER (PARTITION BY id ORDER BY pos) = 1), r AS (SELECT id, node_type, score, alias, name, row_number() OVER (ORDER BY score, node_type, lower(name), id) AS place, count(*) OVER () > 25 AS truncated FROM m) SELECT * FROM r WHERE place <= 25")
def q_alias_search(spark: SparkSession, d: str) -> DataFrame:
    p, s = table(spark, d, "part"), table(spark, d, "supplier")
    part = p.select(node_id("part", F.col("p_partkey")).alias("id"), F.lit("part").alias("node_type"), F.col("p_name").alias("name"), F.posexplode(F.concat(F.array(node_id("part", F.col("p_partkey")), "p_name"), F.split("p_name", " "))).alias("pos", "alias"))
    supplier = s.select(node_id("supplier", F.col("s_suppkey")).alias("id"), F.lit("supplier").alias("node_type"), F.col("s_name").alias("name"), F.posexplode(F.array(node_id("supplier", F.col("s_suppkey")), "s_name")).alias("pos", "alias"))
    return L.alias_search(part.unionByName(supplier), "re")


@query("SELECT l_orderkey, l_linenumber, l_partkey, l_quantity, (SELECT count(*) FROM lineitem WHERE l_suppkey = 1) AS total, CASE WHEN (SELECT count(*) FROM lineitem WHERE l_suppkey = 1) > 20 THEN 20 END::BIGINT AS next_cursor FROM lineitem WHERE l_suppkey = 1 ORDER BY l_orderkey, l_linenumber, l_partkey, l_quantity LIMIT 10 OFFSET 10")
def q_evidence_page(spark: SparkSession, d: str) -> DataFrame:
    keys = ["l_orderkey", "l_linenumber", "l_partkey", "l_quantity"]
    return L.page(table(spark, d, "lineitem").where("l_suppkey = 1").select(keys), keys, 10, 10)


@query(f"WITH {_BUSINESS}, n AS (SELECT 'x' AS side, relation, y_id AS other_id, y_type AS other_type FROM e WHERE x_id = 'nation:3' UNION ALL SELECT 'y', relation, x_id, x_type FROM e WHERE y_id = 'nation:3'), r AS (SELECT *, count(*) OVER (PARTITION BY other_type) AS n_type, row_number() OVER (PARTITION BY other_type ORDER BY other_id, relation, side) AS type_rank FROM n) SELECT * FROM r WHERE type_rank <= 5 ORDER BY other_type, type_rank LIMIT 20")
def q_dossier(spark: SparkSession, d: str) -> DataFrame:
    return L.capped(L.neighbours(business_edges(spark, d), "nation:3"), 5, 20)


@query(f"WITH {_SUPPLIES} SELECT y_id, count(*) AS n_evidence, count(DISTINCT x_id) AS n_suppliers, max(score) AS best_score FROM s GROUP BY y_id ORDER BY n_evidence DESC, y_id LIMIT 50")
def q_most_evidence(spark: SparkSession, d: str) -> DataFrame:
    found = supplies(spark, d).groupBy("y_id").agg(F.count("*").alias("n_evidence"), F.countDistinct("x_id").alias("n_suppliers"), F.max("score").alias("best_score"))
    return found.orderBy(F.desc("n_evidence"), "y_id").limit(50)


@query("SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderpriority = '1-URGENT'")
def q_shard_read(spark: SparkSession, d: str) -> DataFrame:
    return L.shard(table(spark, d, "orders"), "o_orderpriority", "1-URGENT", ["o_orderkey", "o_totalprice"])


_CATALOG = {"region": 2, "nation": 3, "customer": 5, "supplier": 4, "part": 6, "orders": 6, "lineitem": 11, "events": 6, "documents": 5}


@query(" UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS n_rows, (SELECT count(*) FROM (DESCRIBE {t})) AS n_columns FROM {t}" for t in _CATALOG))
def q_catalog(spark: SparkSession, d: str) -> DataFrame:
    out = None
    for t in _CATALOG:
        df = table(spark, d, t)
        one = df.agg(F.count("*").alias("n_rows")).select(F.lit(t).alias("table_name"), "n_rows", F.lit(len(df.columns)).cast("long").alias("n_columns"))
        out = one if out is None else out.unionByName(one)
    return out


_PATHS = """a AS (SELECT 'supplier:' || l_suppkey AS x_id, 'part:' || l_partkey AS mid, list_sort(list(DISTINCT l_returnflag)) AS flags, list_sort(list(DISTINCT l_linestatus)) AS states FROM lineitem GROUP BY ALL),
  b AS (SELECT 'part:' || l_partkey AS mid, 'segment:' || c_mktsegment AS y_id, list_sort(list(DISTINCT l_returnflag)) AS flags, list_sort(list(DISTINCT l_linestatus)) AS states FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey WHERE l_quantity > 40 GROUP BY ALL),
  p AS (SELECT x_id, mid, y_id, a.flags AS af, a.states AS sa, b.flags AS bf, b.states AS sb FROM a JOIN b USING (mid))"""
_COMPATIBLE = "len(af) <= 1 AND len(bf) <= 1 AND af = bf"
_APART = "NOT list_has_any(sa, sb)"


def _paths(spark: SparkSession, d: str) -> DataFrame:
    """Supplier -> part -> market segment, with the flags as context and the states as provenance."""
    li, fields = table(spark, d, "lineitem"), {"flags": "l_returnflag"}
    first = C.with_evidence(li.select(node_id("supplier", F.col("l_suppkey")).alias("x"), node_id("part", F.col("l_partkey")).alias("y"), "l_returnflag", "l_linestatus"), "x", "y", fields, ["l_linestatus"])
    bought = li.where("l_quantity > 40").join(table(spark, d, "orders"), F.col("l_orderkey") == F.col("o_orderkey")).join(table(spark, d, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    second = C.with_evidence(bought.select(node_id("part", F.col("l_partkey")).alias("x"), F.concat(F.lit("segment:"), "c_mktsegment").alias("y"), "l_returnflag", "l_linestatus"), "x", "y", fields, ["l_linestatus"])
    return C.join_premises(first, second)


@query(f"WITH {_PATHS} SELECT x_id, y_id, count(*) AS support, min(sha256('supplier_part_segment|' || x_id || '|' || mid || '|' || y_id)) AS derivation FROM p WHERE {_COMPATIBLE} AND {_APART} GROUP BY ALL")
def q_context_composition(spark: SparkSession, d: str) -> DataFrame:
    return C.candidates(_paths(spark, d).where(C.compatible("flags") & C.shares("flags") & C.independent()), "supplier_part_segment")


@query(f"WITH {_PATHS} SELECT CASE WHEN len(af) > 1 OR len(bf) > 1 THEN 'conflicting' WHEN NOT ({_COMPATIBLE}) THEN 'incompatible' WHEN NOT ({_APART}) THEN 'dependent' ELSE 'accepted' END AS verdict, count(*) AS n FROM p GROUP BY 1")
def q_template_ledger(spark: SparkSession, d: str) -> DataFrame:
    verdict = ids.first_reason((C.conflicting("flags"), "conflicting"), (~C.compatible("flags"), "incompatible"), (~C.independent(), "dependent"))
    return _paths(spark, d).groupBy(F.coalesce(verdict, F.lit("accepted")).alias("verdict")).agg(F.count("*").alias("n"))


@query(f"WITH {_PATHS}, g AS (SELECT x_id, y_id, CASE WHEN len(af) = 1 THEN CASE af[1] WHEN 'A' THEN 1 WHEN 'R' THEN -1 END END * CASE WHEN len(bf) = 1 THEN CASE bf[1] WHEN 'A' THEN 1 WHEN 'R' THEN -1 END END AS s FROM p) SELECT x_id, y_id, CASE WHEN s < 0 THEN 'treats' ELSE 'contraindicates' END AS relation, count(*) AS support FROM g WHERE s IS NOT NULL GROUP BY ALL")
def q_signed_treatment(spark: SparkSession, d: str) -> DataFrame:
    return C.signed(_paths(spark, d), C.sign(F.col("a_flags"), "A", "R"), C.sign(F.col("b_flags"), "A", "R"))


@query("WITH m AS (SELECT p_brand || '/' || p_type AS grp, p_partkey AS member, l_suppkey AS y_id, list(DISTINCT l_returnflag) AS src FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY ALL), k AS (SELECT p_brand || '/' || p_type AS grp FROM part JOIN (SELECT DISTINCT l_partkey FROM lineitem) ON l_partkey = p_partkey GROUP BY 1 HAVING count(*) <= 500), t AS (SELECT DISTINCT a.grp, a.y_id FROM m a JOIN m b ON a.grp = b.grp AND a.y_id = b.y_id AND a.member < b.member WHERE NOT list_has_any(a.src, b.src)) SELECT grp AS \"group\", y_id, count(*) AS n_members FROM m JOIN k USING (grp) JOIN t USING (grp, y_id) GROUP BY ALL")
def q_pathway_candidate(spark: SparkSession, d: str) -> DataFrame:
    held = table(spark, d, "lineitem").groupBy(F.col("l_partkey").alias("p_partkey"), F.col("l_suppkey").alias("y_id")).agg(F.collect_set("l_returnflag").alias("sources"))
    members = held.join(table(spark, d, "part"), "p_partkey").select(F.concat_ws("/", "p_brand", "p_type").alias("group"), F.col("p_partkey").alias("member"), "y_id", "sources")
    return C.group_candidates(members)


@query("WITH a AS (SELECT s_suppkey FROM supplier ORDER BY s_suppkey LIMIT 20), e AS (SELECT DISTINCT l_suppkey AS s, l_partkey AS p FROM lineitem), c AS (SELECT x.s AS anchor, y.s AS other, count(*) AS support FROM e x JOIN a ON x.s = s_suppkey JOIN e y ON x.p = y.p AND x.s <> y.s GROUP BY ALL) SELECT anchor, other, support FROM c JOIN supplier u ON anchor = u.s_suppkey JOIN supplier v ON other = v.s_suppkey WHERE u.s_nationkey <> v.s_nationkey")
def q_template_support(spark: SparkSession, d: str) -> DataFrame:
    s = table(spark, d, "supplier")
    anchors = s.select(F.col("s_suppkey").alias("x_id")).orderBy("x_id").limit(20)
    found = C.shared_neighbours(table(spark, d, "lineitem").select(F.col("l_suppkey").alias("x_id"), F.col("l_partkey").alias("y_id")), anchors).withColumnRenamed("x_id", "other")
    home = lambda c: s.select(F.col("s_suppkey").alias(c), F.col("s_nationkey").alias(f"n_{c}"))
    return found.join(home("anchor"), "anchor").join(home("other"), "other").where("n_anchor <> n_other").select("anchor", "other", "support")


@query(f"WITH {_SUPPLIES} SELECT x_id, 'line:' || p_brand AS y_id, 'supplier_supplies_line' AS relation, max(credibility)::BIGINT AS credibility, count(DISTINCT y_id) AS n_parts FROM s JOIN part ON y_id = 'part:' || p_partkey WHERE score >= 0.05 GROUP BY ALL")
def q_expression_projection(spark: SparkSession, d: str) -> DataFrame:
    mapping = table(spark, d, "part").select(node_id("part", F.col("p_partkey")).alias("part_id"), F.concat(F.lit("line:"), "p_brand").alias("line_id"))
    found = supplies(spark, d).where("score >= 0.05").withColumnRenamed("y_id", "part_id").join(mapping, "part_id")
    return found.groupBy("x_id", F.col("line_id").alias("y_id"), F.lit("supplier_supplies_line").alias("relation")).agg(F.max("credibility").alias("credibility"), F.countDistinct("part_id").alias("n_parts"))


@query("SELECT count(*) AS n, count(*) FILTER (l_quantity NOT BETWEEN 1 AND 50) AS bad_quantity, count(*) FILTER (l_returnflag IS NULL) AS no_source, count(*) FILTER (o_orderkey IS NULL) AS no_order, count(*) FILTER (p_partkey IS NULL) AS no_part FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey LEFT JOIN (SELECT p_partkey FROM part WHERE p_size > 5) ON l_partkey = p_partkey")
def q_relation_artifact(spark: SparkSession, d: str) -> DataFrame:
    rows = V.marked(table(spark, d, "lineitem"), "l_orderkey", table(spark, d, "orders"), "o_orderkey", "has_order")
    rows = V.marked(rows, "l_partkey", table(spark, d, "part").where("p_size > 5"), "p_partkey", "has_part")
    return V.counters(rows, bad_quantity=~F.col("l_quantity").between(1, 50), no_source=F.col("l_returnflag").isNull(), no_order=~F.col("has_order"), no_part=~F.col("has_part"))


@query("SELECT l_orderkey, l_partkey, count(*) - 1 AS excess FROM lineitem GROUP BY ALL HAVING count(*) > 1")
def q_duplicate_identities(spark: SparkSession, d: str) -> DataFrame:
    return V.excess(table(spark, d, "lineitem"), ["l_orderkey", "l_partkey"])


@query("SELECT count(*) AS n, count(*) FILTER (text IS NULL OR text = '') AS empty, count(*) FILTER (length(text) > 5000) AS too_long, count(*) FILTER (l.doc_id IS NULL) AS without_label, round(count(l.doc_id) / count(*), 6) AS coverage FROM documents d LEFT JOIN (SELECT DISTINCT doc_id FROM labels) l USING (doc_id)")
def q_summary_rows(spark: SparkSession, d: str) -> DataFrame:
    rows = V.marked(table(spark, d, "documents"), "doc_id", table(spark, d, "labels"), "doc_id", "labelled")
    t = F.col("text")
    out = V.counters(rows, empty=t.isNull() | (t == ""), too_long=F.length(t) > 5000, without_label=~F.col("labelled"))
    return out.withColumn("coverage", F.round(F.try_divide(F.col("n") - F.col("without_label"), F.col("n")), 6))


@query("WITH i AS (SELECT o_orderkey, date_diff('day', DATE '1990-01-01', o_orderdate::DATE) AS lo, date_diff('day', DATE '1990-01-01', l_shipdate::DATE) AS hi FROM orders JOIN lineitem ON l_orderkey = o_orderkey) SELECT count(*) AS n, count(*) FILTER (lo < 1) AS early, count(*) FILTER (hi < lo) AS reversed, count(*) FILTER (hi - lo > 90) AS wide FROM i")
def q_interval_rows(spark: SparkSession, d: str) -> DataFrame:
    day = lambda c: F.datediff(F.col(c).cast("date"), F.lit("1990-01-01").cast("date"))
    rows = table(spark, d, "orders").join(table(spark, d, "lineitem"), F.col("l_orderkey") == F.col("o_orderkey")).select(day("o_orderdate").alias("lo"), day("l_shipdate").alias("hi"))
    return V.counters(rows, early=F.col("lo") < 1, reversed=F.col("hi") < F.col("lo"), wide=F.col("hi") - F.col("lo") > 90)


@query("WITH b AS (SELECT o_orderkey + 3 * (o_orderkey % 50 = 0)::INT * 10000000 AS k, o_orderpriority AS p, CASE WHEN o_orderkey % 9 = 0 THEN 'X' ELSE o_orderstatus END AS s FROM orders WHERE o_orderkey % 7 <> 0), j AS (SELECT o.o_orderkey AS a, b.k AS b, o.o_orderstatus AS s, b.s AS t FROM orders o FULL JOIN b ON o_orderkey = k) SELECT 'only_a' AS difference, count(*) FILTER (b IS NULL) AS n FROM j UNION ALL SELECT 'only_b', count(*) FILTER (a IS NULL) FROM j UNION ALL SELECT 'status', count(*) FILTER (a IS NOT NULL AND b IS NOT NULL AND s IS DISTINCT FROM t) FROM j")
def q_table_diff(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders").select(F.col("o_orderkey").alias("k"), F.col("o_orderpriority").alias("priority"), F.col("o_orderstatus").alias("status"))
    moved = F.col("k") + 3 * (F.col("k") % 50 == 0).cast("int") * 10000000
    copy = o.where("k % 7 <> 0").select(moved.alias("k"), "priority", F.when(F.col("k") % 9 == 0, "X").otherwise(F.col("status")).alias("status"))
    return V.table_diff(o, copy, "k", ["priority", "status"])


@query("SELECT count(*) AS n, sum(('0x' || substr(md5(concat_ws('|', l_orderkey, l_partkey, l_suppkey, l_linenumber, l_returnflag)), 1, 8))::BIGINT)::BIGINT AS digest FROM lineitem")
def q_receipt_digest(spark: SparkSession, d: str) -> DataFrame:
    return V.digest(table(spark, d, "lineitem"), ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_returnflag"])


@query("WITH a AS (SELECT DISTINCT l_orderkey AS id FROM lineitem), b AS (SELECT o_orderkey AS id FROM orders WHERE o_orderstatus <> 'P') SELECT CASE WHEN b.id IS NULL THEN 'only_a' WHEN a.id IS NULL THEN 'only_b' ELSE 'both' END AS found, count(*) AS n FROM a FULL JOIN b ON a.id = b.id GROUP BY 1")
def q_id_parity(spark: SparkSession, d: str) -> DataFrame:
    return V.id_parity(table(spark, d, "lineitem").select(F.col("l_orderkey").alias("id")), table(spark, d, "orders").where("o_orderstatus <> 'P'").select(F.col("o_orderkey").alias("id")))


@query("SELECT count(*) AS n, min(length(text)) AS shortest, max(length(text)) AS longest, quantile_cont(length(text), 0.25) AS p25, quantile_cont(length(text), 0.5) AS p50, quantile_cont(length(text), 0.75) AS p75, count(*) FILTER (length(text) > 1000) AS over, sum(CASE WHEN length(text) = 0 THEN 0 ELSE greatest(1, ceil((length(text) - 1000) / 500) + 1) END)::BIGINT AS windows FROM documents WHERE text IS NOT NULL")
def q_length_audit(spark: SparkSession, d: str) -> DataFrame:
    return V.length_audit(table(spark, d, "documents"), "text", 1000, 500)


@query(f"WITH {_SUPPLIES}, m AS (SELECT 'part:' || p_partkey AS old, 'part:' || (p_partkey - p_partkey % 2) AS new, p_size % 10 > 1 AS ok FROM part) SELECT (SELECT count(*) FROM s) AS n_before, count(*) FILTER (ok AND n = 1) AS n_after, count(*) FILTER (NOT coalesce(ok, false)) AS n_quarantine, (SELECT count(*) - count(DISTINCT (x_id, new)) FROM s JOIN m ON old = y_id WHERE ok) AS n_collisions, true AS conserved FROM (SELECT x_id, new, ok, row_number() OVER (PARTITION BY x_id, new, ok) AS n FROM s LEFT JOIN m ON old = y_id)")
def q_conservation(spark: SparkSession, d: str) -> DataFrame:
    before = supplies(spark, d)
    p = table(spark, d, "part")
    mapping = p.select(node_id("part", F.col("p_partkey")).alias("old"), node_id("part", F.col("p_partkey") - F.col("p_partkey") % 2).alias("new"), F.when(F.col("p_size") % 10 > 1, "mapped").otherwise("ambiguous").alias("status"))
    moved, apart = E.remap(before, mapping)
    tag = lambda df, name: df.select(F.lit(name).alias("part"))
    ranked = E.collisions(moved)
    parts = tag(before, "before").union(tag(ranked.where("edge_rank = 1"), "after")).union(tag(ranked.where("edge_rank > 1"), "collision")).union(tag(apart, "quarantine"))
    n = parts.agg(*[F.count_if(F.col("part") == k).alias(a) for k, a in (("before", "n_before"), ("after", "n_after"), ("quarantine", "n_quarantine"), ("collision", "n_collisions"))])
    return n.withColumn("conserved", F.expr("n_before = n_after + n_quarantine + n_collisions"))


@query(f"WITH {_BUSINESS}, {_NODES}, c AS (SELECT x_type, y_type, x.id IS NULL OR y.id IS NULL AS bad FROM e LEFT JOIN v x ON x.id = x_id AND x.node_type = x_type LEFT JOIN v y ON y.id = y_id AND y.node_type = y_type) SELECT x_type, y_type, count(*) AS n_edges, count(*) FILTER (bad) AS n_dangling, count(*) FILTER (bad) = 0 AS passed FROM c GROUP BY ALL")
def q_validate_types(spark: SparkSession, d: str) -> DataFrame:
    e, v = business_edges(spark, d), nodes(spark, d).distinct()
    end = lambda s: v.select(F.col("id").alias(f"{s}_id"), F.col("node_type").alias(f"{s}_type"), F.lit(True).alias(f"has_{s}"))
    joined = e.join(end("x"), ["x_id", "x_type"], "left").join(end("y"), ["y_id", "y_type"], "left")
    bad = F.col("has_x").isNull() | F.col("has_y").isNull()
    return joined.groupBy("x_type", "y_type").agg(F.count("*").alias("n_edges"), F.count_if(bad).alias("n_dangling")).withColumn("passed", F.col("n_dangling") == 0)

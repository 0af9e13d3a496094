"""Registered queries over the driver's tables, with the SQL that gives the same rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import ids
from ..operators import edges as E
from ..operators import graph_ml as G
from ..sources.tables import business_edges, edges, nodes, supplies, table

QUERIES: dict = {}
ORACLE_SQL: dict[str, str] = {}

_SUPPLIES = """s AS (SELECT 'supplier:' || l_suppkey AS x_id, 'part:' || l_partkey AS y_id, 'supplier_supplies_part' AS relation, l_returnflag AS source,
  CASE WHEN l_quantity <= 17 THEN 1 WHEN l_quantity <= 34 THEN 2 ELSE 3 END AS credibility, l_orderkey * 10 + l_linenumber AS pos, l_discount AS score, l_orderkey, l_suppkey FROM lineitem)"""
_BUSINESS = """e AS (SELECT 'customer:' || o_custkey AS x_id, 'customer' AS x_type, 'order:' || o_orderkey AS y_id, 'order' AS y_type, 'customer_places_order' AS relation FROM orders
  UNION ALL SELECT 'supplier:' || s_suppkey, 'supplier', 'nation:' || s_nationkey, 'nation', 'supplier_in_nation' FROM supplier
  UNION ALL SELECT 'customer:' || c_custkey, 'customer', 'nation:' || c_nationkey, 'nation', 'customer_in_nation' FROM customer
  UNION ALL SELECT 'nation:' || n_nationkey, 'nation', 'region:' || n_regionkey, 'region', 'nation_in_region' FROM nation
  UNION ALL SELECT 'order:' || l_orderkey, 'order', 'part:' || l_partkey, 'part', 'order_contains_part' FROM lineitem)"""
_NODES = """v AS (SELECT 'part:' || p_partkey AS id, 'part' AS node_type FROM part UNION ALL SELECT 'supplier:' || s_suppkey, 'supplier' FROM supplier UNION ALL SELECT 'customer:' || c_custkey, 'customer' FROM customer
  UNION ALL SELECT 'nation:' || n_nationkey, 'nation' FROM nation UNION ALL SELECT 'region:' || r_regionkey, 'region' FROM region UNION ALL SELECT 'order:' || o_orderkey, 'order' FROM orders)"""


def query(sql: str):
    def register(f):
        QUERIES[f.__name__] = f
        ORACLE_SQL[f.__name__] = sql
        return f

    return register


@query(f"WITH {_SUPPLIES}, f AS (SELECT x_id, y_id, relation, source, min(pos) AS pos, max(credibility) AS c FROM s GROUP BY ALL) SELECT x_id, y_id, relation, string_agg(source, ',' ORDER BY pos) AS source, max(c) AS credibility FROM f GROUP BY x_id, y_id, relation")
def q_edge_dedup_merge(spark: SparkSession, d: str) -> DataFrame:
    return E.merge_edges(supplies(spark, d))


@query(f"WITH {_SUPPLIES} SELECT x_id, y_id, relation, count(*) AS n_evidence, string_agg(DISTINCT source, '; ' ORDER BY source) AS sources, max(score) AS best_score FROM s GROUP BY x_id, y_id, relation")
def q_evidence_summary(spark: SparkSession, d: str) -> DataFrame:
    return E.evidence_summary(supplies(spark, d))


@query(f"WITH {_SUPPLIES}, g AS (SELECT x_id, y_id, count(*) AS n_evidence, string_agg(DISTINCT source, '; ' ORDER BY source) AS sources FROM s GROUP BY x_id, y_id) SELECT x_id AS supplier_id, s_name AS supplier_name, n_name AS nation, y_id AS part_id, p_name AS part_name, n_evidence, sources FROM g JOIN supplier ON x_id = 'supplier:' || s_suppkey JOIN nation ON s_nationkey = n_nationkey LEFT JOIN part ON y_id = 'part:' || p_partkey")
def q_neighbours_with_evidence(spark: SparkSession, d: str) -> DataFrame:
    found = E.evidence_summary(supplies(spark, d)).drop("relation", "best_score")
    names = table(spark, d, "supplier").join(table(spark, d, "nation"), F.col("s_nationkey") == F.col("n_nationkey")).select(F.concat(F.lit("supplier:"), "s_suppkey").alias("x_id"), F.col("s_name").alias("supplier_name"), F.col("n_name").alias("nation"))
    parts = table(spark, d, "part").select(F.concat(F.lit("part:"), "p_partkey").alias("y_id"), F.col("p_name").alias("part_name"))
    return found.join(names, "x_id").join(parts, "y_id", "left").select(F.col("x_id").alias("supplier_id"), "supplier_name", "nation", F.col("y_id").alias("part_id"), "part_name", "n_evidence", "sources")


_PAPERS = """p AS (SELECT x_id, y_id, relation, source, pos, CASE WHEN l_orderkey % 5 > 0 THEN (l_orderkey % 97)::VARCHAR END AS paper, CASE WHEN l_orderkey % 3 = 0 THEN (l_suppkey % 7)::VARCHAR END AS grp,
  CASE WHEN l_orderkey % 11 > 0 THEN score * 10 END AS sc, CASE l_orderkey % 4 WHEN 0 THEN 'known_drug' WHEN 1 THEN 'animal_model' WHEN 2 THEN 'literature' END AS dt, CASE WHEN l_orderkey % 13 = 0 THEN 'reactome' ELSE source END AS src FROM s)"""
_CREDIBILITY = """b AS (SELECT *, row_number() OVER (PARTITION BY x_id, y_id, relation, coalesce(paper, '~' || pos) ORDER BY coalesce(sc, -1e300) DESC, pos) AS n FROM p),
  g AS (SELECT x_id, y_id, relation, bool_or(src IN ('drugbank', 'chembl_indication', 'chembl_moa', 'reactome', 'go', 'mondo', 'hpo')) AS curated, count(DISTINCT grp) FILTER (n = 1) AS groups, count(DISTINCT paper) FILTER (n = 1) AS papers,
    count(DISTINCT src) FILTER (n = 1) AS sources, coalesce(bool_or(sc >= 0.75 AND dt IN ('genetic_association', 'animal_model', 'known_drug', 'clinical_trial')) FILTER (n = 1), false) AS strong FROM b GROUP BY ALL),
  k AS (SELECT x_id, y_id, relation, CASE WHEN curated THEN 3 WHEN (CASE WHEN groups > 0 THEN groups WHEN papers > 0 THEN papers ELSE sources END) >= 2 OR strong THEN 2 ELSE 1 END::BIGINT AS credibility FROM g)"""


def _papers(spark: SparkSession, d: str) -> DataFrame:
    order, supplier = F.floor(F.col("pos") / 10), F.split_part("x_id", F.lit(":"), F.lit(2)).cast("long")
    kind = order % 4
    datatype = F.when(kind == 0, "known_drug").when(kind == 1, "animal_model").when(kind == 2, "literature")
    return supplies(spark, d).withColumns({
        "paper_id": F.when(order % 5 > 0, (order % 97).cast("string")), "author_group_key": F.when(order % 3 == 0, (supplier % 7).cast("string")), "raw_score": F.when(order % 11 > 0, F.col("score") * 10),
        "datatype": datatype, "source": F.when(order % 13 == 0, "reactome").otherwise(F.col("source")),
    })


@query(f"WITH {_SUPPLIES}, {_PAPERS}, {_CREDIBILITY} SELECT * FROM k")
def q_edge_dedup_credibility(spark: SparkSession, d: str) -> DataFrame:
    return E.score_credibility(_papers(spark, d))


@query(f"WITH {_SUPPLIES}, {_PAPERS}, {_CREDIBILITY}, f AS (SELECT x_id, y_id, relation, src, min(pos) AS pos FROM p GROUP BY ALL), t AS (SELECT x_id, y_id, relation, string_agg(src, ',' ORDER BY pos) AS source FROM f GROUP BY ALL), o AS (SELECT x_id, y_id, relation, arg_min(struct_pack(score, paper), pos) AS one FROM (SELECT p.*, s.score FROM p JOIN s USING (x_id, y_id, relation, pos)) GROUP BY ALL) SELECT x_id, y_id, relation, source, credibility, one.score AS score, one.paper AS paper_id FROM k JOIN t USING (x_id, y_id, relation) JOIN o USING (x_id, y_id, relation)")
def q_edge_dedup_evidence(spark: SparkSession, d: str) -> DataFrame:
    return E.dedup_edges(_papers(spark, d)).select("x_id", "y_id", "relation", "source", "credibility", "score", "paper_id")


@query(f"WITH {_SUPPLIES} SELECT x_id, y_id, relation, 'R' AS source, arg_min(credibility, pos)::BIGINT AS credibility, arg_min(score, pos) AS score FROM s WHERE source = 'R' GROUP BY ALL")
def q_edge_dedup_single_source(spark: SparkSession, d: str) -> DataFrame:
    return E.dedup_edges(supplies(spark, d).where("source = 'R'")).select("x_id", "y_id", "relation", "source", "credibility", "score")


@query(f"WITH {_SUPPLIES}, f AS (SELECT x_id, y_id, relation, source, min(pos) AS pos FROM s GROUP BY ALL), t AS (SELECT x_id, y_id, relation, string_agg(source, ',' ORDER BY pos) AS source FROM f GROUP BY ALL), o AS (SELECT x_id, y_id, relation, max(credibility)::BIGINT AS credibility, arg_min(score, pos) AS score FROM s GROUP BY ALL) SELECT * FROM t JOIN o USING (x_id, y_id, relation)")
def q_edge_dedup_many_sources(spark: SparkSession, d: str) -> DataFrame:
    return E.dedup_edges(supplies(spark, d)).select("x_id", "y_id", "relation", "source", "credibility", "score")


@query(f"WITH {_BUSINESS}, {_NODES} SELECT relation, count(*) AS n_edges, count(*) FILTER (x.id IS NULL OR y.id IS NULL) AS n_dangling FROM e LEFT JOIN v x ON x.id = x_id LEFT JOIN v y ON y.id = y_id GROUP BY relation")
def q_dangling_edges(spark: SparkSession, d: str) -> DataFrame:
    return E.dangling(business_edges(spark, d), nodes(spark, d))


@query(f"WITH {_BUSINESS} SELECT DISTINCT id, node_type FROM (SELECT x_id AS id, x_type AS node_type FROM e UNION SELECT y_id, y_type FROM e) WHERE id NOT IN (SELECT 'customer:' || c_custkey FROM customer WHERE c_acctbal >= 0 UNION ALL SELECT 'part:' || p_partkey FROM part WHERE p_size > 10)")
def q_stub_nodes(spark: SparkSession, d: str) -> DataFrame:
    known = table(spark, d, "customer").where("c_acctbal >= 0").select(F.concat(F.lit("customer:"), "c_custkey").alias("id")).union(table(spark, d, "part").where("p_size > 10").select(F.concat(F.lit("part:"), "p_partkey")))
    return E.stubs(business_edges(spark, d), known)


@query("SELECT o.o_orderpriority AS grp, count(*) AS n_edges, count(*) FILTER (l.l_orderkey IS NULL) AS without_evidence FROM orders o LEFT JOIN (SELECT DISTINCT l_orderkey FROM lineitem) l ON l.l_orderkey = o.o_orderkey GROUP BY 1")
def q_edge_evidence_audit(spark: SparkSession, d: str) -> DataFrame:
    held = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), F.lit(1).alias("held")).distinct()
    return table(spark, d, "orders").join(held, "o_orderkey", "left").groupBy(F.col("o_orderpriority").alias("grp")).agg(F.count("*").alias("n_edges"), F.count_if(F.col("held").isNull()).alias("without_evidence"))


#: Id shapes by a number's remainder, one for each label and some that just miss one.
_SHAPES = ("'' || ''", "'  '", "'PMID:' || k", "'CHEMBL' || k", "'DB0' || k", "'DBx' || k", "'CVCL_' || k", "'EH38E' || k", "'R-HSA-' || k", "'rs' || k", "'rsx' || k", "'chr1_' || k || '_A_T'", "'X:' || k || ':ac:g'", "'EFO_' || k", "'GSSO_' || k", "'ABC_' || k", "'ENSG0' || k", "'ENST0' || k", "'ENSP0' || k", "'MONDO:' || k", "' HP:' || k", "'' || k", "'part-' || k")
_SHAPED = "r AS (SELECT l_orderkey AS k, l_returnflag AS node_type, CASE l_orderkey % 23 " + " ".join(f"WHEN {i} THEN {x}" for i, x in enumerate(_SHAPES)) + " END AS id FROM lineitem)"
_LABEL = r"""CASE WHEN id = '' THEN '<blank>' WHEN id LIKE 'PMID:%' THEN 'PMID' WHEN id LIKE 'CHEMBL%' THEN 'ChEMBL' WHEN regexp_full_match(id, 'DB[0-9]+') THEN 'DrugBank' WHEN starts_with(id, 'CVCL_') THEN 'Cellosaurus'
  WHEN id LIKE 'EH38E%' THEN 'ENCODE' WHEN id LIKE 'R-HSA-%' THEN 'Reactome' WHEN regexp_full_match(id, 'rs[0-9]+') THEN 'dbSNP' WHEN regexp_full_match(lower(id), '(chr)?[0-9xym]+[_:-][0-9]+[_:-][acgtn]+[_:-][acgtn]+') THEN 'gnomAD-like'
  WHEN regexp_matches(id, '^(EFO|DOID|CL|HP|GO|MONDO|UBERON|OBA|NCIT|GSSO|MP)_') THEN split_part(id, '_', 1) || '_underscore' WHEN id LIKE 'ENSG%' THEN 'Ensembl Gene' WHEN id LIKE 'ENST%' THEN 'Ensembl Transcript' WHEN id LIKE 'ENSP%' THEN 'Ensembl Protein'
  WHEN contains(id, ':') THEN split_part(id, ':', 1) WHEN regexp_full_match(id, '[0-9]+') THEN 'numeric' ELSE 'unprefixed' END"""


@query(f"WITH {_SHAPED}, t AS (SELECT k, node_type, trim(id) AS id FROM r) SELECT node_type, {_LABEL} AS label, count(*) AS n, min(k) AS sample FROM t GROUP BY ALL")
def q_namespace_coverage(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("l_orderkey")
    shape = F.expr("CASE l_orderkey % 23 " + " ".join(f"WHEN {i} THEN {x.replace(' k', ' l_orderkey')}" for i, x in enumerate(_SHAPES)) + " END")
    return table(spark, d, "lineitem").groupBy(F.col("l_returnflag").alias("node_type"), ids.namespace(shape).alias("label")).agg(F.count("*").alias("n"), F.min(k).alias("sample"))


_RAW = "' EFO_', 'MONDO_', 'HP_', 'OBA_', 'GO_', 'MP_ ', 'NCIT_', 'GSSO_', 'DOID_', 'CL_', 'UBERON_', 'Orphanet_', 'CHEBI_', 'BTO_', 'OTAR_', 'EFO:', 'x EFO_', 'efo_', 'nan', 'None', ' <NA> ', ''"


@query(f"WITH r AS (SELECT l_orderkey, l_linenumber, [{_RAW}][1 + l_orderkey % 22] AS p FROM lineitem), t AS (SELECT l_orderkey, l_linenumber, p || CASE WHEN l_orderkey % 22 >= 18 THEN '' ELSE l_orderkey::VARCHAR END AS raw FROM r) SELECT l_orderkey, l_linenumber, raw, CASE WHEN lower(trim(raw)) IN ('', 'nan', 'none', 'null', '<na>') THEN NULL ELSE regexp_replace(trim(raw), '^(EFO|MONDO|HP|OBA|GO|MP|NCIT|GSSO|DOID|CL|UBERON|Orphanet)_([A-Za-z0-9]+)$', '\\1:\\2') END AS curie FROM t")
def q_curie_normalise(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("l_orderkey") % 22
    raw = F.concat(F.expr(f"array({_RAW})")[k.cast("int")], F.when(k >= 18, "").otherwise(F.col("l_orderkey").cast("string")))
    return table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", raw.alias("raw")).withColumn("curie", ids.normalize_curie(F.col("raw")))


_MAP = "m AS (SELECT 'part:' || p_partkey AS old, 'part:' || (p_partkey - p_partkey % 2) AS new, CASE p_size % 10 WHEN 0 THEN 'ambiguous' WHEN 1 THEN 'retired' ELSE 'mapped' END AS status FROM part)"


def _mapped(spark: SparkSession, d: str):
    p, kind = table(spark, d, "part"), F.col("p_size") % 10
    mapping = p.select(F.concat(F.lit("part:"), "p_partkey").alias("old"), F.concat(F.lit("part:"), F.col("p_partkey") - F.col("p_partkey") % 2).alias("new"), F.when(kind == 0, "ambiguous").when(kind == 1, "retired").otherwise("mapped").alias("status"))
    return E.remap(supplies(spark, d), mapping)


@query(f"WITH {_SUPPLIES}, {_MAP} SELECT coalesce(status, 'unmapped') AS status, source, count(*) AS n FROM s LEFT JOIN m ON old = y_id WHERE coalesce(status, '') <> 'mapped' GROUP BY ALL")
def q_remap_quarantine(spark: SparkSession, d: str) -> DataFrame:
    return _mapped(spark, d)[1].groupBy("status", "source").agg(F.count("*").alias("n"))


@query(f"WITH {_SUPPLIES}, {_MAP} SELECT x_id, new AS y_id, pos, credibility, row_number() OVER (PARTITION BY x_id, new ORDER BY credibility DESC NULLS LAST, source DESC, pos) AS edge_rank, count(*) OVER (PARTITION BY x_id, new) AS edge_count FROM s JOIN m ON old = y_id WHERE status = 'mapped'")
def q_remap_lineage(spark: SparkSession, d: str) -> DataFrame:
    return E.collisions(_mapped(spark, d)[0]).select("x_id", "y_id", "pos", "credibility", "edge_rank", "edge_count")


@query("WITH o AS (SELECT o_custkey AS k, o_orderkey AS id, date_diff('day', DATE '1970-01-01', o_orderdate::DATE) AS lo FROM orders) SELECT a.k AS custkey, a.id AS order_a, b.id AS order_b FROM o a JOIN o b ON a.k = b.k AND a.id < b.id AND a.lo <= b.lo + 30 AND b.lo <= a.lo + 30")
def q_interval_overlap(spark: SparkSession, d: str) -> DataFrame:
    day = F.datediff(F.col("o_orderdate").cast("date"), F.lit("1970-01-01").cast("date"))
    o = table(spark, d, "orders").select(F.col("o_custkey").alias("custkey"), F.col("o_orderkey").alias("id"), day.alias("lo"), (day + 30).alias("hi"))
    a, b = (o.select("custkey", F.col("id").alias(f"order_{s}"), F.col("lo").alias(f"lo_{s}"), F.col("hi").alias(f"hi_{s}")) for s in "ab")
    return E.overlaps(a, b, "custkey", 30).where("order_a < order_b").select("custkey", "order_a", "order_b")


@query("WITH t AS (SELECT DISTINCT unnest(string_split(lower(p_name), ' ')) AS alias, p_partkey AS id FROM part) SELECT alias, count(DISTINCT id) AS n_ids, min(id) AS first_id, CASE WHEN count(DISTINCT id) = 1 THEN 'unambiguous' ELSE 'ambiguous' END AS kind FROM t GROUP BY alias")
def q_resolver_ambiguity(spark: SparkSession, d: str) -> DataFrame:
    return E.resolver_classes(table(spark, d, "part").select(F.explode(F.split(F.lower("p_name"), " ")).alias("alias"), F.col("p_partkey").alias("id")))


_BUYS = "b AS (SELECT o_custkey AS c, l_suppkey AS s, count(*) AS support FROM orders JOIN lineitem ON l_orderkey = o_orderkey GROUP BY ALL)"


def _buys(spark: SparkSession, d: str) -> DataFrame:
    one = F.lit(1).cast("long")
    places = edges(table(spark, d, "orders"), "customer_places_order", ("customer", "o_custkey"), ("order", "o_orderkey"), credibility=one)
    filled = edges(table(spark, d, "lineitem"), "order_filled_by_supplier", ("order", "l_orderkey"), ("supplier", "l_suppkey"), credibility=one)
    return G.compose(places, filled, "customer_buys_from_supplier")


@query(f"WITH {_BUYS} SELECT 'customer:' || c AS x_id, 'supplier:' || s AS y_id, support, 1 AS credibility, 'customer_buys_from_supplier' AS relation FROM b")
def q_compose_two_hop(spark: SparkSession, d: str) -> DataFrame:
    return _buys(spark, d)


@query(f"WITH {_BUYS} SELECT 'customer:' || c AS x_id, 'supplier:' || s AS y_id, support FROM b JOIN customer ON c = c_custkey JOIN supplier ON s = s_suppkey WHERE c_nationkey = s_nationkey")
def q_triangle_view(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "customer").select(F.concat(F.lit("customer:"), "c_custkey").alias("x_id"), F.col("c_nationkey").alias("n"))
    s = table(spark, d, "supplier").select(F.concat(F.lit("supplier:"), "s_suppkey").alias("y_id"), F.col("s_nationkey").alias("n"))
    return _buys(spark, d).join(c, "x_id").join(s, ["y_id", "n"]).select("x_id", "y_id", "support")


@query(f"WITH {_BUYS}, k AS (SELECT DISTINCT o_custkey AS c, l_suppkey AS s FROM orders JOIN lineitem ON l_orderkey = o_orderkey WHERE l_returnflag = 'R') SELECT 'customer:' || c AS x_id, 'supplier:' || s AS y_id, support FROM b ANTI JOIN k USING (c, s)")
def q_novel_candidates(spark: SparkSession, d: str) -> DataFrame:
    seen = table(spark, d, "orders").join(table(spark, d, "lineitem").where("l_returnflag = 'R'"), F.col("l_orderkey") == F.col("o_orderkey")).select(F.concat(F.lit("customer:"), "o_custkey").alias("x_id"), F.concat(F.lit("supplier:"), "l_suppkey").alias("y_id"))
    return G.novel(_buys(spark, d), seen).select("x_id", "y_id", "support")


@query("SELECT CASE WHEN l_discount > 0.08 THEN 'discount' WHEN l_quantity < 5 THEN 'quantity' WHEN l_returnflag = 'R' THEN 'returned' ELSE 'accepted' END AS reason, count(*) AS n FROM lineitem GROUP BY 1")
def q_reject_ledger(spark: SparkSession, d: str) -> DataFrame:
    reason = ids.first_reason((F.col("l_discount") > 0.08, "discount"), (F.col("l_quantity") < 5, "quantity"), (F.col("l_returnflag") == "R", "returned"))
    return table(spark, d, "lineitem").groupBy(F.coalesce(reason, F.lit("accepted")).alias("reason")).agg(F.count("*").alias("n"))


@query("SELECT l_suppkey, l_orderkey, l_linenumber, n FROM (SELECT *, row_number() OVER (PARTITION BY l_suppkey ORDER BY l_quantity DESC, l_orderkey, l_linenumber) AS n FROM lineitem) WHERE n <= 5")
def q_top_n_per_group(spark: SparkSession, d: str) -> DataFrame:
    w = Window.partitionBy("l_suppkey").orderBy(F.desc("l_quantity"), "l_orderkey", "l_linenumber")
    return table(spark, d, "lineitem").select("l_suppkey", "l_orderkey", "l_linenumber", F.row_number().over(w).alias("n"), "l_quantity").where("n <= 5").drop("l_quantity")


@query("SELECT l_orderkey, l_linenumber, unnest(['l_discount', 'l_tax']) AS source, unnest([l_discount, l_tax]) AS value FROM lineitem WHERE l_discount >= 0.06 AND l_tax >= 0.06 UNION ALL SELECT l_orderkey, l_linenumber, 'l_discount', l_discount FROM lineitem WHERE l_discount >= 0.06 AND l_tax < 0.06 UNION ALL SELECT l_orderkey, l_linenumber, 'l_tax', l_tax FROM lineitem WHERE l_tax >= 0.06 AND l_discount < 0.06")
def q_unpivot_threshold(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "lineitem").unpivot(["l_orderkey", "l_linenumber"], ["l_discount", "l_tax"], "source", "value").where("value >= 0.06")


@query(f"WITH {_NODES} SELECT node_type, id, row_number() OVER (PARTITION BY node_type ORDER BY id) - 1 AS node_index FROM v")
def q_index_nodes(spark: SparkSession, d: str) -> DataFrame:
    return G.dense_index(nodes(spark, d))


@query(f"WITH {_BUSINESS} SELECT y_id AS x_id, y_type AS x_type, x_id AS y_id, x_type AS y_type, CASE WHEN x_type = y_type THEN relation ELSE 'rev_' || relation END AS relation FROM e")
def q_reverse_edges(spark: SparkSession, d: str) -> DataFrame:
    return G.reversed_edges(business_edges(spark, d))


@query("SELECT DISTINCT least(a.user_id, b.user_id) AS x_id, greatest(a.user_id, b.user_id) AS y_id FROM events a JOIN events b ON b.event_id = a.event_id + 1 WHERE a.user_id <> b.user_id")
def q_directed_dedup(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events")
    follows = e.select("event_id", F.col("user_id").alias("x_id")).join(e.select((F.col("event_id") - 1).alias("event_id"), F.col("user_id").alias("y_id")), "event_id")
    return G.undirected(follows)


@query("WITH k AS (SELECT event_id, event_type, row_number() OVER (PARTITION BY event_type ORDER BY sha256('7|' || event_id), event_id) AS r, count(*) OVER (PARTITION BY event_type) AS n FROM events) SELECT event_id, event_type, CASE WHEN r <= floor(n * 0.1) THEN 'test' WHEN r <= floor(n * 0.1) + floor(n * 0.2) THEN 'valid' ELSE 'train' END AS split FROM k")
def q_split_random(spark: SparkSession, d: str) -> DataFrame:
    return G.split(table(spark, d, "events").select("event_id", "event_type"), "event_type", "event_id", 7, 0.2, 0.1)


@query("WITH s AS (SELECT (l_returnflag = 'R')::INT AS label, l_discount * 10 AS score FROM lineitem), c AS (SELECT count(*) FILTER (score >= 0.5 AND label = 1) AS tp, count(*) FILTER (score >= 0.5 AND label = 0) AS fp, count(*) FILTER (score < 0.5 AND label = 1) AS fn, count(*) FILTER (score < 0.5 AND label = 0) AS tn FROM s) SELECT tp, fp, fn, tn, round((tp + tn) / (tp + tn + fp + fn), 6) AS accuracy, round(tp / (tp + fn), 6) AS sensitivity, round(tn / (tn + fp), 6) AS specificity, round(tp / (tp + fp), 6) AS ppv, round(2 * tp / (2 * tp + fp + fn), 6) AS f1, round(tn / nullif(tn + fn, 0), 6) AS npv, round(fp / nullif(fp + tn, 0), 6) AS fpr, round(fn / nullif(tp + fn, 0), 6) AS fnr, round(fp / nullif(tp + fp, 0), 6) AS fdr FROM c")
def q_threshold_metrics(spark: SparkSession, d: str) -> DataFrame:
    return G.threshold_metrics(table(spark, d, "lineitem").select((F.col("l_returnflag") == "R").cast("int").alias("label"), (F.col("l_discount") * 10).alias("score")))


@query("WITH s AS (SELECT l_suppkey, l_orderkey * 10 + l_linenumber AS id, (l_returnflag = 'R')::INT AS label, l_discount AS score FROM lineitem), r AS (SELECT *, rank() OVER (PARTITION BY l_suppkey ORDER BY score) + (count(*) OVER (PARTITION BY l_suppkey, score) - 1) / 2 AS mr, row_number() OVER (PARTITION BY l_suppkey ORDER BY score DESC, id) AS top FROM s), g AS (SELECT l_suppkey, count(*) FILTER (label = 1) AS n_pos, count(*) FILTER (label = 0) AS n_neg, sum(mr) FILTER (label = 1) AS ranks, count(*) FILTER (label = 1 AND top <= 10) AS hits, min(top) FILTER (label = 1 AND top <= 10) AS first FROM r GROUP BY 1) SELECT l_suppkey, n_pos, n_neg, round(CASE WHEN n_pos > 0 AND n_neg > 0 THEN (ranks - n_pos * (n_pos + 1) / 2) / (n_pos * n_neg) ELSE -1 END, 6) AS auroc, round(CASE WHEN n_pos > 0 THEN hits / n_pos ELSE -1 END, 6) AS recall_at_k, round(CASE WHEN n_pos > 0 THEN coalesce(1 / first, 0) ELSE -1 END, 6) AS mrr_at_k FROM g")
def q_rank_metrics(spark: SparkSession, d: str) -> DataFrame:
    scored = table(spark, d, "lineitem").select("l_suppkey", (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id"), (F.col("l_returnflag") == "R").cast("int").alias("label"), F.col("l_discount").alias("score"))
    return G.ranking_metrics(scored, "l_suppkey", 10)


@query("SELECT query_id, vec_id, cosine, rank FROM (SELECT a.vec_id AS query_id, b.vec_id, round(list_cosine_similarity(a.embedding::DOUBLE[], b.embedding::DOUBLE[]), 6) AS cosine, row_number() OVER (PARTITION BY a.vec_id ORDER BY round(list_cosine_similarity(a.embedding::DOUBLE[], b.embedding::DOUBLE[]), 6) DESC, b.vec_id) AS rank FROM embeddings a JOIN embeddings b ON a.vec_id <> b.vec_id WHERE a.vec_id % 20 = 0) WHERE rank <= 10")
def q_knn_cosine(spark: SparkSession, d: str) -> DataFrame:
    return G.knn_all(table(spark, d, "embeddings"), F.col("vec_id") % 20 == 0, 10)


@query("WITH l AS (SELECT vec_id AS src, label AS dst, unnest(embedding) AS value, unnest(range(len(embedding))) AS dim FROM embeddings) SELECT dst, dim, round(avg(value::DOUBLE), 6) AS value FROM l WHERE dst IS NOT NULL GROUP BY ALL")
def q_message_mean(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "embeddings")
    out = G.mean_messages(e.where("label IS NOT NULL").select(F.col("vec_id").alias("src"), F.col("label").alias("dst")), e.select(F.col("vec_id").alias("id"), F.col("embedding").alias("vector")))
    return out.withColumn("value", F.round("value", 6))


@query("SELECT count(*) AS n, count(*) FILTER (len(embedding) <> 64) AS wrong_dim, count(*) FILTER (len(list_filter(embedding, lambda x: NOT isfinite(x))) > 0) AS non_finite, count(*) FILTER (len(list_filter(embedding, lambda x: x <> 0)) = 0) AS all_zero, count(*) - count(DISTINCT vec_id) AS duplicate_ids FROM embeddings")
def q_vector_quality(spark: SparkSession, d: str) -> DataFrame:
    v = F.col("embedding")
    return table(spark, d, "embeddings").agg(F.count("*").alias("n"), F.count_if(F.size(v) != 64).alias("wrong_dim"), F.count_if(F.exists(v, lambda x: F.isnan(x) | (F.abs(x) == float("inf")))).alias("non_finite"), F.count_if(F.forall(v, lambda x: x == 0)).alias("all_zero"), (F.count("*") - F.countDistinct("vec_id")).alias("duplicate_ids"))


@query("SELECT doc_id, sha256(concat_ws(chr(10), 'lang: ' || lang, 'source: ' || source, 'text: ' || nullif(text, ''))) AS payload_sha256, length(text) AS chars, (length(text) > 2000)::INT AS over_limit FROM documents")
def q_text_features(spark: SparkSession, d: str) -> DataFrame:
    part = lambda c: F.when(F.col(c) != "", F.concat(F.lit(f"{c}: "), c))
    return table(spark, d, "documents").select("doc_id", F.sha2(F.concat_ws("\n", part("lang"), part("source"), part("text")), 256).alias("payload_sha256"), F.length("text").alias("chars"), (F.length("text") > 2000).cast("int").alias("over_limit"))


@query("SELECT page_id, s AS window_start, least(s + 2000, length(html)) AS window_end FROM (SELECT page_id, html, unnest(range(0, CASE WHEN length(html) = 0 THEN 0 ELSE greatest(0, ceil((length(html) - 2000) / 1000))::BIGINT * 1000 + 1 END, 1000)) AS s FROM pages WHERE html IS NOT NULL)")
def q_sequence_windows(spark: SparkSession, d: str) -> DataFrame:
    n = F.length("html")
    starts = F.sequence(F.lit(0), (F.greatest(F.lit(0), F.ceil((n - 2000) / 1000)) * 1000).cast("int"), F.lit(1000))
    return table(spark, d, "pages").where(n > 0).select("page_id", n.alias("n"), F.explode(starts).alias("window_start")).select("page_id", "window_start", F.least(F.col("window_start") + 2000, "n").alias("window_end"))


@query("SELECT l_partkey AS part, count(DISTINCT l_returnflag) AS n_values, CASE WHEN count(DISTINCT l_returnflag) = 1 THEN 'single' WHEN bool_or(l_returnflag = 'A') AND bool_or(l_returnflag = 'R') THEN 'conflicting' ELSE 'consensus' END AS status FROM lineitem GROUP BY 1")
def q_conflict_status(spark: SparkSession, d: str) -> DataFrame:
    flag = F.col("l_returnflag")
    n = F.countDistinct(flag)
    return table(spark, d, "lineitem").groupBy(F.col("l_partkey").alias("part")).agg(n.alias("n_values"), F.bool_or(flag == "A").alias("a"), F.bool_or(flag == "R").alias("r")).select("part", "n_values", F.when(F.col("n_values") == 1, "single").when(F.col("a") & F.col("r"), "conflicting").otherwise("consensus").alias("status"))

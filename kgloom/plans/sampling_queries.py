"""Splits, negatives, walks and ingest over the driver's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import ids, text
from ..operators import evaluation as V
from ..operators import graph_ml as G
from ..operators import sampling as S
from ..sources.tables import business_edges, node_id, nodes, supplies, table
from .queries import _BUSINESS, _NODES, query

_DRAW = "('0x' || substr(sha256(concat_ws('|', {})), 1, 12))::BIGINT"


@query(f"WITH {_BUSINESS}, {_NODES}, i AS (SELECT *, row_number() OVER (PARTITION BY node_type ORDER BY id) - 1 AS k FROM v) SELECT relation, x.k AS src_index, y.k AS dst_index FROM e JOIN i x ON x.id = x_id JOIN i y ON y.id = y_id")
def q_index_edges(spark: SparkSession, d: str) -> DataFrame:
    index = G.dense_index(nodes(spark, d))
    end = lambda s, name: index.select(F.col("id").alias(f"{s}_id"), F.col("node_index").alias(name))
    return business_edges(spark, d).join(end("x", "src_index"), "x_id").join(end("y", "dst_index"), "y_id").select("relation", "src_index", "dst_index")


def _customers(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "customer").select("c_custkey")


_PLACED = "c AS (SELECT c_custkey, row_number() OVER (ORDER BY sha256('11|' || c_custkey)) - 1 AS place, (SELECT count(*) FROM customer) AS n FROM customer)"
_SPLIT = "CASE WHEN place < floor(n * 0.1) THEN 'test' WHEN place < floor(n * 0.1) + floor(n * 0.2) THEN 'valid' ELSE 'train' END AS split"


@query(f"WITH {_PLACED} SELECT o_orderkey, {_SPLIT} FROM orders JOIN c ON o_custkey = c_custkey")
def q_split_entity(spark: SparkSession, d: str) -> DataFrame:
    parts = S.split_entities(_customers(spark, d), "c_custkey", 11, 0.2, 0.1)
    return table(spark, d, "orders").join(parts, F.col("o_custkey") == F.col("c_custkey")).select("o_orderkey", "split")


@query(f"WITH {_PLACED} SELECT c_custkey, floor(place * 20 / n)::BIGINT AS fold FROM c")
def q_split_folds(spark: SparkSession, d: str) -> DataFrame:
    return S.folds(_customers(spark, d), "c_custkey", 11, 20)


@query("WITH o AS (SELECT o_orderkey, c_mktsegment = 'BUILDING' AS held FROM orders JOIN customer ON o_custkey = c_custkey), r AS (SELECT o_orderkey, row_number() OVER (ORDER BY sha256('13|' || o_orderkey)) - 1 AS place, count(*) OVER () AS n FROM o WHERE NOT held) SELECT o_orderkey, 'test' AS split FROM o WHERE held UNION ALL SELECT o_orderkey, CASE WHEN place < floor(n * 0.05) THEN 'valid' ELSE 'train' END FROM r")
def q_split_holdout(spark: SparkSession, d: str) -> DataFrame:
    listed = table(spark, d, "customer").where("c_mktsegment = 'BUILDING'").select(F.col("c_custkey").alias("o_custkey"))
    orders = table(spark, d, "orders").join(_customers(spark, d), F.col("o_custkey") == F.col("c_custkey"), "left_semi").select("o_orderkey", "o_custkey")
    return S.holdout(orders, "o_custkey", listed, "o_orderkey", 13, 0.05).select("o_orderkey", "split")


@query("SELECT o_custkey, count(*) AS n_edges, CASE WHEN count(*) <= 3 THEN 'test' ELSE 'train' END AS split FROM orders GROUP BY 1")
def q_split_few_edges(spark: SparkSession, d: str) -> DataFrame:
    return S.few_edges(table(spark, d, "orders"), "o_custkey", 3)


def _supplied(spark: SparkSession, d: str) -> DataFrame:
    return supplies(spark, d).select("x_id", "y_id").distinct()


_E = "e AS (SELECT DISTINCT 'supplier:' || l_suppkey AS x_id, 'part:' || l_partkey AS y_id FROM lineitem)"


@query(f"WITH {_E}, t AS (SELECT 'part:' || p_partkey AS id, row_number() OVER (ORDER BY 'part:' || p_partkey) - 1 AS k FROM part), q AS (SELECT x_id, {_DRAW.format(repr('17') + ', x_id, y_id, j')} % (SELECT count(*) FROM part) AS k FROM e, (SELECT unnest([0, 1]) AS j)), n AS (SELECT DISTINCT x_id, id AS y_id FROM q JOIN t USING (k)) SELECT x_id, y_id FROM n ANTI JOIN e USING (x_id, y_id)")
def q_negatives_filtered(spark: SparkSession, d: str) -> DataFrame:
    return S.corrupt_targets(_supplied(spark, d), table(spark, d, "part").select(node_id("part", F.col("p_partkey")).alias("y_id")), 2, 17)


@query(f"WITH {_E}, w AS (SELECT y_id AS id, floor(pow(count(*), 0.75) * 1000)::BIGINT AS w FROM e GROUP BY 1), c AS (SELECT id, sum(w) OVER (ORDER BY id)::BIGINT AS hi, w FROM w), q AS (SELECT x_id, y_id, {_DRAW.format(repr('19') + ', x_id, y_id, 0')} % (SELECT sum(w)::BIGINT FROM w) AS spot FROM e) SELECT x_id, y_id, 0 AS copy, id AS negative FROM q ASOF JOIN (SELECT id, hi - w AS lo FROM c) ON spot >= lo")
def q_negatives_weighted(spark: SparkSession, d: str) -> DataFrame:
    return S.weighted_targets(_supplied(spark, d), 1, 19)


@query(f"WITH {_E}, t AS (SELECT 'supplier:' || s_suppkey AS id, row_number() OVER (ORDER BY 'supplier:' || s_suppkey) - 1 AS k FROM supplier), q AS (SELECT y_id, {_DRAW.format(repr('29') + ', y_id, x_id, j')} % (SELECT count(*) FROM supplier) AS k FROM e, (SELECT unnest([0, 1]) AS j)), n AS (SELECT DISTINCT id AS x_id, y_id FROM q JOIN t USING (k)) SELECT x_id, y_id FROM n ANTI JOIN e USING (x_id, y_id)")
def q_negatives_sources(spark: SparkSession, d: str) -> DataFrame:
    return S.corrupt_sources(_supplied(spark, d), table(spark, d, "supplier").select(node_id("supplier", F.col("s_suppkey")).alias("x_id")), 2, 29)


@query(f"WITH {_E}, t AS (SELECT 'supplier:' || s_suppkey AS a, row_number() OVER (ORDER BY 'supplier:' || s_suppkey) - 1 AS k FROM supplier), u AS (SELECT 'part:' || p_partkey AS b, row_number() OVER (ORDER BY 'part:' || p_partkey) - 1 AS l FROM part), q AS (SELECT {_DRAW.format(repr('31') + ', x_id, y_id, j')} % (SELECT count(*) FROM supplier) AS k, {_DRAW.format(repr('32') + ', x_id, y_id, j')} % (SELECT count(*) FROM part) AS l FROM e, (SELECT unnest([0, 1]) AS j)), n AS (SELECT DISTINCT a AS x_id, b AS y_id FROM q JOIN t USING (k) JOIN u USING (l)) SELECT x_id, y_id FROM n ANTI JOIN e USING (x_id, y_id)")
def q_negatives_both(spark: SparkSession, d: str) -> DataFrame:
    ends = table(spark, d, "supplier").select(node_id("supplier", F.col("s_suppkey")).alias("x_id")), table(spark, d, "part").select(node_id("part", F.col("p_partkey")).alias("y_id"))
    return S.corrupt_both(_supplied(spark, d), *ends, 2, 31)


@query(f"WITH {_E}, w AS (SELECT x_id AS id, floor(pow(count(*), 0.75) * 1000)::BIGINT AS w FROM e GROUP BY 1), c AS (SELECT id, sum(w) OVER (ORDER BY id)::BIGINT AS hi, w FROM w), q AS (SELECT x_id, y_id, {_DRAW.format(repr('37') + ', y_id, x_id, 0')} % (SELECT sum(w)::BIGINT FROM w) AS spot FROM e) SELECT x_id, y_id, 0 AS copy, id AS negative FROM q ASOF JOIN (SELECT id, hi - w AS lo FROM c) ON spot >= lo")
def q_negatives_weighted_sources(spark: SparkSession, d: str) -> DataFrame:
    return S.weighted_sources(_supplied(spark, d), 1, 37)


@query(f"WITH {_BUSINESS}, b AS (SELECT x_id AS id, y_id AS nx FROM e UNION SELECT y_id, x_id FROM e), h1 AS (SELECT DISTINCT nx AS id FROM b WHERE id = 'region:1'), h2 AS (SELECT DISTINCT nx AS id FROM b WHERE id IN (SELECT id FROM h1)) SELECT 'region:1' AS id, 0 AS hops UNION ALL SELECT id, 1 FROM h1 UNION ALL SELECT id, 2 FROM h2 WHERE id <> 'region:1' AND id NOT IN (SELECT id FROM h1)")
def q_two_hop_subgraph(spark: SparkSession, d: str) -> DataFrame:
    return S.k_hop(business_edges(spark, d), nodes(spark, d).where("id = 'region:1'"), 2)


@query("WITH RECURSIVE t AS (SELECT p_partkey AS id, 0 AS depth FROM part WHERE p_partkey = 3 UNION ALL SELECT p_partkey, depth + 1 FROM t JOIN part ON p_partkey // 2 = id AND p_partkey > 0) SELECT id, depth FROM t")
def q_closure(spark: SparkSession, d: str) -> DataFrame:
    p = table(spark, d, "part").where("p_partkey > 0").select(F.col("p_partkey").alias("child"), F.floor(F.col("p_partkey") / 2).alias("parent"))
    return S.descendants(p, table(spark, d, "part").where("p_partkey = 3").select(F.col("p_partkey").alias("id")))


def _step(n: int) -> str:
    pick = _DRAW.format(f"'23', start, walk, {n}")
    return f"s{n} AS MATERIALIZED (SELECT start, walk, {n} AS step, g.nx AS here FROM (SELECT start, walk, s.here, {pick} % deg AS way FROM s{n - 1} s JOIN deg ON deg.here = s.here) p JOIN g ON g.here = p.here AND g.way = p.way)"


@query(f"WITH {_E}, b AS MATERIALIZED (SELECT x_id AS here, y_id AS nx FROM e UNION SELECT y_id, x_id FROM e), g AS MATERIALIZED (SELECT here, nx, row_number() OVER (PARTITION BY here ORDER BY nx) - 1 AS way FROM b), deg AS MATERIALIZED (SELECT here, count(*) AS deg FROM b GROUP BY 1), s0 AS MATERIALIZED (SELECT x_id AS start, unnest([0, 1]) AS walk, 0 AS step, x_id AS here FROM (SELECT DISTINCT x_id FROM e)), {_step(1)}, {_step(2)}, {_step(3)} SELECT start, walk, step, here AS \"at\" FROM (SELECT * FROM s0 UNION ALL SELECT * FROM s1 UNION ALL SELECT * FROM s2 UNION ALL SELECT * FROM s3)")
def q_random_walk(spark: SparkSession, d: str) -> DataFrame:
    return S.walk(_supplied(spark, d), 2, 3, 23)


@query(f"WITH {_E}, z AS (SELECT x_id, count(*) AS n FROM e GROUP BY 1), c AS (SELECT a.x_id, b.x_id AS other, count(*) AS common FROM e a JOIN e b ON a.y_id = b.y_id AND a.x_id <> b.x_id GROUP BY ALL), s AS (SELECT c.x_id, other, common, round(common / sqrt(u.n * w.n), 6) AS cosine FROM c JOIN z u ON u.x_id = c.x_id JOIN z w ON w.x_id = other) SELECT x_id, other, common, cosine, row_number() OVER (PARTITION BY x_id ORDER BY cosine DESC, other) AS n FROM s QUALIFY n <= 5")
def q_profile_topk(spark: SparkSession, d: str) -> DataFrame:
    return S.profile_similarity(_supplied(spark, d), 5)


@query("WITH r AS (SELECT embedding AS r FROM embeddings WHERE vec_id = 0), p AS (SELECT a.vec_id AS u, b.vec_id AS v, list_sum(list_transform(list_zip(a.embedding, b.embedding, r.r), lambda t: t[1]::DOUBLE * t[2]::DOUBLE * t[3]::DOUBLE)) AS s FROM embeddings a JOIN embeddings b ON b.vec_id = a.vec_id + 1, r) SELECT u, v, round(s, 5) AS score, round(1 / (1 + exp(-s)), 5) AS probability FROM p")
def q_distmult(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "embeddings")
    relation = e.where("vec_id = 0").limit(1).select(F.col("embedding").alias("r"))  # one row
    pairs = e.select(F.col("vec_id").alias("u"), F.col("embedding").alias("a")).join(e.select((F.col("vec_id") - 1).alias("u"), F.col("vec_id").alias("v"), F.col("embedding").alias("b")), "u").join(F.broadcast(relation))
    return G.distmult(pairs, "a", "b", "r").select("u", "v", F.round("score", 5).alias("score"), F.round("probability", 5).alias("probability"))


@query("WITH l AS (SELECT DISTINCT s_nationkey AS n FROM supplier), t AS (SELECT DISTINCT p_partkey AS part, n FROM part, l), k AS (SELECT l_partkey AS part, s_nationkey AS n, bool_or(l_linestatus = 'O') AS test FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY ALL) SELECT part, n AS nation, CASE WHEN test THEN 1 WHEN test IS NOT NULL THEN -1 ELSE 0 END AS label FROM t LEFT JOIN k USING (part, n)")
def q_evaluation_pairs(spark: SparkSession, d: str) -> DataFrame:
    seen = table(spark, d, "lineitem").join(table(spark, d, "supplier"), F.col("l_suppkey") == F.col("s_suppkey")).select(F.col("s_nationkey").alias("entity"), F.col("l_partkey").alias("item"), (F.col("l_linestatus") == "O").alias("test"))
    found = V.evaluation_pairs(table(spark, d, "supplier").select(F.col("s_nationkey").alias("entity")), table(spark, d, "part").select(F.col("p_partkey").alias("item")), seen)
    return found.select(F.col("item").alias("part"), F.col("entity").alias("nation"), "label")


_STATES = ("Completed", "Terminated", "Suspended", "Withdrawn", "Recruiting", "Active, not recruiting", "active not recruiting", "Enrolling by invitation", "Unknown status")
_REASONS = ("", "Serious adverse events", "Sponsor decision", "slow accrual", "Lack of effect", "did not meet Primary Endpoint", "moved abroad")
_TRIAL = """CASE WHEN regexp_matches(r, 'safety|adverse|toxicity|toxic|death|mortality|harm') THEN 'safety_failure_or_harm'
  WHEN regexp_matches(r, 'business|commercial|strategic|portfolio|sponsor|funding|financial|resource|administrative|recruitment|enrollment|accrual|slow|feasibility') THEN 'terminated_business_funding_or_feasibility'
  WHEN regexp_matches(r, 'efficacy|futility|lack of effect|lack of efficacy|ineffective|not effective|no benefit|endpoint|failed') THEN 'failed_efficacy_or_endpoint'
  WHEN s IN ('TERMINATED', 'SUSPENDED') THEN 'terminated_unknown_reason' WHEN s = 'WITHDRAWN' THEN 'withdrawn_unknown_reason'
  WHEN s IN ('RECRUITING', 'ENROLLING_BY_INVITATION', 'NOT_YET_RECRUITING', 'ACTIVE_NOT_RECRUITING') THEN 'active_or_recruiting_unknown_outcome' WHEN s = 'COMPLETED' THEN 'completed_outcome_unknown' ELSE 'unknown_trial_trajectory' END"""


@query(f"WITH o AS (SELECT *, upper(replace({list(_STATES)}[1 + o_orderkey % 9], ' ', '_')) AS s, lower({list(_REASONS)}[1 + o_custkey % 7]) AS r FROM orders) SELECT o_orderkey, sha256(concat_ws('|', o_orderkey, o_custkey, o_orderstatus)) AS record_id, {_TRIAL} AS trial, [o_orderkey::VARCHAR, (o_orderkey + 1)::VARCHAR] AS pmids, '10.1000/ab.' || o_orderkey AS doi FROM o")
def q_record_fields(spark: SparkSession, d: str) -> DataFrame:
    o, pick = table(spark, d, "orders"), lambda xs, k: F.array(*map(F.lit, xs))[(F.col(k) % len(xs)).cast("int")]
    tokens = F.concat(F.lit("pubmed:"), "o_orderkey", F.lit("|doi:10.1|PMID: "), F.col("o_orderkey") + 1, F.lit("|pubmed:"), "o_orderkey")
    doi = text.doi(F.concat(F.lit(" https://doi.org/10.1000/AB."), "o_orderkey"))
    return o.select("o_orderkey", text.record_id(F.col("o_orderkey"), F.col("o_custkey"), F.col("o_orderstatus")).alias("record_id"), text.trial_class(pick(_STATES, "o_orderkey"), pick(_REASONS, "o_custkey")).alias("trial"), text.pubmed_ids(tokens).alias("pmids"), doi.alias("doi"))


@query("SELECT event_id, (props->>'$.k')::BIGINT AS k, CASE WHEN (props->>'$.k')::DOUBLE <= 50 THEN 1 WHEN (props->>'$.k')::DOUBLE <= 90 THEN 2 ELSE 3 END::BIGINT AS credibility FROM events")
def q_json_fields(spark: SparkSession, d: str) -> DataFrame:
    k = F.get_json_object("props", "$.k")
    return table(spark, d, "events").select("event_id", k.cast("long").alias("k"), ids.credibility_from_score(k.cast("double"), 50, 90).alias("credibility"))


@query("SELECT l_orderkey AS order_id, coalesce(min(l_partkey) FILTER (l_returnflag = 'R'), min(l_partkey)) AS preferred, count(*) AS n_lines, count(DISTINCT l_partkey) AS n_parts FROM lineitem GROUP BY 1")
def q_nested_ingest(spark: SparkSession, d: str) -> DataFrame:
    li = table(spark, d, "lineitem")
    nested = li.groupBy(F.col("l_orderkey").alias("order_id")).agg(F.array_sort(F.collect_list(F.struct(F.col("l_partkey").alias("id"), F.col("l_returnflag").alias("source")))).alias("lines"))  # the lines of one order
    flat = nested.select("order_id", text.prefer(F.col("lines"), "R").alias("preferred"), F.inline("lines"))
    return flat.groupBy("order_id", "preferred").agg(F.count("*").alias("n_lines"), F.countDistinct("id").alias("n_parts"))


@query("SELECT 'supplier:' || l_suppkey AS x_id, 'part:' || l_partkey AS y_id, count(*) AS n FROM lineitem GROUP BY l_suppkey, l_partkey HAVING count(*) FILTER (l_returnflag NOT IN ('A', 'N')) = 0")
def q_consequence_allowed(spark: SparkSession, d: str) -> DataFrame:
    sets = supplies(spark, d).groupBy("x_id", "y_id").agg(F.collect_set("source").alias("ids"), F.count("*").alias("n"))
    return sets.where(F.size(F.array_except("ids", F.array(F.lit("A"), F.lit("N")))) == 0).select("x_id", "y_id", "n")


@query("WITH m AS (SELECT DISTINCT l_orderkey AS a, l_suppkey AS b FROM lineitem) SELECT a, b FROM m WHERE a IN (SELECT a FROM m GROUP BY a HAVING count(*) = 1) AND b IN (SELECT b FROM m GROUP BY b HAVING count(*) < 700)")
def q_strict_aliases(spark: SparkSession, d: str) -> DataFrame:
    m = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("a"), F.col("l_suppkey").alias("b")).distinct()
    once = lambda c, rule: m.groupBy(c).agg(F.count("*").alias("n")).where(rule).select(c)
    return m.join(once("a", "n = 1"), "a", "left_semi").join(once("b", "n < 700"), "b", "left_semi")


@query("SELECT page_id, nullif(regexp_extract(html, '<title>([^<]*)</title>', 1), '') AS title, length(html) AS n_chars FROM pages WHERE html IS NOT NULL")
def q_page_titles(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "pages").where("html IS NOT NULL").select("page_id", F.nullif(F.regexp_extract("html", "<title>([^<]*)</title>", 1), F.lit("")).alias("title"), F.length("html").alias("n_chars"))


@query("SELECT n.role AS x_role, m.role AS y_role, count(*) AS n FROM conversations n JOIN conversations m ON n.conv_id = m.conv_id AND m.turn = n.turn + 1 GROUP BY ALL")
def q_turn_edges(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "conversations")
    after = c.select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("role").alias("y_role"))
    return c.select("conv_id", "turn", F.col("role").alias("x_role")).join(after, ["conv_id", "turn"]).groupBy("x_role", "y_role").agg(F.count("*").alias("n"))


@query("WITH k AS (SELECT l_returnflag AS relation, l_orderkey, l_linenumber, l_partkey, l_suppkey, row_number() OVER (PARTITION BY l_returnflag ORDER BY sha256(concat_ws('|', '29', concat_ws('|', l_orderkey, l_linenumber, l_partkey, l_suppkey))), l_orderkey) AS n, count(*) OVER (PARTITION BY l_returnflag) AS total FROM lineitem) SELECT relation, l_orderkey, l_linenumber, l_partkey, l_suppkey FROM k WHERE n <= floor(total * 0.25)")
def q_sample_fraction(spark: SparkSession, d: str) -> DataFrame:
    keys = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    rows = table(spark, d, "lineitem").select(F.col("l_returnflag").alias("relation"), *keys, F.concat_ws("|", *keys).alias("key"))
    return G.split(rows, "relation", "key", 29, 0.0, 0.25).where("split = 'test'").select("relation", *keys)

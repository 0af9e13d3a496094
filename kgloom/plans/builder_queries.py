"""Source builders over the driver's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import builders as B
from ..operators import sequences as S
from ..sources.tables import table
from .queries import query


@query("WITH i AS (SELECT c_custkey AS k, CASE WHEN c_custkey % 2 = 0 THEN 'MONDO:' || c_custkey ELSE 'HP:' || c_custkey END AS id, CASE WHEN c_custkey % 2 = 0 THEN 'disease' ELSE 'phenotype' END AS t FROM customer WHERE c_custkey % 7 > 0), e AS (SELECT o_custkey AS x, o_orderkey % 200 AS y, o_orderpriority AS r FROM orders) SELECT DISTINCT CASE WHEN r = '2-HIGH' THEN b.id ELSE a.id END AS x_id, CASE WHEN r = '2-HIGH' THEN b.t ELSE a.t END AS x_type, CASE WHEN r = '2-HIGH' THEN a.id ELSE b.id END AS y_id, CASE WHEN r = '2-HIGH' THEN a.t ELSE b.t END AS y_type, CASE r WHEN '1-URGENT' THEN 'urgent' ELSE 'high' END AS relation FROM e JOIN i a ON a.k = x JOIN i b ON b.k = y WHERE r IN ('1-URGENT', '2-HIGH')")
def q_legacy_migration(spark: SparkSession, d: str) -> DataFrame:
    ids = table(spark, d, "customer").where("c_custkey % 7 > 0").selectExpr("c_custkey AS node_index", "CASE WHEN c_custkey % 2 = 0 THEN 'MONDO:' || c_custkey ELSE 'HP:' || c_custkey END AS id", "CASE WHEN c_custkey % 2 = 0 THEN 'disease' ELSE 'phenotype' END AS node_type")
    names = spark.createDataFrame([("1-URGENT", "urgent"), ("2-HIGH", "high")], "old string, new string")
    triples = table(spark, d, "orders").selectExpr("o_custkey AS x_index", "o_orderkey % 200 AS y_index", "o_orderpriority AS relation")
    return B.migrated(triples, ids, names, ["2-HIGH"])[0]


@query("SELECT DISTINCT 'l' || l_suppkey AS x_id, 'g' || l_partkey AS y_id, 'cell_line_expresses_gene' AS relation, 'r' || l_orderkey AS source_record_id FROM lineitem WHERE l_linenumber > 2 UNION ALL SELECT DISTINCT 'l' || l_suppkey, 'g' || l_partkey, 'cell_line_gene_essentiality', 'r' || l_orderkey FROM lineitem WHERE l_linenumber % 2 = 0 OR l_returnflag = 'R'")
def q_split_measurements(spark: SparkSession, d: str) -> DataFrame:
    mixed = table(spark, d, "lineitem").selectExpr("'l' || l_suppkey AS x_id", "'g' || l_partkey AS y_id", "'r' || l_orderkey AS source_record_id", "CASE WHEN l_linenumber > 2 THEN l_tax WHEN l_linenumber = 1 THEN double('NaN') END AS expression", "CASE WHEN l_linenumber % 2 = 0 THEN l_discount END AS gene_effect", "CASE WHEN l_returnflag = 'R' THEN false END AS is_essential")
    found = B.split_measurements(mixed)
    return found["cell_line_expresses_gene"].unionAll(found["cell_line_gene_essentiality"])


_PHENOTYPE = "p AS (SELECT 'm' || l_orderkey AS x_id, CASE l_linenumber % 3 WHEN 0 THEN 'HP:' || l_suppkey WHEN 1 THEN 'HP:' || l_suppkey END AS y_id, CASE WHEN l_returnflag = 'A' THEN 'PMID:' || l_partkey ELSE '' END AS paper_id FROM lineitem), k AS (SELECT * FROM p WHERE y_id IS NOT NULL AND x_id IN (SELECT 'm' || o_orderkey FROM orders WHERE o_custkey % 3 > 0) AND y_id IN (SELECT 'HP:' || s_suppkey FROM supplier WHERE s_suppkey % 4 > 0))"


@query(f"WITH {_PHENOTYPE} SELECT DISTINCT x_id, y_id, paper_id FROM k")
def q_variant_phenotypes(spark: SparkSession, d: str) -> DataFrame:
    source = table(spark, d, "lineitem").selectExpr("'m' || l_orderkey AS variant", "CASE l_linenumber % 3 WHEN 0 THEN 'HP_' || l_suppkey WHEN 1 THEN ' HP:' || l_suppkey ELSE 'MP_1' END AS phenotype", "CASE WHEN l_returnflag = 'A' THEN array('pubmed:' || l_partkey) END AS literature")
    known = table(spark, d, "orders").where("o_custkey % 3 > 0").selectExpr("'m' || o_orderkey AS id"), table(spark, d, "supplier").where("s_suppkey % 4 > 0").selectExpr("'HP:' || s_suppkey AS id")
    return B.variant_phenotypes(source, *known)[1]


@query("WITH r AS (SELECT 'P' || l_suppkey AS accession, trim(unnest([p_type, ' ' || p_name, ''])) AS label, l_linenumber % 4 + 1 AS c FROM lineitem JOIN part ON p_partkey = l_partkey), n AS (SELECT accession, CASE WHEN lower(label) = 'economy' THEN 'GO:1' WHEN lower(label) = 'standard' THEN 'GO:2' ELSE 'local:' || regexp_replace(lower(label), '[^a-z0-9]+', '-', 'g') END AS y_id, c FROM r WHERE label <> '') SELECT 'protein' || s_suppkey AS x_id, y_id, max(c)::BIGINT AS credibility FROM n JOIN supplier ON accession = 'P' || s_suppkey WHERE s_suppkey % 5 > 0 GROUP BY ALL")
def q_located_proteins(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "lineitem").join(table(spark, d, "part"), F.col("p_partkey") == F.col("l_partkey")).selectExpr("'P' || l_suppkey AS accession", "p_type || ', ' || p_name || ';' AS labels", "CAST(l_linenumber % 4 + 1 AS BIGINT) AS credibility")
    places = spark.createDataFrame([("economy", "GO:1"), ("standard", "GO:2")], "place string, place_id string")
    return B.located(rows, places, table(spark, d, "supplier").where("s_suppkey % 5 > 0").selectExpr("'P' || s_suppkey AS accession", "'protein' || s_suppkey AS protein"))


_HOMOLOGUE = "h AS (SELECT 'g' || l_suppkey AS a, CASE l_returnflag WHEN 'A' THEN 'within_species_paralog' WHEN 'R' THEN 'other_paralog' ELSE 'ortholog_one2one' END AS kind, CASE WHEN l_linenumber = 7 THEN '' ELSE 'g' || l_partkey % 60 END AS b FROM lineitem), w AS (SELECT *, CASE WHEN kind NOT LIKE '%paralog%' THEN 'not_a_paralog' WHEN b = '' THEN 'missing_target' WHEN a = b THEN 'self_pair' WHEN a NOT IN (SELECT 'g' || s_suppkey FROM supplier WHERE s_suppkey % 6 > 0) OR b NOT IN (SELECT 'g' || s_suppkey FROM supplier WHERE s_suppkey % 6 > 0) THEN 'unknown_endpoint' END AS reason FROM h)"


def _paralogs(spark: SparkSession, d: str):
    rows = table(spark, d, "lineitem").selectExpr("'g' || l_suppkey AS id", "named_struct('kind', CASE l_returnflag WHEN 'A' THEN 'within_species_paralog' WHEN 'R' THEN 'other_paralog' ELSE 'ortholog_one2one' END, 'target', CASE WHEN l_linenumber = 7 THEN '' ELSE 'g' || l_partkey % 60 END) AS h")
    return B.paralogs(rows.groupBy("id").agg(F.collect_list("h").alias("homologues")), table(spark, d, "supplier").where("s_suppkey % 6 > 0").selectExpr("'g' || s_suppkey AS id"))


@query(f"WITH {_HOMOLOGUE} SELECT DISTINCT least(a, b) AS x_id, greatest(a, b) AS y_id FROM w WHERE reason IS NULL")
def q_paralogs(spark: SparkSession, d: str) -> DataFrame:
    return _paralogs(spark, d)[0]


@query(f"WITH {_HOMOLOGUE} SELECT reason, count(*) AS n FROM w WHERE reason IS NOT NULL GROUP BY 1")
def q_paralog_rejects(spark: SparkSession, d: str) -> DataFrame:
    return _paralogs(spark, d)[1]


@query("WITH l AS (SELECT o_custkey, 'status' AS name, o_orderstatus AS v FROM orders UNION ALL SELECT o_custkey, 'priority', o_orderpriority FROM orders) SELECT o_custkey, name, count(*) AS n_values, count(*) FILTER (contains(lower(v), 'high')) AS n_with_word FROM l WHERE trim(v) <> '' GROUP BY ALL")
def q_prefixed_columns(spark: SparkSession, d: str) -> DataFrame:
    return B.prefixed_columns(table(spark, d, "orders").select("o_custkey", F.col("o_orderstatus").alias("cancer_status"), F.col("o_orderpriority").alias("cancer_priority")), "o_custkey", "cancer_", "high")


@query("WITH p AS (SELECT DISTINCT l_partkey % 97 AS a, l_suppkey % 31 AS b FROM lineitem WHERE l_linenumber = 1 AND l_quantity > 48) SELECT a, b FROM p WHERE a IN (SELECT a FROM p GROUP BY a HAVING count(*) = 1) AND b IN (SELECT b FROM p GROUP BY b HAVING count(*) = 1) UNION ALL SELECT p_partkey, -p_partkey FROM part")
def q_strict_pairs(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "lineitem").where("l_linenumber = 1 AND l_quantity > 48").selectExpr("l_partkey % 97 AS a", "l_suppkey % 31 AS b")
    own = table(spark, d, "part").selectExpr("p_partkey AS a", "-p_partkey AS b")
    return B.strict_pairs(rows, "a", "b").unionAll(B.strict_pairs(own, "a", "b"))


_TARGETS = "t AS (SELECT 'x' || l_orderkey AS m, 'A' || l_partkey AS acc FROM lineitem WHERE l_linenumber <= 2), a AS (SELECT 'A' || (p_partkey - p_partkey % CASE WHEN p_partkey % 5 = 1 THEN 2 ELSE 1 END) AS alias, 'p' || p_partkey AS id FROM part WHERE p_size > 5), c AS (SELECT alias, count(DISTINCT id) AS n, min(id) AS id FROM a GROUP BY alias)"


def _targets(spark: SparkSession, d: str):
    rows = table(spark, d, "lineitem").where("l_linenumber <= 2").groupBy(F.concat(F.lit("x"), "l_orderkey").alias("molecule")).agg(F.collect_list(F.concat(F.lit("A"), "l_partkey")).alias("components"))
    aliases = table(spark, d, "part").where("p_size > 5").selectExpr("'A' || (p_partkey - p_partkey % CASE WHEN p_partkey % 5 = 1 THEN 2 ELSE 1 END) AS alias", "'p' || p_partkey AS id")
    return B.mapped_targets(rows, aliases)


@query(f"WITH {_TARGETS} SELECT DISTINCT m AS x_id, id AS y_id FROM t JOIN c ON alias = acc WHERE n = 1")
def q_mapped_targets(spark: SparkSession, d: str) -> DataFrame:
    return _targets(spark, d)[0]


@query(f"WITH {_TARGETS} SELECT CASE WHEN n IS NULL THEN 'unmapped' ELSE 'ambiguous' END AS reason, count(DISTINCT acc) AS n FROM t LEFT JOIN c ON alias = acc WHERE n IS NULL OR n > 1 GROUP BY 1")
def q_unmapped_targets(spark: SparkSession, d: str) -> DataFrame:
    return _targets(spark, d)[1]


@query("WITH g AS (SELECT l_suppkey % 25 AS line, CASE WHEN l_linenumber < 6 THEN l_linenumber END AS dose, CASE l_returnflag WHEN 'N' THEN NULL ELSE l_returnflag END AS drug, count(*) AS n_cells FROM lineitem GROUP BY ALL) SELECT line, dose, drug, n_cells, concat_ws(';', CASE WHEN dose IS NULL THEN 'missing_dose' END, CASE WHEN drug IS NULL THEN 'missing_drug' END, CASE WHEN n_cells < 30 THEN 'too_few_cells' END) AS reasons FROM g")
def q_perturbation_conditions(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "lineitem").selectExpr("l_suppkey % 25 AS line", "CASE WHEN l_linenumber < 6 THEN l_linenumber END AS dose", "CASE l_returnflag WHEN 'N' THEN NULL ELSE l_returnflag END AS drug")
    return B.conditions(rows, ["line", "dose", "drug"], 30)


@query("WITH h AS (SELECT 'c' || c_custkey AS id, c_custkey AS node_index FROM customer WHERE c_custkey % 2 = 0), n AS (SELECT DISTINCT 'c' || o_custkey AS id FROM orders WHERE 'c' || o_custkey NOT IN (SELECT id FROM h)) SELECT id, row_number() OVER (ORDER BY id) + (SELECT max(node_index) FROM h) AS node_index FROM n")
def q_additions(spark: SparkSession, d: str) -> DataFrame:
    have = table(spark, d, "customer").where("c_custkey % 2 = 0").selectExpr("'c' || c_custkey AS id", "c_custkey AS node_index")
    return B.additions(table(spark, d, "orders").selectExpr("'c' || o_custkey AS id"), have, "id")


@query("SELECT DISTINCT 'r|c' || o_custkey || '|' || o_orderstatus AS edge_key, 'r' AS relation, 'c' || o_custkey AS x_id, o_orderstatus AS y_id, 'database_record' AS evidence_type, 'ot' AS source, CASE WHEN o_orderkey % 2 = 0 THEN 'eva' ELSE 'none' END AS source_dataset, sha256(concat_ws('|', 'r', 'c' || o_custkey, o_orderstatus, CASE WHEN o_orderkey % 2 = 0 THEN 'ot/eva' ELSE 'ot' END)) AS source_record_id FROM orders")
def q_backfilled_evidence(spark: SparkSession, d: str) -> DataFrame:
    edges = table(spark, d, "orders").selectExpr("'r' AS relation", "'c' || o_custkey AS x_id", "o_orderstatus AS y_id", "CASE WHEN o_orderkey % 2 = 0 THEN 'ot/eva' ELSE 'ot' END AS source")
    return B.backfilled(edges, F.lit("none"))


@query("""WITH g AS (SELECT n_nationkey AS k, repeat('ACgtRYn' || CASE WHEN n_nationkey % 2 = 0 THEN 'A' ELSE 'C' END, 30) AS contig FROM nation WHERE n_nationkey % 5 > 0),
i AS (SELECT DISTINCT l_orderkey * 10 + l_linenumber AS id, l_suppkey % 25 AS k, l_orderkey % 260 + 1 AS start, l_orderkey % 260 + l_linenumber AS stop, CASE WHEN l_returnflag = 'A' THEN '-' ELSE '+' END AS strand FROM lineitem),
j AS (SELECT *, upper(contig[greatest(1, start - 5):least(len(contig), stop + 5)]) AS s FROM i LEFT JOIN g USING (k))
SELECT id, CASE WHEN stop <= len(contig) THEN CASE WHEN strand = '-' THEN reverse(translate(s, 'ACGTRYN', 'TGCAYRN')) ELSE s END END AS sequence, CASE WHEN contig IS NULL THEN 'missing_contig' WHEN stop > len(contig) THEN 'outside_contig' END AS reason FROM j""")
def q_interval_sequences(spark: SparkSession, d: str) -> DataFrame:
    contigs = table(spark, d, "nation").where("n_nationkey % 5 > 0").selectExpr("n_nationkey AS chromosome", "0 AS at", "repeat('ACgtRYn' || CASE WHEN n_nationkey % 2 = 0 THEN 'A' ELSE 'C' END, 30) AS text")
    rows = table(spark, d, "lineitem").selectExpr("l_orderkey * 10 + l_linenumber AS id", "l_suppkey % 25 AS chromosome", "l_orderkey % 260 + 1 AS start", "l_orderkey % 260 + l_linenumber AS end", "CASE WHEN l_returnflag = 'A' THEN '-' ELSE '+' END AS strand")
    return S.windows(rows, S.contig_blocks(contigs, 64), 5, width=64).select("id", "sequence", "reason")


@query("SELECT l_suppkey AS line, 'p' || p_partkey AS protein, l_quantity FROM lineitem JOIN part ON l_partkey % 100 = p_partkey % 100 AND p_partkey < 200")
def q_projected_expression(spark: SparkSession, d: str) -> DataFrame:
    mapping = table(spark, d, "part").where("p_partkey < 200").selectExpr("p_partkey % 100 AS gene", "'p' || p_partkey AS protein")
    return B.projected(table(spark, d, "lineitem").selectExpr("l_suppkey AS line", "l_partkey % 100 AS gene", "l_quantity"), mapping, 1 << 40).select("line", "protein", "l_quantity")

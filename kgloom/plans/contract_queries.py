"""Contracts, look-ups and shared joins over the driver's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text
from ..functions.schema import RELATIONS as REGISTRY
from ..operators import contracts as C
from ..operators import edges as E
from ..operators import lookups as L
from ..sources.tables import business_edges, nodes, table
from .queries import _BUSINESS, _NODES, query
from .template_queries import RELATIONS, _cte, relation_frame

_GENE_EXPR = {
    "id": "CASE p_partkey % 4 WHEN 0 THEN 'ENSG' || p_partkey WHEN 1 THEN 'NCBI:' || p_partkey WHEN 2 THEN 'FB' || p_partkey ELSE 'X' || p_partkey END", "ncbi_gene_id": "'' || p_size", "hgnc_id": "p_brand", "uniprot_id": "CASE WHEN p_size % 9 = 0 THEN 'cold widget' END", "gene_name": "CASE WHEN p_size % 2 = 0 THEN upper(p_name) END",
    "name": "CASE WHEN p_size % 3 > 0 THEN p_name ELSE '' END", "description": "CASE WHEN p_size % 5 = 0 THEN 'Ortholog of it' WHEN p_size % 7 = 0 THEN 'Cold Widget' END", "source": "CASE WHEN p_size % 11 = 0 THEN 'target.Homologues' END",
}
_GENES = "g AS (SELECT " + ", ".join(f"{e} AS {c}" for c, e in _GENE_EXPR.items()) + " FROM part)"
_RESOLVED = """r AS (SELECT *, CASE WHEN upper(id) = 'COLD WIDGET' THEN 'id' WHEN uniprot_id = 'cold widget' THEN 'uniprot_id' WHEN upper(gene_name) = 'COLD WIDGET' THEN 'gene_name' WHEN upper(name) = 'COLD WIDGET' THEN 'name' ELSE 'description' END AS match_kind,
  row_number() OVER (ORDER BY CASE WHEN id LIKE 'ENSG%' AND (coalesce(upper(gene_name) = 'COLD WIDGET', false) OR upper(name) = 'COLD WIDGET') THEN 2 WHEN id LIKE 'NCBI:%' AND (coalesce(upper(gene_name) = 'COLD WIDGET', false) OR upper(name) = 'COLD WIDGET') THEN 3 WHEN upper(gene_name) = 'COLD WIDGET' THEN 4 WHEN upper(name) = 'COLD WIDGET' THEN 5 ELSE 9 END, id) AS rank
  FROM g WHERE (uniprot_id = 'cold widget' OR upper(gene_name) = 'COLD WIDGET' OR upper(name) = 'COLD WIDGET' OR upper(description) = 'COLD WIDGET') AND (id LIKE 'ENSG%' OR id LIKE 'NCBI:%' OR (coalesce(source, '') NOT ILIKE '%homologues%' AND coalesce(description, '') NOT ILIKE '%ortholog%')))"""


def _genes(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "part").selectExpr(*[f"{e} AS {c}" for c, e in _GENE_EXPR.items()])


@query(f"WITH {_GENES}, {_RESOLVED} SELECT id, ncbi_gene_id, hgnc_id, uniprot_id, gene_name, name, description, source, match_kind, rank FROM r")
def q_resolve_gene(spark: SparkSession, d: str) -> DataFrame:
    return L.resolve_gene(_genes(spark, d), "cold widget", limit=None)


_LINKED = {"x_id": _GENE_EXPR["id"].replace("p_partkey", "l_partkey"), "y_id": "'D' || l_suppkey", "relation": "CASE WHEN l_linenumber = 7 THEN 'other' ELSE 'disease_associated_gene' END", "source": "l_returnflag", "credibility": "CAST(l_linenumber % 3 + 1 AS BIGINT)", "score": "l_discount"}
_DISEASES = {"id": "'D' || s_suppkey", "name": "CASE WHEN s_suppkey % 4 = 0 THEN '' ELSE s_name END", "description": "CASE WHEN s_suppkey % 2 = 0 THEN 'about' END", "mondo_id": "'MONDO:' || s_nationkey", "efo_id": "CAST(NULL AS STRING)", "mesh_id": "CAST(NULL AS STRING)", "hp_id": "CAST(NULL AS STRING)", "omim_id": "'' || s_nationkey", "doid_id": "CAST(NULL AS STRING)", "icd10_code": "CAST(NULL AS STRING)"}


def _select(spec: dict[str, str]) -> str:
    return ", ".join(f"{e} AS {c}" for c, e in spec.items())


_SUMMARY = f"WITH {_GENES}, {_RESOLVED}, e AS (SELECT {_select(_LINKED)} FROM lineitem), ds AS (SELECT {_select(_DISEASES)} FROM supplier WHERE s_suppkey % 7 > 0), v AS (SELECT {_LINKED['x_id']} AS x_id, 'D' || l_suppkey AS y_id, l_linestatus AS source, l_tax AS evidence_score FROM lineitem WHERE l_linenumber > 3), w AS (SELECT x_id, y_id, count(*) AS evidence_count, string_agg(DISTINCT source, '; ' ORDER BY source) AS evidence_sources, max(evidence_score) AS evidence_score_max FROM v GROUP BY ALL)"


@query(f"{_SUMMARY} SELECT DISTINCT e.x_id AS gene_id, r.gene_name, coalesce(r.name, r.gene_name, e.x_id) AS gene_label, e.y_id AS disease_id, coalesce(nullif(ds.name, ''), e.y_id) AS disease_name, ds.description AS disease_description, mondo_id, efo_id, mesh_id, hp_id, omim_id, doid_id, icd10_code, e.source AS edge_source, credibility, score, coalesce(evidence_count, 0) AS evidence_count, evidence_sources, evidence_score_max FROM e JOIN r ON r.id = e.x_id LEFT JOIN ds ON ds.id = e.y_id LEFT JOIN w ON w.x_id = e.x_id AND w.y_id = e.y_id WHERE e.relation = 'disease_associated_gene'")
def q_diseases_for_gene(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "lineitem")
    evidence = rows.where("l_linenumber > 3").selectExpr(f"{_LINKED['x_id']} AS x_id", "'D' || l_suppkey AS y_id", "l_linestatus AS source", "l_tax AS evidence_score")
    diseases = table(spark, d, "supplier").where("s_suppkey % 7 > 0").selectExpr(*[f"{e} AS {c}" for c, e in _DISEASES.items()])
    return L.diseases_for_gene(_genes(spark, d), rows.selectExpr(*[f"{e} AS {c}" for c, e in _LINKED.items()]), diseases, evidence, "cold widget")


@query(f"{_SUMMARY} SELECT DISTINCT e.x_id AS gene_id, e.y_id AS disease_id, e.source AS edge_source, credibility, score, 0 AS evidence_count FROM e JOIN r ON r.id = e.x_id WHERE e.relation = 'disease_associated_gene'")
def q_diseases_without_evidence(spark: SparkSession, d: str) -> DataFrame:
    edges = table(spark, d, "lineitem").selectExpr(*[f"{e} AS {c}" for c, e in _LINKED.items()])
    diseases = table(spark, d, "supplier").selectExpr(*[f"{e} AS {c}" for c, e in _DISEASES.items()])
    return L.diseases_for_gene(_genes(spark, d), edges, diseases, None, "cold widget").select("gene_id", "disease_id", "edge_source", "credibility", "score", "evidence_count")


_ALL = ", ".join(f"('{r.name}', '{r.source}', '{r.target}')" for r in REGISTRY.values())


@query("WITH " + ", ".join(_cte(n) for n in RELATIONS) + ", p AS (" + " UNION ALL ".join(f"SELECT '{n}' AS name, count(*) AS n_rows FROM {n}" for n in RELATIONS) + f"), k AS (SELECT * FROM (VALUES {_ALL}) t(name, x_type, y_type)) SELECT name, x_type, y_type, coalesce(n_rows, 0) AS n_rows, n_rows IS NULL AS missing FROM k LEFT JOIN p USING (name)")
def q_registry_coverage(spark: SparkSession, d: str) -> DataFrame:
    present = None
    for n in RELATIONS:
        one = relation_frame(spark, d, n).agg(F.lit(n).alias("name"), F.count("*").alias("n_rows"))
        present = one if present is None else present.unionAll(one)
    return C.registry_coverage(present)


_EDGE = {"relation": "'cell_line_expresses_gene'", "x_id": "'l' || l_suppkey", "x_type": "CASE WHEN l_orderkey % 50 = 0 THEN NULL ELSE 'cell_line' END", "y_id": "'g' || l_partkey", "y_type": "'gene'", "source": "l_returnflag", "credibility": "CASE WHEN l_orderkey % 70 > 0 THEN 3 END"}
_EVIDENCE = {"relation": "'cell_line_expresses_gene'", "x_id": "'l' || l_suppkey", "x_type": "CASE WHEN l_orderkey % 31 = 0 THEN 'tissue' ELSE 'cell_line' END", "y_id": "'g' || (l_partkey + l_linenumber % 2)", "y_type": "'gene'", "source": "CASE WHEN l_orderkey % 40 > 0 THEN l_returnflag END", "source_record_id": "'r' || (l_orderkey % 900)", "edge_key": "CASE WHEN l_orderkey % 60 > 0 THEN 'cell_line_expresses_gene|l' || l_suppkey || '|g' || l_partkey END"}
_PAIR = f"e AS (SELECT {_select(_EDGE)} FROM lineitem WHERE l_linenumber <= 3), v AS (SELECT {_select(_EVIDENCE)} FROM lineitem WHERE l_linenumber >= 3)"


def _pair(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    rows = table(spark, d, "lineitem")
    return rows.where("l_linenumber <= 3").selectExpr(*[f"{e} AS {c}" for c, e in _EDGE.items()]), rows.where("l_linenumber >= 3").selectExpr(*[f"{e} AS {c}" for c, e in _EVIDENCE.items()])


@query(f"""WITH {_PAIR} SELECT (SELECT count(*) - count(DISTINCT (relation, x_id, y_id)) FROM e) AS duplicate_edge_identities, (SELECT count(*) - count(DISTINCT (edge_key, source_record_id)) FROM v) AS duplicate_evidence_identities, (SELECT count(*) FROM (SELECT relation, x_id, y_id FROM e EXCEPT SELECT relation, x_id, y_id FROM v)) AS edges_without_evidence,
  (SELECT count(*) FROM (SELECT relation, x_id, y_id FROM v EXCEPT SELECT relation, x_id, y_id FROM e)) AS evidence_without_edge, (SELECT count(*) FROM e WHERE x_type IS NULL OR credibility IS NULL) AS null_edge_identity_rows, (SELECT count(*) FROM v WHERE edge_key IS NULL OR source IS NULL) AS null_evidence_identity_rows,
  (SELECT count(*) FROM e WHERE x_id NOT IN (SELECT 'l' || s_suppkey FROM supplier WHERE s_suppkey % 3 > 0)) AS missing_x_endpoints, (SELECT count(*) FROM e WHERE y_id NOT IN (SELECT 'g' || p_partkey FROM part WHERE p_size > 5)) AS missing_y_endpoints""")
def q_relation_artifacts(spark: SparkSession, d: str) -> DataFrame:
    lines = table(spark, d, "supplier").where("s_suppkey % 3 > 0").selectExpr("'l' || s_suppkey AS id")
    return C.relation_artifacts(*_pair(spark, d), lines, table(spark, d, "part").where("p_size > 5").selectExpr("'g' || p_partkey AS id"))


@query(f"WITH {_PAIR} SELECT count(*) AS n_rows, 0 AS other_relation, count(*) FILTER (x_type <> 'cell_line') AS other_x_type, 0 AS other_y_type, count(*) FILTER (source IS NULL) AS blank_source, count(*) FILTER (edge_key <> relation || '|' || x_id || '|' || y_id) AS wrong_key FROM v")
def q_evidence_contract(spark: SparkSession, d: str) -> DataFrame:
    return C.evidence_contract(_pair(spark, d)[1].withColumn("source_dataset", F.lit("d")), "cell_line_expresses_gene")


@query(f"WITH {_PAIR} SELECT 'a' AS only_in, x_id, y_id FROM (SELECT x_id, y_id FROM e EXCEPT SELECT x_id, y_id FROM v) UNION ALL SELECT 'b', x_id, y_id FROM (SELECT x_id, y_id FROM v EXCEPT SELECT x_id, y_id FROM e)")
def q_except_both(spark: SparkSession, d: str) -> DataFrame:
    e, v = _pair(spark, d)
    return C.except_both(e.select("x_id", "y_id"), v.select("x_id", "y_id"))


@query(f"WITH {_BUSINESS}, {_NODES}, w AS (SELECT * FROM v WHERE node_type NOT IN ('region', 'part')), t AS (SELECT relation, unnest([x_type, y_type]) AS node_type FROM e) SELECT relation, node_type, count(*) AS n_ends FROM t WHERE node_type NOT IN (SELECT node_type FROM w) GROUP BY ALL")
def q_missing_types(spark: SparkSession, d: str) -> DataFrame:
    return C.missing_types(business_edges(spark, d), nodes(spark, d).where("node_type NOT IN ('region', 'part')"), strict=False)


@query(f"WITH {_BUSINESS}, {_NODES}, w AS (SELECT * FROM v WHERE id NOT IN (SELECT 'customer:' || c_custkey FROM customer WHERE c_acctbal < 0) UNION ALL SELECT 'nation:' || n_nationkey, 'nation' FROM nation WHERE n_regionkey = 1) SELECT 'error' AS severity, node_type || '.ids_unique' AS \"check\", sum(n) AS n FROM (SELECT node_type, id, count(*) AS n FROM w GROUP BY ALL HAVING n > 1) GROUP BY node_type UNION ALL SELECT 'error', relation || '.x_endpoint_in_node_map', count(*) FROM e WHERE x_id NOT IN (SELECT id FROM w) GROUP BY relation UNION ALL SELECT 'error', relation || '.y_endpoint_in_node_map', count(*) FROM e WHERE y_id NOT IN (SELECT id FROM w) GROUP BY relation")
def q_export_issues(spark: SparkSession, d: str) -> DataFrame:
    poor = table(spark, d, "customer").where("c_acctbal < 0").select(F.concat(F.lit("customer:"), "c_custkey").alias("id"))
    again = table(spark, d, "nation").where("n_regionkey = 1").select(F.concat(F.lit("nation:"), "n_nationkey").alias("id"), F.lit("nation").alias("node_type"))
    return C.issues(nodes(spark, d).join(poor, "id", "left_anti").unionByName(again), business_edges(spark, d))


_SEQ = {"node_id": "'g' || (p_partkey - p_partkey % 2)", "source": "'s'", "source_record_id": "'' || (p_partkey - p_partkey % 2 + p_size % 2)", "sequence_kind": "CASE WHEN p_size % 13 = 0 THEN 'rna' ELSE 'dna' END", "sequence": "CASE WHEN p_size % 17 = 0 THEN ' ' WHEN p_size % 9 = 0 THEN 'acXg' ELSE repeat('acg tn', p_size % 5 + 1) END"}


@query(f"WITH s AS (SELECT {_select(_SEQ)} FROM part), c AS (SELECT *, upper(regexp_replace(sequence, '\\s+', '', 'g')) AS q, 'dna|' || node_id || '|s|' || source_record_id || '|' || sequence_kind AS k FROM s), m AS (SELECT k, node_id, sequence_kind, max(q) AS q, count(*) AS copies FROM c GROUP BY ALL), n AS (SELECT DISTINCT 'g' || l_partkey AS id FROM lineitem WHERE l_partkey % 3 > 0), i AS (SELECT DISTINCT node_id AS id FROM m) SELECT count(*) AS n_rows, count(*) FILTER (NOT regexp_full_match(q, '[ACGTRYSWKMBDHVN]*')) AS bad_alphabet, count(*) FILTER (sequence_kind <> 'dna') AS bad_kind, count(*) FILTER (len(q) > 20) AS too_long, count(*) FILTER (q = '') AS empty, sum(copies - 1) AS duplicates, min(len(q)) AS min_length, max(len(q)) AS max_length, (SELECT count(*) FROM i) AS unique_nodes, (SELECT count(*) FROM i ANTI JOIN n USING (id)) AS nodes_not_in_endpoint, (SELECT count(*) FROM n) AS endpoint_nodes, round((SELECT count(*) FROM i JOIN n USING (id)) / (SELECT count(*) FROM n), 6) AS coverage FROM m")
def q_sequence_report(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "part").selectExpr("'dna' AS feature_table", *[f"{e} AS {c}" for c, e in _SEQ.items()])
    known = table(spark, d, "lineitem").where("l_partkey % 3 > 0").selectExpr("'g' || l_partkey AS id").distinct()
    return C.sequence_report(C.sequence_rows(rows, "dna_iupac", "dna", 20), known)


@query("WITH i AS (SELECT 'g' || l_partkey AS node_id, l_linenumber - 1 AS start, CAST(l_quantity AS INT) AS stop, CASE l_returnflag WHEN 'A' THEN '+' WHEN 'R' THEN '-' WHEN 'N' THEN CASE WHEN l_orderkey % 2 = 0 THEN '.' ELSE '?' END END AS strand FROM lineitem), n AS (SELECT 'g' || p_partkey AS id FROM part WHERE p_size > 10), u AS (SELECT DISTINCT node_id AS id FROM i) SELECT count(*) AS n_rows, count(*) FILTER (start < 1 OR stop < start) AS bad_coordinates, count(*) FILTER (strand NOT IN ('+', '-', '.')) AS bad_strand, min(stop - start + 1) AS min_length, max(stop - start + 1) AS max_length, (SELECT count(*) FROM u) AS unique_nodes, (SELECT count(*) FROM u ANTI JOIN n USING (id)) AS nodes_not_in_endpoint, (SELECT count(*) FROM n) AS endpoint_nodes, round((SELECT count(*) FROM u JOIN n USING (id)) / (SELECT count(*) FROM n), 6) AS coverage FROM i")
def q_interval_report(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "lineitem").selectExpr("'g' || l_partkey AS node_id", "l_linenumber - 1 AS start", "CAST(l_quantity AS INT) AS end", "CASE l_returnflag WHEN 'A' THEN '+' WHEN 'R' THEN '-' WHEN 'N' THEN CASE WHEN l_orderkey % 2 = 0 THEN '.' ELSE '?' END END AS strand")
    return C.interval_report(rows, table(spark, d, "part").where("p_size > 10").selectExpr("'g' || p_partkey AS id"))


@query("WITH t AS (SELECT 'd' || doc_id AS node_id, text FROM documents), n AS (SELECT 'd' || doc_id AS id FROM labels), u AS (SELECT DISTINCT node_id AS id FROM t) SELECT count(*) AS n_rows, count(*) FILTER (trim(coalesce(text, '')) = '') AS empty, count(*) FILTER (len(trim(coalesce(text, ''), ' ')) > 2000) AS too_long, (SELECT count(*) FROM u) AS unique_nodes, (SELECT count(*) FROM u ANTI JOIN n USING (id)) AS nodes_not_in_endpoint, (SELECT count(DISTINCT id) FROM n) AS endpoint_nodes, round((SELECT count(*) FROM u SEMI JOIN n USING (id)) / (SELECT count(DISTINCT id) FROM n), 6) AS coverage FROM t")
def q_text_report(spark: SparkSession, d: str) -> DataFrame:
    return C.summary_report(table(spark, d, "documents").selectExpr("'d' || doc_id AS node_id", "text"), 2000, table(spark, d, "labels").selectExpr("'d' || doc_id AS id"))


_BITS = "CASE p_size % 8 WHEN 0 THEN {0}() WHEN 1 THEN {0}(5, 3) WHEN 2 THEN {0}(1, 2000) ELSE {0}(1, p_size + 1, p_size + 70) END"


@query("""WITH f AS (SELECT CASE p_size % 8 WHEN 0 THEN []::INT[] WHEN 1 THEN [5, 3] WHEN 2 THEN [1, 2000] ELSE [1, p_size + 1, p_size + 70] END AS b, p_size FROM part), g AS (SELECT *, sha256('{"fingerprint_format":"sparse_on_bits_uint16_list","fingerprint_kind":"morgan","n_bits":1024,"on_bits":[' || coalesce(array_to_string(list_sort(b), ','), '') || '],"radius":2,"use_bond_types":true,"use_chirality":false}') AS right_sum FROM f)
  SELECT count(*) AS n_rows, count(*) FILTER (len(b) = 0) AS empty, count(*) FILTER (b <> list_sort(b)) AS unsorted, count(*) FILTER (len(list_filter(b, lambda x: x < 0 OR x >= 1024)) > 0) AS out_of_range, count(*) FILTER (p_size % 10 = 3) AS wrong_checksum FROM g""")
def q_fingerprint_report(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "part").select("p_size", F.expr(_BITS.format("array")).cast("array<int>").alias("on_bits"))
    sums = F.when(F.col("p_size") % 10 == 3, "wrong").otherwise(C.fingerprint_checksum(F.col("on_bits"), "morgan", 2, 1024))
    return C.fingerprint_report(rows.withColumn("checksum", sums), "morgan", 2, 1024)


@query("SELECT count(*) AS n_rows, 0 AS other_table, count(*) FILTER (l_linenumber = 7) AS other_x_type, 0 AS other_y_type, count(*) FILTER (l_returnflag = 'A') AS causal, count(*) FILTER (l_returnflag = 'R' AND l_linestatus = 'F') AS unsupported FROM lineitem")
def q_context_report(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "lineitem").selectExpr("'gene_disease_association_score' AS feature_table", "CASE WHEN l_linenumber = 7 THEN 'protein' ELSE 'gene' END AS x_type", "'disease' AS y_type", "CASE l_returnflag WHEN 'A' THEN 'Causal' WHEN 'R' THEN CASE l_linestatus WHEN 'F' THEN 'odd' ELSE 'predictive' END ELSE 'Correlative' END AS evidence_type")
    return C.context_report(rows, "gene_disease_association_score")


@query("WITH v AS (SELECT 'v' || (vec_id - CASE WHEN vec_id % 10 = 1 THEN 1 ELSE 0 END) AS node_id, embedding, label FROM embeddings), n AS (SELECT DISTINCT 'v' || o_orderkey AS id FROM orders WHERE o_orderkey % 4 > 0), u AS (SELECT DISTINCT node_id AS id FROM v) SELECT count(*) AS n_rows, count(*) FILTER (len(embedding) <> 64) AS wrong_dim, count(*) FILTER (len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) > 0) AS not_finite, count(*) FILTER (len(list_filter(embedding, lambda x: x <> 0)) = 0) AS all_zero, count(*) FILTER (label IS NULL) AS no_model, (SELECT sum(k - 1) FROM (SELECT count(*) AS k FROM v GROUP BY node_id)) AS duplicates, (SELECT count(*) FROM u) AS unique_nodes, (SELECT count(*) FROM u ANTI JOIN n USING (id)) AS nodes_not_in_endpoint, (SELECT count(*) FROM n) AS endpoint_nodes, round((SELECT count(*) FROM u JOIN n USING (id)) / (SELECT count(*) FROM n), 6) AS coverage FROM v")
def q_vector_report(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "embeddings").select(F.expr("'v' || (vec_id - CASE WHEN vec_id % 10 = 1 THEN 1 ELSE 0 END)").alias("node_id"), F.col("embedding").alias("vector"), F.col("label").cast("string").alias("model"))
    return C.vector_report(rows, 64, table(spark, d, "orders").where("o_orderkey % 4 > 0").selectExpr("'v' || o_orderkey AS id").distinct())


@query("SELECT CASE WHEN vec_id % 3 = 0 THEN 'gene' ELSE 'disease' END AS node_type, label::VARCHAR AS model, count(*) AS n_rows, min(len(embedding)) AS min_dim, max(len(embedding)) AS max_dim FROM embeddings GROUP BY ALL")
def q_vector_inventory(spark: SparkSession, d: str) -> DataFrame:
    return C.vector_inventory(table(spark, d, "embeddings").selectExpr("CASE WHEN vec_id % 3 = 0 THEN 'gene' ELSE 'disease' END AS node_type", "CAST(label AS STRING) AS model", "embedding AS vector"))


_POOLED = "WITH l AS (SELECT label, unnest(embedding)::DOUBLE AS x, unnest(range(len(embedding))) AS dim, {w} AS w FROM embeddings WHERE label IS NOT NULL), m AS (SELECT label, dim, sum(w * x) / sum(w) AS x FROM l GROUP BY ALL), n AS (SELECT label, sqrt(sum(x * x)) AS n FROM m GROUP BY label) SELECT label, round(max(x / n) FILTER (dim = 0), 6) AS first, round(max(x / n) FILTER (dim = 63), 6) AS last FROM m JOIN n USING (label) GROUP BY label"


@query(_POOLED.format(w="(vec_id % 5 + 1)::DOUBLE"))
def q_weighted_vectors(spark: SparkSession, d: str) -> DataFrame:
    found = C.pooled(table(spark, d, "embeddings").where("label IS NOT NULL").withColumnRenamed("embedding", "vector"), "label", F.col("vec_id") % 5 + 1)
    return found.select("label", F.round(F.col("vector")[0], 6).alias("first"), F.round(F.col("vector")[63], 6).alias("last"))


@query(_POOLED.format(w="1.0::DOUBLE"))
def q_mean_vectors(spark: SparkSession, d: str) -> DataFrame:
    found = C.pooled(table(spark, d, "embeddings").where("label IS NOT NULL").withColumnRenamed("embedding", "vector"), "label")
    return found.select("label", F.round(F.col("vector")[0], 6).alias("first"), F.round(F.col("vector")[63], 6).alias("last"))


@query("WITH r AS (SELECT o_orderstatus, o_orderkey, row_number() OVER (PARTITION BY o_orderstatus ORDER BY o_orderkey) - 1 AS place FROM orders), b AS (SELECT o_orderstatus, place // 100 AS block, sha256(string_agg(o_orderkey::VARCHAR, chr(10) ORDER BY place)) AS h FROM r GROUP BY ALL) SELECT o_orderstatus, sha256(string_agg(h, chr(10) ORDER BY block)) AS digest FROM b GROUP BY ALL")
def q_ordered_digest(spark: SparkSession, d: str) -> DataFrame:
    return C.ordered_digest(table(spark, d, "orders"), "o_orderstatus", ["o_orderkey"], "o_orderkey", 100)


@query("WITH e AS (SELECT DISTINCT l_suppkey % 40 AS x, l_partkey % 40 AS y FROM lineitem WHERE l_linenumber = 1) SELECT x AS a, y AS b FROM e WHERE x < y AND (y, x) IN (SELECT (x, y) FROM e)")
def q_mirror_pairs(spark: SparkSession, d: str) -> DataFrame:
    return C.mirror_pairs(table(spark, d, "lineitem").where("l_linenumber = 1").selectExpr("l_suppkey % 40 AS x_id", "l_partkey % 40 AS y_id"))


@query("SELECT o_orderkey, CASE WHEN o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R') THEN 'test' ELSE 'train' END AS split FROM orders UNION ALL SELECT DISTINCT l_orderkey, 'test' FROM lineitem WHERE l_returnflag = 'R' AND l_orderkey NOT IN (SELECT o_orderkey FROM orders)")
def q_override(spark: SparkSession, d: str) -> DataFrame:
    test = table(spark, d, "lineitem").where("l_returnflag = 'R'").select(F.col("l_orderkey").alias("o_orderkey"), F.lit("test").alias("split")).distinct()
    return C.overridden(table(spark, d, "orders").select("o_orderkey", F.lit("train").alias("split")), test, ["o_orderkey"])


@query("SELECT l_suppkey, l_partkey, l_orderkey, l_linenumber FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_suppkey, l_partkey ORDER BY l_orderkey, l_linenumber, l_extendedprice) = 1")
def q_first_record(spark: SparkSession, d: str) -> DataFrame:
    return C.first_of(table(spark, d, "lineitem"), ["l_suppkey", "l_partkey"], ["l_orderkey", "l_linenumber", "l_extendedprice"]).select("l_suppkey", "l_partkey", "l_orderkey", "l_linenumber")


@query("WITH t AS (SELECT l_orderkey, count(DISTINCT (l_returnflag, l_linestatus)) > 1 AS conflict FROM lineitem GROUP BY 1) SELECT l_orderkey, l_linenumber, conflict FROM lineitem JOIN t USING (l_orderkey)")
def q_assertion_conflicts(spark: SparkSession, d: str) -> DataFrame:
    return C.conflicts(table(spark, d, "lineitem"), "l_orderkey", ["l_returnflag", "l_linestatus"]).select("l_orderkey", "l_linenumber", "conflict")


@query("WITH v AS (SELECT l_orderkey AS k, list(CASE l_returnflag WHEN 'A' THEN 'risk' WHEN 'R' THEN CASE WHEN l_linestatus = 'O' THEN 'protective' ELSE 'unknown' END ELSE '' END) FILTER (l_returnflag <> 'N') AS vs FROM lineitem GROUP BY 1), w AS (SELECT k, list_filter(coalesce(vs, []), lambda x: x <> '' AND x <> 'unknown') AS vs FROM v) SELECT k, array_to_string(list_sort(list_distinct(vs)), ',') AS directions, CASE WHEN len(vs) = 0 THEN 'unknown' WHEN len(list_distinct(vs)) > 1 THEN 'conflicting' WHEN len(vs) = 1 THEN 'single' ELSE 'consensus' END AS status FROM w")
def q_causal_status(spark: SparkSession, d: str) -> DataFrame:
    value = F.expr("CASE l_returnflag WHEN 'A' THEN 'risk' WHEN 'R' THEN CASE WHEN l_linestatus = 'O' THEN 'protective' ELSE 'unknown' END END")
    rows = table(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("k")).agg(F.collect_list(value).alias("vs"))
    known = F.filter("vs", lambda v: ~v.isin("", "unknown"))
    return rows.select("k", F.array_join(F.array_sort(F.array_distinct(known)), ",").alias("directions"), C.causal_status(F.col("vs")).alias("status"))


@query("WITH t AS (SELECT 'c' || c_custkey AS id, 0 AS o, lower(c_name) AS token FROM customer UNION ALL SELECT 'c' || c_custkey, 1, lower(c_mktsegment) FROM customer UNION ALL SELECT 'c' || c_custkey, 2, 'n' || c_nationkey FROM customer) SELECT token, arg_min(id, o::VARCHAR || '|' || id) AS id, min(o) AS \"order\" FROM t WHERE token <> '' GROUP BY token")
def q_token_resolver(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "customer").selectExpr("'c' || c_custkey AS id", "c_name", "c_mktsegment AS seg", "'N' || c_nationkey AS nation")
    return C.token_resolver(rows, ["c_name", "seg", "nation"])


@query("WITH v AS (SELECT l_orderkey, l_partkey * 10 + l_linenumber AS record_id FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY l_partkey * 10 + l_linenumber) <= 2) SELECT o_orderkey, record_id FROM orders LEFT JOIN v ON l_orderkey = o_orderkey")
def q_bounded_evidence(spark: SparkSession, d: str) -> DataFrame:
    v = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), (F.col("l_partkey") * 10 + F.col("l_linenumber")).alias("record_id"))
    return C.paired(table(spark, d, "orders").select("o_orderkey"), v, ["o_orderkey"], 2)


@query("WITH p AS (SELECT l_suppkey AS k, l_orderkey AS id, l_orderkey % 1000 AS pos FROM lineitem WHERE l_linenumber = 1), i AS (SELECT s_suppkey AS k, s_nationkey * 10 AS lo, s_nationkey * 10 + 200 AS hi FROM supplier) SELECT p.k AS gene, id, pos FROM p JOIN i ON p.k = i.k AND pos BETWEEN lo AND hi")
def q_point_in_gene(spark: SparkSession, d: str) -> DataFrame:
    points = table(spark, d, "lineitem").where("l_linenumber = 1").selectExpr("l_suppkey AS gene", "l_orderkey AS id", "l_orderkey % 1000 AS pos")
    return E.point_in_interval(points, table(spark, d, "supplier").selectExpr("s_suppkey AS gene", "s_nationkey * 10 AS lo", "s_nationkey * 10 + 200 AS hi"), "gene", 100).select("gene", "id", "pos")


@query("WITH a AS (SELECT l_suppkey, l_returnflag, l_linestatus, l_partkey % 20 AS s, l_orderkey * 10 + l_linenumber AS id FROM lineitem WHERE l_linenumber <= 3), b AS (SELECT l_suppkey, l_returnflag, l_linestatus, l_partkey % 20 AS s, l_orderkey * 10 + l_linenumber AS other FROM lineitem WHERE l_linenumber > 3) SELECT id, min(other) AS other FROM a JOIN b USING (l_suppkey, l_returnflag, l_linestatus, s) GROUP BY id")
def q_evidence_pairing(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "lineitem").selectExpr("l_suppkey", "l_returnflag", "l_linestatus", "l_partkey % 20 AS s", "l_orderkey * 10 + l_linenumber AS id", "l_linenumber AS n")
    key = ["l_suppkey", "l_returnflag", "l_linestatus", "s"]
    return E.paired_records(rows.where("n <= 3"), rows.where("n > 3").withColumnRenamed("id", "other"), key, "id", "other")


@query("WITH t AS (SELECT o_orderkey, unnest(['NCT' || lpad((o_orderkey % 500)::VARCHAR, 8, '0'), 'NCT' || lpad((o_custkey % 500)::VARCHAR, 8, '0')]) AS trial FROM orders), k AS (SELECT 'NCT' || lpad(c_custkey::VARCHAR, 8, '0') AS trial, c_name FROM customer) SELECT DISTINCT o_orderkey, trial, c_name FROM t JOIN k USING (trial)")
def q_trial_links(spark: SparkSession, d: str) -> DataFrame:
    field = F.concat(F.lit("nct"), F.lpad((F.col("o_orderkey") % 500).cast("string"), 8, "0"), F.lit("; also NCT"), F.lpad((F.col("o_custkey") % 500).cast("string"), 8, "0"))
    links = table(spark, d, "orders").select("o_orderkey", F.explode(text.nct_ids(field)).alias("trial"))
    return links.join(table(spark, d, "customer").select(F.concat(F.lit("NCT"), F.lpad(F.col("c_custkey").cast("string"), 8, "0")).alias("trial"), "c_name"), "trial")


@query("SELECT l_returnflag, l_linestatus, CASE WHEN l_linenumber < 5 THEN l_linenumber END AS dose, count(*) AS n FROM lineitem GROUP BY ALL")
def q_condition_counts(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "lineitem").groupBy("l_returnflag", "l_linestatus", F.when(F.col("l_linenumber") < 5, F.col("l_linenumber")).alias("dose")).agg(F.count("*").alias("n"))


@query("SELECT DISTINCT token FROM (SELECT 'customer' || c_custkey AS token FROM customer UNION SELECT c_mktsegment FROM customer UNION SELECT lower(p_brand) FROM part UNION SELECT unnest(string_split(p_name, ' ')) FROM part)")
def q_union_of_ids(spark: SparkSession, d: str) -> DataFrame:
    c, p = table(spark, d, "customer"), table(spark, d, "part")
    return E.union_of_ids(c.select(F.concat(F.lit("customer"), "c_custkey")), c.select("c_mktsegment"), p.select(F.lower("p_brand")), p.select(F.split("p_name", " ")))

"""Gene-id migration over the driver's tables: parts stand for NCBI genes, line items for their Ensembl ids and edges."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import gene_migration as M
from ..sources.tables import table
from .queries import query

FLAT = {
    "ids": ("part", {"ncbi_gene_id": "'' || p_partkey"}),
    "links": ("lineitem", {
        "tax_id": "CASE WHEN l_linenumber = 7 THEN '10090' ELSE '9606' END", "ncbi": "'' || (l_partkey - l_partkey % 5 + 1 + l_suppkey % 2)",
        "ensembl": "CASE WHEN l_suppkey % 10 = 9 THEN '-' ELSE 'ENSG' || (l_partkey - l_partkey % 5 + CASE WHEN l_partkey % 35 < 5 THEN l_suppkey % 3 ELSE 0 END) || '.' || l_linenumber END",
    }),
    "history": ("part", {"tax_id": "CASE WHEN p_partkey % 9 = 0 THEN '10090' ELSE '9606' END", "new": "CASE p_size % 3 WHEN 0 THEN '-' ELSE '' || (p_partkey - p_partkey % 5 + p_size % 5) END", "old": "'' || (p_partkey - p_partkey % 2)"}),
    "edge": ("lineitem", {
        "x_id": "CASE WHEN l_linenumber <= 3 THEN 'NCBI:' || l_partkey WHEN l_linenumber <= 5 THEN 'ENSG' || (l_partkey - l_partkey % 5) ELSE 'CHEMBL' || l_suppkey END", "x_type": "CASE WHEN l_linenumber <= 5 THEN 'gene' ELSE 'molecule' END",
        "y_id": "CASE WHEN l_linenumber = 2 THEN 'NCBI:' || (l_suppkey * 5 + 1) ELSE 'EFO:' || (l_suppkey % 20) END", "y_type": "CASE WHEN l_linenumber = 2 THEN 'gene' ELSE 'disease' END",
        "relation": "CASE WHEN l_linenumber = 2 THEN 'gene_interacts_gene' WHEN l_linenumber <= 5 THEN 'disease_associated_gene' ELSE 'molecule_treats_disease' END",
        "source": "l_returnflag", "credibility": "CASE WHEN l_quantity <= 17 THEN 1 WHEN l_quantity <= 34 THEN 2 ELSE 3 END", "display_relation": "l_linestatus",
    }),
}
_CTES = "WITH " + ", ".join(f"{name} AS (SELECT " + ", ".join(f'{e} AS "{c}"' for c, e in columns.items()) + f" FROM {source})" for name, (source, columns) in FLAT.items())
_MAP = f"""{_CTES}, a AS (SELECT ncbi, list_sort(list(DISTINCT split_part(ensembl, '.', 1))) AS t FROM links WHERE tax_id = '9606' AND ensembl LIKE 'ENSG%' GROUP BY ncbi),
h AS (SELECT old, max(nullif(new, '-')) AS r FROM history WHERE tax_id = '9606' GROUP BY old),
j AS (SELECT ncbi_gene_id, h.old IS NOT NULL AS retired, r, d.t AS direct, coalesce(d.t, e.t, []) AS t FROM (SELECT DISTINCT ncbi_gene_id FROM ids) LEFT JOIN a d ON d.ncbi = ncbi_gene_id LEFT JOIN h ON h.old = ncbi_gene_id LEFT JOIN a e ON e.ncbi = r),
m AS (SELECT ncbi_gene_id, 'NCBI:' || ncbi_gene_id AS node, CASE WHEN len(t) = 1 THEN CASE WHEN direct IS NOT NULL THEN 'accepted_1to1' ELSE 'retired_replaced_1to1' END WHEN len(t) > 1 THEN CASE WHEN direct IS NOT NULL THEN 'ambiguous_one_to_many' ELSE 'retired_replaced_ambiguous' END
  WHEN retired THEN CASE WHEN r IS NULL THEN 'retired_unmapped' ELSE 'retired_replacement_unmapped' END ELSE 'unmapped' END AS status, CASE WHEN len(t) = 1 THEN t[1] END AS ensembl, CASE WHEN len(t) > 0 THEN array_to_string(t, '|') END AS candidates, r FROM j)"""
_MOVED = f"""{_MAP}, u AS (SELECT relation, bool_or(x_id LIKE 'NCBI:%' OR y_id LIKE 'NCBI:%') AS affected FROM edge GROUP BY relation),
w AS (SELECT edge.*, affected, mx.ensembl AS xt, my.ensembl AS yt, mx.status AS xs, my.status AS ys, (x_id LIKE 'NCBI:%' AND mx.ensembl IS NULL) OR (y_id LIKE 'NCBI:%' AND my.ensembl IS NULL) AS lost
  FROM edge JOIN u USING (relation) LEFT JOIN m mx ON mx.node = x_id LEFT JOIN m my ON my.node = y_id),
k AS (SELECT relation, coalesce(xt, x_id) AS x_id, coalesce(yt, y_id) AS y_id, source, credibility, display_relation, affected, x_id AS ox, y_id AS oy FROM w WHERE NOT lost),
n AS (SELECT *, row_number() OVER (PARTITION BY relation, x_id, y_id ORDER BY credibility DESC NULLS LAST, source DESC NULLS LAST, display_relation DESC NULLS LAST, ox, oy) AS rank, count(*) OVER (PARTITION BY relation, x_id, y_id) AS same FROM k WHERE affected)"""


def _flat(spark: SparkSession, d: str, name: str) -> DataFrame:
    source, columns = FLAT[name]
    return table(spark, d, source).selectExpr(*[f"{e} AS `{c}`" for c, e in columns.items()])


def _mapping(spark: SparkSession, d: str) -> DataFrame:
    return M.authoritative_mapping(_flat(spark, d, "ids"), _flat(spark, d, "links"), _flat(spark, d, "history"))


def _moved(spark: SparkSession, d: str) -> dict[str, DataFrame]:
    return M.remapped(_flat(spark, d, "edge"), _mapping(spark, d))


@query(f"{_MAP} SELECT ncbi_gene_id, node AS ncbi_node_id, status AS mapping_status, ensembl AS canonical_ensembl_gene_id, candidates AS candidate_ensembl_gene_ids, r AS replacement_ncbi_gene_id FROM m")
def q_gene_mapping(spark: SparkSession, d: str) -> DataFrame:
    return _mapping(spark, d).drop("mapping_authority")


@query(f"""{_MAP}, g AS (SELECT DISTINCT split_part(ensembl, '.', 1) AS id FROM links WHERE ensembl LIKE 'ENSG%'), o AS (SELECT id, CASE WHEN substr(id, 5)::INT % 3 = 0 THEN substr(id, 5) || '|LOC7|9' END AS old FROM g),
t AS (SELECT id, unnest(list_distinct(list_filter(list_concat(string_split(coalesce(old, ''), '|'), coalesce((SELECT list(ncbi_gene_id) FROM m WHERE m.ensembl = o.id), [])), lambda x: x <> ''))) AS t FROM o)
SELECT id, (SELECT string_agg(t, '|' ORDER BY try_cast(t AS BIGINT) IS NULL, try_cast(t AS BIGINT), t) FROM t WHERE t.id = o.id) AS ncbi_gene_id FROM o""")
def q_merged_genes(spark: SparkSession, d: str) -> DataFrame:
    own = _flat(spark, d, "links").select(F.split_part("ensembl", F.lit("."), F.lit(1)).alias("id")).where("id LIKE 'ENSG%'").distinct()
    own = own.selectExpr("id", "CASE WHEN CAST(substr(id, 5) AS INT) % 3 = 0 THEN concat(substr(id, 5), '|LOC7|9') END AS ncbi_gene_id")
    gone = _flat(spark, d, "ids").selectExpr("concat('NCBI:', ncbi_gene_id) AS id", "ncbi_gene_id").union(_flat(spark, d, "ids").selectExpr("concat('ENSMUSG', ncbi_gene_id)", "CAST(NULL AS STRING)"))
    return M.merge_gene_nodes(own.union(gone), _mapping(spark, d))


@query(f"{_MOVED} SELECT relation, x_id, y_id, source, credibility, display_relation FROM n WHERE rank = 1 UNION ALL SELECT relation, x_id, y_id, source, credibility, display_relation FROM k WHERE NOT affected")
def q_migrated_edges(spark: SparkSession, d: str) -> DataFrame:
    return _moved(spark, d)["after"].select("relation", "x_id", "y_id", "source", "credibility", "display_relation")


@query(f"{_MOVED} SELECT relation, x_id, y_id, source, CASE WHEN x_id LIKE 'NCBI:%' AND xs LIKE 'ambiguous%' THEN 'ambiguous_x' WHEN y_id LIKE 'NCBI:%' AND ys LIKE 'ambiguous%' THEN 'ambiguous_y' WHEN x_id LIKE 'NCBI:%' THEN coalesce(xs, 'unmapped_x') ELSE coalesce(ys, 'unmapped_y') END AS quarantine_reason FROM w WHERE lost")
def q_migration_quarantine(spark: SparkSession, d: str) -> DataFrame:
    return _moved(spark, d)["quarantine"].select("relation", "x_id", "y_id", "source", "quarantine_reason")


@query(f"{_MOVED} SELECT relation, x_id AS canonical_x_id, y_id AS canonical_y_id, ox AS source_x_id, oy AS source_y_id, rank AS dedup_rank, rank = 1 AS retained, ox <> x_id OR oy <> y_id AS endpoint_rewritten FROM n WHERE same > 1")
def q_migration_lineage(spark: SparkSession, d: str) -> DataFrame:
    return _moved(spark, d)["lineage"].drop("source_row")


@query(f"""{_MOVED}, c AS (SELECT relation, x_id, y_id, count(*) AS n, count(DISTINCT ox || ' ' || oy) AS different, bool_or(ox <> x_id OR oy <> y_id) AS rewrite FROM n WHERE same > 1 GROUP BY ALL),
f AS (SELECT relation, sum(n - 1)::BIGINT AS n_collisions, bool_and(different = n AND rewrite) AS fair FROM c GROUP BY relation), z AS (SELECT relation, count(*) AS n_after FROM (SELECT relation FROM n WHERE rank = 1 UNION ALL SELECT relation FROM k WHERE NOT affected) GROUP BY relation)
SELECT relation, count(*) AS n_rows, count(*) FILTER (x_id LIKE 'NCBI:%' OR y_id LIKE 'NCBI:%') AS n_affected, count(*) FILTER (lost) AS n_quarantine, any_value(n_after) AS n_after, coalesce(any_value(n_collisions), 0) AS n_collisions,
  count(*) = any_value(n_after) + count(*) FILTER (lost) + coalesce(any_value(n_collisions), 0) AND coalesce(any_value(fair), true) AS conserved FROM w LEFT JOIN z USING (relation) LEFT JOIN f USING (relation) GROUP BY relation""")
def q_migration_report(spark: SparkSession, d: str) -> DataFrame:
    return _moved(spark, d)["report"]

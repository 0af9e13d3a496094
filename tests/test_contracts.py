"""Errors that contracts raise, rules of look-ups and ingests on small rows, and some registered queries against their SQL."""

import duckdb
import pytest
from pyspark.sql import functions as F

from kgloom.functions import schema
from kgloom.operators import builders as B
from kgloom.operators import contracts as C
from kgloom.operators import evaluation as V
from kgloom.operators import ingest as I
from kgloom.operators import lookups as L
from kgloom.plans import builder_queries, contract_queries, evaluation_queries, ingest_queries  # noqa: F401
from kgloom.plans import queries as Q

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings labels".split()
SOME = """q_diseases_for_gene q_relation_artifacts q_sequence_report q_fingerprint_report q_weighted_vectors q_token_resolver q_split_cv_inner q_split_few_neighbours q_top_k_metrics q_micro_macro q_link_split
q_ingest_target_products q_ingest_evidence_edges q_ingest_essentiality q_ingest_variants q_ingest_enhancers q_locus_links q_located_proteins q_paralog_rejects q_interval_sequences""".split()


@pytest.mark.parametrize("name", SOME)
def test_matches_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    got = Q.QUERIES[name](spark, SF)
    names = sorted(got.columns)
    cur = con.execute("SELECT {} FROM ({})".format(", ".join(f'"{c}"' for c in names), Q.ORACLE_SQL[name]))
    plain = lambda rows: sorted(tuple(f"{v:.7g}" if isinstance(v, float) else str(v) for v in r) for r in rows)
    assert plain(map(tuple, got.select(names).collect())) == plain(cur.fetchall())


def test_registry():
    assert len(schema.RELATIONS) == 67 and len(schema.NODE_TYPES) == 15
    assert schema.relations_between("gene", "disease") == ["disease_associated_gene"] and "paper_cites_paper" in schema.disconnected()
    assert all({r.source, r.target} <= set(schema.NODE_TYPES) for r in schema.RELATIONS.values())
    with pytest.raises(ValueError):
        schema.relation("none")


def test_a_gene_is_asked_for_by_one_value(spark):
    cols = "id string, ncbi_gene_id string, hgnc_id string, uniprot_id string, gene_name string, name string, description string, source string"
    genes = spark.createDataFrame([("ENSG1", "672", None, None, "BRCA1", "BRCA1", None, "s"), ("NCBI:672", None, None, None, "brca1", None, None, "s"), ("ENSMUSG1", None, None, None, "Brca1", None, "mouse ortholog of BRCA1", "target.homologues"), ("X", None, None, None, None, "other", "brca1", "s")], cols)
    assert [(r.id, r.match_kind) for r in L.resolve_gene(genes, symbol=" brca1 ").orderBy("rank").collect()] == [("ENSG1", "gene_name"), ("NCBI:672", "gene_name"), ("X", "description")]
    assert L.resolve_gene(genes, gene_id="ENSMUSG1").count() == 1 and L.resolve_gene(genes, "ENSMUSG1").count() == 0 and L.resolve_gene(genes, "brca1", human_only=False).count() == 4
    assert [r.match_kind for r in L.resolve_gene(genes, "672", limit=1).collect()] == ["ncbi_gene_id"]
    for bad in ({}, {"identifier": "a", "symbol": "b"}, {"symbol": " "}):
        with pytest.raises(ValueError):
            L.resolve_gene(genes, **bad)


def test_errors(spark):
    edges = spark.createDataFrame([("r", "a", "b", "g", "h")], "relation string, x_id string, y_id string, x_type string, y_type string")
    nodes = spark.createDataFrame([("g", "a")], "node_type string, id string")
    with pytest.raises(ValueError, match="r has 1 dangling"):
        V.indexed_edges(edges, nodes)
    assert V.indexed_edges(edges, nodes, strict=False).count() == 0
    with pytest.raises(ValueError, match="h"):
        C.missing_types(edges, nodes)
    with pytest.raises(ValueError):
        C.context_report(edges, "none")
    with pytest.raises(ValueError, match="no key"):
        C.paired(edges.unionAll(edges), edges.withColumn("record_id", F.lit(1)), ["x_id"], 1)
    with pytest.raises(ValueError):
        I.orthologs(spark.createDataFrame([("ENSG1", None)], "id string, homologues array<string>"))
    with pytest.raises(ValueError, match="more than 1"):
        B.projected(spark.createDataFrame([(1,), (1,)], "gene int"), spark.createDataFrame([(1, "p")], "gene int, protein string"), 1)


def test_small_splits(spark):
    assert {r.split for r in V.link_split(spark.range(3), "id", 1).collect()} == {"train", "valid", "test"}
    assert V.link_split(spark.range(2), "id", 1).count() == 0
    parts = [V.cross_fold(spark.range(43), "id", 1, 20, k).where("split = 'test'").count() for k in (0, 2, 3, 19)]
    assert parts == [3, 3, 2, 2]


def test_pooled_vectors_have_length_one(spark):
    rows = spark.createDataFrame([("a", [3.0, 0.0], 1.0), ("a", [0.0, 4.0], 0.0), ("b", [0.0, 0.0], 1.0)], "k string, vector array<double>, w double")
    assert {r.k: r.vector for r in C.pooled(rows, "k", F.col("w")).collect()} == {"a": [1.0, 0.0], "b": [0.0, 0.0]}

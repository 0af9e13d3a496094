"""Gene-id migration: every status, alias unions, quarantine reasons, collisions with lineage, conservation."""

import pytest

from kgloom.operators import gene_migration as M


def mapping(spark):
    ids = spark.createDataFrame([(str(i),) for i in range(1, 9)] + [("1",)], "ncbi_gene_id string")
    links = [("9606", "1", "ENSG1.4"), ("9606", "1", "ENSG1.5"), ("9606", "2", "ENSG2"), ("9606", "2", "ENSG3"), ("9606", "20", "ENSG4"), ("9606", "30", "ENSG5"), ("9606", "30", "ENSG6"), ("9606", "7", "-"), ("10090", "7", "ENSG7"), ("9606", "7", "ENSMUSG7"), ("9606", "8", "ENSG1")]
    history = [("9606", "20", "3"), ("9606", "30", "4"), ("9606", "-", "5"), ("9606", "99", "6"), ("10090", "20", "7"), ("9606", "20", "1")]
    return M.authoritative_mapping(ids, spark.createDataFrame(links, "tax_id string, ncbi string, ensembl string"), spark.createDataFrame(history, "tax_id string, new string, old string"))


def test_every_status(spark):
    found = {r["ncbi_gene_id"]: (r["mapping_status"], r["canonical_ensembl_gene_id"], r["candidate_ensembl_gene_ids"]) for r in mapping(spark).collect()}
    assert found == {
        "1": ("accepted_1to1", "ENSG1", "ENSG1"), "2": ("ambiguous_one_to_many", None, "ENSG2|ENSG3"), "3": ("retired_replaced_1to1", "ENSG4", "ENSG4"), "4": ("retired_replaced_ambiguous", None, "ENSG5|ENSG6"),
        "5": ("retired_unmapped", None, None), "6": ("retired_replacement_unmapped", None, None), "7": ("unmapped", None, None), "8": ("accepted_1to1", "ENSG1", "ENSG1"),
    }


def test_merged_genes_unite_their_aliases(spark):
    genes = spark.createDataFrame([("ENSG1", "10|LOC2| 8", "a"), ("ENSG4", None, "b"), ("ENSG9", "", "c"), ("NCBI:1", "1", "d"), ("ENSMUSG3", None, "e")], "id string, ncbi_gene_id string, name string")
    assert sorted(map(tuple, M.merge_gene_nodes(genes, mapping(spark)).collect())) == [("ENSG1", "1|8|10|LOC2", "a"), ("ENSG4", "3", "b"), ("ENSG9", None, "c")]
    assert dict(map(tuple, M.gene_classes(genes).collect())) == {"human_ensg": 3, "human_ncbi": 1, "nonhuman_ensembl": 1}
    with pytest.raises(Exception, match="unclassified gene id odd"):
        M.merge_gene_nodes(genes.union(spark.createDataFrame([("odd", None, "x")], genes.schema)), mapping(spark)).collect()
    with pytest.raises(Exception, match="target is absent: ENSG4"):
        M.merge_gene_nodes(genes.where("id <> 'ENSG4'"), mapping(spark)).collect()


EDGE = "relation string, x_id string, x_type string, y_id string, y_type string, source string, credibility int, edge_key string"


def edges(spark, rows):
    return spark.createDataFrame([(r, x, "gene" if x[0] in "NE" else "molecule", y, "gene" if y[:4] in ("NCBI", "ENSG") else "disease", s, c, f"{r}|{x}|{y}") for r, x, y, s, c in rows], EDGE)


ROWS = [
    ("g", "NCBI:1", "EFO:1", "a", 1), ("g", "ENSG1", "EFO:1", "b", 1), ("g", "NCBI:8", "EFO:1", "z", 3),  # one edge after the remap
    ("g", "NCBI:3", "EFO:2", "a", 1), ("g", "NCBI:2", "EFO:1", "a", 1), ("g", "NCBI:5", "EFO:1", "a", 1), ("g", "NCBI:77", "EFO:1", "a", 1),
    ("i", "ENSG1", "NCBI:4", "a", 1), ("i", "NCBI:2", "NCBI:4", "a", 1), ("i", "ENSG9", "NCBI:7", "a", 1),
    ("t", "M1", "EFO:1", "a", 1), ("t", "M1", "EFO:1", "a", 1),
]


def test_edges_move_with_quarantine_and_lineage(spark):
    found = M.remapped(edges(spark, ROWS), mapping(spark))
    after = sorted((r["relation"], r["x_id"], r["y_id"], r["source"], r["edge_key"]) for r in found["after"].collect())
    assert after == [("g", "ENSG1", "EFO:1", "z", "g|ENSG1|EFO:1"), ("g", "ENSG4", "EFO:2", "a", "g|ENSG4|EFO:2"), ("t", "M1", "EFO:1", "a", "t|M1|EFO:1"), ("t", "M1", "EFO:1", "a", "t|M1|EFO:1")]
    assert sorted((r["x_id"], r["y_id"], r["quarantine_reason"]) for r in found["quarantine"].collect()) == [
        ("ENSG1", "NCBI:4", "retired_replaced_ambiguous"), ("ENSG9", "NCBI:7", "unmapped"), ("NCBI:2", "EFO:1", "ambiguous_x"), ("NCBI:2", "NCBI:4", "ambiguous_x"), ("NCBI:5", "EFO:1", "retired_unmapped"), ("NCBI:77", "EFO:1", "unmapped_x"),
    ]
    lineage = sorted((r["dedup_rank"], r["source_x_id"], r["retained"], r["endpoint_rewritten"]) for r in found["lineage"].collect())
    assert lineage == [(1, "NCBI:8", True, True), (2, "ENSG1", False, False), (3, "NCBI:1", False, True)]
    report = {r["relation"]: tuple(r)[1:] for r in found["report"].collect()}
    assert report == {"g": (7, 6, 3, 2, 2, True), "i": (3, 3, 3, 0, 0, True), "t": (2, 0, 0, 2, 0, True)}
    nodes = spark.createDataFrame([("gene", "ENSG1"), ("gene", "ENSG4"), ("disease", "EFO:1"), ("molecule", "M1")], "node_type string, id string")
    assert [tuple(r) for r in M.migration_failures(found["after"], found["report"], nodes).collect()] == [("g", "missing_node", 1)]


def test_row_ids_do_not_depend_on_order(spark):
    one, other = (M.remapped(edges(spark, rows).repartition(n), mapping(spark))["lineage"] for rows, n in ((ROWS, 1), (ROWS[::-1], 4)))
    assert sorted(map(tuple, one.collect())) == sorted(map(tuple, other.collect()))


def test_edges_that_were_equal_before_are_told(spark):
    found = M.remapped(edges(spark, ROWS[:1] * 2 + ROWS[3:4]), mapping(spark))["report"].first()
    assert (found["n_rows"], found["n_after"], found["n_collisions"], found["conserved"]) == (3, 2, 1, False)


def test_evidence_keeps_all_rows_and_old_ends(spark):
    found = M.remapped(edges(spark, ROWS), mapping(spark), evidence=True)
    assert found["after"].where("relation = 'g'").count() == 4 and found["quarantine"].count() == 6
    assert {r["canonicalization_source_x_id"] for r in found["after"].where("x_id = 'ENSG1'").collect()} == {"NCBI:1", "ENSG1", "NCBI:8"}
    assert all(r["conserved"] for r in found["report"].collect())


def test_an_end_of_another_species_is_an_error(spark):
    with pytest.raises(Exception, match="another species"):
        M.remapped(edges(spark, [("g", "ENSMUSG1", "EFO:1", "a", 1)]), mapping(spark))["after"].collect()


def test_a_relation_is_not_one_task(spark):
    from kgloom.operators import gene_migration as G

    rows = spark.createDataFrame([("r", "NCBI:1", "gene", "d", "disease")], "relation string, x_id string, x_type string, y_id string, y_type string")
    mapping = spark.createDataFrame([("NCBI:1", "ENSG1", "accepted_1to1")], "ncbi_node_id string, canonical_ensembl_gene_id string, mapping_status string")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = G.remapped(rows, mapping)["after"]._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin [relation" not in plan

"""Keyed tables under dying and repeated batches; manifests that read new files only; provenance."""

import pytest
from pyspark.sql import functions as F

from kgloom.operators.edges import merge_edges
from kgloom.sources import files
from kgloom.sources.manifest import finalise, labels, read_provenance, table_entries, update_manifest, write_provenance
from kgloom.sources.store import EVIDENCE_KEY, KGRoot
from kgloom.streaming import append
from kgloom.streaming.keyed import KeyedTable

EDGE = "x_id string, y_id string, relation string, source string, pos long, credibility long"


def batches(spark, n=3):
    rows = [(f"x{k % 17}", f"y{k % 5}", "r", f"s{k % 4}", 1000 - k, k % 3 + 1) for k in range(90)]
    return [spark.createDataFrame(rows[i::n], EDGE) for i in range(n)], spark.createDataFrame(rows, EDGE)


def told(df):
    return sorted(map(tuple, df.select(sorted(df.columns)).collect()))


def test_edges_in_batches_equal_one(spark, tmp_path):
    parts, whole = batches(spark)
    table = append.edge_table(spark, str(tmp_path / "t"), cuts=8)
    for k, part in enumerate(parts):
        table.fold(part, k)
        table.fold(parts[0], k)  # comes again: nothing happens
    assert told(append.current(spark, table.uri)) == told(merge_edges(whole))
    assert told(table.current(0)) == told(table.merge(parts[0]).withColumn("cut", F.pmod(F.xxhash64(*table.keys), F.lit(8)).cast("string")).drop("cut"))
    with pytest.raises(ValueError):
        table.fold(parts[0], -1)


def test_a_batch_that_dies_before_its_commit(spark, tmp_path, monkeypatch):
    parts, whole = batches(spark)
    table = append.edge_table(spark, str(tmp_path / "t"), cuts=8)
    table.fold(parts[0], 0)
    before = told(table.current())
    commit = KeyedTable._commit
    monkeypatch.setattr(KeyedTable, "_commit", lambda *a: (_ for _ in ()).throw(RuntimeError("killed")))
    with pytest.raises(RuntimeError):
        table.fold(parts[1], 1)
    assert files.exists(spark, f"{table.uri}/data/batch=1") and told(table.current()) == before
    monkeypatch.setattr(KeyedTable, "_commit", commit)
    for k in (1, 2):
        table.fold(parts[k], k)
    assert told(append.current(spark, table.uri)) == told(merge_edges(whole))


def test_a_batch_rewrites_only_the_cuts_it_touches(spark, tmp_path):
    parts, _ = batches(spark)
    table = append.edge_table(spark, str(tmp_path / "t"), cuts=16)
    table.fold(parts[0], 0)
    one = spark.createDataFrame([("x0", "y0", "r", "s9", 1, 3)], EDGE)
    table.fold(one, 1)
    assert len([n for n in files.names(spark, f"{table.uri}/data/batch=1") if n.startswith("cut=")]) == 1
    table.fold(one.limit(0), 2)
    now = told(table.current())
    assert table.vacuum() == [] and told(table.current()) == now  # batch 0 still holds other cuts
    table.fold(parts[0], 3)
    now = told(table.current())
    assert set(table.vacuum()) >= {1} and told(table.current()) == now
    with pytest.raises(FileNotFoundError):
        append.edge_table(spark, str(tmp_path / "none")).current()


def test_streams_of_edges_and_evidence(spark, tmp_path):
    parts, whole = batches(spark)
    for k, part in enumerate(parts[:2]):
        part.coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    go = lambda: append.append_edges(spark, str(tmp_path / "in"), parts[0].schema, str(tmp_path / "t"), str(tmp_path / "p"), cuts=4)
    go()
    parts[2].coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    go()
    go()
    assert told(append.edge_table(spark, str(tmp_path / "t"), 4).current().groupBy("x_id").count()) == told(append.edge_table(spark, "", 4).merge(whole).groupBy("x_id").count())
    columns = [*EVIDENCE_KEY, "pos", "evidence_score"]
    rows = [tuple("k" if c != "x_id" else f"x{k % 7}" for c in EVIDENCE_KEY) + (k, float(k)) for k in range(20)]
    schema = ", ".join(f"{c} string" for c in EVIDENCE_KEY) + ", pos long, evidence_score double"
    for part in (rows[:8], rows[8:]):
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "ev"))
    append.append_evidence(spark, str(tmp_path / "ev"), spark.createDataFrame([], schema).schema, str(tmp_path / "et"), str(tmp_path / "ep"), cuts=4)
    found = append.evidence_table(spark, str(tmp_path / "et"), columns, 4).current()
    assert sorted((r["x_id"], r["evidence_score"]) for r in found.collect()) == sorted((f"x{k % 7}", float(k)) for k in range(13, 20))


def test_manifest_reads_new_files_only(spark, tmp_path):
    root = KGRoot(spark, str(tmp_path))
    nodes = spark.createDataFrame([(f"D{k}", f"n{k}", None) for k in range(30)], "id string, name string, mondo_id string").withColumns({c: F.lit(None).cast("string") for c in ("omim_id", "doid_id", "icd10_code", "mesh_id", "hp_id")})
    root.write_nodes("disease", nodes)
    edges = spark.createDataFrame([("disease_subtype_of_disease", f"D{k}", "disease", f"D{k + 1}", "disease", "s", "sub", 3) for k in range(20)], "relation string, x_id string, x_type string, y_id string, y_type string, source string, display_relation string, credibility long")
    root.write_edges("disease_subtype_of_disease", edges)
    first, read = update_manifest(root)
    assert read and update_manifest(root)[1] == []
    entries = {(r["layer"], r["name"]): r for r in table_entries(root, first).collect()}
    e = entries["nodes", "disease"]
    assert (e["n_rows"], e["key"]) == (30, "kg/v2/nodes/disease.parquet") and e["n_files"] >= 1 and "id:string" in e["dtypes"] and e["bytes"] > 0
    # a file more is the only one read, and sums add up
    spark.createDataFrame([("D99", "x")], "id string, name string").coalesce(1).write.mode("append").parquet(root.path("nodes", "disease"))
    second, read = update_manifest(root)
    assert len(read) == 1 and "disease" in read[0]
    grown = {(r["layer"], r["name"]): r for r in table_entries(root, second).collect()}
    assert grown["nodes", "disease"]["n_rows"] == 31 and grown["edges", "disease_subtype_of_disease"]["fingerprint"] == entries["edges", "disease_subtype_of_disease"]["fingerprint"]
    # the same rows in other files have the same fingerprint, one changed cell another
    root.write_nodes("disease", root.read("nodes", "disease").repartition(5))
    third = {r["name"]: r for r in table_entries(root, update_manifest(root)[0]).collect()}
    assert third["disease"]["fingerprint"] == grown["nodes", "disease"]["fingerprint"]
    root.write_nodes("disease", root.read("nodes", "disease").withColumn("name", F.when(F.col("id") == "D3", "other").otherwise(F.col("name"))))
    assert {r["name"]: r for r in table_entries(root, update_manifest(root)[0]).collect()}["disease"]["fingerprint"] != third["disease"]["fingerprint"]
    counts = finalise(root, {"a": "b"}, "v1")
    assert counts["nodes"] == {"disease": 31} and counts["total_rows"] == 51 and read_provenance(root)["row_counts"]["edges"] == {"disease_subtype_of_disease": 20}
    assert "- disease: 31 rows (" in files.read_text(spark, f"{root.uri}/metadata/SUMMARY.md")
    write_provenance(root, {"x": 1}, "abc", "v2")
    assert (read_provenance(root)["code_sha"], read_provenance(root)["sources"]) == ("abc", {"x": 1})


def test_labels():
    assert labels("edges", "gene_has_transcript") == sorted(["kg", "kg-v2", "canonical", "kg-layer:edges", "relation:gene_has_transcript", "x_type:gene", "y_type:transcript", "kind:central_dogma", "direct:yes"])
    assert "node_type:gene" in labels("nodes", "gene") and "node_type:protein" in labels("features", "protein_sequence")

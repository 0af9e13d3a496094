"""Look-ups, composition gates, validation, sampling, the store and text formats on small tables."""

import duckdb
import pytest
from pyspark.sql import functions as F

from kgloom.functions import text as T
from kgloom.operators import composition as C
from kgloom.operators import lookups as L
from kgloom.operators import sampling as S
from kgloom.operators import validate as V
from kgloom.plans import lookup_queries, sampling_queries  # noqa: F401
from kgloom.plans import queries as Q
from kgloom.sources import texts
from kgloom.sources.store import KGRoot

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
NAMES = [n for n, f in Q.QUERIES.items() if f.__module__ in (lookup_queries.__name__, sampling_queries.__name__)]


@pytest.mark.parametrize("name", NAMES)
def test_matches_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    got = Q.QUERIES[name](spark, SF)
    names = sorted(got.columns)
    cur = con.execute("SELECT {} FROM ({})".format(", ".join(f'"{c}"' for c in names), Q.ORACLE_SQL[name]))
    plain = lambda rows: sorted(tuple(f"{v:.9g}" if isinstance(v, float) else str(v) for v in r) for r in rows)
    assert plain(map(tuple, got.select(names).collect())) == plain(cur.fetchall())


def test_resolve_ranks_id_before_name(spark):
    nodes = spark.createDataFrame([("a", "x", "b"), ("b", None, "y"), ("c", "b", "z"), ("d", None, "B"), ("e", None, None)], "id string, xref string, name string")
    assert [(r.id, r.match_kind, r["rank"]) for r in L.resolve(nodes, "b", ("xref",)).orderBy("rank").collect()] == [("b", "id", 1), ("c", "xref", 2), ("a", "name", 3), ("d", "name_nocase", 4)]


def test_alias_search_says_when_it_stops(spark):
    given = [("a", "n", "A", 0, "redder"), ("b", "n", "B", 0, "reddish"), ("c", "n", "C", 0, "scarred"), ("d", "n", "D", 0, "blue"), ("a", "n", "A", 1, "red"), ("e", "m", "E", 0, "red")]
    rows = spark.createDataFrame(given, "id string, node_type string, name string, pos int, alias string")
    found = L.alias_search(rows, "RED", 2).orderBy("place").collect()
    assert [(r.id, r.score, r.truncated) for r in found] == [("e", 0, True), ("a", 1, True)]  # the first alias of a that matches, not its best
    assert not L.alias_search(rows, "red", 4).first().truncated
    assert [r.id for r in L.alias_search(rows, "red", 4, ["m"]).collect()] == ["e"]


def test_unknown_shard_is_an_error(spark):
    with pytest.raises(ValueError):
        L.shard(spark.createDataFrame([("a",)], "k string"), "k", "z", ["k"])


def test_gates_fail_closed(spark):
    a = spark.createDataFrame([("x", "m", "t1", "s1"), ("x", "n", None, "s1"), ("x", "o", "t1", "s1"), ("x", "o", "t2", "s1")], "x string, y string, tissue string, source string")
    b = spark.createDataFrame([("m", "y", "t1", "s2"), ("n", "y", "t1", "s2"), ("o", "y", "t1", "s1")], "x string, y string, tissue string, source string")
    p = C.join_premises(*[C.with_evidence(df, "x", "y", {"tissue": "tissue"}, ["source"]) for df in (a, b)])
    got = {r.mid: (r.c, r.s, r.i, r.st) for r in p.select("mid", C.compatible("tissue").alias("c"), C.shares("tissue").alias("s"), C.independent().alias("i"), C.status(F.col("a_tissue")).alias("st")).collect()}
    assert got == {"m": (True, True, True, "known"), "n": (True, False, True, "unknown"), "o": (False, False, False, "conflicting")}


def test_group_needs_disjoint_sources(spark):
    rows = spark.createDataFrame([("g", "m1", "y", ["a"]), ("g", "m2", "y", ["b"]), ("h", "m1", "y", ["a"]), ("h", "m2", "y", ["a", "b"])], "group string, member string, y_id string, sources array<string>")
    assert [tuple(r) for r in C.group_candidates(rows).collect()] == [("g", "y", 2)]
    assert C.group_candidates(rows, most=1).count() == 0


def test_table_diff(spark):
    a = spark.createDataFrame([(1, "x"), (2, None), (3, "z")], "k int, v string")
    b = spark.createDataFrame([(1, "y"), (2, None), (4, "z")], "k int, v string")
    assert {r.difference: r.n for r in V.table_diff(a, b, "k", ["v"]).collect()} == {"v": 1, "only_a": 1, "only_b": 1}


def test_weighted_negatives_cover_all_edges(spark):
    e = spark.createDataFrame([(f"x{i}", f"y{j}") for i in range(20) for j in range(i % 5 + 1)], "x_id string, y_id string")
    got = S.weighted_targets(e, 3, 1)
    assert got.count() == 3 * e.count() and got.exceptAll(S.weighted_targets(e.repartition(5), 3, 1)).count() == 0


def test_closure_of_a_cycle_ends(spark):
    edges = spark.createDataFrame([("b", "a"), ("c", "b"), ("a", "c"), ("d", "c")], "child string, parent string")
    assert {r.id: r.depth for r in S.descendants(edges, spark.createDataFrame([("a",)], "id string")).collect()} == {"a": 0, "b": 1, "c": 2, "d": 3}


def test_text_fields(spark):
    one = lambda c: spark.range(1).select(c).first()[0]
    assert one(T.nct_ids(F.lit("nct00000001, NCT00000002 nct00000001"))) == ["NCT00000001", "NCT00000002"]
    assert one(T.reverse_complement(F.lit("AACGTn"))) == "NACGTT"
    assert one(T.slug(F.lit("  Golgi (app.) "))) == "golgi-app"
    assert one(T.id_variants(F.lit("PMID:1"))) == ["PMID:1", "PMID_1", "1"]
    assert one(T.trial_class(F.lit("Terminated"), F.lit("Sponsor decision"))) == "terminated_business_funding_or_feasibility"
    assert one(T.doi(F.lit("https://doi.org/10.1000/AB.c"))) == "10.1000/ab.c" and one(T.doi(F.lit("none"))) is None


def test_store_keeps_last_node_and_merges_edges(spark, tmp_path):
    kg = KGRoot(spark, str(tmp_path))
    kg.write_nodes("thing", spark.createDataFrame([("a", "old"), ("b", "old")], "id string, name string"))
    kg.write_nodes("thing", spark.createDataFrame([("a", "new", "x"), (None, "new", "x")], "id string, name string, extra string"), append=True)
    with pytest.raises(ValueError, match="hgnc_id"):  # a registered type needs its cross-references
        kg.write_nodes("gene", spark.createDataFrame([("a", "old")], "id string, name string"))
    assert {r.id: r.name for r in kg.read("nodes", "thing").collect()} == {"a": "new", "b": "old"}
    cols = "x_id string, x_type string, y_id string, y_type string, relation string, display_relation string, source string, credibility long, _pos long"
    edge = lambda s, c, p: ("a", "g", "b", "g", "r", "r", s, c, p)
    kg.write_edges("r", spark.createDataFrame([edge("s2", 1, 0), edge("s1", 3, 1)], cols))
    kg.write_edges("r", spark.createDataFrame([edge("s3", 2, 0)], cols), append=True)
    assert [(r.source, r.credibility) for r in kg.read("edges", "r").collect()] == [("s2,s1,s3", 3)]
    one = spark.createDataFrame([("r", "a", "b", "r", "r", 3, "s", 1), ("r", "a", "b", "r", "r", 1, "s", 0)], "relation string, x_id string, y_id string, x_type string, y_type string, credibility long, source string, _pos long").withColumn("display_relation", F.lit("r"))
    kg.write_edges("single", one)
    assert [r.credibility for r in kg.read("edges", "single").collect()] == [1]  # one source in all: the first row's
    kg.write_edges("papers", one.withColumn("paper_id", F.col("_pos").cast("string")))
    assert [r.credibility for r in kg.read("edges", "papers").collect()] == [2]  # two papers
    name = "disease_associated_gene"
    full = "relation string, x_id string, x_type string, y_id string, y_type string, evidence_type string, source string, source_dataset string, source_record_id string, text_span string, evidence_score double, _pos long"
    record = lambda span, score, pos, y="disease": (name, "a", "gene", "b", y, "paper", "s", "d", "1", span, score, pos)
    kg.write_evidence(name, spark.createDataFrame([record("t", 0.5, 0), record("u", 0.7, 1)], full))  # the span is no part of the key
    row = kg.read("evidence", name).collect()
    assert len(row) == 1 and (row[0].evidence_score, row[0].edge_key, row[0].paper_id, row[0].p_value) == (0.7, f"{name}|a|b", "", None) and len(row[0]) == 25
    for bad in (spark.createDataFrame([record("t", 0.5, 0, "gene")], full), spark.createDataFrame([record("t", 0.5, 0)], full).drop("source_dataset")):
        with pytest.raises(ValueError):
            kg.write_evidence(name, bad)
    with pytest.raises(ValueError, match="unknown"):
        kg.write_evidence("r", spark.createDataFrame([record("t", 0.5, 0)], full))
    for gone in ("single", "papers"):
        kg.remove_source(gone, "s")
    assert kg.remove_source("r", "none") == 0 and kg.remove_source("r", "s2,s1,s3") == 1 and kg.read("edges", "r").count() == 0
    assert {(r.layer, r.name): r.n_rows for r in kg.catalog().collect()} == {("nodes", "thing"): 2, ("edges", "r"): 0, ("edges", "single"): 0, ("edges", "papers"): 0, ("evidence", "disease_associated_gene"): 1}
    with pytest.raises(ValueError):
        kg.bounded("nodes", "gene", ["id"], 10_001)


def test_text_formats(spark, tmp_path):
    put = lambda name, s: (tmp_path / name).write_text(s) and str(tmp_path / name)
    rows = texts.fasta(spark, put("a.fa", ">p1 first\nACG\nTT\n>p2\nGG\n")).orderBy("id").collect()
    assert [tuple(r) for r in rows] == [("p1", "first", "ACGTT"), ("p2", "", "GG")]
    obo = 'format-version: 1.2\n\n[Term]\nid: CL:1\nname: cell\ndef: "A cell." [x]\nis_a: CL:0 ! root\nxref: FMA:1\n\n[Term]\nid: CL:2\nname: gone\nis_obsolete: true\n'
    assert [tuple(r) for r in texts.stanzas(spark, put("a.obo", obo)).collect()] == [("CL:1", "cell", "A cell.", ["CL:0"], ["FMA:1"])]
    gtf = '#x\nchr1\ts\tgene\t5\t9\t.\t+\t.\tgene_id "G1"; gene_name "N1";\nchr1\ts\texon\t5\t9\t.\t+\t.\tgene_id "G1";\n'
    assert [tuple(r) for r in texts.gtf_genes(spark, put("a.gtf", gtf)).collect()] == [("G1", "N1", "1", 5, 9, "+")]
    assert sorted(map(tuple, texts.wide_matrix(spark, put("a.csv", "id,g1,g2\nr1,1.5,\nr2,x,2\n")).collect())) == [("r1", "g1", 1.5), ("r2", "g2", 2.0)]


def test_shared_neighbours_are_counted_without_shuffling_pairs(spark):
    import random
    from collections import Counter

    from kgloom.operators import sampling as S

    rnd = random.Random(8)
    e = {(f"x{rnd.randrange(40)}", f"y{rnd.randrange(25)}") for _ in range(300)} | {(f"x{k}", "hub") for k in range(40)}
    by: dict = {}
    for x, y in e:
        by.setdefault(y, []).append(x)
    want = Counter((a, b) for xs in by.values() for a in xs for b in xs if a != b)
    assert {(r["x_id"], r["other"]): r["common"] for r in S._common(spark.createDataFrame(sorted(e), "x_id string, y_id string")).collect()} == dict(want)

"""Windows over block-wise contigs against plain slices; FASTA files in splits; node sequences and denominators."""

import random

import pytest
from pyspark.sql import functions as F

from kgloom.operators import sequences as S

COMPLEMENT = str.maketrans("ACGTRYSWKMBDHVNacgtryswkmbdhvn", "TGCAYRSWMKVHDBNtgcayrswmkvhdbn")


@pytest.fixture(scope="module")
def genome():
    rnd = random.Random(4)
    return {c: "".join(rnd.choice("ACGTacgtRYNkm") for _ in range(n)) for c, n in (("1", 1234), ("2", 100), ("MT", 7))} | {"bad": "ACGT" * 30 + "x" + "ACGT" * 30}


@pytest.fixture(scope="module")
def files(genome, tmp_path_factory):
    where = tmp_path_factory.mktemp("fasta")
    widths = {"1": 61, "2": 13, "MT": 3, "bad": 60}
    for k, names in enumerate((("chr1 first", "chr2"), ("M", "bad"))):
        out = []
        for name in names:
            own = {"chr1 first": "1", "chr2": "2", "M": "MT"}.get(name, name)
            out += [f">{name}", *[genome[own][i : i + widths[own]] for i in range(0, len(genome[own]), widths[own])], ""]
        (where / f"{k}.fa").write_text("\n".join(out) + "\n")
    return str(where)


@pytest.fixture(scope="module")
def blocks(spark, files):
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "200")  # many splits
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        assert spark.read.text(files).rdd.getNumPartitions() > 3
        lines = S.contig_lines(spark, files)
        return spark.createDataFrame(S.contig_blocks(lines, 50).collect(), "chromosome string, block long, bases string")
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_contigs_of_files_in_splits(blocks, genome):
    rows = sorted((r["chromosome"], r["block"], r["bases"]) for r in blocks.collect())
    for name, contig in genome.items():
        own = [b for c, _, b in rows if c == name]
        assert "".join(own) == contig.upper() and all(len(b) == 50 for b in own[:-1])


def test_numbered_lines_place_like_files(spark, genome):
    rows = [(c, i * 3, s[k : k + 11]) for c, s in genome.items() for i, k in enumerate(range(0, len(s), 11))]
    random.Random(1).shuffle(rows)
    placed = S.numbered_lines(spark.createDataFrame(rows, "chromosome string, line_no long, text string").repartition(4), 8)
    found = S.contig_blocks(placed, 32).collect()
    for name, contig in genome.items():
        assert "".join(b for _, b in sorted((r["block"], r["bases"]) for r in found if r["chromosome"] == name)) == contig.upper()


INTERVAL = "id string, chromosome string, start long, end long, strand string"


def plain(contig, start, end, strand, flank, prefix):
    if prefix and end - start + 1 > prefix:
        start, end = (end - prefix + 1, end) if strand == "-" else (start, start + prefix - 1)
    s = contig[max(0, start - 1 - flank) : min(len(contig), end + flank)].upper()
    return s.translate(COMPLEMENT)[::-1].upper() if strand == "-" else s


@pytest.mark.parametrize("flank, prefix", [(0, None), (7, None), (300, None), (0, 40), (5, 130)])
def test_windows_equal_plain_slices(spark, blocks, genome, flank, prefix):
    rnd = random.Random(flank)
    rows = []
    for k in range(200):
        c = rnd.choice(("1", "2", "MT"))
        a, b = sorted(rnd.randrange(1, len(genome[c]) + 1) for _ in range(2))
        rows.append((f"{k}", c, a, b, rnd.choice("+-.")))
    rows += rows[:3]
    found = {r["id"]: r for r in S.windows(spark.createDataFrame(rows, INTERVAL), blocks, flank, prefix=prefix, width=50).collect()}
    assert len(found) == 200
    for i, c, a, b, strand in rows:
        assert found[i]["sequence"] == plain(genome[c], a, b, strand, flank, prefix) and found[i]["reason"] is None and found[i]["length"] == len(found[i]["sequence"])


def test_reasons_without_a_sequence(spark, blocks):
    rows = [("a", "X", 1, 5, "+"), ("b", "2", 0, 5, "+"), ("c", "2", 9, 8, "+"), ("d", "2", 90, 101, "-"), ("e", "1", 1, 1001, "+"), ("f", "bad", 100, 130, "-"), ("g", "bad", 1, 120, "-"), ("h", None, 1, 2, "+")]
    found = S.windows(spark.createDataFrame(rows, INTERVAL), blocks, longest=1000, width=50)
    assert {r["id"]: r["reason"] for r in found.collect()} == {"a": "missing_contig", "b": "empty_interval", "c": "empty_interval", "d": "outside_contig", "e": "over_length", "f": "invalid_alphabet", "g": None, "h": "missing_contig"}
    assert {r["reason"]: (r["n"], r["bases"]) for r in S.sequence_counts(found).collect()}[""] == (1, 120)


def test_recovery_reads_only_what_is_missing(spark, blocks, genome):
    rows = spark.createDataFrame([("a", "1", 1, 900, "-"), ("b", "1", 5, 8, "+")], INTERVAL)
    have = S.windows(rows.where("id = 'b'"), blocks, width=50)
    found = {r["id"]: r["sequence"] for r in S.recovered(have, rows, blocks, 100, 50).collect()}
    assert found == {"a": plain(genome["1"], 1, 900, "-", 0, 100), "b": genome["1"][4:8].upper()}
    with pytest.raises(Exception, match="no sequence for z"):
        S.recovered(have, spark.createDataFrame([("z", "X", 1, 2, "+")], INTERVAL), blocks, 100, 50).select("id", "length").collect()


def test_coordinates_and_their_rejects(spark):
    genes = spark.createDataFrame([("ENSG1.3", "A", "chr1", 5, 9, "+"), ("ENSG1.3", "A", "1", 4, 9, "+"), ("ENSG2", "B", "KI27", 1, 2, "-"), ("ENSG3", "C", "chrM", 1, 2, "-"), ("ENSG4", "D", "2", 1, 2, "-")], "gene_id string, gene_name string, chromosome string, start long, end long, strand string")
    kept, counts = S.gene_coordinates(genes, spark.createDataFrame([("ENSG1",), ("ENSG2",)], "id string"))
    assert [tuple(r) for r in kept.collect()] == [("ENSG1", "3", "A", "1", 4, 9, "+")]
    assert dict(map(tuple, counts.collect())) == {"": 1, "duplicate_id": 1, "alt_contig": 2, "no_node": 1}


def test_node_sequences(spark):
    records = spark.createDataFrame([("ENSP1.2", "MKV"), ("sp|P5|X", "mk"), ("ENSP2", ""), ("ENSP3", "M1"), ("ENSP4", "MMMMM"), ("ENSP9", "M")], "id string, sequence string")
    kept, counts = S.node_sequences(records, spark.createDataFrame([(i,) for i in ("ENSP1", "P5", "ENSP2", "ENSP3", "ENSP4")], "id string"), "protein_extended", 4)
    assert sorted((r["id"], r["sequence"]) for r in kept.collect()) == [("ENSP1", "MKV"), ("P5", "MK")]
    assert dict(map(tuple, counts.collect())) == {"": 2, "empty": 1, "invalid_alphabet": 1, "over_length": 1, "unmapped": 1}


def test_no_row_holds_a_contig(spark):
    lines = spark.range(2000).select(F.lit("1").alias("chromosome"), F.col("id").alias("line_no"), F.lit("ACGTACGTAC").alias("text"))
    blocks = S.contig_blocks(S.numbered_lines(lines), 1000)
    assert blocks.agg(F.max(F.length("bases")), F.count("*")).first()[0:2] == (1000, 20)


def test_intervals_of_one_block_read_one_text(spark):
    import random
    import re

    from kgloom.operators import sequences as S

    rnd = random.Random(4)
    contig = "".join(rnd.choice("ACGTRYN") for _ in range(500))
    lines = spark.createDataFrame([("c", k, contig[k : k + 50]) for k in range(0, 500, 50)], "chromosome string, at int, text string")
    rows = [(k, "c", start := rnd.randrange(1, 440), start + rnd.randrange(0, 60), rnd.choice("+-")) for k in range(300)]
    turn = str.maketrans("ACGTRYN", "TGCAYRN")
    found = S.windows(spark.createDataFrame(rows, "id int, chromosome string, start int, end int, strand string"), S.contig_blocks(lines, 64), flank=3, width=64)
    got = {r["id"]: r["sequence"] for r in found.collect()}
    for k, _, start, end, strand in rows:
        own = contig[max(0, start - 4) : end + 3]
        assert got[k] == (own if strand == "+" else own.translate(turn)[::-1])
    # pieces of sequences are not grouped by interval
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert not [x for x in plan.splitlines() if "collect_list" in x and re.search(r"\bid#", x)]


def test_intervals_are_shuffled_only_to_their_places(spark):
    """Intervals that repeat meet where they are read: none is shuffled by its content first; read again by their place they are the same."""
    bases = spark.createDataFrame([("1", 0, "ACGTACGTAC"), ("1", 1, "GGTTAACCGG")], "chromosome string, block long, bases string")
    intervals = spark.createDataFrame([("a", "1", 2, 9, "+"), ("a", "1", 2, 9, "+"), ("b", "1", 5, 18, "-"), ("c", "2", 1, 4, "+")], "id string, chromosome string, start long, end long, strand string")
    found = S.placed_windows(intervals, bases, prefix=6, width=10)
    exchanges = [line.split("Exchange hashpartitioning(")[1] for line in found._jdf.queryExecution().executedPlan().toString().splitlines() if "Exchange hashpartitioning(" in line]
    assert exchanges and not any("id#" in e.split("plan_id")[0] for e in exchanges)
    got = sorted(map(tuple, found.collect()))
    assert [(r[0], r[5], r[6]) for r in got] == [("a", "CGTACG", None), ("b", "GGTTAA", None), ("c", None, "missing_contig")]
    again = S.placed_windows(found.where("reason IS NULL").select(intervals.columns), bases, prefix=6, width=10)
    assert sorted(map(tuple, again.collect())) == [r for r in got if r[6] is None]

"""Sequences of genome intervals and of nodes.

A contig is never one row: it is cut into blocks of fixed width.  The blocks that
the longest interval of a block reaches are put together once, and all intervals
that start in the block read their bases from that text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.ids import first_reason
from ..functions.text import reverse_complement

#: Letters of the alphabets that sequence tables may hold.
ALPHABETS = {"dna_iupac": "ACGTRYSWKMBDHVN", "rna_iupac": "ACGURYSWKMBDHVN", "protein_extended": "ABCDEFGHIJKLMNOPQRSTUVWXYZ*-"}
#: Bases of a block; the longest locus that is kept whole.
BLOCK, LONGEST = 1 << 16, 500_000


def chromosome_name(c: Column) -> Column:
    """A contig's name without `chr`; M is MT."""
    name = F.regexp_replace(F.trim(c), r"(?i)^chr", "")
    return F.when(name == "M", F.lit("MT")).otherwise(name)


def contig_lines(spark: SparkSession, path: str) -> DataFrame:
    """chromosome, at, text: each line of FASTA files with its contig and its place there (from 0), in upper case.

    Files are read in splits.  A line belongs to the last header before it: within
    its split, or else the last of the splits before; places are running sums
    within a split upon the sums of the splits before.
    """
    split = ["file", "block"]
    rows = spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("line"), F.trim("value").alias("value")).where("value <> ''")
    is_head = F.col("value").startswith(">")
    name = F.when(is_head, chromosome_name(F.regexp_extract("value", r"^>\s*(\S*)", 1)))
    inside = Window.partitionBy(*split).orderBy("line").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("own", F.last(name, ignorenulls=True).over(inside)).withColumn("head", is_head)
    ends = rows.groupBy(*split).agg(F.max_by("own", "line").alias("end"))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.select(*split, F.last("end", ignorenulls=True).over(before).alias("carried"))
    lines = rows.join(carried, split).where("NOT head").select(*split, "line", F.coalesce("own", "carried").alias("chromosome"), F.upper("value").alias("text"))
    sums = lines.groupBy("chromosome", *split).agg(F.sum(F.length("text")).alias("n"))
    earlier = Window.partitionBy("chromosome").orderBy(*split).rowsBetween(Window.unboundedPreceding, -1)
    base = sums.select("chromosome", *split, F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base"))
    within = Window.partitionBy("chromosome", *split).orderBy("line").rowsBetween(Window.unboundedPreceding, -1)
    placed = lines.withColumn("inner", F.coalesce(F.sum(F.length("text")).over(within), F.lit(0)))
    return placed.join(base, ["chromosome", *split]).select("chromosome", (F.col("base") + F.col("inner")).alias("at"), "text")


def numbered_lines(lines: DataFrame, group: int = 4096) -> DataFrame:
    """chromosome, at, text of lines that carry a number (chromosome, line_no, text): sums of groups of lines, then of the lines of a group."""
    rows = lines.select("chromosome", "line_no", F.upper("text").alias("text"), F.floor(F.col("line_no") / group).alias("block"))
    sums = rows.groupBy("chromosome", "block").agg(F.sum(F.length("text")).alias("n"))
    base = sums.select("chromosome", "block", F.coalesce(F.sum("n").over(Window.partitionBy("chromosome").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("base"))
    within = Window.partitionBy("chromosome", "block").orderBy("line_no").rowsBetween(Window.unboundedPreceding, -1)
    placed = rows.withColumn("inner", F.coalesce(F.sum(F.length("text")).over(within), F.lit(0)))
    return placed.join(base, ["chromosome", "block"]).select("chromosome", (F.col("base") + F.col("inner")).alias("at"), "text")


def _together(at: str, text: str) -> Column:
    """Pieces in order of their place, as one text."""
    return F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(at, text))), lambda p: p[text]), "")


def contig_blocks(placed: DataFrame, width: int = BLOCK) -> DataFrame:
    """chromosome, block, bases: contigs as blocks of `width` bases (the last may be shorter)."""
    rows = placed.withColumn("end", F.col("at") + F.length("text")).where("end > at")
    pieces = rows.withColumn("block", F.explode(F.sequence(F.floor(F.col("at") / width), F.floor((F.col("end") - 1) / width))))
    lo, hi = F.greatest("at", F.col("block") * width), F.least("end", (F.col("block") + 1) * width)
    pieces = pieces.select("chromosome", "block", lo.alias("lo"), F.substr("text", (lo - F.col("at") + 1).cast("int"), (hi - lo).cast("int")).alias("piece"))
    return pieces.groupBy("chromosome", "block").agg(_together("lo", "piece").alias("bases"))


def contig_lengths(blocks: DataFrame, width: int = BLOCK) -> DataFrame:
    return blocks.groupBy("chromosome").agg(F.max(F.col("block") * width + F.length("bases")).alias("contig_length"))


#: Places of a block at which texts for intervals start, so that the intervals of one block are the work of many tasks.
STARTS = 16


def _reaches(intervals: DataFrame, blocks: DataFrame, width: int, step: int) -> DataFrame:
    """chromosome, place, text, complement: the bases from base place * step on to the last that an interval (chromosome, place, hi) of this place reaches, in both directions."""
    reach = intervals.groupBy("chromosome", "place").agg(F.max("hi").alias("hi"), F.count("*").alias("n")).where("n > 0")  # counted, as a largest alone would be taken from another shuffle than the one that brings the intervals
    own = F.floor(F.col("place") * step / width)
    each = reach.withColumn("block", F.explode(F.sequence(own, F.floor((F.col("hi") - 1) / width))))
    skipped = F.col("place") * step - own * width
    joined = each.join(blocks, ["chromosome", "block"]).groupBy("chromosome", "place", "hi").agg(_together("block", "bases").alias("whole"))
    text = joined.select("chromosome", "place", F.upper(F.substr("whole", (skipped + 1).cast("int"), (F.col("hi") - F.col("place") * step).cast("int"))).alias("text"))
    return text.withColumn("complement", reverse_complement(F.col("text")))


def placed_windows(intervals: DataFrame, blocks: DataFrame, flank: int = 0, longest: int = LONGEST, prefix: int | None = None, width: int = BLOCK) -> DataFrame:
    """id, chromosome, start, end, strand, sequence and reason: `windows`, with the place that was read; read again by that place, a row is the same."""
    known = intervals.select("id", "chromosome", "start", "end", "strand").join(F.broadcast(contig_lengths(blocks, width)), "chromosome", "left")  # a row for each contig
    minus = F.col("strand") == "-"
    length = F.col("end") - F.col("start") + 1
    first = F.when(minus & (length > prefix), F.col("end") - prefix + 1).otherwise(F.col("start")) if prefix else F.col("start")
    last = F.when(~minus & (length > prefix), F.col("start") + prefix - 1).otherwise(F.col("end")) if prefix else F.col("end")
    why = first_reason(
        (F.col("contig_length").isNull(), "missing_contig"), ((F.col("start") < 1) | (length < 1), "empty_interval"), (F.col("end") > F.col("contig_length"), "outside_contig"), (F.lit(prefix is None) & (length > longest), "over_length")
    )
    step = max(1, width // STARTS)
    tasks = int(intervals.sparkSession.conf.get("spark.sql.shuffle.partitions"))  # named, as rows are few bytes and much work
    marked = known.select("id", "chromosome", "strand", F.greatest(F.lit(1), first - flank).alias("lo"), F.least("contig_length", last + flank).alias("hi"), why.alias("reason")).withColumn("place", F.floor((F.col("lo") - 1) / step))
    marked = marked.repartition(tasks, "chromosome", "place").distinct()  # rows that repeat share a place, so they move once, to where they are read
    good = marked.where("reason IS NULL AND chromosome IS NOT NULL AND place IS NOT NULL")  # the same filter for all who read it, so that one shuffle serves them
    texts = _reaches(good, blocks, width, step)
    n, at = (F.col("hi") - F.col("lo") + 1).cast("int"), (F.col("lo") - F.col("place") * step).cast("int")
    met = good.join(texts, ["chromosome", "place"])
    sequence = F.when(minus, F.substr("complement", F.length("complement") - at - n + 2, n)).otherwise(F.substr("text", at, n))
    placed = ["id", "chromosome", F.col("lo").alias("start"), F.col("hi").alias("end"), "strand"]
    read = met.select(*placed, sequence.alias("sequence"))
    bad = ~F.col("sequence").rlike(rf"^[{ALPHABETS['dna_iupac']}]*$")
    read = read.withColumns({"sequence": F.when(~bad, F.col("sequence")), "reason": F.when(bad, F.lit("invalid_alphabet"))})
    return read.unionByName(marked.where("reason IS NOT NULL").select(*placed, F.lit(None).cast("string").alias("sequence"), "reason"))


def windows(intervals: DataFrame, blocks: DataFrame, flank: int = 0, longest: int = LONGEST, prefix: int | None = None, width: int = BLOCK) -> DataFrame:
    """id, sequence, length, checksum_sha256 and reason of closed 1-based intervals (id, chromosome, start, end, strand), in the strand's direction.

    `flank` bases on both sides are added and end at the contig's ends; `prefix` keeps
    so many bases from the strand's 5' end instead of the whole.  A reason says why
    an interval has no sequence: its contig is missing or shorter than it, it is
    empty, too long, or holds letters that are no IUPAC nucleotides.  Intervals that
    repeat in full count once; an id may have several.
    """
    every = placed_windows(intervals, blocks, flank, longest, prefix, width)
    return every.select("id", "sequence", F.length("sequence").alias("length"), F.sha2("sequence", 256).alias("checksum_sha256"), "reason")


def sequence_counts(found: DataFrame) -> DataFrame:
    """Rows, shortest, longest and all bases by reason ('' where there is a sequence)."""
    return found.groupBy(F.coalesce("reason", F.lit("")).alias("reason")).agg(F.count("*").alias("n"), F.min("length").alias("shortest"), F.max("length").alias("longest"), F.coalesce(F.sum("length"), F.lit(0)).alias("bases"))


def gene_coordinates(genes: DataFrame, nodes: DataFrame, alt_contigs: bool = False) -> tuple[DataFrame, DataFrame]:
    """Coordinates of the genes that have a node, ids without version; of rows with one id the first by place stays.  Also how many rows went for what.

    genes: gene_id, gene_name, chromosome, start, end, strand.
    """
    name = chromosome_name(F.col("chromosome"))
    rows = genes.withColumn("chromosome", name).withColumn("id", F.regexp_replace("gene_id", r"\.\d+$", "")).withColumn("version", F.regexp_extract("gene_id", r"\.(\d+)$", 1))
    alt = F.lit(not alt_contigs) & (name.contains(".") | (name == "MT") | name.startswith("KI") | name.startswith("GL"))
    rows = rows.withColumn("alt", alt).withColumn("place", F.when(F.col("alt"), F.lit(0)).otherwise(F.row_number().over(Window.partitionBy("id", "alt").orderBy("chromosome", "start", "end", "strand"))))
    rows = rows.join(nodes.select("id").distinct().withColumn("known", F.lit(True)), "id", "left")
    why = first_reason((F.col("alt"), "alt_contig"), (F.col("place") > 1, "duplicate_id"), (F.col("known").isNull(), "no_node"))
    marked = rows.withColumn("reason", why)
    kept = marked.where("reason IS NULL").select("id", "version", "gene_name", "chromosome", "start", "end", "strand")
    return kept, marked.groupBy(F.coalesce("reason", F.lit("")).alias("reason")).agg(F.count("*").alias("n"))


def denominators(nodes: DataFrame, intervals: DataFrame, sequences: DataFrame, embedded: DataFrame, excluded: DataFrame) -> DataFrame:
    """id, part and reason: why a gene of the denominator (human Ensembl ids) has no embedding, and why other ids are outside it."""
    has = lambda df, name: df.select("id").distinct().withColumn(name, F.lit(True))
    rows = nodes.select("id").distinct()
    for df, name in ((intervals, "interval"), (sequences, "sequence"), (embedded, "embedded"), (excluded, "excluded")):
        rows = rows.join(has(df, name), "id", "left")
    human = F.col("id").rlike(r"^ENSG[0-9]+$")
    outside = F.when(F.col("id").rlike("^(NCBI|NCBIGene):"), "unmapped_ncbi_alias").when(F.col("id").startswith("ENS") & ~F.col("id").startswith("ENSG"), "non_human_ensembl_homologue").otherwise("non_ensg_namespace")
    missing = F.when(F.col("sequence"), "embedding_missing_or_failed").when(F.col("interval"), "source_sequence_overlength").when(F.col("excluded"), "source_excluded_contig_or_build").otherwise("source_absent_ensembl_release")
    marked = rows.where(~human | F.col("embedded").isNull()).select("id", F.when(human, "missing").otherwise("quarantine").alias("part"), F.when(human, missing).otherwise(outside).alias("reason"))
    return marked


def node_sequences(records: DataFrame, nodes: DataFrame, alphabet: str, longest: int = LONGEST) -> tuple[DataFrame, DataFrame]:
    """Sequences of FASTA records (id, sequence) that have a node; the others by reason.

    A record's id loses its version, and of `db|accession|name` the accession counts.
    """
    token = F.when(F.size(F.split("id", r"\|")) >= 2, F.coalesce(F.nullif(F.get(F.split("id", r"\|"), F.lit(1)), F.lit("")), F.col("id"))).otherwise(F.col("id"))
    rows = records.select(F.regexp_replace(token, r"^(ENS[A-Z]*\d+)\.\d+$", "$1").alias("id"), F.upper(F.coalesce("sequence", F.lit(""))).alias("sequence"))
    rows = rows.join(nodes.select("id").distinct().withColumn("known", F.lit(True)), "id", "left")
    letters = ALPHABETS[alphabet].replace("-", r"\-").replace("*", r"\*")
    why = first_reason((F.col("sequence") == "", "empty"), (~F.col("sequence").rlike(rf"^[{letters}]*$"), "invalid_alphabet"), (F.length("sequence") > longest, "over_length"), (F.col("known").isNull(), "unmapped"))
    marked = rows.withColumn("reason", why)
    kept = marked.where("reason IS NULL").select("id", "sequence", F.length("sequence").alias("length"), F.lit(alphabet).alias("alphabet"), F.sha2("sequence", 256).alias("checksum_sha256"))
    return kept, marked.groupBy(F.coalesce("reason", F.lit("")).alias("reason")).agg(F.count("*").alias("n"))


def recovered(have: DataFrame, intervals: DataFrame, blocks: DataFrame, prefix: int = 1000, width: int = BLOCK) -> DataFrame:
    """Sequences (id, sequence, length, checksum_sha256) with those of the intervals that have none yet: the first `prefix` bases of their strand.

    An interval that can't be read is an error.
    """
    missing = intervals.join(have.select("id"), "id", "left_anti")
    found = windows(missing, blocks, prefix=prefix, width=width)
    sequence = F.when(F.col("reason").isNull(), F.col("sequence")).otherwise(F.raise_error(F.concat(F.lit("no sequence for "), F.col("id").cast("string"), F.lit(": "), "reason")).cast("string"))
    checked = found.select("id", sequence.alias("sequence")).select("id", "sequence", F.length("sequence").alias("length"), F.sha2("sequence", 256).alias("checksum_sha256"))
    return have.select("id", "sequence", "length", "checksum_sha256").unionByName(checked)

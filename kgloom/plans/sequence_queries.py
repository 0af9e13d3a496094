"""Sequence windows over contigs whose lines are orders."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import sequences as S
from ..sources.tables import table
from .queries import query

WIDTH = 1000
#: A line of a contig: the digits of a hash as letters, some in lower case; of every 97th line one is no nucleotide.
_TEXT = "translate(md5('o' || o_orderkey), '0123456789abcdef', CASE WHEN o_orderkey % 997 = 0 THEN 'ACGTRYSWKMBDHVNx' ELSE 'ACGTRYSWKMBDHVNa' END)"
_LINE = {"chromosome": "'c' || (o_custkey % 23)", "line_no": "o_orderkey", "text": _TEXT}
_INTERVAL = {
    "id": "concat_ws('_', l_orderkey, l_partkey, l_suppkey, l_quantity::INT, l_returnflag, l_linenumber)", "chromosome": "'c' || (l_suppkey % 25)", "start": "(l_orderkey * 37 + l_partkey) % 20000 + 1",
    "end": "(l_orderkey * 37 + l_partkey) % 20000 + l_linenumber * 400 * (l_quantity::INT % 5) - CASE WHEN l_partkey % 50 = 0 THEN 900 ELSE 0 END", "strand": "CASE WHEN l_returnflag = 'A' THEN '-' ELSE '+' END",
}


def _contigs(spark: SparkSession, d: str) -> DataFrame:
    lines = table(spark, d, "orders").selectExpr(*[f"{e} AS {c}" for c, e in _LINE.items()])
    return S.contig_blocks(S.numbered_lines(lines, 64), WIDTH)


def _intervals(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "lineitem").selectExpr(*[f"{e} AS {c}" for c, e in _INTERVAL.items()])


_CTES = f"""WITH g AS (SELECT chromosome, upper(string_agg(text, '' ORDER BY line_no)) AS contig FROM (SELECT {", ".join(f"{e} AS {c}" for c, e in _LINE.items())} FROM orders) GROUP BY chromosome),
i AS (SELECT DISTINCT {", ".join(f'{e} AS "{c}"' for c, e in _INTERVAL.items())} FROM lineitem),
j AS (SELECT *, "end" - start + 1 AS n FROM i LEFT JOIN g USING (chromosome))"""


def _cut(lo: str, hi: str, longest: str) -> str:
    why = f"CASE WHEN contig IS NULL THEN 'missing_contig' WHEN n < 1 THEN 'empty_interval' WHEN \"end\" > len(contig) THEN 'outside_contig' {longest} END"
    forward = f"substr(contig, {lo}, {hi} - {lo} + 1)"
    sequence = f"CASE WHEN strand = '-' THEN reverse(translate({forward}, 'ACGTRYSWKMBDHVN', 'TGCAYRSWMKVHDBN')) ELSE {forward} END"
    return f"""{_CTES}, w AS (SELECT id, {why} AS why, CASE WHEN {why} IS NULL THEN {sequence} END AS s FROM j),
r AS (SELECT id, CASE WHEN regexp_full_match(s, '[ACGTRYSWKMBDHVN]*') THEN s END AS sequence, CASE WHEN NOT regexp_full_match(s, '[ACGTRYSWKMBDHVN]*') THEN 'invalid_alphabet' ELSE why END AS reason FROM w)"""


@query(f"{_cut('greatest(1, start - 30)', 'least(len(contig), chr_end)', 'WHEN n > 6000 THEN {q}over_length{q}')} SELECT id, length(sequence) AS length, sha256(sequence) AS checksum_sha256, reason FROM r".replace("chr_end", '"end" + 30').replace("{q}", "'"))
def q_gene_windows(spark: SparkSession, d: str) -> DataFrame:
    return S.windows(_intervals(spark, d), _contigs(spark, d), flank=30, longest=6000, width=WIDTH).select("id", "length", "checksum_sha256", "reason")


_PREFIX = _cut("CASE WHEN strand = '-' AND n > 700 THEN \"end\" - 699 ELSE start END", "CASE WHEN strand = '+' AND n > 700 THEN start + 699 ELSE \"end\" END", "")


@query(f"{_PREFIX} SELECT coalesce(reason, '') AS reason, count(*) AS n, min(length(sequence)) AS shortest, max(length(sequence)) AS longest, coalesce(sum(length(sequence)), 0)::BIGINT AS bases FROM r GROUP BY 1")
def q_window_counts(spark: SparkSession, d: str) -> DataFrame:
    return S.sequence_counts(S.windows(_intervals(spark, d), _contigs(spark, d), prefix=700, width=WIDTH))


@query(f"{_PREFIX} SELECT id, length(sequence) AS length, checksum FROM (SELECT id, sequence, sha256(sequence) AS checksum FROM r WHERE reason IS NULL)")
def q_recovered_sequences(spark: SparkSession, d: str) -> DataFrame:
    """Half of the readable intervals have a sequence; the rest are recovered."""
    blocks = _contigs(spark, d)
    readable = S.placed_windows(_intervals(spark, d), blocks, prefix=700, width=WIDTH).where("reason IS NULL")
    have = readable.where("substr(id, -1) IN ('1', '2', '3')").select("id", "sequence", F.length("sequence").alias("length"), F.sha2("sequence", 256).alias("checksum_sha256"))
    found = S.recovered(have, readable.select("id", "chromosome", "start", "end", "strand"), blocks, 700, WIDTH)
    return found.select("id", "length", F.col("checksum_sha256").alias("checksum"))


@query("""WITH n AS (SELECT CASE WHEN p_partkey % 9 = 0 THEN 'NCBI:' || p_partkey WHEN p_partkey % 9 = 1 THEN 'ENSMUSG' || p_partkey WHEN p_partkey % 9 = 2 THEN 'X' || p_partkey ELSE 'ENSG' || p_partkey END AS id, p_partkey AS k FROM part),
i AS (SELECT DISTINCT 'ENSG' || l_partkey AS id FROM lineitem WHERE l_linenumber > 3), s AS (SELECT DISTINCT 'ENSG' || l_partkey AS id FROM lineitem WHERE l_linenumber > 5), e AS (SELECT DISTINCT 'ENSG' || l_partkey AS id FROM lineitem WHERE l_linenumber = 7), x AS (SELECT 'ENSG' || p_partkey AS id FROM part WHERE p_size > 30)
SELECT id, CASE WHEN id LIKE 'ENSG%' THEN 'missing' ELSE 'quarantine' END AS part, CASE WHEN id LIKE 'NCBI%' THEN 'unmapped_ncbi_alias' WHEN id LIKE 'ENSM%' THEN 'non_human_ensembl_homologue' WHEN id LIKE 'X%' THEN 'non_ensg_namespace' WHEN id IN (FROM s) THEN 'embedding_missing_or_failed' WHEN id IN (FROM i) THEN 'source_sequence_overlength'
  WHEN id IN (FROM x) THEN 'source_excluded_contig_or_build' ELSE 'source_absent_ensembl_release' END AS reason FROM n WHERE id NOT IN (FROM e)""")
def q_gene_denominators(spark: SparkSession, d: str) -> DataFrame:
    parts, items = table(spark, d, "part"), table(spark, d, "lineitem")
    nodes = parts.selectExpr("CASE WHEN p_partkey % 9 = 0 THEN 'NCBI:' || p_partkey WHEN p_partkey % 9 = 1 THEN 'ENSMUSG' || p_partkey WHEN p_partkey % 9 = 2 THEN 'X' || p_partkey ELSE 'ENSG' || p_partkey END AS id")
    of = lambda rule: items.where(rule).selectExpr("'ENSG' || l_partkey AS id")
    return S.denominators(nodes, of("l_linenumber > 3"), of("l_linenumber > 5"), of("l_linenumber = 7"), parts.where("p_size > 30").selectExpr("'ENSG' || p_partkey AS id"))


@query("""WITH r AS (SELECT CASE WHEN p_partkey % 3 = 0 THEN 'sp|P' || p_partkey || '|X' ELSE 'ENSP' || p_partkey || '.' || p_size END AS id, CASE WHEN p_size % 11 = 0 THEN '' WHEN p_size % 11 = 1 THEN 'MK1' ELSE upper(replace(p_name, ' ', '')) END AS s, 'P' || p_partkey AS a, 'ENSP' || p_partkey AS b, p_partkey, p_size FROM part),
m AS (SELECT CASE WHEN p_partkey % 3 = 0 THEN a ELSE b END AS id, s, CASE WHEN s = '' THEN 'empty' WHEN NOT regexp_full_match(s, '[A-Z*-]*') THEN 'invalid_alphabet' WHEN length(s) > 16 THEN 'over_length' WHEN p_partkey % 7 = 0 THEN 'unmapped' ELSE '' END AS reason FROM r)
SELECT reason, count(*) AS n, CASE WHEN reason = '' THEN sum(length(s))::BIGINT END AS bases FROM m GROUP BY reason""")
def q_node_sequences(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "part").selectExpr(
        "CASE WHEN p_partkey % 3 = 0 THEN 'sp|P' || p_partkey || '|X' ELSE 'ENSP' || p_partkey || '.' || p_size END AS id",
        "CASE WHEN p_size % 11 = 0 THEN '' WHEN p_size % 11 = 1 THEN 'MK1' ELSE replace(p_name, ' ', '') END AS sequence", "p_partkey",
    )
    nodes = rows.where("p_partkey % 7 > 0").selectExpr("CASE WHEN p_partkey % 3 = 0 THEN 'P' || p_partkey ELSE 'ENSP' || p_partkey END AS id")
    kept, counts = S.node_sequences(rows, nodes, "protein_extended", 16)
    bases = kept.agg(F.sum("length").alias("bases")).select(F.lit("").alias("reason"), "bases")
    return counts.join(bases, "reason", "left").select("reason", "n", "bases")

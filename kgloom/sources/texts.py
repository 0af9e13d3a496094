"""Text formats as Spark scans: FASTA, ontology stanzas, gene rows of GTF, wide matrices."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def fasta(spark: SparkSession, path: str) -> DataFrame:
    """id, description, sequence; one row for each record (protein and transcript files, not whole contigs)."""
    rows = spark.read.option("lineSep", "\n>").text(path).select(F.regexp_replace("value", "^>", "").alias("record"))
    head = F.regexp_extract("record", r"^([^\n]*)", 1)
    body = F.regexp_replace(F.regexp_replace("record", r"^[^\n]*", ""), r"\s+", "")
    return rows.where("trim(record) <> ''").select(F.regexp_extract(head, r"^(\S*)", 1).alias("id"), F.trim(F.regexp_replace(head, r"^\S*", "")).alias("description"), body.alias("sequence"))


def stanzas(spark: SparkSession, path: str) -> DataFrame:
    """Ontology terms: id, name, definition, parents, xrefs; obsolete terms are left out."""
    rows = spark.read.option("lineSep", "\n\n").text(path).where(F.col("value").contains("[Term]"))
    one = lambda tag: F.nullif(F.regexp_extract("value", rf"(?m)^{tag}: ([^\n]*)", 1), F.lit(""))
    many = lambda tag: F.regexp_extract_all("value", F.lit(rf"(?m)^{tag}: (\S+)"), F.lit(1))
    found = rows.select(one("id").alias("id"), one("name").alias("name"), F.regexp_extract("value", r'(?m)^def: "([^"]*)"', 1).alias("definition"), many("is_a").alias("parents"), many("xref").alias("xrefs"), one("is_obsolete").alias("obsolete"))
    return found.where("id IS NOT NULL AND coalesce(obsolete, '') <> 'true'").drop("obsolete")


def gtf_genes(spark: SparkSession, path: str) -> DataFrame:
    """gene_id, gene_name, chromosome, start, end, strand of the gene rows."""
    f = F.split("value", "\t")
    attr = lambda name: F.nullif(F.regexp_extract(f[8], rf'{name} "([^"]*)"', 1), F.lit(""))
    rows = spark.read.text(path).where(~F.col("value").startswith("#")).where(f[2] == "gene")
    return rows.select(attr("gene_id").alias("gene_id"), attr("gene_name").alias("gene_name"), F.regexp_replace(f[0], "^chr", "").alias("chromosome"), f[3].cast("long").alias("start"), f[4].cast("long").alias("end"), f[6].alias("strand"))


def wide_matrix(spark: SparkSession, path: str, sep: str = ",") -> DataFrame:
    """row, column, value of a matrix of very many columns: cells are numbered and meet the header by place."""
    lines = spark.read.text(path).select(F.split("value", sep).alias("cells"))
    header = spark.read.text(path).limit(1).select(F.posexplode(F.split("value", sep)).alias("place", "column"))
    first = header.where("place = 0").first()
    body = lines.where(F.col("cells")[0] != (first["column"] if first else "")).select(F.col("cells")[0].alias("row"), F.posexplode("cells").alias("place", "cell")).where("place > 0")
    return body.join(header, "place").select("row", "column", F.expr("try_cast(cell AS double)").alias("value")).where("value IS NOT NULL")

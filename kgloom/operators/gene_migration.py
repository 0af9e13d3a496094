"""Human gene ids from NCBI to Ensembl: a mapping with statuses, merged nodes, remapped relations with quarantine and lineage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: The human taxon; patterns of human, NCBI and other Ensembl genes.
HUMAN = "9606"
ENSG, NCBI, OTHER = r"^ENSG[0-9]+$", r"^NCBI:[0-9]+$", r"^ENS[A-Z]+G[0-9]+$"
#: What decides between edges that a remap makes equal, all falling.
PREFERRED = ("credibility", "source", "display_relation")


def authoritative_mapping(ids: DataFrame, gene2ensembl: DataFrame, gene_history: DataFrame) -> DataFrame:
    """Status and Ensembl id of each NCBI id (ncbi_gene_id).

    gene2ensembl: tax_id, ncbi, ensembl (a version is cut); gene_history: tax_id,
    new (`-` for none), old.  An id's own targets count before those of the id that
    replaced it; one target is accepted, several are ambiguous.  An id with several
    replacements takes the largest.
    """
    target = F.split_part("ensembl", F.lit("."), F.lit(1))
    active = gene2ensembl.where((F.col("tax_id") == HUMAN) & target.rlike(ENSG)).groupBy("ncbi").agg(F.array_sort(F.collect_set(target)).alias("targets"))
    history = gene_history.where(F.col("tax_id") == HUMAN).groupBy(F.col("old").alias("ncbi_gene_id")).agg(F.max(F.nullif("new", F.lit("-"))).alias("replacement"), F.lit(True).alias("retired"))
    rows = ids.select("ncbi_gene_id").distinct().join(active.select(F.col("ncbi").alias("ncbi_gene_id"), F.col("targets").alias("direct")), "ncbi_gene_id", "left").join(history, "ncbi_gene_id", "left")
    rows = rows.join(active.select(F.col("ncbi").alias("replacement"), F.col("targets").alias("of_replacement")), "replacement", "left")
    found = F.coalesce("direct", "of_replacement", F.array().cast("array<string>"))
    own = F.col("direct").isNotNull()
    status = (
        F.when(F.size(found) == 1, F.when(own, "accepted_1to1").otherwise("retired_replaced_1to1"))
        .when(F.size(found) > 1, F.when(own, "ambiguous_one_to_many").otherwise("retired_replaced_ambiguous"))
        .when(F.col("retired"), F.when(F.col("replacement").isNull(), "retired_unmapped").otherwise("retired_replacement_unmapped"))
        .otherwise("unmapped")
    )
    return rows.select(
        "ncbi_gene_id", F.concat(F.lit("NCBI:"), "ncbi_gene_id").alias("ncbi_node_id"), status.alias("mapping_status"), F.when(F.size(found) == 1, found[0]).alias("canonical_ensembl_gene_id"),
        F.when(F.size(found) > 0, F.array_join(found, "|")).alias("candidate_ensembl_gene_ids"), F.col("replacement").alias("replacement_ncbi_gene_id"), F.lit("NCBI gene2ensembl + gene_history").alias("mapping_authority"),
    )


def _joined_aliases(tokens: Column) -> Column:
    """Distinct tokens, numbers first by value, then texts; null if none."""
    number = lambda t: F.when(t.rlike("^[0-9]+$"), t.try_cast("decimal(38,0)"))
    keyed = F.transform(F.array_distinct(F.filter(F.transform(tokens, lambda t: F.trim(t)), lambda t: t != "")), lambda t: F.struct(number(t).isNull().alias("text"), number(t).alias("n"), t.alias("t")))
    return F.nullif(F.array_join(F.transform(F.array_sort(keyed), lambda k: k["t"]), "|"), F.lit(""))


def gene_classes(genes: DataFrame) -> DataFrame:
    """Rows of gene nodes by kind of id: human_ensg, human_ncbi, nonhuman_ensembl, unclassified."""
    kind = F.when(F.col("id").rlike(ENSG), "human_ensg").when(F.col("id").rlike(NCBI), "human_ncbi").when(F.col("id").rlike(OTHER), "nonhuman_ensembl").otherwise("unclassified")
    return genes.groupBy(kind.alias("kind")).agg(F.count("*").alias("n"))


def merge_gene_nodes(genes: DataFrame, mapping: DataFrame) -> DataFrame:
    """Human Ensembl genes with the union of the NCBI ids they had and those that map to them; NCBI and other species' nodes go.

    A node of no known class, or a mapping to a gene that is not there, is an error
    when the rows are made.
    """
    known = F.col("id").rlike(ENSG) | F.col("id").rlike(NCBI) | F.col("id").rlike(OTHER)
    checked = genes.withColumn("id", F.when(known, F.col("id")).otherwise(F.raise_error(F.concat(F.lit("unclassified gene id "), F.coalesce("id", F.lit("null")))).cast("string")))
    aliases = mapping.where("canonical_ensembl_gene_id IS NOT NULL").groupBy(F.col("canonical_ensembl_gene_id").alias("target")).agg(F.collect_set("ncbi_gene_id").alias("new"))
    human = checked.where(F.col("id").rlike(ENSG))
    if "ncbi_gene_id" not in human.columns:
        human = human.withColumn("ncbi_gene_id", F.lit(None).cast("string"))
    joined = human.join(aliases, F.col("id") == F.col("target"), "full")
    whole = F.when(F.col("id").isNull(), F.raise_error(F.concat(F.lit("a mapping's target is absent: "), "target")).cast("string")).otherwise(F.col("id"))
    tokens = F.concat(F.split(F.coalesce("ncbi_gene_id", F.lit("")), r"\|"), F.coalesce("new", F.array().cast("array<string>")))
    return joined.select([whole.alias(c) if c == "id" else _joined_aliases(tokens).alias(c) if c == "ncbi_gene_id" else F.col(c) for c in human.columns])


def row_id(columns: list[str]) -> Column:
    """A row's id by what it holds, whatever file or order it comes in."""
    return F.sha2(F.to_json(F.struct(*[F.col(c) for c in sorted(columns)])), 256)


def _ends(rows: DataFrame, mapping: DataFrame) -> DataFrame:
    """rows with what both ends map to, and whether an NCBI end has no target."""
    for side in ("x", "y"):
        own = mapping.select(F.col("ncbi_node_id").alias(f"{side}_id"), F.lit("gene").alias(f"{side}_type"), F.col("canonical_ensembl_gene_id").alias(f"_{side}_to"), F.col("mapping_status").alias(f"_{side}_status"))
        rows = rows.join(own, [f"{side}_id", f"{side}_type"], "left")
        gene = F.col(f"{side}_type") == "gene"
        rows = rows.withColumn(f"_{side}_ncbi", F.coalesce(gene & F.col(f"{side}_id").startswith("NCBI:"), F.lit(False)))
        rows = rows.withColumn(f"_{side}_lost", F.col(f"_{side}_ncbi") & F.col(f"_{side}_to").isNull()).withColumn(f"_{side}_other", F.coalesce(gene & F.col(f"{side}_id").rlike(OTHER) & ~F.col(f"{side}_id").rlike(ENSG), F.lit(False)))
    return rows


def remapped(rows: DataFrame, mapping: DataFrame, evidence: bool = False) -> dict[str, DataFrame]:
    """Edges or evidence under Ensembl ids: `after`, `quarantine`, `lineage` and a `report` of counts by relation.

    Rows with an NCBI end without one target go to quarantine with a reason.  Edges
    that become equal keep the best one (by credibility, source, display relation,
    old ends, content); `lineage` has every row of such an edge, kept or not.
    Evidence keeps every resolved row and its old ends.  A relation without an NCBI
    end stays as it is, repeated rows too.  An end of another species is an error.
    The report's `conserved` says whether rows = after + quarantine + collisions and
    every collision comes from a rewrite of rows that differed before.
    """
    columns = rows.columns
    ended = _ends(rows.withColumn("_row", row_id(columns)), mapping)
    other = F.col("_x_other") | F.col("_y_other")
    ended = ended.withColumn("relation", F.when(other, F.raise_error(F.concat_ws(" ", F.lit("an end of another species in"), "relation")).cast("string")).otherwise(F.col("relation")))
    touched = ended.groupBy("relation").agg(F.bool_or(F.col("_x_ncbi") | F.col("_y_ncbi")).alias("_affected"))
    ended = ended.join(F.broadcast(touched), "relation")  # a row for each relation, so its rows do not meet in one task
    lost = F.col("_x_lost") | F.col("_y_lost")
    ambiguous = lambda s: F.col(f"_{s}_ncbi") & F.coalesce(F.col(f"_{s}_status").startswith("ambiguous"), F.lit(False))
    reason = F.when(ambiguous("x"), "ambiguous_x").when(ambiguous("y"), "ambiguous_y").when(F.col("_x_ncbi"), F.coalesce("_x_status", F.lit("unmapped_x"))).otherwise(F.coalesce("_y_status", F.lit("unmapped_y")))
    quarantine = ended.where(lost).select(*columns, reason.alias("quarantine_reason"))
    new = {"x_id": F.coalesce(F.when(F.col("_x_ncbi"), F.col("_x_to")), "x_id"), "y_id": F.coalesce(F.when(F.col("_y_ncbi"), F.col("_y_to")), "y_id")}
    moved = ended.where(~lost).withColumns({"_old_x": F.col("x_id"), "_old_y": F.col("y_id")}).withColumns(new)
    if "edge_key" in columns:
        moved = moved.withColumn("edge_key", F.when(F.col("_affected"), F.concat_ws("|", "relation", "x_id", "y_id")).otherwise(F.col("edge_key")))
    counts = ended.groupBy("relation").agg(F.first("_affected").alias("affected"), F.count("*").alias("n_rows"), F.count_if(F.col("_x_ncbi") | F.col("_y_ncbi")).alias("n_affected"), F.count_if(lost).alias("n_quarantine"))
    if evidence:
        after = moved.select(*columns, F.col("_old_x").alias("canonicalization_source_x_id"), F.col("_old_y").alias("canonicalization_source_y_id"))
        report = counts.withColumn("n_after", F.col("n_rows") - F.col("n_quarantine")).withColumn("n_collisions", F.lit(0).cast("long")).withColumn("conserved", F.lit(True))
        return {"after": after, "quarantine": quarantine, "report": report.drop("affected")}
    key = Window.partitionBy("relation", "x_id", "y_id")
    order = [F.desc_nulls_last(c) for c in PREFERRED if c in columns] + [F.asc("_old_x"), F.asc("_old_y"), F.asc("_row")]
    whole = F.col("_affected")
    ranked = moved.where(whole).withColumn("_rank", F.row_number().over(key.orderBy(*order))).withColumn("_same", F.count("*").over(key))
    after = ranked.where("_rank = 1").select(columns).unionByName(moved.where(~whole).select(columns))
    rewritten = (F.col("_old_x") != F.col("x_id")) | (F.col("_old_y") != F.col("y_id"))
    lineage = ranked.where("_same > 1").select(
        "relation", F.col("x_id").alias("canonical_x_id"), F.col("y_id").alias("canonical_y_id"), F.col("_old_x").alias("source_x_id"), F.col("_old_y").alias("source_y_id"), F.col("_row").alias("source_row"),
        F.col("_rank").alias("dedup_rank"), (F.col("_rank") == 1).alias("retained"), rewritten.alias("endpoint_rewritten"),
    )
    identity = ["relation", "canonical_x_id", "canonical_y_id"]
    met = lineage.groupBy(*identity).agg(F.count("*").alias("rows"), F.count_distinct("source_x_id", "source_y_id").alias("different"), F.bool_or("endpoint_rewritten").alias("rewrite"))
    met = met.groupBy("relation").agg(F.sum(F.col("rows") - 1).alias("n_collisions"), F.bool_and((F.col("different") == F.col("rows")) & F.col("rewrite")).alias("fair"))
    kept = after.groupBy("relation").agg(F.count("*").alias("n_after"))
    report = counts.join(kept, "relation", "left").join(met, "relation", "left").withColumns({"n_after": F.coalesce("n_after", F.lit(0)), "n_collisions": F.coalesce("n_collisions", F.lit(0))})
    conserved = (F.col("n_rows") == F.col("n_after") + F.col("n_quarantine") + F.col("n_collisions")) & F.coalesce("fair", F.lit(True))
    return {"after": after, "quarantine": quarantine, "lineage": lineage, "report": report.select("relation", "n_rows", "n_affected", "n_quarantine", "n_after", "n_collisions", conserved.alias("conserved"))}


def migration_failures(after: DataFrame, report: DataFrame, nodes: DataFrame) -> DataFrame:
    """relation, failure, n: ends that are no canonical genes, equal edges in a touched relation, ends without a node (node_type, id), laws that do not hold."""
    gene = lambda s: (F.col(f"{s}_type") == "gene") & ~F.col(f"{s}_id").rlike(ENSG)
    ends = after.select("relation", F.col("x_type").alias("node_type"), F.col("x_id").alias("id")).union(after.select("relation", "y_type", "y_id")).distinct()
    missing = ends.join(nodes.select("node_type", "id"), ["node_type", "id"], "left_anti").groupBy("relation").agg(F.lit("missing_node").alias("failure"), F.count("*").alias("n"))
    odd = after.where(gene("x") | gene("y")).groupBy("relation").agg(F.lit("noncanonical_gene_end").alias("failure"), F.count("*").alias("n"))
    touched = report.where("n_affected > 0").select("relation")
    twice = after.join(touched, "relation", "left_semi").groupBy("relation", "x_id", "y_id").count().where("count > 1").groupBy("relation").agg(F.lit("equal_edges").alias("failure"), F.sum(F.col("count") - 1).alias("n"))
    law = report.where("NOT conserved").select("relation", F.lit("not_conserved").alias("failure"), F.lit(1).cast("long").alias("n"))
    return missing.union(odd).union(twice).union(law)

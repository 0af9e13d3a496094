"""Protein complexes from tab-separated records whose participants are `id(stoichiometry)` tokens; complexes nest to any depth."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.ids import first_reason
from ..sources.shared import cut
from .mitab import cell, tokens

#: Names of columns, relations, namespaces of proteins, the taxon.
AC, NAME, TAXON, MOLECULES = "#Complex ac", "Recommended name", "Taxonomy identifier", "Identifiers (and stoichiometry) of molecules in complex"
MEMBER, NESTED = "protein_part_of_protein_complex", "protein_complex_part_of_protein_complex"
UNIPROT, HUMAN = ("uniprotkb", "uniprot", "uniprot/swiss-prot", "uniprot/trembl"), "9606"
SOURCE, DATASET = "ComplexPortal", "complex_portal_complextab_human"


def complex_id(c: Column) -> Column:
    """CPX-1 of `cpx-1` or `complex portal:CPX-1`; empty for anything else."""
    return F.upper(F.regexp_extract(F.trim(c), r"(?i)^(?:complex portal:)?(CPX-\d+)$", 1))


#: Fixed value: a token, its name and its stoichiometry.
WHOLE = r"^\s*([^()\s]+)(?:\(([^()]*)\))?\s*$"


def _space(named: Column) -> Column:
    return F.when(F.contains(named, F.lit(":")), F.trim(F.lower(F.substring_index(named, ":", 1)))).otherwise("")


def _parsed(named: Column) -> Column:
    return F.when(F.contains(named, F.lit(":")), F.regexp_replace(F.trim(F.substr(named, F.instr(named, ":") + 1)), r'^"+|"+$', "")).otherwise(named)


def _namespace(fits: Column, space: Column, own: Column, cpx: Column) -> Column:
    guessed = F.when(own.rlike(r"^[A-Z0-9]{6,10}(?:-\d+)?$"), "uniprotkb").otherwise("unknown")
    return F.when(~fits, "unknown").when(cpx != "", "complex_portal").when(space == "", guessed).otherwise(space)


def participant(token: Column) -> Column:
    """raw, namespace, id, stoichiometry of one token."""
    fits, named = token.rlike(WHOLE), F.trim(F.regexp_extract(token, WHOLE, 1))
    parsed = _parsed(named)
    own = F.when(parsed == "", named).otherwise(parsed)
    cpx = complex_id(own)
    return F.struct(token.alias("raw"), _namespace(fits, _space(named), own, cpx).alias("namespace"), F.when(~fits, token).when(cpx != "", cpx).otherwise(own).alias("id"), F.when(fits, F.trim(F.regexp_extract(token, WHOLE, 2))).otherwise("").alias("stoichiometry"))


def participants(df: DataFrame) -> DataFrame:
    """df, whose tokens are lists, with a row for each token and what `participant` reads in it as p_raw, p_namespace, p_id, p_stoichiometry; each value is worked out once."""
    c = F.col
    each = df.withColumn("p_raw", F.explode("tokens")).drop("tokens")
    each = each.withColumns({"_fits": c("p_raw").rlike(WHOLE), "_named": F.trim(F.regexp_extract("p_raw", WHOLE, 1))}).withColumn("_parsed", _parsed(c("_named")))
    each = each.withColumn("_own", F.when(c("_parsed") == "", c("_named")).otherwise(c("_parsed"))).withColumn("_cpx", complex_id(c("_own")))
    each = each.withColumns({
        "p_namespace": _namespace(c("_fits"), _space(c("_named")), c("_own"), c("_cpx")), "p_id": F.when(~c("_fits"), c("p_raw")).when(c("_cpx") != "", c("_cpx")).otherwise(c("_own")),
        "p_stoichiometry": F.when(c("_fits"), F.trim(F.regexp_extract("p_raw", WHOLE, 2))).otherwise(""),
    })
    return each.drop("_fits", "_named", "_parsed", "_own", "_cpx")


def _piped(df: DataFrame, name: str) -> Column:
    return F.array_join(tokens(cell(df, name)), "|")


def _papers(*texts: Column) -> Column:
    """Distinct PMIDs that cells name outright, in order."""
    listed = F.flatten(F.array(*[tokens(t) for t in texts]))
    number = lambda t: F.coalesce(*[F.nullif(F.regexp_extract(t, p, 1), F.lit("")) for p in (r'(?i)^\s*pubmed\s*:\s*"?(\d+)"?\s*(?:\(.*)?$', r"(?i)^PMID:\s*(\d+)\s*(?:\(.*)?$", r"^(\d+)$")])
    return F.array_join(F.array_distinct(F.transform(F.filter(F.transform(listed, number), lambda p: p.isNotNull()), lambda p: F.concat(F.lit("PMID:"), p))), "|")


def accession_classes(proteins: DataFrame) -> DataFrame:
    """accession, nodes (sorted): a UniProt accession and the protein nodes that name it."""
    rows = proteins.select(F.trim("uniprot_id").alias("accession"), F.trim("id").alias("node")).where("accession <> '' AND node IS NOT NULL")
    return rows.groupBy("accession").agg(F.array_sort(F.collect_set("node")).alias("nodes"))


def complexes(rows: DataFrame, proteins: DataFrame, release: str = "") -> dict[str, DataFrame]:
    """`nodes`, membership `edges` and `evidence`, `nested_edges` and `nested_evidence`, both in `all_evidence`, `rejected` participants, `counts`.

    Human complexes with an accession count.  A protein participant needs an
    accession that exactly one node has; a complex inside itself is rejected.  Of
    records with one accession the node of the largest stays.
    """
    text = lambda c: cell(rows, c)
    shown = rows.select(
        text(AC).alias("complex"), F.coalesce(F.nullif(text(NAME), F.lit("")), text(AC)).alias("name"), text(TAXON).alias("taxon"), text("Description").alias("description"), _piped(rows, "Aliases for complex").alias("aliases"), text("Complex assembly").alias("assembly"),
        _piped(rows, "Ligand").alias("ligand_ids"), _piped(rows, "Disease").alias("disease_xrefs"), _piped(rows, "Go Annotations").alias("go_annotations"), _piped(rows, "Cross references").alias("crossrefs"), text("Evidence Code").alias("evidence_code"),
        text("Experimental evidence").alias("experimental_evidence"), _papers(text("Cross references"), text("Experimental evidence")).alias("pmids"), tokens(text(MOLECULES)).alias("tokens"),
    )
    why = first_reason((F.col("complex") == "", "missing_complex_id"), (F.col("taxon") != HUMAN, "non_human_complex"))
    good = shown.where(why.isNull())
    counted = F.transform(F.filter(F.transform("tokens", participant), lambda p: p["stoichiometry"] != ""), lambda p: F.struct(p["id"].alias("id"), p["namespace"].alias("namespace"), p["stoichiometry"].alias("stoichiometry")))
    kept = ("name", "description", "aliases", "assembly", "ligand_ids", "disease_xrefs", "go_annotations", "crossrefs", "stoichiometry_json")
    nodes = good.withColumn("stoichiometry_json", F.when(F.size(counted) > 0, F.to_json(counted)).otherwise("")).groupBy(F.col("complex").alias("id")).agg(F.max(F.struct(*kept)).alias("n"))
    nodes = nodes.select("id", *[f"n.{c}" for c in kept], F.lit("NCBITaxon:9606").alias("organism_id"), F.lit(SOURCE).alias("source"), F.col("id").alias("source_record_id"), F.col("id").alias("complex_portal_id"), F.lit(release).alias("release"))
    each = participants(good).join(accession_classes(proteins), F.col("p_id") == F.col("accession"), "left").drop("accession")
    space, many = F.col("p_namespace"), F.size("nodes")
    reason = first_reason(
        ((space == "complex_portal") & (F.col("p_id") == F.col("complex")), "nested_complex_self_reference"), (~space.isin("complex_portal", *UNIPROT), "unsupported_participant_namespace"),
        ((space != "complex_portal") & F.col("nodes").isNull(), "uniprot_unmapped_to_protein_node"), ((space != "complex_portal") & (many > 1), "uniprot_maps_to_multiple_protein_nodes"),
    )
    marked = each.withColumn("reason", reason)
    ok = marked.where("reason IS NULL")

    node, nested = F.col("nodes")[0], space == "complex_portal"
    either = lambda child, member: F.when(nested, child).otherwise(member)
    relation, x = either(F.lit(NESTED), F.lit(MEMBER)), either(F.col("p_id"), node)
    every = ok.select(
        F.concat_ws("|", relation, x, "complex").alias("edge_key"), relation.alias("relation"), x.alias("x_id"), either(F.lit("protein_complex"), F.lit("protein")).alias("x_type"), F.col("complex").alias("y_id"), F.lit("protein_complex").alias("y_type"), F.lit("database_record").alias("evidence_type"),
        F.lit(SOURCE).alias("source"), F.lit(DATASET).alias("source_dataset"), F.concat_ws("|", "complex", "p_raw").alias("source_record_id"), F.col("name").alias("source_complex_name"), F.col("p_id").alias("source_participant_id"), space.alias("source_participant_namespace"),
        either(F.lit(""), node).alias("mapped_protein_id"), either(F.lit("source_native_complex_portal_id"), F.lit("nodes/protein.uniprot_id exact unique xref")).alias("mapping_method"), either(F.lit("explicit_child_complex"), F.lit("exact_unique_uniprot_xref")).alias("mapping_confidence"),
        F.col("p_stoichiometry").alias("stoichiometry"), either(F.lit("child_complex"), F.lit("component")).alias("participant_role"), "evidence_code", "experimental_evidence", "pmids", "go_annotations", "crossrefs", F.col("assembly").alias("complex_assembly"), F.lit(release).alias("release"),
    )

    def edges(df: DataFrame, display: str) -> DataFrame:
        return df.select("x_id", "x_type", "y_id", "y_type", "relation").distinct().select("*", F.lit(display).alias("display_relation"), F.lit(SOURCE).alias("source"), F.lit(3).cast("long").alias("credibility"))

    member, inner = every.where(F.col("relation") == MEMBER), every.where(F.col("relation") == NESTED)
    rejected = marked.where("reason IS NOT NULL").select(F.col("complex").alias("source_complex_id"), F.col("name").alias("source_complex_name"), F.col("p_id").alias("source_participant_id"), F.col("p_namespace").alias("source_participant_namespace"), F.col("p_stoichiometry").alias("stoichiometry"), "reason", F.coalesce(F.array_join("nodes", "|"), F.lit("")).alias("candidate_protein_ids"))
    outcome = lambda c: F.coalesce(c, F.lit("")).alias("outcome")
    counts = shown.groupBy(F.lit("complex").alias("what"), outcome(why)).agg(F.count("*").alias("n")).unionAll(marked.groupBy(F.lit("participant"), outcome(F.col("reason"))).agg(F.count("*")))
    return {"nodes": nodes, "edges": edges(member, "part of"), "evidence": member, "nested_edges": edges(inner, "part of"), "nested_evidence": inner, "all_evidence": every, "rejected": rejected, "counts": counts}


def nesting_cycles(nested: DataFrame, rounds: int = 100) -> DataFrame:
    """part, whole: the nestings (x_id in y_id) that lie on a cycle of complexes.

    What nothing is in, or what is in nothing, is on no cycle: such nestings are
    peeled off while an eighth of them goes, and the ways of the rest are walked.
    """
    step = cut(nested.select(F.col("x_id").alias("part"), F.col("y_id").alias("whole")).distinct())
    n = step.count()
    for _ in range(rounds):
        inner = step.join(step.select(F.col("whole").alias("part")).distinct(), "part", "left_semi").join(step.select(F.col("part").alias("whole")).distinct(), "whole", "left_semi")
        step, before = cut(inner.select("part", "whole")), n
        n = step.count()
        if n * 8 > before * 7 or n == 0:
            break
    reached = fresh = step
    for _ in range(rounds):
        further = fresh.join(step.select(F.col("part").alias("whole"), F.col("whole").alias("next")), "whole").select("part", F.col("next").alias("whole")).distinct()
        fresh = cut(further.join(reached, ["part", "whole"], "left_anti"))
        if fresh.isEmpty():
            break
        reached = reached.unionByName(fresh)
    else:
        raise RuntimeError(f"complexes nest deeper than {rounds} levels")
    back = reached.select(F.col("whole").alias("part"), F.col("part").alias("whole"))
    return step.join(back, ["part", "whole"], "left_semi").union(step.where("part = whole")).distinct()


def flattened(members: DataFrame, nested: DataFrame, rounds: int = 100) -> tuple[DataFrame, DataFrame]:
    """Members of complexes at any depth, and the nestings on cycles, which are left out.

    members and nested: x_id in y_id with a stoichiometry (text).  Gives x_id, y_id,
    depth (the shortest) and copies: the sum over all ways of the products of their
    stoichiometries, null where one on a way is not a positive number.
    """
    number = F.when(F.col("stoichiometry").rlike("^[0-9]+$") & (F.col("stoichiometry").try_cast("decimal(38,0)") > 0), F.col("stoichiometry").try_cast("decimal(18,0)"))

    def summed(df: DataFrame, *by: str) -> DataFrame:
        unknown = F.count_if(F.col("copies").isNull()) > 0
        return df.groupBy(*by).agg(F.when(~unknown, F.sum("copies").cast("decimal(18,0)")).alias("copies"))

    nested = cut(nested.select("x_id", "y_id", "stoichiometry"))  # read three times
    cycles = cut(nesting_cycles(nested, rounds))
    steps = summed(nested.select(F.col("x_id").alias("part"), F.col("y_id").alias("whole"), number.alias("copies")), "part", "whole")
    steps = cut(steps.join(cycles, ["part", "whole"], "left_anti").select("part", "whole", F.col("copies").alias("times")))
    fresh = cut(summed(members.select("x_id", "y_id", number.alias("copies")), "x_id", "y_id").withColumn("depth", F.lit(1)))
    every = fresh
    for depth in range(2, rounds + 3):
        further = fresh.join(steps, fresh["y_id"] == steps["part"]).select("x_id", F.col("whole").alias("y_id"), (F.col("copies") * F.col("times")).cast("decimal(18,0)").alias("copies"))
        fresh = cut(summed(further, "x_id", "y_id").withColumn("depth", F.lit(depth)))
        if fresh.isEmpty():
            break
        every = every.unionByName(fresh)
    else:
        raise RuntimeError(f"complexes nest deeper than {rounds} levels")
    whole = summed(every, "x_id", "y_id").join(every.groupBy("x_id", "y_id").agg(F.min("depth").alias("depth")), ["x_id", "y_id"])
    return whole.select("x_id", "y_id", "depth", F.col("copies").cast("long").alias("copies")), cycles

"""Identifier and text expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Ontology prefixes written with an underscore in some sources; texts that stand for nothing.
CURIE_PREFIXES = ("EFO", "MONDO", "HP", "OBA", "GO", "MP", "NCIT", "GSSO", "DOID", "CL", "UBERON", "Orphanet")
BLANK = ("nan", "none", "null", "<na>")


def clean(c: Column) -> Column:
    """Trimmed text, or null where it stands for nothing."""
    t = F.trim(c)
    return F.when((t == "") | F.lower(t).isin(*BLANK), None).otherwise(t)


def normalize_curie(c: Column) -> Column:
    """EFO_123 becomes EFO:123 for the known prefixes; other ids stay."""
    return F.regexp_replace(clean(c), rf"^({'|'.join(CURIE_PREFIXES)})_([A-Za-z0-9]+)$", "$1:$2")


#: Labels of ids by pattern, the first that fits.
NAMESPACES = (
    ("^$", "<blank>"), ("^PMID:", "PMID"), ("^CHEMBL", "ChEMBL"), ("^DB[0-9]+$", "DrugBank"), ("^CVCL_", "Cellosaurus"), ("^EH38E", "ENCODE"), ("^R-HSA-", "Reactome"), ("^rs[0-9]+$", "dbSNP"),
    ("(?i)^(chr)?[0-9XYM]+[_:-][0-9]+[_:-][ACGTN]+[_:-][ACGTN]+$", "gnomAD-like"), ("^(EFO|DOID|CL|HP|GO|MONDO|UBERON|OBA|NCIT|GSSO|MP)_", "{prefix}_underscore"),
    ("^ENSG", "Ensembl Gene"), ("^ENST", "Ensembl Transcript"), ("^ENSP", "Ensembl Protein"), (":", "{prefix}"), ("^[0-9]+$", "numeric"),
)


def namespace(c: Column) -> Column:
    """What kind of id a text is; null counts as blank."""
    t = F.trim(F.coalesce(c, F.lit("")))
    out = None
    for pattern, name in NAMESPACES:
        label = F.concat(F.split_part(t, F.lit("_"), F.lit(1)), F.lit("_underscore")) if name == "{prefix}_underscore" else F.split_part(t, F.lit(":"), F.lit(1)) if name == "{prefix}" else F.lit(name)
        out = F.when(t.rlike(pattern), label) if out is None else out.when(t.rlike(pattern), label)
    return out.otherwise("unprefixed")


def edge_key(relation: Column, x: Column, y: Column) -> Column:
    return F.concat_ws("|", relation, x, y)


def credibility_from_score(score: Column, low: float, high: float) -> Column:
    """1, 2 or 3 by right-closed bins; no score counts as 0."""
    s = F.coalesce(score, F.lit(0.0))
    return F.when(s <= low, 1).when(s <= high, 2).otherwise(3).cast("long")


def first_reason(*rules: tuple[Column, str]) -> Column:
    """Name of the first rule that holds, or null."""
    out = F.lit(None).cast("string")
    for rule, name in reversed(rules):
        out = F.when(rule, F.lit(name)).otherwise(out)
    return out

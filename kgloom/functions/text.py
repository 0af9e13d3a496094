"""Text and record expressions for ingest."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from .ids import clean

#: Terms of a stop reason and the class they give, in order of precedence.
STOP_TERMS = (
    ("safety_failure_or_harm", ("safety", "adverse", "toxicity", "toxic", "death", "mortality", "harm")),
    ("terminated_business_funding_or_feasibility", ("business", "commercial", "strategic", "portfolio", "sponsor", "funding", "financial", "resource", "administrative", "recruitment", "enrollment", "accrual", "slow", "feasibility")),
    ("failed_efficacy_or_endpoint", ("efficacy", "futility", "lack of effect", "lack of efficacy", "ineffective", "not effective", "no benefit", "endpoint", "primary endpoint", "failed")),
)
#: States of a trial without a classed reason.
TRIAL_STATES = (
    ("terminated_unknown_reason", ("TERMINATED", "SUSPENDED")),
    ("withdrawn_unknown_reason", ("WITHDRAWN",)),
    ("active_or_recruiting_unknown_outcome", ("RECRUITING", "ENROLLING_BY_INVITATION", "NOT_YET_RECRUITING", "ACTIVE_NOT_RECRUITING")),
    ("completed_outcome_unknown", ("COMPLETED",)),
)
#: IUPAC nucleotide letters and their complements.
IUPAC, COMPLEMENT = "ACGTURYSWKMBDHVN", "TGCAAYRSWMKVHDBN"


def pubmed_ids(c: Column) -> Column:
    """Distinct PMIDs of `pubmed:1|doi:..` tokens, in order."""
    tokens = F.split(c, r"\|")
    ids = F.transform(tokens, lambda t: F.regexp_extract(F.trim(t), r"(?i)^(?:pubmed|pmid):\s*(\d+)$", 1))
    return F.array_distinct(F.filter(ids, lambda x: x != ""))


def nct_ids(c: Column) -> Column:
    """Distinct trial ids in upper case, in order."""
    return F.array_distinct(F.regexp_extract_all(F.upper(c), F.lit(r"(NCT\d{8})"), F.lit(1)))


def trial_class(state: Column, reason: Column) -> Column:
    """Trajectory of a trial by terms in its stop reason, else by its state."""
    s = F.translate(F.upper(F.trim(F.coalesce(state, F.lit("")))), " ", "_")
    r = F.lower(F.trim(F.coalesce(reason, F.lit(""))))
    rules = [(r.rlike("|".join(terms)), n) for n, terms in STOP_TERMS] + [(s.isin(*states), n) for n, states in TRIAL_STATES]
    return reduce(lambda out, rule: out.when(*rule), rules[1:], F.when(*rules[0])).otherwise("unknown_trial_trajectory")


def doi(c: Column) -> Column:
    """A DOI in lower case without resolver or prefix, or null."""
    found = F.regexp_extract(F.lower(F.trim(c)), r"(10\.[0-9]{4,9}/\S+)$", 1)
    return F.when(found != "", found)


def record_id(*parts: Column) -> Column:
    return F.sha2(F.concat_ws("|", *parts), 256)


def source_parts(c: Column) -> tuple[Column, Column]:
    """`A/B` as source and dataset; no dataset is empty."""
    return F.split_part(c, F.lit("/"), F.lit(1)), F.split_part(c, F.lit("/"), F.lit(2))


def slug(c: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(F.lower(F.trim(c)), r"[^a-z0-9]+", "-"), r"^-+|-+$", "")


def id_variants(c: Column) -> Column:
    """An id, and how other tables may write it."""
    return F.array_distinct(F.array(c, F.translate(c, ":", "_"), F.translate(c, "_", ":"), F.regexp_replace(c, r"^PMID:", "")))


def first_text(*columns: Column) -> Column:
    """The first that is not blank."""
    return F.coalesce(*[clean(c) for c in columns])


def reverse_complement(c: Column) -> Column:
    return F.reverse(F.translate(F.upper(c), IUPAC, COMPLEMENT))


def is_nucleotides(c: Column) -> Column:
    return F.upper(c).rlike(rf"^[{IUPAC}]*$")


def metadata_json(columns: list[str]) -> Column:
    """Extra columns as JSON with sorted names, nulls left out; null where nothing is left."""
    text = F.to_json(F.struct(*[F.col(c) for c in sorted(columns)]))
    return F.when(text != "{}", text)


def prefer(items: Column, source: str) -> Column:
    """Id of the first struct (id, source) of a source, else of the first."""
    own = F.filter(items, lambda p: p["source"] == source)
    return F.coalesce(F.get(own, F.lit(0))["id"], F.get(items, F.lit(0))["id"])

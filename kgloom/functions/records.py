"""First usable values of nested record fields, by the field's type."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, StringType, StructType

#: Fields that hold a variant's id, in order of preference; fields of a struct that do; lists of structs that may.
VARIANT_FIELDS = ("variantId", "variantRsId", "variantRsIds", "rsId", "rsIds", "leadVariantId", "tagVariantId")
NESTED_FIELDS = ("variantId", "variantRsId", "rsId", "id")
LOCUS_FIELDS = ("studyLocusId", "locus", "credibleSet", "credibleSets")


def first_scalar(c: Column, kind: DataType) -> Column:
    """The first text of a value that is not blank or 'nan': of a list the first entry with one, of a struct its id fields in order; null if none."""
    if isinstance(kind, ArrayType):
        found = F.transform(c, lambda x: first_scalar(x, kind.elementType))
        return F.get(F.filter(found, lambda x: x.isNotNull()), F.lit(0))
    if isinstance(kind, StructType):
        inside = [first_scalar(c[f], kind[f].dataType) for f in NESTED_FIELDS if f in kind.names]
        return F.coalesce(*inside) if inside else F.lit(None).cast("string")
    text = c if isinstance(kind, StringType) else c.cast("string")
    trimmed = F.trim(text)
    return F.when((trimmed != "") & (trimmed != "nan"), trimmed)


def _first_inside(items: Column, entry: StructType) -> Column:
    """The first variant id that an entry of a list of structs holds."""
    own = [k for k in VARIANT_FIELDS if k in entry.names]
    ids = F.transform(items, lambda e: F.coalesce(*[first_scalar(e[k], entry[k].dataType) for k in own]))
    return F.get(F.filter(ids, lambda x: x.isNotNull()), F.lit(0))


def variant_id(df: DataFrame) -> Column:
    """A variant's id from whichever fields df has: plain fields first, then entries of its lists of structs."""
    kinds = {f.name: f.dataType for f in df.schema.fields}
    found = [first_scalar(F.col(f), kinds[f]) for f in VARIANT_FIELDS if f in kinds]
    for f in LOCUS_FIELDS:
        if f in kinds and isinstance(kinds[f], ArrayType) and isinstance(entry := kinds[f].elementType, StructType):
            if any(k in entry.names for k in VARIANT_FIELDS):
                found.append(_first_inside(F.col(f), entry))
    return F.coalesce(*found) if found else F.lit(None).cast("string")

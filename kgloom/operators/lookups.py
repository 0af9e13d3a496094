"""Look-ups a user makes: entity resolution, alias search, pages, neighbours of one node."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.ids import first_reason


def resolve(nodes: DataFrame, text: str, xrefs: tuple[str, ...] = (), limit: int = 20) -> DataFrame:
    """Nodes that an identifier may mean, best kind of match first: id, cross references, name, name in any case."""
    c = F.lit(text)
    rules = [(F.col("id") == c, "id"), *((F.col(x) == c, x) for x in xrefs), (F.col("name") == c, "name"), (F.lower("name") == F.lower(c), "name_nocase")]
    order = F.lit(len(rules))
    for k, (rule, _) in reversed(list(enumerate(rules))):
        order = F.when(rule, k).otherwise(order)
    found = nodes.withColumn("match_kind", first_reason(*rules)).withColumn("match_order", order).where("match_kind IS NOT NULL").orderBy("match_order", "id").limit(limit)
    return found.withColumn("rank", F.row_number().over(Window.orderBy("match_order", "id"))).drop("match_order")  # `limit` rows at most


def alias_search(aliases: DataFrame, text: str, limit: int = 25, types: list[str] | None = None) -> DataFrame:
    """Nodes with an alias that is the text (0), starts with it (1) or holds it (2), by score, type and name.

    aliases has id, node_type, name, pos and alias; the first alias of a node (by pos) that matches counts,
    and `limit` rows come back, with a flag that says whether there are more.
    """
    a, t = F.lower("alias"), text.strip().lower()
    score = F.when(a == t, 0).when(a.startswith(t), 1).when(a.contains(t), 2)
    rows = aliases if types is None else aliases.where(F.col("node_type").isin(types))
    first = rows.withColumn("score", score).where("score IS NOT NULL").groupBy("node_type", "id").agg(F.min_by(F.struct("score", "alias", "name"), "pos").alias("m")).select("id", "node_type", "m.score", "m.alias", "m.name")
    order = ["score", "node_type", F.lower("name"), "id"]
    some = first.orderBy(*order).limit(limit + 1)
    place = Window.orderBy(*order)  # limit + 1 rows at most
    return some.withColumn("place", F.row_number().over(place)).withColumn("truncated", F.max("place").over(Window.partitionBy()) > limit).where(F.col("place") <= limit)


def page(df: DataFrame, keys: list[str], cursor: int, size: int) -> DataFrame:
    """One page in key order, with the total and the cursor of the next page (null after the last)."""
    after = cursor + size
    total = df.agg(F.count("*").alias("total")).withColumn("_one", F.lit(1))  # one row
    rows = df.orderBy(*keys).offset(cursor).limit(size).withColumn("_one", F.lit(1))
    return rows.join(F.broadcast(total), "_one").drop("_one").withColumn("next_cursor", F.when(F.lit(after) < F.col("total"), F.lit(after)).cast("long"))


def neighbours(edges: DataFrame, node: str) -> DataFrame:
    """Edges of one node seen from it: side, other end and its type."""
    own = edges.where((F.col("x_id") == node) | (F.col("y_id") == node))
    out = F.col("x_id") == node
    return own.select(F.when(out, "x").otherwise("y").alias("side"), "relation", F.when(out, F.col("y_id")).otherwise(F.col("x_id")).alias("other_id"), F.when(out, F.col("y_type")).otherwise(F.col("x_type")).alias("other_type"))


def capped(found: DataFrame, per_type: int, total: int) -> DataFrame:
    """At most `per_type` neighbours of each type and `total` in all, with the number that each type has."""
    n = found.groupBy("other_type").agg(F.count("*").alias("n_type"))
    kept = found.withColumn("type_rank", F.row_number().over(Window.partitionBy("other_type").orderBy("other_id", "relation", "side"))).where(F.col("type_rank") <= per_type)
    return kept.join(n, "other_type").orderBy("other_type", "type_rank").limit(total)


def shard(df: DataFrame, column: str, value: str, columns: list[str]) -> DataFrame:
    """Some columns of one partition shard; a shard that does not exist is an error."""
    own = df.where(F.col(column) == value)
    if own.isEmpty():
        raise ValueError(f"no shard {value!r} of {column}")
    return own.select(columns)


def shards(df: DataFrame, column: str) -> DataFrame:
    """The shards there are, with their rows."""
    return df.groupBy(column).agg(F.count("*").alias("n_rows"))


GENE_COLUMNS = ("id", "ncbi_gene_id", "hgnc_id", "uniprot_id", "gene_name", "name", "description", "source")


def resolve_gene(genes: DataFrame, identifier: str | None = None, *, gene_id: str | None = None, gene_name: str | None = None, symbol: str | None = None, human_only: bool = True, limit: int | None = 20) -> DataFrame:
    """Genes that one value may mean: ids and cross-references as given, names in any case; the best kind of match first.

    Exactly one value is asked for.  Names reach human genes only, unless told otherwise; an id reaches all.
    """
    given = {k: v for k, v in {"identifier": identifier, "gene_id": gene_id, "gene_name": gene_name, "symbol": symbol}.items() if v}
    if len(given) != 1:
        raise ValueError(f"give exactly one gene value, not {', '.join(given) or 'none'}")
    (kind, text), = given.items()
    if not text.strip():
        raise ValueError("a gene value can't be blank")
    v, col = F.lit(text.strip()), F.col
    same = lambda c: F.upper(c) == F.upper(v)
    hit = (col("id") == v) | (col("ncbi_gene_id") == v) | (col("hgnc_id") == v) | (col("uniprot_id") == v) | same("gene_name") | same("name") | same("id") | (F.upper(F.coalesce("description", F.lit(""))) == F.upper(v))
    found = genes.where(hit)
    if human_only and kind != "gene_id":
        other = F.lower(F.coalesce("source", F.lit(""))).contains("homologues") | F.lower(F.coalesce("description", F.lit(""))).contains("ortholog")
        found = found.where(col("id").startswith("ENSG") | col("id").startswith("NCBI:") | ~other)
    named = same("gene_name") | same("name")
    order = F.when(col("id") == v, 0).when(same("id"), 1).when(col("id").startswith("ENSG") & named, 2).when(col("id").startswith("NCBI:") & named, 3).when(same("gene_name"), 4).when(same("name"), 5).otherwise(9)
    match = F.when(same("id"), "id").when(col("ncbi_gene_id") == v, "ncbi_gene_id").when(col("hgnc_id") == v, "hgnc_id").when(col("uniprot_id") == v, "uniprot_id").when(same("gene_name"), "gene_name").when(same("name"), "name").otherwise("description")
    ranked = found.select(*GENE_COLUMNS, match.alias("match_kind"), F.row_number().over(Window.orderBy(order, "id")).alias("rank"))  # genes of one name
    return ranked if limit is None else ranked.where(col("rank") <= limit)


DISEASE_RESULT = ("gene_id", "gene_name", "gene_label", "disease_id", "disease_name", "disease_description", "mondo_id", "efo_id", "mesh_id", "hp_id", "omim_id", "doid_id", "icd10_code", "edge_source", "credibility", "score", "evidence_count", "evidence_sources", "evidence_score_max")


def diseases_for_gene(genes: DataFrame, edges: DataFrame, diseases: DataFrame, evidence: DataFrame | None, identifier: str | None = None, *, limit: int | None = None, **how) -> DataFrame:
    """Diseases of the genes that a value resolves to, with a summary of their evidence; those with evidence first.

    Without an evidence table every count is 0.
    """
    g = resolve_gene(genes, identifier, limit=None, **how).select(F.col("id").alias("x_id"), "gene_name", F.coalesce("name", "gene_name", "id").alias("gene_label"))
    e = edges.where("relation = 'disease_associated_gene'").join(F.broadcast(g), "x_id")  # genes of one name
    labels = diseases.select(F.col("id").alias("y_id"), F.nullif("name", F.lit("")).alias("_name"), F.col("description").alias("disease_description"), "mondo_id", "efo_id", "mesh_id", "hp_id", "omim_id", "doid_id", "icd10_code")
    out = e.join(labels, "y_id", "left")
    if evidence is None:
        out = out.withColumns({"evidence_count": F.lit(0).cast("long"), "evidence_sources": F.lit(None).cast("string"), "evidence_score_max": F.lit(None).cast("double")})
    else:
        own = evidence.join(F.broadcast(g.select("x_id")), "x_id", "left_semi")
        told = own.groupBy("x_id", "y_id").agg(F.count("*").alias("evidence_count"), F.array_join(F.array_sort(F.collect_set("source")), "; ").alias("evidence_sources"), F.max("evidence_score").alias("evidence_score_max"))
        out = out.join(told, ["x_id", "y_id"], "left").withColumn("evidence_count", F.coalesce("evidence_count", F.lit(0)))
    rows = out.select(F.col("x_id").alias("gene_id"), "gene_name", "gene_label", F.col("y_id").alias("disease_id"), F.coalesce("_name", "y_id").alias("disease_name"), *DISEASE_RESULT[5:13], F.col("source").alias("edge_source"), *DISEASE_RESULT[14:]).distinct()
    ordered = rows.orderBy(F.when(F.col("evidence_count") > 0, 0).otherwise(1), "disease_name", "disease_id", "gene_id")
    return ordered if limit is None else ordered.limit(limit)

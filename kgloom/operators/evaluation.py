"""Splits of a graph for training, and metrics of what a model predicts on them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .graph_ml import dense_index, ranged, split
from .sampling import descendants, draw, global_order, split_entities


def cross_fold(entities: DataFrame, key: str, seed: int, k: int, fold: int, inner: float = 0.9) -> DataFrame:
    """One fold of k as test; of the others, the first `inner` share in the seeded order is train, the rest valid.

    Folds are consecutive pieces of the order; the first n % k have one more.
    """
    placed = global_order(entities, key, seed)
    n = placed.agg(F.count("*").alias("n")).withColumn("one", F.lit(1))  # one row
    size, extra = F.floor(F.col("n") / k), F.col("n") % k
    start = F.lit(fold) * size + F.least(F.lit(fold), extra)
    width = size + F.when(F.lit(fold) < extra, 1).otherwise(0)
    rest = F.when(F.col("place") < start, F.col("place")).otherwise(F.col("place") - width)
    part = F.when((F.col("place") >= start) & (F.col("place") < start + width), "test").when(rest < F.floor((F.col("n") - width) * inner), "train").otherwise("valid")
    return placed.withColumn("one", F.lit(1)).join(F.broadcast(n), "one").select(key, part.alias("split"))


def few_neighbours(edges: DataFrame, pairs: DataFrame, most: int, seed: int, train: float) -> DataFrame:
    """Entities of pairs (y_id) with 1 to `most` edges at either end in the rest of the graph are test.

    Of the others, a share of all entities is train, in the seeded order, and the rest valid.
    """
    entity = pairs.select(F.col("y_id").alias("id")).distinct()
    ends = edges.select(F.col("x_id").alias("id")).unionAll(edges.select("y_id")).groupBy("id").agg(F.count("*").alias("n_edges"))
    counted = entity.join(ends, "id", "left").withColumn("few", F.coalesce(F.col("n_edges") <= most, F.lit(False)))
    return _rest(counted, seed, train)


def few_pairs(pairs: DataFrame, most: int, seed: int, train: float) -> DataFrame:
    """Entities (y_id) with `most` pairs at most are test; others as in `few_neighbours`."""
    counted = pairs.groupBy(F.col("y_id").alias("id")).agg(F.count("*").alias("n_edges")).withColumn("few", F.col("n_edges") <= most)
    return _rest(counted, seed, train)


def _rest(counted: DataFrame, seed: int, train: float) -> DataFrame:
    n = counted.agg(F.count("*").alias("n")).withColumn("one", F.lit(1))  # one row
    placed = global_order(counted.where("NOT few"), "id", seed).withColumn("one", F.lit(1)).join(F.broadcast(n), "one")
    kept = placed.select("id", F.when(F.col("place") < F.floor(F.col("n") * train), "train").otherwise("valid").alias("split"))
    return kept.unionAll(counted.where("few").select("id", F.lit("test")))


def full_graph(edges: DataFrame, group: str, key: str, seed: int, valid: float = 0.05) -> DataFrame:
    """Train and valid; the valid edges stand for a test as well."""
    parts = split(edges, group, key, seed, valid, 0.0)
    return parts.unionByName(parts.where("split = 'valid'").withColumn("split", F.lit("test")))


def area_split(edges: DataFrame, parents: DataFrame, roots: DataFrame, entity: str) -> DataFrame:
    """Edges of entities below the roots of an area are test, others train."""
    inside = descendants(parents, roots).select(F.col("id").alias(entity)).withColumn("_in", F.lit(True))
    return edges.join(inside, entity, "left").withColumn("split", F.when(F.col("_in"), "test").otherwise("train")).drop("_in")


def area_test(test: DataFrame, listed: DataFrame, grouped: DataFrame, relations: list[str]) -> DataFrame:
    """Test rows of reversed relations for listed entities only; a grouped id (id, member) stands for its members."""
    own = listed.select("id").join(grouped, listed["id"] == grouped["member"], "left").select(F.coalesce(grouped["id"], listed["id"]).alias("x_id")).distinct()
    reverse = test.where(F.col("relation").isin([f"rev_{r}" for r in relations])).join(own, "x_id", "left_semi")
    return reverse.unionByName(test.where(~F.col("relation").startswith("rev_")))


def without(edges: DataFrame, keep: list[str] | None = None, drop: list[str] | None = None) -> DataFrame:
    """Ablations: only some relations (and their reverses), or all but some."""
    base = F.regexp_replace("relation", "^rev_", "")
    if keep is not None:
        return edges.where(base.isin(keep))
    return edges.where(~base.isin(drop or []))


def link_split(edges: DataFrame, key: str, seed: int, most_train: int | None = None, share: float = 0.1) -> DataFrame:
    """Disjoint valid and test links of a relation, at least one each, the others train (at most `most_train` of them).

    Fewer than three links can't be split: an error where that is known, here no rows.
    """
    placed = global_order(edges, key, seed)
    n = placed.agg(F.count("*").alias("n")).withColumn("one", F.lit(1))  # one row
    held = F.greatest(F.lit(1), F.floor(F.col("n") * share))
    part = F.when(F.col("place") < held, "test").when(F.col("place") < 2 * held, "valid").otherwise("train")
    out = placed.withColumn("one", F.lit(1)).join(F.broadcast(n), "one").where("n >= 3").select(key, part.alias("split"), (F.col("place") - 2 * held).alias("rank"))
    return (out if most_train is None else out.where((F.col("split") != "train") | (F.col("rank") < most_train))).select(key, "split")


def message_edges(edges: DataFrame, links: DataFrame, key: str) -> DataFrame:
    """Edges that messages may use: train links, and their reverses; none of valid or test in either direction."""
    train = edges.join(links.where("split = 'train'"), key, "left_semi")
    return train.select("x_id", "y_id", "relation").unionAll(train.select("y_id", "x_id", F.concat(F.lit("rev_"), "relation")))


def indexed_edges(edges: DataFrame, nodes: DataFrame, strict: bool = True) -> DataFrame:
    """relation, src, dst by dense index; `strict`: a dangling edge is an error that says how many."""
    index = dense_index(nodes)
    end = lambda s, name: index.select(F.col("node_type").alias(f"{s}_type"), F.col("id").alias(f"{s}_id"), F.col("node_index").alias(name))
    joined = edges.join(end("x", "src"), ["x_type", "x_id"], "left").join(end("y", "dst"), ["y_type", "y_id"], "left")
    if strict:
        bad = joined.where("src IS NULL OR dst IS NULL").groupBy("relation").count().orderBy("relation").limit(20).collect()  # a row a relation, 20 at most
        if bad:
            raise ValueError("; ".join(f"{r.relation} has {r['count']} dangling edges" for r in bad))
    return joined.where("src IS NOT NULL AND dst IS NOT NULL").select("relation", "src", "dst")


def edge_positions(edges: DataFrame) -> DataFrame:
    """Place of every edge (relation, x_id, y_id) in its relation, by ends."""
    ids = edges.select(F.col("relation").alias("node_type"), F.concat_ws("\t", "x_id", "y_id").alias("id"))
    found = dense_index(ids)
    return found.select(F.col("node_type").alias("relation"), F.split_part("id", F.lit("\t"), F.lit(1)).alias("x_id"), F.split_part("id", F.lit("\t"), F.lit(2)).alias("y_id"), F.col("node_index").alias("edge_pos"))


def feature_rows(nodes: DataFrame, vectors: DataFrame, dim: int) -> DataFrame:
    """A vector for every node: its own (id, vector), else one that a hash of its id gives; is_real tells which."""
    value = lambda k: (draw(0, "node_type", F.col("id").cast("string"), F.lit(str(k))) % 2001 - 1000) / 1000
    fallback = F.array(*[value(k) for k in range(dim)])
    return nodes.join(vectors, "id", "left").select("node_type", "id", F.coalesce("vector", fallback).alias("vector"), F.col("vector").isNotNull().alias("is_real"))


def evaluation_pairs(entities: DataFrame, items: DataFrame, seen: DataFrame) -> DataFrame:
    """Every item for each entity to be evaluated: label 1 for a test edge, -1 for one of training, 0 for none.

    entities: entity; items: item; seen: entity, item, test (a pair in both counts as
    test).  All pairs are the output asked for; entities are spread over the items by
    an explode of their list, which is that of an evaluation and bounded by it.
    """
    listed = entities.agg(F.collect_set("entity").alias("listed")).withColumn("one", F.lit(1))  # one row
    every = items.select("item", F.lit(1).alias("one")).distinct().join(listed, "one").select("item", F.explode("listed").alias("entity"))
    known = seen.groupBy("entity", "item").agg(F.bool_or("test").alias("test"))
    label = F.when(F.col("test"), 1).when(F.col("test").isNotNull(), -1).otherwise(0)
    return every.join(known, ["entity", "item"], "left").select("entity", "item", label.alias("label"))


def id_names(nodes: DataFrame) -> DataFrame:
    """node_type, node_index, id and name of every node (node_type, id, name): both ways from index to id to name; of names of one id the smallest."""
    names = nodes.groupBy("node_type", "id").agg(F.min("name").alias("name"))
    return dense_index(nodes.select("node_type", "id")).join(names, ["node_type", "id"]).select("node_type", "node_index", "id", F.coalesce("name", "id").alias("name"))


def test_entities(split_edges: DataFrame, side: str = "y_id", part: str = "test") -> DataFrame:
    """relation, entity, n: the entities of each relation's test edges, and how many edges they have there."""
    return split_edges.where(F.col("split") == part).groupBy("relation", F.col(side).alias("entity")).agg(F.count("*").alias("n"))


def _ranked(scored: DataFrame, entity: list[str]) -> DataFrame:
    """Scores with their mean rank among equals, and counts of rows and hits down to the end of each tie."""
    w, ties = Window.partitionBy(*entity), Window.partitionBy(*entity, "score")
    down = w.orderBy(F.desc("score")).rangeBetween(Window.unboundedPreceding, 0)
    true = (F.col("label") == 1).cast("long")
    return scored.withColumns({"n_above": F.count("*").over(down), "hits_above": F.sum(true).over(down), "mean_rank": F.rank().over(w.orderBy("score")) + (F.count("*").over(ties) - 1) / 2})


def areas(scored: DataFrame, entity: list[str]) -> DataFrame:
    """AUROC (rank sum, ties averaged) and average precision for each entity; -1 where a class is missing."""
    true = F.col("label") == 1
    agg = _ranked(scored, entity).groupBy(*entity).agg(
        F.count_if(true).alias("n_pos"), F.count_if(~true).alias("n_neg"), F.sum(F.when(true, F.col("mean_rank"))).alias("ranks"), F.sum(F.when(true, F.col("hits_above") / F.col("n_above"))).alias("precisions")
    )
    p, n = F.col("n_pos"), F.col("n_neg")
    auroc = F.when((p > 0) & (n > 0), (F.col("ranks") - p * (p + 1) / 2) / (p * n)).otherwise(-1.0)
    return agg.select(*entity, "n_pos", "n_neg", auroc.alias("auroc"), F.when(p > 0, F.col("precisions") / p).otherwise(-1.0).alias("auprc"))


def spread_areas(scored: DataFrame, pool: list[str]) -> DataFrame:
    """The areas of pools of any size, none of which is one task.

    Equal scores of a pool are one row of counts; those are dealt to ranges, and the
    counts above a row are those of the ranges before and of its own range.
    """
    true = F.col("label") == 1
    ties = scored.groupBy(*pool, "score").agg(F.count_if(true).alias("p"), F.count_if(~true).alias("q"))
    dealt = ranged(ties.withColumn("down", -F.col("score").cast("double")), *pool, "down")
    sizes = dealt.groupBy(*pool, "chunk").agg(F.sum("p").alias("sp"), F.sum("q").alias("sq"))
    before = Window.partitionBy(*pool).orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)  # a row for each partition
    base = sizes.select(*pool, "chunk", F.coalesce(F.sum("sp").over(before), F.lit(0)).alias("bp"), F.coalesce(F.sum("sq").over(before), F.lit(0)).alias("bq"))
    inside = Window.partitionBy(*pool, "chunk").orderBy("down").rowsBetween(Window.unboundedPreceding, 0)
    rows = dealt.withColumns({"cp": F.sum("p").over(inside), "cq": F.sum("q").over(inside)}).join(base, [*pool, "chunk"])
    hits, misses = F.col("cp") + F.col("bp"), F.col("cq") + F.col("bq")  # down to the end of the tie
    above = F.sum(F.col("p") * (misses - F.col("q") / 2))  # of the negatives, those that a positive ranks below
    agg = rows.groupBy(*pool).agg(F.sum("p").alias("n_pos"), F.sum("q").alias("n_neg"), above.alias("lost"), F.sum(F.col("p") * hits / (hits + misses)).alias("precisions"))
    p, n = F.col("n_pos"), F.col("n_neg")
    auroc = F.when((p > 0) & (n > 0), 1 - F.col("lost") / (p * n)).otherwise(-1.0)
    return agg.select(*pool, "n_pos", "n_neg", auroc.alias("auroc"), F.when(p > 0, F.col("precisions") / p).otherwise(-1.0).alias("auprc"))


def top_k_metrics(scored: DataFrame, entity: str, ks: dict[str, int], n_items: int) -> DataFrame:
    """Recall, recall of a random order, enrichment, average precision and reciprocal rank at each k.

    scored has (entity, id, label, score); label -1 (seen in training) is left out.  Equal scores rank by
    id, the greatest first.  Without a positive all are -1.
    """
    place = F.row_number().over(Window.partitionBy(entity).orderBy(F.desc("score"), F.desc("id")))
    hits_to = Window.partitionBy(entity).orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    rows = scored.where("label <> -1").withColumn("place", place).withColumn("precision", F.sum((F.col("label") == 1).cast("long")).over(hits_to) / F.col("place"))
    hit = F.col("label") == 1
    cells = {}
    for name, k in ks.items():
        inside = hit & (F.col("place") <= k)
        cells |= {f"hits_{name}": F.count_if(inside), f"ap_{name}": F.coalesce(F.avg(F.when(inside, F.col("precision"))), F.lit(0.0)), f"mrr_{name}": F.coalesce(1 / F.min(F.when(inside, F.col("place"))), F.lit(0.0))}
    agg = rows.groupBy(entity).agg(F.count_if(hit).alias("n_pos"), *[c.alias(n) for n, c in cells.items()])
    some = F.col("n_pos") > 0
    each = []
    for name, k in ks.items():
        hits, chance = F.col(f"hits_{name}"), F.lit(k / n_items)
        each.append(F.struct(F.lit(name).alias("k"), (hits / F.col("n_pos")).alias("recall"), chance.alias("recall_random"), (hits / (chance * F.col("n_pos"))).alias("enrichment"), F.col(f"ap_{name}").alias("ap"), F.col(f"mrr_{name}").alias("mrr")))
    long = agg.select(entity, "n_pos", F.explode(F.array(*each)).alias("m"))
    value = lambda c: F.when(some, F.round(f"m.{c}", 6)).otherwise(-1.0).alias(c)
    return long.select(entity, "n_pos", "m.k", *[value(c) for c in ("recall", "recall_random", "enrichment", "ap", "mrr")])


def micro_macro(scored: DataFrame, relation: str) -> DataFrame:
    """Areas of each relation, of all pairs together (micro), and the mean over relations that have both classes (macro)."""
    each = spread_areas(scored, [relation]).select(F.col(relation).cast("string").alias("name"), "auroc", "auprc")
    micro = spread_areas(scored.withColumn("_all", F.lit("micro")), ["_all"]).select(F.col("_all").alias("name"), "auroc", "auprc")
    macro = each.where("auroc >= 0").agg(F.lit("macro").alias("name"), F.avg("auroc").alias("auroc"), F.avg("auprc").alias("auprc"))
    return each.unionAll(micro).unionAll(macro).select("name", F.round("auroc", 6).alias("auroc"), F.round("auprc", 6).alias("auprc"))


def summary(metrics: DataFrame, by: list[str], values: list[str]) -> DataFrame:
    """Mean and standard deviation (of the population) of each metric."""
    long = metrics.select(*by, F.explode(F.array(*[F.struct(F.lit(v).alias("metric"), F.col(v).cast("double").alias("value")) for v in values])).alias("m"))
    return long.groupBy(*by, "m.metric").agg(F.count("m.value").alias("n"), F.round(F.avg("m.value"), 6).alias("mean"), F.round(F.stddev_pop("m.value"), 6).alias("std"))


def pooled_areas(scored: DataFrame, run: list[str], seed: str) -> DataFrame:
    """Areas of the pooled scores of each run and seed, then mean and deviation over the seeds."""
    return summary(spread_areas(scored, [*run, seed]), run, ["auroc", "auprc"])


def rarity(degree: Column, rate: float) -> Column:
    """Weight of a prototype: high for nodes of low degree, at least 0.2."""
    return rate * F.exp(-rate * degree) + 0.2


def blended(own: Column, proto: Column, weight: Column) -> Column:
    """(1 - weight) * own + weight * prototype, by place."""
    return F.zip_with(own, proto, lambda a, b: (1 - weight) * a.cast("double") + weight * b.cast("double"))


def entity_split(edges: DataFrame, pairs: DataFrame, key: str, seed: int, valid: float, test: float, group: str, edge_key: str) -> DataFrame:
    """Pairs follow the split of their entity; other edges are split within their relation."""
    held = pairs.join(split_entities(pairs, key, seed, valid, test), key)
    return held.select(edge_key, "split").unionAll(split(edges, group, edge_key, seed, valid, test).select(edge_key, "split"))

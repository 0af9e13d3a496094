"""Seeded samples, splits, negatives, walks and reachable sets.

All draws come from SHA-256 of a seed and a key, so a rerun of a lost task gives the same rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.shared import cut
from .graph_ml import dense_index, places, ranged, split_key


def draw(seed: int, *keys) -> Column:
    """A number below 2^48 from the seed and keys."""
    return F.conv(F.substring(F.sha2(F.concat_ws("|", F.lit(str(seed)), *keys), 256), 1, 12), 16, 10).cast("long")


def global_order(keys: DataFrame, key: str, seed: int) -> DataFrame:
    """Distinct keys with their place in the seeded order, ranked range by range."""
    ids = keys.select(F.lit("").alias("node_type"), F.concat_ws("|", split_key(seed, F.col(key)), F.col(key).cast("string")).alias("id"))
    placed = dense_index(ids).select(F.expr("substring(id, 66)").cast(keys.schema[key].dataType).alias(key), F.col("node_index").alias("place"))
    return placed


def split_entities(entities: DataFrame, key: str, seed: int, valid: float, test: float) -> DataFrame:
    """Distinct entities with train, valid or test; the edges of an entity follow it."""
    n = entities.select(key).distinct().count()
    a, b = int(n * test), int(n * test) + int(n * valid)
    return global_order(entities, key, seed).select(key, F.when(F.col("place") < a, "test").when(F.col("place") < b, "valid").otherwise("train").alias("split"))


def folds(entities: DataFrame, key: str, seed: int, k: int) -> DataFrame:
    """Distinct entities dealt to k folds of equal size in the seeded order."""
    n = entities.select(key).distinct().count()
    return global_order(entities, key, seed).select(key, F.floor(F.col("place") * k / max(1, n)).alias("fold"))


def holdout(edges: DataFrame, entity: str, listed: DataFrame, key: str, seed: int, valid: float) -> DataFrame:
    """test: edges of listed entities; a share of the other edges is valid."""
    marked = edges.join(listed.select(entity).distinct().withColumn("held", F.lit(True)), entity, "left")
    rest = marked.where("held IS NULL").drop("held")
    parts = split_entities(rest, key, seed, valid, 0.0)
    return marked.where("held").drop("held").withColumn("split", F.lit("test")).unionByName(rest.join(parts, key))


def few_edges(edges: DataFrame, entity: str, most: int) -> DataFrame:
    """Entities with `most` edges at most are test, others train."""
    return edges.groupBy(entity).agg(F.count("*").alias("n_edges")).withColumn("split", F.when(F.col("n_edges") <= most, "test").otherwise("train"))


def corrupt_targets(edges: DataFrame, targets: DataFrame, k: int, seed: int) -> DataFrame:
    """k uniform targets for each edge (x_id, y_id); pairs that exist are dropped, repeated ones count once."""
    index = dense_index(targets.select(F.lit("").alias("node_type"), F.col("y_id").alias("id"))).select(F.col("id").alias("y_new"), F.col("node_index").alias("pick"))
    n = targets.select("y_id").distinct().count()
    e = edges.select("x_id", "y_id").distinct()
    drawn = e.withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(k - 1)))).withColumn("pick", draw(seed, "x_id", "y_id", F.col("copy").cast("string")) % max(1, n))
    return drawn.join(index, "pick").select("x_id", F.col("y_new").alias("y_id")).distinct().join(e, ["x_id", "y_id"], "left_anti")


def _swapped(edges: DataFrame) -> DataFrame:
    return edges.select(F.col("y_id").alias("x_id"), F.col("x_id").alias("y_id"))


def corrupt_sources(edges: DataFrame, sources: DataFrame, k: int, seed: int) -> DataFrame:
    """k uniform sources (x_id) for each edge, else as `corrupt_targets`."""
    return _swapped(corrupt_targets(_swapped(edges), sources.select(F.col("x_id").alias("y_id")), k, seed))


def corrupt_both(edges: DataFrame, sources: DataFrame, targets: DataFrame, k: int, seed: int) -> DataFrame:
    """k pairs of a uniform source and a uniform target for each edge; pairs that exist are dropped, repeated ones count once."""
    e = edges.select("x_id", "y_id").distinct()
    drawn = e.withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(k - 1))))
    for n, (ids, end) in enumerate(((sources, "x_id"), (targets, "y_id"))):
        index = dense_index(ids.select(F.lit("").alias("node_type"), F.col(end).alias("id"))).select(F.col("id").alias(f"new_{end}"), F.col("node_index").alias("pick"))
        size = index.agg(F.count("*").alias("size")).withColumn("one", F.lit(1))  # one row
        drawn = drawn.withColumn("one", F.lit(1)).join(F.broadcast(size), "one").withColumn("pick", draw(seed + n, "x_id", "y_id", F.col("copy").cast("string")) % F.col("size")).join(index, "pick").drop("pick", "one", "size")
    return drawn.select(F.col("new_x_id").alias("x_id"), F.col("new_y_id").alias("y_id")).distinct().join(e, ["x_id", "y_id"], "left_anti")


def weighted_sources(edges: DataFrame, k: int, seed: int, power: float = 0.75) -> DataFrame:
    """k sources for each edge, drawn with weight degree^power."""
    return weighted_targets(_swapped(edges), k, seed, power).select(F.col("y_id").alias("x_id"), F.col("x_id").alias("y_id"), "copy", "negative")


def cumulative(weights: DataFrame) -> DataFrame:
    """(id, weight) with the half-open range [lo, hi) that each id owns; whole weights, in id order."""
    dealt = ranged(weights, "id")
    sizes = dealt.groupBy("chunk").agg(F.sum("weight").alias("total"))
    offsets = sizes.select("chunk", F.coalesce(F.sum("total").over(Window.orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("offset"))  # a row for each partition
    hi = F.sum("weight").over(Window.partitionBy("chunk").orderBy("id").rowsBetween(Window.unboundedPreceding, 0)) + F.col("offset")
    return dealt.join(F.broadcast(offsets), "chunk").select("id", (hi - F.col("weight")).alias("lo"), hi.alias("hi"))


def weighted_targets(edges: DataFrame, k: int, seed: int, power: float = 0.75) -> DataFrame:
    """k targets for each edge, drawn with weight degree^power: draws meet the owned ranges in bins of equal width."""
    e = edges.select("x_id", "y_id").distinct()
    weights = e.groupBy(F.col("y_id").alias("id")).agg(F.floor(F.pow(F.count("*").cast("double"), F.lit(power)) * 1000).alias("weight"))
    n, total = weights.agg(F.count("*"), F.sum("weight")).first()
    if not n:
        return e
    width = max(1, total // n)
    owned = cumulative(weights).withColumn("bin", F.explode(F.sequence(F.floor(F.col("lo") / width), F.floor((F.col("hi") - 1) / width))))
    drawn = e.withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(k - 1)))).withColumn("at", draw(seed, "x_id", "y_id", F.col("copy").cast("string")) % total).withColumn("bin", F.floor(F.col("at") / width))
    return drawn.join(owned, "bin").where("at >= lo AND at < hi").select("x_id", "y_id", "copy", F.col("id").alias("negative"))


def k_hop(edges: DataFrame, seeds: DataFrame, k: int) -> DataFrame:
    """Ids within k undirected steps of the seeds (id), with the fewest steps."""
    both = edges.select(F.col("x_id").alias("id"), F.col("y_id").alias("next")).union(edges.select("y_id", "x_id"))
    seen = seeds.select("id", F.lit(0).alias("hops")).distinct()
    for step in range(1, k + 1):
        found = seen.where(F.col("hops") == step - 1).join(both, "id").select(F.col("next").alias("id")).distinct()
        seen = seen.unionByName(found.join(seen, "id", "left_anti").withColumn("hops", F.lit(step)))
    return seen


def descendants(parents: DataFrame, roots: DataFrame) -> DataFrame:
    """Everything below the roots (id) by (child, parent), with its depth; rounds go on until none is new."""
    seen = fresh = cut(roots.select("id", F.lit(0).alias("depth")).distinct())
    depth = 0
    while True:
        depth += 1
        found = fresh.select(F.col("id").alias("parent")).join(parents, "parent").select(F.col("child").alias("id")).distinct()
        fresh = cut(found.join(seen, "id", "left_anti").withColumn("depth", F.lit(depth)))
        if fresh.isEmpty():
            return seen
        seen = cut(seen.unionByName(fresh))


def walk(edges: DataFrame, walks: int, length: int, seed: int) -> DataFrame:
    """Walks from every x_id over undirected edges: one row for each start, walk and step (0 is the start)."""
    both = edges.select(F.col("x_id").alias("at"), F.col("y_id").alias("next")).union(edges.select("y_id", "x_id")).distinct()
    ways = cut(places(both, "at", ["next"]).withColumnRenamed("place", "way"))  # ranked by ranges: a hub's neighbours are no single task
    degree = ways.groupBy("at").agg(F.count("*").alias("degree"))
    now = edges.select(F.col("x_id").alias("start")).distinct().withColumn("walk", F.explode(F.sequence(F.lit(0), F.lit(walks - 1)))).select("start", "walk", F.lit(0).alias("step"), F.col("start").alias("at"))
    out = now
    for step in range(1, length + 1):
        pick = draw(seed, "start", F.col("walk").cast("string"), F.lit(str(step))) % F.col("degree")
        now = now.join(degree, "at").withColumn("way", pick).join(ways, ["at", "way"]).select("start", "walk", F.lit(step).alias("step"), F.col("next").alias("at"))
        out = out.unionByName(now)
    return out


#: Blocks of consecutive x that a partition owns on average.
_BLOCKS = 2


def _counted(edges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """block, x, o, common, size and other_size: how many neighbours two different numbers of x share and how many each has; and the numbers (x) of x_id, in its order.

    A neighbour's list of x goes once to every block of numbers that owns one of them,
    with the sizes; pairs are made and counted there, so no pair is shuffled.
    """
    tasks = int(edges.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    numbered = cut(dense_index(edges.select(F.lit("").alias("node_type"), F.col("x_id").alias("id"))).select(F.col("id").alias("x_id"), F.col("node_index").alias("x")))
    n = numbered.count()
    width, kind = max(1, n // (_BLOCKS * tasks)), "int" if n < 1 << 31 else "long"
    numbered = numbered.hint("shuffle_hash")  # its rows grow with the input
    e = edges.select("x_id", "y_id").repartition("x_id").distinct()  # what follows meets by x, too
    sized = e.groupBy("x_id").agg(F.count("*").alias("size")).join(numbered, "x_id")
    lists = e.join(sized, "x_id").groupBy("y_id").agg(F.array_sort(F.collect_list(F.struct("x", "size"))).alias("all")).where("size(all) > 1")
    owner = lambda x: F.floor(x / width).cast("int")
    sent = lists.select(F.col("all.x").cast(f"array<{kind}>").alias("xs"), F.col("all.size").cast("array<int>").alias("sizes"))
    sent = sent.select("xs", "sizes", F.explode(F.array_distinct(F.transform("xs", owner))).alias("block")).repartition(tasks, "block")
    mine = sent.select("block", "xs", "sizes", F.posexplode("xs").alias("at", "x")).where(owner(F.col("x")) == F.col("block")).select("block", "xs", "sizes", "x", F.get("sizes", F.col("at")).alias("size"))
    pairs = mine.select("block", "x", "size", "sizes", F.posexplode("xs").alias("at", "o")).where("x <> o").select("block", "x", "size", "o", F.get("sizes", F.col("at")).alias("other_size"))
    return pairs.groupBy("block", "x", "o").agg(F.count("*").alias("common"), F.max("size").alias("size"), F.max("other_size").alias("other_size")), numbered


def _named(pairs: DataFrame, numbered: DataFrame) -> DataFrame:
    return pairs.join(numbered, "x").join(numbered.select(F.col("x").alias("o"), F.col("x_id").alias("other")), "o")


def _common(edges: DataFrame) -> DataFrame:
    """x_id, other, common: how many neighbours two different x share."""
    return _named(*_counted(edges)).select("x_id", "other", "common")


def profile_similarity(edges: DataFrame, k: int) -> DataFrame:
    """The k most similar x for each x by cosine of their 0/1 neighbour profiles; only those k meet the names."""
    common, numbered = _counted(edges.where("x_id IS NOT NULL AND y_id IS NOT NULL"))
    scored = common.withColumn("cosine", F.round(F.col("common") / F.sqrt(F.col("size") * F.col("other_size")), 6))
    best = F.row_number().over(Window.partitionBy("block", "x").orderBy(F.desc("cosine"), "o"))
    found = scored.withColumn("n", best).where(F.col("n") <= k).select("x", "o", "common", "cosine", "n")
    return _named(found, numbered).select("x_id", "other", "common", "cosine", "n")

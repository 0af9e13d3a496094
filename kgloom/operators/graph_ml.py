"""Graph-ML data preparation and evaluation."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.shared import cut


def compose(ac: DataFrame, cb: DataFrame, name: str) -> DataFrame:
    """Two-hop paths over a common middle: support, and the best of the weaker credibilities."""
    left = ac.select("x_id", F.col("y_id").alias("mid"), F.col("credibility").alias("c1"))
    right = cb.select(F.col("x_id").alias("mid"), "y_id", F.col("credibility").alias("c2"))
    paths = left.join(right, "mid").groupBy("x_id", "y_id").agg(F.count("*").alias("support"), F.max(F.least("c1", "c2")).alias("credibility"))
    return paths.withColumn("relation", F.lit(name))


def novel(candidates: DataFrame, observed: DataFrame) -> DataFrame:
    return candidates.join(observed.select("x_id", "y_id").distinct(), ["x_id", "y_id"], "left_anti")


def ranged(rows: DataFrame, *keys: str) -> DataFrame:
    """Rows dealt to ranges of the keys, with the number of the range, written once.

    Range bounds are sampled anew each time a plan runs, so sizes and ranks are
    read from the same written rows.
    """
    return cut(rows.repartitionByRange(*keys).withColumn("chunk", F.spark_partition_id()))


def dense_index(nodes: DataFrame) -> DataFrame:
    """node_index 0.. within each type by id: ranks within ranges of ids, and the ranges' offsets.

    Its joins are named shuffled ones: its rows grow with the input, and are far larger
    than the files from which their size is guessed, so the driver must not gather them.
    """
    dealt = ranged(nodes.select("node_type", "id").distinct(), "node_type", "id")
    sizes = dealt.groupBy("node_type", "chunk").count()
    before = Window.partitionBy("node_type").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)  # a row for each partition
    offsets = sizes.select("node_type", "chunk", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("offset"))
    rank = F.row_number().over(Window.partitionBy("node_type", "chunk").orderBy("id")) - 1
    return dealt.withColumn("rank", rank).join(F.broadcast(offsets), ["node_type", "chunk"]).select("node_type", "id", (F.col("rank") + F.col("offset")).cast("long").alias("node_index")).hint("shuffle_hash")


def places(rows: DataFrame, group: str, order: list[str]) -> DataFrame:
    """rows with `place` 0.. in their group by order, ranked range by range; rows with a null come first."""
    dealt = ranged(rows, group, *order)
    sizes = dealt.groupBy(group, "chunk").count()
    before = Window.partitionBy(group).orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)  # a row for each partition
    offsets = sizes.select(F.col(group).alias("_group"), F.col("chunk").alias("_chunk"), F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_offset"))
    rank = F.row_number().over(Window.partitionBy(group, "chunk").orderBy(*order)) - 1
    joined = dealt.withColumn("_rank", rank).join(offsets, F.col(group).eqNullSafe(F.col("_group")) & (F.col("chunk") == F.col("_chunk")))
    return joined.select(*rows.columns, (F.col("_rank") + F.col("_offset")).cast("long").alias("place"))


def reversed_edges(edges: DataFrame) -> DataFrame:
    """Swapped edges; the relation is renamed where the ends have different types."""
    name = F.when(F.col("x_type") == F.col("y_type"), F.col("relation")).otherwise(F.concat(F.lit("rev_"), "relation"))
    return edges.select(F.col("y_id").alias("x_id"), F.col("y_type").alias("x_type"), F.col("x_id").alias("y_id"), F.col("x_type").alias("y_type"), name.alias("relation"))


def undirected(edges: DataFrame) -> DataFrame:
    """One row for each pair of different ends."""
    return edges.where("x_id <> y_id").select(F.least("x_id", "y_id").alias("x_id"), F.greatest("x_id", "y_id").alias("y_id")).distinct()


def split_key(seed: int, key: Column) -> Column:
    return F.sha2(F.concat_ws("|", F.lit(str(seed)), key), 256)


#: Bins of the seeded order, by the leading 12 bits of a row's hash.
_BIN = 3


def last_rows(keyed: DataFrame, asked: dict[str, Callable[[Column], Column]]) -> DataFrame:
    """_g and, for each name of `asked`, hash and name (_h, _n) of the last of a group's first `asked(its size)` rows in the seeded order; null where there are none.  keyed: _g, _h, _n.

    No row is moved but those of the bins in which a number ends: the others are counted by bins of their hash.
    """
    own, cell = Window.partitionBy("_g"), F.substring("_h", 1, _BIN).alias("_bin")  # 4,096 bins at most
    bins = keyed.groupBy("_g", cell).agg(F.count("*").alias("n"))
    placed = bins.select("_g", "_bin", "n", F.sum("n").over(own).alias("size"), (F.sum("n").over(own.orderBy("_bin")) - F.col("n")).alias("before"))
    budgets = F.explode(F.array(*[F.struct(F.lit(name).alias("name"), F.least(rule(F.col("size")), "size").cast("long").alias("asked")) for name, rule in asked.items()])).alias("b")
    ends = placed.select("_g", "_bin", "n", "before", budgets).where("before < b.asked AND before + n >= b.asked")
    ends = ends.select(F.col("_g").alias("_eg"), F.col("_bin").alias("_eb"), F.col("b.name").alias("name"), (F.col("b.asked") - F.col("before")).alias("left"))  # a row for each group and name
    within = keyed.select("_g", "_h", "_n", cell).join(F.broadcast(ends), F.col("_g").eqNullSafe(F.col("_eg")) & (F.col("_bin") == F.col("_eb")))
    found = within.withColumn("rank", F.row_number().over(Window.partitionBy("_g", "name").orderBy("_h", "_n"))).where("rank = left")
    return found.groupBy("_g").agg(*[F.max(F.when(F.col("name") == name, F.struct("_h", "_n"))).alias(name) for name in asked])


def split(df: DataFrame, group: str, key: str, seed: int, valid: float, test: float) -> DataFrame:
    """Exact shares within each group by a seeded hash order; `key` is unique in its group.

    Rows stay where they are: each is held against the last row of its group's shares.
    """
    first, both = lambda n: F.floor(n * test), lambda n: F.floor(n * test) + F.floor(n * valid)
    marks = {"_g": F.col(group), "_h": split_key(seed, F.col(key)), "_n": F.coalesce(F.col(key).cast("string"), F.lit(""))}
    ends = cut(last_rows(df.select(*[c.alias(name) for name, c in marks.items()]), {"_test": first, "_valid": both})).withColumnRenamed("_g", "_eg")
    marked = df.withColumns(marks).join(F.broadcast(ends), F.col("_g").eqNullSafe(F.col("_eg")), "left")  # a row for each group
    upto = lambda end: F.coalesce(F.struct("_h", "_n") <= F.col(end), F.lit(False))
    return marked.withColumn("split", F.when(upto("_test"), "test").when(upto("_valid"), "valid").otherwise("train")).select(*df.columns, "split")


def threshold_metrics(scored: DataFrame, at: float = 0.5) -> DataFrame:
    """scored has label (0, 1) and score; rates are null where they have no denominator."""
    hit, true = F.col("score") >= at, F.col("label") == 1
    c = scored.agg(F.count_if(hit & true).alias("tp"), F.count_if(hit & ~true).alias("fp"), F.count_if(~hit & true).alias("fn"), F.count_if(~hit & ~true).alias("tn"))
    rate = lambda a, b: F.round(F.try_divide(F.expr(a), F.expr(b)), 6)
    return c.select("tp", "fp", "fn", "tn", rate("tp + tn", "tp + tn + fp + fn").alias("accuracy"), rate("tp", "tp + fn").alias("sensitivity"), rate("tn", "tn + fp").alias("specificity"), rate("tp", "tp + fp").alias("ppv"), rate("2 * tp", "2 * tp + fp + fn").alias("f1"), rate("tn", "tn + fn").alias("npv"), rate("fp", "fp + tn").alias("fpr"), rate("fn", "tp + fn").alias("fnr"), rate("fp", "tp + fp").alias("fdr"))


def ranking_metrics(scored: DataFrame, entity: str, k: int) -> DataFrame:
    """AUROC by rank sum with tied ranks averaged, recall and reciprocal rank at k; -1 without both classes."""
    w = Window.partitionBy(entity)
    ranked = (
        scored.withColumn("low", F.rank().over(w.orderBy("score"))).withColumn("tied", F.count("*").over(Window.partitionBy(entity, "score")))
        .withColumn("mean_rank", F.col("low") + (F.col("tied") - 1) / 2).withColumn("top", F.row_number().over(w.orderBy(F.desc("score"), "id")))
    )
    true = F.col("label") == 1
    agg = ranked.groupBy(entity).agg(F.count_if(true).alias("n_pos"), F.count_if(~true).alias("n_neg"), F.sum(F.when(true, F.col("mean_rank"))).alias("ranks"), F.count_if(true & (F.col("top") <= k)).alias("hits"), F.min(F.when(true & (F.col("top") <= k), F.col("top"))).alias("first"))
    both = (F.col("n_pos") > 0) & (F.col("n_neg") > 0)
    auc = (F.col("ranks") - F.col("n_pos") * (F.col("n_pos") + 1) / 2) / (F.col("n_pos") * F.col("n_neg"))
    return agg.select(entity, "n_pos", "n_neg", F.round(F.when(both, auc).otherwise(-1.0), 6).alias("auroc"), F.round(F.when(F.col("n_pos") > 0, F.col("hits") / F.col("n_pos")).otherwise(-1.0), 6).alias("recall_at_k"), F.round(F.when(F.col("n_pos") > 0, F.coalesce(1 / F.col("first"), F.lit(0.0))).otherwise(-1.0), 6).alias("mrr_at_k"))


def dot(a: str, b: str) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def knn(vectors: DataFrame, query_id: int, k: int) -> DataFrame:
    """The k vectors of highest cosine with one vector; an unknown id is an error."""
    norm = lambda c: F.sqrt(dot(c, c))
    query = vectors.where(F.col("vec_id") == query_id).limit(1).select(F.col("embedding").alias("q"))  # one row
    if query.isEmpty():
        raise KeyError(f"no vector {query_id}")
    scored = vectors.where(F.col("vec_id") != query_id).join(F.broadcast(query)).withColumn("cosine", dot("embedding", "q") / (norm("embedding") * norm("q")))
    return scored.select("vec_id", F.round("cosine", 6).alias("cosine")).orderBy(F.desc("cosine"), "vec_id").limit(k)


#: Queries whose cosines a task holds at once.
QUERIES_AT_ONCE = 64


def _top_of_block(k: int):
    """The k best partners in one block of vectors for each query of the block's query group."""

    def top(table: pa.Table) -> pa.Table:
        ids, is_query = table["vec_id"].to_numpy(), table["is_query"].to_numpy()
        lists = table["embedding"].combine_chunks()
        flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
        v = flat.reshape(len(lists), -1)  # vectors of one length, as the key of the group says
        v = v / np.maximum(np.sqrt((v * v).sum(1)), 1e-300)[:, None]
        asks, rest = np.flatnonzero(is_query), np.flatnonzero(~is_query)
        names, base = ids[rest], v[rest]
        out: list[tuple] = []
        for lo in range(0, len(asks), QUERIES_AT_ONCE):
            some = asks[lo : lo + QUERIES_AT_ONCE]
            cosines = np.round(v[some] @ base.T, 6)
            for q, cos in zip(ids[some].tolist(), cosines):
                if len(cos) > k + 1:  # all that reach the k + 1st value, so ties stay whole
                    near = np.flatnonzero(cos >= np.partition(cos, -k - 1)[-k - 1])
                else:
                    near = np.arange(len(cos))
                near = near[np.lexsort((names[near], -cos[near]))]
                near = near[names[near] != q][:k]
                out += zip([q] * len(near), names[near].tolist(), cos[near].tolist())
        return pa.table({"query_id": pa.array([r[0] for r in out], pa.int64()), "vec_id": pa.array([r[1] for r in out], pa.int64()), "cosine": pa.array([r[2] for r in out], pa.float64())})

    return top


def knn_all(vectors: DataFrame, queries: Column, k: int, block_rows: int = 100_000, group_rows: int = 10_000) -> DataFrame:
    """The k vectors of highest cosine for every query row, in blocks: each block of vectors meets each group of queries.

    A task holds one block and one group of so many rows on average, and sends k rows
    a query.  Vectors of different length do not meet.  One count of the rows says
    how many blocks there are.
    """
    rows = vectors.where("vec_id IS NOT NULL AND size(embedding) > 0").select("vec_id", "embedding", F.size("embedding").alias("dim"))
    n = rows.agg(F.count("*"), F.count_if(queries)).first()
    blocks, groups = max(1, -(-n[0] // block_rows)), max(1, -(-n[1] // group_rows))
    deal = lambda n: F.pmod(F.xxhash64("vec_id"), F.lit(n))
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))
    base = rows.select("vec_id", "embedding", "dim", F.lit(False).alias("is_query"), deal(blocks).alias("block"), every(groups).alias("group"))
    asks = rows.where(queries).select("vec_id", "embedding", "dim", F.lit(True).alias("is_query"), every(blocks).alias("block"), deal(groups).alias("group"))
    found = base.unionByName(asks).groupBy("dim", "block", "group").applyInArrow(_top_of_block(k), "query_id long, vec_id long, cosine double")
    best = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("cosine"), "vec_id"))
    return found.withColumn("rank", best).where(F.col("rank") <= k)


def mean_messages(edges: DataFrame, vectors: DataFrame) -> DataFrame:
    """Mean of source vectors for each target and dimension; edges (src, dst), vectors (id, vector)."""
    long = vectors.select(F.col("id").alias("src"), F.posexplode("vector").alias("dim", "value"))
    return edges.join(long, "src").groupBy("dst", "dim").agg(F.avg(F.col("value").cast("double")).alias("value"))


def distmult(pairs: DataFrame, head: str, tail: str, relation: str) -> DataFrame:
    """Sum of head * relation * tail for each pair, and its sigmoid."""
    part = F.zip_with(head, tail, lambda a, b: a.cast("double") * b.cast("double"))
    score = F.aggregate(F.zip_with(part, relation, lambda x, r: x * r.cast("double")), F.lit(0.0), lambda s, x: s + x)
    return pairs.withColumn("score", score).withColumn("probability", 1 / (1 + F.exp(-F.col("score"))))

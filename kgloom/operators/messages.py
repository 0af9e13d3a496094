"""Messages over typed edges: projections by relation, mean or attention over each target's incoming edges, sums over relations.

A softmax over a target's edges is a maximum, a sum and a weighted vector, and
such triples merge in any order.  Tasks merge the edges that they happen to hold,
batch by batch, then a target's triples meet in one row.  So a target of very many
edges is the work of many tasks, and none holds its edges whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bytes of weights that go into the tasks; a model of more is an error.
WEIGHT_BYTES = 64 << 20
PROJECTED = "relation string, node string, wh binary, own double, other double"
MERGED = "relation string, dst string, slot int, top double, total double, vector binary"


class Weights:
    """Linear maps by relation (matrix out x in, bias) and attention vectors (2 * out; of zeros, attention is the mean)."""

    def __init__(self, linear: dict[str, tuple[np.ndarray, np.ndarray]], attention: dict[str, np.ndarray] | None = None):
        self.linear = {r: (np.asarray(w, float), np.asarray(b, float)) for r, (w, b) in linear.items()}
        self.attention = {r: np.asarray(a, float) for r, a in (attention or {}).items()}
        if sum(w.nbytes + b.nbytes for w, b in self.linear.values()) > WEIGHT_BYTES:
            raise ValueError(f"weights of more than {WEIGHT_BYTES} bytes")

    def partner(self, relation: str) -> str | None:
        """The relation under which a target is projected: the reverse where it has one, else the relation itself."""
        turned = relation.removeprefix("rev_") if relation.startswith("rev_") else f"rev_{relation}"
        return turned if turned in self.linear else relation


def leaky(x: np.ndarray, slope: float = 0.01) -> np.ndarray:
    return np.where(x > 0, x, slope * x)


def _project(weights: Weights):
    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            relation, node = batch.column("relation").to_pylist(), batch.column("node").to_pylist()
            vectors = batch.column("vector").to_pylist()
            by: dict[str, list[int]] = {}
            for k, r in enumerate(relation):
                by.setdefault(r, []).append(k)
            for r, rows in by.items():
                w, b = weights.linear[r]
                wh = np.array([vectors[k] for k in rows], float).reshape(len(rows), -1) @ w.T + b
                n = w.shape[0]
                source = wh @ weights.attention[r][:n] if r in weights.attention else np.zeros(len(rows))
                # as a target, a node counts in the relations that it is the partner of
                used = [x for x in weights.attention if weights.partner(x) == r]
                if not used:
                    used = [None]
                for x in used:
                    yield pa.RecordBatch.from_pydict({
                        "relation": pa.array([r] * len(rows)), "node": pa.array([node[k] for k in rows]), "wh": pa.array([v.tobytes() for v in wh], pa.binary()), "own": pa.array(source),
                        "other": pa.array(wh @ weights.attention[x][n:] if x else np.zeros(len(rows))),
                    })
                    break

    return project


def _triples(relation: pa.Array, dst: pa.Array, slot: pa.Array, top: np.ndarray, total: np.ndarray, vectors: np.ndarray) -> pa.Table:
    """Merged triples by (relation, target, slot)."""
    names = pc.binary_join_element_wise(slot.cast(pa.string()), relation, dst, "\0").dictionary_encode()
    group, n = names.indices.to_numpy(), len(names.dictionary)
    if n == 0:
        return pa.table({"relation": relation, "dst": dst, "slot": slot, "top": pa.array(top), "total": pa.array(total), "vector": pa.array([], pa.binary())})
    order = np.argsort(group, kind="stable")
    starts = np.searchsorted(group[order], np.arange(n))
    most = np.maximum.reduceat(top[order], starts)
    scale = np.exp(top - most[group])
    sums = np.bincount(group, total * scale, n)
    merged = np.add.reduceat((vectors * scale[:, None])[order], starts, axis=0)
    first = pa.array(order[starts])
    return pa.table({"relation": relation.take(first), "dst": dst.take(first), "slot": slot.take(first), "top": pa.array(most), "total": pa.array(sums), "vector": _cells(merged)})


def _matrix(cells: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """A row of doubles from each cell of bytes; cells are of one length and none is null."""
    parts = []
    for a in cells.chunks if isinstance(cells, pa.ChunkedArray) else [cells]:
        if len(a):
            _, ends, data = a.buffers()
            ends = np.frombuffer(ends, np.int64 if pa.types.is_large_binary(a.type) else np.int32)[a.offset : a.offset + len(a) + 1]
            parts.append(np.frombuffer(data.slice(int(ends[0]), int(ends[-1] - ends[0])).to_pybytes()).reshape(len(a), -1))
    return np.concatenate(parts) if parts else np.zeros((0, 0))


def _cells(rows: np.ndarray) -> pa.Array:
    ends = np.arange(len(rows) + 1, dtype=np.int64) * (rows.shape[1] * 8)
    whole = pa.Array.from_buffers(pa.large_binary(), len(rows), [None, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(rows, float).tobytes())])
    return whole.cast(pa.binary())


def _flat(column: pa.Array | pa.ChunkedArray) -> pa.Array:
    return pa.concat_arrays(column.chunks) if isinstance(column, pa.ChunkedArray) and column.num_chunks else column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column


def _combine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows:
            logit = batch.column("logit").to_numpy()
            yield from _triples(batch.column("relation"), batch.column("dst"), batch.column("slot"), logit, np.ones(len(logit)), _matrix(batch.column("wh"))).to_batches()


def _merge(table: pa.Table) -> pa.Table:
    return _triples(_flat(table["relation"]), _flat(table["dst"]), _flat(table["slot"]), table["top"].to_numpy(), table["total"].to_numpy(), _matrix(table["vector"]))


def attention_logits(edges: DataFrame, features: DataFrame, weights: Weights) -> DataFrame:
    """edges (relation, src, dst) with the source's projection `wh` and the logit of attention: leaky(a . [Wh src, Wh' dst]).

    features: node, vector (array of doubles).  An end without features joins nothing.
    """
    partners = F.create_map(*[F.lit(x) for r in weights.linear for x in (r, weights.partner(r))])
    turned = F.try_element_at(partners, F.col("relation"))
    need = edges.select("relation", F.col("src").alias("node")).union(edges.select(turned.alias("relation"), F.col("dst"))).distinct()
    projected = need.join(features.select("node", "vector"), "node").select("relation", "node", "vector").mapInArrow(_project(weights), PROJECTED)
    source = projected.select("relation", F.col("node").alias("src"), "wh", "own")
    target = projected.select(F.col("relation").alias("partner"), F.col("node").alias("dst"), "other")
    met = edges.select("relation", "src", "dst", turned.alias("partner")).join(target, ["partner", "dst"]).join(source, ["relation", "src"])
    x = F.col("own") + F.col("other")
    return met.select("relation", "src", "dst", F.when(x > 0, x).otherwise(0.01 * x).alias("logit"), "wh")


def relation_messages(edges: DataFrame, features: DataFrame, weights: Weights) -> DataFrame:
    """relation, dst, vector: for each target the softmax-weighted sum of its sources' projections (their mean without attention)."""
    logits = attention_logits(edges, features, weights).withColumn("slot", F.lit(0))
    parts = logits.select("relation", "dst", "slot", "logit", "wh").mapInArrow(_combine, MERGED)  # a row at most of each target from each batch, so of a hub few are left
    tasks = int(edges.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    dealt = parts.withColumn("task", F.pmod(F.xxhash64("relation", "dst"), F.lit(tasks)))
    whole = dealt.groupBy("task").applyInArrow(lambda t: _merge(t.drop_columns(["task"])), MERGED)
    return whole.mapInArrow(_scaled, "relation string, dst string, vector array<double>")


def _scaled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        vectors = _matrix(batch.column("vector"))
        if batch.num_rows:
            yield pa.RecordBatch.from_pydict({"relation": batch.column("relation"), "dst": batch.column("dst"), "vector": pa.array(list(vectors / batch.column("total").to_numpy()[:, None]), pa.list_(pa.float64()))})


def layer(edges: DataFrame, features: DataFrame, weights: Weights, activate: bool = False) -> DataFrame:
    """node, vector: each target's messages summed over its relations, through a leaky ramp if asked; a node without incoming edges has none."""
    each = relation_messages(edges, features, weights)
    add = lambda items: F.aggregate(F.slice(items, 2, F.size(items)), items[0], lambda a, b: F.zip_with(a, b, lambda x, y: x + y))
    summed = each.groupBy(F.col("dst").alias("node")).agg(F.sort_array(F.collect_list(F.struct("relation", "vector"))).alias("m"))  # a vector a relation
    vector = add(F.transform("m", lambda x: x["vector"]))
    return summed.select("node", (F.transform(vector, lambda x: F.when(x > 0, x).otherwise(0.01 * x)) if activate else vector).alias("vector"))


def prototypes(similar: DataFrame, embeddings: DataFrame, k: int, skip_self: bool = True) -> DataFrame:
    """entity, prototype: the k most similar others' embeddings (ties: smallest id), weighted by similarities that are scaled to absolute sum 1.

    similar: entity, other, similarity; embeddings: id, vector.
    """
    from pyspark.sql.window import Window

    pairs = similar.where("entity <> other") if skip_self else similar
    best = pairs.withColumn("place", F.row_number().over(Window.partitionBy("entity").orderBy(F.desc("similarity"), "other"))).where(F.col("place") <= k)
    met = best.join(embeddings.select(F.col("id").alias("other"), "vector"), "other")
    rows = met.groupBy("entity").agg(F.sort_array(F.collect_list(F.struct("place", "similarity", "vector"))).alias("rows"))  # k at most
    total = F.aggregate("rows", F.lit(0.0), lambda a, r: a + F.abs(r["similarity"]))
    scaled = F.transform("rows", lambda r: F.transform(r["vector"], lambda v: v.cast("double") * r["similarity"] / F.greatest(total, F.lit(1e-12))))
    summed = F.aggregate(F.slice(scaled, 2, F.size(scaled)), scaled[0], lambda a, b: F.zip_with(a, b, lambda x, y: x + y))
    return rows.select("entity", summed.alias("prototype"))


def blended_prototypes(similar: DataFrame, embeddings: DataFrame, degrees: DataFrame, k: int, measure: str = "rarity", rate: float = 0.7, skip_self: bool = True) -> DataFrame:
    """id, vector: embeddings mixed with their prototypes; the prototype's share is high for low degrees (`rarity`), 0.5 (`avg`), 0.2 (`heuristics-0.8`) or 1 (`100proto`).

    degrees: id, degree.  An id without a prototype keeps its embedding.
    """
    from .evaluation import blended, rarity

    shares = {"rarity": rarity(F.coalesce("degree", F.lit(0)), rate), "avg": F.lit(0.5), "heuristics-0.8": F.lit(0.2), "100proto": F.lit(1.0)}
    if measure not in shares:
        raise ValueError(f"unknown measure {measure!r}")
    proto = prototypes(similar, embeddings, k, skip_self).withColumnRenamed("entity", "id")
    joined = embeddings.select("id", "vector").join(proto, "id", "left").join(degrees.select("id", "degree"), "id", "left")
    own = F.transform("vector", lambda v: v.cast("double"))
    return joined.select("id", F.when(F.col("prototype").isNull(), own).otherwise(blended(own, F.col("prototype"), shares[measure])).alias("vector"))

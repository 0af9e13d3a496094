"""Source divergence audit: how far the term counts of sources lie apart.

Terms are counted by (lang, source) inside Arrow batches, then across the corpus.
The matrix of groups by kept terms is cut into blocks of terms; a task holds the
K-squared quadtree of one block.  Pairs of groups descend the tree together:
columns where neither has a count are priced by one product, the others leaf by
leaf.  Sums of blocks add up to sums over all terms.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .arrays import text_bytes
from .buckets import cut
from .pretokens import slices
from .quadtree import Tree

LEAST_DOCS, TOP, SCALE, PRIOR = 10, 10, 1_000_000_000, 2
#: Terms of a block, first groups of the pairs of a task, and cells of a descent at a time.
BLOCK_TERMS, CHUNK_GROUPS, CELLS = 2048, 256, 1 << 20
#: Bytes of texts whose terms are counted at a time; a longer text is counted alone.
SLICE_BYTES = 16 << 20
COUNTED = "lang string, source string, term string, n long, docs long"
PRICED = "kind int, source string, item string, value long"

_LETTER = np.arange(256, dtype=np.uint8)
_LETTER[65:91] += 32
_LETTER[:65] = _LETTER[91:97] = _LETTER[123:128] = 32


def _codes(a: np.ndarray, b: np.ndarray, width: int, weights: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Sums of the weights by distinct (a, b); b < width."""
    key = a.astype(np.int64) * width + b
    order = np.argsort(key, kind="stable")
    key = key[order]
    at = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1]))) if len(key) else np.zeros(0, np.int64)
    return key[at] // width, key[at] % width, [np.add.reduceat(w[order], at) if len(at) else w[:0] for w in weights]


def _counted(batches):
    """Counts and documents of each (lang, source, term) of some MB of texts at a time."""
    for batch in batches:
        data, offsets = text_bytes(batch.column("text"))
        for a, b in slices(offsets, SLICE_BYTES):
            yield _counted_texts(batch.slice(a, b - a), _LETTER[data[offsets[a] : offsets[b]]], offsets[a : b + 1] - offsets[a])


def _counted_texts(rows: pa.RecordBatch, data: np.ndarray, offsets: np.ndarray) -> pa.RecordBatch:
    plain = pa.LargeStringArray.from_buffers(rows.num_rows, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(data.tobytes()))
    lists = pc.split_pattern(plain, " ")
    terms, doc = pc.list_flatten(lists), pc.list_parent_indices(lists).to_numpy()
    some = pc.greater(pc.binary_length(terms), 0)
    terms, doc = terms.filter(some).dictionary_encode(), doc[some.to_numpy(zero_copy_only=False)]
    words, code = terms.dictionary, terms.indices.to_numpy()
    doc, code, (n,) = _codes(doc, code, max(1, len(words)), [np.ones(len(code), np.int64)])
    lang, source = rows.column("lang").dictionary_encode(), rows.column("source").dictionary_encode()
    wide = max(1, len(source.dictionary))
    group = lang.indices.to_numpy().astype(np.int64) * wide + source.indices.to_numpy()
    group, code, (n, docs) = _codes(group[doc], code, max(1, len(words)), [n, np.ones(len(doc), np.int64)])
    return pa.RecordBatch.from_pydict({"lang": lang.dictionary.take(pa.array(group // wide)), "source": source.dictionary.take(pa.array(group % wide)), "term": words.take(pa.array(code)).cast(pa.string()), "n": pa.array(n, pa.int64()), "docs": pa.array(docs, pa.int64())})


def share(n, total):
    """1 + floor(SCALE * n / total) for n <= total, three digits at a time: exact in 64 bits up to a total of 9 * 10^15."""
    whole = 0
    for _ in range(3):
        n = n * 1000
        whole, n = whole * 1000 + n // total, n % total
    return 1 + whole


def apart(p, q):
    return (p - q) * (p - q) // (p + q)


def _priced(top: int):
    def price(block: pa.Table, groups: pa.Table) -> pa.Table:
        """Of one block of terms: `kind` 0, the sum of each pair of groups (by place, first < second); 1, the first terms of each group."""
        out: dict[str, list] = {"kind": [], "source": [], "item": [], "value": []}
        order = np.argsort(groups["place"].to_numpy())
        groups = groups.take(pa.array(order))
        total, v, whole = (groups[k].to_numpy() for k in ("total", "kept", "whole"))
        base = total + PRIOR * v
        terms = block["term"].combine_chunks().dictionary_encode() if block.num_rows else pa.array([], pa.string()).dictionary_encode()
        terms = terms.combine_chunks() if isinstance(terms, pa.ChunkedArray) else terms
        width = len(terms.dictionary)
        row, column, n, every = block["place"].to_numpy(), terms.indices.to_numpy().astype(np.int64), block["n"].to_numpy(), block["every"].to_numpy()
        tree = Tree(row, column, n, max(width, len(order), 1))
        nothing = share(np.full(len(order), PRIOR, np.int64), np.maximum(base, 1)) if v[0] else np.ones(len(order), np.int64)
        first = np.flatnonzero(groups["chunk"].to_numpy())
        pairs = np.array([(x, y) for x in first for y in range(x + 1, len(order))], np.int64).reshape(-1, 2)
        sums = np.zeros(len(pairs), np.int64)
        step = max(1, CELLS // max(width, 1))
        for lo in range(0, len(pairs), step):
            a, b = pairs[lo : lo + step].T
            pair, _, left, right = tree.joint(a, b)
            met = np.bincount(pair, minlength=len(a))
            worth = apart(share(left + PRIOR, base[a][pair]), share(right + PRIOR, base[b][pair]))
            added = np.zeros(len(a), np.int64)
            np.add.at(added, pair, worth)
            sums[lo : lo + step] = added + (width - met) * apart(nothing[a], nothing[b])
        source = groups["source"].to_pylist()
        out["kind"] += [0] * len(pairs)
        out["source"] += [source[x] for x in pairs[:, 0]]
        out["item"] += [source[y] for y in pairs[:, 1]]
        out["value"] += sums.tolist()
        mine = np.flatnonzero(groups["chunk"].to_numpy()[row]) if block.num_rows else np.zeros(0, np.int64)
        if len(mine):
            row, column, n, every = row[mine], column[mine], n[mine], every[mine]
            p, q = share(n + PRIOR, base[row]), share(every + PRIOR, (whole + PRIOR * v)[row])
            over = np.flatnonzero(p > q)
            name = np.array([t.encode() for t in terms.dictionary.to_pylist()], object)
            rank = np.empty(width, np.int64)
            rank[np.argsort(name, kind="stable")] = np.arange(width)
            value = apart(p, q)
            order = over[np.lexsort((rank[column[over]], -value[over], row[over]))]
            at = np.concatenate(([0], np.flatnonzero(np.diff(row[order])) + 1)) if len(order) else np.zeros(0, np.int64)
            place = np.arange(len(order)) - np.repeat(at, np.diff(np.append(at, len(order))))
            for k in order[place < top]:
                out["kind"].append(1)
                out["source"].append(source[row[k]])
                out["item"].append(name[column[k]].decode())
                out["value"].append(int(value[k]))
        lang = groups["lang"][0].as_py()
        return pa.table({"lang": pa.array([lang] * len(out["kind"]), pa.string()), "kind": pa.array(out["kind"], pa.int32()), "source": pa.array(out["source"], pa.string()), "item": pa.array(out["item"], pa.string()), "value": pa.array(out["value"], pa.int64())})

    return price


def kept_terms(docs: DataFrame, least_docs: int = LEAST_DOCS) -> DataFrame:
    """lang, source, term, n (occurrences), every (in the lang) of the terms in at least so many documents of the lang."""
    counted = docs.mapInArrow(_counted, COUNTED)
    by_term = counted.repartition("lang", "term").groupBy("lang", "term", "source").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    over = Window.partitionBy("lang", "term")
    held = by_term.select("lang", "source", "term", "n", F.sum("n").over(over).alias("every"), F.sum("docs").over(over).alias("docs"))
    return held.where(F.col("docs") >= least_docs).drop("docs")


def divergence(docs: DataFrame, least_docs: int = LEAST_DOCS, top: int = TOP, text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """lang, source, part, item, value, rank: for each group, all other sources of its lang (`pair`) and its first terms (`term`).

    A null text, lang or source counts as ''.  Every row is a document, repeated
    ones too.  A group without terms has pairs, and no terms.  A lang without kept
    terms has pairs of value 0; one with a single source has none.  Ties rank by
    the bytes of the item.  An empty table gives no rows; other columns are ignored.
    """
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    rows = docs.select(text(lang_col).alias("lang"), text(source_col).alias("source"), text(text_col).alias("text"))
    kept = cut(kept_terms(rows, least_docs))
    langs = kept.groupBy("lang", "term").agg(F.first("every").alias("every")).groupBy("lang").agg(F.count("*").alias("kept"), F.sum("every").alias("whole"))
    totals = kept.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = rows.groupBy("lang", "source").agg(F.count("*").alias("rows")).join(totals, ["lang", "source"], "left").join(langs, "lang", "left")
    groups = groups.select("lang", "source", *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("total", "kept", "whole")])
    by_lang = Window.partitionBy("lang")
    groups = groups.withColumn("place", (F.row_number().over(by_lang.orderBy("source")) - 1).cast("long")).withColumn("chunks", F.ceil(F.count("*").over(by_lang) / CHUNK_GROUPS).cast("long"))
    groups = cut(groups.withColumn("blocks", F.greatest(F.lit(1), F.ceil(F.col("kept") / BLOCK_TERMS)).cast("long")))
    upto = lambda c: F.explode(F.sequence(F.lit(0).cast("long"), F.col(c) - 1))
    offered = groups.withColumn("block", upto("blocks")).withColumn("slice", upto("chunks")).withColumn("chunk", F.floor(F.col("place") / CHUNK_GROUPS) == F.col("slice"))
    cells = kept.join(groups.select("lang", "source", "place", "blocks", "chunks"), ["lang", "source"])
    cells = cells.withColumn("block", F.pmod(F.xxhash64("term"), F.col("blocks"))).withColumn("slice", upto("chunks")).select("lang", "block", "slice", "place", "term", "n", "every")
    offered = offered.select(*[F.col(c).alias(c) for c in ("lang", "block", "slice", "place", "chunk", "source", "total", "kept", "whole")])  # columns of its own, for the cogroup
    key = ["lang", "block", "slice"]
    priced = cut(cells.groupBy(key).cogroup(offered.groupBy(key)).applyInArrow(_priced(top), f"lang string, {PRICED}"))
    pairs = priced.where("kind = 0").groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
    pairs = pairs.unionByName(pairs.select("lang", F.col("item").alias("source"), F.col("source").alias("item"), "value"))
    return _ranked(pairs, "pair").unionByName(_ranked(priced.where("kind = 1"), "term").where(F.col("rank") <= top))


def _ranked(rows: DataFrame, part: str) -> DataFrame:
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return rows.select("lang", "source", F.lit(part).alias("part"), "item", "value", F.row_number().over(order).alias("rank"))

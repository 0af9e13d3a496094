"""N-gram Jaccard join: prefix filters under several global token orders, intersected.

A document is its set of word shingles.  Two sets as similar as asked share a
token among the first few of either, under any order of all tokens.  Four orders
are used: rarest first by one hash, rarest first by another, and two random orders
that look at no frequency; a candidate pair must share a prefix token under each.

Equal sets are one class.  Classes that share a prefix token under the first
order are joined to that token's smallest class, and the components of these
stars bound where candidates can be: each class's set is sent to its component's
tasks alone (a large component is cut into blocks, and pairs of blocks are tasks).
There the prefix filters run, candidates are verified, and a pair already
connected is not looked at again, so copies of one text cost one comparison each.
"""

from __future__ import annotations

from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .arrays import Words, mix, prefix, runs, span_hash, steady_memory, text_bytes
from .buckets import ANSWER, Layout, answer_rows, bucketed, cut, flagged_set, ordered, place, set_rows, split_hash
from .components import components

U64 = np.uint64
#: Sets, and tokens of sets, that a block of a large component holds.
BLOCK, BLOCK_TOKENS = 1500, 400_000
LEVELS = 12
#: Bytes of text whose tokens meet in a task.
PART_BYTES = 8 << 20
TOKEN, SET = 0, 1
SENT = "kind int, part long, bucket long, payload binary"
SHOWN = "kind int, doc_id long, node long, n_shingles long, class long, part long, payload binary"
#: Nodes of the further rows that repeat an id are counted from here; ids are smaller.
AGAIN = 1 << 62
LINK = "a long, b long"
#: A token's key within its partition, and how common it is.
GRADED = np.dtype([("key", np.uint32), ("level", np.uint8)])


def shingles(table: pa.Table, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (document, shingle hash), sorted by document; a short text is one shingle."""
    words = Words(*text_bytes(table["text"]), lower=True)
    at, h = words.windows(size)
    doc = words.doc[at] if len(at) else np.zeros(0, np.int64)
    short = np.flatnonzero((words.n > 0) & (words.n < size))
    whole = span_hash(prefix(words.hash, 1), words.first[short], words.first[short] + words.n[short], 1)
    doc, h = np.concatenate((doc, short)), np.concatenate((h, mix(whole ^ words.n[short].astype(U64), 3)))
    order = np.lexsort((h, doc))
    doc, h = doc[order], h[order]
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (h[1:] != h[:-1])
    return doc[new], h[new]


def _nodes(table: pa.Table) -> np.ndarray:
    """A node for each row of a bucket: its id, or, where an earlier row has that id, a number of its own.

    All rows of an id lie in one bucket, in one order, so a row's node is the same each time.
    """
    ids = table["doc_id"].to_numpy().astype(np.int64)
    if len(ids) and ids.max() >= AGAIN:
        raise ValueError(f"ids of {AGAIN} and more are not supported")
    again = np.zeros(len(ids), bool)
    again[1:] = ids[1:] == ids[:-1]
    return np.where(again, AGAIN + (table["bucket"][0].as_py() << 31) + np.arange(len(ids)), ids)


def _signature(doc: np.ndarray, h: np.ndarray, n_docs: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Set size and two sums over the set that differ for different sets."""
    n = np.bincount(doc, minlength=n_docs)
    start = np.cumsum(n) - n
    sums = []
    for seed in (21, 22):
        total = np.concatenate((np.zeros(1, U64), np.cumsum(mix(h, seed))))
        sums.append(mix(total[start + n] - total[start] + n.astype(U64), seed))
    return n, sums[0], sums[1]


def _sent(size: int, parts: int):
    def send(table: pa.Table) -> pa.Table:
        steady_memory()
        table = ordered(table)
        bucket, ids = table["bucket"][0].as_py(), _nodes(table)
        doc, h = shingles(table, size)
        tokens = flagged_set(bucket, h, np.zeros(len(h), bool), parts)
        n, one, two = _signature(doc, h, table.num_rows)
        some = np.flatnonzero(n > 0)
        part = (one[some] % U64(parts)).astype(np.int64)
        order = np.argsort(part, kind="stable")
        cells = np.stack((one[some], two[some], ids[some].view(U64)), axis=1)[order]
        sets = set_rows(bucket, part[order], cells)
        both = [t.add_column(0, "kind", pa.array(np.full(t.num_rows, k, np.int32), pa.int32())) for k, t in ((TOKEN, tokens), (SET, sets))]
        return pa.concat_tables(both)

    return send


def _answered(table: pa.Table) -> pa.Table:
    """For each bucket one row: its tokens held by two documents or more, and how common each is; or
    the class of each set that is not its own."""
    steady_memory()
    kind, part = table["kind"][0].as_py(), table["part"][0].as_py()
    buckets = np.array(table["bucket"].to_pylist(), np.int64)
    order = np.argsort(buckets, kind="stable")
    buckets, cells = buckets[order], table["payload"].to_pylist()
    if kind == TOKEN:
        values = [np.frombuffer(cells[k], np.uint32) for k in order]
        owner = np.repeat(np.arange(len(order), dtype=U64), [len(v) for v in values])
        packed = np.sort((np.concatenate(values).astype(U64) << U64(32)) | owner)
        key = packed >> U64(34)
        at = runs(key)
        held = np.diff(np.append(at, len(packed)))
        multi = (np.bitwise_or.reduceat(packed >> U64(33), at) & U64(1)) > 0
        level = np.where((held > 1) | multi, np.minimum(np.frexp(held.astype(float))[1], LEVELS), 0)
        some = np.repeat(level > 0, held)
        cell = np.zeros(int(some.sum()), GRADED)
        cell["key"], cell["level"] = key[some], np.repeat(level, held)[some]
        who = (packed[some] & U64(0xFFFFFFFF)).astype(np.int64)
        by = np.argsort(who, kind="stable")
        return answer_rows(part, TOKEN + 1, buckets[who[by]], cell[by])
    values = [np.frombuffer(cells[k], U64).reshape(-1, 3) for k in order]
    owner = np.repeat(buckets, [len(v) for v in values])
    v = np.concatenate(values)
    by = np.lexsort((v[:, 2].view(np.int64), v[:, 1], v[:, 0]))
    v, owner = v[by], owner[by]
    new = np.ones(len(v), bool)
    new[1:] = (v[1:, :2] != v[:-1, :2]).any(1)
    first = np.flatnonzero(new)[np.cumsum(new) - 1]
    other = v[first, 2] != v[:, 2]
    by = np.argsort(owner[other], kind="stable")
    return answer_rows(part, 0, owner[other][by], np.stack((v[other, 2], v[first, 2][other]), axis=1)[by])


def need(size: np.ndarray, num: int, den: int) -> np.ndarray:
    """Least overlap of a set of this size with any set that is similar enough."""
    return -(-num * size // den)


def _shown(size: int, parts: int, num: int, den: int):
    """A row for each document; of each class that can have a partner, its set and its prefix tokens."""

    def show(table: pa.Table, answers: pa.Table) -> pa.Table:
        steady_memory()
        table = ordered(table)
        ids, doc_id = _nodes(table), table["doc_id"].to_pylist()
        doc, h = shingles(table, size)
        n = np.bincount(doc, minlength=table.num_rows)
        level = np.zeros(len(h), np.int64)
        rep = dict()
        if answers.num_rows:
            kinds, from_part, cells = answers["kind"].to_pylist(), answers["part"].to_pylist(), answers["payload"].to_pylist()
            graded = [(p, np.frombuffer(c, GRADED)) for k, p, c in zip(kinds, from_part, cells) if k]
            if graded:
                keys = np.concatenate([g["key"].astype(U64) | (U64(p) << U64(32)) for p, g in graded])
                grade = np.concatenate([g["level"] for _, g in graded])
                order = np.argsort(keys)
                keys, grade = keys[order], grade[order]
                spot = np.minimum(np.searchsorted(keys, p := place(h, parts)), len(keys) - 1)
                level = np.where(keys[spot] == p, grade[spot], 0)
            for k, c in zip(kinds, cells):
                if not k:
                    rep |= dict(np.frombuffer(c, np.int64).reshape(-1, 2).tolist())
        own = np.array([rep.get(i, i) for i in ids.tolist()], np.int64)
        shared = np.bincount(doc, level > 0, table.num_rows)
        can = (n > 0) & (own == ids) & (shared >= need(n, num, den))
        rows: dict[str, list] = {k: [] for k in ("kind", "doc_id", "node", "n_shingles", "class", "part", "payload")}
        for i in range(table.num_rows):
            for k, x in zip(rows, (0, doc_id[i], int(ids[i]), int(n[i]), int(own[i]) if n[i] else int(ids[i]), 0, None)):
                rows[k].append(x)
        order = np.lexsort((h, level, doc))
        h, level, start = h[order], level[order], np.cumsum(n) - n
        tokens, holders = [np.zeros(0, U64)], [np.zeros(0, np.int64)]
        for i in np.flatnonzero(can):
            mine, grades = h[start[i] : start[i] + n[i]], level[start[i] : start[i] + n[i]]
            counts = np.bincount(grades, minlength=LEVELS + 1).astype(np.uint32)
            for k, x in zip(rows, (2, None, int(ids[i]), int(n[i]), int(own[i]), 0, counts.tobytes() + mine.tobytes())):
                rows[k].append(x)
            lead = slice(counts[0], n[i] - need(n[i], num, den) + 1)  # tokens of one document only join nothing
            tokens.append(mine[lead])
            holders.append(np.full(len(tokens[-1]), ids[i]))
        tokens, holders = np.concatenate(tokens), np.concatenate(holders)
        part = split_hash(tokens, parts)[0].astype(np.int64)
        order = np.argsort(part, kind="stable")
        cells = np.stack((tokens, holders.view(U64)), axis=1)[order]
        for r in set_rows(0, part[order], cells).to_pylist():
            for k, x in zip(rows, (1, None, None, None, None, r["part"], r["payload"])):
                rows[k].append(x)
        types = (pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
        return pa.table({k: pa.array(v, t) for (k, v), t in zip(rows.items(), types)})

    return show


def _stars(table: pa.Table) -> pa.Table:
    """Each class of a token with the token's smallest class."""
    v = np.concatenate([np.frombuffer(c, U64).reshape(-1, 2) for c in table["payload"].to_pylist()])
    order = np.lexsort((v[:, 1].view(np.int64), v[:, 0]))
    token, holder = v[order, 0], v[order, 1].view(np.int64)
    at = runs(token)
    low = np.repeat(holder[at], np.diff(np.append(at, len(token))))
    pairs = np.unique(np.stack((holder, low), axis=1)[holder != low], axis=0)
    return pa.table({"a": pa.array(pairs[:, 0], pa.int64()), "b": pa.array(pairs[:, 1], pa.int64())})


class _Set:
    def __init__(self, payload: bytes, size: int, num: int, den: int):
        counts = np.frombuffer(payload, np.uint32, LEVELS + 1)
        tokens = np.frombuffer(payload, U64, size, 4 * (LEVELS + 1))
        level = np.repeat(np.arange(LEVELS + 1), counts)
        lead = size - int(need(size, num, den)) + 1
        self.size, self.tokens = size, np.sort(tokens)
        self.first = tokens[counts[0] : lead].tolist()  # tokens of one document only join nothing
        others = [np.lexsort((mix(tokens, 8), level)), *(np.argsort(mix(tokens, seed), kind="stable") for seed in (9, 10))]
        self.others = [frozenset(tokens[o[:lead]][level[o[:lead]] > 0].tolist()) for o in others]

    def candidate(self, other: "_Set") -> bool:
        """A common prefix token under each of the other orders."""
        return not any(a.isdisjoint(b) for a, b in zip(self.others, other.others))


def join_sets(sets: list[tuple[int, int, _Set]], num: int, den: int, across: bool) -> list[tuple[int, int]]:
    """Links that span the similar pairs among (id, block, set); only pairs across blocks if asked."""
    parent = list(range(len(sets)))

    def find(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    index: dict[int, dict[int, list[int]]] = defaultdict(dict)  # token: group: sets
    links = []
    for x, (name, block, s) in enumerate(sets):
        tried = set()
        for token in s.first:
            groups = index[token]
            for root in list(groups):
                now = find(root)
                if now == find(x):
                    continue
                if now != root:  # the group has grown since
                    groups.setdefault(now, []).extend(groups.pop(root))
                for y in reversed(groups[now]):
                    other = sets[y][2]
                    if y in tried or across and sets[y][1] == block or num * max(s.size, other.size) > den * min(s.size, other.size):
                        continue
                    tried.add(y)
                    if not s.candidate(other):
                        continue
                    common = len(np.intersect1d(s.tokens, other.tokens, assume_unique=True))
                    if den * common >= num * (s.size + other.size - common):
                        links.append((name, sets[y][0]))
                        parent[find(x)] = find(y)
                        break
        for token in s.first:
            index[token].setdefault(find(x), []).append(x)
    return links


def _verified(num: int, den: int):
    def verify(table: pa.Table) -> pa.Table:
        cells: dict[tuple, list] = defaultdict(list)
        for g, i, j, b, d, n, p in zip(*(table[k].to_pylist() for k in ("group", "i", "j", "block", "doc_id", "n_shingles", "payload"))):
            cells[g, i, j].append((d, b, n, p))
        links = []
        for (_, i, j), rows in cells.items():
            if len(rows) > 1:
                sets = [(d, b, _Set(p, n, num, den)) for d, b, n, p in sorted(rows)]
                links += join_sets(sets, num, den, i != j)
        return pa.table({"a": pa.array([x for x, _ in links], pa.int64()), "b": pa.array([y for _, y in links], pa.int64())})

    return verify


def jaccard_components(docs: DataFrame, size: int = 5, num: int = 75, den: int = 100, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles and component_id (smallest id reachable by links).

    Documents link when den * |intersection| >= num * |union| of their sets of
    `size`-word shingles (words lower-cased in A-Z).  With fewer words the whole
    sequence is the one shingle.  A null text, or one without words, has an empty
    set and links with nothing: its component is its own id.  Rows that repeat an
    id are separate sets of one document: what either links with is one component
    with it.  Ids are under 2^62.  A null id is not linked.  An empty table gives no
    rows; other columns are ignored.
    """
    spark = docs.sparkSession
    layout = Layout(docs, text_col, part_bytes=PART_BYTES)
    parts = layout.parts
    named = docs.where(F.col(id_col).isNotNull())
    texts = bucketed(named, layout, id_col, text_col)
    sets = texts.groupBy("bucket").applyInArrow(_sent(size, parts), SENT)
    answers = sets.groupBy("kind", "part").applyInArrow(_answered, ANSWER)
    shown = cut(texts.groupBy("bucket").cogroup(answers.groupBy("bucket")).applyInArrow(_shown(size, parts, num, den), SHOWN))
    stars = shown.where("kind = 1").select("part", "payload").groupBy("part").applyInArrow(_stars, LINK)
    groups = cut(components(stars).select("node", F.col("component").alias("group")))
    held = shown.where("kind = 2").select("node", "n_shingles").join(groups, "node")
    sizes = held.groupBy("group").agg(F.greatest(F.ceil(F.count("*") / BLOCK), F.ceil(F.sum("n_shingles") / BLOCK_TOKENS)).cast("int").alias("blocks"))
    members = shown.where("kind = 2").select("node", "n_shingles", "payload").join(groups, "node").join(sizes, "group")
    members = members.withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    members = members.select("group", F.col("node").alias("doc_id"), "n_shingles", "payload", "block", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"))
    tasks = max(parts, int(spark.conf.get("spark.sql.shuffle.partitions")))
    links = members.withColumn("part", F.pmod(F.xxhash64("group", "i", "j"), F.lit(tasks))).groupBy("part").applyInArrow(_verified(num, den), LINK)
    rows = shown.where("kind = 0").select("doc_id", "node", "n_shingles", "class")
    same = rows.where("class <> node OR doc_id <> node").select(F.col("node").alias("a"), F.explode(F.array("class", "doc_id")).alias("b"))
    found = components(links.union(same))
    out = rows.join(found, "node", "left").select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"))
    empty = docs.where(F.col(id_col).isNull())
    nameless = bucketed(empty, layout, id_col, text_col).groupBy("bucket").applyInArrow(_counted(size), "doc_id long, n_shingles long, component_id long")
    return out.union(nameless)


def _counted(size: int):
    def count(table: pa.Table) -> pa.Table:
        steady_memory()
        table = ordered(table)
        doc, _ = shingles(table, size)
        return pa.table({"doc_id": table["doc_id"], "n_shingles": pa.array(np.bincount(doc, minlength=table.num_rows), pa.int64()), "component_id": table["doc_id"]})

    return count

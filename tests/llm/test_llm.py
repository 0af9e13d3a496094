"""Each operator against brute force, a round trip or held-out accuracy, with the odd cases."""

import hashlib
import math
import random
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import pytest
import tiktoken
from pyspark.sql import functions as F

from kgloom.llm import html_extract, labelled_pages, mixing, pretokens, suffix_dedup, toxicity
from kgloom.llm import queries as llm_queries
from kgloom.llm.bcr import repeated_starts
from kgloom.llm.buckets import repeated_answer
from kgloom.llm.bpe import Codec, encode_texts, read_ranks
from kgloom.llm.components import components
from kgloom.llm.decontaminate import alignment, contaminated
from kgloom.llm.embedding_dedup import link_embeddings
from kgloom.llm.html_blocks import blocks
from kgloom.llm.jaccard import jaccard_components
from kgloom.llm.lm_score import score_texts
from kgloom.llm.pfor import pack, unpack
from kgloom.llm.substring import dedup_substrings
from kgloom.llm.suffix_dedup import dedup_suffixes
from kgloom.llm.token_files import read_token_files, store_path, write_token_files

DOC = "doc_id long, text string, bucket string, payload int"
RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def words(rnd, n):
    return " ".join(rnd.choice(("ba", "Bo", "dé", "du", "ka", "ki", "mo", "字", "x'll")) + str(rnd.randrange(60)) for _ in range(n))


@pytest.fixture(scope="module")
def rows():
    rnd = random.Random(1)
    shared, out = words(rnd, 90), []
    for i in range(30):
        text = words(rnd, rnd.randrange(120))
        if i % 3 == 0:
            text = f"{text}\n{shared} {words(rnd, 3)}"
        out.append((i, text))
    out += [(30, out[3][1]), (31, out[3][1].replace("ba", "ko", 1)), (32, None), (33, ""), (34, " \t\n"), (35, "one two"), (36, "one two"), (37, "ab" * 700), (38, words(rnd, 4000)), (None, out[6][1]), (3, out[3][1])]
    return out


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame([(i, t, "clash", 7) for i, t in rows], DOC).repartition(3).cache()


def by_id(rows):
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))


def test_substring_dedup(docs, rows):
    seen, want = set(), []
    for i, text in by_id(rows):
        own = (text or "").encode().split()
        gone = [False] * len(own)
        for s in range(len(own) - 19):
            key = tuple(own[s : s + 20])
            if key in seen:
                gone[s : s + 20] = [True] * 20
            seen.add(key)
        rest = b" ".join(w for w, g in zip(own, gone) if not g)
        want.append((i, len(own), sum(gone), hashlib.sha256(rest).hexdigest(), rest.decode()))
    got = [tuple(r) for r in dedup_substrings(docs).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_suffix_dedup(docs, rows):
    raw = [(i, (t or "").encode()) for i, t in rows]
    seen = Counter(b[a : a + 400] for _, b in raw for a in range(len(b) - 399))
    want = []
    for i, b in raw:
        gone = np.zeros(len(b), bool)
        for a in range(len(b) - 399):
            if seen[b[a : a + 400]] > 1:
                gone[a : a + 400] = True
        rest = bytes(np.frombuffer(b, np.uint8)[~gone])
        spans = int((gone & ~np.append(False, gone[:-1])[: len(gone)]).sum())
        want.append((i, len(b), int(gone.sum()), spans, hashlib.sha256(rest).hexdigest(), rest.decode(errors="ignore")))
    assert sorted(map(tuple, dedup_suffixes(docs).collect()), key=str) == sorted(want, key=str)


def test_suffix_dedup_crowded_anchor(spark, docs, monkeypatch):
    rnd = random.Random(9)
    line = words(rnd, 45)[:300]
    copied = f"{words(rnd, 20)} {line} {words(rnd, 20)}"
    texts = [f"{words(rnd, 40)} {copied if i % 40 == 0 else line} {words(rnd, 40)}" for i in range(300)]
    raw = [t.encode() for t in texts]
    seen = Counter(b[a : a + 400] for b in raw for a in range(len(b) - 399))
    want = {}
    for i, b in enumerate(raw):
        gone = np.zeros(len(b), bool)
        for a in range(len(b) - 399):
            if seen[b[a : a + 400]] > 1:
                gone[a : a + 400] = True
        want[i] = int(gone.sum())
    many = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    groups = []
    inner = suffix_dedup._repeated_windows
    monkeypatch.setattr(suffix_dedup, "_repeated_windows", lambda t, s, n: groups.append(len(t)) or inner(t, s, n))
    assert {r.doc_id: r.n_removed for r in dedup_suffixes(many, many=(8, 20)).collect()} == want and sum(want.values()) > 0
    # the runs of the common line no longer meet in one group
    tables = [pa.table({"bucket": [b], "rows": [suffix_dedup_rows(texts[b::4], b)]}) for b in range(4)]
    sets = pa.concat_tables([suffix_dedup._anchor_sets(400, 64, 1, 8)(t) for t in tables])
    answers = repeated_answer(sets, False, 20)
    cut = [suffix_dedup._repeated_runs(400, 64, 1)(t, answers.filter(pc.equal(answers["bucket"], b))) for b, t in enumerate(tables)]
    suffix_dedup._repeated_spans(400, 10)(pa.concat_tables(cut))
    assert max(groups, default=0) < 40
    # every anchor crowded: all goes by windows, with the same result
    same = lambda d: sorted(map(tuple, d.collect()), key=str)
    assert same(dedup_suffixes(docs, many=(1, 0))) == same(dedup_suffixes(docs))


def suffix_dedup_rows(texts, first):
    rows = pa.table({"doc_id": pa.array([first + 4 * i for i in range(len(texts))], pa.int64()), "text": pa.array(texts)})
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, rows.schema) as out:
        out.write_table(rows)
    return sink.getvalue().to_pybytes()


def test_column_wise_construction():
    rnd = random.Random(2)
    for trial in range(40):
        strings = ["".join(rnd.choice("ab" if trial % 2 else "abcd") for _ in range(rnd.randint(1, 30))).encode() for _ in range(rnd.randint(1, 8))]
        k = rnd.randint(1, 7)
        seen = Counter(s[a : a + k] for s in strings for a in range(len(s) - k + 1))
        want = [[a for a in range(len(s) - k + 1) if seen[s[a : a + k]] > 1] for s in strings]
        assert [x.tolist() for x in repeated_starts([np.frombuffer(s, np.uint8).astype(np.uint16) for s in strings], k)] == want


def test_bpe(docs, rows):
    known = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=read_ranks(RANKS), special_tokens={})
    want = []
    for i, t in rows:
        ids = known.encode_ordinary(t or "")
        raw = np.array(ids, "<u4").tobytes()
        want.append((i, len(ids), hashlib.sha256(raw).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest(), raw))
    assert sorted(((*r[:4], bytes(r[4])) for r in encode_texts(docs, RANKS).collect()), key=str) == sorted(want, key=str)


def test_bpe_long_words():
    rnd = random.Random(7)
    known = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=read_ranks(RANKS), special_tokens={})
    codec = Codec(read_ranks(RANKS))
    long = ["".join(rnd.choice("etaoinshrdlucmfwypvbgkqjxz") for _ in range(n)) for n in (100_000, 513, 512, 300, 30)] + ["a" * 5000, "字" * 700, "the" * 2000]
    assert codec.encode([w.encode() for w in long]) == [known.encode_ordinary(w) for w in long]
    short = ["".join(rnd.choice("etaoins") for _ in range(400)) for _ in range(120)]  # more rows than one call gets
    assert codec.encode([w.encode() for w in short]) == [known.encode_ordinary(w) for w in short]


def test_pfor_round_trip():
    rng = np.random.default_rng(1)
    for n in (0, 1, 127, 128, 129, 3000):
        for top in (1, 2, 300, 50257, 2**32 - 1):
            v = rng.integers(0, top, n).astype(np.uint32)
            v[rng.random(n) < 0.03] = 2**32 - 1
            assert (unpack(*pack(v), n) == v).all()


def test_token_files(spark, docs, rows):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    tokenizer, out = Tokenizer.from_file(path), store_path(spark)
    write_token_files(docs, path, out)
    start, want = 0, []
    for i, t in by_id(rows):
        ids = [*tokenizer.encode(t or "", add_special_tokens=False).ids, 0]
        want.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert sorted((tuple(r) for r in read_token_files(spark, out, ids=False).drop("ids").collect()), key=lambda r: r[1]) == want


def test_token_files_added_token(spark):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    tokenizer, out = Tokenizer.from_file(path), store_path(spark)
    texts = ["a <|endoftext|> b", "plain words", "", "<|endoftext|>", "<|endof", "text|> x", "x<|endoftext|><|endoftext|>字 \n"]
    write_token_files(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), path, out)
    got = {r.doc_id: np.frombuffer(r.ids, "<u4").tolist() for r in read_token_files(spark, out).collect()}
    assert got == {i: [*tokenizer.encode(t, add_special_tokens=False).ids, 0] for i, t in enumerate(texts)}


def test_decontamination(spark):
    rnd = random.Random(4)
    items = [(k, " ".join("".join(rnd.choice("abcdefghij") for _ in range(rnd.randint(2, 8))) for _ in range(25))) for k in range(6)] + [(6, None), (7, "ab")]
    noise = lambda: "".join(rnd.choice("klmnopq ") for _ in range(300))
    near = list(items[1][1])
    for p in (10, 50, 90):
        near[p] = "z"
    far = ["z" if p % 8 == 0 else c for p, c in enumerate(items[2][1])]
    texts = [(0, noise() + items[0][1].upper().replace(" ", " \n") + noise()), (1, noise() + "".join(near)), (2, noise() + "".join(far)), (3, noise()), (4, None), (5, ""), (None, items[3][1]), (8, items[4][1] + " " + items[5][1])]
    found = contaminated(spark.createDataFrame([(*x, "c", 1) for x in texts], DOC), spark.createDataFrame(items, "item_id long, text string"))
    assert sorted(((r.doc_id, r.item_id, r.edits) for r in found.collect()), key=str) == sorted([(0, 0, 0), (1, 1, 3), (None, 3, 0), (8, 4, 0), (8, 5, 0)], key=str)


def test_alignment():
    rnd = random.Random(5)
    for _ in range(60):
        item, text = ("".join(rnd.choice("abc") for _ in range(n)) for n in (rnd.randint(5, 20), rnd.randint(0, 40)))
        row = [0] * (len(text) + 1)
        for i, x in enumerate(item):
            new = [i + 1]
            for j, y in enumerate(text):
                new.append(min(row[j] + (x != y), row[j + 1] + 1, new[j] + 1))
            row = new
        got = alignment(np.frombuffer(item.encode(), np.uint8), np.frombuffer(text.encode(), np.uint8), -30, 90, 9)
        assert got == min(min(row), 10)


def test_toxicity_held_out(spark):
    sf = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    held_out = F.crc32(F.col("doc_id").cast("string")) % 4 == 2
    model = toxicity.train(docs, labels.where(~held_out))
    r = toxicity.score(docs, model, ["doc_id"]).join(labels, "doc_id").where(held_out).select((F.col("score") >= 0.3).cast("int").alias("p"), "toxic").toPandas()
    assert ((r.p == 1) & (r.toxic == 1)).sum() >= 0.8 * (r.toxic == 1).sum()
    assert ((r.p == 1) & (r.toxic == 0)).sum() <= 0.02 * (r.toxic == 0).sum()


def test_toxicity_odd_cases(spark, docs):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert {round(r.score, 6) for r in toxicity.score(docs, toxicity.train(docs, none), ["doc_id"]).collect()} == {0.000998}  # the share of toxic labels, of which there are none


def test_lm_base_score_and_gain(docs, rows):
    held_out = F.crc32(F.col("doc_id").cast("string")) % 10 == 0
    low = lambda t: bytes(c + 32 if 65 <= c <= 90 else c for c in (t or "").encode()).split() + [None]
    train = Counter(w for i, t in rows if i is None or zlib.crc32(str(i).encode()) % 10 for w in low(t))
    n, v = sum(train.values()), len(train)
    want = defaultdict(list)
    for i, t in rows:
        own = low(t)
        want[i].append((len(own), sum(train[w] > 0 for w in own), n, round(sum(math.log10((train[w] + 0.1) / (n + 0.1 * (v + 1))) for w in own), 6)))
    got = defaultdict(list)
    for r in score_texts(docs, held_out).collect():
        got[r.doc_id].append((r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)))
        assert r.score < 0 and r.bits_per_byte < 12
    assert {k: sorted(x) for k, x in got.items()} == {k: sorted(x) for k, x in want.items()}


def slow_mixing(code, count, pairs):
    """cell_log2 written symbol by symbol, with dictionaries; pairs counts (last two bytes, symbol)."""
    stretch = lambda n0, n1, prior: float(np.clip(math.log((n1 + prior) / (n0 + prior)), -12, 12))
    squash = lambda x: 1 / (1 + math.exp(-x))
    seen, one_back, two_back = Counter(), Counter(), Counter()
    for k in mixing.HIGH:
        for c, n in zip(mixing.context(code, k).tolist(), count.tolist()):
            for bit in range(8):
                seen[k, bit, c >> (8 - bit), c >> (7 - bit) & 1] += n
    for (pair, symbol), n in pairs.items():
        for bit in range(8):
            one_back[pair >> 8, bit, symbol >> (8 - bit), symbol >> (7 - bit) & 1] += n
            two_back[pair, bit, symbol >> (8 - bit), symbol >> (7 - bit) & 1] += n
    low = {k: mixing.context(code, k).tolist() for k in mixing.HIGH}
    turn = mixing.mix(code >> np.uint64(8), 7)
    order = sorted(range(len(code)), key=lambda i: (int(turn[i]), int(code[i])))
    batches, ctx = [], None
    for place, i in enumerate(order):
        if code[i] >> np.uint64(8) != ctx:
            ctx, start = code[i] >> np.uint64(8), place
        if place % mixing.BATCH == 0:
            batches.append(start)
    batches = sorted(set(batches)) + [len(order)]
    trust = lambda n: int(n > 0) + int(n > 2) + int(n > 12)
    out = [0.0] * len(code)
    for bit in range(8):
        w = {}
        steps, hits, sums = Counter(), {}, {}
        place_of = lambda x: (min(int((x + 12) * 32 / 24), 31), (x + 12) * 32 / 24 - min(int((x + 12) * 32 / 24), 31))

        def look(i, less):
            symbol, one = int(code[i]) & 255, int(code[i]) >> (7 - bit) & 1
            node, pair = symbol >> (8 - bit), int(code[i]) >> 48
            x = [stretch(one_back[pair >> 8, bit, node, 0], one_back[pair >> 8, bit, node, 1], 0.02), stretch(two_back[pair, bit, node, 0], two_back[pair, bit, node, 1], 0.1)]
            longest = 0
            for k in mixing.HIGH:
                n = [seen[k, bit, low[k][i] >> (8 - bit), v] for v in (0, 1)]
                n[one] -= less and count[i] > 0
                x.append(stretch(*n, 0.4))
                last = trust(sum(n))
                if last and k < mixing.WORD:
                    longest = k - 2
            return x + [0.3], longest * 4 + last, node, one

        def predict(x, gate, node):
            st = float(np.clip(sum(a * b for a, b in zip(w.get(gate, mixing.START.tolist()), x)), -12, 12))
            at, part = place_of(st)
            value = lambda p: sums.get((node, p), 4 * squash(-12 + p * 24 / 32)) / hits.get((node, p), 4)
            own = value(at) * (1 - part) + value(at + 1) * part
            return min(max((squash(st) + own) / 2, 1e-6), 1 - 1e-6), squash(st), at, part

        for scoring in (False, True):
            for a, b in zip(batches, batches[1:]):
                if scoring:
                    for i in order[a:b]:
                        x, gate, node, one = look(i, False)
                        p = predict(x, gate, node)[0]
                        out[i] += math.log2(p if one else 1 - p)
                slope, held, more = defaultdict(lambda: [0.0] * mixing.INPUTS), Counter(), []
                for i in order[a:b]:
                    x, gate, node, one = look(i, True)
                    _, plain, at, part = predict(x, gate, node)
                    held[gate] += int(count[i])
                    slope[gate] = [s + (one - plain) * int(count[i]) * v for s, v in zip(slope[gate], x)]
                    more += [(node, at, (1 - part) * int(count[i]), one), (node, at + 1, part * int(count[i]), one)]
                for g, n in held.items():
                    if n:
                        steps[g] += 1
                        rate = mixing.RATE / math.sqrt(steps[g]) * min(1, n / 16)
                        w[g] = [v + rate * s / n for v, s in zip(w.get(g, mixing.START.tolist()), slope[g])]
                for node, at, n, one in more:
                    sums[node, at] = sums.get((node, at), 4 * squash(-12 + at * 24 / 32)) + n * one
                    hits[node, at] = hits.get((node, at), 4) + n
    return out


@pytest.fixture(scope="module")
def cell():
    rnd = random.Random(5)
    data = np.frombuffer(words(rnd, 400).encode(), np.uint8)
    code, count = np.unique(mixing.codes(data, np.array([0, len(data)])), return_counts=True)
    some = code[len(code) // 2] >> np.uint64(8) << np.uint64(8)
    every = np.union1d(code, some | np.arange(256, dtype=np.uint64))  # one context with all symbols
    n = np.zeros(len(every), np.int64)
    n[np.searchsorted(every, code)] = count
    keys, back = np.unique(mixing.pairs_of(code), return_inverse=True)
    return every, n, mixing.Low(keys, np.bincount(back, count)), {(int(k) >> 8, int(k) & 255): int(c) for k, c in zip(keys, np.bincount(back, count))}, some


def test_mixing_against_a_slow_version(cell, monkeypatch):
    code, count, low, pairs, _ = cell
    monkeypatch.setattr(mixing, "BATCH", 300)
    assert np.allclose(mixing.cell_log2(code, count, low), slow_mixing(code, count, pairs), atol=2e-3)


def test_mixing_probabilities_sum_to_one(cell):
    code, count, low, _, some = cell
    p = 2.0 ** mixing.cell_log2(code, count, low)
    assert abs(p[(code >> np.uint64(8)) == (some >> np.uint64(8))].sum() - 1) < 1e-6


def test_lm_scores_do_not_depend_on_partitions(spark, docs):
    held_out, found = F.crc32(F.col("doc_id").cast("string")) % 10 == 0, []
    before = spark.conf.get("spark.sql.shuffle.partitions")
    for n in ("2", "5"):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        found.append(sorted((str(r.doc_id), r.n_tokens, round(r.score, 9)) for r in score_texts(docs, held_out, cell_bytes=4096).collect()))
    spark.conf.set("spark.sql.shuffle.partitions", before)
    assert found[0] == found[1]


def test_embeddings(spark):
    rng = np.random.default_rng(3)
    centers = rng.standard_normal((8, 16))
    rows = [(i, [float(x) for x in centers[i % 8] + rng.standard_normal(16) * (0.02 if i % 3 else 0.15)], i % 2) for i in range(80)]
    rows += [(80, rows[5][1], rows[5][2]), (81, rows[5][1], None), (82, None, 1), (83, [0.0] * 16, 1), (84, [float("nan")] * 16, 1), (85, [1.0, None], 1), (86, [], 1), (None, rows[5][1], rows[5][2]), (87, [1.0, 2.0], 1)]
    x = [(i, np.array(v), lab) for i, v, lab in rows if i is not None and i < 81]
    near = {(a[0], b[0]) for a in x for b in x if a[0] != b[0] and a[2] == b[2] and a[1] @ b[1] / np.sqrt((a[1] @ a[1]) * (b[1] @ b[1])) >= 0.98}
    low = {i: i for i, _, _ in rows}
    for _ in range(20):
        for a, b in near:
            low[a] = low[b] = min(low[a], low[b])
    want = [(i, sum(p[0] == i for p in near), low[i], i is None or low[i] == i) for i, _, _ in rows]
    df = spark.createDataFrame([(*r, "c") for r in rows], "vec_id long, embedding array<double>, label int, cell string")
    assert sorted(map(tuple, link_embeddings(df, tables=20, planes=8).collect()), key=str) == sorted(want, key=str)


def test_labels_with_one_hash_do_not_link(spark):
    rows = [(1, [1.0, 0.0, 0.1], -1), (2, [1.0, 0.0, 0.1001], -2), (3, [1.0, 0.0, 0.1002], -1), (4, [1.0, 0.0], -1)]
    found = link_embeddings(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int"))
    assert sorted((r["vec_id"], r["n_links"], r["component_id"]) for r in found.collect()) == [(1, 1, 1), (2, 0, 2), (3, 1, 1), (4, 0, 4)]


def test_components(spark):
    rnd = random.Random(6)
    for links in ([(i, i + 1) for i in range(40)], [(rnd.randrange(80), rnd.randrange(80)) for _ in range(50)] + [(None, 1)]):
        low = {x: x for p in links if None not in p for x in p}
        for _ in range(60):
            for a, b in links:
                if a is not None and b is not None:
                    low[a] = low[b] = min(low[a], low[b])
        got = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
        alone = {a for a, b in links if a == b} - {x for p in links if p[0] != p[1] and None not in p for x in p}
        assert got == {k: v for k, v in low.items() if k not in alone}


def test_jaccard(docs, rows):
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    sets = []
    for i, t in rows:
        own = (t or "").translate(low).encode().split()
        sets.append((i, {tuple(own[k : k + 5]) for k in range(max(1, len(own) - 4))} if own else set()))
    group = {i: i for i, _ in sets}
    for _ in range(10):
        for a, x in sets:
            for b, y in sets:
                if x and y and a is not None and b is not None and 100 * len(x & y) >= 75 * len(x | y):
                    group[a] = group[b] = min(group[a], group[b])
    want = [(i, len(s), group[i]) for i, s in sets]
    assert sorted(map(tuple, jaccard_components(docs).collect()), key=str) == sorted(want, key=str)


def test_an_id_with_two_texts_keeps_the_links_of_both(spark):
    rnd = random.Random(8)
    a, b = words(rnd, 60), words(rnd, 60)
    rows = [(2, a), (3, a), (3, b), (5, f"{b} more"), (7, words(rnd, 60)), (8, None), (8, b), (9, ""), (3, b)]
    found = jaccard_components(spark.createDataFrame([(i, t, "clash", 7) for i, t in rows], DOC).repartition(3)).collect()
    assert sorted((r["doc_id"], r["component_id"]) for r in found) == sorted((i, i if i in (7, 9) else 2) for i, _ in rows)
    apart = jaccard_components(spark.createDataFrame([(i, t, "clash", 7) for i, t in [(2, a), (3, a), (4, b), (5, f"{b} more")]], DOC)).collect()
    assert sorted((r["doc_id"], r["component_id"]) for r in apart) == [(2, 2), (3, 2), (4, 4), (5, 4)]


def thue_morse(n):
    """A word of 2**n letters and its complement: any sum of letters times powers of one base is the same modulo 2**64."""
    bits = [bin(i).count("1") % 2 for i in range(1 << n)]
    return "".join("ab"[b] for b in bits), "".join("ba"[b] for b in bits)


def test_words_that_cancel_in_powers_of_a_base(spark):
    one, two = thue_morse(10)
    lead = " ".join(f"w{i}" for i in range(19))
    docs = spark.createDataFrame([(1, f"{lead} {one}"), (2, f"{lead} {two}")], "doc_id long, text string")
    assert [r.n_removed for r in dedup_substrings(docs).collect()] == [0, 0]
    assert {r.component_id for r in jaccard_components(docs.selectExpr("doc_id", "split_part(text, ' ', 20) AS text")).collect()} == {1, 2}
    got = {r.doc_id: r.ids for r in encode_texts(docs, RANKS).collect()}
    library = tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=read_ranks(RANKS), special_tokens={})
    assert all(np.frombuffer(got[i], "<u4").tolist() == library.encode_ordinary(t) for i, t in ((1, f"{lead} {one}"), (2, f"{lead} {two}")))


def test_words_with_one_hash_keep_their_own_ids(monkeypatch):
    monkeypatch.setattr(pretokens, "word_hash", lambda data, starts, ends: (ends - starts).astype(np.uint64) % np.uint64(2))
    table = pretokens.WordTable(lambda words: [list(w) for w in words], lambda lists: [bytes(x) for x in lists])
    for text in (b"ab cd ab xyz cd", b"cd ab uvw xyz"):
        ids, n, back, size = table.encode(np.frombuffer(text, np.uint8), np.array([0, len(text)]))
        assert bytes(ids.astype(np.uint8)) == text and bytes(back) == text and n.tolist() == size.tolist() == [len(text)]


def test_suffix_query_against_sql(spark):
    con = duckdb.connect()
    con.execute("CREATE VIEW documents AS SELECT * FROM '/root/testdata/sf0.001/documents.parquet'")
    got = llm_queries.op2_suffix_dedup(spark, "/root/testdata/sf0.001")
    want = con.execute(f"SELECT {', '.join(got.columns)} FROM ({llm_queries.ORACLE_SQL['op2_suffix_dedup']})").fetchall()
    assert sorted(map(tuple, got.collect())) == sorted(want) and any(r[2] for r in want)


def test_empty_tables(spark):
    none = spark.createDataFrame([], DOC)
    for found in (dedup_substrings(none), dedup_suffixes(none), encode_texts(none, RANKS), jaccard_components(none), score_texts(none, F.lit(False))):
        assert found.count() == 0
    assert link_embeddings(spark.createDataFrame([], "vec_id long, embedding array<float>, label int")).count() == 0
    assert contaminated(none, spark.createDataFrame([], "item_id long, text string")).count() == 0
    assert html_extract.extract_pages(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_html(spark):
    model, wrong, total = html_extract.train(), 0, 0
    for seed in range(9000, 9100):
        page = blocks(labelled_pages.page(seed))
        gold = [int(b.text.startswith(labelled_pages.IN)) for b in page]
        for b in page:
            b.text = b.text.replace(labelled_pages.IN, "").replace(labelled_pages.OUT, "") or "-"
        if page:
            wrong += int((model.decode([html_extract.features(page)])[0] != gold).sum())
            total += len(gold)
    assert wrong <= 0.02 * total
    html = "<html><head><title>t</title><script>var a='<p>no</p>'</script></head><body><nav><a href='/'>Home</a></nav><article><h1>A &amp; B</h1><p>First\n  line.<br>Still it.<p>Second.</article><footer>&copy; me</footer></body></html>"
    pages = spark.createDataFrame([(1, "u", html, 1), (2, None, None, 1), (3, "u", "", 1), (4, "u", "<div class='ad'>Buy it</div", 1)], "page_id long, url string, html string, text int")
    got = {r.page_id: (r.text, r.n_chars) for r in html_extract.extract_pages(pages).collect()}
    assert [(b.text, b.around.leaf) for b in blocks('<p class=x">Hello there</p><p title="a > b" id = \'c>d\'>Two</p><p it\'s>Three')] == [("Hello there", "p"), ("Two", "p"), ("Three", "p")]
    assert got[1] == ("A & B\nFirst line. Still it.\nSecond.", 35) and got[2] == got[3] == ("", 0)


def test_pipeline_stages_keep_columns(spark, docs, tmp_path):
    import corpus_pipeline as C

    spark.createDataFrame([], "doc_id long, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame([(1, "nothing of this is anywhere in the texts at all")], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    given = docs.select("doc_id", "text", F.lit("en").alias("lang"), F.lit("s").alias("source"), F.length("text").cast("long").alias("n_chars"))
    for name, stage in C.STAGES[1:-1]:
        out = stage(spark, given, str(tmp_path))
        assert out.columns == given.columns, name
        given = out.cache()
        assert given.count() > 0
    left = {r.doc_id: r.text for r in given.collect()}
    assert 31 not in left and 30 not in left and 3 in left and 36 not in left and 32 in left


def test_pipeline_cuts_short_shared_passages(spark):
    import corpus_pipeline as C

    rnd = random.Random(8)
    shared = " ".join("".join(rnd.choice("abcdefghij") for _ in range(4)) for _ in range(51))  # 254 bytes
    texts = [words(rnd, 80), f"{words(rnd, 60)}\n{shared}\n{words(rnd, 60)}", f"{words(rnd, 50)}\n{shared}\n{words(rnd, 90)}", None]
    given = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in enumerate(texts)], "doc_id long, text string, lang string, source string, n_chars long")
    seen = Counter(b[a : a + 250] for t in texts for b in [(t or "").encode()] for a in range(len(b) - 249))
    want = {}
    for i, t in enumerate(texts):
        b = (t or "").encode()
        gone = np.zeros(len(b), bool)
        for a in range(len(b) - 249):
            if seen[b[a : a + 250]] > 1:
                gone[a : a + 250] = True
        want[i] = None if t is None else bytes(np.frombuffer(b, np.uint8)[~gone]).decode(errors="ignore")
    got = {r.doc_id: r.text for r in C.cut_repeated_passages(spark, given, "").collect()}
    assert got == want and shared not in got[1] and got[0] == texts[0]


def test_whole_pipeline(spark, tmp_path):
    """Every stage by hand, in turn, over a table with clashing extra columns."""
    import corpus_pipeline as C

    rnd = random.Random(12)
    shared = " ".join("".join(rnd.choice("abcdefghij") for _ in range(5)) for _ in range(60))
    item = "the colour of a quiet river at dawn is said to be the oldest question of the northern school of painters"
    texts = [f"{words(rnd, 60)} {'vile scum filth' if i % 10 == 0 else 'kind warm words'} {words(rnd, 40)}" for i in range(60)]
    texts += [texts[1], texts[1].replace("ba", "ko", 1), *(f"{words(rnd, 50)} kind warm words {middle} {words(rnd, 50)}" for middle in (shared, shared, item))]
    rows = [(i, t, "en", "s", len(t or ""), 0.5, "k", "z") for i, t in enumerate(texts)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, score double, _key string, _kept string").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(i, int(i % 10 == 0)) for i in range(60)], "doc_id long, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    steps = {}
    for name, stage in C.STAGES[:-1]:
        docs = spark.createDataFrame(stage(spark, docs, str(tmp_path)).collect(), docs.schema)
        steps[name] = {r.doc_id: r for r in docs.collect()}
        assert all((r.score, r._key, r._kept) == (0.5, "k", "z") for r in steps[name].values()), name
    assert set(steps["toxicity"]) == {i for i in range(len(texts)) if i >= 60 or i % 10}
    assert set(steps["toxicity"]) - set(steps["ngram_jaccard"]) == {60, 61}
    cut = {i for i, r in steps["suffix_dedup"].items() if r.text != texts[i]}
    assert cut == {62, 63} and all(shared not in steps["suffix_dedup"][i].text for i in cut) and steps["suffix_dedup"][62].n_chars == len(steps["suffix_dedup"][62].text)
    assert set(steps["suffix_dedup"]) - set(steps["decontaminate"]) == {64}
    library = tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=read_ranks(RANKS), special_tokens={})
    got = {r.doc_id: (np.frombuffer(r.ids, "<u4").tolist(), r.decoded_sha256) for r in C.run(spark, str(tmp_path)).collect()}
    assert got == {i: (library.encode_ordinary(r.text or ""), hashlib.sha256((r.text or "").encode()).hexdigest()) for i, r in steps["decontaminate"].items()}


def test_equal_windows_have_equal_anchors_in_buckets_of_any_size():
    rnd = random.Random(3)
    shared = bytes(rnd.choice(b"ab") for _ in range(900))
    found = []
    for n in (50, 1 << 17, 1 << 21):
        data = np.frombuffer(bytes(rnd.randrange(256) for _ in range(1000)) * (n // 1000) + shared, np.uint8)
        _, first, count, spot, h = suffix_dedup.anchored_runs(data, np.array([0, len(data)]), 400, 64)
        at = len(data) - len(shared)
        inside = first >= at
        found.append(list(zip((first[inside] - at).tolist(), count[inside].tolist(), (spot[inside] - at).tolist(), h[inside].tolist())))
    assert found[0][1:] == found[1][-len(found[0][1:]):] == found[2][-len(found[0][1:]):]


def test_rows_of_one_id_leave_the_same_one(spark, docs):
    import corpus_pipeline

    stage = dict(corpus_pipeline.STAGES)["ngram_jaccard"]
    rnd = random.Random(2)
    rows = [(1, words(rnd, 40), "a", k) for k in range(6)] + [(1, words(rnd, 40), "b", 9), (2, words(rnd, 40), "c", 1)]
    one = [sorted(map(tuple, stage(spark, spark.createDataFrame(rows[::step], DOC).repartition(n), None).collect()), key=str) for step, n in ((1, 1), (-1, 5))]
    assert one[0] == one[1] and sorted(r[0] for r in one[0]) == [1, 2]

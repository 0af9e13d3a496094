"""Exact dedup, source divergence and embedding whitening against brute force, with the odd cases."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from kgloom.llm import divergence as divergence_module
from kgloom.llm import exact_dedup, fuse, whitening
from kgloom.llm.divergence import divergence, share
from kgloom.llm.exact_dedup import dedup_exact
from kgloom.llm.quadtree import Tree
from kgloom.llm.whitening import whiten

DOC = "doc_id long, text string, lang string, source string, bucket string, part string, place int, key string"
CLASH = ("clash", "clash", 7, "clash")


@pytest.fixture(scope="module")
def rows():
    rnd = random.Random(5)
    out = [(i, " ".join(rnd.choice(("ab", "Ab", "é1", "zo")) for _ in range(rnd.randrange(3)))) for i in range(60)]
    out += [(None, "only here"), (None, "only here"), (None, "ab"), (7, "twice 7"), (7, "twice 7"), (3, "other"), (70, None), (71, ""), (72, "x" * 3_000_000), (73, "x" * 3_000_000), (74, "x" * 2_999_999 + "y")]
    return out


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame([(i, t, "l", "s", *CLASH) for i, t in rows], DOC).repartition(3)


def slow_exact(rows):
    groups = defaultdict(list)
    for i, t in rows:
        groups[t or ""].append(i)
    out = []
    for i, t in rows:
        ids = [x for x in groups[t or ""] if x is not None]
        keep = max(ids, default=None)
        out.append((i, keep, len(groups[t or ""]), i == keep, hashlib.sha256((t or "").encode()).hexdigest()))
    return sorted(out, key=str)


def told(df):
    return sorted((tuple(r) for r in df.select("doc_id", "keep_id", "group_size", "kept", "text_sha256").collect()), key=str)


def test_exact_dedup(docs, rows):
    assert told(dedup_exact(docs)) == slow_exact(rows)


def test_exact_dedup_of_many_batches(docs, rows):
    third = [F.pmod(F.coalesce("doc_id", F.lit(1)), F.lit(3)) == n for n in range(3)]
    assert told(dedup_exact(docs, third)) == slow_exact(rows)
    assert told(dedup_exact(docs, [F.lit(True)])) == slow_exact(rows)


def test_exact_dedup_compares_bytes(docs, rows, monkeypatch):
    weak = lambda c: F.encode(F.substring(F.sha2(c, 256), 1, 1), "utf-8")  # noqa: E731  sixteen digests for all texts
    tried = []
    totals = exact_dedup._totals
    monkeypatch.setattr(exact_dedup, "_totals", lambda *a: tried.append(1) or totals(*a))
    assert told(dedup_exact(docs, digest=weak)) == slow_exact(rows)
    assert len(tried) == 2


def test_clash_between_a_snapshot_and_a_batch(spark):
    rows = [(1, "a"), (2, "b")]
    docs = spark.createDataFrame([(i, t, "l", "s", *CLASH) for i, t in rows], DOC)
    one = lambda c: F.encode(F.lit("same"), "utf-8")
    assert told(dedup_exact(docs, [F.col("doc_id") == 1, F.col("doc_id") == 2], digest=one)) == slow_exact(rows)


def test_small_filters_in_pieces(docs, rows, monkeypatch):
    monkeypatch.setattr(exact_dedup, "FILTER_KEYS", 4)
    assert told(dedup_exact(docs)) == slow_exact(rows)


@pytest.mark.parametrize("n", [0, 1, 2, 3, 10, 100, 5000, 200_000])
def test_fuse_filter(n):
    rng = np.random.default_rng(n)
    keys = rng.integers(0, 2**64, n, dtype=np.uint64)
    packed = fuse.build(np.concatenate((keys, keys[:3])))
    assert fuse.contains(packed, keys).all()
    others = rng.integers(0, 2**64, 100_000, dtype=np.uint64)
    assert fuse.contains(packed, others).mean() < 0.006
    if n >= 5000:
        assert len(packed) < 1.35 * n


def slow_divergence(rows, least=10, top=10):
    docs = [(l or "", s or "", [re.sub("[A-Z]", lambda m: m[0].lower(), t) for t in re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", t or "")]) for t, l, s in rows]
    df, counts, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for lang, source, terms in docs:
        groups[lang].add(source)
        df[lang].update(set(terms))
    kept = {lang: sorted(t for t, n in df[lang].items() if n >= least) for lang in groups}
    for lang, source, terms in docs:
        counts[lang, source].update(t for t in terms if df[lang][t] >= least)
    out = []
    f = lambda p, q: (p - q) ** 2 // (p + q)

    def prices(c, terms):
        total = sum(c[t] for t in terms) + 2 * len(terms)
        return {t: 1 + 10**9 * (c[t] + 2) // total for t in terms}

    for lang, sources in groups.items():
        terms = kept[lang]
        p = {s: prices(counts[lang, s], terms) for s in sources}
        q = prices(sum((counts[lang, s] for s in sources), Counter()), terms)
        for s in sources:
            pair = sorted((-sum(f(p[s][t], p[o][t]) for t in terms), o.encode()) for o in sources if o != s)
            term = sorted((-f(p[s][t], q[t]), t.encode()) for t in terms if counts[lang, s][t] and p[s][t] > q[t])[:top]
            for part, items in (("pair", pair), ("term", term)):
                out += [(lang, s, part, i.decode(), -v, r) for r, (v, i) in enumerate(items, 1)]
    return sorted(out)


@pytest.fixture(scope="module")
def spoken():
    rnd = random.Random(9)
    out = [(" ".join(rnd.choice(("Ba", "bA", "dé", "字", "\U0001f600x", "ka", "x'll", "1b2", "zz")) * (1 + rnd.randrange(2)) for _ in range(rnd.randrange(12))), rnd.choice(("en", "fr", None)), rnd.choice(("s1", "s2", "é", "\U0001f600", "￿", None))) for _ in range(300)]
    return out + [(None, "en", "quiet"), ("", "en", "quiet"), ("solo words", "xx", "one"), ("few", "yy", "a"), ("few", "yy", "b")] + [("ba " * 200_000, "en", "s1")] * 2


@pytest.fixture(scope="module")
def talk(spark, spoken):
    return spark.createDataFrame([(n, t, l, s, *CLASH) for n, (t, l, s) in enumerate(spoken)], DOC).repartition(3)


def listed(df):
    return sorted(tuple(r) for r in df.select("lang", "source", "part", "item", "value", "rank").collect())


def test_divergence(talk, spoken):
    assert listed(divergence(talk)) == slow_divergence(spoken)


def test_divergence_in_small_blocks(talk, spoken, monkeypatch):
    for name, size in (("BLOCK_TERMS", 2), ("CHUNK_GROUPS", 2), ("CELLS", 3)):
        monkeypatch.setattr(divergence_module, name, size)
    assert listed(divergence(talk)) == slow_divergence(spoken)


def test_shares_of_large_totals():
    rnd = random.Random(1)
    for _ in range(500):
        total = rnd.randrange(1, 9 * 10**15)
        n = rnd.randrange(0, total + 1)
        assert share(np.array([n]), np.array([total]))[0] == 1 + 10**9 * n // total


def test_quadtree_pairs():
    rng = np.random.default_rng(3)
    for rows, columns in ((1, 1), (5, 3), (7, 40), (40, 7)):
        matrix = rng.integers(0, 9, (rows, columns)) * (rng.random((rows, columns)) < 0.2)
        r, c = np.nonzero(matrix)
        a, b = np.repeat(np.arange(rows), rows), np.tile(np.arange(rows), rows)
        pair, column, left, right = Tree(r, c, matrix[r, c], max(rows, columns)).joint(a, b)
        got = sorted(zip(pair.tolist(), column.tolist(), left.tolist(), right.tolist()))
        want = sorted((k, j, int(matrix[a[k], j]), int(matrix[b[k], j])) for k in range(len(a)) for j in range(columns) if matrix[a[k], j] or matrix[b[k], j])
        assert got == want


VEC = "vec_id long, embedding array<float>, label int, x string, index int, component int"


def test_whitening(spark, monkeypatch):
    monkeypatch.setattr(whitening, "BLOCK_ROWS", 16)
    rng = np.random.default_rng(2)
    base = (rng.standard_normal((150, 6)) * [3, 2, 1, 0.7, 0.5, 0.1]).astype(np.float32)
    rows = [(i, v.tolist()) for i, v in enumerate(base)] + [(200 + i, base[0].tolist()) for i in range(80)]
    odd = [(900, None), (901, []), (902, [1.0] * 5), (903, [float("nan")] * 6), (904, [None] * 6), (905, [float("inf")] * 6), (906, [3e38] * 6)]
    rows += [(None, base[1].tolist()), (3, base[2].tolist())]
    df = spark.createDataFrame([(i, v, 1, "clash", 2, 3) for i, v in rows + odd], VEC).repartition(5)
    got = whiten(df).collect()
    assert len(got) == 4 * len(rows)
    x = np.floor(256 * np.array([v for _, v in rows], np.float64)).astype(int)
    fit = np.unique(x, axis=0)
    n, s = len(fit), fit.sum(0)
    cov = np.cov(fit.T, bias=True)
    values, vectors = np.linalg.eigh(cov)
    values, vectors = values[::-1][:4], vectors[:, ::-1][:, :4]
    white = (x - s / n) @ vectors / np.sqrt(values)
    want = {(i, k + 1, int(((n * x[j] - s) ** 2).sum())): abs(white[j, k]) for j, (i, _) in enumerate(rows) for k in range(4)}
    for r in got:
        assert abs(abs(r["whitened"]) - want[r["vec_id"], r["component"], r["deviation"]]) < 1e-9
        assert r["n"] == n and abs(r["explained"] - values[r["component"] - 1] / np.trace(cov)) < 1e-12 and 0 <= r["identity_error"] < 1e-9
    signs = defaultdict(set)
    for r in got:
        w = [white[j, r["component"] - 1] for j in range(len(rows)) if rows[j][0] == r["vec_id"]]
        if len(w) == 1 and abs(w[0]) > 1e-6:
            signs[r["component"]].add(np.sign(w[0]) == np.sign(r["whitened"]))
    assert all(len(x) == 1 for x in signs.values())


def test_whitening_without_variance(spark):
    empty = spark.createDataFrame([], VEC)
    assert whiten(empty).collect() == [] and whiten(empty).columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    one = whiten(spark.createDataFrame([(1, [1.0, 2.0], 1, "x", 1, 1), (2, [1.0, 2.0], 1, "x", 1, 1)], VEC)).collect()
    assert sorted((r["vec_id"], r["component"]) for r in one) == [(1, 1), (1, 2), (2, 1), (2, 2)]
    assert {(r["n"], r["deviation"], r["whitened"], r["explained"], r["identity_error"]) for r in one} == {(1, 0, None, None, None)}
    line = whiten(spark.createDataFrame([(i, [float(i), 2.0 * i, 0.0], 1, "x", 1, 1) for i in range(9)], VEC)).collect()
    assert all((r["whitened"] is None) == (r["component"] > 1) and r["identity_error"] < 1e-9 for r in line)


def test_new_operators_on_empty_tables(spark):
    empty = spark.createDataFrame([], DOC)
    assert dedup_exact(empty).collect() == [] and divergence(empty).collect() == []


#: Pages labelled by hand: what stands in curly brackets is the article.
PAGES = [
    "<div id=content><p>{The fox went out that night.}</p><div class='newsletter'><p>Sign up to our newsletter now</p></div><p>{It came home late.}</p></div>",
    "<nav><a href=/>Home</a> <a href=/n>News</a></nav><article><h1>{A long road}</h1><p>{We walked for days along the river.}</p><div class='cookie-banner'><p>We use cookies on this site.</p><button>Accept</button></div><p>{Then the snow began to fall.}</p></article><footer>Copyright 2020</footer>",
    "<header><div class=logo>The Paper</div></header><main><h1>{Prices rise}</h1><p>{Prices rose again in May, the office said.}</p><aside><h3>Related</h3><ul><li><a href=/a>More on prices</a><li><a href=/b>Old news</a></ul></aside><p>{Wages did not.}</p></main><div class=sidebar><p>Popular posts of the week</p></div>",
    "<body><div class='notice banner'>This site will close on Monday</div><div class=post><h2>{Bread at home}</h2><p>{Mix flour and water; wait a day.}</p><ul><li>{500 g of flour}</li><li>{350 g of water}</li></ul><div role=alert>Your session ends soon</div><p>{Bake it hot.}</p></div><section id=comments><h2>Comments</h2><div class=comment><p>I loved this bread so much.</p></div></section>",
    "<div class='ad'>Buy shoes today at half the price</div><article><p>{Shoes were once made by hand.}</p><form class=login><label>Name</label><input><button>Log in</button></form><blockquote>{A shoe is a promise, he said.}</blockquote></article><div class='share social'><a href=/t>Tweet</a> | <a href=/f>Post</a></div>",
]


def test_pages_labelled_by_hand():
    from kgloom.llm import html_extract

    wants = ["\n".join(re.findall(r"\{(.*?)\}", p)) for p in PAGES]
    got = html_extract.main_text([p.replace("{", "").replace("}", "") for p in PAGES], html_extract.train())
    assert got == wants


def test_deep_nesting_takes_time_in_proportion():
    import time

    from kgloom.llm import html_extract

    model = html_extract.train()
    for page in ("<div>x" * 50_000, "<b>x<div>" * 50_000, "<i><div>" + "<b>x" * 50_000 + "</i>" * 50_000):
        began = time.process_time()
        html_extract.main_text([page], model)
        assert time.process_time() - began < 10


def test_long_and_short_pages_are_decoded_apart(monkeypatch):
    from kgloom.llm import html_extract, labelled_pages

    model, pages = html_extract.train(), [labelled_pages.page(s).replace(labelled_pages.IN, "").replace(labelled_pages.OUT, "") for s in range(40)]
    whole = html_extract.main_text([*pages, "<p>x</p>" * 3000, "", None], model)
    monkeypatch.setattr(html_extract, "CELLS", 7)
    assert html_extract.main_text([*pages, "<p>x</p>" * 3000, "", None], model) == whole == [html_extract.main_text([p], model)[0] for p in [*pages, "<p>x</p>" * 3000, "", None]]


def test_viterbi_against_all_labellings():
    import itertools

    from kgloom.llm.html_extract import FEATURES, Model

    rng = np.random.default_rng(7)
    model = Model(rng.standard_normal((FEATURES, 2)), rng.standard_normal((2, 2)))
    pages = [[tuple(rng.integers(0, FEATURES, 3)) for _ in range(n)] for n in (1, 2, 5, 8, 0)]
    for page, labels in zip(pages, model.decode(pages)):
        def worth(ys, page=page):
            return sum(model.emission[list(f), y].sum() for f, y in zip(page, ys)) + sum(model.transition[a, b] for a, b in zip(ys, ys[1:]))

        best = max(itertools.product((0, 1), repeat=len(page)), key=worth)
        assert labels.tolist() == list(best)


def fewest_edits(item, text):
    """Over all places of the text, by the whole table."""
    row = [0] * (len(text) + 1)
    for i, x in enumerate(item):
        new = [i + 1]
        for j, y in enumerate(text):
            new.append(min(row[j] + (x != y), row[j + 1] + 1, new[j] + 1))
        row = new
    return min(row)


def edited(rnd, text, n):
    chars = list(text)
    for _ in range(n):
        p = rnd.randrange(len(chars))
        kind = rnd.randrange(3)
        if kind == 0:
            chars[p] = rnd.choice("xyz")
        elif kind == 1:
            del chars[p]
        else:
            chars.insert(p, rnd.choice("xyz"))
    return "".join(chars)


@pytest.mark.parametrize("seed, alphabet", [(1, "abcdefghij"), (2, "ab"), (3, "abc")])
def test_decontamination_against_all_places_and_items(spark, seed, alphabet):
    from kgloom.llm.decontaminate import Q, RATE, contaminated

    rnd = random.Random(seed)
    make = lambda n: "".join(rnd.choice(alphabet) for _ in range(n))
    items = [(k, make(rnd.randrange(20, 130))) for k in range(6)] + [(6, make(11)), (7, make(60))] + [(8, "ab" * 40)]
    docs = []
    for k in range(16):
        item = rnd.choice(items)[1]
        docs.append((k, make(rnd.randrange(60)) + edited(rnd, item, rnd.randrange(10)) + make(rnd.randrange(60))))
    docs += [(20, items[0][1]), (21, items[1][1][:-2]), (22, items[2][1][3:]), (23, "ba" * 45), (24, items[3][1] + items[4][1])]
    want = set()
    for d, text in docs:
        for i, item in items:
            m = len(item)
            most = min(int(RATE * m), max(0, (m - Q) // Q))
            if m >= Q and (edits := fewest_edits(item, text)) <= most:
                want.add((d, i, edits))
    found = contaminated(spark.createDataFrame([(i, t, "l", "s", *CLASH) for i, t in docs], DOC).repartition(3), spark.createDataFrame(items, "item_id long, text string"))
    got = {(r["doc_id"], r["item_id"], r["edits"]) for r in found.collect()}
    assert got == want and want


def slow_toxicity(texts, toxic, share, features, l2, steps):
    """The classifier in plain Python: sets of hashed n-grams, log-count ratios, logistic regression by the same steps."""
    from math import exp, log, sqrt

    def grams(text):
        data, out = bytes(b + 32 if 65 <= b <= 90 else b for b in (text or "").encode()), set()
        for size in (3, 4, 5, 6):
            for p in range(len(data) - size + 1):
                code = int.from_bytes(data[p : p + size], "little")
                out.add((((code * 0x9E3779B97F4A7C15 + size) * 0xD1342543DE82EF95) % 2**64) >> 44)
        return out

    sets, n1 = [grams(t) for t in texts], sum(toxic)
    n0 = len(toxic) - n1
    every = sorted(set().union(*sets))
    count = {g: [sum(g in s for s, y in zip(sets, toxic) if y == k) for k in (0, 1)] for g in every}
    ratio = {g: log((c[1] + 1) / (n1 + 2)) - log((c[0] + 1) / (n0 + 2)) for g, c in count.items()}
    told = {}
    for g, c in count.items():
        both = sum(c) / (n0 + n1)
        told[g] = abs(c[1] / n1 - c[0] / n0) / sqrt((both + 1e-9) * (1 - both + 1e-9) * (1 / n0 + 1 / n1)) if sum(c) >= 3 else 0
    keep = sorted(g for g in sorted(every, key=lambda g: (-told[g], g))[:features] if told[g] > 3)
    place = {g: k for k, g in enumerate(keep)}
    rows = [[place[g] for g in s if g in place] for s in sets]
    size = len(keep) + 1
    w, speed, square = [0.0] * size, [0.0] * size, [0.0] * size
    for step in range(1, steps + 1):
        slope = [0.0] * size
        for row, y in zip(rows, toxic):
            error = 1 / (1 + exp(-(sum(ratio[keep[k]] * w[k] for k in row) + w[-1]))) - y
            for k in row:
                slope[k] += ratio[keep[k]] * error / len(rows)
            slope[-1] += error / len(rows)
        for k in range(size):
            own = slope[k] + (l2 * w[k] if k < size - 1 else 0)
            speed[k] += 0.1 * (own - speed[k])
            square[k] += 0.01 * (own * own - square[k])
            w[k] -= 0.03 * (1 - step / (steps + 1)) * speed[k] / (1 - 0.9**step) / (sqrt(square[k] / (1 - 0.99**step)) + 1e-10)
    bias = w[-1] + log((share + 1e-3) / (1 - share + 1e-3)) - log(n1 / n0)
    return lambda text: 1 / (1 + exp(-(bias + sum(ratio[g] * w[place[g]] for g in grams(text) if g in place)))), len(keep)


def test_toxicity_against_a_slow_version(spark):
    import pyarrow as pa

    from kgloom.llm import toxicity

    rnd = random.Random(3)
    words = ["good", "day", "Tree", "river", "stone", "walk", "é", "blue"]
    make = lambda bad: " ".join(rnd.choice(words + ["vile", "SCUM", "rotten"] * (2 if bad else 0)) for _ in range(rnd.randrange(4, 14)))
    toxic = [int(rnd.random() < 0.4) for _ in range(70)]
    texts = [make(y) for y in toxic] + ["", None]
    toxic += [0, 1]
    model = toxicity.fit(pa.chunked_array([pa.array(texts)]), np.array(toxic), 0.1, features=60, l2=1e-3, steps=40)
    slow, kept = slow_toxicity(texts, toxic, 0.1, 60, 1e-3, 40)
    assert kept == len(model.features) > 10
    asked = [*texts, make(1), make(0), "vile " * 3000, "字" * 50]
    rows = spark.createDataFrame([(k, t, "l", "s", *CLASH) for k, t in enumerate(asked)], DOC).repartition(3)
    got = {r["doc_id"]: r["score"] for r in toxicity.score(rows, model, ["doc_id"]).collect()}
    assert len(got) == len(asked) and all(abs(got[k] - slow(t)) < 1e-9 for k, t in enumerate(asked))
    empty = toxicity.score(spark.createDataFrame([], DOC), model, ["doc_id"])
    assert empty.columns == ["doc_id", "score"] and empty.count() == 0


def test_toxicity_of_clashing_and_lacking_labels(spark):
    from kgloom.llm import toxicity

    docs = spark.createDataFrame([(k, "vile scum" if k % 2 else "good day", "l", "s", *CLASH) for k in range(40)], DOC)
    labels = spark.createDataFrame([(k, k % 2) for k in range(40)] + [(0, 1), (None, 1), (3, None), (99, 1)], "doc_id long, toxic int")
    model = toxicity.train(docs, labels)
    scores = {r["doc_id"]: r["score"] for r in toxicity.score(docs, model, ["doc_id"]).collect()}
    assert min(scores[k] for k in range(1, 40, 2)) > max(scores[k] for k in range(0, 40, 2))
    one = toxicity.train(docs, labels.where("toxic = 1"))
    assert len({r["score"] for r in toxicity.score(docs, one, ["doc_id"]).collect()}) == 1

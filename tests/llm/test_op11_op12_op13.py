import math
import random
import re
import zlib
from collections import Counter
from itertools import combinations, product

import numpy as np
import pytest

from quayside.llm import op11_minmax_dedup as op11
from quayside.llm import op12_spelling_variants as op12
from quayside.llm import op13_lexical_search as op13
from quayside.llm.common import words_of

# ---------------------------------------------------------------- op11


def pairs_of(text):
    w = words_of(text)
    return {tuple(w)} if len(w) == 1 else {tuple(w[i : i + 2]) for i in range(len(w) - 1)}


def components(rows):
    sets, root = [(d, pairs_of(t)) for d, t in rows], {d: d for d, _ in rows}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for (d, a), (e, b) in combinations(sets, 2):
        if a and b and 100 * len(a & b) >= 80 * len(a | b):
            lo, hi = sorted((find(d), find(e)))
            root[hi] = lo
    return {d: find(d) for d, _ in rows}


def edited(seed, n=160, passage=40):
    """Texts of a few words' alphabet with edits, so that pairs stand at all similarities, and a shared passage."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choices("abcdefghij", k=4))
    shared = [word() for _ in range(passage)]
    base = [[word() for _ in range(rng.choice((1, 2, 3, 6, 10, 11, 40, 150)))] for _ in range(25)]
    out = []
    for i in range(n):
        w = list(rng.choice(base))
        for _ in range(rng.choice((0, 0, 1, 1, 2, 3, 6, 10))):
            w[rng.randrange(len(w))] = word()
        if rng.random() < 0.3:
            at = rng.randrange(len(w) + 1)
            w[at:at] = shared
        out.append((i, " ".join(w)))
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_dedup_like_brute_force(spark, seed):
    rows = edited(seed)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in op11.near_duplicates(df).collect()}
    want = components(rows)
    assert 5 < len(set(want.values())) < len(rows)
    assert got == {d: (len(pairs_of(t)), want[d], want[d] == d) for d, t in rows}


def test_links_share_a_band():
    """Pairs at the threshold: all of 2,000 meet."""
    rng = np.random.default_rng(3)
    for n in (4, 9, 45, 180):
        for _ in range(500):
            a = rng.integers(0, 2**63, n).astype(np.uint64)
            k = n // 9 if n > 8 else 0  # of n, so that J = (n - k) / (n + k) = 0.8
            b = np.concatenate((a[k:], rng.integers(0, 2**63, k or 1).astype(np.uint64)))
            x, y = (op11.bands(*op11.extremes([s]))[0] for s in (a, b))
            assert (x == y).any()


def test_estimate_is_unbiased_and_steadier():
    rng = np.random.default_rng(4)
    pairs = []
    for _ in range(400):
        a = rng.integers(0, 2**63, 12).astype(np.uint64)
        pairs.append((a, np.concatenate((a[2:], rng.integers(0, 2**63, 2).astype(np.uint64)))))
    a, b = (op11.extremes([p[i] for p in pairs]) for i in (0, 1))
    both = op11.estimate(a, b)
    assert abs(both.mean() - 10 / 14) < 0.01
    alone = 10 / 14 * 4 / 14 / (2 * op11.PERMUTATIONS)  # variance of as many minima
    assert both.var() < 0.97 * alone


def test_extremes_in_pieces(monkeypatch):
    rng = np.random.default_rng(5)
    sets = [rng.integers(0, 2**63, n).astype(np.uint64) for n in (1, 7, 300, 2, 1000, 64)]
    whole = op11.extremes(sets)
    monkeypatch.setattr(op11, "PIECE", 50)
    parts = op11.extremes(sets)
    assert all((x == y).all() for x, y in zip(whole, parts, strict=True))
    assert (whole[0][2] == (sets[2][:, None] * op11.TIMES + op11.PLUS).min(axis=0)).all()


def test_dedup_odd_rows(spark):
    long = " ".join(f"w{i}" for i in range(30_000))
    rows = [(5, None), (6, ""), (7, " \t\n"), (1, "A b"), (2, "a\tB"), (3, long), (4, long + " end"), (9, "one"), (9, "one"), (8, "One"), (None, "a b"), (None, "else where")]
    df = spark.createDataFrame([(d, t, 1, "x", "y") for d, t in rows], "doc_id long, text string, n_shingles int, component_id string, key string")
    got = sorted((r["doc_id"] or -1, r["n_shingles"], r["component_id"], r["kept"]) for r in op11.near_duplicates(df).collect() if r["component_id"])
    assert got == [(-1, 1, 1, False), (1, 1, 1, True), (2, 1, 1, False), (3, 29999, 3, True), (4, 30000, 3, False), (5, 0, 5, True), (6, 0, 6, True), (7, 0, 7, True), (8, 1, 8, True), (9, 1, 8, False), (9, 1, 8, False)]
    assert [r["kept"] for r in op11.near_duplicates(df).filter("component_id is null").collect()] == [True]
    assert op11.near_duplicates(df.limit(0)).collect() == []


# ---------------------------------------------------------------- op12


def variants(rows):
    counts = Counter()
    for d, t in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if d is None else d}:{run}".encode())
            if h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    words = {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}

    def near(a, b):
        a, b = sorted((a, b), key=len)
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b, strict=True)) == 1
        return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))

    of = {w: [x for x in words if x != w and near(w, x)] for w in words}
    form = {}
    for w, xs in of.items():
        best = min(xs, key=lambda x: (-words[x], x), default=None)
        form[w] = best if best is not None and words[best] >= 2 * words[w] else None

    def root(w):
        return w if form[w] is None else root(form[w])

    return sorted((w, n, len(of[w]), form[w], words[form[w]] if form[w] else None, root(w)) for w, n in words.items())


def typed(seed, n=400):
    """Words with typing errors, some of them often, and a stem that many words share."""
    rng = random.Random(seed)
    letters = "abcdé"
    base = ["".join(rng.choices(letters, k=rng.randint(4, 9))) for _ in range(25)] + ["stem" + "".join(rng.choices(letters, k=4)) for _ in range(25)]
    rows = []
    for i in range(n):
        out = []
        for _ in range(12):
            w = rng.choice(base[: 1 + rng.randrange(len(base))])
            for _ in range(rng.choice((0, 0, 0, 1, 2))):
                at, c = rng.randrange(len(w)), rng.choice(letters)
                w = rng.choice((w[:at] + w[at + 1 :], w[:at] + c + w[at:], w[:at] + c + w[at + 1 :], w + c))
            out.append(w.upper() if rng.random() < 0.1 else w)
        rows.append((i if rng.random() < 0.9 else None, rng.choice((" ", "-", ", 7")).join(out)))
    return [*rows, (1, None), (2, ""), (3, "1 2"), (4, "Été Àéîõü ÀÉÎÕÜ " * 5)]


@pytest.mark.parametrize("hot", [1, 200, 16_384])
def test_variants_like_brute_force(spark, hot, monkeypatch):
    """Whether no, some or all chunks are hot."""
    monkeypatch.setattr(op12, "HOT_PAIRS", hot)
    rows = typed(1)
    df = spark.createDataFrame([(d, t, "x", 1) for d, t in rows], "doc_id long, text string, word string, n int").repartition(3)
    words = op12.written(op12.word_counts(df), "words")
    got = sorted(tuple(r) for r in op12.spelling_variants(words).collect())
    want = variants(rows)
    assert got == want and sum(r[3] is not None for r in want) > 20 and any(r[3] not in (None, r[5]) for r in want)


def test_no_words(spark):
    df = spark.createDataFrame([(1, None)], "doc_id long, text string")
    assert op12.spelling_variants(op12.written(op12.word_counts(df), "words")).collect() == []


def test_no_table_that_grows_is_broadcast(spark, monkeypatch):
    """With every broadcast an error: words that differ in their first letter have forms, and all chunks are hot, or none."""
    words = ["".join(w) for w in product("abcd", repeat=5)]
    df = spark.createDataFrame([(w, 3 << ord(w[0]) - ord("a")) for w in words], "word string, n long")
    want = sorted((w, 3 << i, 15, None if i == 3 else "d" + w[1:], None if i == 3 else 24, "d" + w[1:]) for w in words for i in ["abcd".index(w[0])])
    monkeypatch.setattr(op12, "BROADCAST_KEYS", 0)
    before = spark.conf.get("spark.sql.maxBroadcastTableSize")
    spark.conf.set("spark.sql.maxBroadcastTableSize", "1b")
    try:
        for hot in (1, 16_384):
            monkeypatch.setattr(op12, "HOT_PAIRS", hot)
            assert sorted(tuple(r) for r in op12.spelling_variants(op12.written(df, "words")).collect()) == want
    finally:
        spark.conf.set("spark.sql.maxBroadcastTableSize", before)


def test_hot_chunks_of_many_bytes_are_not_broadcast(spark, monkeypatch):
    monkeypatch.setattr(op12, "HOT_PAIRS", 1)
    words = op12.written(spark.createDataFrame([("abcdefgh" * 20 + c, 3) for c in "uvwx"], "word string, n long"), "words")
    plan = lambda: op12.near_pairs(words)._jdf.queryExecution().executedPlan().toString()
    assert "Broadcast" in plan()
    monkeypatch.setattr(op12, "BROADCAST_BYTES", 50)
    assert "Broadcast" not in plan() and op12.near_pairs(words).count() == 6


def test_long_chain_of_forms(spark):
    forms = spark.createDataFrame([(f"w{i:03}", f"w{i + 1:03}") for i in range(100)], "word string, form string")
    assert {r["root"] for r in op12.roots(forms).collect()} == {"w100"}


# ---------------------------------------------------------------- op13


def ranking(docs, items):
    terms = lambda t: re.findall("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))
    own = [(d, Counter(terms(t))) for d, t in docs]
    own = [(d, c, sum(c.values())) for d, c in own if c]
    total, length = len(own), sum(n for _, _, n in own)
    df = Counter(t for _, c, _ in own for t in c)
    out = []
    for item, text in items:
        scored = []
        for d, c, n in own:
            m = 100 - 50 + (50 * n * total) // length
            s = sum(math.floor(1000 * math.log((2 * total + 2) / (2 * df[t] + 1))) * ((1_000_000_000 * c[t]) // (1000 * c[t] + 20 * m)) for t in set(terms(text)) if c[t])
            if s > 0:
                scored.append((-s, d is None, d))
        out += [(item, k, d, -s) for k, (s, _, d) in enumerate(sorted(scored, key=lambda x: (x[0], x[1], x[2] or 0))[:50], 1)]
    return sorted(out, key=repr)


def library(seed, n=700):
    rng = random.Random(seed)
    common, rare = [f"c{i}" for i in range(12)], [f"r{i}é" for i in range(300)]
    text = lambda k: " ".join(rng.choice(common) if rng.random() < 0.6 else rng.choice(rare[: 1 + rng.randrange(300)]) for _ in range(k))
    docs = [(i, text(rng.choice((1, 3, 10, 40, 200)))) for i in range(n)]
    docs += [(n + i, docs[7][1].upper()) for i in range(60)] + [(3, "c1 c1"), (None, "r1é c2"), (None, "r1é c2"), (n + 90, None), (n + 91, ""), (n + 92, "--")]
    items = [(i, text(rng.choice((1, 4, 15, 30)))) for i in range(25)] + [(50, docs[7][1]), (51, None), (52, ""), (53, "nowhere at all"), (54, "c0 nowhere"), (None, "c3 r2é")]
    return docs, items


@pytest.mark.parametrize(("leaf", "chunk"), [(16, 65_536), (2, 65_536), (16, 256)])
def test_search_like_brute_force(spark, leaf, chunk, monkeypatch):
    monkeypatch.setattr(op13, "LEAF", leaf)
    monkeypatch.setattr(op13, "CHUNK_DOCS", chunk)
    docs, items = library(1)
    d = spark.createDataFrame([(i, t, 1, "x") for i, t in docs], "doc_id long, text string, n int, terms string").repartition(3)
    q = spark.createDataFrame([(i, t, 7) for i, t in items], "item_id long, text string, rank int")
    got = sorted((tuple(r) for r in op13.ranked(d, q).collect()), key=repr)
    assert got == ranking(docs, items)


def test_search_in_blocks_of_items(spark, monkeypatch):
    monkeypatch.setattr(op13, "ITEM_BLOCK", 4)
    docs, items = library(2, 150)
    d, q = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    assert sorted((tuple(r) for r in op13.ranked(d, q).collect()), key=repr) == ranking(docs, items)
    assert op13.ranked(d.limit(0), q).collect() == [] and op13.ranked(d, q.limit(0)).collect() == []


def test_bounds_hold_and_prune():
    """No node's bound is below a score under it, and the search scores few of the documents."""
    rng = np.random.default_rng(6)
    sizes = rng.integers(0, 12, 3000)
    term = np.concatenate([np.sort(rng.choice(200, n, replace=False, p=(p := 1 / np.arange(1, 201)) / p.sum())) for n in sizes]).astype(np.int32)
    tf, m = rng.integers(1, 6, len(term)), rng.integers(50, 300, 3000)
    tree = op13.Tree(term, tf, np.concatenate(([0], np.cumsum(sizes))), m, 200)
    assert sorted(tree.order.tolist()) == list(range(3000))
    leaves = [(int(a), int(b)) for a, b, x in zip(tree.lo, tree.hi, tree.leaf, strict=True) if x]
    assert sorted(i for a, b in leaves for i in range(a, b)) == list(range(3000)) and max(b - a for a, b in leaves) <= op13.LEAF
    for v in range(len(tree.lo)):
        a, b = tree.at[tree.lo[v]], tree.at[tree.hi[v]]
        assert (tree.f[a:b] <= tree.bound[tree.term[a:b], v]).all()
    wanted, weight, scored = np.array([3, 90, 150]), np.array([100, 5000, 6000]), []
    whole = np.zeros(200, np.int64)
    whole[wanted] = weight
    scores = np.add.reduceat(np.append(whole[tree.term] * tree.f, 0), tree.at[:-1]) * (tree.size > 0)
    places, got = tree.search(wanted, weight, np.arange(3000), 10)
    assert got.tolist() == sorted(scores.tolist(), reverse=True)[:10]
    plain = op13.ranges
    try:
        op13.ranges = lambda a, b: (scored.append(len(a)), plain(a, b))[1]
        tree.search(wanted, weight, np.arange(3000), 10)
    finally:
        op13.ranges = plain
    assert sum(scored) < 1500

import random
from itertools import combinations

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from quayside.llm import groups
from quayside.llm import op6_jaccard_join as op6
from quayside.llm.common import words_of


def shingles(text):
    w = words_of(text)
    return {tuple(w)} if 0 < len(w) < 5 else {tuple(w[i : i + 5]) for i in range(len(w) - 4)}


def brute(rows):
    """doc_id -> (n, least reachable)."""
    sets = {}
    for d, t in rows:
        sets.setdefault(d, []).append(shingles(t))
    nodes = [(d, s) for d, own in sets.items() for s in own]
    root = {d: d for d in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for (d, a), (e, b) in combinations(nodes, 2):
        if a and b and 100 * len(a & b) >= 75 * len(a | b):
            lo, hi = sorted((find(d), find(e)))
            root[hi] = lo
    return {d: find(d) for d in sets}


def corpus(seed, n=150):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choices("abcdefg", k=rng.randint(1, 4)))
    passage = [word() for _ in range(60)]
    base = [[word() for _ in range(rng.choice((1, 3, 5, 6, 9, 15, 40, 120)))] for _ in range(30)]
    texts = []
    for _ in range(n):
        w = list(rng.choice(base))
        for _ in range(rng.choice((0, 0, 1, 1, 2, 3, 6))):
            w[rng.randrange(len(w))] = word()
        if rng.random() < 0.3:  # a passage that many share
            at = rng.randrange(len(w) + 1)
            w[at:at] = passage
        texts.append(" ".join(w))
    return list(enumerate(texts))


def result(spark, rows, **kw):
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    return {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in op6.jaccard_components(df).collect()}


@pytest.mark.parametrize(("seed", "hot"), [(1, False), (2, True)])
def test_like_brute_force(spark, seed, hot, monkeypatch):
    rows = corpus(seed)
    if hot:  # most shingles are frequent
        monkeypatch.setattr(op6, "HOT_LEAST", 2)
    got = result(spark, rows)
    want = brute(rows)
    assert {d: c for d, (_, c) in got.items()} == want
    assert {d: n for d, (n, _) in got.items()} == {d: len(shingles(t)) for d, t in rows}


def near_threshold(n=60, seed=4):
    """Copies of one text with so many edits that some pairs link and many just fail to."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choices("abcdefghij", k=6))
    base = [word() for _ in range(80)]
    texts = []
    for _ in range(n):
        w = list(base)
        for _ in range(rng.choice((1, 2, 2, 3))):
            w[rng.randrange(len(w))] = word()
        texts.append(" ".join(w))
    return list(enumerate(texts))


@pytest.mark.parametrize(("block", "many", "size"), [(2048, 4, 1 << 25), (7, 4, 1 << 25), (2048, 0, 5000), (2048, -1, 1 << 25)])
def test_groups_in_blocks(spark, block, many, size, monkeypatch):
    """Pairs of blocks (of few members, or of few bytes), with bitmaps or with the exact sets, settle all
    pairs of a group."""
    monkeypatch.setattr(groups, "GROUP_BLOCK", block)
    monkeypatch.setattr(groups, "BLOCK_BYTES", size)
    monkeypatch.setattr(groups, "MANY", many)
    rows = near_threshold()
    want = brute(rows)
    assert 1 < len(set(want.values())) < len(want)
    assert {d: c for d, (_, c) in result(spark, rows).items()} == want


def test_all_pairs_of_a_group_meet(spark, monkeypatch):
    monkeypatch.setattr(groups, "GROUP_BLOCK", 5)
    rows = [(1, i, i, 20, bytes(8), [1]) for i in range(40)] + [(2, i, i, 20, bytes(8), [1] if i < 40 else [2]) for i in range(30, 50)]
    rows = spark.createDataFrame(rows, "grp long, sid long, root long, n_shingles long, bits binary, known array<long>")
    monkeypatch.setattr(groups, "MANY", 1000)
    some = groups.with_pairs(groups.in_blocks(rows).drop("bits"))
    dealt = some.join(rows.select("grp", "sid", "n_shingles", "bits"), ["grp", "sid"])
    got = [(r["grp"], r["a"], r["b"]) for r in groups.close_pairs(dealt, op6.RULE).collect()]
    first, second = set(combinations(range(40), 2)), set(combinations(range(30, 50), 2))
    assert len(got) == len(set(got)) and {p[1:] for p in got if p[0] == 1} == first
    assert {p[1:] for p in got if p[0] == 2} == second - first  # those that group 1 has are left to it


def test_intersections():
    import numpy as np

    rng = np.random.default_rng(1)
    sets = [np.unique(rng.integers(0, 300, n)).astype(np.uint64) for n in (1, 5, 80, 200, 80)]
    groups.COLUMNS, before = 16, groups.COLUMNS
    try:
        got = groups.intersections(sets)
    finally:
        groups.COLUMNS = before
    for i, j in combinations(range(5), 2):
        assert got[i, j] == len(np.intersect1d(sets[i], sets[j]))


def test_sets_with_partners_stay(spark):
    """A set with a link to a different one is never settled early; lone ones are."""
    rows = [*near_threshold(20), *((100 + i, t) for i, t in corpus(5, 60)), *((1000 + i, " ".join(f"{i}w{k}" for k in range(90))) for i in range(50))]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    seen = op6.met(docs.select(F.col("doc_id").alias("key"), "doc_id", "text"), 4, 40).cache()
    kept = {r["sid"] for r in op6.partnered(seen).collect()}
    of = {r["doc_id"]: r["sid"] for r in seen.filter("bucket = -2").collect()}
    sets = {d: shingles(t) for d, t in rows}
    for a, b in combinations(sets, 2):
        if sets[a] and sets[a] != sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
            assert {of[a], of[b]} <= kept
    assert not kept & {of[1000 + i] for i in range(50)}


def test_signatures_meet():
    """Any two linked sets share a signature, whatever the frequent shingles are."""
    import numpy as np

    rng = np.random.default_rng(5)
    for _ in range(300):
        n = int(rng.integers(1, 200))
        a = np.unique(rng.integers(0, 2**63, n).astype(np.uint64))
        drop = rng.random(len(a)) < rng.choice([0, 0.05, 0.12, 0.2])
        b = np.unique(np.concatenate((a[~drop], rng.integers(0, 2**63, int(drop.sum())).astype(np.uint64))))
        both, union = len(np.intersect1d(a, b)), len(np.union1d(a, b))
        if len(b) and 100 * both >= 75 * union:
            for share in (0, 0.5, 0.9, 1.0):
                hot = np.unique(a[rng.random(len(a)) < share] >> np.uint64(64 - op6.HOT_BITS))
                hot = hot, rng.permutation(len(hot))
                assert set(op6.signatures(a, *hot).tolist()) & set(op6.signatures(b, *hot).tolist())
            size = min(len(groups.bitmap(a)), len(groups.bitmap(b))) // 8
            far = int(np.bitwise_count(groups.fold(groups.bitmap(a), size) ^ groups.fold(groups.bitmap(b), size)).sum())
            assert far <= union - both <= op6.RULE.apart(len(a) + len(b))


def test_odd_rows(spark):
    long = " ".join(f"w{i}" for i in range(30_000))
    rows = [(5, None), (6, ""), (7, " \t\n"), (1, "A b c"), (2, "a B\tc"), (3, long), (4, long + " end"), (9, "a b c d"), (9, "a b c d"), (8, "a b c d"), (None, "A B C")]
    df = spark.createDataFrame([(d, t, 1, "x") for d, t in rows], "doc_id long, text string, n_shingles int, component_id string")
    got = sorted((r["doc_id"] or -1, r["n_shingles"], r["component_id"]) for r in op6.jaccard_components(df).collect())
    assert got == [(-1, 1, 1), (1, 1, 1), (2, 1, 1), (3, 29996, 3), (4, 29997, 3), (5, 0, 5), (6, 0, 6), (7, 0, 7), (8, 1, 8), (9, 1, 8), (9, 1, 8)]


def test_empty(spark):
    assert op6.jaccard_components(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_pipeline(spark, sf_dir):
    """Every stage does to its input what its operator says."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out, seen = docs, [docs.count()]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        before = out
        out = stage(spark, before, sf_dir).cache()
        assert out.columns == docs.columns
        seen.append(out.count())
    assert seen[0] >= seen[1] > seen[2] >= seen[3]
    assert out.join(docs, docs.columns, "left_semi").count() == seen[3]
    comps = brute([(r["doc_id"], r["text"]) for r in out.select("doc_id", "text").collect()])
    assert all(d == c for d, c in comps.items())
    packed = corpus_pipeline.run(spark, sf_dir)
    assert packed.select("doc_id").distinct().count() == seen[3]
    over = packed.groupBy("bin_id").agg(F.sum("length").alias("n"), F.first("bin_tokens").alias("c")).filter("n > c")
    assert over.count() == 0


def test_pipeline_decides_by_rows(spark, tmp_path):
    """Texts that share a doc_id stay, near copies and leaks without doc_id go."""
    schema = "doc_id long, text string, lang string, source string, n_chars long, key string, component_id string"
    word = lambda k, n: " ".join(f"{k}{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(n))
    item = word("item", 40)
    rows = [(1, word("one", 60)), (1, word("two", 60)), (2, word("tri", 90)), (None, word("tri", 90) + " end"), (None, word("four", 50)), (None, f"{word('five', 30)} {item} {word('six', 30)}"),
            (3, f"{word('seven', 30)} {item}"), (4, word("very", 30_000))]
    df = spark.createDataFrame([(d, t, "en", "s", len(t), "k", "c") for d, t in rows], schema)
    df.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    once = corpus_pipeline.one_of_each(spark, df, str(tmp_path))
    assert sorted((r["doc_id"] or -1, r["text"][:3]) for r in once.collect()) == [(-1, "fiv"), (-1, "fou"), (1, "one"), (1, "two"), (2, "tri"), (3, "sev"), (4, "ver")]
    left = corpus_pipeline.decontaminate(spark, once, str(tmp_path))
    assert sorted((r["doc_id"] or -1, r["text"][:3]) for r in left.collect()) == [(-1, "fou"), (1, "one"), (1, "two"), (2, "tri"), (4, "ver")]


def test_pipeline_odd_rows(spark, tmp_path):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    rows = [(1, "the cat sat on the mat today", "en", "s", 1), (1, "the cat sat on the mat today", "en", "s", 1), (2, None, None, None, None), (3, "", "en", "s", 0),
            (None, "der hund lief schnell nach hause", "de", None, 3), (4, "123 456", "de", "s", 2), (5, "THE CAT sat on the mat today", "en", "s", 1)]
    spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, None), (2, "")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert sorted(r["doc_id"] or -1 for r in got) == [-1, 1]
    empty = tmp_path / "empty"
    spark.createDataFrame([], schema).write.parquet(f"{empty}/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{empty}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(empty)).collect() == []

import random

import numpy as np
import pytest

from quayside.llm.common import WordHasher, distinct_sorted, pack, shingle_hashes, unpack, words_of
from quayside.llm.graph import components


def test_hashes_follow_words():
    rng = random.Random(3)
    texts = ["".join(rng.choices(" \t\nabÉéx\x1c Z9.", k=rng.randint(0, 60))) for _ in range(500)] + ["", "  ", "a" * 9000 + " B"]
    hasher, known, back = WordHasher(), {}, {}
    for t in texts:
        words, hashes = words_of(t), hasher(t).tolist()
        assert len(words) == len(hashes)
        for w, h in zip(words, hashes, strict=True):
            assert known.setdefault(w, h) == h and back.setdefault(h, w) == w


def test_long_texts_in_pieces(monkeypatch):
    text = " ".join(f"w{i}" for i in range(5000))
    whole = WordHasher()(text)
    monkeypatch.setattr(WordHasher, "PIECE", 100)
    assert np.array_equal(whole, WordHasher()(text))


def test_shingles():
    h = WordHasher()
    assert len(shingle_hashes(h("a b c"))) == 1 and len(shingle_hashes(h(""))) == 0
    assert len(shingle_hashes(h("a b c d e f g"))) == 3
    assert len(distinct_sorted(shingle_hashes(h("x " * 50)))) == 1


def test_pack_round_trip():
    arrays = [np.arange(5, dtype=np.uint64), np.zeros(0, np.int64), np.array([1.5, -2], np.float32), np.array([7], np.uint8)]
    for a, b in zip(arrays, unpack(pack(*arrays)), strict=True):
        assert a.dtype == b.dtype and np.array_equal(a, b)


@pytest.mark.parametrize("seed", [1, 2])
def test_components(spark, seed):
    rng = random.Random(seed)
    links = [(rng.randrange(60), rng.randrange(60)) for _ in range(40)] + [(100 + i, 101 + i) for i in range(12)] + [(200, i) for i in range(201, 230)]
    root = {n: n for e in links for n in e}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        lo, hi = sorted((find(a), find(b)))
        root[hi] = lo
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    loops = {a for a, b in links if a == b}
    for n in root:
        if n in got or n not in loops:
            assert got[n] == find(n)


def test_components_of_nothing(spark):
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_unsettled_links_are_an_error(spark):
    path = spark.createDataFrame([(i, i + 1) for i in range(40)], "a long, b long")
    with pytest.raises(RuntimeError):
        components(path, max_rounds=1)
    assert components(path).filter("root = 0").count() == 41

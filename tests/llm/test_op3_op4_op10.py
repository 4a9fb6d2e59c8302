import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from quayside.llm import op3_topk_search as op3
from quayside.llm import op4_token_ids as op4
from quayside.llm import op10_best_fit_packing as op10
from quayside.llm.tokens import Encoder, default_path


@pytest.fixture(scope="module")
def encoder():
    return Encoder()


@pytest.fixture(scope="module")
def plain():
    """The tokenizer as the library loads it."""
    from tokenizers import Tokenizer

    return Tokenizer.from_file(default_path())


TEXTS = ["", None, " ", "  a", "a  b", "a \n b", "a\n\nb", "\n", "\na", "a\n", "a 　b", "don't we'll", "a\tb  c\t", "<|endoftext|> x", "a  <|endoftext|>b", "x" * 70_000, "a b " * 9000, "é ñ\n ü", "日本 語\nテ", "\x1c a", "a b  c", "$$$ ###\n###", " \u0085 a"]


def test_encoder_is_the_tokenizer(encoder, plain):
    for t, ids in zip(TEXTS, encoder.encode(TEXTS), strict=True):
        assert ids.tolist() == plain.encode(t or "", add_special_tokens=False).ids
    assert next(encoder.encode(["a<|endoftext|>b"])).tolist() == [64, 50256, 65]


def test_one_hash_for_many_pieces(plain, monkeypatch):
    """Pieces that share a hash are noticed, whatever the hash."""
    small = Encoder()
    cut = small._cut
    monkeypatch.setattr(small, "_cut", lambda raw: (cut(raw)[0], cut(raw)[1] % np.uint64(3)))
    texts = ["one two three", "one two four", "five six", "one"]
    assert [x.tolist() for x in small.encode(texts)] == [plain.encode(t, add_special_tokens=False).ids for t in texts]


def test_pieces_are_forgotten(plain):
    small = Encoder()
    small.LIMIT, small.LEARN = 5, 3
    texts = [f"word{i} and {i} others\n{i * i}" for i in range(20)]
    for t in texts:
        assert next(small.encode([t])).tolist() == plain.encode(t, add_special_tokens=False).ids


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet=" \n\taBé'1. 日\r​ s", max_size=30), max_size=8))
def test_encoder_property(encoder, plain, texts):
    for t, ids in zip(texts, encoder.encode(texts), strict=True):
        assert ids.tolist() == plain.encode(t, add_special_tokens=False).ids


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 2**32 - 1), max_size=300), st.sampled_from([1, 7, 64]), st.booleans())
def test_planes_round_trip(ids, block, bits):
    a = np.array(ids, np.uint32)
    width, ends, planes = op4.encode_chunk(a, block, bits)
    assert np.array_equal(op4.decode_chunk(len(a), block, bits, width, ends, planes), a)


@pytest.mark.parametrize("bits", [False, True])
def test_files(spark, plain, bits, monkeypatch):
    monkeypatch.setattr(op4, "SHARD_CHARS", 20_000)
    rows = [(i * 7 % 23, t) for i, t in enumerate(TEXTS)] + [(500, "word " * 20_000), (501, "x"), (501, "x"), (None, "y")]
    df = spark.createDataFrame([(d, t, 1) for d, t in rows], "doc_id long, text string, start int").repartition(5)
    chunks = op4.write_ids(df, bits=bits)
    got = [tuple(r) for r in op4.read_digests(chunks).collect()]
    start = 0
    want = []
    for d, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = np.array([*plain.encode(t or "", add_special_tokens=False).ids, 0], "<u4")
        want.append((d, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    assert sorted(got, key=lambda r: r[1]) == want
    whole = {(r["doc_id"], r["start"]): r["ids"] for r in op4.read_ids(chunks).collect()}
    assert all(zlib.crc32(np.array(whole[d, s], "<u4").tobytes()) == c for d, s, _, c in want)


def test_no_files(spark):
    assert op4.read_digests(op4.write_ids(spark.createDataFrame([], "doc_id long, text string"))).collect() == []


# ---------------------------------------------------------------- op10


def plain_best_fit(lengths, caps):
    """The same rule, piece by piece, over plain lists: (bin of each piece, final capacities)."""
    caps, bins, where = sorted(caps), [], []
    for i, n in enumerate(lengths):
        room = [(c - used, -last, j) for j, (c, used, last) in enumerate(bins) if c - used >= n]
        if room:  # least room left; of these the bin that came to it last
            j = min(room)[2]
        else:
            def rate(c, i=i, n=n):
                left = c - n
                for m in lengths[i + 1 :]:
                    if m <= left:
                        left -= m
                return op10.cost(c) / (c - left)

            bins.append([min((c for c in caps if c >= n), key=lambda c: (rate(c), c)), 0, i])
            j = len(bins) - 1
        bins[j][1] += n
        bins[j][2] = i
        where.append(j)
    return where, [min(c for c in caps if c >= used) for _, used, _ in bins]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(1, 64), min_size=1, max_size=60), st.sampled_from([(1, 64.0), (4, 256.0), (0, 1e9)]))
def test_packing_like_brute_force(lengths, costs):
    before = op10.BIN_COST, op10.ATTENTION
    op10.BIN_COST, op10.ATTENTION = costs
    try:
        lengths = sorted(lengths, reverse=True)
        caps = (8, 16, 32, 64)
        where, final = op10.pack_group(lengths, caps)
        assert (where, final) == plain_best_fit(lengths, caps)
    finally:
        op10.BIN_COST, op10.ATTENTION = before
    used = np.bincount(where, lengths).astype(int)
    assert len(where) == len(lengths) and set(where) == set(range(len(final)))
    for u, c in zip(used, final, strict=True):
        assert u <= c and c in caps and not any(u <= s < c for s in caps)


def test_cheaper_than_one_length():
    """Several lengths are opened, and together they cost less than any one of them with downsizing."""
    rng = np.random.default_rng(4)
    lengths = sorted(np.minimum(8192, rng.lognormal(6, 1.3, 3000).astype(int) + 1).tolist(), reverse=True)
    total = lambda final: sum(map(op10.cost, final))
    joint = op10.pack_group(lengths)[1]
    single = op10.pack_group(lengths, (8192,))
    used = np.bincount(single[0], lengths)
    downsized = [min(c for c in op10.CAPACITIES if c >= u) for u in used]
    assert len(set(joint)) >= 4 and max(joint.count(c) for c in set(joint)) < 0.9 * len(joint)
    assert total(joint) < 0.97 * total(downsized)
    assert sum(lengths) > 0.9 * sum(joint)


def test_best_fit_choice():
    where, final = op10.pack_group([60, 40, 24, 4], (64,))
    assert where == [0, 1, 1, 0] and final == [64, 64]
    assert op10.pack_group([5], (8, 64))[1] == [8]


def test_lengths(spark):
    rows = [(1, 20_000), (2, 0), (3, 5), (3, 5), (4, 8192), (None, 7)]
    out = op10.pack_lengths(spark.createDataFrame(rows, "doc_id long, n_tokens long")).collect()
    total = {}
    for r in out:
        total[r["doc_id"]] = total.get(r["doc_id"], 0) + r["length"]
    assert total == {1: 20_000, 3: 10, 4: 8192, None: 7}
    spans = sorted((r["bin_id"], r["bin_start"], r["bin_start"] + r["length"], r["bin_tokens"]) for r in out)
    assert all(a[0] != b[0] or a[2] <= b[1] for a, b in zip(spans, spans[1:], strict=False)) and all(s[2] <= s[3] for s in spans)


def test_pack_documents(spark):
    df = spark.createDataFrame([(1, None, 2), (2, "a b c", 3)], "doc_id long, text string, length int")
    assert {(r["doc_id"], r["length"]) for r in op10.best_fit_packing(df).collect()} == {(1, 1), (2, 4)}
    assert op10.best_fit_packing(df.limit(0)).collect() == []


# ---------------------------------------------------------------- op3


@pytest.mark.parametrize(("block", "queries", "rows_"), [(65_536, 2048, 2048), (5, 2, 100)])
def test_search_like_brute_force(spark, block, queries, rows_, monkeypatch):
    for name, value in (("QUERY_BLOCK", block), ("ASKED", queries), ("ROWS", rows_)):
        monkeypatch.setattr(op3, name, value)
    rng = np.random.default_rng(3)
    v = rng.normal(size=(600, 24)) / 5
    v[100:130] = v[100]  # ties
    rows = [(int(i), [float(x) for x in r]) for i, r in enumerate(v)] + [(1000, None), (1001, [float("nan")] * 24), (1002, [None, *[0.1] * 23]), (1003, [0.5] * 3), (50, v[50].tolist())]
    q = op3.quantised(spark.createDataFrame([(i, x, 1) for i, x in rows], "vec_id long, embedding array<double>, score int").repartition(4))
    got = sorted(map(tuple, op3.top_k(q.filter("vec_id % 50 = 0"), q).collect()))
    ints = [(i, np.floor(256 * np.array(x)).astype(int)) for i, x in rows if x is not None and len(x) == 24 and None not in x and np.isfinite(x).all()]
    want = []
    for qid, a in {i: a for i, a in ints if i % 50 == 0}.items():
        best = sorted((-int(a @ b), i) for i, b in ints if i != qid)[:5]
        want += [(qid, r + 1, i, -s) for r, (s, i) in enumerate(best)]
    assert got == sorted(want)


def test_search_of_empty_vectors(spark):
    rows = [(50, []), (51, []), (52, []), (53, [0.5]), (100, [0.5]), (150, None)]
    q = op3.quantised(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))
    got = sorted(map(tuple, op3.top_k(q.filter("vec_id % 50 = 0"), q).collect()))
    assert got == [(50, 1, 51, 0), (50, 2, 52, 0), (100, 1, 53, 128 * 128)]


def test_search_prunes():
    rng = np.random.default_rng(1)
    centre = rng.normal(size=(20, 8)).repeat(8, axis=1) * 300
    x = (centre[rng.integers(0, 20, 4000)] + rng.normal(size=(4000, 64)) * 20).astype(np.int64)
    s = op3.Search(np.arange(10), x[:10], 5)
    for at in range(0, 4000, 500):
        s.add(np.arange(at, at + 500), x[at : at + 500])
    assert s.exact < 0.5 * s.compared
    for n in range(10):
        order = sorted((-int(x[n] @ x[j]), j) for j in range(4000) if j != n)[:5]
        assert [(-a, b) for a, b in order] == [tuple(r) for r in s.best[n].tolist()]


def test_search_empty(spark):
    none = op3.quantised(spark.createDataFrame([], "vec_id long, embedding array<float>"))
    assert op3.top_k(none, none).collect() == []


def test_pieces_kept_are_given_by_the_caller():
    from quayside.llm import tokens

    assert tokens.encoder(kept=7).LIMIT == 7 and tokens.encoder().LIMIT == tokens.Encoder.LIMIT and tokens.encoder(kept=7) is tokens.encoder()

import math
import random
import zlib
from collections import Counter

import pytest

from quayside.llm import op1_lm_scoring as op1
from quayside.llm import op5_language_id as op5
from quayside.llm import op9_decontamination as op9
from quayside.llm.common import words_of

# ---------------------------------------------------------------- op1


def brute_scores(rows, target, vocabulary):
    docs = [(d, words_of(t), 0 if d is not None and d in target else 1) for d, t in rows]
    total = Counter(w for _, ws, _ in docs for w in ws)
    uni, bi, starts = [Counter(), Counter()], [Counter(), Counter()], [0, 0]
    name = lambda w: w if w in vocabulary else None
    for _, ws, m in docs:
        ws = [name(w) for w in ws]
        uni[m].update(ws)
        bi[m].update(zip(["<s>", *ws[:-1]], ws))
        starts[m] += bool(ws)
    size = len(vocabulary & set(total)) + 2
    out = []
    for d, ws, m in docs:
        ws = [name(w) for w in ws]
        loss = [0.0, 0.0]
        for (h, w), n in Counter(zip(["<s>", *ws[:-1]], ws)).items():
            for k in (0, 1):
                own = n if k == m else 0
                p = (uni[k][w] - own + 1) / (sum(uni[k].values()) + size)
                ch = starts[k] if h == "<s>" else uni[k][h]
                loss[k] -= n * math.log((bi[k][h, w] - own + op1.MU * p) / (max(ch - own, 0) + op1.MU))
        out.append((d, len(ws), *([loss[0] / len(ws), loss[1] / len(ws)] if ws else [None, None])))
    return out


@pytest.mark.parametrize(("hot", "flush"), [(512, 10**6), (8, 50)])
def test_scores(spark, monkeypatch, hot, flush):
    monkeypatch.setattr(op1, "HOT", hot)
    monkeypatch.setattr(op1, "FLUSH", flush)
    rng = random.Random(4)
    rows = [(i, " ".join(rng.choices([f"w{j}" for j in range(40)], weights=[1 / (j + 1) for j in range(40)], k=rng.randint(0, 60)))) for i in range(80)]
    rows += [(200, None), (201, "  "), (None, "w1 w2"), (3, "w1 w9"), (3, "w1 w9"), (202, "w1 " * 3000)]
    target = set(range(0, 40))
    df = spark.createDataFrame([(d, t, 1.0) for d, t in rows], "doc_id long, text string, score double").repartition(3)
    got = op1.cross_entropy_difference(df, spark.createDataFrame([(i,) for i in [*target, 5, 9999]], "doc_id long")).collect()
    words = {w for _, t in rows for w in words_of(t)}
    key = lambda r: (r[0] is None, r[0] or 0, r[1], r[2] or 0)
    for a, b in zip(sorted(map(tuple, got), key=key), sorted(brute_scores(rows, target, words), key=key), strict=True):
        assert a[:2] == b[:2]
        if b[2] is None:
            assert a[2:] == (None, None, None)
        else:
            assert a[2:4] == pytest.approx(b[2:], abs=2e-5) and a[4] == pytest.approx(b[2] - b[3], abs=2e-5)


def test_bounded_vocabulary(spark, monkeypatch):
    monkeypatch.setattr(op1, "VOCABULARY", 3)
    rows = [(1, "a a a b b c d e"), (2, "a b c c c d"), (3, "e a b")]
    got = op1.cross_entropy_difference(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame([(1,)], "doc_id long"))
    want = {r[0]: r for r in brute_scores(rows, {1}, {b"a", b"b", b"c"})}
    for r in got.collect():
        assert (r["loss_target"], r["loss_background"]) == pytest.approx(want[r["doc_id"]][2:], abs=2e-5)


@pytest.mark.parametrize(("common", "flush"), [(0, 10**6), (6, 50), (20, 10**6)])
def test_words_without_broadcast_counts(spark, monkeypatch, common, flush):
    """Every word is scored as itself, however few words are broadcast."""
    monkeypatch.setattr(op1, "COMMON", common, raising=False)
    monkeypatch.setattr(op1, "HOT", 4)
    monkeypatch.setattr(op1, "FLUSH", flush)
    rng = random.Random(7)
    rows = [(i, " ".join(rng.choices([f"w{j}" for j in range(60)], weights=[1 / (j + 1) for j in range(60)], k=rng.randint(1, 50)))) for i in range(60)]
    rows += [(100, "once upon w1"), (101, "w1 rare rare rare w2"), (102, "rare rare"), (103, None)]
    target = set(range(0, 30))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {r["doc_id"]: r for r in op1.cross_entropy_difference(df, spark.createDataFrame([(i,) for i in target], "doc_id long")).collect()}
    for d, n, *want in brute_scores(rows, target, {w for _, t in rows for w in words_of(t)}):
        assert got[d]["n_tokens"] == n
        assert [got[d]["loss_target"], got[d]["loss_background"]] == (want if n == 0 else pytest.approx(want, abs=2e-5))


def test_more_words_than_are_broadcast(spark):
    """70,000 words of equal counts, which do not fit the broadcast table, are all told apart."""
    words = [f"w{i}" for i in range(70_000)]
    rows = [(1, " ".join(words)), (2, " ".join(words)), (3, " ".join(words[::-1]))]
    got = {r["doc_id"]: r["loss_background"] for r in op1.cross_entropy_difference(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame([(9,)], "doc_id long")).collect()}
    assert got[1] == got[2] < got[3] - 0.001


def shuffled(spark) -> int:
    """Bytes that shuffles have written so far."""
    jsc = spark.sparkContext._jsc.sc()
    jsc.listenerBus().waitUntilEmpty(30_000)
    executors = jsc.statusStore().executorList(True)
    return sum(executors.apply(i).totalShuffleWrite() for i in range(executors.size()))


def test_more_buckets_move_no_more(spark, monkeypatch):
    """A larger corpus has more buckets, but what a document sends and gets back stays the same, as do the scores."""
    monkeypatch.setattr(op1, "COMMON", 1000)
    monkeypatch.setattr(op1, "HOT", 16)
    rng = random.Random(11)
    words, weights = [f"w{j}" for j in range(4000)], [1 / (j + 1) for j in range(4000)]
    rows = [(i, " ".join(rng.choices(words, weights=weights, k=150))) for i in range(2000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(2).cache()
    good = spark.createDataFrame([(i,) for i in range(300)], "doc_id long")
    moved, got = [], []
    for most in (20_000, 1_000):
        monkeypatch.setattr(op1, "POSTINGS_PER_BUCKET", most)
        before = shuffled(spark)
        got.append(sorted(map(tuple, op1.cross_entropy_difference(df, good).collect())))
        moved.append(shuffled(spark) - before)
    df.unpersist()
    assert got[0] == got[1] and moved[1] < 1.3 * moved[0]
    want = {r[0]: r[1:] for r in brute_scores(rows, set(range(300)), {w for _, t in rows for w in words_of(t)})}
    for d, n, *loss in (r[:4] for r in got[1]):
        assert n == want[d][0] and loss == pytest.approx(want[d][1:], abs=2e-5)


def test_chunks_without_words(spark):
    docs = spark.createDataFrame([(1, None), (2, " "), (None, "")], "doc_id long, text string").coalesce(1)
    got = op1.cross_entropy_difference(docs, docs.select("doc_id")).collect()
    assert sorted((r["doc_id"] or 0, *r[1:]) for r in got) == [(i, 0, None, None, None) for i in range(3)]


def test_no_documents(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert op1.cross_entropy_difference(none, none.select("doc_id")).collect() == []
    one = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    assert op1.cross_entropy_difference(one, none.select("doc_id")).count() == 1


# ---------------------------------------------------------------- op5


def test_held_out_accuracy(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out = op5.language_id(docs)
    rows = out.join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert len(rows) == docs.count()
    for r in rows:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) and 0 <= r["score"] <= 1
    held = [r for r in rows if r["held_out"]]
    assert sum(r["lang"] == r["lang_pred"] for r in held) >= 0.97 * len(held)


def test_prediction_ignores_labels(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(60).select("doc_id", "text", "lang")
    model = op5.train(docs)
    a = op5.predict(docs.select("doc_id", "text"), model)
    b = op5.predict(docs.selectExpr("-doc_id as doc_id", "text"), model)
    assert sorted((r["doc_id"], r["lang_pred"], round(r["score"], 9)) for r in a.collect()) == sorted((-r["doc_id"], r["lang_pred"], round(r["score"], 9)) for r in b.collect())


def test_presence_of_whole_text(monkeypatch):
    text = "Ünï çode " * 50 + "ende"
    whole = op5.presence(text).tolist()
    monkeypatch.setattr(op5, "PIECE", 16)
    assert op5.presence(text).tolist() == whole
    assert set(op5.presence("ende").tolist()) <= set(whole)


def test_kernel_ridge_like_dense_algebra():
    """Scores are those of weighted kernel ridge regression with the Nystroem kernel, solved in its dual."""
    import numpy as np

    rng = random.Random(3)
    words = {"a": ["kala", "muna", "tiki", "sola"], "b": ["brodt", "grunz", "schelm", "frist"], "c": ["ouais", "eau", "voix", "rue"]}
    text = lambda k: " ".join(rng.choices([*words[k], "und", "kala"], k=rng.randint(3, 9)))
    rows = [(k, op5.presence(text(k))) for k in words for _ in range(14)]
    asked = [op5.presence(text(k)) for k in words for _ in range(5)] + [op5.presence("zz")]
    langs, weights, offset = op5.fit([(k, op5.compact(b)) for k, b in rows], landmarks=6)
    kernel = lambda x, y: np.array([[len(set(p) & set(q)) / math.sqrt(len(p) * len(q)) for q in y] for p in x])
    marks = [r for k in langs for r in [b for lang, b in rows if lang == k][:6]]
    inner = np.linalg.pinv(kernel(marks, marks), rcond=1e-8, hermitian=True)
    at, new = kernel([b for _, b in rows], marks), kernel(asked, marks)
    k_nn, k_xn = at @ inner @ at.T, new @ inner @ at.T
    target = np.array([[1.0 if lang == k else -1.0 for k in langs] for lang, _ in rows])
    w = np.full(len(rows), 1 / len(rows))  # languages of equal size
    left = np.block([[np.diag(w) @ k_nn + op5.RIDGE * np.eye(len(rows)), w[:, None]], [w[None] @ k_nn, np.ones((1, 1))]])
    alpha = np.linalg.lstsq(left, np.vstack((w[:, None] * target, (w @ target)[None])), rcond=None)[0]
    want = k_xn @ alpha[:-1] + alpha[-1]
    assert np.abs(op5.scores(asked, weights, offset) - want).max() < 2e-3


def test_compact_presences():
    import numpy as np

    rng = np.random.default_rng(1)
    for n in (1, 100, 4095, 4096, 50_000, 1 << op5.BUCKET_BITS):
        b = np.sort(rng.choice(1 << op5.BUCKET_BITS, n, replace=False))
        assert len(op5.compact(b)) <= 1 << (op5.BUCKET_BITS - 3) and op5.listed(op5.compact(b)).tolist() == b.tolist()


def test_many_languages_share_the_bounds():
    """Of two hundred composed languages each has 100 rows and 10 landmarks; unseen texts are told apart."""
    assert op5.shares(4) == (400, 100) and op5.shares(200) == (100, 10) and op5.shares(1000) == (20, 2)
    rng = random.Random(5)
    lexicon = {f"l{k:03}": ["".join(rng.choices("abcdefghijklmnopqrstuvwxyzäöüéèñçß", k=rng.randint(2, 8))) for _ in range(60)] for k in range(200)}
    text = lambda g: " ".join(rng.choices(lexicon[g], k=40))
    sample, landmarks = 12, op5.shares(200)[1]
    langs, weights, offset = op5.fit([(g, op5.compact(op5.presence(text(g)))) for g in lexicon for _ in range(sample)], landmarks)
    asked = [g for g in lexicon for _ in range(2)]
    best = op5.scores([op5.presence(text(g)) for g in asked], weights, offset).argmax(axis=1)
    assert sum(langs[k] == g for k, g in zip(best, asked, strict=True)) >= 0.97 * len(asked)


def test_most_labelled_languages_are_learned(spark, monkeypatch):
    monkeypatch.setattr(op5, "MAX_LANGUAGES", 2)
    rows = [(i, f"wort {i} hund katze", "de") for i in range(40)] + [(100 + i, f"word {i} dog cat", "en") for i in range(30)] + [(200 + i, "mot chien chat", "fr") for i in range(5)]
    assert op5.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"))[0] == ["de", "en"]


def test_language_odd_rows(spark):
    rows = [(i, t, g) for i in range(0, 60, 2) for t, g in ((f"the dog and the cat {i}", "en"),)] + [(i, f"der hund und die katze {i}", "de") for i in range(1, 60, 2)]
    rows += [(100, None, "en"), (101, "", "en"), (102, "12 !?", None), (103, "x", None), (None, "der hund", "de"), (104, "und die katze " * 50_000, None), (1, "der hund und die katze 1", "de")]
    df = spark.createDataFrame([(d, t, g, 0.5, "x") for d, t, g in rows], "doc_id long, text string, lang string, score double, lang_pred string")
    got = {r["doc_id"]: r for r in op5.language_id(df).collect()}
    assert [got[d]["lang_pred"] for d in (100, 101, 102)] == ["und"] * 3 and got[104]["lang_pred"] == "de" == got[None]["lang_pred"]
    assert got[103]["lang_pred"] in ("en", "de") and got[None]["held_out"] is None
    none = op5.language_id(spark.createDataFrame([(1, "text", None)], "doc_id long, text string, lang string")).collect()
    assert [(r["lang_pred"], r["score"]) for r in none] == [("und", 0.0)]
    assert op5.language_id(df.limit(0)).collect() == []


# ---------------------------------------------------------------- op9


def test_leaks_are_found_and_clean_left(spark):
    rng = random.Random(9)
    word = lambda: "".join(rng.choices("abcdefghij", k=rng.randint(2, 7)))
    text = lambda n: " ".join(word() for _ in range(n))
    items = [(i, text(rng.choice((3, 8, 15, 30, 60)))) for i in range(40)] + [(100, None), (101, " ")]
    docs, leaks = [], set()
    for d in range(120):
        t = text(rng.choice((10, 80, 300)))
        if d % 3 == 0:
            i, body = rng.choice(items[:40])
            w = body.split()
            if d % 2 and len(w) >= 30:
                w[len(w) // 2] = "changed"
            t = f"{t} {' '.join(w).upper()}, {text(20)}"
            leaks.add((d, i))
        docs.append((d, t))
    docs += [(500, None), (501, ""), (502, items[3][1]), (502, items[3][1])]
    leaks.add((502, 3))
    df = spark.createDataFrame([(d, t, 1) for d, t in docs], "doc_id long, text string, item_id int").repartition(4)
    got = op9.contaminated(df, spark.createDataFrame(items, "item_id long, text string")).collect()
    assert {(r["doc_id"], r["item_id"]) for r in got} == leaks
    assert sum(r["doc_id"] == 502 for r in got) == 2
    assert all(r["similarity"] >= 0.75 and r["distance"] <= op9.RADIUS for r in got)


@pytest.mark.parametrize("direct", [0, 4096])
def test_all_within_radius(monkeypatch, direct):
    """The multi-index finds every item whose fingerprint is within the radius, by tables or not."""
    import numpy as np

    monkeypatch.setattr(op9, "DIRECT", direct)
    rng = np.random.default_rng(2)
    weights = op9.Weights(50, (np.zeros(0, np.uint64), np.zeros(0, np.int64)))
    items = op9.Items(op9.item_tables([(i, " ".join(f"t{i}x{j}" for j in range(20))) for i in range(50)], weights), weights)
    prints = []
    for _ in range(100):
        f = items.t["prints"][int(rng.integers(50))].copy()
        for b in rng.permutation(128)[: int(rng.integers(0, op9.RADIUS + 1))]:
            f[b // 16] ^= np.uint16(1 << (b % 16))
        prints.append(f)
    far = np.bitwise_count(np.stack(prints)[:, None] ^ items.t["prints"][None]).sum(axis=2)
    want = {(int(w), int(j), int(far[w, j])) for w, j in zip(*np.nonzero(far <= op9.RADIUS))}
    assert len(want) >= 100 and set(zip(*items.close(20, np.stack(prints)))) == want
    w, j = items.met(20, np.stack(prints))
    assert len(w) < 0.45 * 100 * 50  # of random fingerprints a quarter is met


def brute_leaks(docs, items):
    """(doc, item) -> best similarity of all windows as long as the item, at least 0.75."""
    words = lambda t: "".join(c if c.isalnum() or ord(c) > 127 else " " for c in (t or "").lower()).split()
    cut = lambda w, n: [tuple(w[i : i + n]) for i in range(len(w) - n + 1)]
    items = [(i, w) for i, t in items if (w := words(t))]
    sets = {i: set(cut(w, min(5, len(w)))) for i, w in items}
    df = Counter(s for i, _ in items for s in sets[i])
    weight = lambda s: 1 + math.log((1 + len(items)) / (1 + max(1, df[s])))
    out = {}
    for d, t in docs:
        w = words(t)
        for i, body in items:
            n = len(body)
            for k in range(max(1, len(w) - n + 1)):
                own = set(cut(w[k : k + n], min(5, n, max(1, len(w)))))
                both = sum(weight(s) ** 2 for s in own & sets[i])
                sim = both and both / math.sqrt(sum(weight(s) ** 2 for s in own) * sum(weight(s) ** 2 for s in sets[i]))
                if sim >= 0.75:
                    out[d, i] = max(sim, out.get((d, i), 0))
    return out


def test_recall_of_all_windows(spark):
    """Against brute force over every window: nothing false, and at least 0.9 of what there is (texts
    are made to lie about the threshold, where the fingerprints' distances spread most)."""
    rng = random.Random(12)
    vocabulary = [f"w{i}" for i in range(60)]
    text = lambda n: rng.choices(vocabulary, k=n)
    items = [(i, " ".join(text(rng.choice((2, 7, 12, 20, 20, 35))))) for i in range(30)]
    docs = []
    for d in range(300):
        w = rng.choice(items)[1].split()
        for _ in range(rng.choice((0, 0, 1, 1, 2))):
            w[rng.randrange(len(w))] = "other"
        if d % 5 == 0:  # words left out: no window lines up
            del w[len(w) // 2]
        docs.append((d, " ".join([*text(rng.randint(0, 15)), *w, *text(rng.randint(0, 15))])))
    docs += [(900, "a b a b a b a b a b a b a b a b a b a b a b a b"), (901, None), (902, "x " * 3000)]
    items += [(90, "a b " * 10), (91, "x " * 12), (92, None)]
    want = brute_leaks(docs, items)
    got = {(r["doc_id"], r["item_id"]): r["similarity"] for r in op9.contaminated(
        spark.createDataFrame(docs, "doc_id long, text string").repartition(3), spark.createDataFrame(items, "item_id long, text string")).collect()}
    assert set(got) <= set(want) and len(got) >= 0.9 * len(want) > 100
    assert {k for k, v in want.items() if v > 0.9} <= set(got)
    for k, v in got.items():
        assert v <= want[k] + 1e-5


def test_blocks_of_items_and_nothing(spark, monkeypatch):
    monkeypatch.setattr(op9, "ITEM_BLOCK", 1)
    docs = spark.createDataFrame([(1, "zero one two three four five six"), (2, "ten eleven twelve thirteen fourteen fifteen")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "one two three four five six"), (2, "Ten, eleven! twelve thirteen FOURTEEN")], "item_id long, text string")
    assert {(r["doc_id"], r["item_id"]) for r in op9.contaminated(docs, items).collect()} == {(1, 1), (2, 2)}
    assert op9.contaminated(docs, items.limit(0)).collect() == [] and op9.contaminated(docs.limit(0), items).collect() == []


def test_short_items_in_longer_documents(spark):
    docs = [(1, "one two three four five six seven"), (2, "two three"), (3, "six Seven! eight nine"), (4, "three two"), (5, "a b c d e f")]
    items = [(1, "two THREE"), (2, "six seven eight nine"), (3, "seven"), (4, "b c d"), (5, "c b d")]
    got = op9.contaminated(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")).collect()
    assert {(r["doc_id"], r["item_id"], r["first_word"], r["n_words"]) for r in got} == {(1, 1, 1, 2), (2, 1, 0, 2), (1, 3, 6, 1), (3, 3, 1, 1), (3, 2, 0, 4), (5, 4, 1, 3)}
    assert all((r["similarity"], r["distance"]) == (1.0, 0) for r in got)


def test_blocks_change_nothing(spark, monkeypatch):
    rng = random.Random(6)
    words = [f"w{i}" for i in range(300)]
    text = lambda n: " ".join(rng.choices(words, k=n))
    common = [text(12) for _ in range(3)]
    items = [(i, f"{text(10)} {common[i % 3]} {text(14)}" if i % 4 else text(3)) for i in range(24)] + [(50, " ")]
    docs = []
    for d in range(60):
        w = rng.choice(items[:24])[1].split()
        if len(w) > 9:  # cut in another item's words at one end
            w[: rng.randrange(9)] = rng.choice(items[:24])[1].split()[:8]
        docs.append((d, f"{text(30)} {' '.join(w)} {text(5)}"))
    docs, items = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    one = sorted(map(tuple, op9.contaminated(docs, items).collect()))
    monkeypatch.setattr(op9, "ITEM_BLOCK", 5)
    assert one and sorted(map(tuple, op9.contaminated(docs, items).collect())) == one

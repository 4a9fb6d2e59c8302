"""LM scoring by cross-entropy difference.

Two bigram models, of the target documents (labelled good and not toxic) and of all others, share
one vocabulary, one order and one smoothing; a document's score is the mean difference of its
tokens' losses, target minus background, in nats (lower: more like the target). Counts are over all
documents and whole texts.

* Vocabulary: every word. (If ``VOCABULARY`` is set to a number, the so many most frequent words;
  every other word is then one unknown token.)
* ``P(w | h) = (c(h, w) + MU * P(w)) / (c(h) + MU)``, ``P(w) = (c(w) + 1) / (tokens + vocabulary)``.
* A document's own occurrences of a bigram are taken out of its model's counts before the bigram
  is scored there, so documents do not vouch for themselves.

Unigram counts of the ``COMMON`` most frequent words and the counts of bigrams of two ``HOT`` words are small
tables of fixed size; both are broadcast. Counts of all other bigrams and words, which grow with the
corpus, are never gathered in one place. Texts go, as numbers of words, to chunks of ``FLUSH`` words. A
chunk sends each of its distinct bigrams and words without known count once, with its times, to buckets;
a bucket adds up and answers in the same order, so an answer is only counts. The chunk then scores its
documents on its own. What moves for a chunk is bounded by its distinct bigrams and words, whatever
the number of buckets, and a bigram has one entry a chunk, however frequent it is.

Bigrams of two words with ids go to buckets by ranges of equal expected weight, all others by ranges of a
64-bit hash: keys of a bucket are neighbours, so their differences pack as well in many buckets as in few.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import U64, WordHasher, distinct_sorted, mix, only, pack, share, shared_value, spans, table, unpack, written

VOCABULARY: int | None = None  # all words
COMMON = 65_536  # words whose counts are broadcast
HOT = 512
MU = 100.0
UNKNOWN, START, FIRST = 0, 1, 2  # ids; words follow by falling frequency
RARE = U64(1 << 63)  # marks the hash of a word that has no id
POSTINGS_PER_BUCKET = 2_000_000
FLUSH = 1_500_000  # words of a chunk
BROADCAST_IDS = 2_000_000


def marked(docs: DataFrame, target: DataFrame) -> DataFrame:
    """docs(doc_id, text) with ``target``, by the distinct ids of ``target(doc_id)``. A list of
    checked size is broadcast; beyond it, documents are joined once and written."""
    ids = target.filter("doc_id is not null").select("doc_id").distinct().withColumn("hit", F.lit(True))
    flag = F.coalesce("hit", F.lit(False)).alias("target")
    if ids.count() <= BROADCAST_IDS:
        return docs.join(F.broadcast(ids), "doc_id", "left").select("doc_id", "text", flag)
    return written(docs.join(ids, "doc_id", "left").select("doc_id", "text", flag), "marked")


def word_counts(docs: DataFrame) -> DataFrame:
    """(h, t, b): occurrences of each word in target and background; word 0 counts documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, held, size = WordHasher(), ([], []), 0

        def emit():
            parts = [np.unique(np.concatenate(x), return_counts=True) if x else (np.zeros(0, U64), np.zeros(0, np.int64)) for x in held]
            h = np.concatenate([p[0] for p in parts]).astype(np.int64)
            zero = [np.zeros(len(p[0]), np.int64) for p in parts]
            return pa.RecordBatch.from_arrays(
                [pa.array(h), pa.array(np.concatenate((zero[0], parts[1][1]))), pa.array(np.concatenate((parts[0][1], zero[1])))], ["h", "t", "b"]
            )

        for batch in batches:
            for text, good in zip(batch.column("text"), batch.column("target"), strict=True):
                h = hasher(text.as_py())
                if len(h):
                    held[good.as_py()].append(np.append(h, U64(0)))
                    size += len(h)
                if size > FLUSH:
                    yield emit()
                    held, size = ([], []), 0
        if size:
            yield emit()

    return docs.select("text", "target").mapInArrow(run, "h long, t long, b long").groupBy("h").agg(F.sum("t").alias("t"), F.sum("b").alias("b"))


def least_count(words: DataFrame, most: int) -> int:
    """The least count of a word that gets an id: words of one count get one together or not at
    all, as long as there are no more than ``most``. Only the numbers of words by count reach
    the driver, of which there are few (k different counts need k * k / 2 tokens)."""
    by_count = words.groupBy("n").agg(F.count("*").alias("words")).toPandas().sort_values("n", ascending=False)
    fits = by_count["n"][by_count["words"].cumsum() <= most]
    return int(fits.iloc[-1]) if len(fits) else 1 << 62


class Model:
    """Ids, their unigrams and hot bigrams of both models (index 0: target, 1: background). The
    vocabulary has ``size`` entries; if it is open, words without id are words of their own."""

    def __init__(self, words: pd.DataFrame, total: tuple[int, int], documents: tuple[int, int], distinct: int | None = None):
        words = words.sort_values(["n", "h"], ascending=[False, True])
        h = words["h"].to_numpy(np.int64).astype(U64)
        order = np.argsort(h)
        self.key, self.id_of = h[order], (order + FIRST).astype(np.int64)
        self.total, self.open = total, distinct is not None
        self.size = (distinct if self.open else len(words)) + FIRST
        known = [words["t"].to_numpy(np.int64), words["b"].to_numpy(np.int64)]
        self.uni = [np.concatenate(([total[m] - known[m].sum(), documents[m]], known[m])) for m in (0, 1)]
        self.hot = [np.zeros(HOT * HOT, np.int64)] * 2

    def tokens(self, h: np.ndarray) -> np.ndarray:
        """Ids of words, or, for words without id, marked hashes or the unknown token."""
        other = h | RARE if self.open else np.full(len(h), U64(UNKNOWN))
        if not len(self.key):
            return other
        i = np.minimum(np.searchsorted(self.key, h), len(self.key) - 1)
        return np.where(self.key[i] == h, self.id_of[i].astype(U64), other)

    def losses(self, x: np.ndarray, y: np.ndarray, times: np.ndarray, counts: list, own: list, uni: list) -> list[np.ndarray]:
        """Loss of all occurrences of bigrams (x, y) under each model; own: how many of a model's are the document's."""
        out = []
        for m in (0, 1):
            p = (uni[m][y] - own[m] + 1) / (self.total[m] + self.size)
            out.append(-times * np.log((counts[m] - own[m] + MU * p) / (np.maximum(uni[m][x] - own[m], 0) + MU)))
        return out

    def ranges(self) -> tuple[np.ndarray, ...]:
        """Where a word's bigrams begin in a line of all that are neither hot nor rare, were words independent;
        their weight; and the part of it before each second word, if the first is hot or not."""
        uni = (self.uni[0] + self.uni[1]).astype(float)
        uni[UNKNOWN] *= not self.open
        word = uni * (np.arange(len(uni)) != START)
        cold = word * (np.arange(len(uni)) >= HOT)
        weight = uni * np.where(np.arange(len(uni)) < HOT, cold.sum() / max(word.sum(), 1), 1.0)
        return np.cumsum(weight) - weight, weight, *((np.cumsum(z) - z) / max(z.sum(), 1) for z in (cold, word))

    def buckets(self) -> tuple[int, int]:
        """Numbers of buckets for bigrams of words with ids, and for rare bigrams and words: at most so many
        entries come as there are tokens of the kind."""
        rare = sum(self.total) - sum(int(u[FIRST:].sum()) for u in self.uni) if self.open else 0
        return tuple(max(8, math.ceil(n / POSTINGS_PER_BUCKET)) for n in (self.ranges()[1].sum(), 3 * rare))


def chunks_of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """Ids, target flags and lengths of documents with up to ``FLUSH`` words, and the hashes of all their words."""

    def held():
        return doc, np.array(good, bool), np.array([len(h) for h in words], np.int64), np.concatenate(words)

    hasher, size = WordHasher(), 0
    doc, good, words = [], [], []
    for batch in batches:
        for d, text, g in zip(batch.column("doc_id"), batch.column("text"), batch.column("target"), strict=True):
            doc.append(d.as_py())
            good.append(g.as_py())
            words.append(hasher(text.as_py()))
            size += len(words[-1])
            if size > FLUSH or len(doc) >= 100_000:
                yield held()
                doc, good, words, size = [], [], [], 0
    if doc:
        yield held()


def befores(words: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The word before each word, in documents of so many words."""
    before = np.concatenate((words[:1], words[:-1]))
    before[(np.cumsum(size) - size)[size > 0]] = START
    return before


def hot_counts(docs: DataFrame, model: Model) -> DataFrame:
    """(k, t, b): occurrences of bigrams of two hot words."""
    shared = share(docs.sparkSession, model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared_value(shared)
        table = np.zeros((2, HOT * HOT), np.int64)
        for _, good, size, h in chunks_of(batches):
            word = model.tokens(h)
            before = befores(word, size)
            hot, good = (before < HOT) & (word < HOT), np.repeat(good, size)
            for m in (0, 1):
                some = hot & (good == (m == 0))
                table[m] += np.bincount((before[some] * U64(HOT) + word[some]).astype(np.int64), minlength=HOT * HOT)
        k = np.flatnonzero(table.any(axis=0))
        yield pa.RecordBatch.from_arrays([pa.array(k), pa.array(table[0, k]), pa.array(table[1, k])], ["k", "t", "b"])

    return docs.mapInArrow(run, "k long, t long, b long").groupBy("k").agg(F.sum("t").alias("t"), F.sum("b").alias("b"))


def chunks(docs: DataFrame, model: Model) -> DataFrame:
    """(chunk, blob): ids, flags and lengths of documents, their words as ids, and the hashes of words
    without id, which are numbered on from the last id."""
    shared = share(docs.sparkSession, model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        model, part = shared_value(shared), TaskContext.get().partitionId()
        for i, (doc, good, size, h) in enumerate(chunks_of(batches)):
            word = model.tokens(h)
            rare = word >= RARE
            names = distinct_sorted(word[rare])
            word[rare] = len(model.uni[0]) + np.searchsorted(names, word[rare])
            ids, null = np.array([x or 0 for x in doc], np.int64), np.array([x is None for x in doc], np.uint8)
            blob = pack(ids, null, good.astype(np.uint8), size, word.astype(np.uint32), np.diff(names, prepend=U64(0)))
            yield pa.RecordBatch.from_arrays([pa.array([part * 1_000_000 + i]), pa.array([blob], pa.binary())], ["chunk", "blob"])

    return docs.mapInArrow(run, "chunk long, blob binary")


class Chunk:
    """A chunk's documents, their distinct bigrams (x, y), and what it asks of the buckets: counts of ``dense``
    bigrams by key, then of the ``rare`` bigrams and of words without id in the ``order`` of their hashes."""

    def __init__(self, blob: bytes, known: int):
        self.doc, self.null, good, self.size, word, gaps = unpack(blob)
        names, self.good = np.cumsum(gaps, dtype=U64), good.astype(bool)
        self.row = np.repeat(np.arange(len(self.size)), self.size)
        pairs, self.at = np.unique(befores(word, self.size).astype(U64) << U64(32) | word, return_inverse=True)
        self.x, self.y = (pairs >> U64(32)).astype(np.int64), (pairs & U64(0xFFFFFFFF)).astype(np.int64)
        self.hot = np.flatnonzero((self.x < HOT) & (self.y < HOT))
        rare = (self.x >= known) | (self.y >= known)
        self.dense, self.rare = np.flatnonzero(~rare & ((self.x >= HOT) | (self.y >= HOT))), np.flatnonzero(rare)
        x, y = (np.where(z < known, z.astype(U64), np.append(names, U64(0))[np.maximum(z - known, 0)]) for z in (self.x[rare], self.y[rare]))
        hashes = np.concatenate((mix(x) * U64(3) + mix(y ^ RARE), mix(names)))
        self.order = np.argsort(hashes, kind="stable")
        self.keys, self.hashes, self.n_names = pairs[self.dense], hashes[self.order], len(names)
        self.word, self.known = word, known

    def times(self) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """Of dense keys, and of hashes: occurrences in the chunk's target and background documents."""
        dense, hashed, good = [], [], self.good[self.row]
        for some in (good, ~good):
            pairs = np.bincount(self.at[some], minlength=len(self.x))
            names = self.word[some & (self.word >= self.known)] - self.known
            dense.append(pairs[self.dense])
            hashed.append(np.concatenate((pairs[self.rare], np.bincount(names, minlength=self.n_names)))[self.order])
        return dense, hashed


def postings(parts: DataFrame, model: Model) -> DataFrame:
    """(bucket, chunk, piece, blob): keys in order and their times in each model. A chunk's pieces
    are numbered in the order of its keys, and of its hashes after them."""
    shared = share(parts.sparkSession, model)

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        model, out = shared_value(shared), []
        begin, weight, cold, word = model.ranges()
        n_dense, n_hashed = model.buckets()
        for chunk, raw in zip(frame["chunk"], frame["blob"], strict=True):
            c, piece = Chunk(raw, len(model.uni[0])), 0
            x, y = c.x[c.dense], c.y[c.dense]
            place = (begin[x] + weight[x] * np.where(x < HOT, cold[y], word[y])) / max(weight.sum(), 1)
            dense = np.minimum((place * n_dense).astype(np.int64), n_dense - 1)
            hashed = n_dense + ((c.hashes >> U64(32)) * U64(n_hashed) >> U64(32)).astype(np.int64)
            for bucket, keys, (t, b) in zip((dense, hashed), (c.keys, c.hashes), c.times(), strict=True):
                for i, j in zip(*spans(bucket), strict=True):
                    blob = pack(np.diff(keys[i:j], prepend=U64(0)), t[i:j].astype(np.uint32), b[i:j].astype(np.uint32))
                    out.append((bucket[i], chunk, piece, blob))
                    piece += 1
        return pd.DataFrame(out, columns=["bucket", "chunk", "piece", "blob"])

    return parts.groupBy("chunk").applyInPandas(run, "bucket long, chunk long, piece long, blob binary")


def bucket_counts(posts: DataFrame) -> DataFrame:
    """(chunk, piece, blob): for each key of a piece, in its order, the times of all chunks in each model."""

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        keys, times = [], ([], [])
        for raw in frame["blob"]:
            d, *t = unpack(raw)
            keys.append(np.cumsum(d, dtype=U64))
            for m in (0, 1):
                times[m].append(t[m])
        cuts = np.cumsum([len(k) for k in keys])[:-1]
        _, at = np.unique(np.concatenate(keys), return_inverse=True)
        counts = [np.split(np.bincount(at, np.concatenate(t)).astype(np.int64)[at], cuts) for t in times]
        return pd.DataFrame({"chunk": frame["chunk"], "piece": frame["piece"], "blob": [pack(t, b) for t, b in zip(*counts, strict=True)]})

    return posts.groupBy("bucket").applyInPandas(run, "chunk long, piece long, blob binary")


def chunk_scores(parts: DataFrame, counts: DataFrame, model: Model) -> DataFrame:
    shared = share(parts.sparkSession, model)

    def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        model = shared_value(shared)
        c = Chunk(left["blob"].iloc[0], len(model.uni[0]))
        got = [unpack(raw) for raw in right.sort_values("piece")["blob"]]
        pairs, uni = [], []
        for m in (0, 1):
            told = np.concatenate([np.zeros(0, np.int64), *(g[m] for g in got)])
            if len(left) != 1 or len(told) != len(c.keys) + len(c.hashes):
                raise RuntimeError("the documents changed while they were scored")
            hashed = np.zeros(len(c.hashes), np.int64)
            hashed[c.order] = told[len(c.keys) :]
            n = np.zeros(len(c.x), np.int64)
            n[c.hot] = model.hot[m][c.x[c.hot] * HOT + c.y[c.hot]]
            n[c.dense], n[c.rare] = told[: len(c.keys)], hashed[: len(c.rare)]
            pairs.append(n)
            uni.append(np.concatenate((model.uni[m], hashed[len(c.rare) :])))
        found, times = np.unique(c.row * len(c.x) + c.at, return_counts=True)  # a document's distinct bigrams
        row, at = np.divmod(found, max(len(c.x), 1))
        own = [times * (c.good[row] == (m == 0)) for m in (0, 1)]
        losses = model.losses(c.x[at], c.y[at], times, [n[at] for n in pairs], own, uni)
        a, b = (np.where(c.size > 0, np.bincount(row, z, len(c.size)) / np.maximum(c.size, 1), np.nan) for z in losses)
        out = pd.DataFrame({"n_tokens": c.size, "loss_target": a.round(6), "loss_background": b.round(6), "score": (a - b).round(6)})
        out.insert(0, "doc_id", pd.array(np.where(c.null == 1, 0, c.doc), "Int64"))
        out.loc[c.null == 1, "doc_id"] = pd.NA
        return out

    kinds = "doc_id long, n_tokens long, loss_target double, loss_background double, score double"
    return parts.groupBy("chunk").cogroup(counts.groupBy("chunk")).applyInPandas(run, kinds)


def cross_entropy_difference(docs: DataFrame, target: DataFrame) -> DataFrame:
    """(doc_id, n_tokens, loss_target, loss_background, score), a row for each row of
    ``docs(doc_id, text)``; ``target(doc_id)`` names the documents of the target model.

    A null or blank text has no tokens and null losses. Rows with one doc_id are scored each on its
    own and count each in the models. Rows without doc_id belong to the background. No target (or no
    background): that model is uniform. Extra columns are ignored.
    """
    docs = marked(only(docs, doc_id="long", text="string"), target)
    words = written(word_counts(docs), "words")
    n = F.col("t") + F.col("b")
    one, rest = words.filter("h = 0").select("t", "b").first(), words.filter("h <> 0").withColumn("n", n)
    sums = rest.agg(F.sum("t"), F.sum("b"), F.count("*")).first()
    total = (sums[0] or 0, sums[1] or 0)
    most = COMMON if VOCABULARY is None else VOCABULARY
    top = rest.filter(F.col("n") >= least_count(rest, most)).toPandas()  # that many rows at most
    model = Model(top, total, (one[0], one[1]) if one else (0, 0), sums[2] if VOCABULARY is None else None)
    hot = hot_counts(docs, model).toPandas()  # HOT * HOT rows at most
    for m, c in enumerate(("t", "b")):
        model.hot[m] = np.zeros(HOT * HOT, np.int64)
        model.hot[m][hot["k"].to_numpy(np.int64)] = hot[c].to_numpy(np.int64)
    parts = chunks(docs, model)  # both uses read one shuffle
    return chunk_scores(parts, bucket_counts(postings(parts, model)), model).replace(float("nan"), None)


def op1_lm_scoring(spark, sf_dir: str) -> DataFrame:
    good = table(spark, sf_dir, "labels").filter("quality = 1 and toxic = 0").select(F.col("doc_id").cast("long"))
    return cross_entropy_difference(table(spark, sf_dir, "documents"), good)


QUERIES = {"op1_lm_scoring": op1_lm_scoring}
ORACLE_SQL: dict[str, str] = {}

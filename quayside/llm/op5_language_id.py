"""Language identification with string kernels.

The kernel of two texts is a blended spectrum: the n-grams of one to four characters that both
hold, each counted once (presence, not frequency), over the geometric mean of the two texts' own
numbers. Characters are lower-cased letters, anything between them is one space; n-grams are
hashed to 2**17 buckets.

A few texts of every language are landmarks. Nyström features of a text are its kernel values with
the landmarks, whitened by the landmarks' own kernel matrix; one-versus-rest kernel ridge
regression in that space gives one score a language. As kernel values with landmarks are products
with the landmarks' presence vectors, features, whitening and ridge weights multiply into one
matrix, buckets by languages, and a batch of texts is scored by products with it.

The classifier is fitted on a bounded sample of labelled rows: per language the ``SAMPLE`` rows
whose ids hash lowest, of which ``LANDMARKS`` are landmarks, for ``MAX_LANGUAGES`` at most. Where many languages would make that
more than ``SAMPLE_IN_ALL`` rows and ``LANDMARKS_IN_ALL`` landmarks, every language has an even share of these.
N-grams are taken on the executors, and the driver holds 16 KB at most of a sampled row however long its
text, one bit for each bucket and landmark, and the weights. Scoring reads every row and whole texts, in tasks, without a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import only, table

SAMPLE = 400  # labelled rows of each language
LANDMARKS = 100  # of these, landmarks
SAMPLE_IN_ALL, LANDMARKS_IN_ALL = 20_000, 2_000
MAX_LANGUAGES = 1000  # that are learned: those with the most labelled rows
BUCKET_BITS = 17
ORDERS = (1, 2, 3, 4)
RIDGE = 1e-3
PIECE = 1 << 20  # characters at a time
_N = 1 << BUCKET_BITS
_LETTER: list[np.ndarray] = []


def _letters() -> np.ndarray:
    """Of every code point: is it a letter?"""
    if not _LETTER:
        _LETTER.append(np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000))
    return _LETTER[0]


def presence(text: str | None) -> np.ndarray:
    """Sorted buckets of the text's n-grams; none if it has no letter. Long texts go in pieces that
    overlap, so every n-gram of the whole text counts."""
    if not text:
        return np.zeros(0, np.int64)
    code = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    letter = _letters()[code]
    if not letter.any():
        return np.zeros(0, np.int64)
    code = np.where(letter, code, np.uint32(32))
    keep = letter.copy()
    keep[1:] |= letter[:-1]  # one space after each run of letters
    code = np.concatenate((np.array([32], np.uint32), code[keep]))
    if code[-1] != 32:
        code = np.append(code, np.uint32(32))
    found = np.zeros(_N, bool) if len(code) > 20_000 else None
    lists = []
    for at in range(0, len(code), PIECE):
        c = code[at : at + PIECE + max(ORDERS) - 1]
        h = np.zeros(len(c), np.uint32)
        for n in range(1, max(ORDERS) + 1):
            if n > len(c):
                break
            h = (h[: len(c) - n + 1] + c[n - 1 :]) * np.uint32(0x9E3779B1)
            h ^= h >> np.uint32(15)
            if n in ORDERS:
                bucket = ((h + np.uint32(n)) * np.uint32(0x85EBCA6B)) >> np.uint32(32 - BUCKET_BITS)
                if found is None:
                    lists.append(bucket)
                else:
                    found[bucket] = True
    if found is not None:
        return np.flatnonzero(found)
    b = np.sort(np.concatenate(lists))
    return b[np.concatenate(([True], b[1:] != b[:-1]))].astype(np.int64)


def compact(buckets: np.ndarray) -> bytes:
    """Sorted buckets as 32-bit numbers, or as one bit each of all where that is no longer."""
    if 4 * len(buckets) < _N // 8:
        return buckets.astype(np.int32).tobytes()
    bits = np.zeros(_N, bool)
    bits[buckets] = True
    return np.packbits(bits).tobytes()


def listed(found: bytes) -> np.ndarray:
    """The buckets of ``compact``."""
    if len(found) < _N // 8:
        return np.frombuffer(found, np.int32)
    return np.flatnonzero(np.unpackbits(np.frombuffer(found, np.uint8)))


def shares(languages: int, sample: int = SAMPLE, landmarks: int = LANDMARKS) -> tuple[int, int]:
    """Rows and landmarks that each of so many languages gets."""
    return min(sample, max(2, SAMPLE_IN_ALL // max(languages, 1))), min(landmarks, max(2, LANDMARKS_IN_ALL // max(languages, 1)))


def fit(rows: list[tuple[str, bytes]], landmarks: int = LANDMARKS, ridge: float = RIDGE) -> tuple[list[str], np.ndarray, np.ndarray]:
    """(languages, weights buckets x languages, offset of each language) from labelled presences,
    each as ``compact`` gives it. Sums over rows are taken block by block."""
    langs = sorted({lang for lang, _ in rows})
    number = {lang: k for k, lang in enumerate(langs)}
    y = np.array([number[lang] for lang, _ in rows])
    chosen = np.concatenate([np.flatnonzero(y == k)[:landmarks] for k in range(len(langs))])
    bits = np.zeros((_N, (len(chosen) + 7) // 8), np.uint8)  # landmarks' presences: a bit each
    norm = np.zeros(len(chosen))
    for j, i in enumerate(chosen):
        b = listed(rows[i][1])
        bits[b, j // 8] |= np.uint8(128 >> j % 8)
        norm[j] = np.sqrt(len(b))

    def kernel(i: int) -> np.ndarray:
        """Of row i with every landmark."""
        b, met = listed(rows[i][1]), np.zeros(len(chosen), np.int64)
        for at in range(0, len(b), 2048):  # a few MB at a time
            met += np.unpackbits(bits[b[at : at + 2048]], axis=1, count=len(chosen)).sum(axis=0, dtype=np.uint16)
        return met / (norm * np.sqrt(len(b)))

    value, vector = np.linalg.eigh(np.stack([kernel(i) for i in chosen]))
    ok = value > 1e-8 * value[-1]
    whiten = vector[:, ok] / np.sqrt(value[ok])
    weight = (1 / np.bincount(y, minlength=len(langs)))[y] / len(langs)  # every language counts alike
    square, mean = np.zeros((whiten.shape[1],) * 2), np.zeros(whiten.shape[1])
    cross, aim = np.zeros((whiten.shape[1], len(langs))), np.zeros(len(langs))
    for at in range(0, len(rows), 1024):
        block = slice(at, at + 1024)
        phi = np.stack([kernel(i) for i in range(at, min(at + 1024, len(rows)))]) @ whiten
        target = np.where(y[block, None] == np.arange(len(langs)), 1.0, -1.0)
        weighted = phi * weight[block, None]
        square += phi.T @ weighted
        cross += weighted.T @ target
        mean += weighted.sum(axis=0)
        aim += weight[block] @ target
    beta = np.linalg.solve(square - np.outer(mean, mean) + ridge * np.eye(len(mean)), cross - np.outer(mean, aim))
    part = ((whiten @ beta) / norm[:, None]).astype(np.float32)
    weights = np.empty((_N, len(langs)), np.float32)
    for at in range(0, _N, 4096):
        weights[at : at + 4096] = np.unpackbits(bits[at : at + 4096], axis=1, count=len(chosen)).astype(np.float32) @ part
    return langs, weights, (aim - mean @ beta).astype(np.float32)


def scores(buckets: list[np.ndarray], weights: np.ndarray, offset: np.ndarray) -> np.ndarray:
    """Ridge scores of texts with at least one letter: a batch of sparse presence vectors, stored
    row after row, times the weights."""
    flat = np.concatenate(buckets)
    size = np.array([len(b) for b in buckets])
    begin = np.concatenate(([0], np.cumsum(size)[:-1]))
    sums = np.stack([np.add.reduceat(np.ascontiguousarray(w)[flat], begin) for w in weights.T], axis=1)
    return sums / np.sqrt(size)[:, None] + offset


def held_out() -> Column:
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2


def train(docs: DataFrame, sample: int = SAMPLE, landmarks: int = LANDMARKS) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Fit on a bounded sample of the rows of ``docs(doc_id, text, lang)`` that are not held out.

    Each task passes on the first ``sample`` ids of a language at most (a window group limit), so a
    language of a third of all rows costs no more than any other. Of more than ``MAX_LANGUAGES``
    languages the ones with the most labelled rows (ties: the first by name) are learned. Rows that
    share a doc_id and language each teach. Without labelled rows the model has no language.
    """
    usable = docs.filter(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}") & ~F.coalesce(held_out(), F.lit(False)))
    langs = [r["lang"] for r in usable.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(MAX_LANGUAGES).collect()]
    if not langs:
        return [], np.zeros((_N, 0), np.float32), np.zeros(0, np.float32)
    sample, landmarks = shares(len(langs), sample, landmarks)
    first = Window.partitionBy("lang").orderBy("h", "doc_id")
    known = docs.sparkSession.createDataFrame([(lang,) for lang in langs], "lang string")
    ids = usable.filter("doc_id is not null").join(F.broadcast(known), "lang").select("doc_id", "lang", F.xxhash64("doc_id").alias("h"))
    ids = ids.withColumn("rank", F.row_number().over(first)).filter(F.col("rank") <= sample)
    ids = ids.select("doc_id", F.col("lang").alias("picked")).distinct()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [compact(presence(t.as_py())) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays([batch.column("lang"), batch.column("doc_id"), pa.array(found, pa.binary())], ["lang", "doc_id", "found"])

    # at most sample * languages ids: a bounded broadcast
    picked = usable.join(F.broadcast(ids), "doc_id").filter("lang = picked").select("lang", "doc_id", "text")
    got = picked.mapInArrow(run, "lang string, doc_id long, found binary").toArrow().sort_by([("lang", "ascending"), ("doc_id", "ascending")])
    rows = [(lang.as_py(), b.as_buffer()) for lang, b in zip(got["lang"], got["found"], strict=True) if len(b.as_buffer())]
    if not rows:
        return [], np.zeros((_N, 0), np.float32), np.zeros(0, np.float32)
    return fit(rows, landmarks)


def predict(docs: DataFrame, model: tuple[list[str], np.ndarray, np.ndarray], keep_text: bool = False) -> DataFrame:
    """``docs`` with lang_pred and score, from text alone; the text itself stays only on demand.

    score is the share of the best language in a softmax of the ridge scores (0 to 1). A null text,
    one without letters, or a model without languages gives ``und`` and 0. Equal scores go to the
    first language in alphabetical order.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        langs, weights, offset = shared.value
        for batch in batches:
            texts = batch.column("text")
            lang, score = ["und"] * len(texts), np.zeros(len(texts))
            for at in range(0, len(texts), 256):
                found = [presence(texts[i].as_py()) for i in range(at, min(at + 256, len(texts)))]
                some = [i for i, b in enumerate(found) if len(b)] if langs else []
                if some:
                    s = scores([found[i] for i in some], weights, offset)
                    best = s.argmax(axis=1)
                    p = 1 / np.exp(4 * (s - s.max(axis=1, keepdims=True))).sum(axis=1)
                    for i, k, v in zip(some, best, p, strict=True):
                        lang[at + i] = langs[k]
                        score[at + i] = v
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in batch.schema.names if c != "text" or keep_text), pa.array(lang, pa.string()), pa.array(score)],
                [*(c for c in batch.schema.names if c != "text" or keep_text), "lang_pred", "score"],
            )

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema if f.name != "text" or keep_text]
    return docs.mapInArrow(run, ", ".join([*fields, "lang_pred string", "score double"]))


def language_id(docs: DataFrame) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) for every row; extra columns are ignored, repeated rows each
    give a row. held_out is null where doc_id is (such rows are never learned from)."""
    docs = only(docs, doc_id="long", text="string", lang="string")
    model = train(docs)
    return predict(docs.select("doc_id", held_out().alias("held_out"), "text"), model)


def op5_language_id(spark, sf_dir: str) -> DataFrame:
    return language_id(table(spark, sf_dir, "documents"))


QUERIES = {"op5_language_id": op5_language_id}
ORACLE_SQL: dict[str, str] = {}

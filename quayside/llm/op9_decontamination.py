"""Benchmark decontamination: SimHash of item-sized windows.

A document is contaminated by a benchmark item if one of its windows, as long in words as the item
(the whole document, if that is shorter), has a weighted shingle similarity of at least 0.75 with it.
Shingles are five words (lower-cased, ASCII signs dropped; an item of fewer words is one shingle,
found wherever a document has just these words in a row); a shingle weighs less the more items of
the whole benchmark hold it; the similarity is the cosine of the two weighted shingle sets, the
quantity that SimHash estimates.

*Windows.* All item-sized windows are looked up, but for those without any shingle of an item of
their length: their similarity is 0. Neighbouring windows share one running sum, so a window's
fingerprint costs the same whatever its length. *SimHash.* A fingerprint has 128 bits, the signs of
the weighted sums over the window's distinct shingles. *Multi-index.* Items of one length form an
index. Fingerprints are cut in 8 blocks of 16 bits. If two differ in at most ``RADIUS`` = 39 bits,
they differ in at most 4 bits of some block, so looking up every block's neighbours within 4 bits
finds every item within the radius. (At similarity 0.75 the expected distance is 29 bits with a
deviation of 5, so the radius is two deviations away; equal texts have distance 0.) A block of random
bits is within 4 bits with a chance of 4 %, so a window meets about a quarter of the items of its
length. *Verification.* The full distance, then the exact similarity decide.

Weights: ``1 + ln((1 + N) / (1 + df))`` of N items; counts of ``N / 1000`` and less weigh alike, as
one. So only shingles that more items hold are counted out to every task: at most 1,000 times an
item's mean number of shingles. Items are taken in blocks of bounded size; each is broadcast, and
documents are read once for each block, whole. Where there are several blocks, each one's result is
written before the next is gathered.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import U64, WordHasher, distinct_sorted, mix, only, shingle_hashes, spans, table, written

WIDTH = 5
SIMILARITY = 0.75
BITS, BLOCKS, NEAR = 128, 8, 4
RADIUS = BLOCKS * (NEAR + 1) - 1
ITEM_BLOCK = 20_000  # items in one broadcast
ITEM_BYTES = 32 << 20  # of text in one broadcast
COMMON_SHARE = 1000  # shingles of more than 1/1000 of the items weigh less
SCALE = 1024  # weights of fingerprints are whole numbers of 1/1024: sums are exact
RUN = 2048  # windows that share one running sum
DIRECT = 4096  # an index of fewer items is compared block by block, not by tables
MASKS = np.array([sum(1 << b for b in bits) for n in range(NEAR + 1) for bits in combinations(range(16), n)], np.uint16)


def shingle_bits(shingles: np.ndarray) -> np.ndarray:
    """+1/-1 for each of the 128 bits of each shingle."""
    halves = np.stack((shingles, mix(shingles ^ U64(0x5851F42D4C957F2D))), axis=1)
    return np.unpackbits(halves.view(np.uint8), axis=1).astype(np.int64) * 2 - 1


def text_words(hasher: WordHasher, text: str | None) -> np.ndarray:
    return hasher((text or "").lower())


class Weights:
    """Of ``total`` items; ``common``: sorted shingles that many items hold, and how many do."""

    def __init__(self, total: int, common: tuple[np.ndarray, np.ndarray]):
        self.key, df = common
        self.weight = 1 + np.log((1 + total) / (1 + df))
        self.rare = float(1 + np.log((1 + total) / 2))

    def __call__(self, shingles: np.ndarray) -> np.ndarray:
        if not len(self.key):
            return np.full(len(shingles), self.rare)
        i = np.minimum(np.searchsorted(self.key, shingles), len(self.key) - 1)
        return np.where(self.key[i] == shingles, self.weight[i], self.rare)

    def print_of(self, shingles: np.ndarray) -> np.ndarray:
        """128 bits, as 8 numbers, of distinct shingles."""
        sums = np.rint(self(shingles) * SCALE).astype(np.int64) @ shingle_bits(shingles)
        return np.packbits(sums > 0).view(np.uint16)


def item_tables(rows: list[tuple[int, str]], weights: Weights) -> dict[str, np.ndarray]:
    """Items as plain arrays: ids, lengths in words, fingerprints, distinct shingles with their
    bounds, and for each known shingle the lengths of its items."""
    hasher = WordHasher(plain=True)
    words = [(i, h) for i, t in sorted((i, t) for i, t in rows if i is not None and t) if len(h := text_words(hasher, t))]
    sets = [distinct_sorted(shingle_hashes(h, WIDTH)) for _, h in words]
    flat = np.concatenate([np.zeros(0, U64), *sets])
    length = np.array([len(h) for _, h in words], np.int64)
    pairs = np.unique(np.stack((flat, np.repeat(length, [len(s) for s in sets]).astype(U64))), axis=1) if len(flat) else np.zeros((2, 0), U64)
    begin, end = spans(pairs[0])
    return {
        "ids": np.array([i for i, _ in words], np.int64), "words": length, "flat": flat, "bounds": np.cumsum([0, *[len(s) for s in sets]]),
        "prints": np.stack([weights.print_of(s) for s in sets]) if sets else np.zeros((0, BLOCKS), np.uint16),
        "known": pairs[0][begin], "from": begin, "to": end, "lengths": pairs[1].astype(np.int64),
    }


class Items:
    """Look-ups in the tables of a block of items."""

    def __init__(self, tables: dict[str, np.ndarray], weights: Weights):
        self.t, self.weights = tables, weights
        self.of_length = {int(n): np.flatnonzero(tables["words"] == n) for n in np.unique(tables["words"])}
        self.short = [n for n in self.of_length if n < WIDTH]
        self.sorted: dict[int, list] = {}

    def shingles_of(self, item: int) -> np.ndarray:
        return self.t["flat"][self.t["bounds"][item] : self.t["bounds"][item + 1]]

    def matches(self, hashes: np.ndarray) -> dict[int, tuple[float, int, int]]:
        """item -> (similarity, first word, distance) of the best window of a document's words."""
        best: dict[int, tuple[float, int, int]] = {}
        for length, shingles, starts, size in self.windows(hashes):
            for begin, prints in self.prints(shingles, starts, size):
                for w, item, far in zip(*self.close(length, prints), strict=True):
                    start = begin + w
                    sim = self.similarity(distinct_sorted(shingles[start : start + size]), item)
                    if sim >= SIMILARITY - 1e-12 and (item not in best or (sim, -start) > (best[item][0], -best[item][1])):
                        best[item] = (sim, start, far)
        return best

    def windows(self, hashes: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray, int]]:
        """(length, the document's shingles, first shingles, shingles of a window): all windows as long
        as some item that hold a shingle of an item of this length."""
        if not len(hashes) or not len(self.t["known"]):
            return
        for width in (WIDTH, *self.short):  # a document of so many words is one shingle of its own width
            if width < WIDTH and width >= len(hashes):
                continue
            shingles = shingle_hashes(hashes, width)
            i = np.minimum(np.searchsorted(self.t["known"], shingles), len(self.t["known"]) - 1)
            hits = np.flatnonzero(self.t["known"][i] == shingles)
            if not len(hits):
                continue
            size = self.t["to"][i[hits]] - self.t["from"][i[hits]]
            at = np.repeat(hits, size)
            which = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size) + np.repeat(self.t["from"][i[hits]], size)
            lengths = self.t["lengths"][which]
            for length in np.unique(lengths).tolist():
                count = min(len(shingles), max(1, length - width + 1))
                p = at[lengths == length]
                marks = np.zeros(len(shingles) + 1, np.int64)
                np.add.at(marks, np.maximum(0, p - count + 1), 1)
                np.add.at(marks, np.minimum(p, len(shingles) - count) + 1, -1)
                yield length, shingles, np.flatnonzero(np.cumsum(marks) > 0), count

    def prints(self, shingles: np.ndarray, starts: np.ndarray, size: int) -> Iterator[tuple[int, np.ndarray]]:
        """(first start, fingerprints) of the windows at runs of neighbouring starts."""
        cut = np.flatnonzero(np.diff(starts) > 1) + 1
        for run in np.split(starts, cut):
            for k in range(0, len(run), RUN):
                own = run[k : k + RUN]
                part = shingles[own[0] : own[-1] + size]
                weight = np.rint(self.weights(part) * SCALE).astype(np.int64)
                sums = np.zeros((len(part) + 1, BITS), np.int64)
                np.cumsum(weight[:, None] * shingle_bits(part), axis=0, out=sums[1:])
                out = np.packbits(sums[size:] - sums[: len(own)] > 0, axis=1).view(np.uint16)
                # a window that has a shingle twice is summed on its own, over its distinct shingles
                order = np.argsort(part, kind="stable")
                again = np.flatnonzero(part[order][1:] == part[order][:-1])
                if len(again):
                    first, second = order[again], order[again + 1]
                    near = second - first < size
                    marks = np.zeros(len(own) + size + 1, np.int64)
                    np.add.at(marks, np.maximum(0, second[near] - size + 1), 1)
                    np.add.at(marks, np.minimum(first[near], len(own) - 1) + 1, -1)
                    for w in np.flatnonzero(np.cumsum(marks)[: len(own)] > 0).tolist():
                        out[w] = self.weights.print_of(distinct_sorted(part[w : w + size]))
                yield int(own[0]), out

    def met(self, length: int, prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(window, item) pairs of which some block differs in at most ``NEAR`` bits."""
        own = self.of_length[length]
        mine = self.t["prints"][own]
        if len(own) < DIRECT:
            near = (np.bitwise_count(prints[:, None, :] ^ mine[None]) <= NEAR).any(axis=2)
            w, j = np.nonzero(near)
            return w, own[j]
        if length not in self.sorted:
            order = np.argsort(mine, axis=0, kind="stable")
            self.sorted[length] = [(np.ascontiguousarray(order[:, b]), mine[order[:, b], b]) for b in range(BLOCKS)]
        found = []
        for b, (order, values) in enumerate(self.sorted[length]):
            wanted = prints[:, b, None] ^ MASKS[None]
            lo, hi = (np.searchsorted(values, wanted, side=s) for s in ("left", "right"))
            n = (hi - lo).ravel()
            at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(lo.ravel(), n)
            found.append(np.repeat(np.arange(len(prints)), (hi - lo).sum(axis=1)) * len(own) + order[at])
        both = np.unique(np.concatenate(found))
        return both // len(own), own[both % len(own)]

    def close(self, length: int, prints: np.ndarray) -> tuple[list[int], list[int], list[int]]:
        """(window, item, distance) of the items within the radius."""
        out = ([], [], [])
        step = max(1, 4_000_000 // max(1, len(self.of_length[length])))
        for k in range(0, len(prints), step):
            w, j = self.met(length, prints[k : k + step])
            far = np.bitwise_count(prints[k + w] ^ self.t["prints"][j]).sum(axis=1, dtype=np.int64)
            ok = far <= RADIUS
            for held, x in zip(out, (w[ok] + k, j[ok], far[ok]), strict=True):
                held += x.tolist()
        return out

    def similarity(self, window: np.ndarray, item: int) -> float:
        own = self.shingles_of(item)
        w = self.weights(window) ** 2
        both = float(w[np.isin(window, own, assume_unique=True)].sum())
        return both / float(np.sqrt(w.sum() * (self.weights(own) ** 2).sum())) if both else 0.0


def item_blocks(items: DataFrame) -> Iterator[list[tuple[int, str]]]:
    """The items in blocks of bounded number and bytes, one block in the driver at a time."""
    held, size = [], 0
    for row in items.toLocalIterator():
        held.append((row["item_id"], row["text"]))
        size += len(row["text"])
        if len(held) >= ITEM_BLOCK or size >= ITEM_BYTES:
            yield held
            held, size = [], 0
    if held:
        yield held


def item_weights(items: DataFrame) -> tuple[int, tuple[np.ndarray, np.ndarray]]:
    """The number of items with words, and the shingles that more than 1/1000 of them (and more than
    one) hold, with counts: over the whole benchmark."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = WordHasher(plain=True)
        for batch in batches:
            held = [distinct_sorted(shingle_hashes(text_words(hasher, t.as_py()), WIDTH)) for t in batch.column("text")]
            first = np.concatenate([np.zeros(0, bool), *(np.arange(len(x)) == 0 for x in held)])
            h = np.concatenate([np.zeros(0, U64), *held]).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(h), pa.array(first)], ["h", "first"])

    counts = written(items.select("text").mapInArrow(run, "h long, first boolean").groupBy("h").agg(F.count("*").alias("df"), F.count_if("first").alias("n")), "counts")
    total = counts.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    got = counts.filter(F.col("df") > max(1, total // COMMON_SHARE)).toPandas()
    h, df = got["h"].to_numpy(np.int64).astype(U64), got["df"].to_numpy(np.int64)
    order = np.argsort(h)
    return total, (h[order], df[order])


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, item_id, first_word, n_words, distance, similarity): a row for each document and
    item that match, with the most similar window (ties: the first).

    Null or empty texts and items match nothing; rows of one doc_id each give their own rows; equal
    items each match. An empty benchmark or corpus gives an empty result. Weights are those of the
    whole benchmark, whatever its blocks. A very long text is held by one task, its windows in runs.
    """
    docs = only(docs, doc_id="long", text="string")
    schema = "doc_id long, item_id long, first_word long, n_words long, distance int, similarity double"
    spark, parts = docs.sparkSession, []
    items = only(benchmark, item_id="long", text="string").filter("item_id is not null and text is not null")
    n, size = items.agg(F.count("*"), F.coalesce(F.sum(F.length("text")), F.lit(0))).first()
    several = n > ITEM_BLOCK or size > ITEM_BYTES
    total, common = item_weights(items)
    for rows in item_blocks(items):
        shared = spark.sparkContext.broadcast((item_tables(rows, Weights(total, common)), total, common))

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            tables, total, common = shared.value
            items, hasher = Items(tables, Weights(total, common)), WordHasher(plain=True)
            for batch in batches:
                found = []
                for doc, text in zip(batch.column("doc_id"), batch.column("text"), strict=True):
                    got = items.matches(text_words(hasher, text.as_py()))
                    found += [(doc.as_py(), int(tables["ids"][j]), s, int(tables["words"][j]), d, round(sim, 6)) for j, (sim, s, d) in sorted(got.items())]
                cols = list(zip(*found, strict=True)) if found else [[]] * 6
                kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.float64())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(cols, kinds, strict=True)],
                    ["doc_id", "item_id", "first_word", "n_words", "distance", "similarity"],
                )

        part = docs.mapInArrow(run, schema)
        if several:
            part = written(part, "leaks")
            shared.unpersist()
        parts.append(part)
    out = spark.createDataFrame([], schema)
    for part in parts:
        out = part if len(parts) == 1 else out.union(part)
    return out


def op9_decontamination(spark, sf_dir: str) -> DataFrame:
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES = {"op9_decontamination": op9_decontamination}
ORACLE_SQL: dict[str, str] = {}

"""Ranked lexical search over document FP-trees, by branch and bound.

Every item ranks all documents. A term's weight is ``w = floor(1000 * ln((2N + 2) / (2df + 1)))``, a document's
``m = 50 + (50 * n * N) div L`` grows with its length, and its score is the sum, over the item's terms, of
``w * f(tf, m)`` with ``f = (10**9 * tf) div (1000 * tf + 20 * m)``.

*Restricted vectors.* One pass over the whole texts keeps, of each document, its number of terms and the
counts of the items' terms, and writes them. N, L and df come from that table.

*FP-trees.* A task takes restricted vectors in chunks. Terms stand in order of df, the most frequent
first, so that sorted vectors share the paths of a trie; a subtree is a run of the sorted chunk. A
subtree that has over half of the documents above it is not a node of its own (its subtrees hang
directly on the node above), and neighbouring small ones make up leaves of ``LEAF`` documents, so the
tree has few nodes and few levels.

*Branch and bound.* f grows with tf and falls with m. A node keeps the largest tf of each term below it and
the least m, so ``sum of w * f(largest tf, least m)`` over the item's terms is no less than any score
below. Each item goes depth first through the subtree of the largest bound; a subtree below the
item's 50th score so far is left, the leaves that remain are scored exactly. Bounds and scores are
whole numbers, and an equal bound is followed, so ties are right.

The 50 best of each chunk are ranked together, first in ``SALTS`` parts an item. Items are broadcast in
blocks of ``ITEM_BLOCK`` or ``ITEM_CHARS``; documents are read once for each block.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import discard, only, spans, table, written
from .tokens import ranges

BEST = 50
LEAF = 16  # documents of a leaf
CHUNK_DOCS, CHUNK_ENTRIES, CHUNK_CELLS = 65_536, 2_000_000, 4_000_000  # of a tree: documents, their terms, nodes x terms
ITEM_BLOCK, ITEM_CHARS = 10_000, 4 << 20  # items, and their text, in one broadcast
SALTS = 64

#: All ASCII signs but letters and digits become spaces, A-Z become a-z.
PLAIN = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))


def terms_of(text: str | None) -> list[bytes]:
    """The maximal runs of ASCII letters and digits and of all other signs beyond ASCII, with repeats."""
    return text.encode("utf-8", "surrogatepass").translate(PLAIN).split() if text else []


def factor(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    return 1_000_000_000 * tf // (1000 * tf + 20 * m)


def restricted(docs: DataFrame, terms: dict[bytes, int]) -> DataFrame:
    """(doc_id, n, terms, tfs): each document with terms, its number of them, and those of ``terms`` with counts."""
    shared = docs.sparkSession.sparkContext.broadcast(terms)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            ids, ns, sizes, held, counts = [], [], [], [], []
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
                words = terms_of(text.as_py())
                if not words:
                    continue
                t, c = np.unique(np.array([known[w] for w in words if w in known], np.int32), return_counts=True)
                ids.append(doc)
                ns.append(len(words))
                sizes.append(len(t))
                held.append(t)
                counts.append(c.astype(np.int32))
            at = pa.array(np.cumsum([0, *sizes]), pa.int32())
            both = [pa.ListArray.from_arrays(at, pa.array(np.concatenate(x) if x else np.zeros(0, np.int32), pa.int32())) for x in (held, counts)]
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(ns, pa.int64()), *both], ["doc_id", "n", "terms", "tfs"])

    return docs.mapInArrow(run, "doc_id long, n long, terms array<int>, tfs array<int>")


class Tree:
    """An FP-tree of documents given by their terms (places in the order of frequency, ascending in each
    document), counts, bounds of their entries and m."""

    def __init__(self, term: np.ndarray, tf: np.ndarray, at: np.ndarray, m: np.ndarray, n_terms: int):
        size = np.diff(at)
        big = term.astype(">u4")
        keys = [big[i:j].tobytes() for i, j in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]
        self.order = np.array(sorted(range(len(keys)), key=keys.__getitem__), np.int64)
        self.keys = [keys[i] for i in self.order.tolist()]
        entry = ranges(at[:-1][self.order], size[self.order])
        self.size, self.m = size[self.order], m[self.order]
        self.at = np.concatenate(([0], np.cumsum(self.size)))
        self.term, self.tf = term[entry], tf[entry].astype(np.int64)
        self.f = factor(self.tf, np.repeat(self.m, self.size))
        self._grow()
        self._sum_up(n_terms)

    def _below(self, lo: int, hi: int) -> list[tuple[int, int, bool]]:
        """The subtrees of a node, in order: (first document, end, whether it is a leaf)."""
        half, found, todo = (hi - lo) // 2, [], [(lo, hi, 0)]
        while todo:
            a, b, depth = todo.pop()
            first, last = self.keys[a], self.keys[b - 1]
            while depth < len(first) and first[depth : depth + 4] == last[depth : depth + 4]:
                depth += 4
            depth //= 4
            if depth == self.size[b - 1]:  # equal vectors
                found += [(i, min(i + LEAF, b), True) for i in range(a, b, LEAF)]
                continue
            own = self.at[a:b] + depth
            step = np.where(self.size[a:b] > depth, self.term[np.minimum(own, len(self.term) - 1)], -1)
            for i, j in zip(*spans(step), strict=True):
                i, j = int(i) + a, int(j) + a
                if j - i > max(half, LEAF):
                    todo.append((i, j, 4 * depth))
                else:
                    found.append((i, j, j - i <= LEAF))
        out: list[tuple[int, int, bool]] = []
        for i, j, leaf in sorted(found):
            if leaf and out and out[-1][2] and j - out[-1][0] <= LEAF:
                out[-1] = (out[-1][0], j, True)
            else:
                out.append((i, j, leaf))
        return out

    def _grow(self) -> None:
        """Nodes in order of level: the children of a node are neighbours. The root is no leaf."""
        lo, hi, leaf, child = [0], [len(self.keys)], [False], []
        for v in iter(range(1 << 62)):
            if v == len(lo):
                break
            if leaf[v]:
                child.append((0, 0))
                continue
            below = self._below(lo[v], hi[v])
            child.append((len(lo), len(lo) + len(below)))
            for i, j, x in below:
                lo.append(i)
                hi.append(j)
                leaf.append(x)
        self.lo, self.hi, self.leaf, self.child = np.array(lo), np.array(hi), np.array(leaf), child

    def _sum_up(self, n_terms: int) -> None:
        """bound[t, v]: f of the largest count of term t below node v and the least m there."""
        most, least = np.zeros((n_terms, len(self.lo)), np.int64), np.full(len(self.lo), np.iinfo(np.int64).max)
        for v in range(len(self.lo) - 1, -1, -1):
            a, b = self.child[v]
            if self.leaf[v]:
                i, j = self.at[self.lo[v]], self.at[self.hi[v]]
                own = np.zeros(n_terms, np.int64)
                np.maximum.at(own, self.term[i:j], self.tf[i:j])
                most[:, v], least[v] = own, self.m[self.lo[v] : self.hi[v]].min()
            else:
                most[:, v], least[v] = most[:, a:b].max(axis=1), least[a:b].min()
        self.bound = factor(most, least[None])

    def search(self, terms: np.ndarray, weight: np.ndarray, doc_id: np.ndarray, best: int = BEST) -> tuple[np.ndarray, np.ndarray]:
        """(places of documents, scores) of the ``best`` documents with a score above 0; doc_id breaks ties."""
        w = np.zeros(len(self.bound), np.int64)
        w[terms] = weight
        found, score, floor = np.zeros(0, np.int64), np.zeros(0, np.int64), 1
        todo = [(floor, 0)]
        while todo:
            upper, v = todo.pop()
            if upper < floor:
                continue
            a, b = self.child[v]
            upper = weight @ self.bound[terms, a:b]
            order = np.argsort(-upper, kind="stable")
            order = order[upper[order] >= floor]
            leaf = self.leaf[a:b][order]
            for x in order[~leaf][::-1].tolist():
                todo.append((int(upper[x]), a + x))
            some = order[leaf]
            for k in range(0, len(some), 8):
                some_now = [a + x for x in some[k : k + 8].tolist() if upper[x] >= floor]
                if not some_now:
                    break
                docs = np.concatenate([np.arange(self.lo[x], self.hi[x]) for x in some_now])
                entry = ranges(self.at[docs], self.size[docs])
                parts = np.concatenate(([0], np.cumsum(w[self.term[entry]] * self.f[entry])))
                ends = np.cumsum(self.size[docs])
                own = parts[ends] - parts[ends - self.size[docs]]
                good = own >= floor
                found, score = np.concatenate((found, docs[good])), np.concatenate((score, own[good]))
                if len(found) > best:
                    top = np.lexsort((doc_id[self.order[found]], -score))[:best]
                    found, score = found[top], score[top]
                    floor = int(score[-1])
        return self.order[found], score


def searched(vectors: DataFrame, shared) -> DataFrame:
    """(item, part, doc_id, score): the best documents of each chunk for each item."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, n_terms, items, total, length = shared.value
        most = min(CHUNK_DOCS, max(256, CHUNK_CELLS // max(1, n_terms) * LEAF // 2))
        part, held, rows, entries = TaskContext.get().partitionId() % SALTS, [], 0, 0

        def done() -> pa.RecordBatch:
            doc_null = np.concatenate([b.column("doc_id").is_null().to_numpy(zero_copy_only=False) for b in held])
            doc = np.concatenate([b.column("doc_id").fill_null(np.iinfo(np.int64).max).to_numpy() for b in held])
            m = np.array([50 + 50 * n * total // length for b in held for n in b.column("n").to_pylist()], np.int64)
            size = np.concatenate([b.column("terms").value_lengths().to_numpy() for b in held]).astype(np.int64)
            term = place[np.concatenate([b.column("terms").flatten().to_numpy() for b in held])]
            tf = np.concatenate([b.column("tfs").flatten().to_numpy() for b in held])
            order = np.lexsort((term, np.repeat(np.arange(len(size)), size)))
            tree = Tree(term[order], tf[order], np.concatenate(([0], np.cumsum(size))), m, n_terms)
            got = [tree.search(terms, weight, doc) for terms, weight in items]
            which = np.concatenate([x for x, _ in got]) if got else np.zeros(0, np.int64)
            score = np.concatenate([s for _, s in got]) if got else np.zeros(0, np.int64)
            item = np.repeat(np.arange(len(items)), [len(x) for x, _ in got])
            ids = pa.array(doc[which], pa.int64(), mask=doc_null[which])
            return pa.RecordBatch.from_arrays([pa.array(item, pa.int32()), pa.array(np.full(len(item), part), pa.int32()), ids, pa.array(score, pa.int64())], ["item", "part", "doc_id", "score"])

        for whole in batches:
            for i in range(0, len(whole), 256):
                batch = whole.slice(i, 256)
                held.append(batch)
                rows += len(batch)
                entries += len(batch.column("terms").flatten())
                if rows >= most or entries >= CHUNK_ENTRIES:
                    yield done()
                    held, rows, entries = [], 0, 0
        if rows:
            yield done()

    return vectors.mapInArrow(run, "item int, part int, doc_id long, score long")


def best_of(rows: DataFrame, *keys: str, rank: str = "rank") -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    return rows.withColumn(rank, F.row_number().over(order)).filter(F.col(rank) <= BEST)


def item_blocks(items: DataFrame) -> Iterator[list[tuple[int | None, str]]]:
    """The items in blocks of bounded number and text, one block in the driver at a time."""
    held, size = [], 0
    for row in items.toLocalIterator():
        held.append((row["item_id"], row["text"]))
        size += len(row["text"])
        if len(held) >= ITEM_BLOCK or size >= ITEM_CHARS:
            yield held
            held, size = [], 0
    if held:
        yield held


def ranked(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(item_id, rank, doc_id, score): for each item of ``benchmark(item_id, text)`` its ``BEST`` best of
    ``docs(doc_id, text)``, all that score above 0 if these are fewer.

    Null and empty texts, and texts without terms, are no documents and match nothing; such items give no
    rows. Items that share an item_id are ranked each on their own, and so are rows that share a
    doc_id; a null doc_id comes after others of its score. Equal scores go by ascending doc_id. Extra
    columns are ignored; an empty table on either side gives no rows.
    """
    docs, items = only(docs, doc_id="long", text="string"), only(benchmark, item_id="long", text="string").filter("text is not null")
    spark, out = docs.sparkSession, []
    for rows in item_blocks(items):
        wanted = [set(terms_of(text)) for _, text in rows]
        known = {t: i for i, t in enumerate(sorted(set().union(*wanted)))}
        vectors = written(restricted(docs, known), "vectors")
        total, length = vectors.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
        df = np.zeros(len(known), np.int64)
        for r in vectors.select(F.explode("terms").alias("t")).groupBy("t").count().collect():  # as many rows as the block has terms
            df[r["t"]] = r["count"]
        order = np.argsort(-df, kind="stable")[: int((df > 0).sum())]
        place = np.full(len(df), -1, np.int32)
        place[order] = np.arange(len(order))
        weight = np.array([math.floor(1000 * math.log((2 * total + 2) / (2 * d + 1))) for d in df[order].tolist()], np.int64)
        terms = [np.sort(place[[known[t] for t in own]]) if own else np.zeros(0, np.int32) for own in wanted]
        terms = [t[t >= 0] for t in terms]
        shared = spark.sparkContext.broadcast((place, len(order), [(t, weight[t]) for t in terms], total, length))
        best = best_of(best_of(searched(vectors.filter(F.size("terms") > 0), shared), "item", "part").drop("rank"), "item")
        ids = spark.createDataFrame([(i, item_id) for i, (item_id, _) in enumerate(rows)], "item int, item_id long")
        out.append(written(best.join(F.broadcast(ids), "item").select("item_id", "rank", "doc_id", "score"), "ranked"))
        discard(vectors)
        shared.unpersist()
    found = spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    for part in out:
        found = part if len(out) == 1 else found.union(part)
    return found


def op13_lexical_search(spark, sf_dir: str) -> DataFrame:
    return ranked(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES = {"op13_lexical_search": op13_lexical_search}

ORACLE_SQL = {
    "op13_lexical_search": r"""
WITH term AS (
  SELECT doc_id, unnest(list_filter(string_split_regex(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'), lambda x: x <> '')) AS t
  FROM documents),
wanted AS (
  SELECT DISTINCT item_id, unnest(list_filter(string_split_regex(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'), lambda x: x <> '')) AS t
  FROM benchmark),
tf AS (SELECT doc_id, t, count(*) AS tf FROM term GROUP BY ALL),
n AS (SELECT doc_id, CAST(sum(tf) AS BIGINT) AS n FROM tf GROUP BY 1),
s AS (SELECT count(*) AS total, CAST(sum(n) AS BIGINT) AS length FROM n),
w AS (SELECT t, CAST(floor(1000 * ln((2 * total + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE)) AS BIGINT) AS w FROM tf, s GROUP BY t, total),
m AS (SELECT doc_id, 100 - 50 + ((50 * n * total) // length) AS m FROM n, s),
score AS (
  SELECT item_id, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * m))) AS BIGINT) AS score
  FROM wanted JOIN tf USING (t) JOIN w USING (t) JOIN m USING (doc_id) GROUP BY ALL),
ranked AS (SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INT) AS rank, doc_id, score FROM score WHERE score > 0)
SELECT * FROM ranked WHERE rank <= 50
"""
}

"""Exact top-k search by multi-resolution segment statistics.

Vectors are cut into segments, at several resolutions. With means ``m`` and deviations ``s`` of the
segments (of ``l`` components), the squared distance of two vectors is at least
``sum l * ((m - m')**2 + (s - s')**2)``. Candidates are held against that bound from coarse to fine;
exact distances are computed for the survivors only. The score here is the inner product, which
is ``(|q|**2 + |c|**2 - distance**2) / 2``, so a lower bound of the distance is an upper bound of
the score, and a candidate survives a level if that bound reaches the query's k-th best score so
far.

Vectors are read and quantised once, and written. Queries go in blocks of at most ``QUERY_BLOCK``, dealt by a hash, each
broadcast; the written candidates are read once for each block, and stay where they are. A task compares ``ASKED`` of a block
with ``ROWS`` candidates at a time and keeps k rows a query; only these are shuffled and ranked.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import only, table, written

SEGMENTS = (4, 16)  # at each level, coarse to fine
QUERY_BLOCK = 65_536  # queries in one broadcast: 32 MB at 64 components
ASKED, ROWS = 2048, 2048  # in one product


def quantised(vectors: DataFrame, scale: int = 256) -> DataFrame:
    """(vec_id, v): floor(scale * x) of each component; rows with a null id, vector or component, or
    a non-finite component are left out."""
    v = only(vectors, vec_id="long", embedding="array<double>")
    fine = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    v = v.filter(F.col("vec_id").isNotNull() & F.forall("embedding", fine))
    return v.select("vec_id", F.transform("embedding", lambda x: F.floor(x * scale)).alias("v"))


def segment_stats(x: np.ndarray, segments: int) -> np.ndarray:
    """Means and deviations, each times the root of its segment's length: products of two such
    rows bound the inner product of the vectors from above."""
    cut = np.linspace(0, x.shape[1], min(segments, x.shape[1]) + 1).astype(int)
    size = np.diff(cut)
    mean = np.add.reduceat(x, cut[:-1], axis=1) / size
    square = np.add.reduceat(x * x, cut[:-1], axis=1) / size
    dev = np.sqrt(np.maximum(0, square - mean * mean))
    return np.concatenate((mean, dev), axis=1) * np.sqrt(np.concatenate((size, size)))


class Search:
    """The k best candidates of each query, as batches of candidates come by."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, k: int):
        vectors = vectors if vectors.shape[1] else np.zeros((len(ids), 1), np.int64)  # products of empty vectors are 0
        self.ids, self.q, self.k = ids, vectors, k
        self.stats = [segment_stats(vectors.astype(np.float64), s) for s in SEGMENTS]
        self.norm = np.sqrt((vectors.astype(np.float64) ** 2).sum(axis=1))
        self.best = [np.zeros((0, 2), np.int64) for _ in ids]  # (score, vec_id)
        self.least = np.full(len(ids), -np.inf)  # the k-th best score so far
        self.compared = self.exact = 0

    def add(self, ids: np.ndarray, vectors: np.ndarray) -> None:
        vectors = vectors if vectors.shape[1] else np.zeros((len(ids), 1), np.int64)
        c = vectors.astype(np.float64)
        norm = np.sqrt((c * c).sum(axis=1))
        slack = 1e-9 * (self.norm[:, None] * norm[None, :]) + 1e-6  # of rounding
        live = self.ids[:, None] != ids[None, :]
        self.compared += live.size
        for stats, segments in zip(self.stats, SEGMENTS, strict=True):
            mine = segment_stats(c, segments)
            if live.mean() > 0.25:  # most pairs are alive: one product is cheaper than picking
                bound = stats @ mine.T
                live &= bound + slack >= self.least[:, None]
            else:
                i, j = np.nonzero(live)
                bound = np.einsum("ij,ij->i", stats[i], mine[j])
                live[i, j] = bound + slack[i, j] >= self.least[i]
        i, j = np.nonzero(live)
        self.exact += len(i)
        if not len(i):
            return
        top = float(np.abs(c).max()) * float(np.abs(self.q).max()) * c.shape[1]
        if top >= 2**52:  # floats would round
            score = np.einsum("ij,ij->i", self.q[i], vectors[j])
        elif live.mean() > 0.25:
            score = (self.q.astype(np.float64) @ c.T)[i, j].astype(np.int64)
        else:
            score = np.einsum("ij,ij->i", self.q[i].astype(np.float64), c[j]).astype(np.int64)
        keep = score >= self.least[i]
        i, found = i[keep], np.stack((score[keep], ids[j[keep]]), axis=1)
        begin = np.searchsorted(i, np.arange(len(self.ids) + 1))
        for n in np.unique(i).tolist():
            rows = np.concatenate((self.best[n], found[begin[n] : begin[n + 1]]))
            rows = rows[np.lexsort((rows[:, 1], -rows[:, 0]))[: self.k]]
            self.best[n] = rows
            if len(rows) == self.k:
                self.least[n] = rows[-1, 0]


def top_k(queries: DataFrame, candidates: DataFrame, k: int = 5) -> DataFrame:
    """(query_id, rank, vec_id, score) from two frames of ``quantised``.

    A row is never its own query's candidate (nor is any other row with that vec_id). Ties go to
    the smaller vec_id; repeated candidate rows each count; a repeated query id is asked
    once, with the least of its vectors. Where queries take several blocks, one block is in the driver
    and on the executors at a time, and its result is written.
    Vectors meet only vectors of their own length (empty ones meet with a score of 0). Empty inputs give an empty result.
    """
    spark = candidates.sparkSession
    queries = written(queries.groupBy("vec_id").agg(F.min("v").alias("v")), "queries")
    blocks = math.ceil(queries.count() / QUERY_BLOCK)
    if blocks > 1:
        candidates = written(candidates, "candidates")
    schema = "query_id long, vec_id long, score long"
    parts = []
    for b in range(blocks):
        rows = queries.filter(F.pmod(F.xxhash64("vec_id"), F.lit(blocks)) == b).toArrow()
        by_size: dict[int, list[int]] = {}
        ids, vectors = rows["vec_id"].to_numpy(), rows["v"].to_pylist()
        for n, v in enumerate(vectors):
            by_size.setdefault(len(v), []).append(n)
        shared = spark.sparkContext.broadcast({d: (ids[at], np.array([vectors[n] for n in at], np.int64).reshape(len(at), d)) for d, at in by_size.items()})

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            search = {d: [Search(i[lo : lo + ASKED], v[lo : lo + ASKED], k) for lo in range(0, len(i), ASKED)] for d, (i, v) in shared.value.items()}
            for batch in batches:
                ids, column = batch.column("vec_id").to_numpy(), batch.column("v")
                size = np.diff(column.offsets.to_numpy())
                flat = column.flatten().to_numpy()
                first = np.concatenate(([0], np.cumsum(size)[:-1]))
                for d in np.unique(size).tolist():
                    if d not in search:
                        continue
                    at = np.flatnonzero(size == d)
                    for lo in range(0, len(at), ROWS):
                        some = at[lo : lo + ROWS]
                        vectors = flat[first[some][:, None] + np.arange(d)]
                        for s in search[d]:
                            s.add(ids[some], vectors)
            for s in (s for own in search.values() for s in own):
                n = [len(x) for x in s.best]
                rows = np.concatenate(s.best) if s.best else np.zeros((0, 2), np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.repeat(s.ids, n)), pa.array(rows[:, 1]), pa.array(rows[:, 0])], ["query_id", "vec_id", "score"]
                )

        part = candidates.mapInArrow(run, schema)
        if blocks > 1:
            part = written(part, "found")
            shared.unpersist()
        parts.append(part)
    out = parts[0] if parts else spark.createDataFrame([], schema)
    for p in parts[1:]:
        out = out.union(p)
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = out.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def op3_topk_search(spark, sf_dir: str) -> DataFrame:
    vectors = quantised(table(spark, sf_dir, "embeddings"))
    return top_k(vectors.filter("vec_id % 50 = 0"), vectors)


QUERIES = {"op3_topk_search": op3_topk_search}

ORACLE_SQL = {
    "op3_topk_search": """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_sum(list_transform(range(1, len(q.v) + 1), lambda i: q.v[i] * c.v[i])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 5
"""
}

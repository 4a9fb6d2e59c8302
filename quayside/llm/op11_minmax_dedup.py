"""MinHash near-duplicates by min-max hashing.

A document's set is its distinct two-word shingles. Two sets link when ``100 * |intersection| >= 80 *
|union|``; the result is the connected components of the links, and the least document of each is kept.

*Min-max hashing.* A permutation of the 64-bit hashes (times an odd number, plus another) is applied once, and
both the least and the greatest value under it are kept, so ``PERMUTATIONS`` evaluations give twice as many
values. Each value is equal in two sets with a chance of their similarity J. Two sets cannot
differ in both by the same shingle, so the two values of a permutation fail apart rather than together,
and the share of equal values has a lower variance than that of as many minima.

*Bands.* ``ROWS`` values make a band: the minima of ``ROWS`` permutations are one, their maxima are another, never
mixed, so a band's values are independent. Sets that agree in a whole band are a group. At J = 0.8 a
band is equal with a chance of 0.33, so all ``BANDS`` = 40 differ with a chance of 1.3e-7 (less, as the two
bands of the same permutations fail apart): that is the share of links at the very threshold that
can be lost; at J = 0.9 it is 1e-16. Every pair that meets is settled exactly, on the full sets
(``groups.settled``).

*Scale.* Copies have one set, which each task signs once. Band rows of 16 bytes are what is shuffled: first
the least and greatest set of a band (combined map-side), then a join of the rows with the bands that
have two sets or more, which adaptive execution can split where a band has very many.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import groups
from .common import U64, WordHasher, discard, mix, only, set_id, table, written

RULE = groups.Rule(80, 100)
WIDTH = 2
PERMUTATIONS, ROWS = 100, 5
BANDS = 2 * PERMUTATIONS // ROWS
PIECE = 65_536  # shingles that are hashed together
SEEN = 1_000_000  # sets that a task remembers

_RANDOM = mix(np.arange(1, 2 * PERMUTATIONS + 1, dtype=U64) * U64(0x2545F4914F6CDD1D))
TIMES, PLUS = _RANDOM[:PERMUTATIONS] | U64(1), _RANDOM[PERMUTATIONS:]


def extremes(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(least, greatest): for each set, none of them empty, and each permutation."""
    low, high = np.empty((len(sets), PERMUTATIONS), U64), np.empty((len(sets), PERMUTATIONS), U64)
    pieces = [(i, s[k : k + PIECE]) for i, s in enumerate(sets) for k in range(0, len(s), PIECE)]
    low[:], high[:] = np.iinfo(U64).max, 0
    at = 0
    while at < len(pieces):
        end, size = at, 0
        while end < len(pieces) and (end == at or size + len(pieces[end][1]) <= PIECE):
            size += len(pieces[end][1])
            end += 1
        owner, flat = np.array([i for i, _ in pieces[at:end]]), np.concatenate([p for _, p in pieces[at:end]])
        first = np.cumsum([0, *[len(p) for _, p in pieces[at : end - 1]]])
        own, mine = (np.empty((len(owner), PERMUTATIONS), U64) for _ in "ab")
        for j in range(PERMUTATIONS):
            moved = flat * TIMES[j] + PLUS[j]
            own[:, j], mine[:, j] = np.minimum.reduceat(moved, first), np.maximum.reduceat(moved, first)
        np.minimum.at(low, owner, own)
        np.maximum.at(high, owner, mine)
        at = end
    return low, high


def estimate(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """The share of equal values of the (least, greatest) of two lists of sets: unbiased for the similarity."""
    return ((a[0] == b[0]).mean(axis=1) + (a[1] == b[1]).mean(axis=1)) / 2


def bands(low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """A 64-bit name for each band of each set."""
    out = []
    for kind, values in enumerate((low, high)):
        parts = values.reshape(len(values), PERMUTATIONS // ROWS, ROWS)
        name = np.broadcast_to(mix(np.arange(1, parts.shape[1] + 1, dtype=U64) * U64(2) + U64(kind)), parts.shape[:2])
        for j in range(ROWS):
            name = mix(name * U64(0x9E3779B97F4A7C15) + parts[:, :, j])
        out.append(name)
    return np.concatenate(out, axis=1)


def signed(docs: DataFrame) -> DataFrame:
    """(key, doc_id, n_shingles, sid, bands) of docs(key, doc_id, text): the id of each document's set (null without words),
    and the set's bands, null where the task has given them before."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, seen = WordHasher(), set()
        for batch in batches:
            ns, sids, new, names = [], [], [], [None] * len(batch)
            held, size = [], 0

            def sign() -> None:
                for i, row in zip(new[len(new) - len(held) :], bands(*extremes(held)), strict=True):
                    names[i] = row.tobytes()  # noqa: B023  (called within its batch)

            for i, text in enumerate(batch.column("text")):
                s = groups.shingle_set(text.as_py(), hasher, WIDTH)
                ns.append(len(s))
                sids.append(set_id(s) if len(s) else None)
                if not len(s) or sids[-1] in seen:
                    continue
                seen.add(sids[-1])
                new.append(i)
                held.append(s)
                size += len(s)
                if size > 16 * PIECE:
                    sign()
                    held, size = [], 0
            if held:
                sign()
            if len(seen) > SEEN:
                seen.clear()
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), batch.column("doc_id"), pa.array(ns, pa.int64()), pa.array(sids, pa.int64()), pa.array(names, pa.binary())],
                ["key", "doc_id", "n_shingles", "sid", "bands"],
            )

    return docs.mapInArrow(run, "key long, doc_id long, n_shingles long, sid long, bands binary")


def band_rows(rows: DataFrame) -> DataFrame:
    """(band, sid): a row for each band of signed rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = np.frombuffer(b"".join(batch.column("bands").to_pylist()), np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(names), pa.array(np.repeat(batch.column("sid").to_numpy(), BANDS))], ["band", "sid"])

    return rows.filter("bands is not null").select("sid", "bands").mapInArrow(run, "band long, sid long")


def set_components(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(members(key, doc_id, n_shingles, sid), labels(sid, root)), both written, of docs(key, doc_id, text)."""
    rows = written(signed(docs), "signed")
    members = rows.select("key", "doc_id", "n_shingles", "sid")
    each = band_rows(rows)
    centres = each.groupBy("band").agg(F.min("sid").alias("least"), F.max("sid").alias("most")).filter("least <> most").select("band", "least")
    met = written(each.join(centres, "band").filter("sid <> least"), "met")
    of_set = members.filter("sid is not null").groupBy("sid").agg(F.min("key").alias("key"))
    wanted = written(of_set.join(met.select("sid").union(met.select("least")).distinct(), "sid"), "wanted")
    sets = groups.contents(docs, wanted, WIDTH)
    several = met.groupBy("band").agg(F.min("sid").alias("a"), F.max("sid").alias("b")).filter("a <> b").select("band")
    large = met.join(several, "band", "left_semi")
    named = large.select(F.col("band").alias("grp"), "sid").union(large.select("band", "least")).distinct()
    labels = groups.settled(met.select(F.col("least").alias("a"), F.col("sid").alias("b")), named, sets, RULE)
    kept = written(members, "members")
    discard(rows, met, wanted, sets)
    return kept, labels


def near_duplicates(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept), a row for each row of ``docs(doc_id, text)``; kept: it is the
    least of its component.

    A null or blank text has no shingles and is its own component. Rows with one doc_id count as one
    document. A null doc_id gets the smallest doc_id it reaches, or null, and is kept only if that is
    null. Extra columns are ignored; an empty table gives an empty result.
    """
    docs = only(docs, doc_id="long", text="string")
    members, labels = set_components(docs.select(F.col("doc_id").alias("key"), "doc_id", "text"))
    out = written(groups.component_ids(members, labels), "components")
    discard(members, labels)
    return out.withColumn("kept", F.expr("doc_id <=> component_id"))


def op11_minmax_dedup(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


QUERIES = {"op11_minmax_dedup": op11_minmax_dedup}

#: Words, two-word shingles, pairs that share one, exact test, and the reachable minimum.
ORACLE_SQL = {
    "op11_minmax_dedup": r"""
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM documents),
sh AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 2 THEN w
      ELSE list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) END) AS s
  FROM words),
n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
common AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM sh a JOIN sh b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY 1, 2),
link AS (SELECT x, y FROM common JOIN n p ON p.doc_id = x JOIN n q ON q.doc_id = y WHERE 100 * c >= 80 * (p.n + q.n - c)),
edge AS (SELECT x, y FROM link UNION SELECT y, x FROM link),
reach AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT a, y FROM reach JOIN edge ON b = x)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, min(r.b) AS component_id, d.doc_id = min(r.b) AS kept
FROM documents d JOIN reach r ON r.a = d.doc_id LEFT JOIN n ON n.doc_id = d.doc_id
GROUP BY d.doc_id, n.n
"""
}

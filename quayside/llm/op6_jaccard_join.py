"""N-gram Jaccard join by PartEnum signatures.

A document's set is its distinct five-word shingles. Two sets link when
``100 * |intersection| >= 75 * |union|``; the result is the connected components of all links.

*Shared shingles.* A set whose partner differs keeps at least three quarters of its shingles in that
partner. So half of all shingles (by a bit of their hash) are met in hash buckets, and a set of which
more than a quarter was seen in this set alone can have no partner: it is settled. Most documents of
a corpus end here; the others' sets are written once, and all that follows reads them, not the texts.

*Bands.* Sets are put in size bands ``(r, r * 3.16]``; a set is signed in its own band (where its
partner may be the larger or the smaller) and, if a linked partner could be that large, in the
next one. Two linked sets of ``a`` and ``b`` shingles differ in at most ``(a + b) / 7`` shingles,
so a set that is signed in a band knows the largest difference ``k`` it may have there.

*Partitions and their subsets.* The band hashes the shingle domain into groups, each of ``PARTS`` = 3
partitions. A set goes through the groups in order and signs, in each, the contents of every subset
of ``PARTS - SPOILT`` = 2 partitions (where it has any), until it has met ``k // (SPOILT + 1) + 1``
groups in which it occupies more than ``SPOILT`` partitions ("thick" groups). In a group where two
sets differ in at most ``SPOILT`` shingles some subset is untouched, and if one of them is thick
there it has content. So, before the first subset that both share, each thick group of either has
``SPOILT + 1`` differences or more, and there are at most ``k // (SPOILT + 1)`` of these: linked sets
both sign the first subset that they share.

*Frequent shingles.* Any fixed set H of shingles can be left out of both sets without raising the
difference. H holds the shingles that most of these sets repeat (boilerplate, large groups of near
copies), so unrelated documents with a common passage do not meet. It is broadcast: at most
``HOT_MOST`` shingles, the most frequent ones in ``HOT_LEAST`` sets or more; a larger corpus has a
higher bar, never another result. Sets that are left with too few thick groups are signed a second
time, in a family of their own, on their whole content: the first ``k + 1`` shingles in order of
rarity. A pair is only missed by the first family if both its sets are of this kind, so the two
families together lose nothing.

*Groups.* Sets (not documents: copies have one set) that share a signature are a group; ``groups.settled`` settles
every pair that shares one. Signatures travel as packed blobs, one for each task and bucket. Nothing whole passes the driver.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import groups
from .common import U64, WordHasher, discard, mix, only, pack, set_id, spans, table, unpack, written

RULE = groups.Rule(75, 100)
WIDTH = 5
BAND = (4 / 3) ** 4
PARTS, SPOILT = 3, 1  # partitions of a group, and how many of them a difference may touch
GROUPS = 0.2  # groups of a band, as a share of its largest size
FLUSH = 1_500_000  # shingles or signatures that a task gathers before it emits blobs
PER_BUCKET = 2_000_000
HOT_LEAST, HOT_MOST = 8, 2_000_000  # sets that hold a frequent shingle; frequent shingles (16 MB)
HOT_BITS = 40  # of a shingle's hash that tell whether it is frequent


def band_of(n: int) -> int:
    return max(0, math.ceil(math.log(n) / math.log(BAND) - 1e-9))


def band_top(band: int) -> int:
    return int(math.floor(BAND**band + 1e-9))


def places(n: int) -> list[tuple[int, int]]:
    """(band, largest difference) for each band that a set of n shingles is signed in."""
    own, most = band_of(n), n * 4 // 3
    found = [(own, (n + min(band_top(own), most)) // 7)]
    if most > band_top(own):
        found.append((own + 1, (n + most) // 7))
    return found


def signatures(shingles: np.ndarray, hot: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """All signatures of one set; hot: the first bits of the frequent shingles, sorted; rank: their
    places in order of rarity."""
    out = []
    rare, rest = shingles, shingles[:0]
    if len(hot):
        head = shingles >> U64(64 - HOT_BITS)
        at = np.searchsorted(hot, head)
        at[at == len(hot)] = 0
        is_hot = hot[at] == head
        rare, rest = shingles[~is_hot], shingles[is_hot][np.lexsort((shingles[is_hot], rank[at[is_hot]]))]
    for band, k in places(len(shingles)):
        salt = U64((band + 1) * 0x632BE59BD9B4E019 & (1 << 64) - 1)
        need, thick = k // (SPOILT + 1) + 1, 0
        if len(rare):
            keys = np.sort(mix(rare ^ salt))
            group = ((keys >> U64(32)) * U64(max(1, int(band_top(band) * GROUPS)))) >> U64(32)  # in order, as the keys are
            begin, end = spans(group)
            row = np.repeat(np.arange(len(begin)), end - begin)
            cell = row * PARTS + (keys % U64(PARTS)).astype(np.int64)
            order = np.argsort(cell, kind="stable")
            first, _ = spans(cell[order])
            content, full = np.zeros(len(begin) * PARTS, U64), np.zeros(len(begin) * PARTS, bool)
            content[cell[order][first]] = np.add.reduceat(mix(keys[order] + U64(1)), first)
            full[cell] = True
            content, full = content.reshape(-1, PARTS), full.reshape(-1, PARTS)
            met = np.cumsum(full.sum(axis=1) > SPOILT)
            thick = int(met[-1])
            stop = int(np.searchsorted(met, need)) + 1  # all of them, if there are too few thick ones
            for i, subset in enumerate(combinations(range(PARTS), PARTS - SPOILT)):
                has = full[:stop, subset].any(axis=1)
                name = mix(group[begin][:stop][has] + salt) + U64(i)
                out.append(mix(content[:stop, subset].sum(axis=1, dtype=U64)[has] ^ mix(name)))
        if thick < need:
            whole = np.concatenate((rare, rest))
            out.append(mix(whole[: k + 1] ^ mix(np.array([salt ^ U64(0xD6E8FEB86659FD93)]))))
    return np.concatenate(out) if out else np.zeros(0, U64)


# ---------------------------------------------------------------- sets that may have a partner


def halved(shingles: np.ndarray) -> np.ndarray:
    """The half of the shingles whose document counts are taken."""
    return shingles[(mix(shingles) & U64(1)) == 0]


def met(docs: DataFrame, buckets: int, bits: int) -> DataFrame:
    """Rows of three kinds, of docs(key, doc_id, text). bucket -2: a document (key, doc_id, n_shingles, sid; sid
    is null if it has no words). bucket -1: the sets of a chunk, in order. Others: a chunk's shingles of the bucket, each
    with the place of the set that has it, or -1 where several sets of the chunk do."""
    schema = "bucket int, chunk long, key long, doc_id long, n_shingles long, sid long, blob binary"
    arrow = pa.schema([("bucket", pa.int32()), ("chunk", pa.int64()), ("key", pa.int64()), ("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("sid", pa.int64()), ("blob", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, held, sids, ns, seen, size = WordHasher(), [], [], [], set(), 0
        chunk = TaskContext.get().partitionId() << 24

        def emit():
            h = np.concatenate(held) >> U64(64 - bits)
            place = np.repeat(np.arange(len(held), dtype=np.int32), [len(x) for x in held])
            order = np.argsort(h, kind="stable")
            h, place = h[order], place[order]
            begin, end = spans(h)
            h, place = h[begin], np.where(end - begin > 1, -1, place[begin]).astype(np.int32)
            cut = np.searchsorted(h, (np.arange(buckets + 1, dtype=np.float64) * (2.0**bits / buckets)).astype(U64))
            names, blobs = [-1], [pack(np.array(sids, np.int64), np.array(ns, np.uint32))]
            for b, (i, j) in enumerate(zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True)):
                if i < j:
                    names.append(b)
                    blobs.append(pack(np.diff(h[i:j], prepend=U64(0)), place[i:j].astype(np.uint16) if len(held) < 65_536 else place[i:j]))
            none = pa.nulls(len(names), pa.int64())
            return pa.RecordBatch.from_arrays(
                [pa.array(names, pa.int32()), pa.array([chunk] * len(names), pa.int64()), none, none, none, none, pa.array(blobs, pa.binary())], schema=arrow
            )

        for batch in batches:
            n, own = [], []
            for text in batch.column("text"):
                s = groups.shingle_set(text.as_py(), hasher, WIDTH)
                n.append(len(s))
                own.append(set_id(s) if len(s) else None)
                if not len(s) or own[-1] in seen:
                    continue
                seen.add(own[-1])
                sids.append(own[-1])
                ns.append(len(s))
                held.append(halved(s))
                size += len(held[-1])
                if size > FLUSH:
                    yield emit()
                    held, sids, ns, size, chunk = [], [], [], 0, chunk + 1
                    seen.clear()
            none = pa.nulls(len(n), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array([-2] * len(n), pa.int32()), none, batch.column("key"), batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(own, pa.int64()), pa.nulls(len(n), pa.binary())],
                schema=arrow,
            )
        if sids:
            yield emit()

    return docs.mapInArrow(run, schema)


def partnered(rows: DataFrame) -> DataFrame:
    """(sid): the sets of which at most a quarter is known to be in no other set."""

    def alone(frame: pd.DataFrame) -> pd.DataFrame:
        h, place, row = [], [], []
        for i, raw in enumerate(frame["blob"]):
            d, p = unpack(raw)
            h.append(np.cumsum(d, dtype=U64))
            place.append(np.where(p == np.iinfo(p.dtype).max, -1, p.astype(np.int32)) if p.dtype == np.uint16 else p)
            row.append(np.full(len(p), i, np.int32))
        sizes = [int(p.max(initial=-1)) + 1 for p in place]
        h = np.concatenate(h)
        order = np.argsort(h)
        h = h[order]
        begin, end = spans(h)
        one = order[begin[end - begin == 1]]
        del h, order
        place, row = np.concatenate(place), np.concatenate(row)
        one = one[place[one] >= 0]
        base = np.concatenate(([0], np.cumsum(sizes)))
        counts = np.bincount(base[row[one]] + place[one], minlength=base[-1])
        blobs = [pack(counts[a:b].astype(np.uint32)) for a, b in zip(base[:-1], base[1:], strict=True)]
        return pd.DataFrame({"chunk": frame["chunk"], "bucket": frame["bucket"], "blob": blobs})

    def summed(frame: pd.DataFrame) -> pd.DataFrame:
        sids = ns = None
        parts = []
        for b, raw in zip(frame["bucket"], frame["blob"], strict=True):
            if b == -1:
                sids, ns = unpack(raw)
            else:
                parts.append(unpack(raw)[0])
        total = np.zeros(len(sids), np.int64)
        for p in parts:
            total[: len(p)] += p
        return pd.DataFrame({"sid": sids[4 * total <= ns]})

    blobs = rows.filter("bucket >= 0").select("bucket", "chunk", "blob")
    counts = blobs.groupBy("bucket").applyInPandas(alone, "chunk long, bucket int, blob binary")
    named = rows.filter("bucket = -1").select("chunk", "bucket", "blob")
    return named.unionByName(counts).groupBy("chunk").applyInPandas(summed, "sid long").distinct()


def frequent(sets: DataFrame, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """First bits of the shingles that most of sets(content) hold, sorted, and their places in order of
    rarity. (Any set of shingles would be right, and any order.)"""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def emit():
            h, c = np.unique(np.concatenate(held) >> U64(64 - HOT_BITS), return_counts=True)
            cut = np.searchsorted(h, (np.arange(buckets + 1, dtype=np.float64) * (2.0**HOT_BITS / buckets)).astype(U64)).tolist()
            own = [(b, i, j) for b, (i, j) in enumerate(zip(cut[:-1], cut[1:], strict=True)) if i < j]
            blobs = [pack(np.diff(h[i:j], prepend=U64(0)), c[i:j].astype(np.uint32)) for _, i, j in own]
            return pa.RecordBatch.from_arrays([pa.array([b for b, _, _ in own], pa.int32()), pa.array(blobs, pa.binary())], ["bucket", "blob"])

        for batch in batches:
            for content in batch.column("content"):
                held.append(np.frombuffer(content.as_py(), U64))
                size += len(held[-1])
                if size > FLUSH:
                    yield emit()
                    held, size = [], 0
        if held:
            yield emit()

    def count(frame: pd.DataFrame) -> pd.DataFrame:
        parts = [unpack(raw) for raw in frame["blob"]]
        h, c = np.concatenate([np.cumsum(d, dtype=U64) for d, _ in parts]), np.concatenate([x for _, x in parts])
        order = np.argsort(h)
        begin, _ = spans(h[order])
        h, c = h[order][begin], np.add.reduceat(c[order].astype(np.int64), begin)
        return pd.DataFrame({"h": h[c >= HOT_LEAST].astype(np.int64), "c": c[c >= HOT_LEAST]})

    blobs = sets.select("content").mapInArrow(run, "bucket int, blob binary")
    found = written(blobs.groupBy("bucket").applyInPandas(count, "h long, c long"), "frequent")
    by_count = found.groupBy("c").agg(F.count("*").alias("n")).toPandas().sort_values("c", ascending=False)  # as many rows as different counts
    fits = by_count["c"][by_count["n"].cumsum() <= HOT_MOST]
    got = found.filter(F.col("c") >= (int(fits.iloc[-1]) if len(fits) else 1 << 62)).toPandas().sort_values(["c", "h"])
    discard(found)
    h = got["h"].to_numpy(np.int64).astype(U64)
    order = np.argsort(h)
    return h[order], order.astype(np.int32)


# ---------------------------------------------------------------- sets that share a signature


def signature_blobs(sets: DataFrame, hot: tuple[np.ndarray, np.ndarray], buckets: int) -> DataFrame:
    shared = sets.sparkSession.sparkContext.broadcast(hot)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hot, sigs, sids, ns, size = shared.value, [], [], [], 0

        def emit():
            times = [len(x) for x in sigs]
            sig = np.concatenate(sigs)
            owner = np.repeat(np.arange(len(sids)), times)
            bucket = (sig % U64(buckets)).astype(np.int32)
            order = np.lexsort((sig, bucket))
            sig, owner, bucket = sig[order] >> U64(20), owner[order], bucket[order]
            name, blob = [], []
            for i, j in zip(*spans(bucket), strict=True):
                own, local = np.unique(owner[i:j], return_inverse=True)
                name.append(int(bucket[i]))
                blob.append(pack(np.diff(sig[i:j], prepend=U64(0)), local.astype(np.uint32), np.array(sids, np.int64)[own], np.array(ns, np.uint32)[own]))
            return pa.RecordBatch.from_arrays([pa.array(name, pa.int32()), pa.array(blob, pa.binary())], ["bucket", "blob"])

        for batch in batches:
            for sid, n, content in zip(batch.column("sid").to_pylist(), batch.column("n_shingles").to_pylist(), batch.column("content"), strict=True):
                sids.append(sid)
                ns.append(n)
                sigs.append(signatures(np.frombuffer(content.as_py(), U64), *hot))
                size += len(sigs[-1])
                if size > FLUSH:
                    yield emit()
                    sigs, sids, ns, size = [], [], [], 0
        if sids:
            yield emit()

    return sets.select("sid", "n_shingles", "content").mapInArrow(run, "bucket int, blob binary")


def meetings(blobs: DataFrame) -> DataFrame:
    """(grp, a, b): pairs (a, b) of a group's first member and another, and, where b is null, the
    members a of groups grp of three or more."""

    def meet(frame: pd.DataFrame) -> pd.DataFrame:
        sig, sid, length = [], [], []
        for raw in frame["blob"]:
            d, local, own, sizes = unpack(raw)
            sig.append(np.cumsum(d, dtype=U64))
            sid.append(own[local])
            length.append(sizes[local])
        sig, sid, length = np.concatenate(sig), np.concatenate(sid), np.concatenate(length).astype(np.int64)
        order = np.lexsort((sid, sig))
        sig, sid, length = sig[order], sid[order], length[order]
        keep = np.concatenate(([True], (sig[1:] != sig[:-1]) | (sid[1:] != sid[:-1])))
        sig, sid, length = sig[keep], sid[keep], length[keep]
        i, j = spans(sig)
        i, n = i[j - i > 1], (j - i)[j - i > 1]
        at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(i, n)
        p = np.stack((np.repeat(i, n), at))[:, at != np.repeat(i, n)]
        p = sid[p[:, RULE.fits(*length[p])]]
        p = p[:, np.lexsort((p[1], p[0]))]
        p = p[:, np.concatenate(([True], (p[:, 1:] != p[:, :-1]).any(axis=0)))[: p.shape[1]]]
        # a group is named by its members: the same members again are nothing new to compare
        name = np.add.reduceat(mix(sid[at].astype(U64)), np.cumsum(n) - n).astype(np.int64) if len(n) else np.zeros(0, np.int64)
        first = np.zeros(len(n), bool)
        first[np.unique(name, return_index=True)[1]] = True
        once = np.repeat(first & (n > 2), n)
        g, m = np.repeat(name, n)[once], sid[at][once]
        return pd.DataFrame(
            {
                "grp": pd.array(np.concatenate((np.zeros(p.shape[1], np.int64), g)), "Int64"),
                "a": np.concatenate((p[0], m)),
                "b": pd.arrays.IntegerArray(np.concatenate((p[1], np.zeros(len(m), np.int64))), np.arange(p.shape[1] + len(m)) >= p.shape[1]),
            }
        )

    return blobs.groupBy("bucket").applyInPandas(meet, "grp long, a long, b long")


def set_components(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(members(key, doc_id, n_shingles, sid), labels(sid, root)), both written, of docs(key, doc_id, text): a row for
    each document, with the id of its set, and the root of each set that may have a partner. The key
    tells where a set's text is read again; rows may share one."""
    rows, chars = docs.agg(F.count("*"), F.coalesce(F.sum(F.length("text").cast("long")), F.lit(0))).first()
    shingles = chars // 5 + rows  # about; it only sets the sizes of tasks, and how often hashes meet by chance
    bits = min(60, max(30, (64 * shingles).bit_length()))
    seen = written(met(docs, max(16, math.ceil(shingles / 2 / PER_BUCKET)), bits), "met")
    members = written(seen.filter("bucket = -2").select("key", "doc_id", "n_shingles", "sid"), "members")
    of_set = members.filter("sid is not null").groupBy("sid").agg(F.min("key").alias("key"))
    wanted = written(of_set.join(partnered(seen), "sid"), "wanted")
    discard(seen)
    sets = groups.contents(docs, wanted, WIDTH)
    total = sets.agg(F.count("*"), F.coalesce(F.sum("n_shingles"), F.lit(0))).first()
    buckets = max(16, math.ceil(total[1] / PER_BUCKET))
    found = written(meetings(signature_blobs(sets, frequent(sets, buckets), buckets)), "meetings")
    labels = groups.settled(found.filter("b is not null").select("a", "b"), found.filter("b is null").select("grp", F.col("a").alias("sid")).distinct(), sets, RULE)
    discard(wanted, found, sets)
    return members, labels


def jaccard_components(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id), a row for each row of ``docs(doc_id, text)``.

    A null or blank text has no shingles and is its own component. Rows with one doc_id count as
    one document. A null doc_id gets the smallest doc_id it reaches, or null. Extra columns are
    ignored; an empty table gives an empty result.
    """
    docs = only(docs, doc_id="long", text="string")
    members, labels = set_components(docs.select(F.col("doc_id").alias("key"), "doc_id", "text"))
    out = written(groups.component_ids(members, labels), "components")
    discard(members, labels)
    return out


def op6_jaccard_join(spark, sf_dir: str) -> DataFrame:
    return jaccard_components(table(spark, sf_dir, "documents"))


QUERIES = {"op6_jaccard_join": op6_jaccard_join}

#: Words, five-word shingles, pairs that share one, exact test, and the reachable minimum.
ORACLE_SQL = {
    "op6_jaccard_join": r"""
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM documents),
sh AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
      ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS s
  FROM words),
n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
common AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM sh a JOIN sh b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY 1, 2),
link AS (SELECT x, y FROM common JOIN n p ON p.doc_id = x JOIN n q ON q.doc_id = y WHERE 100 * c >= 75 * (p.n + q.n - c)),
edge AS (SELECT x, y FROM link UNION SELECT y, x FROM link),
reach AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT a, y FROM reach JOIN edge ON b = x)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, min(r.b) AS component_id
FROM documents d JOIN reach r ON r.a = d.doc_id LEFT JOIN n ON n.doc_id = d.doc_id
GROUP BY d.doc_id, n.n
"""
}

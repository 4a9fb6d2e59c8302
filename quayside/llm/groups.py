"""Sets of shingles in groups that share a signature: from groups to components of linked sets.

Two sets link under a ``Rule``: ``den * |intersection| >= num * |union|``. Each member of a group is paired with
the group's first member; for each set one such pair is verified on the exact sets, which connects most
copies. Groups whose members are not all connected by then are compared in blocks of bounded members and
bytes. Similar sets share many groups; each set knows the ``FIRST`` lowest names of its groups, and a pair
is left to the lowest group that both know. Where a pair is compared, parity bitmaps, whose Hamming
distance never exceeds the true difference, leave few pairs of different components, and these are
verified. A pair of blocks with many such pairs (sets just below the threshold) gets the exact sets
themselves, counts all intersections by matrix products, and gives a spanning forest of its links. So
every pair that shares a signature is settled, without rounds.

Sets are rows (sid, n_shingles, bits, content), content being the sorted 64-bit shingles. Nothing whole
passes the driver.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import U64, WordHasher, discard, distinct_sorted, set_id, shingle_hashes, written
from .graph import components

GROUP_BLOCK = 2048  # members of a large group that one task compares with as many others
BLOCK_BYTES = 16 << 20  # of their sets
MANY = 4  # pairs for each member beyond which a pair of blocks gets the exact sets
COLUMNS = 4096  # of a matrix of members and shingles
FIRST = 8  # groups that a set knows
BROADCAST_IDS = 4_000_000  # 16 bytes each: at most 64 MB


class Rule(NamedTuple):
    """Sets link when ``den * |intersection| >= num * |union|``."""

    num: int
    den: int

    def fits(self, a, b):
        """Sizes (numbers, arrays or columns of them) that can link."""
        return (self.num * a <= self.den * b) & (self.num * b <= self.den * a)

    def apart(self, total):
        """Linked sets of so many shingles together differ in at most this many."""
        return total * (self.den - self.num) // (self.den + self.num)

    def links(self, both, a, b):
        return self.den * both >= self.num * (a + b - both)


def shingle_set(text: str | None, hasher: WordHasher, width: int) -> np.ndarray:
    return distinct_sorted(shingle_hashes(hasher(text), width))


def bitmap(shingles: np.ndarray) -> bytes:
    """Parity bits of the set: bit ``h mod size`` flips for each member. Its size depends on the
    set's size only through the power of two above it, so bitmaps fold onto each other."""
    size = 1 << max(6, int(len(shingles) * 4 - 1).bit_length())
    bits = (np.bincount((shingles & U64(size - 1)).astype(np.int64), minlength=size) & 1).astype(np.uint8)
    return np.packbits(bits, bitorder="little").tobytes()


def fold(raw: bytes, size: int) -> np.ndarray:
    words = np.frombuffer(raw, dtype=U64)
    while len(words) > size:
        words = words[: len(words) // 2] ^ words[len(words) // 2 :]
    return words


def contents(docs: DataFrame, wanted: DataFrame, width: int) -> DataFrame:
    """(sid, n_shingles, bits, content) of the written wanted(sid, key), a row for each sid. key tells
    which rows of docs(key, text) to read, the set itself decides."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = WordHasher()
        for batch in batches:
            found = [(sid, s) for sid, t in zip(batch.column("sid").to_pylist(), batch.column("text"), strict=True)
                     if len(s := shingle_set(t.as_py(), hasher, width)) and set_id(s) == sid]
            yield pa.RecordBatch.from_arrays(
                [pa.array([sid for sid, _ in found], pa.int64()), pa.array([len(s) for _, s in found], pa.int64()),
                 pa.array([bitmap(s) for _, s in found], pa.binary()), pa.array([s.tobytes() for _, s in found], pa.binary())],
                ["sid", "n_shingles", "bits", "content"],
            )

    few = wanted.count() <= BROADCAST_IDS
    need = wanted.select(F.col("key").alias("want"), "sid")
    texts = docs.join(F.broadcast(need) if few else need, F.expr("key <=> want")).select("sid", "text")
    out = written(texts.mapInArrow(run, "sid long, n_shingles long, bits binary, content binary"), "contents")
    rows, sids = out.agg(F.count("*"), F.countDistinct("sid")).first()
    if rows == sids:
        return out
    once = written(out.dropDuplicates(["sid"]), "contents")  # rows that share a key and a set
    discard(out)
    return once


def may_link(rule: Rule, *columns: str) -> Column:
    """Sizes and parity bitmaps (na, nb, ba, bb) allow a link."""

    def run(na: pd.Series, nb: pd.Series, ba: pd.Series, bb: pd.Series) -> pd.Series:
        out = np.zeros(len(na), bool)
        for i, (x, y, p, q) in enumerate(zip(na, nb, ba, bb, strict=True)):
            if rule.fits(x, y):
                size = min(len(p), len(q)) // 8
                out[i] = int(np.bitwise_count(fold(p, size) ^ fold(q, size)).sum()) <= rule.apart(x + y)
        return pd.Series(out)

    return F.pandas_udf(run, T.BooleanType())(*columns)


def linked(rule: Rule, *columns: str) -> Column:
    """The exact test on two sorted shingle sets."""

    def run(a: pd.Series, b: pd.Series) -> pd.Series:
        out = np.zeros(len(a), bool)
        for i, (p, q) in enumerate(zip(a, b, strict=True)):
            x, y = np.frombuffer(p, U64), np.frombuffer(q, U64)
            out[i] = rule.links(len(x) + len(y) - len(distinct_sorted(np.concatenate((x, y)))), len(x), len(y))
        return pd.Series(out)

    return F.pandas_udf(run, T.BooleanType())(*columns)


def hopeful(pairs: DataFrame, sets: DataFrame, rule: Rule) -> DataFrame:
    """Those of the distinct pairs (a, b) whose sizes and bitmaps allow a link."""
    one = sets.select("sid", "n_shingles", "bits")
    left = one.select(F.col("sid").alias("a"), F.col("n_shingles").alias("na"), F.col("bits").alias("ba"))
    right = one.select(F.col("sid").alias("b"), F.col("n_shingles").alias("nb"), F.col("bits").alias("bb"))
    return pairs.join(left, "a").join(right, "b").filter(may_link(rule, "na", "nb", "ba", "bb")).select("a", "b")


def verified(pairs: DataFrame, sets: DataFrame, rule: Rule) -> DataFrame:
    """Those of the written distinct pairs (a, b) that link."""
    need = pairs.select(F.col("a").alias("sid")).union(pairs.select("b")).distinct()
    some = sets.join(need, "sid", "left_semi")
    a = some.select(F.col("sid").alias("a"), F.col("content").alias("ca"))
    b = some.select(F.col("sid").alias("b"), F.col("content").alias("cb"))
    return pairs.join(a, "a").join(b, "b").filter(linked(rule, "ca", "cb")).select("a", "b")


def gathered(df: DataFrame, keys: list[str], columns: list[str], schema: str, work) -> DataFrame:
    """``work(key, columns)``, which returns columns, on each group of keys, a group in memory at a time: rows are dealt and
    sorted by Spark, and a task takes its groups one after the other."""
    kinds = {"long": pa.int64(), "array<long>": pa.list_(pa.int64())}
    arrow = pa.schema([(name, kinds[kind]) for name, kind in (c.split() for c in schema.split(", "))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held = None, []

        def done():
            cols = {c: pa.chunked_array([b.column(c) for b in held]) for c in columns}
            made = work(key, cols)
            return pa.RecordBatch.from_arrays([pa.array(made[f.name], f.type) for f in arrow], schema=arrow)

        for batch in batches:
            if not len(batch):
                continue
            names = np.stack([batch.column(k).to_numpy() for k in keys])
            cut = [0, *(np.flatnonzero((names[:, 1:] != names[:, :-1]).any(axis=0)) + 1).tolist(), len(batch)]
            for i, j in zip(cut, cut[1:], strict=False):
                own = tuple(names[:, i].tolist())
                if held and own != key:
                    yield done()
                    held = []
                key = own
                held.append(batch.slice(i, j - i))
        if held:
            yield done()

    return df.select(*keys, *columns).repartition(*keys).sortWithinPartitions(*keys).mapInArrow(run, schema)


def in_blocks(groups: DataFrame) -> DataFrame:
    """groups(grp, sid, n_shingles, ...) with lo and hi: a group is dealt into blocks of about ``GROUP_BLOCK``
    members and ``BLOCK_BYTES`` of sets, and every member gets a row for each pair of blocks that its
    own is part of."""
    most = F.greatest(F.count("*") / GROUP_BLOCK, F.sum("n_shingles") * 8 / BLOCK_BYTES)
    sizes = groups.groupBy("grp").agg(F.ceil(most).alias("blocks"))
    dealt = groups.join(sizes, "grp").withColumn("block", F.expr("CASE WHEN blocks = 1 THEN 0L ELSE pmod(xxhash64(sid, grp), blocks) END"))
    dealt = dealt.withColumn("other", F.explode(F.expr("sequence(0L, blocks - 1)")))
    return dealt.withColumn("lo", F.least("block", "other")).withColumn("hi", F.greatest("block", "other")).drop("other", "blocks", "n_shingles")


def own_pairs(key: tuple, sid: np.ndarray, root: np.ndarray, block: np.ndarray, known: np.ndarray, own: slice) -> np.ndarray:
    """Which pairs of the rows ``own`` and all rows are to be compared here: of different components,
    of different blocks if there are two, once each, and no lower group is known to both."""
    ok = (root[own, None] != root[None]) & (np.arange(own.start, own.start + len(sid[own]))[:, None] < np.arange(len(sid))[None])
    if key[1] != key[2]:
        ok &= block[own, None] != block[None]
    x, y = np.nonzero(ok)
    for k in range(0, len(x), 1 << 18):
        p, q = x[k : k + (1 << 18)], y[k : k + (1 << 18)]
        a, b = known[own][p], known[q]
        lower = np.zeros(len(p), bool)
        for i in range(known.shape[1]):
            lower |= ((a == b[:, i : i + 1]) & (b[:, i : i + 1] < key[0])).any(axis=1)
        ok[p[lower], q[lower]] = False
    return ok


def known_groups(cols: dict) -> np.ndarray:
    """A row of the groups that each member knows; the rest is the largest number, lower than none."""
    rows = cols["known"].combine_chunks()
    sizes = rows.value_lengths().to_numpy().astype(np.int64)
    out = np.full((len(sizes), FIRST), np.iinfo(np.int64).max)
    out[np.repeat(np.arange(len(sizes)), sizes), np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = rows.flatten().to_numpy()
    return out


def steps(rows: int) -> Iterator[slice]:
    width = max(1, 2_000_000 // max(1, rows))
    return (slice(i, min(i + width, rows)) for i in range(0, rows, width))


def with_pairs(dealt: DataFrame) -> DataFrame:
    """The rows of dealt(grp, lo, hi, block, sid, root, known) that have a pair to compare."""

    def work(key: tuple, cols: dict) -> dict:
        root, sid, block = (cols[c].to_numpy() for c in ("root", "sid", "block"))
        known, has = known_groups(cols), np.zeros(len(sid), bool)
        for own in steps(len(sid)):
            ok = own_pairs(key, sid, root, block, known, own)
            has[own] |= ok.any(axis=1)
            has |= ok.any(axis=0)
        at = np.flatnonzero(has)
        grp, lo, hi = (np.full(len(at), k, np.int64) for k in key)
        return {"grp": grp, "lo": lo, "hi": hi, "block": block[at], "sid": sid[at], "root": root[at], "known": list(known[at])}

    return gathered(dealt, ["grp", "lo", "hi"], ["sid", "root", "block", "known"], "grp long, lo long, hi long, block long, sid long, root long, known array<long>", work)


def close_pairs(dealt: DataFrame, rule: Rule) -> DataFrame:
    """(grp, lo, hi, a, b) of dealt(grp, lo, hi, block, sid, root, known, n_shingles, bits): the pairs
    to compare here that sizes and bitmaps allow; a and b are null where a pair of blocks has more
    than ``MANY`` for each member."""

    def work(key: tuple, cols: dict) -> dict:
        n, root, sid, block = (cols[c].to_numpy() for c in ("n_shingles", "root", "sid", "block"))
        raw, known = cols["bits"].to_pylist(), known_groups(cols)
        size = min(len(x) for x in raw) // 8
        bits = np.stack([fold(x, size) for x in raw])
        many, found = MANY * len(n), []
        for own in steps(len(n)):
            x, y = np.nonzero(own_pairs(key, sid, root, block, known, own))
            x = x + own.start
            fits = rule.fits(n[x], n[y])
            x, y = x[fits], y[fits]
            for k in range(0, len(x), 4_000_000 // size + 1):
                p, q = x[k : k + 4_000_000 // size + 1], y[k : k + 4_000_000 // size + 1]
                near = np.bitwise_count(bits[p] ^ bits[q]).sum(axis=1, dtype=np.int64) <= rule.apart(n[p] + n[q])
                found.append(np.stack((sid[p[near]], sid[q[near]])))
            if sum(f.shape[1] for f in found) > many:
                found = None
                break
        if found is None:
            p, gone = np.zeros((2, 1), np.int64), np.ones(1, bool)
        else:
            p = np.sort(np.concatenate([np.zeros((2, 0), np.int64), *found], axis=1), axis=0)
            gone = np.zeros(p.shape[1], bool)
        grp, lo, hi = (np.full(p.shape[1], k, np.int64) for k in key)
        return {"grp": grp, "lo": lo, "hi": hi, "a": pd.arrays.IntegerArray(p[0], gone), "b": pd.arrays.IntegerArray(p[1], gone)}

    return gathered(dealt, ["grp", "lo", "hi"], ["sid", "root", "n_shingles", "bits", "block", "known"], "grp long, lo long, hi long, a long, b long", work)


def intersections(sets: list[np.ndarray]) -> np.ndarray:
    """The sizes of all pairs' intersections, by products of a 0/1 matrix of members and shingles."""
    flat = np.concatenate(sets)
    member = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    name, column, times = np.unique(flat, return_inverse=True, return_counts=True)
    keep = times[column] > 1  # others are in no intersection
    shared = np.cumsum(times > 1) - 1
    column, member = shared[column[keep]], member[keep]
    order = np.argsort(column, kind="stable")
    column, member = column[order], member[order]
    out = np.zeros((len(sets), len(sets)), np.float32)
    for i in range(0, int((times > 1).sum()), COLUMNS):
        a, b = np.searchsorted(column, (i, i + COLUMNS))
        x = np.zeros((len(sets), COLUMNS), np.float32)
        x[member[a:b], column[a:b] - i] = 1
        out += x @ x.T
    return out.astype(np.int64)  # whole numbers far below 2**24: exact


def dense_links(dealt: DataFrame, rule: Rule) -> DataFrame:
    """(a, b): a spanning forest of the links between different components in each pair of blocks of
    dealt(grp, lo, hi, sid, root, content)."""

    def work(key: tuple, cols: dict) -> dict:
        root, sid = (cols[c].to_numpy() for c in ("root", "sid"))
        sets = [np.frombuffer(x, U64) for x in cols["content"].to_pylist()]
        both, n = intersections(sets), np.array([len(s) for s in sets])
        comp, found = np.unique(root, return_inverse=True)[1], []
        for i in range(len(n)):
            for j in np.flatnonzero(rule.links(both[i], n, n[i]) & (comp != comp[i])).tolist():
                if comp[j] != comp[i]:
                    found.append((sid[i], sid[j]))
                    comp[comp == comp[j]] = comp[i]
        p = np.sort(np.array(found, np.int64).reshape(-1, 2), axis=1)
        return {"a": p[:, 0], "b": p[:, 1]}

    return gathered(dealt, ["grp", "lo", "hi"], ["sid", "root", "content"], "a long, b long", work)


def joined_up(labels: DataFrame, links: DataFrame) -> DataFrame:
    """labels(sid, root), written anew, after more links (a, b): only the roots are connected anew."""
    ends = links.join(labels.select(F.col("sid").alias("a"), F.col("root").alias("ra")), "a")
    ends = ends.join(labels.select(F.col("sid").alias("b"), F.col("root").alias("rb")), "b")
    found = components(ends.select(F.col("ra").alias("a"), F.col("rb").alias("b")))
    up = found.select(F.col("node").alias("root"), F.col("root").alias("up"))
    out = written(labels.join(up, "root", "left").select("sid", F.coalesce("up", "root").alias("root")), "labels")
    discard(found)
    return out


def within_groups(groups: DataFrame, stars: DataFrame, labels: DataFrame, sets: DataFrame, rule: Rule) -> DataFrame:
    """Labels after all links inside groups(grp, sid), and those of the pairs stars(a, b)."""
    named = groups.join(labels, "sid")
    apart = named.groupBy("grp").agg(F.min("root").alias("least"), F.max("root").alias("most")).filter("least <> most").select("grp")
    named = named.join(apart, "grp", "left_semi")
    nth = F.row_number().over(Window.partitionBy("sid").orderBy("grp"))
    known = named.select("sid", "grp", nth.alias("nth")).filter(F.col("nth") <= FIRST).groupBy("sid").agg(F.collect_list("grp").alias("known"))
    sized = named.join(sets.select("sid", "n_shingles"), "sid")
    dealt = written(with_pairs(in_blocks(sized.join(known, "sid"))), "groups")
    close = written(close_pairs(dealt.join(sets.select("sid", "n_shingles", "bits"), "sid"), rule), "close")
    root = labels.select(F.col("sid").alias("a"), F.col("root").alias("ra")), labels.select(F.col("sid").alias("b"), F.col("root").alias("rb"))
    open_ = stars.join(root[0], "a").join(root[1], "b").filter("ra <> rb").select("a", "b")
    pairs = written(close.filter("a is not null").select("a", "b").union(open_).distinct(), "pairs")
    links = verified(pairs, sets, rule)
    dense = close.filter("a is null").select("grp", "lo", "hi")
    if dense.take(1):
        links = links.union(dense_links(dealt.join(dense, ["grp", "lo", "hi"], "left_semi").join(sets.select("sid", "content"), "sid"), rule))
    links = written(links.distinct(), "links")
    out = joined_up(labels, links)
    discard(dealt, close, pairs, links)
    return out


def settled(pairs: DataFrame, groups: DataFrame, sets: DataFrame, rule: Rule) -> DataFrame:
    """(sid, root) of each of the written sets, written: all links within groups(grp, sid) of three or more, and
    of pairs(a, b), each group's first member and another."""
    stars = written(hopeful(pairs.distinct(), sets, rule), "stars")
    first = written(stars.groupBy("b").agg(F.min("a").alias("a")).select("a", "b"), "first")
    links = written(verified(first, sets, rule), "links")
    once = joined_up(sets.select("sid", F.col("sid").alias("root")), links)
    out = within_groups(groups, stars.join(first, ["a", "b"], "left_anti"), once, sets, rule)
    discard(stars, first, links, once)
    return out


def with_roots(members: DataFrame, labels: DataFrame) -> DataFrame:
    """members(..., sid) with the root of their set: the set itself, where labels(sid, root) has none.
    Copies have one set, so they have one root."""
    return members.join(labels, "sid", "left").withColumn("root", F.coalesce("root", "sid"))


def component_ids(members: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id) of members(doc_id, n_shingles, sid): a component is named by its
    least document. Sets, one row each, are joined; rows without a set are their own component."""
    own = members.filter("sid is not null").groupBy("sid").agg(F.min("doc_id").alias("least"))
    named = with_roots(own, labels)
    roots = named.groupBy("root").agg(F.min("least").alias("component_id"))
    by_set = named.select("sid", "root").join(roots, "root").select("sid", "component_id")
    return members.join(by_set, "sid", "left").select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))

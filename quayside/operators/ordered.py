"""Running sums and folds in an order, without one task for a key: rows are dealt into ranges of the order, each range
is gone through in order, and what the ranges before it add up to is put on top."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..shared import discard, written

CHUNK_BYTES = 1 << 20  # of a fold's input in one row
ROUND_BYTES = 256 << 20  # of keys that are folded at once, at least
#: Pieces are written and read in groups of about 8 MB, whose size is looked at with every row: writers and readers hold a group at once.
SMALL_GROUPS = {"parquet.block.size": 8 << 20, "parquet.block.size.row.check.min": 1, "parquet.page.size.row.check.min": 1}


def in_ranges(rows: DataFrame, key: str, order: list[str]) -> DataFrame:
    """The rows in ranges of (key, order), sorted, written with their range and place there, so that all that follows
    sees the same ranges; equal rows of the order are in one range."""
    ranged = rows.repartitionByRange(*[F.col(c) for c in (key, *order)]).sortWithinPartitions(key, *order)
    return written(ranged.withColumn("_part", F.spark_partition_id()).withColumn("_place", F.monotonically_increasing_id()), "ranged")


def carried(ranged: DataFrame, key: str, of_range: Column) -> DataFrame:
    """(_k, _p, _carry): for each key and range the sum of ``of_range``, an aggregate, over the ranges before it. A row for each range
    a key is in: the window is over few rows, whatever the key has."""
    sums = ranged.groupBy(F.col(key).alias("_k"), F.col("_part").alias("_p")).agg(of_range.alias("_sum"))
    before = Window.partitionBy("_k").orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    return sums.select("_k", "_p", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_carry"))


def numbered(rows: DataFrame, key: str, order: list[str], name: str = "seq") -> DataFrame:
    """The rows with consecutive numbers from 1 in each key (nulls are one key), in the order."""
    ranged = in_ranges(rows, key, order)
    first = ranged.groupBy(F.col(key).alias("_k2"), F.col("_part").alias("_p2")).agg(F.min("_place").alias("_first"))
    carry = carried(ranged, key, F.count("*")).join(first, F.expr("_k <=> _k2 AND _p = _p2")).drop("_k2", "_p2")
    out = ranged.join(carry, F.expr("_part = _p") & F.col(key).eqNullSafe(F.col("_k")))
    return out.withColumn(name, F.col("_place") - F.col("_first") + 1 + F.col("_carry")).drop("_part", "_place", "_k", "_p", "_first", "_carry")


def running(rows: DataFrame, key: str, order: list[str], value: str, name: str) -> DataFrame:
    """The rows with the sum of ``value`` (a long) over the rows before them in their key, in the order. Keys may be null.

    In a range one window for each key adds up no more than the range's rows.
    """
    ranged = in_ranges(rows, key, order)
    before = Window.partitionBy("_part", key).orderBy("_place").rowsBetween(Window.unboundedPreceding, -1)
    own = ranged.withColumn("_own", F.coalesce(F.sum(value).over(before), F.lit(0)))
    out = own.join(carried(ranged, key, F.sum(value)), F.expr("_part = _p") & F.col(key).eqNullSafe(F.col("_k")))
    return out.withColumn(name, F.col("_own") + F.col("_carry")).drop("_part", "_place", "_own", "_k", "_p", "_carry")


def halved(text: str) -> tuple[bool, bytes]:
    """(whether these are the bytes that a hexadecimal text stands for, the text's bytes or these)."""
    try:
        raw = bytes.fromhex(text)
    except ValueError:
        return False, text.encode()
    return (True, raw) if raw.hex() == text else (False, text.encode())


def halves(text: Column) -> tuple[Column, Column]:
    """As ``halved``, of a column."""
    raw = F.unhex(text)
    whole = F.coalesce(F.lower(F.hex(raw)) == text, F.lit(False))
    return whole, F.when(whole, raw).otherwise(text.cast("binary"))


def in_rounds(sizes: DataFrame, key: str, size: str) -> tuple[DataFrame, int]:
    """(_of, _round) of sizes(key, size), and the number of rounds: the largest first, each round about as much as the largest key, or a
    quarter of all (at most that and one key more), and no less than ``ROUND_BYTES``."""
    total, most = sizes.agg(F.sum(size), F.max(size)).first()
    bound = max(most, -(-total // 4), ROUND_BYTES)
    named = sizes.select(F.col(key).alias("_of"), F.col(size).alias("_size"), (-F.col(size)).alias("_down"), F.lit("").alias("_all"))
    if total <= bound:
        return named.select("_of", F.lit(0).cast("long").alias("_round")), 1
    before = running(named, "_all", ["_down", "_of"], "_size", "_before")
    return written(before.select("_of", F.floor(F.col("_before") / bound).cast("long").alias("_round")), "rounds"), (total - 1) // bound + 1


def folded_sha256(rows: DataFrame, key: str, order: list[str], text: str, size: str, sizes: DataFrame | None = None) -> DataFrame:
    """(key, n, total, sha256): for each key the SHA-256 of ``text`` (ASCII, never null) of its rows in order, one after the other, how
    many there are, and the sum of ``size``.

    Each range joins the texts of a key's run in pieces of ``CHUNK_BYTES``; then a key's pieces, not its rows, go through one
    task in order, a piece in memory at a time. So only that a digest must see all bytes in order is left in one task.
    Hexadecimal texts are moved as the bytes they stand for. ``sizes(_by, _bytes)`` are the keys' sizes, by which they are folded in
    rounds; the shuffle files of a round's ranges are gone before its pieces are folded, and those of a round before the next.
    """
    kind = dict(rows.dtypes)[key]
    arrow = pa.schema([("_key", pa.string()), ("_part", pa.int32()), ("_nth", pa.int64()), ("_n", pa.int64()), ("_total", pa.int64()), ("_hex", pa.bool_()), ("_piece", pa.binary())])

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, at, nth, n, total, length = [], None, 0, 0, 0, 0

        def done() -> pa.RecordBatch:
            row = (at[0], part, nth, n, total, at[1], b"".join(held))
            return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(row, arrow, strict=True)], schema=arrow)

        for batch in batches:
            if not batch.num_rows:
                continue
            part, raw = batch.column("_part")[0].as_py(), batch.column("_raw")
            ends = np.frombuffer(raw.buffers()[1], np.int32, len(raw) + 1, 4 * raw.offset)
            data = memoryview(raw.buffers()[2] or b"")
            own, half = batch.column("_key").dictionary_encode("encode"), batch.column("_hex").to_numpy(zero_copy_only=False)
            added = np.concatenate(([0], np.cumsum(batch.column("_size").fill_null(0).to_numpy())))
            mark = own.indices.to_numpy() * 2 + half
            cuts = [0, *(np.flatnonzero(mark[1:] != mark[:-1]) + 1).tolist(), len(mark)]
            for i, end in pairwise(cuts):
                if at != (now := (own[i].as_py(), bool(half[i]))):
                    if n:
                        yield done()
                        held, nth, n, total, length = [], nth + 1, 0, 0, 0
                    at = now
                while i < end:
                    j = min(max(int(np.searchsorted(ends, ends[i] + CHUNK_BYTES - length)), i + 1), end)
                    held.append(bytes(data[ends[i] : ends[j]]))
                    n, total, length = n + j - i, total + int(added[j] - added[i]), length + int(ends[j] - ends[i])
                    i = j
                    if length >= CHUNK_BYTES:
                        yield done()
                        held, nth, n, total, length = [], nth + 1, 0, 0, 0
        if n:
            yield done()

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, n, total, digest = None, 0, 0, hashlib.sha256()
        began = False

        def done() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([at], pa.string()), pa.array([n], pa.int64()), pa.array([total], pa.int64()), pa.array([digest.hexdigest()])], ["_key", "n", "total", "sha256"])

        for batch in batches:
            for own, count, size, half, piece in zip(*(batch.column(c) for c in ("_key", "_n", "_total", "_hex", "_piece")), strict=True):
                if not began or own.as_py() != at:
                    if began:
                        yield done()
                    at, n, total, digest, began = own.as_py(), 0, 0, hashlib.sha256(), True
                n += count.as_py()
                total += size.as_py()
                digest.update(piece.as_py().hex().encode() if half.as_py() else piece.as_buffer())
        if began:
            yield done()

    whole, raw = halves(F.col(text))
    again = F.when(F.col("_hex"), F.lower(F.hex("_raw"))).otherwise(F.col("_raw").cast("string"))  # the text, for its order
    rounds, count = in_rounds(sizes, "_by", "_bytes") if sizes is not None else (None, 1)
    out = []
    for i in range(count):
        of = rows if count == 1 else rows.join(rounds.filter(F.col("_round") == i).select("_of"), F.col(key).eqNullSafe(F.col("_of")), "left_semi")
        moved = of.select(F.col(key).cast("string").alias("_key"), *[F.col(c).alias(f"_by_{c}") for c in order if c != text], whole.alias("_hex"), raw.alias("_raw"), F.col(size).cast("long").alias("_size"))
        by = ["_key", *[again if c == text else F.col(f"_by_{c}") for c in order]]
        ranged = moved.repartitionByRange(*by).sortWithinPartitions(*by).select("_key", F.spark_partition_id().alias("_part"), "_hex", "_raw", "_size")
        made = written(ranged.mapInArrow(pieces, "_key string, _part int, _nth long, _n long, _total long, _hex boolean, _piece binary"), "pieces", clean=True, **SMALL_GROUPS)
        folded = made.repartition("_key").sortWithinPartitions("_key", "_part", "_nth").mapInArrow(fold, "_key string, n long, total long, sha256 string")
        out.append(written(folded.select(F.col("_key").cast(kind).alias(key), "n", "total", "sha256"), "folded", clean=True))
        discard(made)
    return reduce(DataFrame.unionByName, out)

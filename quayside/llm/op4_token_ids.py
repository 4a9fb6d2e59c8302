"""Token-ID output: bit-plane shuffled, zstandard-compressed id files with a chunk index.

Ids are dealt by ranges of doc_id and sorted, so shard after shard and chunk after chunk the ids
stand in ascending doc_id order. A chunk holds whole documents. Its ids are cut in blocks of a
fixed number of ids; each block is transposed into byte planes (plane ``j`` holds byte ``j`` of
every id) or bit planes, planes that are zero throughout are left out, and every plane is
compressed on its own. The chunk index (documents, their lengths, where each block's planes end)
stands beside the planes, so any chunk can be read without its neighbours.

Shards are the part files of a table in the shared folder: any store that Spark writes to will do,
and a lost executor's shard is written again. Only the shards' totals, one row each, are summed
to give every shard the number of ids before it.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import only, table, written
from .tokens import encoder as encoder_of

BLOCK = 16_384
CHUNK_IDS = 262_144
ROWS = 1000  # texts that a task takes at a time
SHARD_CHARS = 16 << 20  # characters of text in a shard, about
CHUNK_SCHEMA = (
    "shard int, chunk int, first long, n_ids long, doc_ids array<long>, doc_sizes array<long>,"
    " block int, bits boolean, width int, plane_ends array<int>, planes binary"
)


def encode_block(ids: np.ndarray, width: int, bits: bool) -> list[bytes]:
    """The planes of one block, least significant first."""
    raw = ids.astype("<u4").view(np.uint8).reshape(-1, 4)
    if bits:
        planes = np.packbits(np.unpackbits(raw, axis=1, bitorder="little").T[:width], axis=1)
    else:
        planes = raw.T[:width]
    return [np.ascontiguousarray(p).tobytes() for p in planes]


def decode_block(planes: list[bytes], n: int, bits: bool) -> np.ndarray:
    if bits:
        rows = np.zeros((32, n), np.uint8)
        for i, p in enumerate(planes):
            rows[i] = np.unpackbits(np.frombuffer(p, np.uint8))[:n]
        return np.ascontiguousarray(np.packbits(rows.T, axis=1, bitorder="little")).view("<u4").reshape(n)
    out = np.zeros((n, 4), np.uint8)
    for i, p in enumerate(planes):
        out[:, i] = np.frombuffer(p, np.uint8)
    return out.view("<u4").reshape(n)


def encode_chunk(ids: np.ndarray, block: int = BLOCK, bits: bool = False) -> tuple[int, list[int], bytes]:
    """(planes in a block, end of each compressed plane, all planes)."""
    top = int(ids.max(initial=0))
    width = max(1, top.bit_length() if bits else (top.bit_length() + 7) // 8)
    press = zstandard.ZstdCompressor(level=3)
    ends, parts, at = [], [], 0
    for i in range(0, len(ids), block):
        for plane in encode_block(ids[i : i + block], width, bits):
            parts.append(press.compress(plane))
            at += len(parts[-1])
            ends.append(at)
    return width, ends, b"".join(parts)


def decode_chunk(n: int, block: int, bits: bool, width: int, ends: list[int], planes: bytes) -> np.ndarray:
    open_ = zstandard.ZstdDecompressor()
    cut = [0, *ends]
    parts = [open_.decompress(planes[a:b]) for a, b in zip(cut, cut[1:], strict=False)]
    blocks = [
        decode_block(parts[k * width : (k + 1) * width], min(block, n - k * block), bits) for k in range(-(-n // block))
    ]
    return np.concatenate(blocks) if blocks else np.zeros(0, np.uint32)


def to_bytes(ids: np.ndarray) -> bytes:
    """Ids as they are shuffled: their width, then all of them."""
    return b"\2" + ids.astype("<u2").tobytes() if ids.max(initial=0) < 1 << 16 else b"\4" + ids.astype("<u4").tobytes()


def from_bytes(raw: bytes) -> np.ndarray:
    return np.frombuffer(raw, f"<u{raw[0]}", offset=1).astype(np.uint32)


def encoded(docs: DataFrame, bounds: list[float], tokenizer: str | None, end_id: int) -> DataFrame:
    """(shard, doc_id, h, ids): h is a hash of the text; the shard is the range of doc_id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, cuts = encoder_of(tokenizer), np.array(bounds)
        for batch in batches:
            for at in range(0, len(batch), ROWS):
                part = batch.slice(at, ROWS)
                blobs = [to_bytes(np.append(ids, np.uint32(end_id))) for ids in encoder.encode(part.column("text").to_pylist())]
                name = part.column("doc_id")
                shard = np.searchsorted(cuts, name.cast(pa.float64(), safe=False).fill_null(-np.inf).to_numpy(zero_copy_only=False), side="right")
                yield pa.RecordBatch.from_arrays(
                    [pa.array(shard, pa.int32()), name, part.column("h"), pa.array(blobs, pa.binary())], ["shard", "doc_id", "h", "ids"]
                )

    return docs.select("doc_id", "text", F.xxhash64("text").alias("h")).mapInArrow(run, "shard int, doc_id long, h long, ids binary")


def write_ids(docs: DataFrame, tokenizer: str | None = None, end_id: int = 0, block: int = BLOCK, bits: bool = False) -> DataFrame:
    """Write ``docs(doc_id, text)`` to shards; returns the table of chunks.

    A null text is empty (its ids are the end id alone). Rows of one doc_id stand in the order of
    their texts' hashes, each as a document of its own; rows without doc_id come first.

    Shards are ranges of doc_id, one for each ``SHARD_CHARS`` of text; their bounds come from
    approximate quantiles of doc_id, so texts are encoded once, and ids are shuffled. Rows of one
    doc_id are in one shard; a shard's task holds one chunk at a time.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, chunk, first = None, 0, 0
        names: list = []
        held: list[np.ndarray] = []
        size = 0

        def emit() -> pa.RecordBatch:
            ids = np.concatenate(held)
            width, ends, planes = encode_chunk(ids, block, bits)
            row = [shard, chunk, first, len(ids), names, [len(x) for x in held], block, bits, width, ends, planes]
            return pa.RecordBatch.from_arrays([pa.array([v], type=f.type) for v, f in zip(row, _ARROW, strict=True)], schema=_ARROW)

        for batch in batches:
            for own, name, blob in zip(*(batch.column(c).to_pylist() for c in ("shard", "doc_id", "ids")), strict=True):
                if held and (own != shard or size >= CHUNK_IDS):
                    yield emit()
                    chunk, first = chunk + 1, first + size
                    names, held, size = [], [], 0
                if own != shard:
                    shard, chunk, first = own, 0, 0
                names.append(name)
                held.append(from_bytes(blob))
                size += len(held[-1])
        if held:
            yield emit()

    docs = only(docs, doc_id="long", text="string")
    n = max(1, math.ceil((docs.agg(F.sum(F.length("text").cast("long"))).first()[0] or 0) / SHARD_CHARS))
    bounds = docs.select("doc_id").approxQuantile("doc_id", [i / n for i in range(1, n)], 0.1 / n) if n > 1 else []
    dealt = encoded(docs, sorted(set(bounds)), tokenizer, end_id).repartition(n, "shard").sortWithinPartitions("shard", "doc_id", "h")
    return written(dealt.mapInArrow(run, CHUNK_SCHEMA), "ids")


_ARROW = pa.schema(
    [("shard", pa.int32()), ("chunk", pa.int32()), ("first", pa.int64()), ("n_ids", pa.int64()), ("doc_ids", pa.list_(pa.int64())),
     ("doc_sizes", pa.list_(pa.int64())), ("block", pa.int32()), ("bits", pa.bool_()), ("width", pa.int32()),
     ("plane_ends", pa.list_(pa.int32())), ("planes", pa.binary())]
)


def placed(chunks: DataFrame) -> DataFrame:
    """Chunks with ``base``, the ids of all chunks before: a running sum over one row a shard."""
    totals = chunks.groupBy("shard").agg(F.sum("n_ids").alias("total"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.select("shard", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("offset"))
    return chunks.join(F.broadcast(bases), "shard").withColumn("base", F.col("offset") + F.col("first"))


def read_ids(chunks: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids array<int>) of every document, from the files."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids = _ids(row)
                ends = np.cumsum(row["doc_sizes"])
                offsets = pa.array(np.concatenate(([0], ends)), pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(row["doc_ids"], pa.int64()), pa.array(row["base"] + ends - row["doc_sizes"], pa.int64()),
                     pa.array(row["doc_sizes"], pa.int64()), pa.ListArray.from_arrays(offsets, pa.array(ids.astype(np.int32)))],
                    ["doc_id", "start", "n_tokens", "ids"],
                )

    return placed(chunks).mapInArrow(run, "doc_id long, start long, n_tokens long, ids array<int>")


def read_digests(chunks: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, from the files."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids = _ids(row)
                sizes = np.array(row["doc_sizes"], np.int64)
                ends = np.cumsum(sizes)
                crc = [zlib.crc32(x.tobytes()) for x in np.split(ids, ends[:-1])]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(row["doc_ids"], pa.int64()), pa.array(row["base"] + ends - sizes), pa.array(sizes), pa.array(crc, pa.int64())],
                    ["doc_id", "start", "n_tokens", "ids_crc32"],
                )

    return placed(chunks).mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def _ids(row: dict) -> np.ndarray:
    return decode_chunk(row["n_ids"], row["block"], row["bits"], row["width"], row["plane_ends"], row["planes"])


def op4_token_ids(spark, sf_dir: str) -> DataFrame:
    return read_digests(write_ids(table(spark, sf_dir, "documents")))


QUERIES = {"op4_token_ids": op4_token_ids}
ORACLE_SQL: dict[str, str] = {}

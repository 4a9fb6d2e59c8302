"""Shared helpers: tables, shared-folder writes, word shingles, packed column blobs."""

from __future__ import annotations

import pickle
import sys
import types

import numpy as np
import xxhash
import zstandard
from pyspark import cloudpickle
from pyspark.core.broadcast import Broadcast
from pyspark.sql import DataFrame, SparkSession

from ..shared import discard, shared_dir, written  # noqa: F401

U64 = np.uint64
_MASK = (1 << 64) - 1


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def only(df: DataFrame, **columns: str) -> DataFrame:
    """The named columns cast to their types (absent ones null): extra columns never clash."""
    from pyspark.sql import functions as F

    have = set(df.columns)
    return df.select(*[(df[c] if c in have else F.lit(None)).cast(t).alias(c) for c, t in columns.items()])


def share(spark: SparkSession, value: object) -> Broadcast:
    """Broadcast an object of this package by value: workers need no installed copy to read it."""
    return spark.sparkContext.broadcast(cloudpickle.dumps(value))


def shared_value(broadcast: Broadcast) -> object:
    return pickle.loads(broadcast.value)


def worker_cache() -> dict:
    """What a Python worker keeps from task to task. (Functions of this package reach workers by
    value, so their own globals last for one task only.)"""
    return sys.modules.setdefault("_quayside_worker", types.ModuleType("_quayside_worker")).__dict__


# ---------------------------------------------------------------- words and shingles


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (the public splitmix64 constants)."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U64(27))
    x = x * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def words_of(text: str | None) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` with A-Z lower-cased (bytes.lower and bytes.split are
    ASCII-only, which is exactly this definition)."""
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


class WordHasher:
    """The words of a text, as ``words_of`` has them, each as a 64-bit hash.

    A word's hash is a polynomial modulo 2**64 in fixed random numbers of its bytes, mixed with its
    length. All come from one running sum over the text: a word's part of the sum, times the
    inverse power of the place where it begins. Long texts go in pieces cut between words.
    With ``plain`` all ASCII signs but letters and digits separate words, too.
    """

    BASE = 0x9E3779B97F4A7C15 | 1
    PIECE = 1 << 20

    def __init__(self, plain: bool = False):
        byte = mix(np.arange(1, 257, dtype=U64) * U64(0xD1342543DE82EF95)) | U64(1)
        byte[65:91] = byte[97:123]  # A-Z as a-z
        space = np.zeros(256, bool)
        space[[9, 10, 11, 12, 13, 32]] = True
        if plain:
            space[:128] = [not chr(c).isalnum() for c in range(128)]
        self.byte, self.space = byte, space
        self._powers(1 << 12)

    def _powers(self, size: int) -> None:
        self.up = np.full(size, U64(self.BASE))
        self.down = np.full(size, U64(pow(self.BASE, -1, 1 << 64)))
        self.up[0] = self.down[0] = 1
        np.cumprod(self.up, out=self.up)
        np.cumprod(self.down, out=self.down)

    def __call__(self, text: str | None) -> np.ndarray:
        if not text:
            return np.zeros(0, U64)
        raw = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
        if len(raw) <= self.PIECE:
            return self._piece(raw)
        cuts, at = [], self.PIECE
        gaps = np.flatnonzero(self.space[raw])
        while at < len(raw):
            i = np.searchsorted(gaps, at)
            if i == len(gaps):
                break
            cuts.append(int(gaps[i]))
            at = cuts[-1] + self.PIECE
        return np.concatenate([self._piece(x) for x in np.split(raw, cuts)])

    def _piece(self, raw: np.ndarray) -> np.ndarray:
        n = len(raw)
        if n > len(self.up):
            self._powers(1 << n.bit_length())
        gap = np.ones(n + 2, bool)
        np.take(self.space, raw, out=gap[1:-1])
        edge = np.flatnonzero(gap[1:] != gap[:-1])
        begin, end = edge[::2], edge[1::2]
        total = np.zeros(n + 1, U64)
        np.cumsum(np.take(self.byte, raw) * self.up[:n], out=total[1:])
        return mix((total[end] - total[begin]) * self.down[begin] + (end - begin).astype(U64))


def shingle_hashes(hashes: np.ndarray, size: int = 5) -> np.ndarray:
    """One 64-bit hash per window of ``size`` words, in order; a shorter text is one shingle."""
    n = len(hashes)
    if n == 0:
        return hashes
    width = min(size, n)
    acc = np.full(n - width + 1, U64(width), dtype=U64)
    for i in range(width):
        acc = acc * U64(0x9E3779B97F4A7C15) + hashes[i : n - width + 1 + i]
        acc ^= acc >> U64(29)
    return mix(acc)


def distinct_sorted(values: np.ndarray) -> np.ndarray:
    """np.unique by plain sorting, which is several times faster on random 64-bit numbers."""
    if len(values) < 2:
        return values
    values = np.sort(values)
    return values[np.concatenate(([True], values[1:] != values[:-1]))]


def set_id(shingles: np.ndarray) -> int:
    """Signed 64-bit identity of a sorted shingle set."""
    return int(np.array(xxhash.xxh3_64_intdigest(shingles.tobytes()), dtype=U64).astype(np.int64))


# ---------------------------------------------------------------- packed blobs


def pack(*arrays: np.ndarray) -> bytes:
    """Arrays of numbers as one zstd-compressed blob, each stored as byte planes."""
    head, body = [np.array([len(arrays)], dtype="<u4").tobytes()], []
    for a in arrays:
        a = np.ascontiguousarray(a)
        planes = a.view(np.uint8).reshape(len(a), a.dtype.itemsize).T if len(a) else a.view(np.uint8)
        head.append(np.array([a.dtype.num, len(a)], dtype="<u4").tobytes())
        body.append(np.ascontiguousarray(planes).tobytes())
    return zstandard.ZstdCompressor(level=1).compress(b"".join(head + body))


_TYPES = {np.dtype(t).num: np.dtype(t) for t in ("u1", "u2", "u4", "u8", "i4", "i8", "f4", "f8", np.ulonglong, np.longlong)}


def unpack(blob: bytes) -> list[np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(blob)
    n = int(np.frombuffer(raw, "<u4", 1)[0])
    meta = np.frombuffer(raw, "<u4", 2 * n, 4).reshape(n, 2)
    at, out = 4 + 8 * n, []
    for num, size in meta.tolist():
        kind = _TYPES[num]
        planes = np.frombuffer(raw, np.uint8, size * kind.itemsize, at).reshape(kind.itemsize, size)
        out.append(planes.T.copy(order="C").view(kind).reshape(size) if size else np.zeros(0, kind))
        at += size * kind.itemsize
    return out


def spans(sorted_keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of equal values."""
    if not len(sorted_keys):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    cut = np.flatnonzero(sorted_keys[1:] != sorted_keys[:-1]) + 1
    return np.concatenate(([0], cut)), np.concatenate((cut, [len(sorted_keys)]))

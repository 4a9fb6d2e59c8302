"""Whole texts to token ids with a public byte-level BPE tokenizer, faster than text by text."""

from __future__ import annotations

import json
import os
from collections.abc import Iterator

import numpy as np

from .common import U64, mix, spans, worker_cache

DEFAULT = "byte_bpe_50k.json"


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(DEFAULT)


def encoder(path: str | None = None, kept: int | None = None) -> Encoder:
    """This worker's encoder, with the pieces that earlier tasks met (so many at most, if given)."""
    cache = worker_cache()
    if ("encoder", path) not in cache:
        cache["encoder", path] = Encoder(path)
    cache["encoder", path].LIMIT = kept or Encoder.LIMIT
    return cache["encoder", path]


def ranges(begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """begin[0], begin[0] + 1, ... (size[0] numbers), begin[1], ..."""
    ends = np.cumsum(size)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(begin - ends + size, size)


class Encoder:
    """Encodes texts as ``Tokenizer.encode(text, add_special_tokens=False)`` does.

    The tokenizer first cuts a text by its pattern and then encodes each piece on its own; none of
    its pieces crosses from a non-space to a white space character. So a text may be cut before a
    single space that a visible character follows, and around a single line feed between visible
    characters, without changing an id. Pieces are looked up by a hash; only pieces never seen before
    (by this worker, since the table last filled up) go through the tokenizer. The bytes of what was
    looked up are compared with the text's, so a hash that two pieces share changes nothing: such a
    text, like one that holds the string of a special token, goes through the tokenizer as a whole.
    """

    LIMIT = 2_000_000  # pieces kept: about 50 bytes each
    BASE = 0x9E3779B97F4A7C15 | 1
    BATCH = 2 << 20
    LEARN = 20_000  # pieces that go through the tokenizer together

    def __init__(self, path: str | None = None):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        path = path or default_path()
        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.special = [t["content"] for t in spec.get("added_tokens", ())]
        vocab = spec["model"]["vocab"]
        self.bytes_of = np.zeros(max(vocab.values()) + 1, np.int64)
        for token, i in vocab.items():
            self.bytes_of[i] = len(token)  # byte-level: one character a byte
        self.byte = mix(np.arange(1, 257, dtype=U64) * U64(0xD1342543DE82EF95)) | U64(1)
        # bytes that begin no white space character, and are not control characters
        self.solid = np.ones(256, bool)
        self.solid[:33] = False
        self.solid[[0x7F, 0xC2, 0xE1, 0xE2, 0xE3]] = False
        self.space = np.zeros(256, bool)
        self.space[[9, 10, 11, 12, 13, 32]] = True
        self._powers(1 << 12)
        self._forget()

    def _powers(self, size: int) -> None:
        self.up = np.full(size, U64(self.BASE))
        self.down = np.full(size, U64(pow(self.BASE, -1, 1 << 64)))
        self.up[0] = self.down[0] = 1
        np.cumprod(self.up, out=self.up)
        np.cumprod(self.down, out=self.down)

    def _forget(self) -> None:
        self.key = np.zeros(0, U64)
        self.piece = np.zeros(0, np.int32)  # of each key, in order of learning:
        self.at = np.zeros(0, np.int64)  # its ids
        self.size = np.zeros(0, np.int32)
        self.pool = np.zeros(0, np.uint32)
        self.text_at = np.zeros(0, np.int64)  # and its bytes
        self.text_size = np.zeros(0, np.int32)
        self.text = np.zeros(0, np.uint8)

    def _cut(self, raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Begins of the pieces, and their hashes."""
        n = len(raw)
        if n + 1 > len(self.up):
            self._powers(1 << (n + 1).bit_length())
        solid = np.zeros(n + 1, bool)  # of the next byte
        np.take(self.solid, raw, out=solid[:-1])
        cut = np.zeros(n, bool)
        cut[0] = True
        cut[:-1] |= (raw[:-1] == 32) & solid[1:-1]
        feed = np.flatnonzero((raw[1:] == 10) & solid[: n - 1] & solid[2:]) + 1
        # a trailing byte may belong to a white space character: only ASCII may stand before
        feed = feed[raw[feed - 1] < 0x80]
        cut[feed] = True
        cut[feed + 1] = True
        begin = np.flatnonzero(cut)
        total = np.zeros(n + 1, U64)
        np.cumsum(np.take(self.byte, raw) * self.up[:n], out=total[1:])
        end = np.append(begin[1:], n)
        return begin, mix((total[end] - total[begin]) * self.down[begin] + (end - begin).astype(U64))

    def _together(self, raw: np.ndarray, begin: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(all ids, how many each piece has) of pieces without inner white space, encoded as one text:
        those that begin with no space come after a line feed, whose id is left out again."""
        bare = raw[begin] != 32
        length = size + bare
        flat = np.full(int(length.sum()), 10, np.uint8)
        first = np.cumsum(length) - length
        flat[ranges(first + bare, size)] = raw[ranges(begin, size)]
        got = np.array(self.tokenizer.encode(flat.tobytes().decode("utf-8"), add_special_tokens=False).ids, dtype=np.uint32)
        stop = np.searchsorted(np.cumsum(self.bytes_of[got]), first + length) + 1
        start = np.concatenate(([0], stop[:-1])) + bare
        return got[ranges(start, stop - start)], stop - start

    def _learn(self, keys: np.ndarray, raw: np.ndarray, begin: np.ndarray, size: np.ndarray) -> None:
        """Encode new pieces ``raw[begin : begin + size]``, in the order of their keys."""
        spaces = np.concatenate(([0], np.cumsum(self.space[raw])))
        lead = raw[begin] == 32
        last = raw[begin + size - 1]
        head = np.minimum(begin + lead, len(raw) - 1)
        plain = (size > lead) & (spaces[begin + size] == spaces[begin + lead]) & self.solid[raw[head]] & (last < 0x80) & (last > 32)
        some, rest = np.flatnonzero(plain), np.flatnonzero(~plain)
        ids, n = [], np.zeros(len(keys), np.int64)
        for k in range(0, len(some), self.LEARN):
            own = some[k : k + self.LEARN]
            got, n[own] = self._together(raw, begin[own], size[own])
            ids.append(got)
        texts = [raw[b : b + s].tobytes().decode("utf-8", "replace") for b, s in zip(begin[rest].tolist(), size[rest].tolist(), strict=True)]
        for i, e in zip(rest.tolist(), self.tokenizer.encode_batch(texts, add_special_tokens=False), strict=True):
            ids.append(np.array(e.ids, dtype=np.uint32))
            n[i] = len(e.ids)
        order = np.concatenate((some, rest))  # ids stand in this order
        n, size = n[order], size[order]
        self.at = np.concatenate((self.at, len(self.pool) + np.cumsum(n) - n))
        self.size = np.concatenate((self.size, n.astype(np.int32)))
        self.pool = np.concatenate([self.pool, *ids])
        self.text_at = np.concatenate((self.text_at, len(self.text) + np.cumsum(size) - size))
        self.text_size = np.concatenate((self.text_size, size.astype(np.int32)))
        self.text = np.concatenate((self.text, raw[ranges(begin[order], size)]))
        number = np.empty(len(keys), np.int32)
        number[order] = len(self.piece) + np.arange(len(keys), dtype=np.int32)
        where = np.searchsorted(self.key, keys)
        self.key, self.piece = np.insert(self.key, where, keys), np.insert(self.piece, where, number)

    def _some(self, raws: list[bytes]) -> list[np.ndarray]:
        """Ids of some texts, none of them empty."""
        cuts = [self._cut(np.frombuffer(r, np.uint8)) for r in raws]
        offset = np.cumsum([0, *[len(r) for r in raws]])
        raw = np.frombuffer(b"".join(raws), np.uint8)
        keys = np.concatenate([k for _, k in cuts])
        begin = np.concatenate([b + o for (b, _), o in zip(cuts, offset, strict=False)])
        size = np.diff(begin, append=len(raw))
        if len(self.key) > self.LIMIT:
            self._forget()
        order = np.argsort(keys)
        first, end = spans(keys[order])
        wanted, where = keys[order][first], order[first]
        i = np.searchsorted(self.key, wanted)
        new = np.ones(len(wanted), bool)
        if len(self.key):
            new = self.key[np.minimum(i, len(self.key) - 1)] != wanted
        if new.any():
            self._learn(wanted[new], raw, begin[where[new]], size[where[new]])
            i = np.searchsorted(self.key, wanted)
        piece = np.empty(len(keys), np.int32)
        piece[order] = np.repeat(self.piece[i], end - first)
        same = (self.text_size[piece] == size).all() and np.array_equal(self.text[ranges(self.text_at[piece], self.text_size[piece])], raw)
        if not same:
            return [np.array(e.ids, np.uint32) for e in self.tokenizer.encode_batch([r.decode("utf-8", "replace") for r in raws], add_special_tokens=False)]
        n = self.size[piece].astype(np.int64)
        ids = self.pool[ranges(self.at[piece], n)]
        ends = np.cumsum(n)[np.cumsum([len(k) for _, k in cuts]) - 1]
        return np.split(ids, ends[:-1])

    def encode(self, texts: list[str | None]) -> Iterator[np.ndarray]:
        """uint32 ids of each text, in order; a null text is empty."""
        held, size = [], 0  # texts as bytes, or ids that are known

        def done() -> Iterator[np.ndarray]:
            raws = [x for x in held if isinstance(x, bytes)]
            got = iter(self._some(raws) if raws else ())
            for x in held:
                yield next(got) if isinstance(x, bytes) else x

        for t in texts:
            if not t:
                held.append(np.zeros(0, np.uint32))
            elif any(s in t for s in self.special):
                held.append(np.array(self.tokenizer.encode(t, add_special_tokens=False).ids, np.uint32))
            else:
                held.append(t.encode("utf-8", "surrogatepass"))
                size += len(held[-1])
            if size > self.BATCH:
                yield from done()
                held, size = [], 0
        yield from done()

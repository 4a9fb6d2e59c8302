"""Archive expansion: gzip, zip, tar and tar.gz resources become rows, in parallel over archives, layer
inside layer.

A task keeps a work list of open layers, each a stream over the one around it, and reads all of them in
one pass and in small chunks: whatever the archives unpack to, it holds one archive, one chunk a layer, one
part of a member and one batch of rows. Only a zip inside another archive is read twice, as its directory
stands at its end: from memory up to ``HOLD_BYTES``, beyond that by running the layers around it again.
"""

from __future__ import annotations

import io
import re
import tarfile
import zipfile
import zlib
from collections.abc import Callable, Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.names import sniff

BATCH_BYTES = 8 << 20  # of archives, or of members, that a task holds before it passes them on
PART_BYTES = 8 << 20  # of a member in one row
HOLD_BYTES = 8 << 20  # of a zip inside another archive that is kept in memory
CHUNK = 64 << 10
LAYERS = 8
BAD_ARCHIVE = (OSError, EOFError, zipfile.BadZipFile, tarfile.TarError, zlib.error, RuntimeError, NotImplementedError, ValueError)
SUFFIXES = (".tar.gz", ".tgz", ".gz", ".gzip", ".tar", ".zip")
_SUFFIX = re.compile("(" + "|".join(re.escape(s) for s in sorted(SUFFIXES, key=len, reverse=True)) + r")\Z")
TAR_MARK = slice(257, 262)


# ---------------------------------------------------------------- streams


class Forward(io.RawIOBase):
    """A stream that is read once, from front to end, with a look ahead."""

    def __init__(self, read: Callable[[int], bytes]):
        super().__init__()
        self._read, self._ahead = read, b""

    def readable(self) -> bool:
        return True

    def peek(self, n: int) -> bytes:
        while len(self._ahead) < n and (more := self._read(n - len(self._ahead))):
            self._ahead += more
        return self._ahead[:n]

    def read(self, n: int = -1) -> bytes:
        if n is None or n < 0:
            return b"".join(iter(lambda: self.read(CHUNK), b""))
        out, self._ahead = self._ahead[:n], self._ahead[n:]
        while len(out) < n and (more := self._read(n - len(out))):
            out += more
        return out


class Gunzip:
    """The bytes that gzip members of a stream hold, as they are asked for."""

    def __init__(self, source: Forward):
        self.source, self.inner, self.rest, self.began = source, None, b"", False

    def read(self, n: int) -> bytes:
        while True:
            if self.inner is None:
                self.rest = self.rest or self.source.read(CHUNK)
                if self.began:  # zeros may follow a member
                    while self.rest and not self.rest.strip(b"\0"):
                        self.rest = self.source.read(CHUNK)
                    self.rest = self.rest.lstrip(b"\0")
                if not self.rest:
                    return b""
                self.inner, self.began = zlib.decompressobj(wbits=31), True
            out = self.inner.decompress(self.rest, n)
            self.rest = self.inner.unconsumed_tail
            if self.inner.eof:
                self.rest, self.inner = self.inner.unused_data, None
            elif not out and not self.rest and not (more := self.source.read(CHUNK)):
                raise EOFError("the gzip stream ends before its end mark")
            elif not out and not self.rest:
                self.rest = more
            if out:
                return out


class Again(io.RawIOBase):
    """A stream with a place, by opening it anew where it has to go back."""

    def __init__(self, reopen: Callable[[], Forward]):
        super().__init__()
        self._reopen, self._at, self._stream, self._size = reopen, 0, reopen(), None

    def readable(self) -> bool:
        return True

    def seekable(self) -> bool:
        return True

    def tell(self) -> int:
        return self._at

    def seek(self, to: int, whence: int = 0) -> int:
        if whence == 2:
            if self._size is None:
                while self.read(CHUNK):
                    pass
                self._size = self._at
            to += self._size
        elif whence == 1:
            to += self._at
        if to < self._at:
            self._at, self._stream = 0, self._reopen()
        while self._at < to and self.read(min(CHUNK, to - self._at)):
            pass
        return self._at

    def read(self, n: int = -1) -> bytes:
        out = self._stream.read(n)
        self._at += len(out)
        return out


# ---------------------------------------------------------------- layers


class Event(NamedTuple):
    """A part of a file, or (data is null) what is wrong with an archive. The path has its place in each layer."""

    path: tuple
    name: str
    parent: str | None
    data: bytes | None
    part: int
    size: int  # of the file so far
    error: str | None = None


def kind_of(head: bytes) -> str | None:
    return "gzip" if head[:2] == b"\x1f\x8b" else "zip" if head[:2] == b"PK" else "tar" if head[TAR_MARK] == b"ustar" else None


def stripped(name: str) -> str:
    return _SUFFIX.sub("", name)


class Opened(NamedTuple):
    kinds: frozenset
    keep_packed: bool
    layers: int
    bad: dict

    def enters(self, path: tuple, name: str, head: bytes) -> str | None:
        kind = kind_of(head)
        packed = kind == "zip" and self.keep_packed and name.lower().endswith(".zip")
        return kind if kind in self.kinds and not packed and path not in self.bad else None


def files(kind: str, stem: str, source, anew, path: tuple) -> Iterator[tuple[tuple, str, Forward, Callable[[], Forward]]]:
    """(path, name, stream, how to open it again) of each file in an archive; a stream is to be used before the
    next. ``source()`` is the archive's stream, ``anew()`` one from its start again, or, of a zip, a seekable file."""
    if kind == "zip":
        with zipfile.ZipFile(anew()) as z:
            for i, info in enumerate(z.infolist()):
                if not info.is_dir():
                    with z.open(info) as member:
                        yield (*path, i), f"{stem}/{info.filename}", Forward(member.read), lambda info=info: Forward(z.open(info).read)
        return
    if kind == "gzip":
        inner = Forward(Gunzip(source()).read)
        if inner.peek(TAR_MARK.stop)[TAR_MARK] != b"ustar":
            yield (*path, 0), stem, inner, lambda: Forward(Gunzip(anew()).read)
            return
    else:
        inner = source()

    def again(k: int) -> Forward:
        outer = anew() if kind == "tar" else Forward(Gunzip(anew()).read)
        for i, t, info in tar_files(outer):
            if i == k:
                return Forward(t.extractfile(info).read)
        raise EOFError("a member is gone")

    for i, t, info in tar_files(inner):
        yield (*path, i), f"{stem}/{info.name}", Forward(t.extractfile(info).read), lambda i=i: again(i)
    while inner.read(CHUNK):  # what follows the end mark, so that a cut-off gzip is seen
        pass


def tar_files(stream) -> Iterator[tuple[int, tarfile.TarFile, tarfile.TarInfo]]:
    t = tarfile.open(fileobj=stream, mode="r|")
    for i, info in enumerate(t):
        t.members = []  # else every header seen is kept
        if info.isfile():
            yield i, t, info


class Raw:
    """Passes a stream on and keeps what went by until it is taken, in parts."""

    def __init__(self, stream: Forward, path: tuple, name: str, parent: str | None):
        self.stream, self.about, self.held, self.part, self.size = stream, (path, name, parent), [], 0, 0
        self.waiting = 0

    def read(self, n: int) -> bytes:
        out = self.stream.read(n)
        self.held.append(out)
        self.waiting += len(out)
        return out

    def taken(self, last: bool = False) -> Iterator[Event]:
        while self.waiting >= PART_BYTES or last and (self.waiting or not self.part):
            whole = b"".join(self.held)
            self.held = [whole[PART_BYTES:]] if len(whole) > PART_BYTES else []
            self.waiting -= (n := min(len(whole), PART_BYTES))
            self.size += n
            yield Event(*self.about, whole[:PART_BYTES], self.part, self.size)
            self.part += 1


def walk(path: tuple, name: str, parent: str | None, stream: Forward, reopen: Callable[[], Forward], here: Opened) -> Iterator[Event]:
    """A file in an archive, and, if it is an archive itself, all that is in it."""
    kind = here.enters(path, name, stream.peek(TAR_MARK.stop))
    raw = Raw(stream, path, name, parent)
    error = None
    if kind and len(path) >= here.layers:
        error, kind = f"ValueError: archives in more than {here.layers} layers", None
    try:
        if kind == "zip":
            while raw.size + raw.waiting <= HOLD_BYTES and raw.read(CHUNK):
                pass
            if raw.size + raw.waiting <= HOLD_BYTES:
                whole = b"".join(raw.held)
                yield from inside(kind, name, None, lambda: io.BytesIO(whole), here, path)
            else:
                yield from inside(kind, name, None, lambda: Again(reopen), here, path)
        elif kind:
            for event in inside(kind, name, lambda: Forward(raw.read), reopen, here, path):
                yield event
                yield from raw.taken()
    except BAD_ARCHIVE as e:
        error = f"{type(e).__name__}: {e}"
    if error:
        yield Event(path, name, parent, None, 0, 0, error)
    while True:
        yield from raw.taken()
        if not raw.read(CHUNK):
            break
    yield from raw.taken(last=True)


def inside(kind: str, name: str, source, anew, here: Opened, path: tuple) -> Iterator[Event]:
    for own, member, stream, reopen in files(kind, stripped(name), source, anew, path):
        yield from walk(own, member, name, stream, reopen, here)


def events(name: str, content: pa.Buffer | bytes, kind: str, here: Opened) -> Iterator[Event]:
    """All files in a resource that is an archive, at any depth; an error that ends the archive itself is raised."""

    def open_() -> Forward:
        return Forward(pa.BufferReader(content).read)

    return inside(kind, name, open_, (lambda: pa.BufferReader(content)) if kind == "zip" else open_, here, ())


def unpacked(name: str, content: pa.Buffer | bytes, kind: str, here: Opened) -> tuple[str | None, Iterator[Event]]:
    """(what is wrong with the archive, its files' parts). All of an archive's files or none are passed on, in each
    layer: the first reading goes to the end, to see which archives are whole, and what it finds is passed
    on if it is no more than ``BATCH_BYTES``; else a second reading enters only the whole ones."""
    bad, sizes, held, size = {}, {}, [], 0
    try:
        for e in events(name, content, kind, here._replace(bad=bad)):
            if e.error:
                bad[e.path] = e.error
                continue
            if e.part:
                sizes[e.path] = e.size
            size += len(e.data) + 200
            held = held if held is not None and size <= BATCH_BYTES else None
            if held is not None:
                held.append(e)
    except BAD_ARCHIVE as e:
        return f"{type(e).__name__}: {e}", iter(())
    if held is None:
        held = (e for e in events(name, content, kind, here._replace(bad=dict(bad))) if not e.error)
    else:
        held = (e for e in held if not any(e.path[:i] in bad for i in range(1, len(e.path))))
    return None, (e._replace(size=sizes.get(e.path, e.size), error=bad.get(e.path)) for e in held)


def listed(name: str, content: pa.Buffer | bytes, kind: str) -> tuple[str | None, list[tuple[str, int]]]:
    """(what is wrong, (name, size) of the files directly in an archive); a zip's sizes come from its directory."""
    stem, found = stripped(name), []
    try:
        if kind == "zip":
            with zipfile.ZipFile(pa.BufferReader(content)) as z:
                return None, [(f"{stem}/{i.filename}", i.file_size) for i in z.infolist() if not i.is_dir()]
        stream = Forward(pa.BufferReader(content).read)
        inner = Forward(Gunzip(stream).read) if kind == "gzip" else stream
        if kind == "tar" or inner.peek(TAR_MARK.stop)[TAR_MARK] == b"ustar":
            found = [(f"{stem}/{info.name}", info.size) for _, _, info in tar_files(inner)]
            while inner.read(CHUNK):
                pass
        else:
            found = [(stem, sum(map(len, iter(lambda: inner.read(CHUNK), b""))))]
    except BAD_ARCHIVE as e:
        return f"{type(e).__name__}: {e}", []
    return None, found


# ---------------------------------------------------------------- rows


def bounded(spark: SparkSession) -> None:
    """Batches for Python are bounded by bytes from here on: ten thousand archives are too much at once."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def packed(rows: Iterator[tuple[str, bytes]]) -> Iterator[pa.RecordBatch]:
    """(name, content) in batches of about ``BATCH_BYTES``."""
    held, size = [], 0

    def done() -> pa.RecordBatch:
        names, contents = zip(*held, strict=True)
        return pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(contents, pa.binary())], ["name", "content"])

    for row in rows:
        held.append(row)
        size += len(row[1]) + 200
        if size > BATCH_BYTES:
            yield done()
            held, size = [], 0
    if held:
        yield done()


def expand(
    resources: DataFrame, keep_packed: bool = False, use_zip: bool = True, use_tar_gz: bool = True, contents: bool = True, layers: int = LAYERS
) -> DataFrame:
    """The resources and what was in them: (bid, name, url, content_type, status_code, derived_from,
    content, size, error, part).

    Archives are told by their first bytes. A member of a zip or tar is named ``{stripped}/{member}``,
    what a gzip held ``{stripped}``; tar.gz is both. Members that are archives are expanded in turn,
    up to ``layers`` deep (1: only the resources themselves; a deeper archive has ``error`` set), and each
    file's ``derived_from`` names the archive around it. A file of more than ``PART_BYTES`` comes in rows
    numbered by ``part`` (0 for the first), each with the size of the whole file. A bad archive, in whatever layer,
    keeps its own rows, with ``error`` set, and gives none of its files. With ``keep_packed``, zip files by
    name (or, of resources, by type) stay packed; with ``contents`` false, the resources' own members come with null
    contents (a listing). Members inherit the status; null contents are no archive.
    """
    bounded(resources.sparkSession)
    cols = ["bid", "name", "url", "content_type", "status_code", "derived_from", "content"]
    kind = sniff("content")
    wanted = F.when((kind == "zip") & F.lit(use_zip), kind).when(kind.isin("gzip", "tar") & F.lit(use_tar_gz), kind)
    if keep_packed:
        packed = F.regexp_replace(F.lower("url"), "[?#].*$", "").endswith(".zip") | (F.lower("content_type") == "application/zip")
        wanted = F.when(~F.coalesce(packed, F.lit(False)), wanted)
    df = resources.select(*cols, wanted.alias("kind"))
    schema = "bid string, name string, url string, content_type string, status_code int, derived_from string, content binary, size long, error string, part int"
    kinds = {"content": pa.binary(), "status_code": pa.int32(), "size": pa.int64(), "part": pa.int32()}
    arrow = pa.schema([(c, kinds.get(c, pa.string())) for c in [*cols, "size", "error", "part"]])
    here = Opened(frozenset((["zip"] if use_zip else []) + (["gzip", "tar"] if use_tar_gz else [])), keep_packed, layers, {})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size = 0

        def done() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(zip(*held, strict=True), arrow, strict=True)], schema=arrow)

        def rows(batch: pa.RecordBatch, i: int) -> Iterator[tuple]:
            row = {c: batch.column(c)[i].as_py() for c in (*cols[:-1], "kind")}
            content, error = batch.column("content")[i], None
            if row["kind"]:
                base = row["url"].rsplit("/", 1)[0] + "/" if row["url"] and "/" in row["url"] else ""
                about = lambda name: (row["bid"], name, base + name.rsplit("/", 1)[-1], None, row["status_code"])
                name = row["name"] or ""
                if contents:
                    error, found = unpacked(name, content.as_buffer(), row["kind"], here)
                    for e in found:
                        yield *about(e.name), e.parent, e.data, e.size, e.error, e.part
                else:
                    error, found = listed(name, content.as_buffer(), row["kind"])
                    for member, n in found:
                        yield *about(member), name, None, n, None, 0
            whole = content.as_py()
            yield *(row[c] for c in cols[:-1]), whole, None if whole is None else len(whole), error, 0

        for batch in batches:
            for i in range(len(batch)):
                for row in rows(batch, i):
                    held.append(row)
                    size += len(row[6] or b"") + 200
                    if size > BATCH_BYTES:
                        yield done()
                        held, size = [], 0
        if held:
            yield done()

    return df.mapInArrow(run, schema)


def listing(resources: DataFrame) -> DataFrame:
    """(bid, derived_from, name, size) of every member, without contents."""
    return expand(resources, contents=False).filter("derived_from is not null").select("bid", "derived_from", "name", "size")


ALL = Opened(frozenset(("zip", "gzip", "tar")), False, LAYERS, {})
EXPANDED = "member string, derived_from string, part int, size long, body binary, error string"


def table_rows(name: str | None, content: pa.Buffer | bytes | None) -> Iterator[tuple]:
    """(member, derived_from, part, size, body, error): a row for each part of each file at any depth, and one for
    the archive itself only if it is bad. What is no archive gives none."""
    head = b"" if content is None else bytes(memoryview(content)[: TAR_MARK.stop])
    if kind := kind_of(head):
        error, found = unpacked(name or "", content, kind, ALL)
        if error:
            yield name, None, 0, len(content), None, error
        for e in found:
            yield e.name, e.parent, e.part, e.size, e.data, e.error


class Expand:
    """A row at a time: Spark takes no Arrow table function beside a LATERAL."""

    def eval(self, name: str, content: bytes) -> Iterator[tuple]:
        yield from table_rows(name, content)


class ExpandTable:
    """A whole TABLE(name, content) in record batches; the archive's name comes first."""

    def eval(self, table: pa.RecordBatch) -> Iterator[pa.Table]:
        fields = ("archive", "member", "derived_from", "part", "size", "body", "error")
        types = (pa.string(), pa.string(), pa.string(), pa.int32(), pa.int64(), pa.binary(), pa.string())
        held, size = [], 0

        def done() -> pa.Table:
            cols = zip(*held, strict=True) if held else [()] * len(fields)
            return pa.table({f: pa.array(v, t) for f, t, v in zip(fields, types, cols, strict=True)})

        for name, content in zip(table.column("name"), table.column("content"), strict=True):
            for row in table_rows(name.as_py(), content.as_buffer() if content.is_valid else None):
                held.append((name.as_py(), *row))
                size += len(row[4] or b"") + 200
                if size > BATCH_BYTES:
                    yield done()
                    held, size = [], 0
        yield done()


def register_expand(spark: SparkSession) -> None:
    """Make archives expand in any SQL text: ``FROM files, LATERAL expand_archive(name, content)``, a row at a time, or
    ``FROM expand_archives(TABLE(SELECT name, content FROM files))``, in record batches. Rows are those of ``expand``."""
    spark.udtf.register("expand_archive", F.udtf(Expand, returnType=EXPANDED))
    spark.udtf.register("expand_archives", F.arrow_udtf(ExpandTable, returnType=f"archive string, {EXPANDED}"))

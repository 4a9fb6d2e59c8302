import gzip
import io
import random
import tarfile
import zipfile

import pytest

from quayside.operators import archives

RESOURCE = "bid string, name string, url string, content_type string, status_code int, derived_from string, content binary"


def zipped(files):
    f = io.BytesIO()
    with zipfile.ZipFile(f, "w", zipfile.ZIP_DEFLATED) as z:
        for name, body in files:
            z.writestr(name, body)
    return f.getvalue()


def tarred(files, mode="w"):
    f = io.BytesIO()
    with tarfile.open(fileobj=f, mode=mode) as t:
        folder = tarfile.TarInfo("folder")
        folder.type = tarfile.DIRTYPE
        t.addfile(folder)
        for name, body in files:
            info = tarfile.TarInfo(name)
            info.size = len(body)
            t.addfile(info, io.BytesIO(body))
    return f.getvalue()


def resources(spark, *named):
    return spark.createDataFrame([("b", n, f"http://x/{n}" if n else None, t, 200, None, c) for n, t, c in named], RESOURCE)


def expanded(spark, *named, **kw):
    """(name, derived_from) -> (content, error); parts are put together, and their sizes are those of the whole."""
    found = {}
    for r in sorted(archives.expand(resources(spark, *named), **kw).collect(), key=lambda r: r["part"]):
        key = (r["name"], r["derived_from"])
        body, error, size, parts = found.get(key, (b"", r["error"], r["size"], 0))
        assert r["part"] == parts and r["error"] == error and r["size"] == size and r["status_code"] == 200
        found[key] = (body + bytes(r["content"] or b""), error, size, parts + 1)
    assert all(len(b) == n or b == b"" for b, _, n, _ in found.values())
    return {k: (b, e) for k, (b, e, _, _) in found.items()}


NOISE = random.Random(1).randbytes(300_000)


def deep(text=b"leaf"):
    return zipped([("in.tar.gz", tarred([("d/text.gz", gzip.compress(text)), ("plain.txt", b"plain")], "w:gz")), ("top.txt", b"top")])


def test_layers_in_layers(spark):
    got = expanded(spark, ("p.zip", None, deep()))
    assert {k: b for k, (b, _) in got.items() if k[0].endswith(("text", "txt"))} == {
        ("p/in/d/text", "p/in/d/text.gz"): b"leaf", ("p/in/plain.txt", "p/in.tar.gz"): b"plain", ("p/top.txt", "p.zip"): b"top",
    }
    assert {k for k in got if k[0].endswith("z") or k[0].endswith("p")} == {("p.zip", None), ("p/in.tar.gz", "p.zip"), ("p/in/d/text.gz", "p/in.tar.gz")}
    assert not any(e for _, e in got.values())
    one = expanded(spark, ("p.zip", None, deep()), layers=1)
    assert len(one) == 3 and "layers" in one["p/in.tar.gz", "p.zip"][1]
    assert len(expanded(spark, ("p.zip", None, deep()), use_zip=False)) == 1
    assert set(expanded(spark, ("p.zip", None, deep()), use_tar_gz=False)) == {("p.zip", None), ("p/in.tar.gz", "p.zip"), ("p/top.txt", "p.zip")}


@pytest.mark.parametrize("batch", [32 << 20, 1000])
def test_bad_layers_keep_their_rows(spark, monkeypatch, batch):
    """A bad inner archive gives its own row and none of its files, whether one reading is enough or two are needed."""
    monkeypatch.setattr(archives, "BATCH_BYTES", batch)
    cut = tarred([("a", NOISE), ("b", b"b")], "w:gz")[:-5000]
    whole = zipped([("good.gz", gzip.compress(b"good")), ("bad.gz", gzip.compress(NOISE)[:-9]), ("bad.tgz", cut), ("bad.zip", b"PK no zip"), ("wrong.gz", b"\x1f\x8b wrong")])
    got = expanded(spark, ("w.zip", None, whole))
    assert got["w/good", "w/good.gz"] == (b"good", None)
    assert {k[0] for k, (_, e) in got.items() if e} == {"w/bad.gz", "w/bad.tgz", "w/bad.zip", "w/wrong.gz"}
    assert len(got) == 7 and got["w/bad.tgz", "w.zip"][0] == cut
    bad = bytearray(zipped([("x", b"x" * 1000), ("y.gz", gzip.compress(b"y"))]))
    bad[33] ^= 255  # the first member's data
    got = expanded(spark, ("z.zip", None, bytes(bad)), ("e.gz", None, b"\x1f\x8b"), ("n.gz", None, None), ("t.txt", None, b"text"), ("empty.gz", None, gzip.compress(b"")))
    assert {k: e is not None for k, (_, e) in got.items()} == {
        ("z.zip", None): True, ("e.gz", None): True, ("n.gz", None): False, ("t.txt", None): False, ("empty.gz", None): False, ("empty", "empty.gz"): False,
    }


@pytest.mark.parametrize("hold", [8 << 20, 50])
def test_parts_and_streams(spark, monkeypatch, hold):
    """Files over the size of a part come in parts; zips inside archives are read from memory or by opening them again."""
    for name, value in (("PART_BYTES", 70_000), ("HOLD_BYTES", hold), ("BATCH_BYTES", 100_000), ("CHUNK", 1000)):
        monkeypatch.setattr(archives, name, value)
    inner = zipped([("big", NOISE), ("small", b"s")])
    many = [(f"f{i}.zip", zipped([("one", b"%d" % i)])) for i in range(5)]
    got = expanded(spark, ("a.tar.gz", None, tarred([*many, ("in.zip", inner)], "w:gz")), ("b.tar", None, tarred([("in.zip", inner)])), ("c.gz", None, gzip.compress(inner)),
                   ("d.zip", None, zipped([("in.zip", inner)])), ("two.gz", None, gzip.compress(NOISE) + gzip.compress(b"more") + bytes(9)))
    for around in ("a/in", "b/in", "c", "d/in"):
        own = [k for k in got if k[0] == f"{around}/big"]
        assert len(own) == 1 and got[own[0]][0] == NOISE
    assert got["c/small", "c"][0] == b"s" and got["two", "two.gz"][0] == NOISE + b"more"
    assert all(got[f"a/f{i}/one", f"a/f{i}.zip"][0] == b"%d" % i for i in range(5))
    assert not any(e for _, e in got.values())


def test_memory_of_a_large_member():
    """A gzip of zeros unpacks to 200 MB within a few parts of memory."""
    import tracemalloc

    import pyarrow as pa

    packed = gzip.compress(gzip.compress(bytes(200 << 20), 1))
    here = archives.Opened(frozenset(("zip", "gzip", "tar")), False, 8, {})
    tracemalloc.start()
    total = sum(len(e.data) for e in archives.events("z.gz.gz", pa.py_buffer(packed), "gzip", here) if e.name == "z")
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert total == 200 << 20 and most < 6 * archives.PART_BYTES


def test_packed_and_listed(spark):
    named = ("p.zip", None, deep()), ("q", "application/zip", deep()), ("r.gz", None, gzip.compress(deep()))
    got = expanded(spark, *named, keep_packed=True)
    assert {k for k in got if k[1]} == {("r", "r.gz"), *((f"r/{x}", y) for x, y in (("in.tar.gz", "r"), ("in/d/text.gz", "r/in.tar.gz"), ("in/d/text", "r/in/d/text.gz"), ("in/plain.txt", "r/in.tar.gz"), ("top.txt", "r")))}
    listed = sorted(tuple(r)[1:] for r in archives.listing(resources(spark, *named[:1], ("t.tgz", None, tarred([("a", b"12")], "w:gz")), ("g.gz", None, gzip.compress(b"123")))).collect())
    assert listed == [("g.gz", "g", 3), ("p.zip", "p/in.tar.gz", listed[1][2]), ("p.zip", "p/top.txt", 3), ("t.tgz", "t/a", 2)]


def test_table_function(spark):
    """SQL text gives the rows of ``expand``."""
    named = [("p.zip", None, deep()), ("t.txt", None, b"text"), ("bad.gz", None, b"\x1f\x8b"), ("n", None, None)]
    archives.register_expand(spark)
    resources(spark, *named).createOrReplaceTempView("landed_files")
    whole = {k: b for k, (b, _) in expanded(spark, *named).items() if k[1]}
    for sql in ("SELECT name AS archive, e.* FROM landed_files, LATERAL expand_archive(name, content) AS e", "SELECT * FROM expand_archives(TABLE(SELECT name, content FROM landed_files))"):
        got = spark.sql(sql).collect()
        assert [(r["archive"], r["error"] is not None) for r in got if r["derived_from"] is None] == [("bad.gz", True)]
        assert {(r["member"], r["derived_from"]): bytes(r["body"]) for r in got if r["derived_from"]} == whole
        assert {r["archive"] for r in got if r["derived_from"]} == {"p.zip"}


def test_archives_are_packed_in_batches(spark, sf_dir, monkeypatch):
    """What is made, and what a worker is given, is bounded by bytes, not by rows alone."""
    from quayside import catalog_writes

    batches = list(archives.packed((str(i), b"x" * 100) for i in range(7)))
    assert [b.num_rows for b in batches] == [7]
    monkeypatch.setattr(archives, "BATCH_BYTES", 700)
    assert [b.num_rows for b in archives.packed((str(i), b"x" * 100) for i in range(7))] == [3, 3, 1] and list(archives.packed(iter(()))) == []
    catalog_writes._packed(spark, sf_dir, "tar")
    assert int(spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch")) == 700
    spark.conf.unset("spark.sql.execution.arrow.maxBytesPerBatch")

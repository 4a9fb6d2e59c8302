import datetime as dt
import fnmatch
import gzip
import hashlib
import io
import json
import random
import tarfile
import zipfile

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quayside.functions import names
from quayside.operators import archives, bundles, filters, registry, reports, state
from quayside.plans import requests
from quayside.schemas import RESOURCE
from quayside.sources import files
from quayside.sources.paged import read_paged

UTC = dt.UTC


def values(df, col):
    return [r[col] for r in df.collect()]


# ---------------------------------------------------------------- filters

NAMES = ["20250829c.txt", "20250913c.txt", "20250915c.txt", "20250828c.txt", "notes.txt", "120250901c.txt", "cordata.zip", "a&&b", "x]y", "x^y", "", "a\nb", "A.TXT"]
PATTERNS = ["????????c.txt", "*.txt", "[0-9]*", "[!0-9]*", "x[]^]y", "a&&b", "*", "a?b", "[a-z]&&[a-z]", "x[", "*[!a-m].txt", "a.*"]


def test_glob_like_fnmatch(spark):
    df = spark.createDataFrame([(n,) for n in NAMES], "n string")
    for p in PATTERNS:
        got = df.select("n", filters.glob("n", p).alias("ok")).collect()
        assert {r["n"] for r in got if r["ok"]} == {n for n in NAMES if fnmatch.fnmatchcase(n, p)}, p
    low = df.filter(filters.glob("n", "A*.TXT", case_sensitive=False)).collect()
    assert [r["n"] for r in low] == ["A.TXT"]


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="ab*?[]!-^.\\&", max_size=8))
def test_glob_regex_property(pattern):
    import re

    rx = filters.glob_regex(pattern).replace(r"\z", r"\Z") if pattern else ""
    for n in ("", "a", "b", "ab", "a-b", "]", "!", "^", "a.b", "\\", "&", "[a]", "*"):
        try:
            compiled = re.compile(rx)
        except re.error:  # a reversed range: no name matches in either dialect
            return
        if pattern and not re.search(r"\[[^\]]*.-.", pattern):
            assert bool(compiled.match(n)) == fnmatch.fnmatchcase(n, pattern), (pattern, n)


def test_date_filters(spark):
    df = spark.createDataFrame([(n,) for n in NAMES], "n string")
    any_ = values(df.filter(filters.any_date_from("n", "20250829")), "n")
    first = values(df.filter(filters.first_date_from("n", "20250829")), "n")
    assert set(any_) == {"20250829c.txt", "20250913c.txt", "20250915c.txt", "120250901c.txt"}
    assert set(first) == {"20250829c.txt", "20250913c.txt", "20250915c.txt"}
    with pytest.raises(ValueError):
        filters.any_date_from("n", "2025")


def test_composite_and_registry(spark):
    df = spark.createDataFrame([(n,) for n in NAMES], "n string")
    assert df.filter(filters.composite([])).count() == len(NAMES) and df.filter(filters.composite([], "OR")).count() == 0
    with pytest.raises(ValueError):
        filters.composite([], "XOR")
    r = registry.default_registry()
    f = r.create("composite_filter", {"filters": [{"type": "pattern_filter", "pattern": "????????c.txt"}, {"type": "date_filter", "start_date": "20250829"}]})
    assert df.filter(f("n")).count() == 3
    for bad in (("nothing", {}), ("pattern_filter", {}), ("date_filter", {"start_date": "20250829", "x": 1})):
        with pytest.raises(ValueError):
            r.create(*bad)
    by_python = registry.column_filter(lambda s: s.endswith("c.txt") and len(s) == 13, on_columns=False)
    assert df.filter(by_python("n")).count() == 4


def test_pages_and_status(spark):
    df = spark.createDataFrame([(10, "c", 5, 200), (10, "", 5, 200), (10, None, 5, 404), (10, "c", 0, 500), (30_000, "c", 5, 200)], "total long, cur string, n long, status int")
    assert df.filter(filters.more_pages("total", "cur", "n")).count() == 1 and df.filter(filters.too_broad("total")).count() == 1
    ok, no = filters.by_status(df, F.col("status") == 200)
    assert (ok.count(), no.count()) == (3, 2)


def test_golden_selection(spark):
    t = lambda d: dt.datetime(2025, 9, d, tzinfo=UTC)
    listing = spark.createDataFrame([(n, n, t(i + 1) if i else None, 1, i) for i, n in enumerate(NAMES[:7])], "path string, name string, mtime timestamp, length long, ordinal int")
    keep = filters.composite([filters.glob("name", "????????c.txt"), filters.first_date_from("name", "20250829")])
    got = values(registry.select_files(listing, keep, state.sort_by_mtime(reverse=True)), "path")
    assert got == ["20250829c.txt", "20250915c.txt", "20250913c.txt"]  # no mtime: first when descending
    known = spark.createDataFrame([("20250915c.txt",)], "path string")
    got = values(registry.select_files(listing, keep, state.sort_by_mtime(True, nulls_last=True), known, 1), "path")
    assert got == ["20250913c.txt"]
    found, missing = files.explicit_files(spark.createDataFrame([("cordata.zip",), ("gone",)], "path string"), listing)
    assert values(found, "path") == ["cordata.zip"] and values(missing, "path") == ["gone"]


# ---------------------------------------------------------------- names

GOLDEN = [
    ("2f5814543783d43c1fdd739a5088db2e5384360d6842f46bace48d1d0973c8b5", "8bd137065a12d11ac9fffbd3dcf1305932fc3002d8ff0e000503c55ccdbb61be"),
    ("b3a7dd309a31f0299bb7cfe99605b2262d4993b57a7d2fbe4f509a3c2444d8c3", "086fe282a72aebcd247ed93352f29d137b915991c6457ea46b6b97adb6720765"),
]


def test_golden_bundle_hash(spark):
    df = spark.createDataFrame([(f"b{i}", "n", h, 5) for i, (h, _) in enumerate(GOLDEN)], "bid string, name string, sha256 string, size long")
    assert {r["bid"]: r["bundle_hash"] for r in bundles.bundle_hashes(df).collect()} == {f"b{i}": b for i, (_, b) in enumerate(GOLDEN)}


def test_bids(spark):
    df = spark.createDataFrame([("us FL", dt.datetime(2025, 9, 18, 22, 30, 28, tzinfo=UTC), "u")], "r string, ts timestamp, u string").withColumn("bid", names.mint_bid("r", "ts", "u"))
    row = df.select("bid", names.bid_path("bid").alias("path"), names.bid_parts("bid").alias("p")).first()
    rnd = hashlib.sha256(b"u").hexdigest()[:8]
    assert row["bid"] == f"bid:v1:us-fl:20250918223028:{rnd}"
    assert row["path"] == f"raw/us-fl/data/year=2025/month=09/day=18/22-30-28-{rnd}"
    assert row["p"]["registry"] == "us-fl"
    bad = spark.createDataFrame([("bid:v1:x",), (None,)], "bid string").select(names.bid_parts("bid")["rnd"].alias("x"))
    assert values(bad, "x") == [None, None]


def test_urls(spark):
    cases = [
        ("https://h/a/b.txt?x=1#f", "a_b.txt", "b.txt"), ("https://h/", "index.html", None), ("https://h", "index.html", None),
        ("sftp:////doc/cor/é b.txt", "_doc_cor_é_b.txt", "é b.txt"), ("https://h/a/b;v=1", "a_b", "b"),
    ]
    df = spark.createDataFrame([(c[0],) for c in cases], "u string").select("u", names.safe_name("u").alias("s"), names.resource_name("u").alias("r"), names.object_key(F.lit("p"), F.lit("b"), "u").alias("k"))
    for (u, safe, base), r in zip(cases, df.collect(), strict=True):
        h = hashlib.sha256(u.encode()).hexdigest()[:8]
        assert (r["s"], r["r"], r["k"]) == (safe, base or f"resource_{h}", f"p/b/{base or h}")
    df = spark.createDataFrame([("a.tar.gz",), ("b.gz",), ("c.tgz",), ("d.tar",), ("e.txt",), ("f.gz.txt",)], "p string")
    assert values(df.select(names.strip_suffix("p").alias("s")), "s") == ["a", "b", "c", "d", "e.txt", "f.gz.txt"]


def test_small_functions(spark):
    one = spark.range(4).withColumn("a", F.col("id"))
    assert values(one.select(names.backoff("a", most=100.0).alias("d")), "d") == [1, 2, 4, 8]
    assert values(one.select(names.backoff("a", most=5.0).alias("d")), "d") == [1, 2, 4, 5]
    row = one.limit(1).select(
        names.prefixed_key(F.lit("k"), F.lit("p")).alias("a"), names.prefixed_key(F.lit("k"), F.lit("p:")).alias("b"), names.prefixed_key(F.lit("k"), F.lit("")).alias("c"),
        names.permissions(F.lit(0o100644)).alias("m"), names.run_id(F.lit("us_fl"), F.lit("2025-09-18 22:30:17").cast("timestamp")).alias("r"),
        names.strip_scheme(F.lit("sftp://a/sftp://b")).alias("s"), names.join_path(F.lit("/d/"), F.lit("f")).alias("j"),
        names.query_string({"nombre": F.lit(10), "q": F.lit("x")}, F.create_map(F.lit("q"), F.lit("y"), F.lit("z"), F.lit("1"))).alias("q"),
    ).first()
    assert tuple(row) == ("p:k", "p:k", "k", "0o100644", "fetcher_us_fl_20250918223017", "a/b", "/d/f", "nombre=10&q=y&z=1")
    meta = spark.createDataFrame([('{"url":"u"}',), ('{"url":"v","depth":3,"flags":{"x":true}}',)], "j string").select(names.request_meta("j").alias("m"))
    assert [tuple(r["m"]) for r in meta.collect()] == [("u", 0, None, {}, {}), ("v", 3, None, {}, {"x": True})]


# ---------------------------------------------------------------- state


def test_ranges_and_prefixes(spark):
    s = spark.createDataFrame([(f"user:{i}", str(i)) for i in range(10)] + [("item:1", "a"), ("item:2", "b"), ("item:3", "c"), ("error:1", "e")], "k string, v string")
    users = state.key_prefix(s, "user:")
    assert state.key_range(users, "user:3").count() == 7 and state.key_range(users, "user:3", "user:7").count() == 4
    assert values(state.key_range(users, "user:0", limit=5), "k") == [f"user:{i}" for i in range(5)]
    assert values(state.key_range(s, "item:1", "item:3"), "k") == ["item:1", "item:2"]


def test_put_log(spark):
    t = lambda h: dt.datetime(2024, 1, 1, h, tzinfo=UTC)
    log = [("a", "1", t(1), 1, None), ("a", "2", t(2), 2, t(3)), ("b", "1", t(1), 3, t(2)), ("b", "2", t(1), 4, None), ("c", "x", t(9), 5, None)]
    df = spark.createDataFrame(log, "k string, v string, put_at timestamp, seq long, expires_at timestamp")
    at = lambda h: {r["k"]: r["v"] for r in state.current(df, F.lit(t(h))).collect()}
    assert at(2) == {"a": "2", "b": "2"} and at(3) == {"a": "2", "b": "2"} and at(4) == {"b": "2"}
    view = state.current(df, F.lit(t(2)))
    gone, report = state.delete(view, spark.createDataFrame([("a",), ("zz",)], "k string"), F.lit(t(2)))
    assert values(gone, "k") == ["a"] and {r["k"]: r["existed"] for r in report.collect()} == {"a": True, "zz": False}
    assert state.get(spark.createDataFrame([("q",)], "k string"), view, "none").first()["v"] == "none"


def test_merge(spark):
    t = lambda h: dt.datetime(2024, 1, 1, h, tzinfo=UTC)
    df = spark.createDataFrame([("s", {"key1": "value1", "count": "10"}, t(1), 1), ("s", {"count": "15", "new_key": "new_value"}, t(2), 2)], "k string, state map<string,string>, put_at timestamp, seq long")
    assert state.merge_states(df).first()["state"] == {"key1": "value1", "count": "15", "new_key": "new_value"}


def test_modified_since(spark):
    l = spark.createDataFrame([("file1", 100.0), ("file2", 200.0), ("file3", 5.0)], "path string, mtime double")  # noqa: E741
    seen = spark.createDataFrame([("file1", 100.0), ("file2", 150.0)], "path string, last_mtime double")
    assert set(values(state.modified_since(l, seen), "path")) == {"file2", "file3"}


def test_queue(spark):
    items = spark.createDataFrame([("a" if i % 4 else "b", i) for i in range(200)], "ns string, i long").repartition(7)
    q = state.enqueue(items, ["i"], base=spark.createDataFrame([("b", 11)], "ns string, next_id long"))
    rows = sorted((r["ns"], r["i"], r["seq"]) for r in q.collect())
    assert [r[2] for r in rows if r[0] == "a"] == list(range(1, 151)) and [r[2] for r in rows if r[0] == "b"] == list(range(11, 61))
    taken, left = state.dequeue(q.filter("ns = 'a'"), 5)
    assert values(taken, "seq") == [1, 2, 3, 4, 5] and left.count() == 145
    audit = state.queue_audit(q, spark.createDataFrame([("a", 151, 150), ("b", 61, 49), ("c", 4, 2)], "ns string, next_id long, size long"))
    assert {r["ns"]: (r["consistent"], r["fixed_size"], r["fixed_next_id"]) for r in audit.collect()} == {"a": (True, 150, 151), "b": (False, 50, 61), "c": (False, 0, 4)}


def test_reports(spark):
    log = spark.createDataFrame([("r1", "ok", None), ("r1", "error", "x"), ("r2", "error", "x"), ("r2", "error", "y")], "run_id string, status string, error string")
    assert {r["run_id"]: (r["processed_count"], r["errors"], r["failed"]) for r in reports.run_summary(log).collect()} == {"r1": (1, ["x"], False), "r2": (0, ["x", "y"], True)}


# ---------------------------------------------------------------- plans


def test_day_plans(spark):
    a, b = dt.date(2024, 2, 27), dt.date(2024, 3, 2)
    assert values(requests.day_plan(spark, a, b).orderBy("ordinal"), "day") == [a + dt.timedelta(i) for i in range(5)]
    assert values(requests.day_plan(spark, a, b, reverse=True).orderBy("ordinal"), "day")[0] == b
    assert requests.day_plan(spark, b, a).count() == 0 and requests.day_plan(spark, a, as_of=b).count() == 5
    url = requests.with_url(requests.day_plan(spark, a, a).withColumn("prefix", F.lit("07")), "http://x").first()["url"]
    assert url.startswith("http://x?nombre=1000&curseur=*&q=siren:07* AND ") and "[2024-02-27T00:00:00%20TO%202024-02-27T23:59:59]" in url


def test_prefixes(spark):
    df = spark.createDataFrame([(None,), ("00",), ("09",), ("98",), ("99",), ("129",), ("12",), ("123",), ("0099",), ("999",)], "p string")
    assert values(df.select(requests.next_prefix("p").alias("n")), "n") == ["00", "01", "10", "99", "99", "13", "13", "124", "010", "100"]


def page(total, n, cursor, at_top=True):
    head = {"total": total, "nombre": n, **({} if at_top else {"curseurSuivant": cursor})}
    return json.dumps({"header": head, "unitesLegales": [{"siren": str(i), "etablissements": [{"siret": f"{i}a"}] if i % 2 else []} for i in range(n)], **({"curseurSuivant": cursor} if at_top else {})})


def test_crawl(spark):
    day = dt.date(2025, 9, 7)
    bodies = {"*": page(5, 2, "c1"), "c1": page(5, 2, "c2", at_top=False), "c2": page(5, 1, None)}
    landed = spark.createDataFrame([(day, k, v) for k, v in bodies.items()], "day date, cursor string, body string")
    fetch = lambda todo: todo.join(landed, ["day", "cursor"]).select("day", "prefix", "cursor", "body")
    plan = requests.day_plan(spark, day, day).withColumn("prefix", F.lit(None).cast("string"))
    got = requests.crawl(plan, fetch, lambda p: p)
    assert sorted(values(got, "cursor")) == ["*", "c1", "c2"]
    r = reports.pagination(got.select("day", "prefix", "total", "count")).first()
    assert (r["pages"], r["records"], r["complete"], r["narrow"]) == (3, 5, True, False)
    assert requests.entities(landed).count() == 5


def test_chains(spark):
    df = spark.createDataFrame([("a", "*", "1"), ("a", "1", "2"), ("a", "2", None), ("b", "*", "x"), ("b", "x", "*"), ("c", "*", "lost")], "chain string, cursor string, next_cursor string")
    got = requests.cursor_chain(df, F.col("cursor") == "*", 20)
    by = {}
    for r in got.collect():
        by.setdefault(r["chain"], []).append((r["depth"], r["cyclic"]))
    assert sorted(by["a"]) == [(0, False), (1, False), (2, False)] and max(by["b"]) == (2, True) and by["c"] == [(0, False)]


def test_long_chains(spark):
    n = 1500
    rows = [("a", i, i + 1) for i in range(n)] + [("b", i, (i + 1) % 700 if i < 699 else 300) for i in range(700)] + [("c", 0, 1), ("c", 0, 1), ("d", 5, 6)]
    df = spark.createDataFrame(rows, "chain string, cursor int, next_cursor int")
    got = requests.cursor_chain(df, F.col("cursor") == 0).collect()
    by = {}
    for r in got:
        by.setdefault(r["chain"], []).append((r["depth"], r["cursor"], r["cyclic"]))
    assert sorted(by.pop("a")) == [(i, i, False) for i in range(n)]
    assert sorted(by.pop("b")) == [(i, i, False) for i in range(700)] + [(700, 300, True)]
    assert by == {"c": [(0, 0, False)]}
    with pytest.raises(RuntimeError, match="beyond 1000"):
        requests.cursor_chain(df, F.col("cursor") == 0, 1000)


def test_branching_chains(spark):
    df = spark.createDataFrame([("a", "*", "1"), ("a", "*", "2"), ("a", "1", "3"), ("a", "2", "3"), ("a", "3", None)], "chain string, cursor string, next_cursor string")
    got = requests.cursor_chain(df, F.col("cursor") == "*")
    assert sorted((r["cursor"], r["depth"]) for r in got.collect()) == [("*", 0), ("*", 0), ("1", 1), ("2", 1), ("3", 2), ("3", 2)]
    with pytest.raises(Exception, match="(?i)recursion"):
        requests.cursor_chain(df, F.col("cursor") == "*", 1).collect()


def test_crawl_that_does_not_end(spark):
    day = dt.date(2025, 9, 7)
    fetch = lambda todo: todo.select("day", "prefix", "cursor", F.lit(page(50, 2, "c1")).alias("body"))
    plan = requests.day_plan(spark, day, day).withColumn("prefix", F.lit(None).cast("string"))
    with pytest.raises(RuntimeError, match="after 3 rounds"):
        requests.crawl(plan, fetch, lambda p: p, 3)


def test_paged_source(spark):
    def transport(url, cursor):
        pages = {"*": {"header": {"total": 3, "nombre": 2}, "curseurSuivant": "n"}, "n": {"total": 3, "nombre": 1, "curseurSuivant": None}}
        return (200, json.dumps(pages[cursor])) if url == "u" else (500, "no")

    got = read_paged(spark, [{"url": "u"}, {"url": "v", "cursor": "q"}], transport).collect()
    assert sorted((r["url"], r["cursor"], r["status"]) for r in got) == [("u", "*", 200), ("u", "n", 200), ("v", "q", 500)]


def test_gaps_and_replay(spark):
    d = lambda n: dt.date(2024, 1, n)
    assert sorted(values(requests.gaps(spark.createDataFrame([(d(1),), (d(4),), (d(4),)], "day date")), "day")) == [d(2), d(3)]
    t = spark.createDataFrame([("a", 1), ("b", 2), ("c", 3)], "item_id string, x int")
    failed, ok = spark.createDataFrame([("a",), ("a",), ("b",)], "item_id string"), spark.createDataFrame([("b",)], "item_id string")
    assert values(requests.failed_replay(t, failed, ok), "item_id") == ["a"]


# ---------------------------------------------------------------- archives and sinks


def _zip(members):
    f = io.BytesIO()
    with zipfile.ZipFile(f, "w") as z:
        for n, b in members.items():
            z.writestr(n, b)
    return f.getvalue()


def _tar(members, mode="w"):
    f = io.BytesIO()
    with tarfile.open(fileobj=f, mode=mode) as t:
        for n, b in members.items():
            i = tarfile.TarInfo(n)
            i.size = len(b)
            t.addfile(i, io.BytesIO(b))
    return f.getvalue()


def resource(name, content, kind="application/octet-stream"):
    return ("b", name, f"https://h/{name}", kind, 200, None, content)


def test_archives(spark):
    two = {"file1.txt": b"one", "d/file2.txt": b"two"}
    rows = [
        resource("a.zip", _zip({**two, "dir/": b""}), "application/zip"), resource("t.gz", gzip.compress(b"text")), resource("x.tar", _tar(two)),
        resource("y.tar.gz", _tar(two, "w:gz")), resource("bad.zip", b"PK\x03\x04broken"), resource("bad.gz", b"\x1f\x8bxx"), resource("cordata.zip", b"plain text"), resource("n.txt", None),
    ]
    out = archives.expand(spark.createDataFrame(rows, RESOURCE)).collect()
    made = {r["name"]: (r["derived_from"], bytes(r["content"]), r["status_code"], r["url"]) for r in out if r["derived_from"]}
    assert made["a/file1.txt"] == ("a.zip", b"one", 200, "https://h/file1.txt") and made["t"] == ("t.gz", b"text", 200, "https://h/t")
    assert {n for n in made} == {"a/file1.txt", "a/d/file2.txt", "t", "x/file1.txt", "x/d/file2.txt", "y/file1.txt", "y/d/file2.txt"}
    assert {r["name"] for r in out if r["error"]} == {"bad.zip", "bad.gz"} and sum(r["derived_from"] is None for r in out) == len(rows)
    kept = archives.expand(spark.createDataFrame(rows, RESOURCE), keep_packed=True).filter("derived_from = 'a.zip'")
    assert kept.count() == 0
    assert archives.listing(spark.createDataFrame(rows[:1], RESOURCE)).count() == 2
    assert bundles.with_lineage(archives.expand(spark.createDataFrame(rows[:1], RESOURCE))).count() == 2


def test_raw_layout(spark, tmp_path):
    bid = "bid:v1:us_fl:20250918223028:95ec03ae"
    res = spark.createDataFrame([(bid, "n1", "https://h/n1", "text/plain", 200, None, b"abc"), (bid, "n2", "https://h/n2", "text/plain", 200, None, b"de")], RESOURCE)
    bundles.write_raw(res, str(tmp_path), "us_fl", "run1")
    base = "registry=us_fl/year=2025/month=9/day=18"
    assert all((tmp_path / k / "batch=run1" / base).is_dir() for k in bundles.RAW_PARTS)
    h = hashlib.sha256("".join(hashlib.sha256(b).hexdigest() for b in (b"abc", b"de")).encode()).hexdigest()
    done = bundles.read_raw(spark, str(tmp_path), "completed").first()
    assert (done["bundle_hash"], done["resources_count"], done["run_id"]) == (h, 2, "run1")
    meta = bundles.write_objects(res, str(tmp_path / "o"), "p").first()
    assert meta["uploaded_keys"] == [f"p/{bid}/n1", f"p/{bid}/n2"]
    bundles.write_flat(res, str(tmp_path / "flat"))
    assert set(values(spark.read.parquet(f"{tmp_path}/flat/content"), "target")) == {f"bundle_{bid}/n1", f"bundle_{bid}/n2"}
    with pytest.raises(ValueError):
        bundles.load_bundle(res.limit(0), bid)


def test_listing_reads_no_content(spark, tmp_path):
    (tmp_path / "d").mkdir()
    (tmp_path / "d" / "a.txt").write_text("x")
    df = files.list_files(spark, str(tmp_path))
    assert values(df, "name") == ["a.txt"]
    assert "content:binary" not in df._jdf.queryExecution().executedPlan().toString()


def test_unprocessed_is_one_join(spark):
    rng = random.Random(1)
    a = spark.createDataFrame([(str(rng.random()),) for _ in range(50)], "path string")
    plan = state.unprocessed(a, a)._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftAnti" in plan


def test_queue_numbers_with_payload(spark):
    """Every number once, whatever columns come along and however the rows lie."""
    rows = spark.range(20_000).select(
        F.when(F.col("id") % 3 == 0, "a").when(F.col("id") % 97 == 0, "b").otherwise("hot").alias("ns"), F.xxhash64("id").alias("at"),
        F.repeat(F.col("id").cast("string"), 5).alias("note"), F.col("id"), F.sha2(F.col("id").cast("string"), 256).alias("more"),
    ).repartition(16)
    out = state.enqueue(rows, ["at", "id"], base=spark.createDataFrame([("b", 11)], "ns string, next_id long"))
    got = out.select("ns", "seq", "at", "id", "note").collect()
    assert len(got) == 20_000
    for ns, first in (("a", 1), ("b", 11), ("hot", 1)):
        own = sorted((r["seq"], r["at"], r["id"]) for r in got if r["ns"] == ns)
        assert [r[0] for r in own] == list(range(first, first + len(own))) and [r[1:] for r in own] == sorted(r[1:] for r in own)
    assert all(r["note"] == str(r["id"]) * 5 for r in got)


def test_archives_of_any_size(spark, monkeypatch):

    monkeypatch.setattr(archives, "BATCH_BYTES", 100_000)
    f = io.BytesIO()
    with zipfile.ZipFile(f, "w") as z:
        for i in range(100_001):
            z.writestr(f"m{i}", b"")
    g = io.BytesIO()
    with zipfile.ZipFile(g, "w") as z:
        z.writestr("large", b"x" * 300_000)
        z.writestr("small", b"y")
    bad = g.getvalue()[:1000] + b"!" + g.getvalue()[1001:]  # one byte of a member
    rows = [("b", n, f"http://x/{n}", None, 200, None, c) for n, c in (("many.zip", f.getvalue()), ("large.zip", g.getvalue()), ("bad.zip", bad))]
    out = archives.expand(spark.createDataFrame(rows, RESOURCE)).cache()
    assert {r["derived_from"]: r["count"] for r in out.groupBy("derived_from").count().collect()} == {None: 3, "many.zip": 100_001, "large.zip": 2}
    assert [r["name"] for r in out.filter("error is not null").collect()] == ["bad.zip"]
    assert out.filter("name = 'large/large'").first()["size"] == 300_000


def test_chain_of_branches_leaves_the_session_alone(spark):
    rows = [(1, "a", "b"), (1, "a", "c"), (1, "b", None), (1, "c", None)]
    pages = spark.createDataFrame(rows, "chain long, cursor string, next_cursor string")
    before = spark.conf.get("spark.sql.cteRecursionLevelLimit")
    got = requests.cursor_chain(pages, F.col("cursor") == "a")
    assert {(r["cursor"], r["depth"]) for r in got.collect()} == {("a", 0), ("b", 1), ("c", 1)}
    assert spark.conf.get("spark.sql.cteRecursionLevelLimit") == before


def test_registered_sources_gates_and_plans(spark, tmp_path):
    r = registry.default_registry()
    (tmp_path / "a.txt").write_text("x")
    assert [x["name"] for x in r.create("directory_listing", {"path": str(tmp_path)})(spark).collect()] == ["a.txt"]
    assert r.create("url_list", {"urls": ["u", "v"]})(spark).count() == 2
    t = spark.createDataFrame([(dt.datetime(2024, 1, 1, 5),)], "t timestamp")
    due = lambda name, p: t.select(F.date_format(r.create(name, p)(F.col("t")), "yyyy-MM-dd HH:mm").alias("d")).first()["d"]
    assert due("interval_gate", {"interval_s": 90}) == "2024-01-01 05:01" and due("daily_gate", {"time_of_day": "04:00"}) == "2024-01-02 04:00"
    asked = spark.createDataFrame([(1, None, "*")], "day long, prefix string, cursor string")
    pages = spark.createDataFrame([(1, None, 5, 5, "c2")], "day long, prefix string, total long, count long, next_cursor string")
    assert r.create("cursor_pages")(asked, pages).first()["cursor"] == "c2"
    with pytest.raises(ValueError):
        r.create("interval_gate", {"interval": 1})

import datetime as dt
import json
import os
import random
import time

import pytest
from pyspark.sql import functions as F

from quayside import catalog, catalog_flows, shared  # noqa: F401  (catalog_flows registers)
from quayside.operators import bundles, ordered, reports, state
from quayside.plans import requests
from quayside.sources import paged


def rates(rows, every, limit):
    out = {}
    for source in {s for s, t in rows if t is not None}:
        ts = sorted(t for s, t in rows if s == source and t is not None)
        here = [sum(t <= u < t + every for u in ts) for t in ts]
        gaps = [b - a for a, b in zip(ts, ts[1:], strict=False)]
        out[source] = (len(ts), max(here), sum(h > limit for h in here), min(gaps, default=None))
    return out


def test_bursts_across_seconds(spark):
    """Four requests within 150 ms, of which two lie in each of two seconds."""
    at = [dt.datetime(2024, 1, 1, 0, 0, 0, 900_000) + dt.timedelta(milliseconds=50 * i) for i in range(4)]
    r = reports.sliding_rates(spark.createDataFrame([("a", t) for t in at], "source string, ts timestamp"), 2).first()
    assert (r["most"], r["starts_over"], r["shortest_gap_us"]) == (4, 2, 50_000)


@pytest.mark.parametrize("parts", [1, 7])
def test_sliding_rates_like_brute_force(spark, parts):
    rng = random.Random(parts)
    rows = [(rng.choice("aaaaab"), rng.randrange(3000) * 1000) for _ in range(400)] + [("a", 5000)] * 30 + [(None, 7), (None, 9), ("lone", 1), ("b", None)]
    df = spark.createDataFrame(rows, "source string, us long").select("source", F.timestamp_micros("us").alias("ts"), F.lit(1).alias("n"))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        for every in (1, 50_000, 2_000_000):
            got = {r["source"]: (r["requests"], r["most"], r["starts_over"], r["shortest_gap_us"]) for r in reports.sliding_rates(df, 3, every).collect()}
            assert got == rates(rows, every, 3)
        assert reports.sliding_rates(df.limit(0), 3).collect() == []
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_numbers_and_sums_in_ranges(spark):
    rng = random.Random(2)
    rows = [(rng.choice(["hot", "hot", "hot", "x", None]), i, rng.randrange(9)) for i in rng.sample(range(10_000), 500)]
    df = spark.createDataFrame(rows, "k string, o int, v long").repartition(5)
    got = {r["o"]: (r["nth"], r["k"]) for r in ordered.numbered(df, "k", ["o"], "nth").collect()}
    sums = {r["o"]: r["s"] for r in ordered.running(df, "k", ["o"], "v", "s").collect()}
    for key in ("hot", "x", None):
        own = sorted((o, v) for k, o, v in rows if k == key)
        assert [got[o] for o, _ in own] == [(i, key) for i in range(1, len(own) + 1)]
        assert [sums[o] for o, _ in own] == [sum(v for _, v in own[:i]) for i in range(len(own))]


def test_bundles_of_any_size(spark, monkeypatch):
    import hashlib

    rng = random.Random(3)
    rows = [(rng.choice(["big", "big", "big", "b", None]), f"n{rng.randrange(300):03}", rng.choice([bytes([i % 251]), b"", None])) for i in range(900)]
    want = {}
    for bid in ("big", "b", None):
        own = sorted((n, hashlib.sha256(c).hexdigest() if c is not None else "") for b, n, c in rows if b == bid)
        want[bid] = (len(own), sum(len(c or b"") for b, _, c in rows if b == bid), hashlib.sha256("".join(h for _, h in own).encode()).hexdigest())
    df = spark.createDataFrame(rows, "bid string, name string, content binary").repartition(6)
    for size in (1 << 20, 500):
        monkeypatch.setattr(ordered, "CHUNK_BYTES", size)
        got = {r["bid"]: (r["resources_count"], r["total_bytes"], r["bundle_hash"]) for r in bundles.bundle_hashes(bundles.manifest(df)).collect()}
        assert got == want
    assert bundles.bundle_hashes(bundles.manifest(df.limit(0))).collect() == []


def test_attempts_of_a_hot_item(spark):
    df = spark.createDataFrame([("hot", i) for i in range(200)] + [("x", 5)], "item_id string, ts int").repartition(4)
    got = {(r["item_id"], r["ts"]): r["retry_count"] for r in state.attempts(df).collect()}
    assert got == {("x", 5): 0} | {("hot", i): i for i in range(200)}


# ---------------------------------------------------------------- prefix trees


def test_prefix_tree_by_searches(spark):
    """Totals from an API that is asked a level at a time; what it is asked is counted."""
    rng = random.Random(4)
    ids = [f"{rng.choice([7, 7, 7, rng.randrange(1000)]):03}{rng.randrange(100):02}" for _ in range(3000)]
    day, asked = dt.date(2024, 1, 1), []

    def totals(searches):
        rows = searches.collect()
        asked.append(len(rows))
        return spark.createDataFrame([(r["day"], r["prefix"], sum(i.startswith(r["prefix"] or "") for i in ids)) for r in rows], "day date, prefix string, total long")

    leaves = {r["prefix"]: r["total"] for r in requests.prefix_tree(spark.createDataFrame([(day,), (day,)], "day date"), totals, 100, 5).collect()}
    assert sum(leaves.values()) == len(ids) and max(leaves.values()) <= 100
    assert all(sum(i.startswith(p) for i in ids) == n for p, n in leaves.items())
    assert all(sum(i.startswith(p[:-1]) for i in ids) > 100 for p in leaves) and asked[0] == 1 and asked[1] == 10
    table = spark.createDataFrame([(day, i) for i in ids], "day date, id string")
    again = requests.prefix_tree(table.select("day"), requests.counted(table), 100, 5)
    assert {r["prefix"]: r["total"] for r in again.collect()} == leaves


def test_prefix_tree_ends(spark):
    day = dt.date(2024, 1, 1)
    same = spark.createDataFrame([(day, "123")] * 5, "day date, id string")
    with pytest.raises(RuntimeError, match="ids of 3 signs"):
        requests.prefix_tree(same.select("day"), requests.counted(same), 4, 3)
    short = spark.createDataFrame([(day, "12")] * 3 + [(day, "123")] * 3, "day date, id string")
    with pytest.raises(RuntimeError, match="of those they split"):
        requests.prefix_tree(short.select("day"), requests.counted(short), 4, 3)
    whole = requests.prefix_tree(same.select("day"), requests.counted(same), 5, 3).collect()
    assert [(r["prefix"], r["total"]) for r in whole] == [(None, 5)]
    assert requests.prefix_tree(same.select("day").limit(0), requests.counted(same)).collect() == []


# ---------------------------------------------------------------- paged sources

START, END = dt.date(2024, 1, 1), dt.date(2024, 1, 4)


def served(log):
    """An API of 1 to 5 pages a search that writes down what it is asked."""

    def transport(url, cursor):
        import os
        import uuid

        with open(os.path.join(log, uuid.uuid4().hex), "w") as f:
            f.write(f"{url} {cursor}")
        n, page = 1 + (int(url[-2:]) + int(url[-5:-3])) % 5, 0 if cursor == "*" else int(cursor)
        return 200, json.dumps({"header": {"total": n, "nombre": 1, "curseurSuivant": str(page + 1) if page + 1 < n else None}})

    return transport


def asked(log):
    return sorted(f.read_text() for f in log.iterdir())


def pages(url_day, prefix):
    n = 1 + (int(prefix) + url_day.day) % 5
    return [f"x/{url_day}/{prefix} {'*' if i == 0 else i}" for i in range(n)]


def test_pushed_filters(spark, tmp_path, capfd):
    transport = served(str(tmp_path))
    df = paged.read_days(spark, "x/{day}/{prefix}", START, END, transport, ["00", "01", "12"])
    some = df.filter("day >= DATE '2024-01-02' AND day <> DATE '2024-01-03' AND (prefix LIKE '0%')")
    some.explain("formatted")
    assert "PushedFilters: [" in (plan := capfd.readouterr().out) and "GreaterThanOrEqual" in plan and "StringStartsWith" in plan
    got = sorted(f"{r['url']} {r['cursor']}" for r in some.collect())
    want = sorted(p for d in (2, 4) for q in ("00", "01") for p in pages(dt.date(2024, 1, d), q))
    assert got == want
    assert asked(tmp_path) == sorted(p for d in (2, 3, 4) for q in ("00", "01") for p in pages(dt.date(2024, 1, d), q))  # <> is left to Spark
    assert df.filter("prefix = '77'").collect() == [] and df.filter("prefix IS NULL").collect() == []
    assert df.filter("day IN (DATE '2024-01-01') AND prefix > '01' AND prefix <= '12' AND status = 200").count() == len(pages(START, "12"))


def test_searches_of_a_table(spark, tmp_path):
    rows = [(START, "00", f"x/{START}/00", None), (START, "01", f"x/{START}/01", "1"), (None, None, f"x/{END}/12", "*")]
    got = paged.walk_searches(spark.createDataFrame(rows, "day date, prefix string, url string, cursor string"), served(str(tmp_path)))
    assert sorted(f"{r['url']} {r['cursor']}" for r in got.collect()) == sorted([*pages(START, "00"), *pages(START, "01")[1:], *pages(END, "12")])


def test_stream_resumes_in_searches(spark, tmp_path):
    """Stopped after each round and started anew, it lands every page once, and asks for none twice but those of a broken round."""
    log = tmp_path / "log"
    log.mkdir()
    landed, broken = [], []

    def land(batch, number):
        rows = sorted(f"{r['url']} {r['cursor']}" for r in batch.collect())
        if number == 1 and not broken:
            broken.append(rows)
            raise RuntimeError("broken")
        landed.append((number, rows))

    def go():
        s = paged.stream_days(spark, "x/{day}/{prefix}", START, END, served(str(log)), f"file://{tmp_path}/state", ["00", "01", "12"], round_pages=2, shares=3)
        q = s.writeStream.option("checkpointLocation", f"{tmp_path}/checkpoint").foreachBatch(land).start()
        try:
            q.processAllAvailable()
        finally:
            q.stop()

    with pytest.raises(Exception, match="broken"):
        go()
    go()
    go()
    want = sorted(p for d in range(1, 5) for q in ("00", "01", "12") for p in pages(dt.date(2024, 1, d), q))
    assert sorted(p for _, rows in landed for p in rows) == want and [n for n, _ in landed] == [0, 1, 2]
    assert landed[1][1] == broken[0] and asked(log) == sorted([*want, *broken[0]])


def test_prefix_leaves_with_broad_ids(spark, tmp_path):
    """Whole ids that are too broad end no search for the leaves beside them, and are told where they are asked for."""
    day = dt.date(2024, 1, 1)
    ids = spark.createDataFrame([(day, "123")] * 5 + [(day, "124")] * 2 + [(day, "200")], "day date, id string")
    got = requests.prefix_tree(ids.select("day"), requests.counted(ids), 4, 3, broad_ids=True)
    assert sorted((r["prefix"], r["total"]) for r in got.collect()) == [("123", 5), ("124", 2), ("2", 1)]
    from quayside import catalog, catalog_flows  # noqa: F401

    keys = [3000 * i for i in range(41)] + [3, 6] + list(range(1, 600, 3))
    spark.createDataFrame([(k, dt.datetime(2024, 5, 1)) for k in keys], "o_orderkey long, o_orderdate timestamp").write.parquet(f"{tmp_path}/orders.parquet")
    leaves = [tuple(r) for r in catalog.QUERIES["prefix_leaves"](spark, str(tmp_path)).collect()]
    texts = [f"{k % 1000 if k % 3 == 0 else k * 7919 % 1_000_000:06}" for k in keys]
    assert ("2024", "000003", 1) in leaves and sum(n for _, _, n in leaves) == len(texts) - 41
    assert all(sum(x.startswith(p) for x in texts) == n <= 40 < sum(x.startswith(p[:-1]) for x in texts) for _, p, n in leaves)


@pytest.mark.parametrize("group_bytes", [0, 400, 1 << 20])
def test_small_bundles_are_not_folded(spark, group_bytes, monkeypatch):
    """All, some or no bundles folded, of hashes that are hexadecimal or not; each fold's rows are counted."""
    import hashlib

    seen = []
    fold = bundles.folded_sha256
    monkeypatch.setattr(bundles, "folded_sha256", lambda rows, *a: seen.append(rows.count()) or fold(rows, *a))
    monkeypatch.setattr(bundles, "GROUP_BYTES", group_bytes, raising=False)
    monkeypatch.setattr(ordered, "CHUNK_BYTES", 200)
    rng = random.Random(7)
    hex_ = lambda i: hashlib.sha256(str(i % 13).encode()).hexdigest()
    rows = [(b, rng.choice(["n1", "n2", None, f"m{i}"]), rng.choice([hex_(i), "AB", "x", "a b", None]) if b == "odd" else hex_(i), rng.choice([None, i]))
            for b, n in (("one", 1), ("few", 4), ("odd", 30), (None, 3), ("many", 60)) for i in range(n)]
    got = {r["bid"]: (r["resources_count"], r["total_bytes"], r["bundle_hash"]) for r in bundles.bundle_hashes(spark.createDataFrame(rows, "bid string, name string, sha256 string, size long").repartition(5)).collect()}
    for bid in ("one", "few", "odd", None, "many"):
        own = sorted(((n is not None, n or "", h or ""), s or 0) for b, n, h, s in rows if b == bid)
        assert got[bid] == (len(own), sum(s for _, s in own), hashlib.sha256("".join(h for (_, _, h), _ in own).encode()).hexdigest())
    assert len(got) == 5 and seen == {0: [98], 400: [90], 1 << 20: []}[group_bytes]
    assert ordered.halved(hex_(1)) == (True, bytes.fromhex(hex_(1))) and ordered.halved("AB") == (False, b"AB") and ordered.halved("ab cd") == (False, b"ab cd")


@pytest.mark.parametrize("round_bytes", [0, 1 << 28])
def test_a_fold_writes_no_rows(spark, sf_dir, round_bytes, monkeypatch):
    """All bundles folded, in rounds or at once: of the tables written none has a row for each line, and only one of pieces is there at a time."""
    wrote, plain = [], ordered.written

    def seen(df, name, *a, **b):
        out = plain(df, name, *a, **b)
        wrote.append((name, out.count(), out))
        return out

    monkeypatch.setattr(bundles, "GROUP_BYTES", 0)
    monkeypatch.setattr(ordered, "ROUND_BYTES", round_bytes, raising=False)
    for module in (bundles, ordered):
        monkeypatch.setattr(module, "written", seen)
    got = catalog.QUERIES["large_bundles"](spark, sf_dir)
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet").count()
    assert max(n for _, n, _ in wrote) < lines / 10 and got.count() == 51
    of = [out for name, _, out in wrote if name == "pieces"]
    assert len(of) == (1 if round_bytes else 2) and not any(os.path.exists(x._written_at.removeprefix("file:")) for x in of)


def test_rounds_of_a_fold(spark, monkeypatch):
    """The largest key, or a quarter of all, bounds a round; every key is in one, null too."""
    monkeypatch.setattr(ordered, "ROUND_BYTES", 10)
    for sizes, want in (([9, 1], [10]), ([50, 20, 20, 10], [50, 50]), ([10] * 8, [20] * 4), ([7, 3, 3, 3], [10, 6]), ([100], [100])):
        keys = [None, *map(str, range(1, len(sizes)))]
        rounds, n = ordered.in_rounds(spark.createDataFrame(list(zip(keys, sizes, strict=True)), "_by string, _bytes long").repartition(3), "_by", "_bytes")
        of = {r["_of"]: r["_round"] for r in rounds.collect()}
        sums = [sum(s for k, s in zip(keys, sizes, strict=True) if of[k] == i) for i in range(n)]
        assert len(of) == len(sizes) and sum(sums) == sum(sizes) and sums == want


def test_shuffle_files_go_with_a_clean_table(spark):
    files = lambda: {f for f in spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().mkString(" ").split() if f.endswith(".data")}
    held, conf = files(), spark.conf.get(shared.CLEANUP)
    out = shared.written(spark.range(1000).repartition(3, "id"), "clean", clean=True)
    for _ in range(100):
        if not files() - held:
            break
        time.sleep(0.1)
    assert not files() - held and out.count() == 1000 and spark.conf.get(shared.CLEANUP) == conf


def test_pieces_are_in_small_groups(spark):
    """Forty rows of 1 MB that cannot be compressed: no group of rows is much above 8 MB."""
    import glob

    import pyarrow.parquet as pq

    rng = random.Random(1)
    df = spark.createDataFrame([(i, bytearray(rng.randbytes(1 << 20))) for i in range(40)], "i int, piece binary").coalesce(1)
    out = shared.written(df, "pieces", **ordered.SMALL_GROUPS)
    files = [pq.ParquetFile(f).metadata for f in glob.glob(out._written_at.removeprefix("file:") + "/*.parquet")]
    assert max(m.row_group(i).total_byte_size for m in files for i in range(m.num_row_groups)) < 12 << 20 and out.count() == 40

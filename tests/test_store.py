import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from quayside.operators import bundles, commits, state
from quayside.operators.store import Queue, StateStore
from quayside.streaming import streams

PUT = "k string, v string, put_at timestamp, expires_at timestamp, deleted boolean"
AT = dt.datetime(2024, 1, 1)


def when(minutes):
    return AT + dt.timedelta(minutes=minutes)


def alive(log, now):
    """The state of every key after (seq, k, v, put, expires, deleted) rows."""
    last = {}
    for seq, k, v, put, expires, deleted in log:
        row = (put, seq, v, deleted, expires or dt.datetime.min)
        if k not in last or row > last[k]:
            last[k] = row
    return {k: v for k, (_, _, v, deleted, expires) in last.items() if not deleted and (expires == dt.datetime.min or expires > now)}


def test_store_after_twenty_rounds(spark, tmp_path):
    """Puts, merges and sweeps give what the whole log gives."""
    rng, log = random.Random(2), []
    store = StateStore(spark, f"file://{tmp_path}/s", buckets=4, runs=3, filter_parts=1)
    for seq in range(1, 21):
        rows = [(f"k{rng.randrange(25)}", f"v{rng.randrange(9)}", when(10 * seq + rng.randrange(3)), when(rng.randrange(350)) if rng.random() < 0.5 else None, rng.random() < 0.2) for _ in range(rng.choice((1, 2, 6)))]
        log += [(seq, *r) for r in rows]
        assert 1 <= len(store.put(spark.createDataFrame(rows, PUT))) <= len(rows)
        if seq == 12:
            assert store.sweep(F.lit(when(10 * seq - 5)))
    for minutes in (203, 300):
        want = alive(log, when(minutes))
        assert {r["k"]: r["v"] for r in store.view(F.lit(when(minutes))).collect()} == want
    keys = [f"k{i}" for i in range(25)]
    assert {r["k"]: r["v"] for r in store.get(spark.createDataFrame([(k,) for k in keys], "k string"), F.lit(when(300))).collect()} == {k: want.get(k) for k in keys}
    items = spark.createDataFrame([(k, i) for i, k in enumerate([*keys, "new1", "new2", None])], "k string, i int")
    assert {r["k"] for r in store.unprocessed(items, F.lit(when(300))).collect()} == {*keys, "new1", "new2", None} - set(want)
    before = store.commits.latest()[1]
    touched = store.put(spark.createDataFrame([("k1", "x", when(400), None, False)], PUT))
    after = store.commits.latest()[1]
    assert len(touched) == 1 and {b for b in after["buckets"] if after["buckets"][b] != before["buckets"].get(b)} == {str(touched[0])}
    assert store.put(spark.createDataFrame([], PUT)) == [] and store.commits.latest()[1] == after
    seen = {r["k"]: r["v"] for r in store.view(F.lit(when(500))).collect()}
    assert store.vacuum() > 0 and {r["k"]: r["v"] for r in store.view(F.lit(when(500))).collect()} == seen and store.vacuum() == 0


def test_filters_rule_keys_out(spark, tmp_path):
    store = StateStore(spark, f"file://{tmp_path}/s", buckets=4, filter_parts=2)
    assert store.unprocessed(spark.createDataFrame([("a",)], "k string"), F.lit(AT)).count() == 1
    store.put(spark.createDataFrame([(f"k{i}", "v", AT, None, False) for i in range(500)], PUT))
    store.put(spark.createDataFrame([(f"k{i}", "v", AT, None, False) for i in range(500, 600)], PUT))
    filters = store._filters(store.commits.latest()[1], list(range(4)))
    probes = spark.createDataFrame([(f"k{i}", True) for i in range(600)] + [(f"other{i}", False) for i in range(2000)], "k string, there boolean")
    met = probes.withColumn("bucket", store.bucket()).join(filters, "bucket").withColumn("maybe", store._maybe("k"))
    n = {(r["there"], r["maybe"]): r["count"] for r in met.groupBy("there", "maybe").count().collect()}
    assert n[True, True] == 600 and (True, False) not in n and n.get((False, True), 0) < 20


def test_put_of_two_writers(spark, tmp_path, monkeypatch):
    """The second of two puts from one base starts again from the first one's."""
    one, two = (StateStore(spark, f"file://{tmp_path}/s", buckets=2) for _ in "ab")
    plain, done = commits.Commits.create, []

    def late(self, name, body):
        if not done:
            done.append(1)
            two.put(spark.createDataFrame([("b", "2", AT, None, False)], PUT))
        return plain(self, name, body)

    monkeypatch.setattr(commits.Commits, "create", late)
    one.put(spark.createDataFrame([("a", "1", AT, None, False)], PUT))
    assert {r["k"]: r["v"] for r in one.view(F.lit(AT)).collect()} == {"a": "1", "b": "2"} and one.commits.latest()[0] == 2


# ---------------------------------------------------------------- queue


def queued(spark, *rows):
    return spark.createDataFrame(list(rows), "ns string, o int, payload string")


def seqs(df):
    return sorted((r["ns"] or "", r["seq"], r["payload"]) for r in df.collect())


def test_queue_numbers_are_committed(spark, tmp_path, monkeypatch):
    a, b = (Queue(spark, f"file://{tmp_path}/q") for _ in "ab")
    assert a.peek(1) is None and a.dequeue(1) is None
    assert seqs(a.enqueue(queued(spark, ("x", 2, "two"), ("x", 1, "one"), (None, 1, "none")), ["o"])) == [("", 1, "none"), ("x", 1, "one"), ("x", 2, "two")]
    plain, done = commits.Commits.create, []

    def late(self, name, body):
        if not done:
            done.append(seqs(b.enqueue(queued(spark, ("x", 1, "b1"), ("y", 1, "by")), ["o"])) if not done.append(0) else None)
        return plain(self, name, body)

    monkeypatch.setattr(commits.Commits, "create", late)
    mine = seqs(a.enqueue(queued(spark, ("x", 1, "a1"), ("x", 2, "a2")), ["o"]))
    monkeypatch.setattr(commits.Commits, "create", plain)
    assert done[1] == [("x", 3, "b1"), ("y", 1, "by")] and mine == [("x", 4, "a1"), ("x", 5, "a2")]
    counters = {r["ns"]: (r["next_id"], r["head"], r["size"]) for r in a.counters().collect()}
    assert counters == {"x": (6, 1, 5), "y": (2, 1, 1), None: (2, 1, 1)}
    assert seqs(a.peek(2)) == [("", 1, "none"), ("x", 1, "one"), ("x", 2, "two"), ("y", 1, "by")]
    assert seqs(a.dequeue(3)) == [("", 1, "none"), ("x", 1, "one"), ("x", 2, "two"), ("x", 3, "b1"), ("y", 1, "by")]
    a.compact()
    assert seqs(b.dequeue(1)) == [("x", 4, "a1")] and seqs(b.peek(9)) == [("x", 5, "a2")]
    assert seqs(b.enqueue(queued(spark, ("x", 0, "last"), ("y", 0, "y2")), ["o"])) == [("x", 6, "last"), ("y", 2, "y2")]
    audit = state.queue_audit(a.peek(99).select("ns", "seq"), a.counters().select("ns", "next_id", "size"))
    assert all(r["consistent"] for r in audit.filter("n > 0").collect())


def test_failed_batch_leaves_nothing(spark, tmp_path, monkeypatch):
    q = Queue(spark, f"file://{tmp_path}/q")
    q.enqueue(queued(spark, ("x", 1, "one")), ["o"])
    before = sorted(p.name for p in (tmp_path / "q").iterdir())
    plain = commits.Commits.create
    monkeypatch.setattr(commits.Commits, "create", lambda self, name, body: (_ for _ in ()).throw(OSError("store is gone")))
    with pytest.raises(OSError):
        q.enqueue(queued(spark, ("x", 1, "lost")), ["o"])
    monkeypatch.setattr(commits.Commits, "create", lambda self, name, body: False)
    monkeypatch.setattr(commits.Commits, "RETRIES", 2)
    with pytest.raises(commits.Conflict):
        q.enqueue(queued(spark, ("x", 1, "lost")), ["o"])
    monkeypatch.setattr(commits.Commits, "create", plain)
    assert sorted(p.name for p in (tmp_path / "q").iterdir()) == before and seqs(q.peek(9)) == [("x", 1, "one")]


# ---------------------------------------------------------------- staged layout

RESOURCE = "bid string, name string, url string, content_type string, status_code int, derived_from string, content binary"


@pytest.mark.parametrize("fails_at", bundles.RAW_PARTS)
def test_raw_batch_is_whole_or_absent(spark, tmp_path, monkeypatch, fails_at):
    bid = "bid:v1:us_fl:20250918223028:95ec03ae"
    rows = lambda *names: spark.createDataFrame([(bid, n, f"https://h/{n}", "text/plain", 200, None, n.encode()) for n in names], RESOURCE)
    path = f"file://{tmp_path}/raw"
    bundles.write_raw(rows("n1"), path, "c", "first")
    plain = bundles.Commits.remove
    from pyspark.sql.readwriter import DataFrameWriter

    save = DataFrameWriter.save

    def failing(self, place=None, *a, **kw):
        save(self, place, *a, **kw)
        if f"/{fails_at}/" in (place or ""):
            raise OSError("broken")

    monkeypatch.setattr(DataFrameWriter, "save", failing)
    with pytest.raises(OSError):
        bundles.write_raw(rows("n2", "n3"), path, "c", "second")
    monkeypatch.setattr(DataFrameWriter, "save", save)
    assert bundles.Commits.remove is plain
    assert all(bundles.read_raw(spark, path, part).count() == 1 for part in bundles.RAW_PARTS)
    for _ in range(2):
        assert bundles.write_raw(rows("n2", "n3"), path, "c", "second").first()["resources_count"] == 2
    assert sorted(r["name"] for r in bundles.read_raw(spark, path, "content").collect()) == ["n1", "n2", "n3"]
    assert [bundles.read_raw(spark, path, part, "second").count() for part in bundles.RAW_PARTS] == [2, 2, 2, 1, 1]


# ---------------------------------------------------------------- timers


def test_keys_expire_by_timers(spark, tmp_path):
    """Files in order of time, rows within a file in any: stretches end by a timer or by a later row."""
    rng, ttl = random.Random(3), 10_000
    rows = sorted((rng.randrange(200_000), rng.choice("abcdef")) for _ in range(60))
    rows += [(200_001, "z"), (300_000, "z")]
    for i, lo in enumerate(range(0, len(rows), 20)):
        part = rows[lo : lo + 20]
        rng.shuffle(part)
        spark.createDataFrame(part, "ms long, k string").select("k", F.timestamp_millis("ms").alias("ts")).coalesce(1).write.parquet(f"{tmp_path}/in/{i}")
    stream = spark.readStream.schema("k string, ts timestamp").option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in/*")
    out = streams.expired_keys(stream, "k", "ts", ttl)
    q = out.writeStream.format("memory").queryName("expired").option("checkpointLocation", f"{tmp_path}/c").trigger(availableNow=True).start()
    q.awaitTermination()
    got = sorted((r["key"], r["since_ms"], r["expired_ms"], r["n"]) for r in spark.table("expired").collect())
    want, high = [], max(t for t, _ in rows)
    for k in "abcdefz":
        own, begin = sorted(t for t, x in rows if x == k), 0
        for i, t in enumerate(own):
            if i + 1 == len(own) or own[i + 1] > t + ttl:
                if t + ttl <= high:
                    want.append((k, own[begin], t + ttl, i + 1 - begin))
                begin = i + 1
    assert got == sorted(want) and any(k != "z" for k, *_ in got)

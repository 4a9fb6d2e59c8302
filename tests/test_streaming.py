import datetime as dt
import time

from pyspark.sql import functions as F

from quayside.operators import bundles
from quayside.streaming import streams


def run(stream, spark, name, mode="append", rows=1):
    """What the query gives: waits for so many rows, half a minute at most. (A query with a time to
    live keeps running batches, so it never counts as idle.)"""
    q = stream.writeStream.format("memory").queryName(name).outputMode(mode).start()
    try:
        end = time.time() + 30
        while time.time() < end and q.isActive and spark.table(name).count() < rows:
            time.sleep(0.3)
    finally:
        q.stop()
    return spark.table(name).collect()


def write(folder, rows, n):
    folder.mkdir(exist_ok=True)
    (folder / f"{n}.json").write_text("\n".join(rows))


def test_watch(spark, tmp_path):
    for i in range(3):
        (tmp_path / f"f{i}.txt").write_text(str(i))
    got = run(streams.watch_files(spark, str(tmp_path), max_files=1).select("path", "length"), spark, "watched", rows=3)
    assert len(got) == 3


def test_dedup_and_rates(spark, tmp_path):
    d = tmp_path / "in"
    write(d, ['{"source":"a","ts":"2024-01-01 00:00:00.1"}', '{"source":"a","ts":"2024-01-01 00:00:00.7"}', '{"source":"b","ts":"2024-01-01 00:00:01"}'], 1)
    src = spark.readStream.schema("source string, ts timestamp").json(str(d))
    assert sorted(r["source"] for r in run(streams.dedup_within(src, ["source"], "ts", "1 minute"), spark, "dedup", rows=2)) == ["a", "b"]
    rates = run(streams.request_rates(src), spark, "rates", "complete", 2)
    assert sorted((r["source"], r["count"]) for r in rates) == [("a", 2), ("b", 1)]
    once = run(streams.dedup_with_ttl(src, "source", 3600), spark, "once", rows=2)
    assert sorted(r["source"] for r in once) == ["a", "b"]


def test_modified_since(spark, tmp_path):
    d = tmp_path / "in"
    src = spark.readStream.schema("path string, mtime timestamp").option("maxFilesPerTrigger", 1).json(str(d)) if d.mkdir() is None else None
    write(d, ['{"path":"f1","mtime":"2024-01-01"}', '{"path":"f2","mtime":"2024-01-01"}'], 1)
    time.sleep(1.1)
    write(d, ['{"path":"f1","mtime":"2024-01-01"}', '{"path":"f2","mtime":"2024-01-02"}'], 2)
    got = sorted((r["path"], r["mtime"].day) for r in run(streams.modified_since(src), spark, "modified", rows=3))
    assert got == [("f1", 1), ("f2", 1), ("f2", 2)]


def test_counters(spark, tmp_path):
    d = tmp_path / "in"
    write(d, ['{"name":"x","amount":2}', '{"name":"x"}', '{"name":"y"}'], 1)
    src = spark.readStream.schema("name string, amount int").json(str(d))
    assert {r["name"]: r["value"] for r in run(streams.running_counters(src), spark, "counted", "complete", 2)} == {"x": 3, "y": 1}


def test_completion_is_once(spark, tmp_path):
    calls = []
    done = bundles.complete_once(str(tmp_path / "done"), [lambda df: calls.append(df.count())])
    batch = spark.createDataFrame([("b1", 1), ("b1", 1), ("b2", 2)], "bid string, n int")
    for _ in range(2):
        done(batch, 0)
    done(spark.createDataFrame([("b3", 1)], "bid string, n int"), 1)
    assert sorted(r["bid"] for r in spark.read.parquet(str(tmp_path / "done")).collect()) == ["b1", "b2", "b3"] and calls == [2, 1]
    seen = []
    streams.fan_out(lambda df, i: seen.append(("a", df.count())), lambda df, i: seen.append(("b", df.count())))(batch, 0)
    assert seen == [("a", 3), ("b", 3)]


def test_next_due(spark):
    t = lambda *a: dt.datetime(*a)
    df = spark.createDataFrame([(t(2024, 1, 31, 23),), (t(2024, 1, 31, 1),)], "x timestamp")
    got = df.select(F.date_format(streams.next_due(F.col("x"), "06:00", "Europe/Paris"), "yyyy-MM-dd HH:mm").alias("d")).collect()
    assert [r["d"] for r in got] == ["2024-02-01 05:00", "2024-01-31 05:00"]


def test_expiry_is_not_row_by_row(spark, tmp_path):
    """No row goes through Python; rows without a time take no part, one that comes at the end itself belongs to the stretch."""
    t = lambda ms: dt.datetime(2024, 1, 1) + dt.timedelta(milliseconds=ms)
    rows = [("a", t(0)), ("a", t(10_000)), ("a", t(20_001)), ("a", None), (None, t(5)), ("z", t(90_000))]
    spark.createDataFrame(rows, "k string, ts timestamp").coalesce(1).write.parquet(f"{tmp_path}/in")
    out = streams.expired_keys(spark.readStream.schema("k string, ts timestamp").parquet(f"{tmp_path}/in"), "k", "ts", 10_000)
    assert "TransformWithState" not in out._jdf.queryExecution().toString()
    got = sorted(((r["key"], r["n"], r["expired_ms"] - r["since_ms"]) for r in run(out, spark, "silent", rows=3)), key=str)
    assert got == [("a", 1, 10_000), ("a", 2, 20_000), (None, 1, 10_000)]


def test_modified_since_in_large_batches(spark, tmp_path):
    """A path's rows of one batch may be more than an Arrow batch has, in any order: each time passes once. Times may lie before 1970."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 3)
    try:
        rows = spark.range(20).selectExpr("'f' AS path", "timestamp_seconds((id % 10 - 5) * 7 % 10) AS mtime")
        rows.orderBy(F.desc("mtime")).coalesce(1).write.parquet(f"{tmp_path}/in")
        src = spark.readStream.schema(rows.schema).parquet(f"{tmp_path}/in")
        got = run(streams.modified_since(src), spark, "modified_large", rows=10)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert sorted(r["mtime"] for r in got) == sorted(r["mtime"] for r in rows.distinct().collect()) and len(got) == rows.distinct().count()

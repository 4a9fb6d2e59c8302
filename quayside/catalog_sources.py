"""Registered queries on sources, strategies by name, and streams of files: what lands is written by the query itself, from the given tables."""

from __future__ import annotations

import datetime as dt
import time

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .catalog import query, read
from .catalog_writes import _place, _settled
from .operators import bundles, registry, state
from .operators.store import StateStore
from .plans import requests
from .sources import files
from .streaming import streams

# ---------------------------------------------------------------- files


def _landed(spark, sf_dir) -> str:
    """The keys of orders in files, one for each status and first letter of the priority: status=F/level=1/..."""
    path = _place(spark, "orders")
    o = read(spark, sf_dir, "orders").select(F.col("o_orderkey").cast("string").alias("value"), F.col("o_orderstatus").alias("status"), F.substring("o_orderpriority", 1, 1).alias("level"))
    o.repartition("status", "level").sortWithinPartitions("status", "level", "value").write.partitionBy("status", "level").text(path)
    return path


def _folder(path: str = "path"):
    return F.regexp_extract(path, "(status=.*/level=[^/]*)/", 1)


_FILES = """(SELECT 'status=' || o_orderstatus || '/level=' || substr(o_orderpriority, 1, 1) AS folder, string_agg(o_orderkey || '', chr(10) ORDER BY o_orderkey || '') || chr(10) AS body FROM orders GROUP BY 1)"""


@query(f"SELECT folder, CAST(length(body) AS BIGINT) AS bytes FROM {_FILES} f")
def listed_files(spark, sf_dir):
    """A directory's files with their lengths; contents are not read."""
    return files.list_files(spark, _landed(spark, sf_dir)).select(_folder().alias("folder"), F.col("length").alias("bytes"))


@query(f"SELECT folder, true AS found FROM {_FILES} f WHERE folder LIKE 'status=O%' UNION ALL SELECT 'status=' || r_name || '/level=0', false FROM region")
def explicit_list(spark, sf_dir):
    """Files asked for by name: those that are there, and a report of those that are not."""
    listing = files.list_files(spark, _landed(spark, sf_dir)).withColumn("path", _folder())
    gone = read(spark, sf_dir, "region").select(F.concat(F.lit("status="), "r_name", F.lit("/level=0")).alias("path"))
    found, missing = files.explicit_files(listing.filter("path LIKE 'status=O%'").select("path").union(gone), listing)
    return found.select(F.col("path").alias("folder"), F.lit(True).alias("found")).union(missing.select("path", F.lit(False)))


@query(f"SELECT folder, sha256(body) AS sha256, CAST(length(body) AS BIGINT) AS length, 1 AS resources_count FROM {_FILES} f WHERE folder NOT LIKE '%level=3'")
def files_as_bundles(spark, sf_dir):
    """Each file as a bundle of one resource; a filter on the path keeps others from being read."""
    at = F.lit("2024-01-01 00:00:00").cast("timestamp")
    res = files.file_resources(spark, _landed(spark, sf_dir), "orders", at, ~F.col("path").like("%level=3%"))
    rows = bundles.manifest(res).join(res.select("bid", _folder("url").alias("folder"), "length"), "bid")
    counts = rows.groupBy("bid").agg(F.count("*").cast("int").alias("resources_count"))
    return rows.join(counts, "bid").select("folder", "sha256", "length", "resources_count")


@query(f"SELECT count(*) AS resources_count, CAST(sum(length(body)) AS BIGINT) AS total_bytes, true AS one_bid FROM {_FILES} f")
def directory_as_bundle(spark, sf_dir):
    """A directory as one bundle."""
    at = F.lit("2024-01-01 00:00:00").cast("timestamp")
    whole = bundles.load_bundle(files.file_resources(spark, _landed(spark, sf_dir), "orders", at), "bid:v1:orders:20240101000000:00000000")
    made = bundles.bundle_hashes(bundles.manifest(whole))
    return made.select("resources_count", "total_bytes", (F.col("bid") == "bid:v1:orders:20240101000000:00000000").alias("one_bid"))


@query("""SELECT CAST(conv_id % 28 AS BIGINT) AS day, count(*) AS count, CAST(sum(turn) AS BIGINT) AS total, 'c' || (conv_id % 28) AS next_cursor FROM conversations GROUP BY conv_id % 28""")
def landed_responses(spark, sf_dir):
    """API responses that landed as files, one body each, read whole and parsed."""
    path = _place(spark, "responses")
    day = (F.col("conv_id") % 28).alias("day")
    per = read(spark, sf_dir, "conversations").groupBy(day).agg(F.count("*").alias("nombre"), F.sum("turn").alias("total"))
    head = F.struct("total", "nombre", F.concat(F.lit("c"), F.col("day").cast("string")).alias("curseurSuivant"))
    per.select("day", F.to_json(F.struct(head.alias("header"))).alias("value")).repartition("day").write.partitionBy("day").option("lineSep", " ").text(path)
    pages = requests.parsed_pages(files.landed_pages(spark, f"{path}/*/*.txt"))
    return pages.select(F.regexp_extract("path", "day=([0-9]+)", 1).cast("long").alias("day"), F.col("count").cast("long").alias("count"), "total", "next_cursor")


@query("SELECT CAST(row_number() OVER (ORDER BY n_nationkey) - 1 AS INT) AS ordinal, 'https://x/' || n_name AS url FROM nation QUALIFY n_nationkey NOT IN (SELECT s_nationkey FROM supplier WHERE s_suppkey < 10)")
def url_source(spark, sf_dir):
    """A fixed list of URLs, less those that were processed; a nation's URL is its page."""
    urls = [f"https://x/{r[0]}" for r in read(spark, sf_dir, "nation").orderBy("n_nationkey").select("n_name").collect()]  # 25 fixed rows
    done = read(spark, sf_dir, "supplier").filter("s_suppkey < 10").join(read(spark, sf_dir, "nation"), F.expr("s_nationkey = n_nationkey")).select(F.concat(F.lit("https://x/"), "n_name").alias("url"))
    return state.unprocessed(files.url_list(spark, urls), done, "url")


# ---------------------------------------------------------------- callbacks, strategies, sets


@query("SELECT source AS bid, CAST(CASE WHEN bool_or(doc_id % 2 = 0) THEN 0 ELSE 1 END AS BIGINT) AS batch_id, 2 AS calls FROM documents GROUP BY source")
def completion_callbacks(spark, sf_dir):
    """Two callbacks on every bundle that completes; a batch that is run again calls neither."""
    path = _place(spark, "called")

    def note(name: str):
        return lambda new: new.select("bid", "batch_id", F.lit(name).alias("callback")).write.mode("append").parquet(f"{path}/notes")

    done = bundles.complete_once(f"{path}/feed", [note("loader"), note("locator")])
    d = read(spark, sf_dir, "documents").select("doc_id", F.col("source").alias("bid"))
    for batch, part in ((0, "doc_id % 2 = 0"), (0, "doc_id % 2 = 0"), (1, "doc_id >= 0")):
        done(d.filter(part).select("bid").distinct(), batch)
    notes = spark.read.schema("bid string, batch_id long, callback string").parquet(f"{path}/notes")
    return notes.groupBy("bid", "batch_id").agg(F.count("*").cast("int").alias("calls"))


@query("""SELECT p_partkey, p_name || '-' || strftime(DATE '2024-01-01' + CAST(p_partkey % 300 AS INT), '%Y%m%d') || '.csv' AS path FROM part
WHERE p_partkey % 300 >= 100 AND lower(p_name) LIKE '%a%' AND length(p_name) % 2 = 0 ORDER BY path DESC, p_partkey LIMIT 150""")
def files_by_strategies(spark, sf_dir):
    """A date filter, a pattern and a user's function, all made by name with their parameters checked, and a sort by name; the 150 first."""
    r = registry.default_registry()
    r.register("even_name", lambda: registry.column_filter(lambda c: F.length(F.regexp_extract(c, "^(.*)-[0-9]{8}[.]csv$", 1)) % 2 == 0), registry.needs())
    wanted = {"filters": [{"type": "first_date_filter", "start_date": "20240410"}, {"type": "pattern_filter", "pattern": "*a*-*.csv", "case_sensitive": False}, {"type": "even_name"}]}
    try:
        r.create("first_date_filter", {"start": "20240410"})
        raise AssertionError("a parameter is missing")
    except ValueError:
        pass
    keep = r.create("composite_filter", wanted)("path")
    day = F.date_add(F.lit(dt.date(2024, 1, 1)), (F.col("p_partkey") % 300).cast("int"))
    p = read(spark, sf_dir, "part").select("p_partkey", F.concat("p_name", F.lit("-"), F.date_format(day, "yyyyMMdd"), F.lit(".csv")).alias("path"))
    return registry.select_files(p, keep, [*r.create("path_sort", {"reverse": True}), F.col("p_partkey")], cap=150)


@query("SELECT p_partkey FROM part WHERE p_partkey % 5 <> 0 OR p_partkey % 3 = 0 EXCEPT SELECT p_partkey FROM part WHERE p_partkey % 7 = 0")
def processed_sets(spark, sf_dir):
    """Sets of processed parts, saved by two runs and loaded again; of the first, a third was saved for an hour only and is forgotten."""
    store = StateStore(spark, _place(spark, "processed"), buckets=8)
    p = read(spark, sf_dir, "part").select(F.col("p_partkey").cast("string").alias("path"), "p_partkey")
    t = [F.lit(f"2024-01-01 {h}:00:00").cast("timestamp") for h in ("00", "06", "12")]
    state.save_processed(store, p.filter("p_partkey % 5 = 0 AND p_partkey % 3 <> 0"), t[0], "run")
    state.save_processed(store, p.filter("p_partkey % 5 = 0 AND p_partkey % 3 = 0 AND p_partkey % 7 <> 0"), t[0], "run", 3600)
    state.save_processed(store, p.filter("p_partkey % 7 = 0"), t[1], "run")
    return state.unprocessed(p, state.load_processed(store, t[2], "run")).select("p_partkey")


@query("SELECT event_id FROM events WHERE ts + INTERVAL 3 DAYS > (SELECT max(ts) FROM events) OR event_type = 'click'")
def purged_keys(spark, sf_dir):
    """Rows that have not expired; clicks never do."""
    e = read(spark, sf_dir, "events").withColumn("at", F.col("ts").cast("timestamp"))
    now = e.agg(F.max("at")).first()[0]
    rows = e.select("event_id", F.when(F.col("event_type") != "click", F.col("at") + F.expr("INTERVAL 3 DAYS")).alias("expires_at"))
    return state.purge(rows, F.lit(now)).select("event_id")


@query("""SELECT CAST(row_number() OVER (ORDER BY day) - 1 AS INT) AS ordinal, strftime(day, '%Y-%m-%d') AS day, '*' AS cursor
FROM (SELECT unnest(generate_series(DATE '2024-01-10', (SELECT max(CAST(ts AS DATE)) FROM events), INTERVAL 1 DAY)) AS day)""")
def open_ended_days(spark, sf_dir):
    """A plan without an end goes up to the day it is made, here that of the last event."""
    today = read(spark, sf_dir, "events").agg(F.max(F.to_date("ts"))).first()[0]
    return requests.day_plan(spark, dt.date(2024, 1, 10), as_of=today).withColumn("day", F.date_format("day", "yyyy-MM-dd"))


@query("""WITH t AS (SELECT n_nationkey AS d, sum(c_acctbal) AS s FROM nation JOIN customer ON c_nationkey = n_nationkey GROUP BY 1)
SELECT strftime(DATE '2024-01-01' + CAST(d AS INT), '%Y-%m-%d') AS day, count(*) AS searches FROM (SELECT d, unnest(CASE WHEN CAST(round(s) AS BIGINT) > 250000 THEN range(100) ELSE [0] END) FROM t) AS x GROUP BY 1""")
def narrowing_by_name(spark, sf_dir):
    """The narrowing of a plan as a strategy that is made by name."""
    narrow = registry.default_registry().create("prefix_narrowing")
    t = read(spark, sf_dir, "customer").groupBy("c_nationkey").agg(F.sum("c_acctbal").alias("s"))
    t = t.select(F.date_add(F.lit("2024-01-01").cast("date"), F.col("c_nationkey").cast("int")).alias("day"), F.round("s").cast("long").alias("total"))
    plan = narrow(t.select("day", F.lit("*").alias("cursor")), t, 250_000)
    return plan.groupBy(F.date_format("day", "yyyy-MM-dd").alias("day")).agg(F.count("*").alias("searches"))


@query("SELECT event_id, strftime(CASE WHEN ts < date_trunc('day', ts) + INTERVAL 6 HOURS THEN date_trunc('day', ts) + INTERVAL 6 HOURS ELSE date_trunc('day', ts) + INTERVAL 30 HOURS END, '%Y-%m-%d %H:%M') AS due FROM events")
def daily_due(spark, sf_dir):
    """When a job that last ran at an event's time is due again, at six every day."""
    gate = registry.default_registry().create("daily_gate", {"time_of_day": "06:00", "tz": "UTC"})
    e = read(spark, sf_dir, "events").select("event_id", F.col("ts").cast("timestamp").alias("ts"))
    return e.select("event_id", F.date_format(gate(F.col("ts")), "yyyy-MM-dd HH:mm").alias("due"))


# ---------------------------------------------------------------- streams of files


def _in_turn(frame: DataFrame, path: str, parts: int, part, kind: str = "parquet") -> None:
    """Lands a file for each part, one after the other, so that their times differ."""
    for i in range(parts):
        frame.filter(part == i).repartition(1).write.format(kind).save(f"{path}/{i}")
        time.sleep(0.05)


@query("""WITH e AS (SELECT DISTINCT user_id, ts, event_id % 2 AS part FROM events),
first AS (SELECT user_id, max(ts) AS last FROM e WHERE part = 0 GROUP BY 1)
SELECT user_id, count(*) AS passed FROM (SELECT user_id, ts FROM e WHERE part = 0 UNION ALL SELECT e.user_id, ts FROM e LEFT JOIN first f USING (user_id) WHERE part = 1 AND (last IS NULL OR ts > last)) AS p GROUP BY 1""")
def stream_modified_since(spark, sf_dir):
    """Files (users) as they are seen again in a second landing: only later times pass."""
    path = _place(spark, "modified")
    e = read(spark, sf_dir, "events").select(F.col("user_id").cast("string").alias("path"), F.col("ts").cast("timestamp").alias("mtime"), "event_id")
    _in_turn(e, path, 2, F.col("event_id") % 2)
    conf, provider = "spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    before = spark.conf.get(conf)
    spark.conf.set(conf, provider)
    try:
        seen = _settled(streams.modified_since(spark.readStream.schema(e.schema).option("maxFilesPerTrigger", 1).parquet(f"{path}/*").select("path", "mtime")))
    finally:
        spark.conf.set(conf, before)
    return seen.groupBy(F.col("path").cast("long").alias("user_id")).agg(F.count("*").alias("passed"))


@query("SELECT CAST(3 - part AS BIGINT) AS batch, CAST(part AS BIGINT) AS part, CAST(sum(length(o_orderkey || '') + 1) AS BIGINT) AS bytes FROM (SELECT o_orderkey, o_orderkey % 4 AS part FROM orders) AS o GROUP BY part")
def stream_newest_first(spark, sf_dir):
    """Four files wait; one is taken in each batch, the newest first."""
    path = _place(spark, "waiting")
    o = read(spark, sf_dir, "orders").select(F.col("o_orderkey").cast("string").alias("value"))
    for i in range(4):
        o.filter(F.col("value").cast("long") % 4 == i).coalesce(1).write.text(f"{path}/part={i}")
        time.sleep(1.1)  # files are told apart by the second in some stores
    seen = streams.watch_files(spark, f"{path}/*/*.txt", max_files=1, newest_first=True).select("path", "length")
    spark.createDataFrame([], "path string, length long, batch long").write.parquet(f"{path}-out")
    q = seen.writeStream.option("checkpointLocation", f"{path}-checkpoint").trigger(availableNow=True)
    q.foreachBatch(lambda df, i: df.withColumn("batch", F.lit(i).cast("long")).write.mode("append").parquet(f"{path}-out")).start().awaitTermination()
    out = spark.read.schema("path string, length long, batch long").parquet(f"{path}-out")
    return out.select("batch", F.regexp_extract("path", "part=([0-9])", 1).cast("long").alias("part"), F.col("length").alias("bytes"))

"""Registered queries on the star-schema tables, with the SQL that gives the same rows."""

from __future__ import annotations

import gzip
import io
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .functions import names
from .operators import archives, bundles, filters, reports, state
from .plans import requests
from .sources import files

QUERIES: dict[str, Callable] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a function under its name."""

    def add(fn):
        QUERIES[fn.__name__] = fn
        if sql is not None:
            ORACLE_SQL[fn.__name__] = sql
        return fn

    return add


def read(spark, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _files(spark, sf_dir) -> DataFrame:
    """Documents as landed files: (doc_id, path, name, content)."""
    name = F.concat_ws("/", "source", F.concat(F.col("doc_id").cast("string"), F.lit(".txt")))
    return read(spark, sf_dir, "documents").select("doc_id", name.alias("name"), F.encode("text", "UTF-8").alias("content"), "lang", "source")


_NAME = "source || '/' || doc_id || '.txt'"

# ---------------------------------------------------------------- landing


@query(f"""SELECT {_NAME} AS name, sha256(text) AS sha256, CAST(octet_length(encode(text)) AS BIGINT) AS size
FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)""")
def new_files_manifest(spark, sf_dir):
    """List, glob, leave out what is processed (labelled), hash: the manifest of new files."""
    listing = _files(spark, sf_dir).filter(filters.glob("name", "src*/*.txt"))
    new = state.unprocessed(listing, read(spark, sf_dir, "labels"), "doc_id")
    return bundles.manifest(new.withColumn("bid", F.lit(None))).drop("bid")


@query("""WITH r AS (SELECT l_orderkey, lpad(CAST(l_linenumber AS VARCHAR), 3, '0') || '-' || l_partkey AS name,
  sha256(l_partkey || '|' || l_suppkey || '|' || l_returnflag || '|' || l_linestatus) AS h,
  octet_length(encode(l_partkey || '|' || l_suppkey || '|' || l_returnflag || '|' || l_linestatus)) AS n FROM lineitem)
SELECT l_orderkey AS bid, count(*) AS resources_count, CAST(sum(n) AS BIGINT) AS total_bytes, sha256(string_agg(h, '' ORDER BY name, h)) AS bundle_hash
FROM r GROUP BY l_orderkey""")
def bundle_hash_by_order(spark, sf_dir):
    content = F.concat_ws("|", F.col("l_partkey").cast("string"), F.col("l_suppkey").cast("string"), "l_returnflag", "l_linestatus")
    name = F.concat_ws("-", F.lpad(F.col("l_linenumber").cast("string"), 3, "0"), F.col("l_partkey").cast("string"))
    lines = read(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("bid"), name.alias("name"), content.cast("binary").alias("content"))
    return bundles.bundle_hashes(bundles.manifest(lines))


@query("""SELECT source, count(*) AS resources_count, CAST(sum(octet_length(encode(text))) AS BIGINT) AS total_bytes FROM documents GROUP BY source""")
def bundle_sizes_by_source(spark, sf_dir):
    size = F.octet_length("content").cast("long")
    return _files(spark, sf_dir).groupBy("source").agg(F.count("*").alias("resources_count"), F.sum(size).alias("total_bytes"))


@query("""SELECT source || '/' || d.doc_id || '.txt' AS name, CASE WHEN l.doc_id IS NULL THEN 'new' WHEN l.quality = 1 THEN 'unchanged' ELSE 'changed' END AS change
FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id""")
def content_changes(spark, sf_dir):
    """Stored hashes: of labelled documents; of bad ones an older content."""
    docs = _files(spark, sf_dir)
    now = docs.select("name", F.sha2("content", 256).alias("sha256"))
    old = docs.join(read(spark, sf_dir, "labels"), "doc_id")
    stored = F.when(F.col("quality") == 1, F.col("content")).otherwise(F.concat("content", F.lit("old").cast("binary")))
    return bundles.content_changes(now, old.select("name", F.sha2(stored, 256).alias("sha256"))).select("name", "change")


@query("""SELECT sha256(text) AS sha256, count(*) AS copies, min(doc_id) AS first_doc FROM documents GROUP BY 1 HAVING count(*) > 1""")
def exact_copies(spark, sf_dir):
    h = _files(spark, sf_dir).select("doc_id", F.sha2("content", 256).alias("sha256"))
    return h.groupBy("sha256").agg(F.count("*").alias("copies"), F.min("doc_id").alias("first_doc")).filter("copies > 1")


@query(f"""SELECT {_NAME} AS original, sha256(text) AS sha256, CAST(octet_length(encode(text)) AS BIGINT) AS size, true AS same FROM documents""")
def archive_gunzip(spark, sf_dir):
    """Every document is packed by gzip in one job and unpacked by the engine in the next."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return archives.packed((name.as_py(), gzip.compress(x.as_py(), 1, mtime=0)) for b in batches for name, x in zip(b.column("name"), b.column("content"), strict=True))

    docs = _files(spark, sf_dir)
    packed = docs.select(F.concat("name", F.lit(".gz")).alias("name"), "content").mapInArrow(run, "name string, content binary")
    res = packed.select(
        F.lit("b").alias("bid"), "name", F.col("name").alias("url"), F.lit("application/gzip").alias("content_type"), F.lit(200).alias("status_code"),
        F.lit(None).cast("string").alias("derived_from"), "content",
    )
    out = archives.expand(res).filter("derived_from is not null")
    same = F.concat("name", F.lit(".gz")) == F.col("derived_from")
    return out.select(F.col("name").alias("original"), F.sha2("content", 256).alias("sha256"), F.octet_length("content").cast("long").alias("size"), same.alias("same"))


@query("""SELECT 'conv-' || conv_id || '.zip' AS derived_from, count(*) AS members, CAST(sum(octet_length(encode(text))) AS BIGINT) AS bytes FROM conversations GROUP BY conv_id""")
def archive_members(spark, sf_dir):
    """Turns zipped by conversation and date-free name, expanded, with lineage kept."""
    import zipfile

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def made(member: str, body: bytes) -> bytes:
            f = io.BytesIO()
            with zipfile.ZipFile(f, "w") as z:
                z.writestr(member, body)
            return f.getvalue()

        return archives.packed((name.as_py(), made(member.as_py(), body.as_py())) for b in batches for name, member, body in zip(*(b.column(c) for c in ("name", "member", "content")), strict=True))

    turns = read(spark, sf_dir, "conversations").select(
        F.concat(F.lit("conv-"), F.col("conv_id").cast("string"), F.lit(".zip")).alias("name"),
        F.concat(F.lit("turn-"), F.col("turn").cast("string"), F.lit(".txt")).alias("member"), F.encode("text", "UTF-8").alias("content"),
    )
    res = turns.mapInArrow(run, "name string, content binary").select(
        F.lit("b").alias("bid"), "name", F.col("name").alias("url"), F.lit("application/zip").alias("content_type"), F.lit(200).alias("status_code"),
        F.lit(None).cast("string").alias("derived_from"), "content",
    )
    out = archives.expand(res).filter("derived_from is not null")
    return out.groupBy("derived_from").agg(F.count("*").alias("members"), F.sum(F.octet_length("content").cast("long")).alias("bytes"))


@query("""SELECT 'no metadata' AS violation, count(*) AS n FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)
UNION ALL SELECT 'no content', count(*) FROM labels l WHERE NOT EXISTS (SELECT 1 FROM documents d WHERE d.doc_id = l.doc_id)
UNION ALL SELECT 'no manifest', count(DISTINCT source) FROM documents d WHERE source NOT IN (SELECT source FROM documents JOIN labels USING (doc_id) WHERE toxic = 1)
UNION ALL SELECT 'no discovery record', count(DISTINCT source) FROM documents d WHERE source NOT IN (SELECT source FROM documents JOIN labels USING (doc_id) WHERE quality = 0)""")
def completeness_audit(spark, sf_dir):
    """Labels as metadata, sources as bundles; counts of each kind of violation, zeros included."""
    docs = read(spark, sf_dir, "documents").select(F.col("source").alias("bid"), F.col("doc_id").cast("string").alias("name"), "doc_id")
    labels = read(spark, sf_dir, "labels")
    meta = labels.join(docs, "doc_id", "left").select("bid", F.col("doc_id").cast("string").alias("name"), "quality", "toxic")
    found = bundles.completeness(
        docs.select(F.lit("x").alias("bid"), "name"), meta.select(F.lit("x").alias("bid"), "name"), docs.filter("false"), docs.filter("false")
    ).filter("name is not null")
    by_bundle = bundles.completeness(docs, docs, meta.filter("toxic = 1"), meta.filter("quality = 0")).filter("name is null")
    kinds = spark.createDataFrame([(k,) for k in ("no metadata", "no content", "no manifest", "no discovery record")], "violation string")
    n = found.union(by_bundle).groupBy("violation").agg(F.count("*").alias("n"))
    return kinds.join(n, "violation", "left").withColumn("n", F.coalesce("n", F.lit(0)))


# ---------------------------------------------------------------- filters and sorts


@query("SELECT p_partkey, p_name FROM part WHERE regexp_full_match(p_name, '.*r[^a-d].* [rw]i.*')")
def glob_parts(spark, sf_dir):
    return read(spark, sf_dir, "part").filter(filters.glob("p_name", "*r[!a-d]* [rw]i*")).select("p_partkey", "p_name")


@query("SELECT p_partkey, p_brand FROM part WHERE regexp_full_match(lower(p_brand), 'brand#.[0-4]')")
def glob_parts_nocase(spark, sf_dir):
    return read(spark, sf_dir, "part").filter(filters.glob("p_brand", "BRAND#?[0-4]", case_sensitive=False)).select("p_partkey", "p_brand")


def _dated(spark, sf_dir):
    name = F.concat(F.col("o_orderkey").cast("string"), F.date_format("o_orderdate", "yyyyMMdd"), F.lit("c.txt"))
    return read(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate", name.alias("name"))


_DATED = "(SELECT o_orderkey, o_orderdate, o_orderkey || strftime(o_orderdate, '%Y%m%d') || 'c.txt' AS name FROM orders)"
_ANY = "len(list_filter(range(1, length(name) - 6), lambda i: regexp_full_match(substr(name, i, 8), '[0-9]{8}') AND substr(name, i, 8) >= '19970601')) > 0"


@query(f"SELECT o_orderkey, name FROM {_DATED} WHERE {_ANY}")
def date_any_orders(spark, sf_dir):
    return _dated(spark, sf_dir).filter(filters.any_date_from("name", "19970601")).select("o_orderkey", "name")


@query(f"SELECT o_orderkey, name FROM {_DATED} WHERE regexp_extract(name, '([0-9]{{8}})', 1) >= '19970601'")
def date_first_orders(spark, sf_dir):
    return _dated(spark, sf_dir).filter(filters.first_date_from("name", "19970601")).select("o_orderkey", "name")


@query(f"SELECT o_orderkey FROM {_DATED} WHERE (name LIKE '%0_c.txt' OR name LIKE '1%') AND {_ANY}")
def composite_filter(spark, sf_dir):
    either = filters.composite([filters.glob("name", "*0?c.txt"), filters.glob("name", "1*")], "OR")
    return _dated(spark, sf_dir).filter(filters.composite([either, filters.any_date_from("name", "19970601")])).select("o_orderkey")


@query("SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS day FROM orders ORDER BY o_orderdate DESC NULLS FIRST, o_orderkey LIMIT 100")
def sort_recent_orders(spark, sf_dir):
    rows = read(spark, sf_dir, "orders").select("o_orderkey", F.col("o_orderdate").alias("mtime"), F.col("o_orderkey").alias("ordinal"))
    top = rows.orderBy(*state.sort_by_mtime(reverse=True)).limit(100)
    return top.select("o_orderkey", F.date_format("mtime", "yyyy-MM-dd").alias("day"))


# ---------------------------------------------------------------- membership and state


@query("""SELECT o_orderkey AS path, o_orderstatus FROM orders WHERE o_orderstatus <> 'F'
AND o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')""")
def unprocessed_orders(spark, sf_dir):
    orders = read(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("path"), "o_orderstatus")
    returned = read(spark, sf_dir, "lineitem").filter("l_returnflag = 'R'").select(F.col("l_orderkey").alias("path"))
    return state.unprocessed(orders, state.known(orders.filter("o_orderstatus = 'F'"), returned))


@query("""WITH s AS (SELECT user_id, max(ts) AS last FROM events WHERE event_type IN ('signup', 'view') GROUP BY 1)
SELECT e.event_id FROM events e LEFT JOIN s USING (user_id) WHERE e.event_type NOT IN ('signup', 'view') AND (s.last IS NULL OR e.ts > s.last)""")
def modified_since(spark, sf_dir):
    e = read(spark, sf_dir, "events").select("event_id", F.col("user_id").alias("path"), F.col("ts").alias("mtime"), "event_type")
    seen = e.filter("event_type IN ('signup', 'view')").select("path", F.col("mtime").alias("last_mtime"))
    return state.modified_since(e.filter("event_type NOT IN ('signup', 'view')"), seen).select("event_id")


@query("""WITH f AS (SELECT DISTINCT user_id FROM events WHERE event_type = 'signup' AND value > 40),
d AS (SELECT DISTINCT user_id FROM events WHERE event_type = 'purchase' AND value > 60),
w AS (SELECT DISTINCT user_id FROM events WHERE event_type = 'click' AND value > 50)
SELECT user_id AS path, min(p) AS priority FROM (SELECT user_id, 0 AS p FROM f WHERE user_id NOT IN (SELECT user_id FROM d) UNION ALL SELECT user_id, 1 FROM w) GROUP BY 1""")
def recover_in_flight(spark, sf_dir):
    e = read(spark, sf_dir, "events").withColumn("path", F.col("user_id"))
    pick = lambda kind, least: e.filter((F.col("event_type") == kind) & (F.col("value") > least)).select("path").distinct()
    return state.recover_in_flight(pick("signup", 40), pick("purchase", 60), pick("click", 50))


@query("SELECT user_id AS k, event_type, value, strftime(ts, '%Y-%m-%d %H:%M:%S') AS at FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS n FROM events) WHERE n = 1")
def latest_per_user(spark, sf_dir):
    log = read(spark, sf_dir, "events").select(F.col("user_id").alias("k"), "event_type", "value", F.col("ts").alias("put_at"), F.col("event_id").alias("seq"))
    return state.last_write(log).select("k", "event_type", "value", F.date_format("put_at", "yyyy-MM-dd HH:mm:ss").alias("at"))


def _log(spark, sf_dir):
    key = names.prefixed_key(F.col("user_id").cast("string"), F.col("event_type"))
    ttl = F.when(F.col("event_type") != "signup", F.lit(7 * 86400))  # signups never expire
    return read(spark, sf_dir, "events").select(
        key.alias("k"), F.col("value").cast("string").alias("v"), F.col("ts").cast("timestamp").alias("put_at"), F.col("event_id").alias("seq"),
        names.expires_at(F.col("ts").cast("timestamp"), ttl).alias("expires_at"),
    )


_AS_OF = "2024-01-20 00:00:00"
_STATE = f"""(SELECT * FROM (SELECT event_type || ':' || user_id AS k, value AS v, event_id AS seq,
    CASE WHEN event_type <> 'signup' THEN date_trunc('second', ts) + INTERVAL 7 DAY END AS e,
    row_number() OVER (PARTITION BY event_type, user_id ORDER BY ts DESC, event_id DESC) AS n
  FROM events WHERE ts <= TIMESTAMP '{_AS_OF}') WHERE n = 1 AND (e IS NULL OR e >= TIMESTAMP '{_AS_OF}'))"""


def _state(spark, sf_dir):
    return state.current(_log(spark, sf_dir), F.lit(_AS_OF).cast("timestamp"))


@query(f"SELECT k, seq, e IS NOT NULL AS expires FROM {_STATE}")
def state_as_of(spark, sf_dir):
    return _state(spark, sf_dir).select("k", "seq", F.col("expires_at").isNotNull().alias("expires"))


@query(f"SELECT k, seq FROM {_STATE} WHERE k >= 'error:' AND k < 'signup:2'")
def state_range(spark, sf_dir):
    return state.key_range(_state(spark, sf_dir), "error:", "signup:2").select("k", "seq")


@query(f"SELECT k, seq FROM {_STATE} WHERE starts_with(k, 'purchase:1')")
def state_prefix(spark, sf_dir):
    return state.key_prefix(_state(spark, sf_dir), "purchase:1").select("k", "seq")


@query(f"SELECT k, seq FROM {_STATE} WHERE regexp_full_match(k, '.*k:[0-9]?5')")
def state_scan(spark, sf_dir):
    s = _state(spark, sf_dir)
    return s.filter(filters.composite([filters.glob("k", "*k:[0-9]5"), filters.glob("k", "*k:5")], "OR")).select("k", "seq")


@query(f"SELECT count(*) AS total_keys, count(e) AS expiring_keys FROM {_STATE}")
def state_stats(spark, sf_dir):
    return reports.state_stats(_state(spark, sf_dir))


@query(f"""WITH s AS {_STATE} SELECT q.k, coalesce(CAST(s.seq AS VARCHAR), 'none') AS v, s.k IS NOT NULL AS found
FROM (SELECT 'view:' || n_nationkey AS k FROM nation) q LEFT JOIN s ON s.k = q.k""")
def state_get(spark, sf_dir):
    s = _state(spark, sf_dir).withColumn("v", F.col("seq").cast("string"))
    keys = read(spark, sf_dir, "nation").select(names.prefixed_key(F.col("n_nationkey").cast("string"), F.lit("view:")).alias("k"))
    return state.exists(state.get(keys, s, "none"), s)


@query("""SELECT user_id AS k, event_type AS field, CAST(arg_max(CAST(json_extract(props, '$.k') AS BIGINT), (ts, event_id)) AS VARCHAR) AS value
FROM events GROUP BY 1, 2""")
def state_merge(spark, sf_dir):
    k = F.get_json_object("props", "$.k")
    e = read(spark, sf_dir, "events").select(F.col("user_id").alias("k"), F.create_map("event_type", k).alias("state"), F.col("ts").alias("put_at"), F.col("event_id").alias("seq"))
    return state.merge_states(e).select("k", F.explode("state").alias("field", "value"))


# ---------------------------------------------------------------- queues and retries


@query("SELECT event_type AS ns, event_id, row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) + 100 AS seq FROM events")
def fifo_numbers(spark, sf_dir):
    e = read(spark, sf_dir, "events").select(F.col("event_type").alias("ns"), "ts", "event_id")
    base = e.select("ns").distinct().withColumn("next_id", F.lit(101))
    return state.enqueue(e, ["ts", "event_id"], base=base).select("ns", "event_id", F.col("seq").cast("long").alias("seq"))


@query("SELECT event_id FROM events ORDER BY ts, event_id LIMIT 100")
def fifo_take(spark, sf_dir):
    e = read(spark, sf_dir, "events").select("event_id", F.struct("ts", "event_id").alias("seq"))
    return state.take(e, 500, cap=100).select("event_id")


@query("""WITH i AS (SELECT event_type AS ns, min(event_id) AS min_id, max(event_id) AS max_id, count(*) AS n FROM events GROUP BY 1),
c AS (SELECT event_type AS ns, max(event_id) + 1 AS next_id, count(CASE WHEN value >= 0 AND event_type <> 'view' THEN 1 END) AS size FROM events GROUP BY 1)
SELECT ns, min_id, max_id, n, next_id, size, max_id + 1 AS fixed_next_id, n AS fixed_size, next_id - size AS expected_start, next_id = max_id + 1 AND size = n AS consistent FROM i JOIN c USING (ns)""")
def queue_audit(spark, sf_dir):
    e = read(spark, sf_dir, "events").withColumn("ns", F.col("event_type"))
    size = F.count_if((F.col("value") >= 0) & (F.col("ns") != "view"))
    counters = e.groupBy("ns").agg((F.max("event_id") + 1).alias("next_id"), size.alias("size"))
    return state.queue_audit(e.select("ns", F.col("event_id").alias("seq")), counters)


@query("""SELECT user_id AS item_id, event_id, CAST(n - 1 AS INTEGER) AS retry_count, least(1.0 * pow(2.0, n - 1), 3.0) AS delay_s
FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS n FROM events WHERE event_type = 'error') WHERE n - 1 < 3""")
def retry_worklist(spark, sf_dir):
    errors = read(spark, sf_dir, "events").filter("event_type = 'error'").select(F.col("user_id").alias("item_id"), "ts", "event_id")
    tried = state.attempts(errors, order=("ts", "event_id")).filter(filters.may_retry(3))
    return tried.select("item_id", "event_id", "retry_count", names.backoff("retry_count", 1.0, 2.0, 3.0).alias("delay_s"))


# ---------------------------------------------------------------- reports


@query("""SELECT strftime(ts, '%Y%m%d') AS run_id, count(CASE WHEN event_type <> 'error' THEN 1 END) AS processed_count, count(CASE WHEN event_type = 'error' THEN 1 END) AS error_count,
count(DISTINCT CASE WHEN event_type = 'error' THEN floor(value / 10) END) AS kinds, count(CASE WHEN event_type <> 'error' THEN 1 END) = 0 AND count(CASE WHEN event_type = 'error' THEN 1 END) > 0 AS failed
FROM events GROUP BY 1""")
def run_summary(spark, sf_dir):
    bad = F.col("event_type") == "error"
    log = read(spark, sf_dir, "events").select(
        F.date_format("ts", "yyyyMMdd").alias("run_id"), F.when(bad, "error").otherwise("ok").alias("status"), F.when(bad, F.floor(F.col("value") / 10).cast("string")).alias("error")
    )
    out = reports.run_summary(log)
    return out.select("run_id", "processed_count", "error_count", F.size("errors").cast("long").alias("kinds"), "failed")


_ERROR = "CASE WHEN value < 20 THEN 'Connection reset' WHEN value < 40 THEN 'access denied' WHEN value < 60 THEN 'read timeout' ELSE 'odd' END"


@query("""SELECT CASE WHEN value < 20 OR (value >= 40 AND value < 60) THEN 'network' WHEN value < 40 THEN 'fatal' ELSE 'other' END AS error_class, count(*) AS n,
strftime(max(ts), '%Y-%m-%d %H:%M:%S') AS last_at FROM events WHERE event_type = 'error' GROUP BY 1""")
def error_classes(spark, sf_dir):
    e = read(spark, sf_dir, "events").filter("event_type = 'error'").select(F.expr(_ERROR).alias("error"), "ts")
    return reports.errors_by_class(e).select("error_class", "n", F.date_format("last_ts", "yyyy-MM-dd HH:mm:ss").alias("last_at"))


@query("""SELECT name, CAST(coalesce(sum(CASE WHEN e.event_id IS NULL THEN 0 ELSE coalesce(amount, 1) END), 0) AS BIGINT) AS value
FROM (SELECT unnest(['click', 'view', 'refund']) AS name) n LEFT JOIN (SELECT *, CASE WHEN value > 50 THEN 2 END AS amount FROM events) e ON e.event_type = n.name GROUP BY 1""")
def counters(spark, sf_dir):
    e = read(spark, sf_dir, "events").select(F.col("event_type").alias("name"), F.when(F.col("value") > 50, 2).alias("amount"))
    asked = spark.createDataFrame([("click",), ("view",), ("refund",)], "name string")
    return reports.counters(e, asked)


@query("""SELECT event_type AS operation, count(value) AS n, round(avg(value), 6) AS avg_s, min(value) AS min_s, max(value) AS max_s,
strftime(max(ts), '%Y-%m-%d %H:%M:%S') AS last_updated FROM events GROUP BY 1""")
def timing_stats(spark, sf_dir):
    e = read(spark, sf_dir, "events").select(F.col("event_type").alias("operation"), F.col("value").alias("seconds"), "ts")
    out = reports.timing_stats(e)
    return out.select("operation", "n", F.round("avg_s", 6).alias("avg_s"), "min_s", "max_s", F.date_format("last_updated", "yyyy-MM-dd HH:mm:ss").alias("last_updated"))


@query("""SELECT source, max(c) AS most, count(CASE WHEN c > 4 THEN 1 END) AS windows_over
FROM (SELECT event_type AS source, date_trunc('hour', ts) AS h, count(*) AS c FROM events GROUP BY 1, 2) GROUP BY 1""")
def rate_compliance(spark, sf_dir):
    e = read(spark, sf_dir, "events").select(F.col("event_type").alias("source"), F.col("ts").cast("timestamp").alias("ts"))
    return reports.rate_compliance(e, 4, "1 hour")


@query("SELECT o_orderpriority AS source, count(*) AS n, round(avg(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END), 6) AS success_rate FROM orders GROUP BY 1")
def success_rates(spark, sf_dir):
    o = read(spark, sf_dir, "orders").select(F.col("o_orderpriority").alias("source"), (F.col("o_orderstatus") == "F").alias("success"))
    return reports.success_rate(o).withColumn("success_rate", F.round("success_rate", 6))


# ---------------------------------------------------------------- request plans

_DAYS = "SELECT min(CAST(ts AS DATE)) AS lo, max(CAST(ts AS DATE)) AS hi FROM events"


def _span(spark, sf_dir):
    return read(spark, sf_dir, "events").agg(F.min(F.to_date("ts")), F.max(F.to_date("ts"))).first()


@query(f"""WITH s AS ({_DAYS}), d AS (SELECT lo, unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS t FROM s)
SELECT CAST(date_diff('day', lo, CAST(t AS DATE)) AS INTEGER) AS ordinal, strftime(t, '%Y-%m-%d') AS day,
'https://api.example.org/units?nombre=1000&curseur=*&q={names.REGISTRY_CONDITIONS} AND {names.REGISTRY_FIELD}:[' || strftime(t, '%Y-%m-%d') || 'T00:00:00%20TO%20' || strftime(t, '%Y-%m-%d') || 'T23:59:59]' AS url FROM d""")
def day_plan(spark, sf_dir):
    lo, hi = _span(spark, sf_dir)
    plan = requests.with_url(requests.day_plan(spark, lo, hi), "https://api.example.org/units")
    return plan.select("ordinal", F.date_format("day", "yyyy-MM-dd").alias("day"), "url")


@query(f"""WITH s AS ({_DAYS}), d AS (SELECT hi, unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS t FROM s)
SELECT CAST(date_diff('day', CAST(t AS DATE), hi) AS INTEGER) AS ordinal, strftime(t, '%Y-%m-%d') AS day FROM d WHERE CAST(t AS DATE) <= DATE '2024-01-20'""")
def day_plan_reverse(spark, sf_dir):
    import datetime as dt

    lo, hi = _span(spark, sf_dir)
    plan = requests.resumed(requests.day_plan(spark, lo, hi, reverse=True), dt.date(2024, 1, 20), reverse=True)
    return plan.select("ordinal", F.date_format("day", "yyyy-MM-dd").alias("day"))


@query("""WITH o AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS day FROM orders WHERE o_totalprice > 400000 AND o_orderpriority = '1-URGENT'),
s AS (SELECT unnest(generate_series(min(day), max(day), INTERVAL 1 DAY)) AS t FROM o)
SELECT strftime(t, '%Y-%m-%d') AS day FROM s WHERE CAST(t AS DATE) NOT IN (SELECT day FROM o)""")
def gap_days(spark, sf_dir):
    o = read(spark, sf_dir, "orders").filter("o_totalprice > 400000 AND o_orderpriority = '1-URGENT'").select(F.to_date("o_orderdate").alias("day"))
    return requests.gaps(o).select(F.date_format("day", "yyyy-MM-dd").alias("day"))


@query("""WITH t AS (SELECT c_nationkey, CAST(sum(c_acctbal) AS BIGINT) AS total FROM customer GROUP BY 1), p AS (SELECT DATE '2024-01-01' + CAST(c_nationkey AS INTEGER) AS day, total FROM t)
SELECT strftime(day, '%Y-%m-%d') AS day, lpad(CAST(r AS VARCHAR), 2, '0') AS prefix FROM p, range(0, 100) x(r) WHERE total > 200000
UNION ALL SELECT strftime(day, '%Y-%m-%d'), NULL FROM p WHERE total <= 200000""")
def narrow_plan(spark, sf_dir):
    t = read(spark, sf_dir, "customer").groupBy("c_nationkey").agg(F.sum("c_acctbal").alias("s"))
    t = t.select(F.date_add(F.lit("2024-01-01").cast("date"), F.col("c_nationkey").cast("int")).alias("day"), F.round("s").cast("long").alias("total"))
    plan = t.select("day", F.lit("*").alias("cursor"))
    return requests.narrowed(plan, t, 200_000).select(F.date_format("day", "yyyy-MM-dd").alias("day"), "prefix")


@query("""WITH p AS (SELECT DISTINCT lpad(CAST(c_custkey AS VARCHAR), CAST(greatest(2, length(CAST(c_custkey AS VARCHAR))) AS INTEGER), '0') AS p FROM customer),
n AS (SELECT p, CASE WHEN length(p) > 2 AND p LIKE '%9' THEN substr(p, 1, length(p) - 1) ELSE p END AS q FROM p)
SELECT p AS prefix, CASE WHEN p = '99' THEN p ELSE lpad(CAST(CAST(q AS BIGINT) + 1 AS VARCHAR), CAST(greatest(length(q), length(CAST(CAST(q AS BIGINT) + 1 AS VARCHAR))) AS INTEGER), '0') END AS successor FROM n""")
def prefix_successor(spark, sf_dir):
    key = F.col("c_custkey").cast("string")
    p = read(spark, sf_dir, "customer").select(F.lpad(key, F.greatest(F.length(key), F.lit(2)), F.lit("0")).alias("prefix")).distinct()
    return p.select("prefix", requests.next_prefix("prefix").alias("successor"))


@query("""WITH RECURSIVE p AS (SELECT DISTINCT conv_id, turn FROM conversations),
w AS (SELECT conv_id, turn, 0 AS depth FROM p WHERE turn = 0 UNION ALL SELECT p.conv_id, p.turn, w.depth + 1 FROM w JOIN p ON p.conv_id = w.conv_id AND p.turn = w.turn + 1)
SELECT conv_id AS chain, max(depth) AS depth, count(*) AS pages FROM w GROUP BY 1""")
def page_chain(spark, sf_dir):
    p = read(spark, sf_dir, "conversations").select(F.col("conv_id").alias("chain"), F.col("turn").alias("cursor"), (F.col("turn") + 1).alias("next_cursor")).distinct()
    walked = requests.cursor_chain(p, F.col("cursor") == 0)
    return walked.groupBy("chain").agg(F.max("depth").alias("depth"), F.count("*").alias("pages"))


@query("""SELECT conv_id, count(*) AS pages, CAST(sum(length(text)) AS BIGINT) AS records, max(length(text)) AS total,
sum(length(text)) = max(length(text)) AS complete, max(length(text)) > 2000 AS narrow FROM conversations GROUP BY 1""")
def page_totals(spark, sf_dir):
    n = F.length("text").cast("long")
    p = read(spark, sf_dir, "conversations").select(F.col("conv_id").alias("day"), F.lit(None).cast("string").alias("prefix"), n.alias("total"), n.alias("count"))
    return reports.pagination(p, 2000).drop("prefix").withColumnRenamed("day", "conv_id")


# ---------------------------------------------------------------- names

_PATH = "regexp_replace(regexp_replace(url, '[?#].*$', ''), '^[A-Za-z][A-Za-z0-9+.-]*://[^/]*', '')"
_BASE = f"regexp_extract({_PATH}, '([^/]*)$', 1)"
_HASH = "substr(sha256(url), 1, 8)"


@query(f"SELECT page_id, CASE WHEN {_BASE} = '' THEN 'resource_' || {_HASH} ELSE {_BASE} END AS name FROM pages")
def url_names(spark, sf_dir):
    return read(spark, sf_dir, "pages").select("page_id", names.resource_name("url").alias("name"))


@query(f"SELECT page_id, regexp_replace(regexp_replace({_PATH}, '^/', ''), '[^\\p{{L}}\\p{{N}}_.-]', '_', 'g') AS name FROM pages")
def safe_names(spark, sf_dir):
    return read(spark, sf_dir, "pages").select("page_id", names.safe_name("url").alias("name"))


@query(f"SELECT page_id, 'raw/b-' || page_id || '/' || CASE WHEN {_BASE} = '' THEN {_HASH} ELSE {_BASE} END AS key FROM pages")
def object_keys(spark, sf_dir):
    bid = F.concat(F.lit("b-"), F.col("page_id").cast("string"))
    return read(spark, sf_dir, "pages").select("page_id", names.object_key(F.lit("raw"), bid, "url").alias("key"))


@query(f"SELECT page_id, regexp_replace({_PATH} || '.tar.gz', '(\\.tar\\.gz|\\.tgz|\\.gz|\\.tar)$', '') AS path FROM pages")
def strip_suffix(spark, sf_dir):
    return read(spark, sf_dir, "pages").select("page_id", names.strip_suffix(F.concat(names.url_path("url"), F.lit(".tar.gz"))).alias("path"))


@query("""WITH l AS (SELECT page_id, regexp_extract_all(html, '<a\\s[^>]*href="([^"]*)"', 1)[1:2] AS links FROM pages)
SELECT page_id, CAST(unnest(range(0, len(links))) AS INTEGER) AS position, unnest(links) AS link FROM l""")
def related_links(spark, sf_dir):
    return files.related_links(read(spark, sf_dir, "pages"))


_BID = "'bid:v1:' || replace(lower(o_orderpriority), ' ', '-') || ':' || strftime(o_orderdate, '%Y%m%d%H%M%S') || ':' || substr(sha256(CAST(o_orderkey AS VARCHAR)), 1, 8)"


def _bids(spark, sf_dir):
    return read(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority", names.mint_bid("o_orderpriority", "o_orderdate", "o_orderkey").alias("bid"))


@query(f"""SELECT o_orderkey, {_BID} AS bid, replace(lower(o_orderpriority), ' ', '-') AS registry, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS at,
substr(sha256(CAST(o_orderkey AS VARCHAR)), 1, 8) AS rnd FROM orders""")
def bid_roundtrip(spark, sf_dir):
    p = names.bid_parts("bid")
    return _bids(spark, sf_dir).select("o_orderkey", "bid", p["registry"].alias("registry"), F.date_format(p["bid_ts"], "yyyy-MM-dd HH:mm:ss").alias("at"), p["rnd"].alias("rnd"))


@query("""SELECT o_orderkey, 'raw/' || replace(lower(o_orderpriority), ' ', '-') || strftime(o_orderdate, '/data/year=%Y/month=%m/day=%d/%H-%M-%S-') || substr(sha256(CAST(o_orderkey AS VARCHAR)), 1, 8) AS path FROM orders""")
def bid_partition(spark, sf_dir):
    return _bids(spark, sf_dir).select("o_orderkey", names.bid_path("bid").alias("path"))


@query(f"""SELECT replace(lower(o_orderpriority), ' ', '-') AS registry, arg_max({_BID}, (o_orderdate, {_BID})) AS bid FROM orders GROUP BY 1""")
def latest_bundle(spark, sf_dir):
    p = names.bid_parts("bid")
    h = _bids(spark, sf_dir).select("bid", p["registry"].alias("registry"), p["bid_ts"].alias("bid_ts"), F.sha2("bid", 256).alias("bundle_hash"))
    return bundles.latest(h).select("registry", "bid")


@query(f"""SELECT o_orderkey, CASE WHEN o_orderstatus = 'O' THEN 'missing bid' WHEN o_orderstatus = 'P' THEN 'malformed bid' WHEN o_totalprice > 300000 THEN 'missing request_meta' END AS reason
FROM orders""")
def ref_validation(spark, sf_dir):
    """Open orders lose their bundle id, pending ones get a broken one, dear ones lose their meta."""
    status = F.col("o_orderstatus")
    o = _bids(spark, sf_dir).join(read(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice"), "o_orderkey")
    bid = F.when(status == "O", None).when(status == "P", F.replace("bid", F.lit("v1"), F.lit("v0"))).otherwise(F.col("bid"))
    meta = F.when(F.col("o_totalprice") <= 300_000, F.create_map(F.lit("url"), F.lit("x")))
    refs = o.select("o_orderkey", bid.alias("bid"), F.lit(None).cast("map<string,string>").alias("request_meta"), meta.alias("meta"))
    return filters.validated_refs(refs).select("o_orderkey", "reason")

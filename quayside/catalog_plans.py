"""Registered queries on request plans, names, state and queues, with the SQL that gives the same rows."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from .catalog import query, read
from .functions import names
from .operators import bundles, filters, reports, state
from .plans import requests
from .sources import files
from .streaming import streams

# ---------------------------------------------------------------- queues and state


@query("""SELECT l_returnflag AS ns, l_orderkey, l_linenumber, l_extendedprice, note,
row_number() OVER (PARTITION BY l_returnflag ORDER BY l_shipdate, l_orderkey, l_linenumber, note, l_extendedprice) AS seq
FROM (SELECT *, l_linestatus || '-' || l_partkey || '-' || l_suppkey AS note FROM lineitem)""")
def fifo_numbers_lines(spark, sf_dir):
    """Queue numbers of whole line items, with what they carry."""
    note = F.concat_ws("-", "l_linestatus", F.col("l_partkey").cast("string"), F.col("l_suppkey").cast("string"))
    rows = read(spark, sf_dir, "lineitem").select(F.col("l_returnflag").alias("ns"), "l_shipdate", "l_orderkey", "l_linenumber", "l_extendedprice", note.alias("note"))
    return state.enqueue(rows, ["l_shipdate", "l_orderkey", "l_linenumber", "note", "l_extendedprice"]).drop("l_shipdate")


@query("""SELECT event_id, to_json(event_type) AS a, to_json(user_id) AS b, to_json(value > 50) AS c, to_json({'id': event_id, 'kind': event_type}) AS d FROM events""")
def state_json(spark, sf_dir):
    """State values as JSON; those that are decoded again are encoded from what was decoded."""
    e = read(spark, sf_dir, "events")
    kind = names.decode_value(names.encode_value("event_type"), "string")
    both = names.decode_value(names.encode_value(F.struct(F.col("event_id").alias("id"), F.col("event_type").alias("kind"))), "struct<id:long,kind:string>")
    return e.select(
        "event_id", names.encode_value(kind).alias("a"), names.encode_value("user_id").alias("b"), names.encode_value(F.col("value") > 50).alias("c"), names.encode_value(both).alias("d")
    )


@query("""WITH d AS (SELECT user_id, count(*) AS n, arg_max(floor(value), (ts, event_id)) AS last FROM events WHERE event_type = 'error' AND ts < TIMESTAMP '2024-01-03' GROUP BY 1),
e AS (SELECT user_id, count(*) AS n, max(floor(value)) AS last FROM events WHERE event_type = 'error' AND ts >= TIMESTAMP '2024-01-03' AND ts < TIMESTAMP '2024-01-03 12:00:00' GROUP BY 1)
SELECT CAST(coalesce(e.user_id, d.user_id) AS VARCHAR) AS item_id, CAST(CAST(coalesce(e.last, d.last) AS BIGINT) AS VARCHAR) AS error,
CAST(CASE WHEN d.user_id IS NULL THEN 0 WHEN e.user_id IS NULL THEN 0 ELSE 1 END AS BIGINT) AS retry_count
FROM d FULL JOIN e USING (user_id) WHERE coalesce(e.user_id, d.user_id) % 7 <> 0""")
def saved_errors(spark, sf_dir):
    """Errors saved twice, a day apart, those of some items cleared; what may be tried again then."""
    e = read(spark, sf_dir, "events").filter("event_type = 'error'")
    last = F.max_by(F.floor("value").cast("string"), F.struct("ts", "event_id")).alias("error")
    first = e.filter("ts < '2024-01-03'").groupBy(F.col("user_id").cast("string").alias("item_id")).agg(last)
    again = e.filter("ts >= '2024-01-03' and ts < '2024-01-03 12:00:00'").groupBy(F.col("user_id").cast("string").alias("item_id")).agg(F.max(F.floor("value")).cast("string").alias("error"))
    t = [F.lit(f"2024-01-03 {h}:00:00") for h in ("00", "12", "18")]
    log = state.error_puts(first, spark.createDataFrame([], "k string, v string"), t[0]).withColumn("seq", F.lit(1))
    view = state.current(log, t[1].cast("timestamp"))
    log = log.unionByName(state.error_puts(again, view, t[1]).withColumn("seq", F.lit(2)))
    view = state.current(log, t[2].cast("timestamp"))
    gone, _ = state.delete(view, view.filter(F.substring_index("k", ":", -1).cast("long") % 7 == 0).select("k"), t[2].cast("timestamp"))
    log = log.unionByName(gone.withColumn("seq", F.lit(3)), allowMissingColumns=True)
    return state.failed_items(state.current(log, t[2].cast("timestamp")))


@query("""SELECT 'app:session:' || user_id AS k, CAST(event_id AS VARCHAR) AS v FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS n FROM events
WHERE event_type = 'view' AND ts <= TIMESTAMP '2024-01-20') WHERE n = 1 AND date_trunc('second', ts) + INTERVAL 1 DAY >= TIMESTAMP '2024-01-20'""")
def live_sessions(spark, sf_dir):
    """Session records live for a day after they were last put."""
    e = read(spark, sf_dir, "events").filter("event_type = 'view'")
    rows = e.select(F.col("user_id").cast("string").alias("k"), F.col("event_id").cast("string").alias("v"), "ts", F.col("event_id").alias("seq"))
    log = rows.select(F.explode(F.array(F.struct("k", "v", "ts", "seq"))).alias("r")).select("r.*")
    keyed = log.select(names.prefixed_key("k", F.lit("app:session")).alias("k"), "v", F.col("ts").cast("timestamp").alias("put_at"), names.expires_at(F.col("ts").cast("timestamp"), F.lit(86400)).alias("expires_at"), "seq")
    return state.current(keyed, F.lit("2024-01-20").cast("timestamp")).select("k", "v")


@query("""SELECT count(*) AS keys, count(CASE WHEN c >= 10 THEN 1 END) AS kept FROM (SELECT user_id, count(*) AS c FROM events GROUP BY 1)""")
def state_delete(spark, sf_dir):
    """Keys of users with few events are deleted from the state."""
    n = read(spark, sf_dir, "events").groupBy(F.col("user_id").cast("string").alias("k")).agg(F.count("*").alias("v"))
    at = F.lit("2024-02-01").cast("timestamp")
    log = state.puts(n, "state", at, default_ttl=False).withColumn("seq", F.lit(1))
    few = log.filter(F.col("v").cast("long") < 10).select("k")
    gone, report = state.delete(log, few, at)
    left = state.current(log.unionByName(gone.withColumn("seq", F.lit(2)), allowMissingColumns=True), at)
    total = log.agg(F.count("*").alias("keys"))
    return total.join(left.agg(F.count("*").alias("kept")))


@query("""SELECT user_id, strftime(to_timestamp(floor(epoch(max(ts)))::BIGINT + 3600)::TIMESTAMP, '%Y-%m-%d %H:%M:%S') AS due FROM events GROUP BY 1""")
def interval_due(spark, sf_dir):
    last = read(spark, sf_dir, "events").groupBy("user_id").agg(F.date_trunc("second", F.max("ts")).alias("t"))
    return last.select("user_id", F.date_format(streams.interval_due(F.col("t"), 3600), "yyyy-MM-dd HH:mm:ss").alias("due"))


@query("""SELECT event_type AS kind, count(*) AS n FROM events WHERE event_type IN ('error', 'view') GROUP BY 1""")
def status_split(spark, sf_dir):
    """Responses told by a status, those accepted and those not, counted."""
    e = read(spark, sf_dir, "events").filter("event_type in ('error', 'view')").withColumn("status", F.when(F.col("event_type") == "view", 200).when(F.col("value") > 50, 500))
    good, bad = filters.by_status(e, F.col("status") == 200)
    return good.groupBy(F.lit("view").alias("kind")).agg(F.count("*").alias("n")).union(bad.groupBy(F.lit("error").alias("kind")).agg(F.count("*").alias("n")))


@query("""SELECT event_id, CAST(user_id AS VARCHAR) AS item_id, CASE WHEN value < 50 THEN 'network' ELSE 'other' END AS error_class, CAST(0 AS INTEGER) AS retry_count FROM events WHERE event_type = 'error'""")
def error_log(spark, sf_dir):
    e = read(spark, sf_dir, "events")
    text = F.when(F.col("event_type") == "error", F.when(F.col("value") < 50, "read timeout").otherwise("odd"))
    log = e.select(F.concat_ws(":", "user_id", "event_id").alias("item_id"), text.alias("error"), "ts")
    out = reports.error_rows(log)
    return out.select(F.substring_index("item_id", ":", -1).cast("long").alias("event_id"), F.substring_index("item_id", ":", 1).alias("item_id"), "error_class", "retry_count")


@query("""SELECT source AS bid, count(*) AS bundle_count, true AS success, min(doc_id) || '' AS first_ref FROM documents GROUP BY 1 UNION ALL SELECT 'none', 0, false, NULL""")
def processing_results(spark, sf_dir):
    """Sources as bundles of documents, and one path whose bundle has nothing."""
    docs = read(spark, sf_dir, "documents").select(F.col("source").alias("bid"), F.lpad(F.col("doc_id").cast("string"), 12, "0").alias("name"))
    done = docs.select("bid").distinct().union(spark.createDataFrame([("none",)], "bid string")).select(F.concat(F.lit("/in/"), "bid").alias("path"), F.lit(0).alias("ts"), "bid")
    out = reports.result_rows(done, docs)
    return out.select("bid", "bundle_count", "success", F.try_element_at("bundle_refs", F.lit(1)).cast("long").cast("string").alias("first_ref"))


@query("""SELECT page_id FROM pages p WHERE url NOT IN (SELECT url FROM pages WHERE page_id % 3 = 0)""")
def unprocessed_urls(spark, sf_dir):
    """URLs of which none was fetched (those of every third page were)."""
    pages = read(spark, sf_dir, "pages").select("page_id", F.lit("2024-01-01").cast("date").alias("day"), "url")
    return requests.resumed(pages, None, pages.filter("page_id % 3 = 0")).select("page_id")


@query("""SELECT DISTINCT source AS registry FROM documents WHERE source NOT IN (SELECT source FROM documents JOIN labels USING (doc_id) WHERE toxic = 1)""")
def dangling_latest(spark, sf_dir):
    """Latest rows whose bundle hash is not known (of sources without toxic documents)."""
    docs = read(spark, sf_dir, "documents").select("doc_id", F.col("source").alias("registry"), F.sha2("source", 256).alias("bundle_hash"))
    known = docs.join(read(spark, sf_dir, "labels").filter("toxic = 1"), "doc_id")
    return bundles.dangling(docs.select("registry", "bundle_hash").distinct(), known).select("registry")


@query("""SELECT c.conv_id || '' AS bid, c.turn || '' AS name, '0' AS original, 'u' || c.conv_id AS original_url FROM conversations c
JOIN (SELECT DISTINCT conv_id FROM conversations WHERE turn = 0) o USING (conv_id) WHERE c.turn > 0""")
def turn_lineage(spark, sf_dir):
    """Later turns as resources derived from their conversation's first."""
    c = read(spark, sf_dir, "conversations").distinct()
    t = F.col("turn").cast("string")
    res = c.select(F.col("conv_id").cast("string").alias("bid"), t.alias("name"), F.concat(F.lit("u"), F.col("conv_id").cast("string")).alias("url"), F.when(F.col("turn") > 0, "0").alias("derived_from"))
    return bundles.with_lineage(res)


@query("""SELECT o_orderkey FROM orders WHERE o_custkey IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P') AND o_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F')""")
def failed_replay(spark, sf_dir):
    o = read(spark, sf_dir, "orders").withColumn("item_id", F.col("o_custkey"))
    return requests.failed_replay(o, o.filter("o_orderstatus = 'P'"), o.filter("o_orderstatus = 'F'")).select("o_orderkey")


@query("""SELECT count(DISTINCT source) AS bundles, count(DISTINCT sha256(source)) AS hashes, count(DISTINCT source) = 20 AS as_expected FROM documents""")
def expected_count(spark, sf_dir):
    d = read(spark, sf_dir, "documents").select(F.col("source").alias("bid"), F.sha2("source", 256).alias("bundle_hash"))
    return bundles.count_check(d, d, 20)


@query("SELECT page_id, url FROM pages ORDER BY url DESC NULLS FIRST, page_id LIMIT 200")
def sort_paths(spark, sf_dir):
    p = read(spark, sf_dir, "pages").select("page_id", F.col("url").alias("path"))
    return p.orderBy(*state.sort_by_path(reverse=True), "page_id").limit(200).select("page_id", F.col("path").alias("url"))


# ---------------------------------------------------------------- names


@query("""SELECT page_id, '/' || coalesce(page_id || '/x', '') || '/' || 'f' || page_id || '.txt' AS path FROM pages""")
def joined_paths(spark, sf_dir):
    key = F.col("page_id").cast("string")
    url = F.concat(F.lit("sftp:///"), key, F.lit("/x//"))
    return read(spark, sf_dir, "pages").select("page_id", names.join_path(names.strip_scheme(url), F.concat(F.lit("f"), key, F.lit(".txt"))).alias("path"))


@query("""SELECT p_partkey, '0o' || CASE WHEN m >= 32768 THEN '10' ELSE '4' END || CASE WHEN m >= 32768 THEN '0' ELSE '0' END || (m % 512) // 64 || (m % 64) // 8 || m % 8 AS mode
FROM (SELECT p_partkey, (CASE WHEN p_partkey % 2 = 0 THEN 32768 ELSE 16384 END) + p_partkey % 512 AS m FROM part)""")
def file_modes(spark, sf_dir):
    """Modes of files and directories, written in base 8."""
    m = F.when(F.col("p_partkey") % 2 == 0, 32768).otherwise(16384) + F.col("p_partkey") % 512
    return read(spark, sf_dir, "part").select("p_partkey", names.permissions(m).alias("mode"))


@query("""SELECT page_id, url, CAST(CASE WHEN page_id % 2 = 0 THEN page_id ELSE 0 END AS INTEGER) AS depth, CAST(0 AS INTEGER) AS headers FROM pages""")
def request_defaults(spark, sf_dir):
    p = read(spark, sf_dir, "pages")
    packed = F.to_json(F.struct("url", F.when(F.col("page_id") % 2 == 0, F.col("page_id")).alias("depth")))
    m = names.request_meta(packed)
    return p.select("page_id", m["url"].alias("url"), m["depth"].alias("depth"), F.size(m["headers"]).alias("headers"))


@query("""SELECT o_orderkey, 'fetcher_' || lower(o_orderstatus) || '_' || strftime(o_orderdate, '%Y%m%d%H%M%S') AS run FROM orders""")
def run_ids(spark, sf_dir):
    return read(spark, sf_dir, "orders").select("o_orderkey", names.run_id(F.lower("o_orderstatus"), "o_orderdate").alias("run"))


# ---------------------------------------------------------------- plans and pages

_DAYS = "SELECT min(CAST(ts AS DATE)) AS lo, max(CAST(ts AS DATE)) AS hi FROM events"


@query(f"""WITH s AS ({_DAYS}), d AS (SELECT unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS t FROM s)
SELECT strftime(t, '%Y-%m-%d') AS day FROM d WHERE isodow(t) < 6 AND substr(strftime(t, '%Y-%m-%d'), 9) <> '10'""")
def filtered_days(spark, sf_dir):
    """A plan's days but weekends (a Column) and every 10th (a function of the day)."""
    lo, hi = read(spark, sf_dir, "events").agg(F.min(F.to_date("ts")), F.max(F.to_date("ts"))).first()
    plan = requests.kept_days(requests.day_plan(spark, lo, hi), F.dayofweek("day").between(2, 6))
    return requests.kept_days(plan, lambda d: d[8:] != "10").select(F.date_format("day", "yyyy-MM-dd").alias("day"))


@query(f"""WITH t AS (SELECT CAST(ts AS DATE) AS day, count(*) AS n FROM events GROUP BY 1), m AS (SELECT avg(n) AS a FROM t), s AS ({_DAYS}),
d AS (SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS day FROM s),
p AS (SELECT d.day, NULL AS prefix FROM d LEFT JOIN t USING (day), m WHERE coalesce(n, 0) <= floor(a) UNION ALL
  SELECT d.day, lpad(CAST(r AS VARCHAR), 2, '0') FROM d JOIN t USING (day), m, range(0, 100) x(r) WHERE n > floor(a))
SELECT strftime(day, '%Y-%m-%d') AS day, prefix, 'http://x/q?nombre=500&curseur=' || CASE WHEN day = DATE '2024-01-15' AND prefix IS NOT DISTINCT FROM (SELECT CASE WHEN n > floor(a) THEN '40' END FROM t, m WHERE day = DATE '2024-01-15') THEN 'c7' ELSE '*' END
  || '&q=' || strftime(day, '%d') || coalesce(prefix, '') AS url
FROM p WHERE day < DATE '2024-01-15' OR (day = DATE '2024-01-15' AND (prefix IS NULL OR prefix >= '40'))""")
def complex_plan(spark, sf_dir):
    """Days backwards, narrowed where they have more events than the mean day, from a saved position."""
    e = read(spark, sf_dir, "events").select(F.to_date("ts").alias("day"))
    totals = e.groupBy("day").agg(F.count("*").alias("total"))
    most, lo, hi = totals.agg(F.floor(F.avg("total")), F.min("day"), F.max("day")).first()
    here = totals.filter("day = '2024-01-15'").first()
    prefix = "40" if here and here["total"] > most else None
    search = lambda plan: F.concat(F.date_format("day", "dd"), F.coalesce("prefix", F.lit("")))
    plan = requests.complex_plan(spark, lo, hi, totals, "http://x/q", reverse=True, max_records=most, page_size=500, query=search, position=(dt.date(2024, 1, 15), prefix, "c7"))
    return plan.select(F.date_format("day", "yyyy-MM-dd").alias("day"), "prefix", "url")


@query("""SELECT conv_id AS source, CAST(turn + 1 AS VARCHAR) AS cursor FROM (SELECT conv_id, turn, max(length(text)) AS n, max(CASE WHEN role = 'user' THEN 1 ELSE 0 END) AS u FROM conversations GROUP BY 1, 2)
WHERE turn = 0 AND u = 1 AND n BETWEEN 1 AND 400""")
def next_page_requests(spark, sf_dir):
    """First turns as landed pages; one that is short and a user's has a next page."""
    c = read(spark, sf_dir, "conversations").groupBy("conv_id", "turn").agg(F.max(F.length("text")).alias("total"), F.max(F.when(F.col("role") == "user", 1).otherwise(0)).alias("u"))
    first = c.filter("turn = 0").select(F.col("conv_id").alias("day"), F.lit(None).cast("string").alias("prefix"), "total", F.col("total").alias("count"),
                                        F.when(F.col("u") == 1, (F.col("turn") + 1).cast("string")).alias("next_cursor"))
    asked = first.select("day", "prefix", F.lit("*").alias("cursor"))
    return requests.next_requests(asked, first, 400).select(F.col("day").alias("source"), "cursor")


@query("""SELECT conv_id AS day, count(*) AS total, 'c' || conv_id AS next_cursor FROM conversations GROUP BY 1""")
def page_headers(spark, sf_dir):
    """Pages whose counts and cursor stand in the header (even ids) or beside it."""
    n = read(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.count("*").alias("n"))
    cursor = F.concat(F.lit("c"), F.col("conv_id").cast("string")).alias("curseurSuivant")
    inside = F.to_json(F.struct(F.struct(F.col("n").alias("total"), F.col("n").alias("nombre"), cursor).alias("header")))
    beside = F.to_json(F.struct(F.col("n").alias("total"), F.col("n").alias("nombre"), cursor))
    pages = n.select(F.col("conv_id").alias("day"), F.when(F.col("conv_id") % 2 == 0, inside).otherwise(beside).alias("body"))
    return requests.parsed_pages(pages).select("day", "total", "next_cursor")


@query("""SELECT c.c_nationkey AS day, lpad(c.c_custkey || '', 9, '0') AS siren, c.c_name AS name, lpad(o.o_orderkey || '', 14, '0') AS siret FROM customer c LEFT JOIN orders o ON o.o_custkey = c.c_custkey""")
def registry_entities(spark, sf_dir):
    """Customers as entities and orders as their establishments, packed in pages and read again."""
    o = read(spark, sf_dir, "orders").select(F.col("o_custkey").alias("k"), F.struct(F.lpad(F.col("o_orderkey").cast("string"), 14, "0").alias("siret")).alias("s"))
    c = read(spark, sf_dir, "customer").join(o, F.col("c_custkey") == F.col("k"), "left").groupBy("c_custkey", "c_name", "c_nationkey").agg(F.collect_list("s").alias("etablissements"))
    unit = F.struct(F.lpad(F.col("c_custkey").cast("string"), 9, "0").alias("siren"), F.col("c_name").alias("denominationUniteLegale"), "etablissements")
    pages = c.select(F.col("c_nationkey").alias("day"), F.to_json(F.struct(F.array(unit).alias("unitesLegales"))).alias("body"))
    return requests.entities(pages).select("day", "siren", "name", "siret")


@query("""SELECT path, min(i) AS locator_index FROM (SELECT 'f' || doc_id AS path, 0 AS i FROM labels UNION ALL SELECT 'f' || doc_id, 1 FROM documents) GROUP BY 1""")
def chained_sources(spark, sf_dir):
    name = F.concat(F.lit("f"), F.col("doc_id").cast("string")).alias("path")
    both = files.chained(read(spark, sf_dir, "labels").select(name), read(spark, sf_dir, "documents").select(name, "source"))
    return both.groupBy("path").agg(F.min("locator_index").alias("locator_index"))

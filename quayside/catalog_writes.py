"""Registered queries that write and read again: raw layout, flat and object layouts, completion feed,
archives, streams."""

from __future__ import annotations

import gzip
import io
import tarfile
import uuid
import zipfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .catalog import query, read
from .functions import names
from .operators import archives, bundles
from .shared import shared_dir
from .streaming import streams


def _place(spark, name: str) -> str:
    return f"{shared_dir(spark)}/quayside-{name}-{uuid.uuid4().hex[:12]}"


def _resources(spark, sf_dir) -> DataFrame:
    """Pages as resources of bundles, 50 pages to a bundle."""
    p = read(spark, sf_dir, "pages")
    n = F.floor(F.col("page_id") / 50)
    bid = names.mint_bid(F.lit("web"), F.timestamp_seconds(F.lit(1_700_000_000) + n * 3600), n)
    key = F.col("page_id").cast("string")
    return p.select(
        bid.alias("bid"), F.concat(F.lpad(key, 9, "0"), F.lit(".html")).alias("name"), "url", F.lit("text/html").alias("content_type"), F.lit(200).alias("status_code"),
        F.lit(None).cast("string").alias("derived_from"), F.encode("html", "UTF-8").alias("content"),
    )


_BID = "'bid:v1:web:' || strftime(make_timestamp((1700000000 + (page_id // 50) * 3600) * 1000000), '%Y%m%d%H%M%S') || ':' || substr(sha256((page_id // 50) || ''), 1, 8)"
_PAGES = f"(SELECT *, {_BID} AS bid, lpad(page_id || '', 9, '0') || '.html' AS name, sha256(html) AS h, octet_length(encode(html)) AS n FROM pages)"


@query(f"""SELECT bid, count(*) AS resources_count, CAST(sum(n) AS BIGINT) AS total_bytes, sha256(string_agg(h, '' ORDER BY name, h)) AS bundle_hash, arg_min(url, name) AS primary_url,
'raw/web/data/year=' || substr(bid, 12, 4) || '/month=' || substr(bid, 16, 2) || '/day=' || substr(bid, 18, 2) || '/' || substr(bid, 20, 2) || '-' || substr(bid, 22, 2) || '-' || substr(bid, 24, 2) || '-' || right(bid, 8) AS bundle_path
FROM {_PAGES} GROUP BY bid""")
def raw_layout(spark, sf_dir):
    """All five parts of the raw layout, written twice under one name, and read again."""
    path = _place(spark, "raw")
    for _ in range(2):
        bundles.write_raw(_resources(spark, sf_dir), path, "pages", "run")
    content = bundles.read_raw(spark, path, "content").groupBy("bid", "bundle_path").agg(F.sum(F.octet_length("content").cast("long")).alias("total_bytes"))
    done = bundles.read_raw(spark, path, "completed").select("bid", "bundle_hash", "resources_count")
    found = bundles.read_raw(spark, path, "discovered").select("bid", "primary_url")
    listed = bundles.read_raw(spark, path, "manifest").groupBy("bid").count().withColumnRenamed("count", "resources_count")
    meta = bundles.read_raw(spark, path, "metadata").groupBy("bid").count().withColumnRenamed("count", "resources_count")
    return content.join(done, "bid").join(found, "bid").join(listed, ["bid", "resources_count"], "left_semi").join(meta, ["bid", "resources_count"], "left_semi")


_PATH = "regexp_replace(regexp_replace(url, '[?#].*$', ''), '^[A-Za-z][A-Za-z0-9+.-]*://[^/]*', '')"
_BASE = f"regexp_extract({_PATH}, '([^/]*)$', 1)"


@query(f"""SELECT 'bundle_' || bid || '/' || regexp_replace(regexp_replace({_PATH}, '^/', ''), '[^\\p{{L}}\\p{{N}}_.-]', '_', 'g') AS target, h AS sha256 FROM {_PAGES}""")
def flat_layout(spark, sf_dir):
    path = _place(spark, "flat")
    bundles.write_flat(_resources(spark, sf_dir), path)
    meta = spark.read.json(f"{path}/meta").select(F.regexp_replace("name", "[.]meta$", "").alias("name"), "bid", "sha256")
    content = spark.read.parquet(f"{path}/content").select("bid", "name", "target")
    return content.join(meta, ["bid", "name"]).select("target", "sha256")


@query(f"""SELECT bid, 'lake/bundles/' || bid || '/metadata.json' AS metadata_key, count(*) AS objects, min('lake/' || bid || '/' || CASE WHEN {_BASE} = '' THEN substr(sha256(url), 1, 8) ELSE {_BASE} END) AS first_key
FROM {_PAGES} GROUP BY bid""")
def object_layout(spark, sf_dir):
    path = _place(spark, "objects")
    bundles.write_objects(_resources(spark, sf_dir), path, "lake")
    meta = spark.read.json(f"{path}/bundles")
    return meta.select("bid", "metadata_key", F.size("uploaded_keys").cast("long").alias("objects"), F.element_at("uploaded_keys", 1).alias("first_key"))


@query("SELECT DISTINCT source AS bid, CAST(CASE WHEN source IN (SELECT source FROM documents WHERE doc_id % 2 = 0) THEN 0 ELSE 1 END AS BIGINT) AS batch_id FROM documents")
def completion_feed(spark, sf_dir):
    """Sources complete in three batches, the second a repetition of the first: each once."""
    path = _place(spark, "completed")
    done = bundles.complete_once(path)
    d = read(spark, sf_dir, "documents").select("doc_id", F.col("source").alias("bid"))
    for batch, part in ((0, "doc_id % 2 = 0"), (0, "doc_id % 2 = 0"), (1, "doc_id >= 0")):
        done(d.filter(part).select("bid").distinct(), batch)
    return spark.read.schema("bid string, batch_id long").parquet(path)


# ---------------------------------------------------------------- archives


def _packed(spark, sf_dir, kind: str) -> DataFrame:
    """Each source's conversations' turns in archives: one archive a turn, its text in two members."""

    def archive(name: str, body: bytes) -> bytes:
        f = io.BytesIO()
        if kind == "zip":
            with zipfile.ZipFile(f, "w") as z:
                z.writestr("d/a.txt", body)
                z.writestr("b.txt", name)
        else:
            with tarfile.open(fileobj=f, mode="w") as t:
                for member, data in (("d/a.txt", body), ("b.txt", name.encode())):
                    info = tarfile.TarInfo(member)
                    info.size = len(data)
                    t.addfile(info, io.BytesIO(data))
        data = f.getvalue() if kind != "tar.gz" else gzip.compress(f.getvalue(), 1, mtime=0)
        return data[: len(data) // 2] if name.endswith("7") and kind == "tar.gz" else data

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return archives.packed((name.as_py(), archive(name.as_py(), body.as_py())) for b in batches for name, body in zip(b.column("name"), b.column("body"), strict=True))

    archives.bounded(spark)
    c = read(spark, sf_dir, "conversations").select(
        F.concat_ws("-", F.col("conv_id").cast("string"), F.col("turn").cast("string")).alias("name"), F.encode(F.coalesce("text", F.lit("")), "UTF-8").alias("body")
    )
    made = c.mapInArrow(run, "name string, content binary")
    return made.select(
        F.lit("b").alias("bid"), F.concat("name", F.lit("." + kind)).alias("name"), F.concat(F.lit("http://x/"), "name", F.lit("." + kind)).alias("url"), F.lit(None).cast("string").alias("content_type"),
        F.lit(200).alias("status_code"), F.lit(None).cast("string").alias("derived_from"), "content",
    )


_TURNS = "(SELECT conv_id || '-' || turn AS name, octet_length(encode(coalesce(text, ''))) AS n, coalesce(text, '') AS text FROM conversations)"


@query(f"SELECT name || '/d/a.txt' AS name, name || '.tar' AS derived_from, sha256(text) AS sha256 FROM {_TURNS} UNION ALL SELECT name || '/b.txt', name || '.tar', sha256(name) FROM {_TURNS}")
def archive_untar(spark, sf_dir):
    out = archives.expand(_packed(spark, sf_dir, "tar")).filter("derived_from is not null")
    return out.select("name", "derived_from", F.sha2("content", 256).alias("sha256"))


@query(f"""SELECT CASE WHEN name LIKE '%7' THEN 'broken' ELSE 'whole' END AS state, CAST(count(*) AS BIGINT) AS archives, CAST(sum(CASE WHEN name LIKE '%7' THEN 0 ELSE 2 END) AS BIGINT) AS members FROM {_TURNS} GROUP BY 1""")
def archive_tar_gz(spark, sf_dir):
    """Every archive whose turn ends in 7 is cut off: it keeps its row, with an error, and gives none."""
    out = archives.expand(_packed(spark, sf_dir, "tar.gz"))
    state = F.when(F.substring_index(F.coalesce("derived_from", "name"), ".", 1).endswith("7"), "broken").otherwise("whole")
    one = F.col("derived_from").isNull() & (F.col("error").isNotNull() == (state == "broken"))
    return out.groupBy(state.alias("state")).agg(F.count_if(one).alias("archives"), F.count("derived_from").alias("members"))


@query(f"SELECT name || '.zip' AS derived_from, name || '/d/a.txt' AS name, CAST(n AS BIGINT) AS size FROM {_TURNS} UNION ALL SELECT name || '.zip', name || '/b.txt', CAST(octet_length(encode(name)) AS BIGINT) FROM {_TURNS}")
def archive_listing(spark, sf_dir):
    return archives.listing(_packed(spark, sf_dir, "zip")).select("derived_from", "name", "size")


@query(f"SELECT count(*) AS rows, 0 AS derived FROM {_TURNS}")
def archive_bypass(spark, sf_dir):
    """Zip files that are to stay packed."""
    out = archives.expand(_packed(spark, sf_dir, "zip"), keep_packed=True)
    return out.agg(F.count("*").alias("rows"), F.count("derived_from").cast("int").alias("derived"))


# ---------------------------------------------------------------- streams, run once over a whole table


def _stream(spark, sf_dir, name: str) -> DataFrame:
    schema = read(spark, sf_dir, name).schema
    return spark.readStream.schema(schema).option("pathGlobFilter", "*.parquet").parquet(f"{sf_dir}/{name}.parquet*")


def _settled(stream: DataFrame, mode: str = "append") -> DataFrame:
    """What a stream gives over all that is there now, written by batch and read again."""
    spark, path = stream.sparkSession, _place(stream.sparkSession, "stream")
    how = "overwrite" if mode == "complete" else "append"
    stream.sparkSession.createDataFrame([], stream.schema).write.parquet(f"{path}/out")
    writer = stream.writeStream.outputMode(mode).option("checkpointLocation", f"{path}/checkpoint").trigger(availableNow=True)
    writer.foreachBatch(lambda df, _: df.write.mode(how).parquet(f"{path}/out")).start().awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{path}/out")


@query("SELECT event_type AS name, CAST(sum(coalesce(CASE WHEN value > 50 THEN 2 END, 1)) AS BIGINT) AS value FROM events GROUP BY 1")
def stream_counters(spark, sf_dir):
    e = _stream(spark, sf_dir, "events").select(F.col("event_type").alias("name"), F.when(F.col("value") > 50, 2).alias("amount"))
    return _settled(streams.running_counters(e), "complete")


@query("SELECT event_type AS operation, count(value) AS n, round(avg(value), 6) AS avg_s, min(value) AS min_s, max(value) AS max_s FROM events GROUP BY 1")
def stream_timings(spark, sf_dir):
    e = _stream(spark, sf_dir, "events").select(F.col("event_type").alias("operation"), F.col("value").alias("seconds"))
    return _settled(streams.running_timings(e), "complete").withColumn("avg_s", F.round("avg_s", 6))


@query("SELECT event_type AS source, strftime(date_trunc('day', ts), '%Y-%m-%d') AS day, count(*) AS n FROM events GROUP BY 1, 2")
def stream_rates(spark, sf_dir):
    e = _stream(spark, sf_dir, "events").select(F.col("event_type").alias("source"), F.col("ts").cast("timestamp").alias("ts"))
    out = _settled(streams.request_rates(e, "1 day", "400 days"), "complete")
    return out.select("source", F.date_format("window.start", "yyyy-MM-dd").alias("day"), F.col("count").alias("n"))


@query("SELECT user_id, count(*) > 0 AS seen FROM events GROUP BY 1")
def stream_dedup(spark, sf_dir):
    """One row of each user, within a time to live longer than the table's span."""
    e = _stream(spark, sf_dir, "events").select("user_id", F.col("ts").cast("timestamp").alias("ts"))
    return _settled(streams.dedup_within(e, ["user_id"], "ts", "400 days")).select("user_id", F.lit(True).alias("seen"))


@query("SELECT 'kept' AS part, count(*) AS n FROM events WHERE event_type <> 'error' UNION ALL SELECT 'failed', count(*) FROM events WHERE event_type = 'error'")
def stream_fan_out(spark, sf_dir):
    """One reading, two consumers."""
    path = _place(spark, "fan")

    def keep(name: str, what: str):
        return lambda df, _: df.filter(what).select("event_id").write.mode("append").parquet(f"{path}/{name}")

    both = streams.fan_out(keep("kept", "event_type <> 'error'"), keep("failed", "event_type = 'error'"))
    q = _stream(spark, sf_dir, "events").writeStream.option("checkpointLocation", f"{path}/checkpoint").trigger(availableNow=True)
    q.foreachBatch(both).start().awaitTermination()
    n = [spark.read.schema("event_id long").parquet(f"{path}/{name}").agg(F.lit(name).alias("part"), F.count("*").alias("n")) for name in ("kept", "failed")]
    return n[0].union(n[1])


@query("SELECT count(*) AS files, count(DISTINCT name) AS names, CAST(sum(n) AS BIGINT) AS bytes FROM (SELECT o_orderpriority AS name, sum(octet_length(encode(o_orderkey || ''))) + count(*) AS n FROM orders GROUP BY 1)")
def watched_files(spark, sf_dir):
    """A file for each priority of orders lands; the watch finds each, with its length."""
    path = _place(spark, "landed")
    o = read(spark, sf_dir, "orders").select(F.col("o_orderkey").cast("string").alias("value"), "o_orderpriority")
    names_ = [r[0] for r in o.select("o_orderpriority").distinct().collect()]  # five fixed priorities
    o.repartition(len(names_), "o_orderpriority").write.partitionBy("o_orderpriority").text(path)
    seen = streams.watch_files(spark, f"{path}/*/*.txt").select("path", "length")
    out = _settled(seen).withColumn("name", F.url_decode(F.regexp_extract("path", "o_orderpriority=([^/]*)", 1)))
    return out.groupBy("name").agg(F.sum("length").alias("n")).agg(F.count("*").alias("files"), F.countDistinct("name").alias("names"), F.sum("n").alias("bytes"))

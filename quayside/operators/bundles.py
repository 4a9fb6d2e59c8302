"""Bundles: manifests, hashes, change detection, audits, and the writers of the raw layout."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.names import bid_parts, bid_path, object_key, resource_name, safe_name
from ..shared import discard, written
from .commits import Commits
from .ordered import folded_sha256


def manifest(resources: DataFrame) -> DataFrame:
    """(bid, name, sha256, size): hashes are taken before anything is shuffled, so contents never are."""
    return resources.select("bid", "name", F.sha2("content", 256).alias("sha256"), F.octet_length("content").cast("long").alias("size"))


GROUP_BYTES = 1 << 20  # of a bundle's names and hashes that are put in order as one group


def bundle_hashes(manifest_rows: DataFrame, by: str = "bid", at_rest: bool = False) -> DataFrame:
    """Summary and hash of each bundle: the hash of its resources' hashes in the order of names. Bundles of up to ``GROUP_BYTES`` are
    a group each, larger ones are folded piece by piece, however large they are. A resource without content counts,
    and has no part in the hash. The rows are written, unless they are ``at_rest``: made from tables, at little cost each time."""
    rows = manifest_rows.select(by, "name", F.coalesce("sha256", F.lit("")).alias("sha256"), "size")
    if not at_rest:
        rows = written(rows, "hashed")
    bytes_ = F.sum(F.octet_length("sha256") + F.coalesce(F.octet_length("name"), F.lit(0)) + 16)
    large = written(rows.groupBy(F.col(by).alias("_by")).agg(bytes_.alias("_bytes")).filter(F.col("_bytes") > GROUP_BYTES), "large")
    found = F.count("*").alias("resources_count"), F.coalesce(F.sum("size"), F.lit(0)).alias("total_bytes")
    joined = F.concat_ws("", F.transform(F.sort_array(F.collect_list(F.struct("name", "sha256"))), lambda x: x["sha256"]))
    small = rows
    if some := bool(large.take(1)):
        same = F.col(by).eqNullSafe(F.col("_by"))
        small = rows.join(large, same, "left_anti")
    out = small.groupBy(by).agg(*found, F.sha2(joined.cast("binary"), 256).alias("bundle_hash"))
    if not some:
        return out
    folded = folded_sha256(rows.join(large, same, "left_semi"), by, ["name", "sha256"], "sha256", "size", large)
    return out.unionByName(folded.select(by, F.col("n").alias("resources_count"), F.col("total").alias("total_bytes"), F.col("sha256").alias("bundle_hash")))


def load_bundle(resources: DataFrame, bid: str) -> DataFrame:
    """All rows as the resources of one bundle; an empty bundle is an error."""
    if not resources.take(1):
        raise ValueError("no file matches")
    return resources.withColumn("bid", F.lit(bid))


def latest(hashes: DataFrame) -> DataFrame:
    """The newest (registry, bundle_hash, bid): by the bundle's time, then its id."""
    newest = F.max_by(F.struct("bundle_hash", "bid"), F.struct("bid_ts", "bid"))
    return hashes.groupBy("registry").agg(newest.alias("r")).select("registry", "r.*")


def content_changes(current: DataFrame, stored: DataFrame, key: str = "name", value: str = "sha256") -> DataFrame:
    """new, changed or unchanged, against the stored hash of the name."""
    old = stored.select(key, F.col(value).alias("stored"))
    state = F.when(F.col("stored").isNull(), "new").when(F.col("stored") == F.col(value), "unchanged").otherwise("changed")
    return current.join(old, key, "left").withColumn("change", state).drop("stored")


def new_bundles(bundles: DataFrame, hashes: DataFrame) -> DataFrame:
    return bundles.join(hashes.select("bundle_hash"), "bundle_hash", "left_anti")


def with_lineage(resources: DataFrame) -> DataFrame:
    """Derived resources beside their originals."""
    d = resources.filter("derived_from is not null").select("bid", "name", F.col("derived_from").alias("original"))
    o = resources.filter("derived_from is null").select("bid", F.col("name").alias("original"), F.col("url").alias("original_url"))
    return d.join(o, ["bid", "original"])


def completeness(contents: DataFrame, metadata: DataFrame, manifests: DataFrame, discovered: DataFrame) -> DataFrame:
    """Violations: contents or metadata without the other, bundles without manifest or discovery record."""
    key = ["bid", "name"]
    out = contents.join(metadata.select(*key), key, "left_anti").select(*key, F.lit("no metadata").alias("violation"))
    out = out.union(metadata.join(contents.select(*key), key, "left_anti").select(*key, F.lit("no content")))
    bids = contents.select("bid").distinct()
    for other, what in ((manifests, "no manifest"), (discovered, "no discovery record")):
        out = out.union(bids.join(other.select("bid"), "bid", "left_anti").select("bid", F.lit(None).cast("string"), F.lit(what)))
    return out


def dangling(latest_rows: DataFrame, hashes: DataFrame) -> DataFrame:
    return latest_rows.join(hashes.select("bundle_hash"), "bundle_hash", "left_anti")


def count_check(completed: DataFrame, hashes: DataFrame, expected: int) -> DataFrame:
    n = completed.agg(F.countDistinct("bid").alias("bundles"))
    h = hashes.agg(F.countDistinct("bundle_hash").alias("hashes"))
    return n.join(h).select("bundles", "hashes", ((F.col("bundles") == expected) & (F.col("hashes") == expected)).alias("as_expected"))


# ---------------------------------------------------------------- writers


def discovery_records(bundles: DataFrame, config_id: str) -> DataFrame:
    meta = F.struct(F.col("url").alias("url"), F.col("resources_count").alias("resources_count"))
    return bundles.select("bid", F.col("url").alias("primary_url"), "resources_count", meta.alias("meta"), F.lit(config_id).alias("config_id"))


def completion_records(summary: DataFrame, source: str, run: str) -> DataFrame:
    return summary.select("bid", "bundle_hash", F.lit(source).alias("source"), F.lit(run).alias("run_id"), "resources_count")


def resource_metadata(resources: DataFrame) -> DataFrame:
    size = F.octet_length("content").cast("long").alias("bytes_uploaded")
    return resources.select("bid", "name", F.sha2("content", 256).alias("sha256"), size, "url", "content_type", "status_code")


RAW_PARTS = ("metadata", "content", "manifest", "discovered", "completed")


def write_raw(resources: DataFrame, path: str, config_id: str, run: str, batch: str | None = None) -> DataFrame:
    """Contents, metadata, manifests, discovery and completion records under ``path``, partitioned by batch,
    registry and day; ``bundle_path`` is each bundle's place in the layout. Returns the summary of the
    bundles. Contents are hashed once: the metadata is written first, and all else but the contents
    comes from the metadata of these bundles.

    All five parts of a batch (by default, of the run) are there together: they are staged in partitions of the batch, and
    seen by ``read_raw`` once the batch's mark is put in place. What a batch that failed has left is replaced when it is
    run again; a batch that is committed adds nothing.
    """
    spark, batch = resources.sparkSession, run if batch is None else batch
    marks = Commits(spark, f"{path}/_committed")
    if not marks.has(batch):
        for part in RAW_PARTS:
            marks.remove(f"{path}/{part}/batch={batch}")
        _stage_raw(resources, path, config_id, run, batch)
        marks.create(batch, {"run": run, "config_id": config_id})
    return read_raw(spark, path, "completed", batch).select("bid", "resources_count", "total_bytes", "bundle_hash")


def _stage_raw(resources: DataFrame, path: str, config_id: str, run: str, batch: str) -> None:
    p = bid_parts("bid")
    day = [p["registry"].alias("registry"), F.year(p["bid_ts"]).alias("year"), F.month(p["bid_ts"]).alias("month"), F.day(p["bid_ts"]).alias("day")]
    keys = ("registry", "year", "month", "day")

    def stage(rows: DataFrame, part: str, kind: str = "json") -> None:
        rows.select("*", *day).write.partitionBy(*keys).format(kind).save(f"{path}/{part}/batch={batch}")

    rows = written(resource_metadata(resources), "metadata")
    at = bid_path("bid").alias("bundle_path")
    stage(rows.select("*", at), "metadata")
    stage(resources.select("*", at), "content", "parquet")
    listed = rows.select("bid", "name", "sha256", F.col("bytes_uploaded").alias("size"))
    stage(listed, "manifest")
    summary = written(bundle_hashes(listed), "summary")
    first = rows.groupBy("bid").agg(F.min_by("url", "name").alias("url"))
    stage(discovery_records(summary.join(first, "bid"), config_id), "discovered")
    stage(completion_records(summary, config_id, run).join(summary.select("bid", "total_bytes"), "bid"), "completed")
    discard(rows, summary)


def read_raw(spark: SparkSession, path: str, part: str, batch: str | None = None) -> DataFrame:
    """A part of the raw layout (one of ``RAW_PARTS``): the rows of committed batches only, or of one batch. Batches are
    partitions, so others are not opened."""
    committed = [n for n in Commits(spark, f"{path}/_committed").names() if batch in (None, n)]
    if not committed:
        raise FileNotFoundError(f"no batch is committed in {path}")
    reader = spark.read.option("basePath", f"{path}/{part}")
    places = [f"{path}/{part}/batch={n}" for n in sorted(committed)]
    return reader.parquet(*places) if part == "content" else reader.json(places)


def write_flat(resources: DataFrame, path: str, mode: str = "append") -> None:
    """``bundle_{bid}/{safe name}`` as target column, bytes in parquet, metadata in JSON beside it."""
    target = F.concat(F.lit("bundle_"), F.col("bid"), F.lit("/"), safe_name("url"))
    resources.withColumn("target", target).write.mode(mode).parquet(f"{path}/content")
    resource_metadata(resources).withColumn("name", F.concat("name", F.lit(".meta"))).write.mode(mode).json(f"{path}/meta")
    bundle_hashes(manifest(resources)).write.mode(mode).json(f"{path}/bundle_meta")


def write_objects(resources: DataFrame, path: str, prefix: str, mode: str = "append") -> DataFrame:
    """Object-store layout; returns (bid, metadata_key, uploaded_keys)."""
    keyed = resources.withColumn("key", object_key(F.lit(prefix), F.col("bid"), F.col("url")))
    keyed.write.mode(mode).parquet(f"{path}/objects")
    meta_key = F.concat(F.lit(f"{prefix}/bundles/"), F.col("bid"), F.lit("/metadata.json")).alias("metadata_key")
    meta = keyed.groupBy("bid").agg(F.sort_array(F.collect_list("key")).alias("uploaded_keys")).select("bid", meta_key, "uploaded_keys")
    meta.write.mode(mode).json(f"{path}/bundles")
    return meta


def complete_once(completed_path: str, callbacks: list[Callable[[DataFrame], None]] | None = None) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function: appends bundles that are not yet in the completion feed and, once
    they are written, runs the callbacks on them. The feed is partitioned by batch, and a batch's mark
    beside it says that its callbacks ran: a batch that is run again adds nothing and calls nothing, one
    that failed half-way is written anew and calls again. Of the feed only the ids are read."""

    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        feed, mark = path(completed_path), path(f"{completed_path}-called/{batch_id}")
        files = feed.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        if files.exists(mark):
            return
        new = batch.dropDuplicates(["bid"])
        if files.exists(feed):
            done = spark.read.parquet(completed_path).filter(F.col("batch_id") != batch_id)
            new = new.join(done.select("bid"), "bid", "left_anti")
        new = written(new.withColumn("batch_id", F.lit(batch_id).cast("long")), "completed")
        if new.take(1):
            # the batch's own partition is replaced as a whole
            new.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(completed_path)
            for call in callbacks or ():
                call(new)
        files.create(mark).close()

    return run


def named_resources(resources: DataFrame) -> DataFrame:
    return resources.withColumn("name", resource_name("url"))


def changed(column: Column, other: Column) -> Column:
    return ~column.eqNullSafe(other)

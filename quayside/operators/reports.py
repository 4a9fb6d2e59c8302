"""Reports on runs, timings, errors, requests and pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..shared import written
from .ordered import in_ranges, running


def run_summary(log: DataFrame) -> DataFrame:
    """log(run_id, status, error): processed and failed counts and distinct errors; a run failed if
    nothing was processed and something went wrong."""
    ok = F.col("status") == "ok"
    out = log.groupBy("run_id").agg(
        F.count_if(ok).alias("processed_count"), F.count_if(~ok).alias("error_count"), F.sort_array(F.collect_set("error")).alias("errors")
    )
    return out.withColumn("failed", (F.col("processed_count") == 0) & (F.col("error_count") > 0))


def counters(events: DataFrame, names: DataFrame | None = None) -> DataFrame:
    """Sum of amounts (1 where null) by name; asked-for names without events are 0."""
    out = events.groupBy("name").agg(F.sum(F.coalesce("amount", F.lit(1))).alias("value"))
    if names is not None:
        out = names.select("name").distinct().join(out, "name", "left").withColumn("value", F.coalesce("value", F.lit(0)))
    return out


def timing_stats(timings: DataFrame) -> DataFrame:
    return timings.groupBy("operation").agg(
        F.count("seconds").alias("n"), F.avg("seconds").alias("avg_s"), F.min("seconds").alias("min_s"), F.max("seconds").alias("max_s"), F.max("ts").alias("last_updated")
    )


def pagination(pages: DataFrame, max_records: int = 20_000) -> DataFrame:
    """pages(day, prefix, total, count): do the counts of a search's pages add up to its total?"""
    out = pages.groupBy("day", "prefix").agg(F.count("*").alias("pages"), F.sum("count").alias("records"), F.max("total").alias("total"))
    return out.withColumn("complete", F.col("records") == F.col("total")).withColumn("narrow", F.col("total") > max_records)


def state_stats(state: DataFrame) -> DataFrame:
    return state.agg(F.count("*").alias("total_keys"), F.count("expires_at").alias("expiring_keys"))


def rate_compliance(requests: DataFrame, limit: int, every: str = "1 second") -> DataFrame:
    """Most requests of a source in one window, and how many windows were over the limit."""
    per = requests.groupBy("source", F.window("ts", every)).count()
    return per.groupBy("source").agg(F.max("count").alias("most"), F.count_if(F.col("count") > limit).alias("windows_over"))


def sliding_rates(requests: DataFrame, limit: int, every_us: int = 1_000_000) -> DataFrame:
    """(source, requests, most, starts_over, shortest_gap_us) of requests(source, ts): the most requests in any stretch of ``every_us``
    (the end not counted), how many requests begin one with more than ``limit``, and the shortest time between two.

    A sweep with two ends in range order: each time is an event, and so is each time ``every_us`` later; what has come before the
    later one, less what had come before the earlier one, is the stretch's number. Running sums carry over from
    range to range, so a busy source is not one task and a long stretch copies no rows. Requests of one
    microsecond are one row. Requests without a time are left out; those without a source are one source.
    """
    at = F.unix_micros(F.col("ts").cast("timestamp"))
    per = requests.filter("ts is not null").groupBy("source", at.alias("us")).agg(F.count("*").alias("n"))
    rows = written(running(per, "source", ["us"], "n", "before"), "times")
    both = rows.select("source", "us", F.lit(1).alias("kind"), "n", F.lit(None).cast("long").alias("starts"), "before")
    both = both.unionByName(rows.select("source", (F.col("us") + every_us).alias("us"), F.lit(0).alias("kind"), F.lit(0).cast("long").alias("n"), F.col("n").alias("starts"), "before"))
    swept = running(both, "source", ["us", "kind"], "n", "reached").filter("kind = 0").withColumn("here", F.col("reached") - F.col("before"))
    rates = swept.groupBy("source").agg(
        F.sum("starts").alias("requests"), F.max("here").alias("most"), F.coalesce(F.sum(F.when(F.col("here") > limit, F.col("starts"))), F.lit(0)).alias("starts_over")
    )
    return rates.join(shortest_gaps(rows), rates["source"].eqNullSafe(F.col("_source")), "left").drop("_source")


def shortest_gaps(times: DataFrame) -> DataFrame:
    """(_source, shortest_gap_us) of the written, distinct times(source, us, n): 0 where a time has several requests, null for a lone request."""
    ranged = in_ranges(times.select("source", "us", "n"), "source", ["us"])
    last = F.lag("us").over(Window.partitionBy("_part", "source").orderBy("_place"))
    inner = ranged.select("source", F.when(F.col("n") > 1, 0).otherwise(F.col("us") - last).alias("gap"))
    ends = ranged.groupBy("source", "_part").agg(F.min("us").alias("first"), F.max("us").alias("last"))  # a row for each range
    over = F.lag("last").over(Window.partitionBy("source").orderBy("_part"))
    gaps = inner.unionByName(ends.select("source", (F.col("first") - over).alias("gap")))
    return gaps.groupBy(F.col("source").alias("_source")).agg(F.min("gap").alias("shortest_gap_us"))


def error_class(error: Column) -> Column:
    e = F.lower(error)
    return F.when(e.rlike("timeout|timed out|connection|network|dns|reset"), "network").when(e.rlike("fatal|denied|unauthor|forbidden|invalid"), "fatal").otherwise("other")


def error_rows(log: DataFrame) -> DataFrame:
    """(item_id, error, error_class, retry_count, ts): a row for each error of log(item_id, error, ts),
    to be appended; retry_count (0 if the log has none) is carried."""
    n = F.coalesce(F.col("retry_count"), F.lit(0)) if "retry_count" in log.columns else F.lit(0)
    return log.filter("error is not null").select("item_id", "error", error_class(F.col("error")).alias("error_class"), n.cast("int").alias("retry_count"), "ts")


def result_rows(done: DataFrame, resources: DataFrame) -> DataFrame:
    """(path, ts, success, bid, bundle_count, bundle_refs) of done(path, ts, bid): a path succeeded if
    its bundle has resources(bid, name); refs are the names, in order, of one path's bundle."""
    refs = resources.groupBy("bid").agg(F.count("*").alias("bundle_count"), F.sort_array(F.collect_list("name")).alias("bundle_refs"))
    out = done.join(refs, "bid", "left")
    n = F.coalesce("bundle_count", F.lit(0))
    return out.select("path", "ts", (n > 0).alias("success"), "bid", n.alias("bundle_count"), F.coalesce("bundle_refs", F.array().cast("array<string>")).alias("bundle_refs"))


def errors_by_class(errors: DataFrame) -> DataFrame:
    return errors.withColumn("error_class", error_class(F.col("error"))).groupBy("error_class").agg(F.count("*").alias("n"), F.max("ts").alias("last_ts"))


def success_rate(results: DataFrame) -> DataFrame:
    return results.groupBy("source").agg(F.count("*").alias("n"), F.avg(F.col("success").cast("int")).alias("success_rate"))

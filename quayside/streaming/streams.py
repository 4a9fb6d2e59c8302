"""The landing zone as streams: discovery, deduplication, modified-since, counters, rates, fan-out."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

BINARY_FILE = "path string, modificationTime timestamp, length long, content binary"


def watch_files(spark: SparkSession, path: str, max_files: int | None = None, newest_first: bool = False, pattern: str | None = None) -> DataFrame:
    """New files as they land. The checkpointed file log remembers what was seen; ``max_files`` a
    trigger is the back-pressure."""
    r = spark.readStream.format("binaryFile").schema(BINARY_FILE).option("latestFirst", str(newest_first).lower())
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    if pattern:
        r = r.option("pathGlobFilter", pattern)
    return r.load(path)


def dedup_within(stream: DataFrame, keys: list[str], ts: str, ttl: str) -> DataFrame:
    """The first row of each key within the time to live, by event time."""
    return stream.withWatermark(ts, ttl).dropDuplicatesWithinWatermark(keys)


class _SeenOnce(StatefulProcessor):
    """Passes a key's first row; the key is forgotten after its time to live."""

    def __init__(self, ttl_ms: int):
        self.ttl_ms = ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.seen = handle.getValueState("seen", "at long", self.ttl_ms)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        for frame in rows:
            if len(frame) and not self.seen.exists():
                self.seen.update((1,))
                yield frame.head(1)

    def close(self) -> None:
        pass


def dedup_with_ttl(stream: DataFrame, key: str, ttl_seconds: int) -> DataFrame:
    """As ``dedup_within`` by processing time (needs the RocksDB state store)."""
    return stream.groupBy(key).transformWithStateInPandas(
        statefulProcessor=_SeenOnce(ttl_seconds * 1000), outputStructType=stream.schema, outputMode="Append", timeMode="ProcessingTime"
    )


def expired_keys(stream: DataFrame, key: str, ts: str, ttl_ms: int, late: str = "0 seconds") -> DataFrame:
    """(key, since_ms, expired_ms, n): every stretch of a key's rows (n of them, from ``since_ms``) after which it was silent for
    ``ttl_ms``, once event time, less ``late``, has passed its end. Rows of a batch may come in any order; a stretch that is not over
    is one row of state, and goes when it is given out. Rows without a time take no part."""
    rows = stream.select(F.col(key).alias("key"), F.timestamp_millis(F.unix_millis(ts)).alias("ts")).withWatermark("ts", late)
    stretches = rows.groupBy("key", F.session_window("ts", f"{ttl_ms} milliseconds").alias("at")).agg(F.count("*").alias("n"))
    return stretches.select("key", F.unix_millis("at.start").alias("since_ms"), F.unix_millis("at.end").alias("expired_ms"), "n")


class _Modified(StatefulProcessor):
    """Passes rows with a time after the last that passed in earlier batches, one of each time; rows of a batch may come in any order."""

    def __init__(self, place: int):
        self.place = place

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.last = handle.getValueState("last", "us long")

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        last, passed = self.last.get(), set()
        for row in rows:
            at = row[self.place]
            if at is not None and (last is None or at > last[0]) and at not in passed:
                passed.add(at)
                yield row
        if passed:
            self.last.update((max(passed),))

    def close(self) -> None:
        pass


def modified_since(stream: DataFrame, key: str = "path") -> DataFrame:
    """Files that were never seen, or are newer than when last seen; state is one time a path."""
    rows = stream.withColumn("mtime", F.unix_micros(F.col("mtime").cast("timestamp")))
    new = rows.groupBy(key).transformWithState(
        statefulProcessor=_Modified(rows.columns.index("mtime")), outputStructType=rows.schema, outputMode="Append", timeMode="None"
    )
    return new.withColumn("mtime", F.timestamp_micros("mtime").cast(stream.schema["mtime"].dataType))


def running_counters(stream: DataFrame) -> DataFrame:
    return stream.groupBy("name").agg(F.sum(F.coalesce("amount", F.lit(1))).alias("value"))


def running_timings(stream: DataFrame) -> DataFrame:
    return stream.groupBy("operation").agg(F.count("seconds").alias("n"), F.avg("seconds").alias("avg_s"), F.min("seconds").alias("min_s"), F.max("seconds").alias("max_s"))


def request_rates(stream: DataFrame, every: str = "1 second", late: str = "10 seconds") -> DataFrame:
    """Requests by source and window; rows later than the watermark are dropped."""
    return stream.withWatermark("ts", late).groupBy("source", F.window("ts", every)).count()


def fan_out(*consumers: Callable[[DataFrame, int], None]) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function: the batch is read once and given to every consumer."""

    def run(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            for consume in consumers:
                consume(batch, batch_id)
        finally:
            batch.unpersist()

    return run


def interval_due(last_run: Column, interval_s: int, jitter_s: int = 0, seed: int = 0) -> Column:
    """When a job that may run once an interval is due again; jitter spreads starts that fall together.
    A job that never ran is due at once (null)."""
    wait = F.lit(float(interval_s)) if not jitter_s else F.lit(float(interval_s)) + F.rand(seed) * jitter_s
    return F.timestamp_micros(F.unix_micros(last_run.cast("timestamp")) + (wait * 1_000_000).cast("long"))


def every(writer: DataStreamWriter, interval_s: int) -> DataStreamWriter:
    """A stream that looks for new input once an interval."""
    return writer.trigger(processingTime=f"{interval_s} seconds")


def next_due(last_run: Column, time_of_day: str, tz: str = "UTC") -> Column:
    """The next time (UTC) that the local clock shows ``HH:mm[:ss]`` after the last run."""
    local = F.from_utc_timestamp(last_run, tz)
    today = F.to_timestamp(F.concat(F.date_format(local, "yyyy-MM-dd "), F.lit(time_of_day)))
    due = F.when(today > local, today).otherwise(today + F.expr("interval 1 day"))
    return F.to_utc_timestamp(due, tz)

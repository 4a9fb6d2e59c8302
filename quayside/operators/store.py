"""Durable state: a key-value store in levels of hash buckets, and a queue whose numbers and contents are committed together."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .commits import Commits
from .ordered import numbered
from .state import current, last_write

BITMAP = 32_768  # bits of one of Spark's bitmaps
BROADCAST_BYTES = 64 << 20


class StateStore:
    """Puts (k, v, put_at, expires_at, deleted) in ``buckets`` by the hash of the key. A put writes one run, whose rows are in
    the buckets of its keys only; a bucket with more than ``runs`` of them is merged into one, other buckets are not touched.
    The manifest of a commit names each bucket's runs and its Bloom filter, so readers see whole puts or none. Of
    the rows of a key the last put_at wins, then the later commit, then the greater value, a delete and the later expiry.
    Replaced rows go when buckets are merged, so a view is of a time not before the last put."""

    SCHEMA = "k string, v string, put_at timestamp, expires_at timestamp, deleted boolean, seq long, bucket int"
    ORDER = ("put_at", "seq", "v", "deleted", "expires_at")
    HASHES = 3

    def __init__(self, spark: SparkSession, path: str, buckets: int = 64, runs: int = 4, filter_parts: int = 8):
        """A filter has ``filter_parts`` bitmaps of 4 KB a bucket. The numbers must stay the same for a path."""
        self.spark, self.path, self.buckets, self.runs = spark, path.rstrip("/"), buckets, runs
        self.parts, self.commits = filter_parts, Commits(spark, f"{path}/_commits")

    # -------------------------------------------------------- buckets and runs

    def bucket(self, key: str = "k") -> Column:
        return F.pmod(F.xxhash64(key), F.lit(self.buckets)).cast("int").alias("bucket")

    def touched(self, rows: DataFrame) -> list[int]:
        """At most ``buckets`` numbers."""
        return sorted(r[0] for r in rows.select("bucket").distinct().collect())

    def _write(self, rows: DataFrame) -> str:
        name = f"run-{uuid.uuid4().hex[:12]}"
        rows.repartition("bucket").write.partitionBy("bucket").parquet(f"{self.path}/{name}")
        return name

    def rows(self, manifest: dict | None = None, buckets: list[int] | None = None) -> DataFrame:
        """All rows of the buckets' runs; others are not listed, opened or read."""
        manifest = self.commits.latest()[1] if manifest is None else manifest
        by_run: dict[tuple[str, int], list[int]] = {}
        for b, runs in manifest.get("buckets", {}).items():
            if buckets is None or int(b) in buckets:
                for run, seq in runs:
                    by_run.setdefault((run, seq), []).append(int(b))
        found = [self._run(run, own).withColumn("seq", F.coalesce("seq", F.lit(seq).cast("long"))) for (run, seq), own in sorted(by_run.items())]
        return reduce(DataFrame.unionByName, found) if found else self.spark.createDataFrame([], self.SCHEMA)

    def _run(self, run: str, buckets: list[int]) -> DataFrame:
        at = f"{self.path}/{run}"
        return self.spark.read.schema(self.SCHEMA).option("basePath", at).parquet(*[f"{at}/bucket={b}" for b in sorted(buckets)])

    # -------------------------------------------------------- filters

    def _positions(self, key: str) -> list[Column]:
        return [F.pmod(F.xxhash64(F.col(key), F.lit(i)), F.lit(BITMAP * self.parts)) for i in range(1, self.HASHES + 1)]

    def _filter(self, rows: DataFrame, manifest: dict, touched: list[int]) -> str:
        """The filters of the touched buckets with the keys of rows(bucket, k) added."""
        at = rows.select("bucket", F.explode(F.array(*self._positions("k"))).alias("at"))
        bits = at.groupBy("bucket", F.expr(f"CAST(at div {BITMAP} AS INT)").alias("part")).agg(F.bitmap_construct_agg(F.col("at") % BITMAP).alias("bits"))
        old = self._filters(manifest, touched)
        if old is not None:
            pieces = F.transform(F.sequence(F.lit(0), F.lit(self.parts - 1)), lambda i: F.struct(i.alias("part"), F.substr("bits", i * (BITMAP // 8) + 1, F.lit(BITMAP // 8)).alias("bits")))
            bits = bits.unionByName(old.select("bucket", F.inline(pieces))).groupBy("bucket", "part").agg(F.bitmap_or_agg("bits").alias("bits"))
        every = self.spark.createDataFrame([(b, p) for b in touched for p in range(self.parts)], "bucket int, part int")
        whole = every.join(bits, ["bucket", "part"], "left").select("bucket", "part", F.coalesce("bits", F.lit(bytes(BITMAP // 8))).alias("bits"))
        joined = F.aggregate(F.array_sort(F.collect_list(F.struct("part", "bits"))), F.lit(b""), lambda a, x: F.concat(a, x["bits"]))
        name = f"filter-{uuid.uuid4().hex[:12]}"
        whole.groupBy("bucket").agg(joined.alias("bits")).repartition("bucket").write.partitionBy("bucket").parquet(f"{self.path}/{name}")
        return name

    def _filters(self, manifest: dict, buckets: list[int]) -> DataFrame | None:
        by_name: dict[str, list[int]] = {}
        for b in buckets:
            if name := manifest.get("filters", {}).get(str(b)):
                by_name.setdefault(name, []).append(b)
        found = [self.spark.read.schema("bits binary, bucket int").option("basePath", f"{self.path}/{name}").parquet(*[f"{self.path}/{name}/bucket={b}" for b in own]) for name, own in sorted(by_name.items())]
        return reduce(DataFrame.unionByName, found) if found else None

    def _maybe(self, key: str) -> Column:
        """All bits of a key are set in ``bits``."""
        def is_set(at: Column) -> Column:
            byte = F.conv(F.hex(F.substr("bits", F.floor(at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
            return F.call_function("shiftright", byte, (at % 8).cast("int")).bitwiseAND(F.lit(1)) == 1

        return reduce(Column.__and__, [is_set(p) for p in self._positions(key)])

    # -------------------------------------------------------- the store

    def put(self, rows: DataFrame) -> list[int]:
        """Commit rows(k, v, put_at, expires_at, deleted); the buckets that were touched. No rows are no commit."""
        own = rows.select("k", "v", "put_at", "expires_at", F.coalesce("deleted", F.lit(False)).alias("deleted"), F.lit(None).cast("long").alias("seq"), self.bucket())
        run = self._write(last_write(own, order=("put_at", "v", "deleted", "expires_at")))
        written = self.spark.read.schema(self.SCHEMA).parquet(f"{self.path}/{run}")
        touched = self.touched(written)
        if not touched:
            self.commits.remove(f"{self.path}/{run}")
            return []
        made: list[str] = [run]

        def step(number: int, manifest: dict) -> dict:
            buckets = {b: list(r) for b, r in manifest.get("buckets", {}).items()}
            for b in touched:
                buckets.setdefault(str(b), []).append([run, number + 1])
            full = [b for b in touched if len(buckets[str(b)]) > self.runs]
            if full:
                merged = last_write(self.rows({"buckets": buckets}, full), order=self.ORDER)
                made.append(self._write(merged))
                buckets |= {str(b): [[made[-1], number + 1]] for b in full}
            made.append(self._filter(written, manifest, touched))
            return {"buckets": buckets, "filters": manifest.get("filters", {}) | {str(b): made[-1] for b in touched}}

        committed = self.commits.advance(step)
        used = {run for runs in committed["buckets"].values() for run, _ in runs} | set(committed["filters"].values())
        for name in set(made) - used:  # of attempts that others came before, or merged at once
            self.commits.remove(f"{self.path}/{name}")
        return touched

    def view(self, as_of: Column, buckets: list[int] | None = None) -> DataFrame:
        """(k, v, put_at, expires_at, deleted, seq, bucket) of the keys alive at a time."""
        rows = self.rows(buckets=buckets).filter(F.col("put_at") <= as_of)
        return current(last_write(rows, order=self.ORDER), as_of)

    def get(self, keys: DataFrame, as_of: Column) -> DataFrame:
        """keys(k) with v, null if absent; only their buckets are read."""
        own = keys.withColumn("bucket", self.bucket())
        return keys.join(self.view(as_of, self.touched(own)).select("k", "v"), "k", "left")

    def unprocessed(self, items: DataFrame, as_of: Column, key: str = "k") -> DataFrame:
        """Items whose key is not alive in the store. Those that the filters rule out pass without a join; of the others only
        the buckets they are in are read. A null key is never known."""
        manifest = self.commits.latest()[1]
        filters = self._filters(manifest, list(range(self.buckets)))
        if filters is None:
            return items
        small = self.buckets * self.parts * BITMAP // 8 <= BROADCAST_BYTES
        marked = items.withColumn("bucket", self.bucket(key)).join(F.broadcast(filters) if small else filters, "bucket", "left")
        marked = marked.withColumn("_maybe", F.coalesce(F.col(key).isNotNull() & self._maybe(key), F.lit(False))).drop("bits")
        maybe = marked.filter("_maybe")
        alive = self.view(as_of, self.touched(maybe)).select(F.col("k").alias(key))
        return marked.filter("NOT _maybe").select(*items.columns).unionByName(maybe.join(alive, key, "left_anti").select(*items.columns))

    def sweep(self, as_of: Column) -> list[int]:
        """Rewrite the buckets that hold rows which no view from this time on shows (replaced, expired, deleted); these buckets."""
        swept: list[int] = []

        def kept(rows: DataFrame) -> DataFrame:
            past = current(last_write(rows.filter(F.col("put_at") <= as_of), order=self.ORDER), as_of)
            return past.unionByName(rows.filter(F.col("put_at") > as_of))

        def step(number: int, manifest: dict) -> dict:
            rows = self.rows(manifest)
            counts = rows.groupBy("bucket").agg(F.count("*").alias("n")).join(kept(rows).groupBy("bucket").agg(F.count("*").alias("m")), "bucket", "left")
            swept[:] = self.touched(counts.filter("m IS NULL OR n > m"))
            if not swept:
                return manifest
            run = self._write(kept(self.rows(manifest, swept)))
            alive = self.touched(self.spark.read.schema(self.SCHEMA).parquet(f"{self.path}/{run}"))
            buckets = {b: r for b, r in manifest["buckets"].items() if int(b) not in swept} | {str(b): [[run, number + 1]] for b in alive}
            return manifest | {"buckets": buckets, "filters": {b: f for b, f in manifest["filters"].items() if b in buckets}}

        self.commits.advance(step)
        return swept

    def vacuum(self) -> int:
        """Delete runs and filters that the latest commit does not name, and earlier commits; no reader or writer may be at work. How many went."""
        number, manifest = self.commits.latest()
        used = {run for runs in manifest.get("buckets", {}).values() for run, _ in runs} | set(manifest.get("filters", {}).values())
        old = [f.getPath().toString() for f in self.commits.files.listStatus(self.commits._at("..")) if not f.getPath().getName().startswith("_") and f.getPath().getName() not in used]
        old += [f"{self.path}/_commits/{n}.json" for n in self.commits.names() if n.isdigit() and int(n) < number]
        for path in old:
            self.commits.remove(path)
        return len(old)


class Queue:
    """A first-in first-out queue of each namespace. Items are written with their place in their batch; the commit gives the
    batch its first numbers and keeps each namespace's next_id, head and size in one table, so a batch is there with its
    numbers or not at all, and one that has to start again from another base is not written again."""

    COUNTERS = "ns string, next_id long, head long, size long, start long"

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self.commits = Commits(spark, f"{path}/_commits")

    def _counters(self, body: dict) -> DataFrame:
        name = body.get("counters")
        return self.spark.read.schema(self.COUNTERS).parquet(f"{self.path}/{name}") if name else self.spark.createDataFrame([], self.COUNTERS)

    def counters(self) -> DataFrame:
        """(ns, next_id, head, size): the next number, the first number that waits, how many wait."""
        return self._counters(self.commits.latest()[1]).select("ns", "next_id", "head", "size")

    def _write(self, rows: DataFrame, kind: str) -> str:
        name = f"{kind}-{uuid.uuid4().hex[:12]}"
        rows.write.parquet(f"{self.path}/{name}")
        return name

    def enqueue(self, items: DataFrame, order: list[str], ns: str = "ns") -> DataFrame:
        """The items with the numbers they have got (seq), consecutive in each namespace, in the order. Null namespaces are one. If
        it fails, nothing is left of them."""
        batch = self._write(numbered(items, ns, order, "_nth"), "items")
        placed = self.spark.read.schema(items.select("*", F.lit(1).cast("long").alias("_nth")).schema).parquet(f"{self.path}/{batch}")
        per = placed.groupBy(F.col(ns).alias("_ns")).agg(F.count("*").alias("_n"))
        made: list[str] = []

        def step(number: int, body: dict) -> dict:
            before = self._counters(body).drop("start")
            both = before.join(per, before["ns"].eqNullSafe(F.col("_ns")) & F.col("_n").isNotNull(), "full_outer")
            start = F.when(F.col("_n").isNotNull(), F.coalesce("next_id", F.lit(1)))
            n = F.coalesce("_n", F.lit(0))
            after = both.select(
                F.when(F.col("next_id").isNull(), F.col("_ns")).otherwise(F.col("ns")).alias("ns"), (F.coalesce("next_id", F.lit(1)) + n).alias("next_id"),
                F.coalesce("head", F.lit(1)).cast("long").alias("head"), (F.coalesce("size", F.lit(0)) + n).alias("size"), start.cast("long").alias("start"),
            )
            made.append(self._write(after, "counters"))
            return {"counters": made[-1], "batches": [*body.get("batches", []), [batch, made[-1], ns]]}

        try:
            committed = self.commits.advance(step)
        except BaseException:
            for name in (batch, *made):
                self.commits.remove(f"{self.path}/{name}")
            raise
        for name in made[:-1]:
            self.commits.remove(f"{self.path}/{name}")
        return self._numbered(*committed["batches"][-1], placed.schema)

    def _numbered(self, batch: str, counters: str, ns: str, schema=None) -> DataFrame:
        rows = self.spark.read.schema(schema).parquet(f"{self.path}/{batch}") if schema else self.spark.read.parquet(f"{self.path}/{batch}")
        starts = self._counters({"counters": counters}).filter("start IS NOT NULL").select(F.col("ns").alias("_ns"), "start")
        return rows.join(starts, F.col(ns).eqNullSafe(F.col("_ns"))).withColumn("seq", F.col("start") + F.col("_nth") - 1).drop("_ns", "start", "_nth")

    def _waiting(self, body: dict) -> DataFrame | None:
        """Items from each namespace's head on, with the head."""
        parts = [self._numbered(*b).withColumn("_of", F.col(b[2])) for b in body.get("batches", [])]
        if not parts:
            return None
        items = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
        heads = self._counters(body).select(F.col("ns").alias("_ns"), F.col("head").alias("_head"))
        return items.join(heads, F.col("_of").eqNullSafe(F.col("_ns")) & (F.col("seq") >= F.col("_head"))).drop("_ns", "_of")

    def peek(self, n: int) -> DataFrame | None:
        """The first n items that wait in each namespace; None before the first batch."""
        waiting = self._waiting(self.commits.latest()[1])
        return waiting if waiting is None else waiting.filter(F.col("seq") < F.col("_head") + n).drop("_head")

    def dequeue(self, n: int) -> DataFrame | None:
        """Take the first n items of each namespace; of two takers each gets others."""
        held: dict = {}

        def step(number: int, body: dict) -> dict:
            held["body"] = body
            if not body:
                return body
            c = self._counters(body)
            took = F.least(F.col("size"), F.lit(n))
            name = self._write(c.select("ns", "next_id", (F.col("head") + took).alias("head"), (F.col("size") - took).alias("size"), F.lit(None).cast("long").alias("start")), "counters")
            return body | {"counters": name}

        if not self.commits.latest()[0]:
            return None
        self.commits.advance(step)
        return self._waiting(held["body"]).filter(F.col("seq") < F.col("_head") + n).drop("_head")

    def compact(self) -> None:
        """Put what waits into one batch, with its numbers; taken items are left behind."""
        def step(number: int, body: dict) -> dict:
            waiting = self._waiting(body)
            if waiting is None:
                return body
            key = body["batches"][-1][2]
            if {b[2] for b in body["batches"]} != {key}:
                raise ValueError("batches name their namespace column differently")
            batch = self._write(waiting.withColumn("_nth", F.col("seq") - F.col("_head") + 1).drop("seq", "_head"), "items")
            starts = self._write(self._counters(body).withColumn("start", F.col("head")), "counters")
            return body | {"batches": [[batch, starts, key]], "counters": starts}

        self.commits.advance(step)

"""State as tables: known sets, key-value views, queues, retries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.names import encode_value, expires_at, prefixed_key
from ..schemas import DEFAULT_TTL
from ..shared import written
from .filters import not_expired
from .ordered import numbered


def known(*sets: DataFrame, key: str = "path") -> DataFrame:
    """Union of processed, in-flight and queued keys."""
    out = sets[0].select(key)
    for s in sets[1:]:
        out = out.union(s.select(key))
    return out.distinct()


def unprocessed(items: DataFrame, known_keys: DataFrame, key: str = "path") -> DataFrame:
    return items.join(known_keys.select(key), key, "left_anti")


def save_processed(store, keys: DataFrame, at: Column, prefix: str = "", ttl_s: int | None = None, key: str = "path") -> list[int]:
    """Add keys to the persisted set of processed items in a ``StateStore``; they stay for ``ttl_s``, by default for the kind's time to live."""
    values = keys.select(F.col(key).cast("string").alias("k"), F.lit("1").alias("v")).filter("k is not null").distinct()
    return store.put(puts(values, "processed", at, prefix, ttl_s))


def load_processed(store, as_of: Column, prefix: str = "", key: str = "path") -> DataFrame:
    """The persisted set at a time, as a column of keys."""
    start = f"{prefix}:processed:" if prefix else "processed:"
    return key_prefix(store.view(as_of), start).select(F.substr("k", F.lit(len(start) + 1)).alias(key))


def modified_since(listing: DataFrame, seen: DataFrame, key: str = "path") -> DataFrame:
    """Rows never seen, or modified after the last time seen; seen(key, last_mtime)."""
    last = seen.groupBy(key).agg(F.max("last_mtime").alias("last_mtime"))
    return listing.join(last, key, "left").filter("last_mtime is null or mtime > last_mtime").drop("last_mtime")


def recover_in_flight(in_flight: DataFrame, processed: DataFrame, pending: DataFrame, key: str = "path") -> DataFrame:
    """Work that was begun and not finished goes back to pending, before what waits there."""
    back = in_flight.join(processed.select(key), key, "left_anti").select(key, F.lit(0).alias("priority"))
    return back.unionByName(pending.select(key, F.lit(1).alias("priority"))).groupBy(key).agg(F.min("priority").alias("priority"))


def last_write(log: DataFrame, key: str = "k", order: tuple[str, ...] = ("put_at", "seq")) -> DataFrame:
    """The latest row of each key. Maxima combine map-side, so a key with very many writes costs one
    row a task."""
    cols = [c for c in log.columns if c != key]
    latest = F.max_by(F.struct(*cols), F.struct(*order)).alias("r")
    return log.groupBy(key).agg(latest).select(key, "r.*")


def current(log: DataFrame, as_of: Column) -> DataFrame:
    """View of a put log(k, v, put_at, seq, expires_at[, deleted]) at a time: last write wins,
    tombstones and expired keys are gone."""
    view = last_write(log.filter(F.col("put_at") <= as_of)).filter(not_expired(as_of))
    return view.filter(~F.coalesce("deleted", F.lit(False))) if "deleted" in log.columns else view


def puts(values: DataFrame, kind: str, at: Column, prefix: str = "", ttl_s: Column | int | None = None, default_ttl: bool = True) -> DataFrame:
    """Rows of a put log, (k, v, put_at, expires_at, deleted), of values(k, v): keys get the prefix and
    kind, v (a string, or any other type, as JSON) expires after ``ttl_s`` seconds, by default after
    the kind's time to live; without either it stays, and an earlier expiry ends."""
    ttl = F.lit(ttl_s).cast("long") if isinstance(ttl_s, int) or ttl_s is None else ttl_s
    v = F.col("v") if dict(values.dtypes)["v"] == "string" else encode_value("v")
    key = prefixed_key("k", F.lit(f"{prefix}:{kind}" if prefix else kind))
    when = at.cast("timestamp")
    return values.select(
        key.alias("k"), v.alias("v"), when.alias("put_at"), expires_at(when, ttl, DEFAULT_TTL.get(kind) if default_ttl else None).alias("expires_at"), F.lit(False).alias("deleted")
    )


def append(rows: DataFrame, path: str) -> None:
    """Append to a put log; a later row of a key replaces an earlier one in every view."""
    rows.write.mode("append").parquet(path)


def compact(log: DataFrame, as_of: Column, path: str) -> None:
    """The sweep: a new log of the keys that are alive at a time, one row each."""
    current(log, as_of).write.mode("errorifexists").parquet(path)


def error_puts(errors: DataFrame, state: DataFrame, at: Column, prefix: str = "") -> DataFrame:
    """Put rows of errors(item_id, error): each counts one retry more than the error that state(k, v)
    has for the item, 0 for its first."""
    key = prefixed_key("item_id", F.lit(f"{prefix}:errors" if prefix else "errors"))
    had = state.select(F.col("k").alias("_k"), F.from_json("v", "retry_count long")["retry_count"].alias("_n"))
    both = errors.withColumn("_key", key).join(had, F.col("_key") == F.col("_k"), "left")
    value = F.struct("item_id", "error", F.coalesce(F.col("_n") + 1, F.lit(0)).alias("retry_count"), F.date_format(at.cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss").alias("timestamp"))
    return puts(both.select(F.col("item_id").alias("k"), value.alias("v")), "errors", at, prefix)


def failed_items(state: DataFrame, max_retries: int = 3, prefix: str = "") -> DataFrame:
    """(item_id, error, retry_count) of the saved errors that may be tried again."""
    own = key_prefix(state, f"{prefix}:errors:" if prefix else "errors:")
    return own.select(F.from_json("v", "item_id string, error string, retry_count long").alias("e")).select("e.*").filter(F.col("retry_count") < max_retries)


def purge(state: DataFrame, as_of: Column) -> DataFrame:
    return state.filter(not_expired(as_of))


def get(keys: DataFrame, state: DataFrame, default: str | None = None) -> DataFrame:
    return keys.join(state.select("k", "v"), "k", "left").withColumn("v", F.coalesce("v", F.lit(default)))


def exists(keys: DataFrame, state: DataFrame) -> DataFrame:
    return keys.join(state.select("k", F.lit(True).alias("found")), "k", "left").withColumn("found", F.coalesce("found", F.lit(False)))


def delete(state: DataFrame, keys: DataFrame, at: Column) -> tuple[DataFrame, DataFrame]:
    """(tombstones to append, report (k, existed))."""
    report = exists(keys.select("k").distinct(), state).withColumnRenamed("found", "existed")
    gone = report.filter("existed").select("k", F.lit(None).cast("string").alias("v"), at.alias("put_at"), F.lit(True).alias("deleted"))
    return gone, report


def key_range(state: DataFrame, start: str, end: str | None = None, limit: int | None = None) -> DataFrame:
    """Keys in [start, end), in order."""
    out = state.filter(F.col("k") >= start)
    out = out if end is None else out.filter(F.col("k") < end)
    out = out.orderBy("k")
    return out if limit is None else out.limit(limit)


def key_prefix(state: DataFrame, prefix: str) -> DataFrame:
    return state.filter(F.col("k").startswith(prefix))


def merge_states(updates: DataFrame, key: str = "k", order: tuple[str, ...] = ("put_at", "seq")) -> DataFrame:
    """updates(k, state map, put_at, seq): later values win field by field; last_updated is the time
    of the last update. Works on (key, field) pairs, so no key's history meets in one task."""
    fields = updates.select(key, *order, F.explode("state").alias("field", "value"))
    last = fields.groupBy(key, "field").agg(F.max_by("value", F.struct(*order)).alias("value"))
    state = last.groupBy(key).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("field", "value")))).alias("state"))
    return state.join(updates.groupBy(key).agg(F.max("put_at").alias("last_updated")), key)


def attempts(errors: DataFrame, item: str = "item_id", order: tuple[str, ...] = ("ts",)) -> DataFrame:
    """Error rows with retry_count: 0 for an item's first error. No item's errors meet in one task."""
    return numbered(errors, item, list(order), "_nth").withColumn("retry_count", (F.col("_nth") - 1).cast("int")).drop("_nth")


def enqueue(items: DataFrame, order: list[str], ns: str = "ns", base: DataFrame | None = None) -> DataFrame:
    """Consecutive sequence numbers in each namespace, from ``base(ns, next_id)`` or 1.

    No namespace is sorted in one task.
    """
    out = numbered(items, ns, order)
    if base is not None:
        start = base.select(F.col(ns).alias("_ns"), F.col("next_id").alias("_next"))
        out = out.join(start, out[ns].eqNullSafe(start["_ns"]), "left").withColumn("seq", F.col("seq") + F.coalesce(F.col("_next") - 1, F.lit(0))).drop("_ns", "_next")
    return out


def take(pending: DataFrame, n: int, cap: int | None = None, order: str = "seq") -> DataFrame:
    """The first n rows (no more than ``cap``, where one is set)."""
    return pending.orderBy(order).limit(min(n, cap) if cap else n)


def dequeue(pending: DataFrame, n: int, key: str = "seq") -> tuple[DataFrame, DataFrame]:
    """(taken, left)."""
    taken = take(pending, n, order=key)
    return taken, pending.join(taken.select(key), key, "left_anti")


def sort_by_mtime(reverse: bool = False, nulls_last: bool = False) -> list[Column]:
    if reverse:
        return [F.col("mtime").desc_nulls_last() if nulls_last else F.col("mtime").desc_nulls_first(), F.col("ordinal")]
    return [F.col("mtime").asc_nulls_last(), F.col("ordinal")]


def sort_by_path(reverse: bool = False) -> list[Column]:
    return [F.col("path").desc_nulls_first() if reverse else F.col("path").asc_nulls_last()]


def queue_audit(items: DataFrame, counters: DataFrame) -> DataFrame:
    """items(ns, seq) against counters(ns, next_id, size): what each should be, and whether it is."""
    real = items.groupBy("ns").agg(F.min("seq").alias("min_id"), F.max("seq").alias("max_id"), F.count("*").alias("n"))
    both = real.join(counters, "ns", "full_outer").withColumn("n", F.coalesce("n", F.lit(0)))
    right_next = F.coalesce(F.col("max_id") + 1, F.col("next_id"), F.lit(1))
    return both.select(
        "ns", "min_id", "max_id", "n", "next_id", "size", right_next.alias("fixed_next_id"), F.col("n").alias("fixed_size"),
        (F.coalesce(F.col("next_id") - F.col("size"), F.lit(1))).alias("expected_start"),
        (F.coalesce(F.col("next_id") == right_next, F.lit(False)) & F.coalesce(F.col("size") == F.col("n"), F.lit(False))).alias("consistent"),
    )

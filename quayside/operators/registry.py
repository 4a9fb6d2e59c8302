"""Named strategies: functions from parameters to a Column, sort order or transform, validated early."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..plans import requests
from ..sources import files
from ..streaming.streams import interval_due, next_due
from . import filters, state


class Registry:
    def __init__(self):
        self._made: dict[str, tuple[Callable, Callable]] = {}

    def register(self, name: str, make: Callable, validate: Callable[[dict], None] = lambda params: None) -> None:
        if name in self._made:
            raise ValueError(f"{name!r} is registered already")
        self._made[name] = (make, validate)

    def create(self, name: str, params: dict | None = None):
        if name not in self._made:
            raise ValueError(f"unknown strategy {name!r}; known: {', '.join(sorted(self._made))}")
        make, validate = self._made[name]
        validate(params or {})
        return make(**(params or {}))

    def names(self) -> list[str]:
        return sorted(self._made)


def needs(*required: str, optional: tuple[str, ...] = ()) -> Callable[[dict], None]:
    def check(params: dict) -> None:
        if missing := [k for k in required if k not in params]:
            raise ValueError(f"missing parameters: {', '.join(missing)}")
        if unknown := [k for k in params if k not in (*required, *optional)]:
            raise ValueError(f"unknown parameters: {', '.join(unknown)}")

    return check


def column_filter(predicate, on_columns: bool = True) -> Callable[[str], Column]:
    """A user's filter: a function of a Column, or (``on_columns`` false; a pandas UDF) of a string."""

    def build(name: str) -> Column:
        if on_columns:
            return predicate(F.col(name))
        return F.pandas_udf(lambda s: s.map(predicate).astype(bool), T.BooleanType())(F.col(name))

    return build


def default_registry() -> Registry:
    r = Registry()
    r.register("pattern_filter", lambda pattern, case_sensitive=True: lambda name: filters.glob(name, pattern, case_sensitive), needs("pattern", optional=("case_sensitive",)))
    r.register("date_filter", lambda start_date: lambda name: filters.any_date_from(name, start_date), needs("start_date"))
    r.register("first_date_filter", lambda start_date: lambda name: filters.first_date_from(name, start_date), needs("start_date"))

    def both(filters_, operation="AND"):
        made = [r.create(f["type"], {k: v for k, v in f.items() if k != "type"}) for f in filters_]
        return lambda name: filters.composite([m(name) for m in made], operation)

    r.register("composite_filter", lambda **p: both(p["filters"], p.get("operation", "AND")), needs("filters", optional=("operation",)))
    # sources of rows: functions of a session
    r.register("directory_listing", lambda path, recursive=True: lambda spark: files.list_files(spark, path, recursive), needs("path", optional=("recursive",)))
    r.register("file_loader", lambda path: lambda spark: files.read_files(spark, path), needs("path"))
    r.register("url_list", lambda urls: lambda spark: files.url_list(spark, urls), needs("urls"))
    r.register("landed_pages", lambda path: lambda spark: files.landed_pages(spark, path), needs("path"))
    # gates: functions of the last run's time, to the time of the next
    r.register("daily_gate", lambda time_of_day, tz="UTC": lambda last: next_due(last, time_of_day, tz), needs("time_of_day", optional=("tz",)))
    r.register("interval_gate", lambda interval_s, jitter_s=0: lambda last: interval_due(last, interval_s, jitter_s), needs("interval_s", optional=("jitter_s",)))
    # plans: how broad searches are narrowed, and when a search has a next page
    r.register("prefix_narrowing", lambda: requests.narrowed, needs())
    r.register("cursor_pages", lambda max_records=20_000: lambda asked, pages: requests.next_requests(asked, pages, max_records), needs(optional=("max_records",)))
    r.register("mtime_sort", state.sort_by_mtime, needs(optional=("reverse", "nulls_last")))
    r.register("path_sort", state.sort_by_path, needs(optional=("reverse",)))
    return r


def select_files(listing: DataFrame, keep: Column, order: list[Column], known: DataFrame | None = None, cap: int | None = None) -> DataFrame:
    """Filter, leave out what is known, sort, cap: one declarative plan."""
    out = listing.filter(keep)
    if known is not None:
        out = state.unprocessed(out, known)
    out = out.orderBy(*order)
    return out.limit(cap) if cap else out

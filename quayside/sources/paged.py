"""Paged APIs as a Python data source: searches are planned by day and prefix, filters on these reach the
planning, and pages come in batches or as a stream that resumes inside a search. The transport is
passed in; ``transport(url, cursor)`` gives (status, body) and runs on the executors."""

from __future__ import annotations

import base64
import datetime as dt
import json
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import datasource as ds
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, Filter, InputPartition

SCHEMA = "day date, prefix string, url string, cursor string, status int, body string"
Transport = Callable[[str, str], tuple[int, str]]


class Search(InputPartition):
    """One search: where it belongs, its URL, and the cursor it starts from."""

    def __init__(self, day: dt.date | None, prefix: str | None, url: str, cursor: str | None = None):
        self.day, self.prefix, self.url, self.cursor = day, prefix, url, cursor

    def named(self) -> str:
        return f"{self.day}/{self.prefix}/{self.url}"


def next_cursor(status: int, body: str) -> str | None:
    """The cursor after a page: none if the page failed, has no records or names none."""
    try:
        page = json.loads(body) if status == 200 else {}
    except ValueError:
        page = {}
    head = page.get("header") or page
    return (head.get("curseurSuivant") or page.get("curseurSuivant") or None) if head.get("nombre") else None


def walk(search: Search, fetch: Transport, limit: int = 0) -> Iterator[tuple[tuple, str | None]]:
    """(page, next cursor) of a search from its cursor on, as they are fetched; a cursor that comes again ends it.
    More than ``limit`` pages, if set, are an error."""
    cursor, seen = search.cursor or "*", set()
    while cursor and cursor not in seen:
        if limit and len(seen) == limit:
            raise RuntimeError(f"{search.url} has pages beyond the limit of {limit}")
        seen.add(cursor)
        status, body = fetch(search.url, cursor)
        after = next_cursor(status, body)
        yield (search.day, search.prefix, search.url, cursor, status, body), after
        cursor = after


# ---------------------------------------------------------------- which searches


class Wanted:
    """What pushed filters leave of the days and prefixes."""

    def __init__(self) -> None:
        self.rules: list[tuple[str, str, object]] = []

    KINDS = {
        ds.EqualTo: "eq", ds.EqualNullSafe: "same", ds.In: "in", ds.GreaterThan: "gt", ds.GreaterThanOrEqual: "ge",
        ds.LessThan: "lt", ds.LessThanOrEqual: "le", ds.StringStartsWith: "starts", ds.IsNotNull: "some", ds.IsNull: "none",
    }

    def take(self, f: Filter) -> bool:
        """Whether the filter is one on day or prefix, which then holds for every row that is read."""
        kind, column = self.KINDS.get(type(f)), getattr(f, "attribute", None)
        if kind is None or column not in (("day",), ("prefix",)):
            return False
        self.rules.append((column[0], kind, getattr(f, "value", None)))
        return True

    def keeps(self, column: str, value: object) -> bool:
        for name, kind, x in self.rules:
            if name != column:
                continue
            if value is None:
                if not (kind == "none" or kind == "same" and x is None):
                    return False
            elif not {
                "eq": lambda: value == x, "same": lambda: value == x, "in": lambda: value in x, "gt": lambda: value > x, "ge": lambda: value >= x,
                "lt": lambda: value < x, "le": lambda: value <= x, "starts": lambda: value.startswith(x), "some": lambda: True, "none": lambda: False,
            }[kind]():
                return False
        return True


def planned(options: dict, wanted: Wanted) -> Iterator[Search]:
    """The searches of the options that are wanted: listed ones, or one for each day from ``start`` to ``end`` and each prefix."""
    if "searches" in options:
        for s in json.loads(options["searches"]):
            day = dt.date.fromisoformat(s["day"]) if s.get("day") else None
            if wanted.keeps("day", day) and wanted.keeps("prefix", s.get("prefix")):
                yield Search(day, s.get("prefix"), s["url"], s.get("cursor"))
        return
    prefixes = [p for p in json.loads(options.get("prefixes", "[null]")) if wanted.keeps("prefix", p)]
    day, end = dt.date.fromisoformat(options["start"]), dt.date.fromisoformat(options["end"])
    while day <= end:
        if wanted.keeps("day", day):
            for p in prefixes:
                yield Search(day, p, options["url"].format(day=day.isoformat(), prefix=p or ""))
        day += dt.timedelta(days=1)


class PagedReader(DataSourceReader):
    """One partition a search."""

    def __init__(self, options: dict):
        self.options, self.wanted = options, Wanted()

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        for f in filters:
            if not self.wanted.take(f):
                yield f

    def partitions(self) -> list[InputPartition]:
        return list(planned(self.options, self.wanted)) or [InputPartition(None)]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        if isinstance(partition, Search):
            fetch = cloudpickle.loads(base64.b64decode(self.options["transport"]))
            for page, _ in walk(partition, fetch, int(self.options.get("max_pages", 0))):
                yield page


# ---------------------------------------------------------------- streams


class Share(InputPartition):
    """Some of the searches in one round of a stream."""

    def __init__(self, number: int, after: int, searches: list[Search]):
        self.number, self.after, self.searches = number, after, searches


class PagedStream(DataSourceStreamReader):
    """Pages as a stream. In each round every search goes on for up to ``round_pages`` pages, all searches side by side in
    ``shares`` tasks. The offset is the number of rounds; each share writes, under ``state`` in the shared folder, where its
    searches stand after the round as (day, prefix, cursor). A round that is run again reads where the one
    before it ended, so it gives the same pages; a stream that stops goes on inside its searches."""

    def __init__(self, options: dict):
        self.options = options
        self.searches = list(planned(options, Wanted()))
        self.shares = max(1, min(int(options.get("shares", 8)), len(self.searches)))

    def _place(self) -> tuple:
        from pyarrow import fs

        return fs.FileSystem.from_uri(self.options["state"])

    def _standing(self, rounds: int, share: int) -> dict | None:
        """Where a share's searches stood after so many rounds: a cursor each, null where one has ended."""
        files, root = self._place()
        try:
            with files.open_input_stream(f"{root}/{rounds}/{share}.json") as f:
                return {s["search"]: s["cursor"] for s in json.loads(f.read())}
        except FileNotFoundError:
            return None

    def _last(self) -> tuple[int, bool]:
        """(rounds that all shares have ended, whether any search has pages left)."""
        from pyarrow import fs

        files, root = self._place()
        found = files.get_file_info(fs.FileSelector(root, allow_not_found=True))
        for rounds in sorted((int(f.base_name) for f in found if f.base_name.isdigit()), reverse=True):
            states = [self._standing(rounds, k) for k in range(self.shares)]
            if all(s is not None for s in states):
                return rounds, any(c is not None for s in states for c in s.values())
        return 0, bool(self.searches)

    def initialOffset(self) -> dict:
        return {"rounds": 0}

    def latestOffset(self) -> dict:
        rounds, more = self._last()
        return {"rounds": rounds + more}

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        return [Share(k, r, self.searches[k :: self.shares]) for r in range(start["rounds"], end["rounds"]) for k in range(self.shares)]

    def read(self, partition: Share) -> Iterator[tuple]:
        fetch = cloudpickle.loads(base64.b64decode(self.options["transport"]))
        most, stands = int(self.options.get("round_pages", 10)), []
        known = self._standing(partition.after, partition.number) if partition.after else {}
        if known is None:
            raise RuntimeError(f"round {partition.after} of share {partition.number} has left no state")
        for s in partition.searches:
            cursor = known.get(s.named(), s.cursor or "*")
            if cursor is not None:
                for n, (page, after) in enumerate(walk(Search(s.day, s.prefix, s.url, cursor), fetch), 1):
                    yield page
                    cursor = after if after != cursor else None
                    if n == most:
                        break
            stands.append({"search": s.named(), "day": s.day and s.day.isoformat(), "prefix": s.prefix, "cursor": cursor})
        files, root = self._place()
        folder = f"{root}/{partition.after + 1}"
        files.create_dir(folder, recursive=True)
        with files.open_output_stream(f"{folder}/{partition.number}.new") as f:
            f.write(json.dumps(stands).encode())
        files.move(f"{folder}/{partition.number}.new", f"{folder}/{partition.number}.json")

    def commit(self, end: dict) -> None:
        """Rounds before the last but one are read by nothing any more."""
        files, root = self._place()
        if end["rounds"] > 1:
            from pyarrow import fs

            old = f"{root}/{end['rounds'] - 2}"
            if files.get_file_info(old).type == fs.FileType.Directory:
                files.delete_dir(old)


class PagedApi(DataSource):
    @classmethod
    def name(cls) -> str:
        return "quayside_paged"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return PagedReader(dict(self.options))

    def streamReader(self, schema) -> DataSourceStreamReader:
        return PagedStream(dict(self.options))


def _options(spark: SparkSession, transport: Transport, **options: object) -> dict[str, str]:
    spark.dataSource.register(PagedApi)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    packed = base64.b64encode(cloudpickle.dumps(transport)).decode()
    return {"transport": packed} | {k: str(v) for k, v in options.items() if v is not None}


def _planned(url: str, start: dt.date, end: dt.date, prefixes: list[str] | None) -> dict[str, object]:
    return {"url": url, "start": start.isoformat(), "end": end.isoformat(), "prefixes": json.dumps(prefixes or [None])}


def read_paged(spark: SparkSession, searches: list[dict], transport: Transport, max_pages: int = 0) -> DataFrame:
    """Pages, (day, prefix, url, cursor, status, body), of a few listed searches ({url, cursor, day, prefix}; all but the url may
    be absent). A search with more than ``max_pages``, if set, is an error."""
    return spark.read.format("quayside_paged").options(**_options(spark, transport, searches=json.dumps(searches), max_pages=max_pages)).load()


def read_days(spark: SparkSession, url: str, start: dt.date, end: dt.date, transport: Transport, prefixes: list[str] | None = None, max_pages: int = 0) -> DataFrame:
    """Pages of a search for each day from ``start`` to ``end`` (and each prefix); ``url`` has places for ``{day}`` and
    ``{prefix}``. Filters on day and prefix are pushed: other searches are not planned, so never fetched."""
    options = _options(spark, transport, max_pages=max_pages, **_planned(url, start, end, prefixes))
    return spark.read.format("quayside_paged").options(**options).load()


def stream_days(
    spark: SparkSession, url: str, start: dt.date, end: dt.date, transport: Transport, state: str, prefixes: list[str] | None = None, round_pages: int = 10, shares: int = 8
) -> DataFrame:
    """The pages of ``read_days`` as a stream that resumes inside its searches; ``state`` is a folder (a URI) that driver and
    executors share. All options must stay the same when it resumes."""
    options = _options(spark, transport, state=state, round_pages=round_pages, shares=shares, **_planned(url, start, end, prefixes))
    return spark.readStream.format("quayside_paged").options(**options).load()


def walk_searches(searches: DataFrame, transport: Transport, max_pages: int = 0) -> DataFrame:
    """Pages of the searches(day, prefix, url, cursor) of a table, each walked by the task that reads its row, so there
    is no limit to their number; filter the table, and only what is left is fetched."""
    arrow = pa.schema([("day", pa.date32()), ("prefix", pa.string()), ("url", pa.string()), ("cursor", pa.string()), ("status", pa.int32()), ("body", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                for page, _ in walk(Search(row["day"], row["prefix"], row["url"], row["cursor"]), transport, max_pages):
                    yield pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(page, arrow, strict=True)], schema=arrow)

    return searches.select("day", "prefix", "url", "cursor").mapInArrow(run, SCHEMA)

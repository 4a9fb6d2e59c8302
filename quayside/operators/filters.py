"""Predicates on listings, plans, responses and state, as Columns."""

from __future__ import annotations

import functools
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.names import BID_PATTERN


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def glob_regex(pattern: str) -> str:
    """A Java pattern for ``* ? [seq] [!seq]``, matching the whole name."""
    out, i = [], 0
    while i < len(pattern):
        ch = pattern[i]
        i += 1
        if ch == "*":
            out.append(".*")
        elif ch == "?":
            out.append(".")
        elif ch == "[":
            end = pattern.find("]", i + 1 + (pattern[i : i + 1] == "!"))
            if end < 0:
                out.append(r"\[")
                continue
            body, i = pattern[i:end], end + 1
            negated, body = body[:1] == "!", body.removeprefix("!")
            body = re.sub(r"([\\\[\]&^~|])", r"\\\1", body)
            out.append(f"[{'^' if negated else ''}{body}]")
        else:
            out.append(re.sub(r"([^A-Za-z0-9_ ])", r"\\\1", ch))
    return r"(?s)\A" + "".join(out) + r"\z"


def glob(name, pattern: str, case_sensitive: bool = True) -> Column:
    if not isinstance(pattern, str) or not pattern:
        raise ValueError("pattern must be a non-empty string")
    if case_sensitive:
        return _c(name).rlike(glob_regex(pattern))
    return F.lower(_c(name)).rlike(glob_regex(pattern.lower()))


def _start(start_date: str) -> str:
    if not re.fullmatch(r"[0-9]{8}", start_date):
        raise ValueError("start_date must be yyyymmdd")
    return start_date


def any_date_from(name, start_date: str) -> Column:
    """Some window of 8 digits in the name is at least the start date."""
    n = _c(name)
    windows = F.transform(F.sequence(F.lit(1), F.greatest(F.length(n) - 7, F.lit(1))), lambda i: F.substr(n, i, F.lit(8)))
    return F.coalesce(F.exists(windows, lambda w: w.rlike(r"^[0-9]{8}\z") & (w >= _start(start_date))), F.lit(False))


def first_date_from(name, start_date: str) -> Column:
    """The first 8 digits in a row are at least the start date."""
    d = F.regexp_extract(_c(name), r"([0-9]{8})", 1)
    return F.coalesce((d != "") & (d >= _start(start_date)), F.lit(False))


def composite(filters: list[Column], operation: str = "AND") -> Column:
    op = operation.upper()
    if op not in ("AND", "OR"):
        raise ValueError(f"unknown operation {operation!r}")
    join, seed = (lambda a, b: a & b, True) if op == "AND" else (lambda a, b: a | b, False)
    return functools.reduce(join, filters, F.lit(seed))


def by_status(df: DataFrame, accepted: Column) -> tuple[DataFrame, DataFrame]:
    """(accepted, rejected) responses; a null verdict rejects."""
    ok = F.coalesce(accepted, F.lit(False))
    return df.filter(ok), df.filter(~ok)


def validated_refs(df: DataFrame) -> DataFrame:
    """df(bid, request_meta, meta, ...) with ``request_meta`` (the legacy ``meta`` if absent) and
    ``reason``: null for a good reference, else why it goes to quarantine."""
    legacy = F.col("meta") if "meta" in df.columns else F.lit(None).cast("map<string,string>")
    m = F.coalesce("request_meta", legacy)
    reason = (
        F.when(F.col("bid").isNull(), "missing bid").when(~F.col("bid").rlike(BID_PATTERN), "malformed bid").when(m.isNull(), "missing request_meta")
    )
    return df.withColumn("reason", reason).withColumn("request_meta", m).drop("meta")


def not_expired(as_of, expires="expires_at") -> Column:
    return _c(expires).isNull() | (_c(as_of) <= _c(expires))


def may_retry(max_retries: int = 3, count="retry_count") -> Column:
    return _c(count) < max_retries


def more_pages(total, cursor, count, max_records: int = 20_000) -> Column:
    """The chain goes on: the search is narrow enough, and there is a cursor and a record."""
    t, n = F.coalesce(_c(total), F.lit(0)), F.coalesce(_c(count), F.lit(0))
    return (t <= max_records) & (F.coalesce(_c(cursor), F.lit("")) != "") & (n > 0)


def too_broad(total, max_records: int = 20_000) -> Column:
    return F.coalesce(_c(total), F.lit(0)) > max_records

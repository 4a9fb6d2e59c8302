"""Request plans for paged APIs: days, prefixes, cursors, pages, resume."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.names import query_string, registry_query
from ..operators.filters import more_pages, too_broad
from ..schemas import PAGE
from ..shared import written

PREFIXES = 100


def day_plan(spark: SparkSession, start: dt.date, end: dt.date | None = None, reverse: bool = False, as_of: dt.date | None = None) -> DataFrame:
    """(ordinal, day, cursor): a row a day, both ends included; without an end up to ``as_of`` or
    today (UTC). Every day starts at cursor ``*``."""
    last = end or as_of or dt.datetime.now(dt.UTC).date()
    if last < start:
        return spark.createDataFrame([], "ordinal int, day date, cursor string")
    a, b, step = (F.lit(last), F.lit(start), -1) if reverse else (F.lit(start), F.lit(last), 1)
    days = F.sequence(a.cast("date"), b.cast("date"), F.expr(f"interval {step} day"))
    return spark.range(1).select(F.posexplode(days).alias("ordinal", "day")).withColumn("cursor", F.lit("*"))


def narrowed(plan: DataFrame, totals: DataFrame, max_records: int = 20_000) -> DataFrame:
    """Days whose search is too broad give a row for each prefix 00..99, others one row without."""
    t = plan.join(totals.groupBy("day").agg(F.max("total").alias("total")), "day", "left")
    wide = t.filter(too_broad("total", max_records)).drop("total")
    wide = wide.select("*", F.explode(F.sequence(F.lit(0), F.lit(PREFIXES - 1))).alias("n"))
    wide = wide.withColumn("prefix", F.lpad(F.col("n").cast("string"), 2, "0")).drop("n")
    rest = t.filter(~too_broad("total", max_records)).drop("total").withColumn("prefix", F.lit(None).cast("string"))
    return wide.unionByName(rest)


def prefix_tree(days: DataFrame, totals_of: Callable[[DataFrame], DataFrame], max_records: int = 20_000, length: int = 9, alphabet: str = "0123456789", broad_ids: bool = False) -> DataFrame:
    """(day, prefix, total), written: the days whose total is within the limit with a null prefix, and of the others the shortest
    prefixes that are. ``totals_of`` gives (day, prefix, total) of searches(day, prefix); searches without a total, or with 0,
    have nothing to fetch and give no row.

    The tree is split level by level: one round of searches (or one aggregation, see ``counted``) for all prefixes of
    one length that are still too broad, of all days together, so it takes no more rounds than ids have signs. A whole id that is
    still too broad cannot be narrowed: an error, or with ``broad_ids`` a row like others, whose total tells that it is too broad.
    Prefixes that have less than the one they split (ids that are shorter, or have other signs) would lose records: an error.
    """
    signs = F.array(*[F.lit(c) for c in alphabet])
    todo, leaves, due = days.select("day", F.lit(None).cast("string").alias("prefix")).distinct(), None, 0
    for size in range(length + 1):
        level = written(totals_of(todo).select("day", "prefix", F.col("total").cast("long").alias("total")).filter("total > 0"), "level")
        have, wide = level.agg(F.coalesce(F.sum("total"), F.lit(0)), F.coalesce(F.sum(F.when(too_broad("total", max_records), F.col("total"))), F.lit(0))).first()
        if have < due:
            raise RuntimeError(f"prefixes of {size} signs have {have} of the {due} records of those they split")
        due = wide
        if size == length and broad_ids:
            return written(level if leaves is None else leaves.unionByName(level), "leaves")
        fits = level.filter(~too_broad("total", max_records))
        leaves = fits if leaves is None else leaves.unionByName(fits)
        broad = level.filter(too_broad("total", max_records))
        if not broad.take(1):
            return written(leaves, "leaves")
        if size == length:
            raise RuntimeError(f"ids of {length} signs have more than {max_records} records")
        todo = broad.select("day", F.explode(signs).alias("sign"), "prefix").select("day", F.concat(F.coalesce("prefix", F.lit("")), "sign").alias("prefix"))
    raise AssertionError("not reached")


def counted(ids: DataFrame) -> Callable[[DataFrame], DataFrame]:
    """The totals of a table of ids(day, id), for ``prefix_tree``: prefixes are counted before they are joined."""

    def totals(searches: DataFrame) -> DataFrame:
        size = F.length(F.coalesce("prefix", F.lit("")))
        n = searches.agg(F.max(size)).first()[0] or 0  # a level's prefixes have one length
        per = ids.groupBy("day", F.substring("id", 1, n).alias("_p")).agg(F.count("*").alias("total")) if n else ids.groupBy("day", F.lit("").alias("_p")).agg(F.count("*").alias("total"))
        return searches.withColumn("_p", F.coalesce("prefix", F.lit(""))).join(per, ["day", "_p"]).select("day", "prefix", "total")

    return totals


def next_prefix(prefix) -> Column:
    """The prefix after this one: ``00`` after none, ``99`` is the last; a longer prefix that ends in 9
    loses that digit before it counts up. Leading zeros are kept."""
    p = F.col(prefix) if isinstance(prefix, str) else prefix

    def up(c: Column) -> Column:
        n = (c.cast("long") + 1).cast("string")
        return F.lpad(n, F.greatest(F.length(c), F.length(n)), "0")

    shorter = F.substr(p, F.lit(1), F.length(p) - 1)
    return (
        F.when(p.isNull() | (p == ""), "00").when(p == "99", p)
        .when((F.length(p) > 2) & p.endswith("9"), up(shorter)).otherwise(up(p))
    )


def with_url(plan: DataFrame, base_url: str, max_records: int = 1000, query: Column | None = None, extra: Column | None = None) -> DataFrame:
    narrowing = F.concat(F.lit("siren:"), F.col("prefix")) if "prefix" in plan.columns else None
    q = registry_query("day", narrowing) if query is None else query
    params = {"nombre": F.lit(max_records), "curseur": F.col("cursor"), "q": q}
    return plan.withColumn("max_records", F.lit(max_records)).withColumn("url", F.concat(F.lit(base_url + "?"), query_string(params, extra)))


def resumed(plan: DataFrame, saved_day: dt.date | None, processed: DataFrame | None = None, reverse: bool = False) -> DataFrame:
    """Days from the saved position on, without URLs that were processed."""
    if saved_day is not None:
        plan = plan.filter(F.col("day") <= saved_day) if reverse else plan.filter(F.col("day") >= saved_day)
    return plan if processed is None else plan.join(processed.select("url"), "url", "left_anti")


def kept_days(plan: DataFrame, keep: Column | Callable[[str], bool]) -> DataFrame:
    """The plan's days that a filter keeps: a Column, or a function of ``yyyy-MM-dd``. A plan has few
    distinct days, so a function is called once for each of them, in tasks."""
    if isinstance(keep, Column):
        return plan.filter(F.coalesce(keep, F.lit(False)))
    days = plan.select("day").distinct()
    good = F.pandas_udf(lambda s: s.map(keep).astype(bool), "boolean")
    return plan.join(days.filter(good(F.date_format("day", "yyyy-MM-dd"))), "day", "left_semi")


def resumed_at(plan: DataFrame, day: dt.date, prefix: str | None = None, cursor: str | None = None, reverse: bool = False) -> DataFrame:
    """A plan(day, prefix, cursor) from a saved position on: days after it whole, the position's day
    from its prefix on (rows without prefix come first), and its own search from the saved cursor."""
    later = F.col("day") < F.lit(day) if reverse else F.col("day") > F.lit(day)
    here = F.col("day") == F.lit(day)
    at = F.col("prefix").eqNullSafe(F.lit(prefix).cast("string"))
    rest = F.lit(True) if prefix is None else F.coalesce(F.col("prefix") >= prefix, F.lit(False))
    return plan.filter(later | (here & rest)).withColumn("cursor", F.when(here & at & F.lit(cursor is not None), F.lit(cursor)).otherwise(F.col("cursor")))


def complex_plan(
    spark: SparkSession, start: dt.date, end: dt.date | None, totals: DataFrame, base_url: str, *, reverse: bool = False, as_of: dt.date | None = None, max_records: int = 20_000,
    page_size: int = 1000, keep: Column | Callable[[str], bool] | None = None, narrow: Callable[[DataFrame, DataFrame, int], DataFrame] = narrowed,
    query: Callable[[DataFrame], Column] | None = None, position: tuple[dt.date, str | None, str | None] | None = None, processed: DataFrame | None = None,
) -> DataFrame:
    """Days, narrowed where their totals(day, total) are too broad, each with its URL: (ordinal, day,
    prefix, cursor, url, max_records). ``keep`` filters days, ``narrow`` and ``query`` replace the
    narrowing and the search, ``position`` is where an earlier run stopped, processed(url) is left out."""
    plan = day_plan(spark, start, end, reverse, as_of)
    plan = plan if keep is None else kept_days(plan, keep)
    plan = narrow(plan, totals, max_records)
    plan = plan if position is None else resumed_at(plan, *position, reverse=reverse)
    plan = with_url(plan, base_url, page_size, None if query is None else query(plan))
    return plan if processed is None else plan.join(processed.select("url"), "url", "left_anti")


def parsed_pages(pages: DataFrame) -> DataFrame:
    """pages(..., body) with total, count, next_cursor and the parsed page."""
    p = F.from_json("body", PAGE)
    out = pages.withColumn("page", p)
    cursor = F.coalesce("page.header.curseurSuivant", "page.curseurSuivant")
    return out.select(
        *pages.columns, F.coalesce("page.header.total", "page.total").alias("total"), F.coalesce("page.header.nombre", "page.nombre").alias("count"),
        F.when(cursor != "", cursor).alias("next_cursor"), "page",
    )


def entities(pages: DataFrame) -> DataFrame:
    """A row for each establishment of each entity (entities without any keep one row)."""
    units = parsed_pages(pages).select("day", F.explode("page.unitesLegales").alias("u"))
    return units.select("day", F.col("u.siren").alias("siren"), F.col("u.denominationUniteLegale").alias("name"), F.explode_outer("u.etablissements").alias("e")).select(
        "day", "siren", "name", F.col("e.siret").alias("siret"), F.col("e.codePostalEtablissement").alias("postcode")
    )


def next_requests(requests: DataFrame, pages: DataFrame, max_records: int = 20_000) -> DataFrame:
    """Requests for the pages after landed ones; pages(day, prefix, total, count, next_cursor)."""
    on = pages.filter(more_pages("total", "next_cursor", "count", max_records)).select("day", "prefix", "next_cursor")
    same = (requests.day == on.day) & requests.prefix.eqNullSafe(on.prefix)
    return requests.join(on, same, "left_semi").drop("cursor").dropDuplicates(["day", "prefix"]).join(
        on.select(F.col("day").alias("d"), F.col("prefix").alias("p"), F.col("next_cursor").alias("cursor")),
        (F.col("day") == F.col("d")) & F.col("prefix").eqNullSafe(F.col("p")),
    ).drop("d", "p")


def crawl(plan: DataFrame, fetch: Callable[[DataFrame], DataFrame], land: Callable[[DataFrame], DataFrame], max_rounds: int = 10_000) -> DataFrame:
    """Follow cursors until no search has a next page. ``fetch`` turns requests into pages(day,
    prefix, cursor, body); ``land`` stores a round's parsed pages and returns them as stored. Each
    round is one Spark job over all searches; the driver sees only whether any is left. Pages that are
    left after ``max_rounds`` are an error; what was landed is stored."""
    landed, todo = None, plan
    for _ in range(max_rounds):
        pages = land(parsed_pages(fetch(todo)).drop("page"))
        landed = pages if landed is None else landed.unionByName(pages)
        todo = next_requests(todo, pages)
        if not todo.take(1):
            return landed
    raise RuntimeError(f"searches have next pages after {max_rounds} rounds")


def cursor_chain(pages: DataFrame, root: Column, max_depth: int | None = None) -> DataFrame:
    """pages(chain, cursor, next_cursor) followed from each chain's root: (chain, cursor, depth,
    cyclic). A cursor met again is marked and not followed; rows that are equal count once. A walk
    that goes beyond ``max_depth``, if given, is an error.

    Pointers double: after k rounds a walk has the pages of its first 2**k steps, and each page
    knows the one 2**k steps on, so a chain of n pages takes log2(n) rounds of joins, each written.
    Where a page has several next cursors, a recursive query follows all branches; it fails where
    it meets its limit of levels (``max_depth`` or 1000) or Spark's of rows.
    """
    pages = pages.select("chain", "cursor", "next_cursor", F.coalesce(root, F.lit(False)).alias("is_root"))
    once = pages.select("chain", "cursor", "next_cursor").distinct()
    if once.groupBy("chain", "cursor").count().filter("count > 1").take(1):
        return _branches(pages.distinct(), 1000 if max_depth is None else max_depth)
    landed = once.select("chain", F.col("cursor").alias("far")).distinct()
    first = written(once.withColumnRenamed("next_cursor", "far").join(landed, ["chain", "far"]).select("chain", "cursor", "far"), "steps")
    walk = pages.filter("is_root").select("chain", F.col("cursor").alias("root"), "cursor", F.lit(0).cast("long").alias("depth")).distinct()
    walk, step, length = written(walk, "walk"), first, 1

    def on(t: DataFrame, s: DataFrame) -> Column:
        return (t.chain == s.chain) & t.cursor.eqNullSafe(s.cursor)  # a first page may have no cursor

    while True:
        s = step.alias("s")
        ahead = walk.join(s, on(walk, step)).select(walk.chain, "root", F.col("s.far").alias("cursor"), (F.col("depth") + length).alias("depth"))
        ahead = ahead.groupBy("chain", "root", "cursor").agg(F.min("depth").alias("depth"))
        known = walk.select("chain", F.col("root").alias("r"), F.col("cursor").alias("c"))
        same = (ahead.chain == known.chain) & ahead.root.eqNullSafe(known.r) & (ahead.cursor == known.c)
        new = written(ahead.join(known, same, "left_anti"), "ahead")
        if not new.take(1):
            break
        walk, length = written(walk.unionByName(new), "walk"), 2 * length
        far = step.select("chain", F.col("cursor").alias("far"), F.col("far").alias("farther"))
        step = written(step.join(far, ["chain", "far"]).select("chain", "cursor", F.col("farther").alias("far")), "steps")
    # a walk's last page has no landed next page, or one that was met before
    last = walk.groupBy("chain", "root").agg(F.max(F.struct("depth", "cursor")).alias("m")).select("chain", F.col("m.cursor").alias("cursor"), F.col("m.depth").alias("depth"))
    again = last.join(first.alias("s"), on(last, first)).select(last.chain, F.col("s.far").alias("cursor"), (F.col("depth") + 1).alias("depth"), F.lit(True).alias("cyclic"))
    out = walk.select("chain", "cursor", "depth", F.lit(False).alias("cyclic")).unionByName(again)
    if max_depth is not None and out.filter(F.col("depth") > max_depth).take(1):
        raise RuntimeError(f"a chain goes on beyond {max_depth} steps")
    return out.withColumn("depth", F.col("depth").cast("int"))


def _branches(pages: DataFrame, max_depth: int) -> DataFrame:
    spark = pages.sparkSession
    limit = "spark.sql.cteRecursionLevelLimit"
    before = spark.conf.get(limit, None)
    spark.conf.set(limit, str(max_depth + 1))
    try:
        walk = spark.sql("""
        WITH RECURSIVE walk(chain, cursor, next_cursor, depth, seen, cyclic) AS (
          SELECT chain, cursor, next_cursor, 0, array(cursor), false FROM {pages} WHERE is_root
          UNION ALL
          SELECT p.chain, p.cursor, p.next_cursor, w.depth + 1, array_append(w.seen, p.cursor), array_contains(w.seen, p.cursor)
          FROM walk w JOIN {pages} p ON p.chain = w.chain AND p.cursor = w.next_cursor
          WHERE NOT w.cyclic)
        SELECT chain, cursor, depth, cyclic FROM walk""", pages=pages)
        return written(walk, "walk")  # under this limit
    finally:
        spark.conf.unset(limit) if before is None else spark.conf.set(limit, before)


def gaps(observed: DataFrame, start: Column | None = None, end: Column | None = None) -> DataFrame:
    """Days between the first and last (or the given) day that were not observed."""
    span = observed.agg(F.min("day").alias("lo"), F.max("day").alias("hi")).filter("lo is not null")
    lo = F.col("lo") if start is None else start
    hi = F.col("hi") if end is None else end
    days = span.select(F.explode(F.sequence(lo, hi)).alias("day"))
    return days.join(observed.select("day").distinct(), "day", "left_anti")


def failed_replay(template: DataFrame, failed: DataFrame, succeeded: DataFrame, key: str = "item_id") -> DataFrame:
    again = failed.select(key).distinct().join(succeeded.select(key), key, "left_anti")
    return template.join(again, key, "left_semi")

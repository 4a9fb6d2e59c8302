"""Connected components of a link table, as DataFrame rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, written


def components(links: DataFrame, max_rounds: int = 60) -> DataFrame:
    """``links(a long, b long)`` -> ``(node long, root long)``, written: the smallest node reachable.

    Each round hangs every node's neighbours, then its smaller neighbours, on the least of them,
    until nothing changes. A round is two aggregations and two joins on the link table; minima are
    combined map-side, so a node with very many links costs one row per task, and the joins are
    ones that adaptive execution can split. Lineage is cut by a written table every round. Rounds
    grow with the logarithm of a component's width; ``max_rounds`` without an end are an error.
    """
    edges = (
        links.filter("a <> b")
        .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .distinct()
    )
    edges = written(edges, "links")
    before = None
    for _ in range(max_rounds):
        both = edges.union(edges.select(F.col("v"), F.col("u")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (
            both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .filter("u <> v").distinct()
        )
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(least, "u")
        small = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).union(joined.select("u", F.col("m").alias("v")))
        last, edges = edges, written(small.filter("u <> v").distinct(), "links")
        discard(last)
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if before is not None and tuple(now) == before:
            break
        before = tuple(now)
    else:
        raise RuntimeError(f"links are not settled after {max_rounds} rounds")
    roots = edges.groupBy("u").agg(F.min("v").alias("root"))
    out = roots.select(F.col("u").alias("node"), "root").union(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
    out = written(out, "roots")
    discard(edges)
    return out

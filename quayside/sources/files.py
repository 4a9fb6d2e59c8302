"""Listings, explicit files, URL lists, related links, chained sources."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.names import mint_bid


def list_files(spark: SparkSession, path: str, recursive: bool = True) -> DataFrame:
    """(path, name, mtime, length). Contents are not read: the column is pruned from the scan."""
    df = spark.read.format("binaryFile").option("recursiveFileLookup", str(recursive).lower()).load(path)
    return df.select("path", F.element_at(F.split("path", "/"), -1).alias("name"), F.col("modificationTime").alias("mtime"), "length")


def read_files(spark: SparkSession, path: str, keep: Column | None = None) -> DataFrame:
    """Files with contents as resources; ``keep`` (on path, mtime, length) runs before bytes are read."""
    df = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    df = df.select("path", F.col("modificationTime").alias("mtime"), "length", "content", F.lit(None).cast("string").alias("permissions"))
    return df if keep is None else df.filter(keep)


def file_resources(spark: SparkSession, path: str, registry: str, loaded_at: Column, keep: Column | None = None) -> DataFrame:
    """Each file as a bundle of one resource, (bid, name, url, content_type, status_code, derived_from, content) with its mtime and
    length: the bundle's id is minted from the registry, the time of loading and the path; the url is the path."""
    df = read_files(spark, path, keep)
    none = F.lit(None).cast("string")
    return df.select(
        mint_bid(F.lit(registry), loaded_at, F.col("path")).alias("bid"), F.element_at(F.split("path", "/"), -1).alias("name"), F.col("path").alias("url"), none.alias("content_type"),
        F.lit(200).alias("status_code"), none.alias("derived_from"), "content", "mtime", "length",
    )


def explicit_files(wanted: DataFrame, listing: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(found, missing) of wanted(path)."""
    return wanted.join(listing, "path"), wanted.join(listing.select("path"), "path", "left_anti")


def url_list(spark: SparkSession, urls: list[str]) -> DataFrame:
    return spark.createDataFrame([(i, u) for i, u in enumerate(urls)], "ordinal int, url string")


def landed_pages(spark: SparkSession, path: str) -> DataFrame:
    """Landed API responses, one row a file: (path, body)."""
    return spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("body"))


def related_links(pages: DataFrame, most: int = 2, html: str = "html", key: str = "page_id") -> DataFrame:
    """(key, position, link): the first links of each page; a page's text is scanned in its row."""
    links = F.regexp_extract_all(F.col(html), F.lit(r'<a\s[^>]*href="([^"]*)"'), F.lit(1))
    return pages.select(key, F.posexplode(F.slice(links, 1, most)).alias("position", "link"))


def chained(*sources: DataFrame) -> DataFrame:
    """Sources in order of priority: union with ``locator_index``; drain by (locator_index, seq)."""
    out = None
    for i, s in enumerate(sources):
        s = s.withColumn("locator_index", F.lit(i))
        out = s if out is None else out.unionByName(s, allowMissingColumns=True)
    if out is None:
        raise ValueError("no sources")
    return out

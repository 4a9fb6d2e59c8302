"""URL filters by association rules, with fixed rules before them.

Spark's FP-growth mines combinations of URL tokens together with the class of a label. Rules whose
consequent is the class ``block`` or ``allow`` are kept if their support, confidence and lift are high
enough and no rule with fewer tokens says the same at least as surely. A URL is judged by the
surest rule all of whose tokens it has, found through an inverted index from token to rules: the
distinct token sets (far fewer than URLs) are joined with the index, matches are counted per rule
and compared with the rule's size. No rule: ``allow``.

Fixed rules (host, path) come first: a rule fits its host and all subdomains if the path starts
with the rule's; the longest wins. They are looked up by the host's suffixes within the row.

Everything is DataFrame and MLlib work; no Python runs in tasks.
"""

from __future__ import annotations

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import only, table, written

#: (verdict, host, path), as the contract gives them.
FIXED_RULES = (
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
)
MIN_SUPPORT = 0.001
MIN_COUNT = 20  # labelled URLs behind a rule, at least
MIN_CONFIDENCE = 0.5
MIN_LIFT = 1.2
BROADCAST_ROWS = 500_000  # of the rule index: a token and two numbers each
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def fixed_rule(host: Column, path: Column, rules=FIXED_RULES) -> Column:
    """struct(rule, verdict) of the longest rule that fits, or null. Of equally long rules the one
    with the longer host wins, then a block."""
    by_host: dict[str, list] = {}
    for verdict, h, p in rules:
        by_host.setdefault(h.translate(str.maketrans(_UPPER, _LOWER)), []).append((verdict, h, p))
    found = F.array().cast("array<struct<size:int,host:int,block:int,rule:string,verdict:string>>")
    for h, own in by_host.items():
        on_host = (host == h) | host.endswith("." + h)
        for verdict, _, p in own:
            entry = F.struct(
                F.lit(len(h) + len(p)).alias("size"), F.lit(len(h)).alias("host"), F.lit(int(verdict == "block")).alias("block"),
                F.lit(h + p).alias("rule"), F.lit(verdict).alias("verdict"),
            )
            found = F.concat(found, F.when(on_host & path.startswith(p), F.array(entry)).otherwise(F.array().cast("array<struct<size:int,host:int,block:int,rule:string,verdict:string>>")))
    return F.array_max(found)


def url_tokens(host: Column, path: Column, url: Column) -> Column:
    """Distinct tokens: site, top-level domain and subdomain of the host, path segments with every
    number as #, names of the query's parameters, and whether there is a fragment."""
    number = lambda c: F.regexp_replace(c, r"[0-9]+", "#")
    labels = F.split(host, r"\.")
    site = F.substring_index(host, ".", -3)
    query = F.regexp_extract(url, r"(?s)^[^?#]*\?([^#]*)", 1)
    parts = F.concat(
        F.array(F.concat(F.lit("site:"), site), F.concat(F.lit("tld:"), F.element_at(labels, -1))),
        F.when(F.size(labels) > 3, F.array(F.concat(F.lit("sub:"), labels[0]))).otherwise(F.array().cast("array<string>")),
        F.transform(F.filter(F.split(path, "/"), lambda s: s != ""), lambda s: F.concat(F.lit("path:"), number(s))),
        F.transform(F.filter(F.split(query, "&"), lambda s: s != ""), lambda s: F.concat(F.lit("arg:"), number(F.substring_index(s, "=", 1)))),
        F.when(url.contains("#"), F.array(F.lit("fragment"))).otherwise(F.array().cast("array<string>")),
    )
    return F.when(host == "", F.array().cast("array<string>")).otherwise(F.array_sort(F.array_distinct(parts)))


def mine_rules(labelled: DataFrame, min_support: float = MIN_SUPPORT, min_confidence: float = MIN_CONFIDENCE, min_lift: float = MIN_LIFT, min_count: int = MIN_COUNT) -> DataFrame:
    """labelled(tokens, cls) -> (rule_tokens, cls, confidence, support). A rule needs ``min_count`` labelled URLs behind it, whatever
    share of them that is, and ``min_support`` of them, so fewer than ``min_count`` teach none."""
    baskets = labelled.select(F.concat("tokens", F.array(F.concat(F.lit("class:"), "cls"))).alias("items"))
    schema = "rule_tokens array<string>, cls string, confidence double, support double"
    n = baskets.count()
    if n < min_count:
        return labelled.sparkSession.createDataFrame([], schema)
    model = FPGrowth(itemsCol="items", minSupport=max(min_support, min_count / n), minConfidence=min_confidence).fit(baskets)
    to = F.col("consequent")[0]
    rules = model.associationRules.filter(to.startswith("class:") & (F.col("lift") >= min_lift))
    rules = rules.select(F.array_sort("antecedent").alias("rule_tokens"), F.substring(to, 7, 99).alias("cls"), "confidence", "support")
    # a rule adds nothing if dropping one of its tokens gives a rule at least as sure
    shorter = rules.select(F.col("rule_tokens").alias("short"), F.col("cls").alias("scls"), F.col("confidence").alias("sconf"))
    longer = rules.filter(F.size("rule_tokens") > 1).withColumn("gone", F.explode("rule_tokens"))
    longer = longer.withColumn("short", F.array_remove("rule_tokens", F.col("gone")))
    idle = longer.join(shorter, (longer.short == shorter.short) & (F.col("cls") == F.col("scls")) & (F.col("sconf") >= F.col("confidence")))
    return rules.join(idle.select("rule_tokens", "cls").distinct(), ["rule_tokens", "cls"], "left_anti")


def judge(token_sets: DataFrame, rules: DataFrame) -> DataFrame:
    """token_sets(tokens), distinct -> (tokens, learned): the surest rule that matches, with its class, confidence and
    support. Of equally sure rules, the better supported, then the longer, then a block decides."""
    rules = rules.withColumn("rule_id", F.xxhash64("rule_tokens", "cls")).withColumn("need", F.size("rule_tokens"))
    rules = written(rules, "rules")
    index = rules.select("rule_id", "need", "cls", "confidence", "support", F.array_join("rule_tokens", " & ").alias("rule"), F.explode("rule_tokens").alias("token"))
    if index.count() <= BROADCAST_ROWS:
        index = F.broadcast(index)
    hits = token_sets.select("tokens", F.explode("tokens").alias("token")).join(index, "token")
    full = hits.groupBy("tokens", "rule_id", "need", "cls", "confidence", "support", "rule").count().filter("count = need")
    best = F.max_by(F.struct("cls", "rule", "confidence", "support"), F.struct("confidence", "support", "need", "cls", "rule"))
    return full.groupBy("tokens").agg(best.alias("learned"))


def url_filter(pages: DataFrame, labels: DataFrame, rules=FIXED_RULES) -> DataFrame:
    """(page_id, host, path, rule, verdict, learned_rule, confidence, support), a row for each row of
    ``pages(page_id, url)``; the last three are the surest learned rule that matches, whether or not a fixed one decides.

    The label of a page is the row of ``labels(doc_id, quality, toxic)`` with its id: block if
    quality is 0 or toxic is 1. A null url, or one without ``://``, has empty host and path, fits no
    rule, and is allowed. No labels: no learned rules. Extra columns are ignored; rows with null ids
    are judged but teach nothing; repeated rows each give a row.
    """
    pages = only(pages, page_id="long", url="string")
    url = F.col("url")
    parts = pages.withColumn("host", host_of(url)).withColumn("path", path_of(url))
    parts = parts.withColumn("tokens", url_tokens(F.col("host"), F.col("path"), F.coalesce(url, F.lit(""))))
    labels = only(labels, doc_id="long", quality="int", toxic="int").filter("quality is not null or toxic is not null")
    bad = (F.coalesce("quality", F.lit(1)) == 0) | (F.coalesce("toxic", F.lit(0)) == 1)
    known = labels.groupBy(F.col("doc_id").alias("page_id")).agg(F.max(bad.cast("int")).alias("bad"))
    taught = parts.filter(F.size("tokens") > 0).select("page_id", "tokens").join(known, "page_id")
    taught = taught.select("tokens", F.when(F.col("bad") == 1, "block").otherwise("allow").alias("cls"))
    learned = judge(parts.filter(F.size("tokens") > 0).select("tokens").distinct(), mine_rules(taught))
    out = parts.join(learned, "tokens", "left").withColumn("fixed", fixed_rule(F.col("host"), F.col("path"), rules))
    return out.select(
        "page_id", "host", "path", F.col("fixed.rule").alias("rule"), F.coalesce("fixed.verdict", "learned.cls", F.lit("allow")).alias("verdict"),
        F.col("learned.rule").alias("learned_rule"), F.col("learned.confidence").alias("confidence"), F.col("learned.support").alias("support"),
    )


def op8_url_filters(spark, sf_dir: str) -> DataFrame:
    return url_filter(table(spark, sf_dir, "pages"), table(spark, sf_dir, "labels"))


def fixed_url_rules(spark, sf_dir: str) -> DataFrame:
    """What the fixed rules alone say of every page: host, path, rule and verdict, null if none fits."""
    out = op8_url_filters(spark, sf_dir).select("page_id", "host", "path", "rule", "verdict")
    return out.withColumn("verdict", F.when(F.col("rule").isNotNull(), F.col("verdict")))


QUERIES = {"op8_url_filters": op8_url_filters, "fixed_url_rules": fixed_url_rules}

_PARTS = r"""(SELECT page_id, translate(coalesce(regexp_extract(url, '^.*?://([^/?#]*)', 1, 's'), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
  coalesce(regexp_extract(url, '^.*?://[^/?#]*([^?#]*)', 1, 's'), '') AS path FROM pages)"""
_RULES = "(VALUES ('block', 'net', '/'), ('allow', 'example.net', '/en/'), ('block', 'example.com', '/de/'), ('allow', 'org', '/fr/')) r(v, h, p)"

#: The mined rules are not SQL; host, path, the fixed rule and its verdict are.
ORACLE_SQL = {
    "fixed_url_rules": f"""
WITH fit AS (
  SELECT page_id, host, path, h || p AS rule, v, row_number() OVER (PARTITION BY page_id, host, path ORDER BY length(h || p) DESC, length(h) DESC) AS n
  FROM {_PARTS} u, {_RULES} WHERE (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p))
SELECT u.page_id, u.host, u.path, f.rule, f.v AS verdict FROM {_PARTS} u LEFT JOIN (SELECT DISTINCT * FROM fit WHERE n = 1) f USING (page_id, host, path)
"""
}

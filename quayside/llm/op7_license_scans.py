"""License scans: normalised text against licence templates by Dice coefficient over word bigrams.

Units are a text's lines, its paragraphs (parted by blank lines) of more than one line, and the
whole text where it has more than one paragraph. Text is lower-cased, everything but letters and
digits parts words. With ``n`` and ``m`` distinct bigrams, the Dice coefficient is at most
``2 * min(n, m) / (n + m)``, so a template of ``m`` bigrams can only reach the threshold ``t`` for
``m * t / (2 - t) <= n <= m * (2 - t) / t``: a unit whose word count rules out every template is
dropped at once, and of the others only the templates within bounds are counted. Before that, texts without any
of a few telling words, one of which every match must have, are passed over. Bigrams meet the
templates' bigrams in a broadcast join (a fixed list of a few thousand), and only bigrams that
occur in a template within bounds are shuffled.

DataFrame functions only; no Python runs in tasks.
"""

from __future__ import annotations

import functools
import itertools
import math
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import only, table
from .licence_templates import TEMPLATES

THRESHOLD = 0.8
#: Frequent words, which tell little.
COMMON = frozenset("a an and any as at be but by for from in is it may not of on or that the this to under with you".split())


def words(text: Column) -> Column:
    plain = F.trim(F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]+", " "))
    return F.filter(F.split(plain, " "), lambda w: w != "")


def bigrams(w: Column) -> Column:
    """Distinct word bigrams of an array of words."""
    pairs = F.zip_with(F.slice(w, 1, F.greatest(F.size(w) - 1, F.lit(0))), F.slice(w, 2, F.greatest(F.size(w) - 1, F.lit(0))), lambda a, b: F.concat_ws(" ", a, b))
    return F.array_distinct(pairs)


def template_bigrams(spark, templates, threshold: float) -> tuple[DataFrame, int, int]:
    """(template, m, low, high, bigram), and the least and largest sizes that any template allows."""
    t = spark.createDataFrame(list(templates), "licence string, template string, body string")
    t = t.select("licence", "template", bigrams(words(F.col("body"))).alias("b")).withColumn("m", F.size("b")).filter("m > 0")
    t = t.withColumn("low", F.ceil(F.col("m") * threshold / (2 - threshold) - 1e-9)).withColumn("high", F.floor(F.col("m") * (2 - threshold) / threshold + 1e-9))
    lo, hi = t.agg(F.min("low"), F.max("high")).first()
    return t.select("licence", "template", "m", "low", "high", F.explode("b").alias("bigram")), int(lo or 1), int(hi or 0)


def telling_words(templates, threshold: float) -> list[str]:
    """Words of which every unit that matches any template has at least one.

    A unit that reaches the threshold shares at least the lower size bound of a template's ``m``
    bigrams, so it misses few of them: words that stand in more bigrams than may be missed
    cannot all be absent. Words chosen before and long words come first, to keep the list short, frequent ones last.
    """
    chosen: list[str] = []
    for _, _, body in templates:
        w = re.findall(r"[^\W_]+", body.lower())
        grams = set(itertools.pairwise(w))
        if not grams:
            continue
        may_miss = len(grams) - math.ceil(len(grams) * threshold / (2 - threshold) - 1e-9)
        touched: set = set()
        for word in sorted(set(w), key=lambda x: (x in COMMON, x not in chosen, -len(x), x)):
            if len(touched) > may_miss:
                break
            touched |= {g for g in grams if word in g}
            if word not in chosen:
                chosen.append(word)
    return chosen


def units(docs: DataFrame) -> DataFrame:
    """(doc_id, kind, unit_no, unit): lines, paragraphs of several lines, texts of several paragraphs."""
    text = F.regexp_replace("text", r"\r\n?", "\n")
    blank = r"\n[ \t\x0B\f]*\n\s*"
    lines, parts = F.split(text, "\n"), F.split(text, blank)
    entry = lambda kind: lambda u, i: F.struct(F.lit(kind).alias("kind"), i.alias("unit_no"), u.alias("unit"))
    several = F.filter(F.transform(parts, entry("paragraph")), lambda s: F.trim(s["unit"]).contains("\n"))
    whole = F.when(F.size(parts) > 1, F.transform(F.array(text), entry("text"))).otherwise(F.array().cast("array<struct<kind:string,unit_no:int,unit:string>>"))
    return docs.select("doc_id", F.explode(F.concat(F.transform(lines, entry("line")), several, whole)).alias("u")).select("doc_id", "u.*")


def license_scan(docs: DataFrame, templates=TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, kind, unit_no, licence, template, dice): for each unit the most similar template, if
    its Dice coefficient reaches the threshold; dice is rounded to 6 digits.

    Ties go to the smaller template name. Null and empty texts, and units of one word, match
    nothing; equal rows count once; extra columns are ignored.
    """
    index, low, high = template_bigrams(docs.sparkSession, templates, threshold)
    docs = only(docs, doc_id="long", text="string").filter("text is not null")
    some = telling_words(templates, threshold)
    has_one = lambda t: functools.reduce(lambda a, b: a | b, [t.contains(w) for w in some], F.lit(False))
    docs = docs.filter(F.exists(F.array(F.lower("text")), has_one))  # lower-cased once a text
    u = units(docs).withColumn("w", words(F.col("unit"))).filter(F.size("w") > low)
    u = u.withColumn("b", bigrams(F.col("w"))).withColumn("n", F.size("b")).filter((F.col("n") >= low) & (F.col("n") <= high))
    u = u.select("doc_id", "kind", "unit_no", "n", F.xxhash64("unit").alias("unit_hash"), F.explode("b").alias("bigram"))
    hits = u.join(F.broadcast(index), "bigram").filter("n between low and high").dropDuplicates(
        ["doc_id", "kind", "unit_no", "unit_hash", "template", "bigram"]
    )
    key = ["doc_id", "kind", "unit_no", "unit_hash"]
    dice = hits.groupBy(*key, "licence", "template", "n", "m").agg(F.count("*").alias("c"))
    dice = dice.withColumn("dice", 2.0 * F.col("c") / (F.col("n") + F.col("m"))).filter(F.col("dice") >= threshold - 1e-9)
    best = dice.groupBy(*key).agg(F.min_by(F.struct("licence", "template", "dice"), F.struct((-F.col("dice")).alias("d"), "template")).alias("t"))
    return best.select("doc_id", "kind", "unit_no", "t.licence", "t.template", F.round("t.dice", 6).alias("dice"))


def op7_license_scans(spark, sf_dir: str) -> DataFrame:
    return license_scan(table(spark, sf_dir, "documents"))


QUERIES = {"op7_license_scans": op7_license_scans}

_VALUES = ",\n    ".join("('" + "', '".join(x.replace("'", "''") for x in t) + "')" for t in TEMPLATES)
_WORDS = r"list_filter(string_split(trim(regexp_replace(lower({0}), '[^\p{{L}}\p{{N}}]+', ' ', 'g')), ' '), lambda w: w <> '')"
_PAIRS = "list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))"

ORACLE_SQL = {
    "op7_license_scans": rf"""
WITH tpl(licence, template, body) AS (VALUES
    {_VALUES}),
tb AS (SELECT licence, template, {_PAIRS} AS b FROM (SELECT *, {_WORDS.format('body')} AS w FROM tpl)),
docs AS (SELECT DISTINCT doc_id, text FROM documents WHERE text IS NOT NULL),
parts AS (SELECT doc_id, regexp_replace(text, '\r\n?', chr(10), 'g') AS text FROM docs),
split AS (SELECT doc_id, text, string_split(text, chr(10)) AS lines, string_split_regex(text, '\n[ \t\x0B\f]*\n\s*') AS paras FROM parts),
units AS (
  SELECT doc_id, 'line' AS kind, unnest(range(0, len(lines))) AS unit_no, unnest(lines) AS unit FROM split
  UNION ALL SELECT * FROM (SELECT doc_id, 'paragraph', unnest(range(0, len(paras))), unnest(paras) AS unit FROM split) WHERE contains(trim(unit), chr(10))
  UNION ALL SELECT doc_id, 'text', 0, text FROM split WHERE len(paras) > 1),
ub AS (SELECT doc_id, kind, unit_no, {_PAIRS} AS b FROM (SELECT *, {_WORDS.format('unit')} AS w FROM units)),
d AS (
  SELECT u.doc_id, u.kind, u.unit_no, t.licence, t.template, 2.0 * len(list_intersect(u.b, t.b)) / (len(u.b) + len(t.b)) AS dice
  FROM ub u JOIN tb t ON len(u.b) > 0 AND 2.0 * least(len(u.b), len(t.b)) / (len(u.b) + len(t.b)) >= {THRESHOLD} - 1e-9),
r AS (SELECT *, row_number() OVER (PARTITION BY doc_id, kind, unit_no ORDER BY dice DESC, template) AS k FROM d WHERE dice >= {THRESHOLD} - 1e-9)
SELECT doc_id, kind, CAST(unit_no AS INTEGER) AS unit_no, licence, template, CAST(round(dice, 6) AS DOUBLE) AS dice FROM r WHERE k = 1
"""
}

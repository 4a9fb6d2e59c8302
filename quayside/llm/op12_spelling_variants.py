"""Spelling variant grouping by asymmetric q-chunks.

*Words.* Runs ``[A-Za-z\\u00C0-\\u00FF]+`` of whole texts, A-Z lower-cased; one run in 97 (by the crc32 of
``<doc_id>:<run>``) loses a code point. Words are the distinct results of at least ``LEAST_LENGTH`` code
points with at least ``LEAST_COUNT`` occurrences. Counts combine map-side, so a very frequent word
costs one row a task.

*Chunks and grams.* Two words are near if they differ by one inserted, deleted or replaced code point.
The shorter word (of equal ones, either) of L code points gives two disjoint chunks of ``q = L // 2``,
its first and its last; the other word, of L or L + 1, gives its positional q-grams. The edit touches
one chunk at most. If the first is untouched, it is the other word's gram at the same position; if only
the last is, everything before the edit is in front of it, and its gram has moved by the difference of
the lengths: by one place at most. So of all grams only those at these positions can meet a chunk, and
the join on (side, L, gram) has every near pair. Each pair is verified by its edit distance.

*Hot chunks.* A chunk that very many words share (a common stem or ending) is not paired out: the words
on both sides of a key with more than ``HOT_PAIRS`` pairs meet on what is left of them without one code
point, and its place. Words that agree in that are near, so a group has no more words than the alphabet
has letters, and nothing but near pairs is made. Both ways give every pair of their keys.

*Forms and roots.* A word's form is its near word of largest n, if that is at least twice the word's n. Forms
grow at each step, so chains have at most log2(n) of them; pointers double until none moves.

Native: DataFrame functions only. The tables that are joined have a few rows for each distinct word, and are
shuffled: Spark would judge them by the compressed files of words they come from, and broadcast what is many times that.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import discard, only, table, written

RUN = "[A-Za-zÀ-ÿ]+"
ONE_IN = 97  # runs lose a code point
LEAST_LENGTH, LEAST_COUNT = 5, 3
RATIO = 2  # a form is so many times as frequent
HOT_PAIRS = 16_384  # of a key beyond which words meet without one code point
BROADCAST_KEYS, BROADCAST_BYTES = 100_000, 4 << 20  # hot keys, and their grams
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def without(word: Column, i: Column) -> Column:
    """The word without its code point at ``i`` (from 0)."""
    return F.concat(F.substr(word, F.lit(1), i.cast("int")), F.substr(word, i.cast("int") + 2))


def shuffled(df: DataFrame) -> DataFrame:
    """The table, never broadcast in a join."""
    return df.hint("merge")


def word_counts(docs: DataFrame) -> DataFrame:
    """(word, n) of ``docs(doc_id, text)``. Null and empty texts have no runs; a null doc_id counts as
    an empty string; rows that repeat count each; extra columns are ignored."""
    docs = only(docs, doc_id="string", text="string")
    runs = F.regexp_extract_all(F.translate("text", UPPER, LOWER), F.lit(RUN), F.lit(0))
    run = docs.select(F.coalesce("doc_id", F.lit("")).alias("doc"), F.explode(runs).alias("run"))
    run = run.withColumn("h", F.crc32(F.concat("doc", F.lit(":"), "run")))
    word = F.when(F.col("h") % ONE_IN == 0, without(F.col("run"), F.col("h") % F.length("run"))).otherwise(F.col("run"))
    counts = run.select(word.alias("word")).groupBy("word").agg(F.count("*").alias("n"))
    return counts.filter((F.length("word") >= LEAST_LENGTH) & (F.col("n") >= LEAST_COUNT))


def chunks(words: DataFrame) -> DataFrame:
    """(side, size, gram, a, na): the first and the last chunk of each word of ``size`` code points."""
    q = F.expr("length(word) div 2").cast("int")
    ends = F.array(
        F.struct(F.lit(0).alias("side"), F.substr("word", F.lit(1), q).alias("gram")), F.struct(F.lit(1).alias("side"), F.substr("word", F.length("word") - q + 1, q).alias("gram"))
    )
    out = words.select(F.col("word").alias("a"), F.col("n").alias("na"), F.length("word").alias("size"), F.inline(ends))
    return out.select("side", "size", "gram", "a", "na")


def grams(words: DataFrame) -> DataFrame:
    """(side, size, gram, b, nb): the grams of each word that a chunk of a word of ``size`` code points, as
    many or one less, can meet: at the chunk's place, the last one's moved by the difference."""
    m = F.length("word")
    at = []
    for size in (m, m - 1):
        q = F.floor(size / 2).cast("int")
        at.append(F.struct(F.lit(0).alias("side"), size.alias("size"), F.substr("word", F.lit(1), q).alias("gram")))
        at.append(F.struct(F.lit(1).alias("side"), size.alias("size"), F.substr("word", m - q + 1, q).alias("gram")))
    out = words.select(F.col("word").alias("b"), F.col("n").alias("nb"), F.inline(F.array(*at)))
    return out.filter(F.col("size") >= LEAST_LENGTH).select("side", "size", "gram", "b", "nb")


def near_pairs(words: DataFrame) -> DataFrame:
    """(a, na, b, nb): every pair of the written words(word, n) that differ by one edit, once; a is the
    shorter, or the lesser of equal length."""
    key = ["side", "size", "gram"]
    left, right = chunks(words), grams(words)
    sides = left.select(*key, F.lit(1).alias("c"), F.lit(0).alias("g")).unionByName(right.select(*key, F.lit(0).alias("c"), F.lit(1).alias("g")))
    hot = written(sides.groupBy(*key).agg(F.sum("c").alias("c"), F.sum("g").alias("g")).filter(F.col("c") * F.col("g") > HOT_PAIRS).select(*key), "hot")
    n_hot, gram_bytes = hot.agg(F.count("*"), F.sum(F.octet_length("gram"))).first()
    cold = left, right
    if n_hot:
        keys = F.broadcast(hot) if n_hot <= BROADCAST_KEYS and gram_bytes <= BROADCAST_BYTES else shuffled(hot)
        cold = tuple(side.join(keys, key, "left_anti") for side in (left, right))
    proper = (F.length("a") < F.length("b")) | (F.col("a") < F.col("b"))
    pairs = cold[0].join(shuffled(cold[1]), key).filter(proper & (F.levenshtein("a", "b", 1) == 1)).select("a", "na", "b", "nb")
    if n_hot:
        some, others = left.join(keys, key, "left_semi").select("a", "na").distinct(), right.join(keys, key, "left_semi").select("b", "nb").distinct()

        def holes(name: str) -> Column:
            """(place, rest) for each code point left out."""
            return F.transform(F.sequence(F.lit(0), F.length(name) - 1), lambda i: F.struct(i.alias("place"), without(F.col(name), i).alias("rest")))

        gone = others.select("b", "nb", F.inline(holes("b")))
        same = some.select("a", "na", F.inline(holes("a"))).join(shuffled(gone), ["place", "rest"]).filter("a < b")
        longer = some.withColumn("rest", F.col("a")).join(shuffled(gone.drop("place").distinct()), "rest")
        pairs = pairs.unionByName(same.select("a", "na", "b", "nb")).unionByName(longer.select("a", "na", "b", "nb"))
    return pairs.distinct()


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of forms(word, form): where following forms ends. Pointers double, each round written."""
    at = written(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        ahead = shuffled(at.select(F.col("word").alias("root"), F.col("root").alias("far")))
        if not at.join(ahead, "root", "left_semi").take(1):
            return at
        last, at = at, written(at.join(ahead, "root", "left").select("word", F.coalesce("far", "root").alias("root")), "roots")
        discard(last)


def spelling_variants(words: DataFrame) -> DataFrame:
    """(word, n, n_near, form, form_n, root), a row for each of the written, distinct words(word, n). Words
    without near ones have n_near 0 and are their own root; ties of forms go to the lesser in
    code-point order; no words give no rows."""
    pairs = written(near_pairs(words), "near")
    both = pairs.select(F.col("a").alias("word"), F.col("b").alias("other"), F.col("nb").alias("m")).union(pairs.select("b", "a", "na"))
    best = both.groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("m")).alias("m"), "other")).alias("best"))
    found = words.join(shuffled(best), "word", "left").select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.col("best.other").alias("other"), (-F.col("best.m")).alias("m"))
    has = F.col("m") >= RATIO * F.col("n")
    found = written(found.select("word", "n", "n_near", F.when(has, F.col("other")).alias("form"), F.when(has, F.col("m")).alias("form_n")), "forms")
    end = roots(found.filter("form is not null"))
    out = found.join(shuffled(end), "word", "left").select("word", "n", "n_near", "form", "form_n", F.coalesce("root", "word").alias("root"))
    discard(pairs)
    return out


def op12_spelling_variants(spark, sf_dir: str) -> DataFrame:
    return spelling_variants(written(word_counts(table(spark, sf_dir, "documents")), "words"))


QUERIES = {"op12_spelling_variants": op12_spelling_variants}

#: crc32 by its bits (polynomial 3988292384), words, pairs that share what is left without one code
#: point, forms, and the chain of forms.
ORACLE_SQL = {
    "op12_spelling_variants": r"""
WITH RECURSIVE run AS (
  SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS doc, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[A-Za-zÀ-ÿ]+')) AS run
  FROM documents),
each AS (SELECT doc, run, count(*) AS times FROM run GROUP BY ALL),
bytes AS (SELECT *, flatten(list_transform(string_split(doc || ':' || run, ''), lambda c: CASE WHEN unicode(c) < 128 THEN [CAST(unicode(c) AS BIGINT)]
    ELSE [192 + (unicode(c) >> 6), 128 + (unicode(c) & 63)] END)) AS b FROM each),
crc AS (SELECT doc, run, times, xor(4294967295, list_reduce(list_prepend(CAST(4294967295 AS BIGINT), b), lambda x, y: list_reduce(
    [xor(x, y), 0, 0, 0, 0, 0, 0, 0, 0], lambda v, k: CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END))) AS h FROM bytes),
made AS (SELECT CASE WHEN h % 97 = 0 THEN left(run, CAST(h % length(run) AS INT)) || substr(run, CAST(h % length(run) AS INT) + 2) ELSE run END AS word, times FROM crc),
words AS (SELECT word, CAST(sum(times) AS BIGINT) AS n FROM made GROUP BY 1 HAVING length(word) >= 5 AND sum(times) >= 3),
hole AS (SELECT word, i, left(word, i) || substr(word, i + 2) AS rest FROM (SELECT word, unnest(range(length(word))) AS i FROM words)),
pair AS (
  SELECT a.word AS a, b.word AS b FROM hole a JOIN hole b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
  UNION SELECT a.word, h.word FROM words a JOIN hole h ON h.rest = a.word
  UNION SELECT h.word, a.word FROM words a JOIN hole h ON h.rest = a.word),
near AS (SELECT a AS word, count(*) AS n_near, arg_min(b, struct_pack(m := -w.n, b := encode(b))) AS best, max(w.n) AS m FROM pair JOIN words w ON w.word = b GROUP BY a),
forms AS (SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN m >= 2 * w.n THEN best END AS form, CASE WHEN m >= 2 * w.n THEN m END AS form_n FROM words w LEFT JOIN near USING (word)),
chain AS (SELECT word, word AS at FROM forms UNION ALL SELECT c.word, f.form FROM chain c JOIN forms f ON f.word = c.at WHERE f.form IS NOT NULL)
SELECT f.word, f.n, f.n_near, f.form, f.form_n, c.at AS root
FROM forms f JOIN chain c ON c.word = f.word JOIN forms e ON e.word = c.at WHERE e.form IS NULL
"""
}

"""The corpus pipeline: keep identifiable languages, one of each group of near copies, drop
benchmark leaks, pack what is left into training sequences.

``STAGES`` holds (name, function) pairs; each function takes ``(spark, docs, sf_dir)`` and returns
a DataFrame, which ``run`` writes to the shared folder and reads again as the next one's ``docs``.
All stages but the last return the columns of ``documents``; other columns are left behind in the
first stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.llm import groups
from quayside.llm.common import discard, only, table, written
from quayside.llm.op5_language_id import predict, train
from quayside.llm.op6_jaccard_join import set_components
from quayside.llm.op9_decontamination import contaminated
from quayside.llm.op10_best_fit_packing import best_fit_packing

COLUMNS = {"doc_id": "long", "text": "string", "lang": "string", "source": "string", "n_chars": "long"}
#: A text whose best language has less than this share of the score, and less than so many times an even
#: share, looks like none of the learned languages, however many these are.
LEAST_SCORE, LEAST_LIFT = 0.3, 1.2
BROADCAST_IDS = 4_000_000  # 8 bytes each: at most 32 MB
KEPT_PIECES = 1_000_000  # of the encoder, beside what the workers of the stages before have left in memory
BATCH_BYTES = 8 << 20  # of texts that a Python worker is given at a time


def documents(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """The columns of documents. Batches are bounded by bytes from here on: ten thousand texts are too much at once if they are long."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return only(docs, **COLUMNS)


def keyed(docs: DataFrame) -> DataFrame:
    """``docs`` with a key: decisions are about rows, which may share a doc_id or have none."""
    return docs.withColumn("key", F.xxhash64(*COLUMNS))


def without(docs: DataFrame, gone: DataFrame) -> DataFrame:
    """keyed docs whose (key, doc_id) is not in the written, distinct ``gone``: these are counted, so texts
    are shuffled only where there are too many to broadcast."""
    away = gone.select(F.col("key").alias("k"), F.col("doc_id").alias("d"))
    return docs.join(F.broadcast(away) if away.count() <= BROADCAST_IDS else away, F.expr("key = k AND doc_id <=> d"), "left_anti")


def identify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop texts that are null, have no letter, or look like none of the learned languages. If
    there is nothing to learn from, only the first two are dropped."""
    docs = documents(spark, docs)
    model = train(docs)  # on a bounded sample
    found = predict(docs, model, keep_text=True)
    good = (F.col("lang_pred") != "und") & (F.col("score") >= min(LEAST_SCORE, LEAST_LIFT / len(model[0]))) if model[0] else F.col("text").rlike(r"\p{L}")
    return found.filter(good).select(*COLUMNS)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one row of every component of linked sets: the one with the smallest doc_id (rows without come
    last), then the smallest key. Rows without words stay; rows that are equal in all columns are
    one, if they have words."""
    docs = keyed(documents(spark, docs))
    members, labels = set_components(docs.select("key", "doc_id", "text"))
    rooted = groups.with_roots(members.filter("sid is not null"), labels)
    first = rooted.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "key")).alias("first"))
    extra = rooted.join(first, "root").filter("NOT (key = first.key AND doc_id <=> first.doc_id)").select("key", "doc_id").distinct()
    gone = written(extra, "drop")
    again = written(members.filter("sid is not null").groupBy("key", "doc_id").count().filter("count > 1").select("key", "doc_id"), "again")
    kept = without(docs, gone)
    if again.take(1):
        mark = again.select(F.col("key").alias("k"), F.col("doc_id").alias("d"))
        same = F.expr("key = k AND doc_id <=> d")
        once = kept.join(mark, same, "left_semi").groupBy("key", "doc_id").agg(F.first(F.struct("text", "lang", "source", "n_chars")).alias("r"))
        kept = kept.join(mark, same, "left_anti").select(*COLUMNS).unionByName(once.select("doc_id", "r.*"))
    discard(members, labels)
    return kept.select(*COLUMNS)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that hold a benchmark item."""
    docs = keyed(documents(spark, docs))
    leaks = contaminated(docs.select(F.col("key").alias("doc_id"), "text"), table(spark, sf_dir, "benchmark"))
    gone = written(leaks.select(F.col("doc_id").alias("k")).distinct(), "leaks")
    return docs.join(F.broadcast(gone) if gone.count() <= BROADCAST_IDS else gone, F.expr("key = k"), "left_anti").select(*COLUMNS)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row for each piece of a document: its bin and its place there."""
    return best_fit_packing(documents(spark, docs), kept=KEPT_PIECES)


STAGES = [
    ("language_id", identify),
    ("jaccard_join", one_of_each),
    ("decontamination", decontaminate),
    ("packing", pack),
]

#: Kernel scores, fingerprints and packing are not SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)

"""Tables in the folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir. Where the session names none,
    a local session (as in tests) gets a temporary folder of our own; on a cluster that is an error."""
    conf = spark.sparkContext.getConf()
    root = conf.get("spark.checkpoint.dir", None) or spark.conf.get("quayside.scratch.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = "file://" + tempfile.mkdtemp(prefix="spark-quayside-")
        spark.conf.set("quayside.scratch.dir", root)
    return root.rstrip("/")


CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def written(df: DataFrame, name: str, *partition_by: str, clean: bool = False, **options: object) -> DataFrame:
    """Write ``df`` to a new table in the shared folder and read it back.

    Cuts lineage with files that outlive a lost executor; the schema is given on reading, so an
    empty table keeps its columns. With ``clean`` the shuffle files of the writing go with its end, not when
    the driver happens to collect its garbage. ``options`` are those of the writer.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/quayside-{name}-{uuid.uuid4().hex[:12]}"
    w = df.write.option("compression", "zstd").options(**options)
    if partition_by:
        w = w.partitionBy(*partition_by)
    before = spark.conf.get(CLEANUP)
    if clean:
        spark.conf.set(CLEANUP, True)
    try:
        w.parquet(path)
    finally:
        spark.conf.set(CLEANUP, before)
    out = spark.read.schema(df.schema).parquet(path)
    out._written_at = path
    return out


def discard(*tables: DataFrame) -> None:
    """Delete written tables that nothing reads any more, so that only live ones take disk."""
    for df in tables:
        jvm = df.sparkSession._jvm
        at = jvm.org.apache.hadoop.fs.Path(df._written_at)
        at.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(at, True)

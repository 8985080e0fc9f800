"""Helpers the operators share: tables, word expressions, staged tables."""

from __future__ import annotations

import gc

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clinistar.session import ensure_checkpoint_dir

#: A word is a run of characters other than the six ASCII blanks (fixed value).
WORD = r"[^\x20\x09-\x0D]+"
ASCII_BLANKS = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


#: Rows and bytes that Spark hands to a Python worker at once, at most. Texts
#: can be long: the defaults, 10,000 rows or 64 MB, are several times that in a
#: worker's memory.
BATCH = {"spark.sql.execution.arrow.maxRecordsPerBatch": "1000", "spark.sql.execution.arrow.maxBytesPerBatch": "8m"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    for key, value in BATCH.items():
        spark.conf.set(key, value)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def word_count(text: Column) -> Column:
    """Words of ``text`` as a long; a null text has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def scratch(spark: SparkSession, label: str) -> str:
    """A fresh path in the shared checkpoint folder. The folder around it is
    removed when the driver's JVM ends."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    base = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{label}-{jvm.java.util.UUID.randomUUID()}"
    path = jvm.org.apache.hadoop.fs.Path(base)
    fs = path.getFileSystem(conf)
    fs.mkdirs(path)
    fs.deleteOnExit(path)
    return f"{base}/table"


def staged(df: DataFrame, label: str) -> DataFrame:
    """``df`` written as a Parquet table in the shared folder and read back.

    Later steps read the table, so a lost executor repeats its own tasks only,
    and every use sees the same rows.
    """
    path = scratch(df.sparkSession, label)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.staged_in = path.rsplit("/", 1)[0]
    return out


def discard(spark: SparkSession, *tables: DataFrame) -> None:
    """Remove staged tables that nothing will read again, and let Spark's
    cleaner remove the shuffle files of plans that are no longer referenced."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    for t in tables:
        path = hadoop.Path(t.staged_in)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    gc.collect()
    spark._jvm.System.gc()

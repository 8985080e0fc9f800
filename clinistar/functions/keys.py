"""Surrogate keys: dense numbers of distinct values, and a map that keeps them.

``dense_keys`` numbers the distinct values of a column 1..n in sort order,
the same numbers as ``DENSE_RANK() OVER (ORDER BY value)``, but without the
global window (which Spark runs in one task): values are numbered inside
ranges and shifted by the sizes of the ranges before. The ranges are a
function of the values (``functions.ranges``), so it is one lazy plan: no job
runs while it is planned and nothing is checkpointed. The only data that meets
in one place is one row per range.

``stable_keys`` and ``KeyMap`` keep the keys across loads: a known value keeps
its key, new ones get the next numbers.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from clinistar.functions.ranges import RANGES, starts, with_range


def dense_keys(df: DataFrame, value_col: str, key_col: str, ranges: int = RANGES) -> DataFrame:
    """Return ``(value_col, key_col)`` with one row per distinct non-NULL value."""
    values = df.select(value_col).where(F.col(value_col).isNotNull()).distinct()
    ranged = with_range(values, value_col, ranges=ranges)
    sizes = ranged.groupBy("_range").agg(F.count(F.lit(1)).alias("_n"))
    inside = F.row_number().over(Window.partitionBy("_range").orderBy(value_col))
    return ranged.withColumn("_nth", inside).join(F.broadcast(starts(sizes, "_n", "_before")), "_range").select(
        value_col, (F.col("_before") + F.col("_nth")).cast("long").alias(key_col)
    )


def stable_keys(df: DataFrame, value_col: str, key_col: str, known: DataFrame | None = None) -> DataFrame:
    """The distinct non-NULL values of ``df`` that ``known`` lacks, numbered
    densely, in sort order, from the largest known key on. ``known`` has
    ``(value_col, key_col)``; without it all values are new."""
    if known is None:
        return dense_keys(df, value_col, key_col)
    values = df.select(value_col).where(F.col(value_col).isNotNull()).distinct()
    new = values.join(known.select(value_col), value_col, "left_anti")
    largest = known.agg(F.coalesce(F.max(key_col), F.lit(0)).alias("_top")).scalar()
    return dense_keys(new, value_col, "_k").select(value_col, (F.col("_k") + largest).cast("long").alias(key_col))


class KeyMap:
    """A key map in a folder, one part per load.

    ``update`` adds a part with the keys of the values that are new and
    touches no older part, so a key once given is never changed, and a load
    that failed leaves the map as it was. One load runs at a time. A load
    that is repeated finds all its values known and adds an empty part.
    """

    def __init__(self, spark: SparkSession, path: str, value_col: str, key_col: str):
        self.spark, self.path, self.value_col, self.key_col = spark, path.rstrip("/"), value_col, key_col

    def _loads(self) -> list[str]:
        """The complete parts: those whose job ended."""
        jvm = self.spark._jvm.org.apache.hadoop.fs
        root = jvm.Path(self.path)
        fs = root.getFileSystem(self.spark._jsc.hadoopConfiguration())
        if not fs.exists(root):
            return []
        names = [s.getPath().getName() for s in fs.listStatus(root) if s.isDirectory()]
        return sorted(n for n in names if n.startswith("load-") and fs.exists(jvm.Path(f"{self.path}/{n}/_SUCCESS")))

    def table(self) -> DataFrame | None:
        """All keys so far; None before the first load."""
        loads = self._loads()
        return self.spark.read.parquet(*[f"{self.path}/{n}" for n in loads]) if loads else None

    def update(self, df: DataFrame) -> DataFrame:
        """Give keys to the new values of ``df``; returns all keys."""
        number = int(self._loads()[-1].split("-")[1]) + 1 if self._loads() else 1
        stable_keys(df, self.value_col, self.key_col, self.table()).write.mode("overwrite").parquet(f"{self.path}/load-{number:09d}")
        return self.table()

"""Ranges of an ordered column that are the same whenever they are computed.

``repartitionByRange`` samples, so a recomputed task may see other bounds; a
number that depends on them would need a checkpoint. Here the bounds are a
function of the set of values: of all distinct values the ``SAMPLE`` with the
smallest hashes are sorted and every so-manieth is a bound. They are a scalar
subquery, so everything stays one lazy plan, and equal values never straddle
a bound. Hashing distinct values makes the ranges even, whatever the skew of
the rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Ranges made, and values that the bounds are taken from. Both are bounds on
#: what meets in one task.
RANGES, SAMPLE = 512, 8192


def with_range(distinct: DataFrame, by: str, range_col: str = "_range", ranges: int = RANGES) -> DataFrame:
    """``distinct`` with the number of the range that ``by`` falls in, rising
    with it. ``by`` holds every value about equally often; NULLs are range 0."""
    sample = max(SAMPLE, ranges)
    lowest = distinct.where(F.col(by).isNotNull()).select(F.col(by).alias("_b")).orderBy(F.xxhash64("_b"), "_b").limit(sample)
    every = F.col("_s")
    step = F.greatest(F.lit(1), F.ceil(F.size(every) / ranges)).cast("int")
    bounds = lowest.agg(F.array_sort(F.collect_list("_b")).alias("_s")).select(
        F.filter(every, lambda b, i: (i > 0) & (i % step == 0)).alias("_bounds")
    )
    # how many bounds are not above, by bisection: a step per power of two,
    # not one per bound; each is a projection, which is compiled, as a lambda
    # is not. A NULL bound, one past the end, and a NULL value are not reached.
    out = distinct.withColumn("_bounds", bounds.scalar()).withColumn(range_col, F.lit(0))
    for half in (1 << k for k in reversed(range(ranges.bit_length()))):
        ahead = F.get("_bounds", F.col(range_col) + (half - 1)) <= F.col(by)
        out = out.withColumn(range_col, F.col(range_col) + F.when(ahead, half).otherwise(0))
    return out.drop("_bounds")


def starts(sizes: DataFrame, size_col: str, out_col: str, range_col: str = "_range", keys: tuple[str, ...] = (), descending: bool = False) -> DataFrame:
    """Rows before each range (of its ``keys``): prefix sums over one row per
    range, or per key and range."""
    order = F.desc(range_col) if descending else F.asc(range_col)
    before = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return sizes.select(*keys, range_col, F.coalesce(F.sum(size_col).over(before), F.lit(0)).alias(out_col))


def top_rows(df: DataFrame, key: Column, n: int) -> DataFrame:
    """The first ``n`` rows of ``df`` by ``key`` (ascending, without ties),
    unordered. For any ``n``: rows are counted by ranges of the key, ranges
    behind the ``n``-th row go, and only the range it falls in is cut by
    numbering; no task sorts more than one range."""
    ranged = with_range(df.withColumn("_key", key), "_key")
    sizes = ranged.groupBy("_range").agg(F.count(F.lit(1)).alias("_n"))
    kept = F.broadcast(starts(sizes, "_n", "_before").where(F.col("_before") < n))
    nth = F.row_number().over(Window.partitionBy("_range").orderBy("_key"))
    cut = ranged.join(kept, "_range").withColumn("_nth", nth + F.col("_before"))
    return cut.where(F.col("_nth") <= n).select(*df.columns)

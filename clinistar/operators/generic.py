"""Generic operators factored out of the reference procedures (P1-P6).

Each works on any DataFrame. They are built so that no single key, period or
group has to be gathered whole into one task:

* P1 ``period_change`` windows are partitioned by the entity, over rows that
  are already aggregated to one per entity and period; with ``spread`` by
  ranges of (entity, period), and each range gets the last row before it.
* P2 ``rank_in_period`` ranks through a histogram of measure values instead
  of sorting every entity of a period in one task. The histogram of counts is
  short; that of any other measure is ranked by ranges.
* P3 ``share_of_total`` computes totals with ordinary (map-side combined)
  aggregation and joins them back, instead of a window over the group.
* P4 ``rolling_rate`` orders only the per-period aggregate (one row per
  period), never the input rows; with ``many_periods`` in blocks that overlap
  by a frame.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from clinistar.functions.keys import dense_keys
from clinistar.functions.ranges import starts, with_range
from clinistar.functions.scalar import pct_round2_sql, percent_units_sql


# ---------------------------------------------------------------------------
# P1
# ---------------------------------------------------------------------------
def period_change(
    df: DataFrame,
    keys: Sequence[str],
    period: str,
    measure: str,
    prev_col: str = "PreviousCount",
    change_col: str = "ChangePercentage",
    strict: bool = False,
    spread: bool = False,
) -> DataFrame:
    """Add the previous period's measure and the rounded % change.

    ``prev`` is the previous *row* of the entity (the previous period that
    has data), as ``LAG`` in the reference; with ``strict`` it is NULL unless
    that row is exactly the period before. The window partitions by the whole
    entity key, so ties on the period cannot make LAG ambiguous.

    ``spread`` is for entities with very many periods: rows are cut into
    ranges of (entity, period), LAG runs inside a range, and the first row of
    an entity in a range takes the entity's last row of the range before. What
    meets per entity is one row per range.
    """
    if strict and df.schema[period].dataType.typeName() not in ("integer", "long", "short", "byte"):
        raise ValueError(f"strict needs an integer period (e.g. a year), not {df.schema[period].dataType}")
    if spread:
        out = _lag_by_ranges(df, list(keys), period, F.struct(F.col(period).alias("p"), F.col(measure).alias("m")))
        out = out.withColumns({prev_col: F.col("_prev.m"), "_prev_period": F.col("_prev.p")}).drop("_prev")
    else:
        w = Window.partitionBy(*keys).orderBy(period)
        out = df.withColumn(prev_col, F.lag(measure).over(w))
        if strict:
            out = out.withColumn("_prev_period", F.lag(period).over(w))
    if strict:
        out = out.withColumn(prev_col, F.when(F.col("_prev_period") == F.col(period) - 1, F.col(prev_col)))
    out = out.drop("_prev_period")
    return out.withColumn(change_col, F.expr(pct_round2_sql(f"({measure} - {prev_col})", prev_col)))


def _lag_by_ranges(df: DataFrame, keys: list[str], period: str, value: Column) -> DataFrame:
    """``df`` with ``_prev``: ``value`` of the entity's previous row."""
    ranged = with_range(df.withColumn("_place", F.struct(*keys, period)), "_place").drop("_place").withColumn("_value", value)
    inside = Window.partitionBy("_range", *keys).orderBy(period)
    last = ranged.groupBy("_range", *keys).agg(F.max_by("_value", period).alias("_last"))
    carried = last.withColumn("_carry", F.lag("_last").over(Window.partitionBy(*keys).orderBy("_range"))).drop("_last")
    lagged = ranged.withColumn("_lag", F.lag("_value").over(inside)).withColumn("_first", F.row_number().over(inside) == 1)
    out = join_back(lagged, carried, ["_range", *keys])
    return out.withColumn("_prev", F.when(F.col("_first"), F.col("_carry")).otherwise(F.col("_lag"))).select(*df.columns, "_prev")


# ---------------------------------------------------------------------------
# P2
# ---------------------------------------------------------------------------
def rank_in_period(
    df: DataFrame, period: str, measure: str, rank_col: str = "RankInPeriod",
    k: int | None = None,
) -> DataFrame:
    """``RANK() OVER (PARTITION BY period ORDER BY measure DESC)``.

    rank = 1 + number of rows of the period with a larger measure. We count
    rows per (period, measure value), rank that histogram and join the rank
    back, so equal measures are one row there. Of a whole-number measure it
    has at most ~sqrt(2N) rows per period, since distinct positive counts
    summing to N are that few, and a window ranks it. Of any other measure it
    can be as long as the data: it is cut into ranges of (period, measure),
    counted inside each, and a range starts with the rows of the period in the
    ranges above. ``k`` keeps ranks <= k (the top-k report).
    """
    hist = df.groupBy(period, measure).agg(F.count(F.lit(1)).alias("_rows"))
    if isinstance(df.schema[measure].dataType, IntegralType):
        above, start = Window.partitionBy(period), F.lit(0)
    else:
        hist = with_range(hist.withColumn("_place", F.struct(period, measure)), "_place").drop("_place")
        sizes = hist.groupBy(period, "_range").agg(F.sum("_rows").alias("_n"))
        hist = join_back(hist, starts(sizes, "_n", "_before", keys=(period,), descending=True), [period, "_range"])
        above, start = Window.partitionBy(period, "_range"), F.col("_before")
    above = above.orderBy(F.col(measure).desc()).rowsBetween(Window.unboundedPreceding, -1)
    rank = F.coalesce(F.sum("_rows").over(above), F.lit(0)) + start + 1
    ranks = hist.select(period, measure, rank.cast("int").alias(rank_col))
    if k is not None:
        ranks = ranks.where(F.col(rank_col) <= k)
    return join_back(df, ranks, [period, measure])


# ---------------------------------------------------------------------------
# P3
# ---------------------------------------------------------------------------
def join_back(df: DataFrame, totals: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Join per-key results back onto ``df`` with NULL-safe key equality (a
    window groups NULL keys together, so must we)."""
    keys = list(keys)
    t = totals.select(*[F.col(k).alias(f"_k_{i}") for i, k in enumerate(keys)],
                      *[c for c in totals.columns if c not in keys])
    cond = [df[k].eqNullSafe(t[f"_k_{i}"]) for i, k in enumerate(keys)]
    return df.join(t, cond, "inner").drop(*[f"_k_{i}" for i in range(len(keys))])


def partition_totals(df: DataFrame, measure: str, partition: Sequence[str], total_col: str) -> DataFrame:
    """``SUM(measure)`` per ``partition`` key (a map-side combined aggregate)."""
    return df.groupBy(*partition).agg(F.sum(measure).alias(total_col))


def share_of_total(
    df: DataFrame, measure: str, partition: Sequence[str], total_col: str,
    share_col: str | None = None, totals: DataFrame | None = None,
) -> DataFrame:
    """Add ``SUM(measure) OVER (PARTITION BY partition)`` as ``total_col`` and,
    if ``share_col`` is given, ``ROUND(measure * 100.0 / total, 2)``.
    ``totals`` may be given precomputed (from the same rows as ``df``)."""
    if totals is None:
        totals = partition_totals(df, measure, partition, total_col)
    out = join_back(df, totals, partition)
    if share_col:
        out = out.withColumn(share_col, F.expr(pct_round2_sql(measure, total_col)))
    return out


# ---------------------------------------------------------------------------
# P4
# ---------------------------------------------------------------------------
ROLLING_PLACES = 6  # published places of the rolling mean of 5-place rates
BLOCK = 4096  # periods of a block


def rolling_rate(
    df: DataFrame,
    period_col: Column,
    period_name: str,
    predicate: Column,
    rate_col: str,
    rolling_col: str,
    n: int = 3,
    calendar_index: Column | None = None,
    many_periods: bool = False,
) -> DataFrame:
    """Rate of rows matching ``predicate`` per period, and its rolling mean
    over the current and ``n - 1`` previous periods.

    The rate is ``count_if * 100.0 / count`` as an exact 5-place decimal; the
    mean of those decimals is published rounded to 6 places (exact integer
    arithmetic). The default frame is rows (previous periods *with data*,
    as in the reference); give ``calendar_index`` (an integer index of the
    period) for a range frame over calendar periods instead.

    The window runs over the per-period aggregate: one row per period, a
    size bounded by the calendar span, not by the data. ``many_periods`` is
    for a long span of short periods: the aggregate is cut into blocks of
    ``BLOCK`` positions, each with the ``n - 1`` before it as a halo, and the
    window runs block by block.
    """
    per = df.groupBy(period_col.alias(period_name)).agg(
        F.count_if(predicate).alias("_hit"), F.count(F.lit(1)).alias("_all"),
        *([F.first(calendar_index).alias("_idx")] if calendar_index is not None else []),
    )
    per = per.withColumn("_rate5", F.expr(percent_units_sql("_hit", "_all", 5)))
    if calendar_index is None and many_periods:
        per = per.join(dense_keys(per, period_name, "_idx"), period_name)  # a place per period
    if many_periods:
        own = F.floor(F.col("_idx") / BLOCK)
        per = per.withColumn("_own", own).withColumn("_block", F.explode(F.sequence(own, F.floor((F.col("_idx") + (n - 1)) / BLOCK))))
        parts = ("_block",)
    else:
        parts = ()
    if calendar_index is None:
        w = Window.partitionBy(*parts).orderBy(period_name).rowsBetween(-(n - 1), Window.currentRow)
    else:
        w = Window.partitionBy(*parts).orderBy("_idx").rangeBetween(-(n - 1), Window.currentRow)
    per = per.withColumn("_s", F.sum("_rate5").over(w)).withColumn("_k", F.count("_rate5").over(w))
    if many_periods:
        per = per.where(F.col("_block") == F.col("_own"))
    return per.select(
        period_name,
        (F.col("_rate5").cast("double") / 10**5).alias(rate_col),
        (F.expr(rolling_mean_sql("_s", "_k")).cast("double") / 10**ROLLING_PLACES).alias(rolling_col),
    )


def rolling_mean_sql(sum_col: str, count_col: str, dialect: str = "spark") -> str:
    """Mean of ``count_col`` rates given in 10**-5 units (their sum is
    ``sum_col``), rounded half up to 10**-6 units: (2 * S * 10 + k) div 2k."""
    div = "div" if dialect == "spark" else "//"
    wide = "decimal(38,0)" if dialect == "spark" else "HUGEINT"
    return f"(((CAST({sum_col} AS {wide}) * 20) + {count_col}) {div} ({count_col} * 2))"


# ---------------------------------------------------------------------------
# P5
# ---------------------------------------------------------------------------
def conditional_counts(
    df: DataFrame,
    keys: Sequence[str],
    predicates: Mapping[str, Column],
    total_col: str | None = None,
    count_col: str | None = None,
    distinct_col: str | None = None,
) -> DataFrame:
    """Per key: ``SUM(CASE WHEN p THEN 1 ELSE 0 END)`` for each named predicate,
    plus the row count (``COUNT(count_col)``, or distinct values of
    ``distinct_col``) as ``total_col``."""
    aggs = []
    if total_col:
        if distinct_col:
            aggs.append(F.countDistinct(distinct_col).alias(total_col))
        elif count_col:
            aggs.append(F.count(count_col).alias(total_col))
        else:
            aggs.append(F.count(F.lit(1)).alias(total_col))
    aggs += [F.count_if(p).alias(name) for name, p in predicates.items()]
    return df.groupBy(*keys).agg(*aggs)


# ---------------------------------------------------------------------------
# P6
# ---------------------------------------------------------------------------
def tiered_label(rules: Sequence[tuple[Column, str]], default: str | None = None) -> Column:
    """``CASE WHEN r1 THEN l1 WHEN r2 THEN l2 ... ELSE default END``: the first
    matching rule wins."""
    expr = F.lit(default).cast("string") if default is not None else F.lit(None).cast("string")
    for cond, label in reversed(list(rules)):
        expr = F.when(cond, F.lit(label)).otherwise(expr)
    return expr

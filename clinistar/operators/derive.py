"""Table-derivation steps of the reference generator as seeded Spark transforms (E1-E10).

The generator draws with unseeded ``random`` in one Python loop. Here every
draw is a function of ``md5(seed || key)``, so a step is repeatable, runs
in parallel on any partitioning, and gives the same values in any engine
that has md5. Each function is a column expression or a lazy transform.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from fractions import Fraction

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clinistar.functions.keys import dense_keys
from clinistar.functions.scalar import draw_edge, seeded_bucket, seeded_draw

#: Parts that a key's items are ranked in before they meet.
SAMPLE_PARTS = 32

# Fixed values of the reference generator.
# Appointment status weights.
STATUS_WEIGHTS = (("Scheduled", 0.1), ("Completed", 0.8), ("Cancelled", 0.1))
# Allergy severity weights.
SEVERITY_WEIGHTS = (("Low", 0.4), ("Medium", 0.35), ("High", 0.25))
# Allergy share of the allergy master list.
ALLERGY_SHARES = (
    ("Peanuts", 0.15), ("Shellfish", 0.12), ("Penicillin", 0.1), ("Latex", 0.08),
    ("Eggs", 0.07), ("Milk", 0.06), ("Tree Nuts", 0.05), ("Pollen", 0.04),
    ("Dust Mites", 0.03), ("Other", 0.2),
)


def _key(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


# E1 -----------------------------------------------------------------------
def weighted_bucket(key: str | Column, weights: Sequence[tuple[str, float]], seed: str = "") -> Column:
    """Category drawn with the given weights: the 60-bit draw of
    md5(seed || key), cut at the exact cumulative weights."""
    draw = seeded_draw(_key(key), seed)
    expr = F.lit(weights[-1][0])
    edges, acc = [], Fraction(0)
    for label, w in weights[:-1]:
        acc += Fraction(str(w))
        edges.append((draw_edge(acc), label))
    for edge, label in reversed(edges):
        expr = F.when(draw < edge, F.lit(label)).otherwise(expr)
    return expr


# E2 -----------------------------------------------------------------------
def sample_k_per_key(df: DataFrame, key: str, item: str, k: int | Column, seed: str = "",
                     rank_col: str = "SampleRank") -> DataFrame:
    """k distinct items per key without replacement, drawn for each key on its
    own: the k items with the smallest md5(seed | key | item). ``k`` is a
    number or a column of ``df`` that is constant per key.

    A key is first cut to k rows in each of ``SAMPLE_PARTS`` parts, so a key
    with a huge share of the rows, or a large k, is ranked in parts; only the
    parts' winners meet.
    """
    order = [F.md5(F.concat_ws("|", F.lit(seed), F.col(key).cast("string"), F.col(item).cast("string"))), F.col(item)]
    limit = k if isinstance(k, Column) else F.lit(k)
    part = F.pmod(F.xxhash64(key, item), F.lit(SAMPLE_PARTS))
    first = Window.partitionBy(key, "_part").orderBy(*order)
    first_cut = df.withColumn("_part", part).withColumn(rank_col, F.row_number().over(first)).where(F.col(rank_col) <= limit)
    w = Window.partitionBy(key).orderBy(*order)
    return first_cut.drop("_part").withColumn(rank_col, F.row_number().over(w)).where(F.col(rank_col) <= limit)


# E3 -----------------------------------------------------------------------
def fan_out(df: DataFrame, n: str | Column, index_col: str = "ChildIndex") -> DataFrame:
    """``n`` child rows per row, numbered 1..n; none when n <= 0 or NULL
    (``sequence(1, 0)`` would count down, so it is guarded)."""
    cnt = _key(n)
    seq = F.when(cnt >= 1, F.sequence(F.lit(1).cast("long"), cnt.cast("long")))
    return df.withColumn(index_col, F.explode(seq))


# E4 -----------------------------------------------------------------------
def assign_foreign_key(
    child: DataFrame, child_key: str, parents: DataFrame, parent_key: str,
    out_col: str, seed: str = "",
) -> DataFrame:
    """A parent for each child: parent number md5(seed || child key) mod
    (number of parents), joined to the parents' dense numbering (1..n in key
    order). The parent count is a scalar subquery, so nothing runs before the
    result is used; without parents the column is NULL."""
    numbered = dense_keys(parents, parent_key, "_parent_no")
    n_parents = numbered.agg(F.count(F.lit(1)).alias("n")).scalar()
    pick = F.pmod(seeded_draw(F.col(child_key), seed), F.nullif(n_parents, F.lit(0))) + 1
    return child.withColumn("_parent_no", pick).join(
        numbered.withColumnRenamed(parent_key, out_col), "_parent_no", "left"
    ).drop("_parent_no")


# E5 -----------------------------------------------------------------------
def null_out_fraction(col: str, fraction: float, key: str | Column, seed: str = "") -> Column:
    """``col``, or NULL for a ``fraction`` of the rows (by seeded draw)."""
    return F.when(seeded_draw(_key(key), seed) < draw_edge(fraction), F.lit(None)).otherwise(F.col(col))


# E6 -----------------------------------------------------------------------
def lookup_default(
    df: DataFrame, key: str, lookup: Mapping | DataFrame, default, out_col: str,
    lookup_key: str | None = None, lookup_value: str | None = None,
) -> DataFrame:
    """Value looked up by ``key`` with a fallback. A literal mapping becomes
    a map expression (no join); a lookup DataFrame (unique on its key) is
    left-joined, and Spark broadcasts it only if it measures small."""
    if isinstance(lookup, Mapping):
        pairs = []
        for k, v in lookup.items():
            pairs += [F.lit(k), F.lit(v)]
        m = F.create_map(*pairs)
        return df.withColumn(out_col, F.coalesce(F.try_element_at(m, F.col(key)), F.lit(default)))
    lk, lv = lookup_key or key, lookup_value or out_col
    right = lookup.select(F.col(lk).alias("_lk"), F.col(lv).alias("_lv"))
    return (
        df.join(right, df[key] == right["_lk"], "left")
        .withColumn(out_col, F.coalesce(F.col("_lv"), F.lit(default)))
        .drop("_lk", "_lv")
    )


# E7 -----------------------------------------------------------------------
def format_code(pattern: str, col: str | Column) -> Column:
    """``MD000001`` / ``POL000001`` (pattern ``MD%06d``) or ``<n>mg`` (``%dmg``)."""
    return F.format_string(pattern, _key(col))


def capitalize(col: str | Column) -> Column:
    """First character upper case, the rest lower case (Python's
    ``str.capitalize``, which the generator applies to names; ``initcap``
    would capitalize every word instead)."""
    c = _key(col)
    return F.concat(F.upper(F.substring(c, 1, 1)), F.lower(F.substring(c, 2, 1 << 30)))


# E8 -----------------------------------------------------------------------
def apportion(shares: DataFrame, total: int | Column, category: str, share: str,
              index_col: str = "ItemIndex") -> DataFrame:
    """floor(total * share) rows per category (shares as DOUBLE, like the
    generator's float arithmetic), numbered 1..n within the category."""
    n = F.floor((total if isinstance(total, Column) else F.lit(total)).cast("double") * F.col(share).cast("double")).cast("long")
    return fan_out(shares.withColumn("_n", n), "_n", index_col).drop("_n")


# E9 -----------------------------------------------------------------------
def clamp_range(df: DataFrame, candidates: Sequence[str | Column], end: str | Column,
                out_col: str = "RangeStart") -> DataFrame:
    """start = greatest(candidates); rows with start >= end are dropped."""
    start = F.greatest(*[_key(c) for c in candidates])
    return df.withColumn(out_col, start).where(F.col(out_col) < _key(end))


# E10 ----------------------------------------------------------------------
def derive_period(df: DataFrame, ts: str, key: str, min_days: int = 7, max_days: int = 30,
                  seed: str = "", start_col: str = "StartDate", end_col: str = "EndDate") -> DataFrame:
    """StartDate = date of ``ts``; EndDate = StartDate + a seeded draw of
    min_days..max_days days."""
    span = max_days - min_days + 1
    days = seeded_bucket(F.col(key), span, seed) + min_days
    return df.withColumn(start_col, F.to_date(F.col(ts))).withColumn(
        end_col, F.date_add(F.col(start_col), days.cast("int"))
    )

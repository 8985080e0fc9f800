"""Column expressions shared by the operators.

All of these are built-in Spark expressions, so they stay inside
whole-stage codegen; none of them is a Python UDF.

``ROUND(x * 100.0 / y, 2)`` of the reference is computed from the exact
quotient, rounded once, half away from zero, in integer arithmetic (``div`` on
decimal(38,0) is an exact integral quotient). Only the cancellation rate is
first rounded to 5 places, the scale of the reference's division, because
that rounded rate is what it averages.
"""

from __future__ import annotations

from fractions import Fraction

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the reference model (kept as written there).
CANCELLED = "Cancelled"
# Symptoms are 1-3 entries joined by a comma and a space.
SYMPTOM_SEPARATOR = ", "


def _dialect(dialect: str) -> tuple[str, str]:
    if dialect == "spark":
        return "decimal(38,0)", "div"
    if dialect == "duckdb":
        return "HUGEINT", "//"
    raise ValueError(f"unknown dialect {dialect!r}")


def percent_units_sql(num: str, den: str, places: int, dialect: str = "spark") -> str:
    """SQL for ``num * 100 / den`` rounded half away from zero to ``places``
    decimals, returned as a signed integer count of 10**-places. NULL when
    ``den`` is 0 or NULL (MySQL semantics; never an ANSI error)."""
    wide, div = _dialect(dialect)
    n = f"CAST(abs({num}) AS {wide})"
    d = f"CAST(abs({den}) AS {wide})"
    scale = 2 * 10 ** (places + 2)
    q = f"((({n} * {scale}) + {d}) {div} ({d} * 2))"
    return (
        f"(CASE WHEN ({den}) = 0 THEN NULL "
        f"WHEN (({num}) < 0) <> (({den}) < 0) THEN -{q} ELSE {q} END)"
    )


def pct_round2_sql(num: str, den: str, dialect: str = "spark") -> str:
    """``ROUND(num * 100.0 / den, 2)`` of the reference, as DOUBLE."""
    return f"(CAST({percent_units_sql(num, den, 2, dialect)} AS DOUBLE) / 100.0)"


def pct_round2(num: str, den: str) -> Column:
    """Column version of :func:`pct_round2_sql` over two column names/expressions."""
    return F.expr(pct_round2_sql(num, den, "spark"))


def ts_range(col: str, start, end, end_inclusive_day: bool = False) -> Column:
    """``col BETWEEN start AND end`` with DATE bounds on a datetime column.

    As in the reference, a DATE bound becomes midnight, so the end day only
    counts at 00:00:00. ``end_inclusive_day`` takes the whole end day. A
    ``None`` bound leaves that side open.
    """
    c = F.col(col)
    cond = F.lit(True)
    if start is not None:
        cond = cond & (c >= F.lit(start).cast("timestamp_ntz"))
    if end is not None:
        if end_inclusive_day:
            cond = cond & (c < F.date_add(F.lit(end), 1).cast("timestamp_ntz"))
        else:
            cond = cond & (c <= F.lit(end).cast("timestamp_ntz"))
    return cond


def year_of(col: str) -> Column:
    return F.year(F.col(col)).cast("int")


def month_index(col: str) -> Column:
    """Months since year 0, an int that sorts like the months: what rows are grouped by."""
    return F.year(F.col(col)) * 12 + F.month(F.col(col)) - 1


def month_text(index: str) -> Column:
    """``DATE_FORMAT(ts, '%Y-%m')`` of the reference, from the month's index."""
    i = F.col(index)
    year, month = F.floor(i / 12).cast("int"), (i % 12 + 1).cast("int")
    return F.concat(F.lpad(year.cast("string"), 4, "0"), F.lit("-"), F.lpad(month.cast("string"), 2, "0"))


def normalized_symptoms(col: str, mode: str) -> Column:
    """Symptom grouping key. ``raw``: the stored string; ``set``: entries
    sorted, so order does not matter. (``exploded`` is handled by the caller.)"""
    if mode == "raw":
        return F.col(col)
    if mode == "set":
        return F.array_join(F.array_sort(F.split(F.col(col), SYMPTOM_SEPARATOR)), SYMPTOM_SEPARATOR)
    raise ValueError(f"unknown symptom mode {mode!r}")


#: A seeded draw has this many bits.
DRAW_BITS = 60


def seeded_draw(key: Column, seed: str = "") -> Column:
    """Repeatable pseudo-random number in [0, 2**60): the first 60 bits of
    md5(seed || key). Same value in DuckDB."""
    text = F.concat(F.lit(seed), key.cast("string"))
    return F.conv(F.substring(F.md5(text), 1, DRAW_BITS // 4), 16, 10).cast("long")


def seeded_bucket(key: Column, buckets: int = 100, seed: str = "") -> Column:
    """The seeded draw modulo ``buckets``."""
    return F.pmod(seeded_draw(key, seed), F.lit(buckets))


def draw_edge(share: float | str) -> int:
    """Draws below this are the given share of all draws; the share is taken
    as the decimal it is written as."""
    return int(Fraction(str(share)) * 2**DRAW_BITS)

"""Join shapes that stay safe when one key holds a large share of the rows.

Spark's adaptive skew handling can split an oversized partition of either
side of an *inner* join, but only the preserved side of an outer join. An
outer join whose hot key sits on the other side would run in one task. We
therefore make outer joins inner ones: a key that the other side lacks gets a
*placeholder* there, a row that is NULL but for the key. Which keys need one
is found by one aggregate over the keys of all sides, a bit per side. It
combines map-side, so a hot key is one row per map task, and it is one shuffle
that all placeholders share. Each side is read twice: for its rows, and for
its keys.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _null_of(df: DataFrame, name: str) -> Column:
    return F.lit(None).cast(df.schema[name].dataType).alias(name)


def _sides(frames: Sequence[DataFrame], keys: Sequence[str]) -> DataFrame:
    """``keys`` and ``_sides``: bit i is set if ``frames[i]`` has the key."""
    flagged = [df.select(*keys, F.lit(1 << i).alias("_side")) for i, df in enumerate(frames)]
    return reduce(DataFrame.unionAll, flagged).groupBy(*keys).agg(F.bit_or("_side").alias("_sides"))


def _filled(df: DataFrame, missing: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``df`` and a placeholder for each key of ``missing``."""
    return df.unionByName(missing.select(*[F.col(k) if k in keys else _null_of(df, k) for k in df.columns]))


def _meet(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Inner join on equal keys, NULL equal to NULL (a row without a key meets
    its placeholder). Columns: keys, the rest of left, the rest of right."""
    renamed = right.select(*[F.col(c).alias(f"_r_{c}") if c in keys else F.col(c) for c in right.columns])
    on = reduce(Column.__and__, (left[k].eqNullSafe(renamed[f"_r_{k}"]) for k in keys))
    rest = [c for c in left.columns if c not in keys]
    return left.join(renamed, on).select(*keys, *rest, *[c for c in right.columns if c not in keys])


def _lacks(*sides: int) -> Column:
    return reduce(Column.__and__, (F.col("_sides").bitwiseAND(F.lit(1 << s)) == 0 for s in sides))


def _with_key(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows without a key match nothing, so the side that isn't preserved drops them."""
    return df.where(reduce(Column.__and__, (F.col(k).isNotNull() for k in keys)))


def left_outer_joins(left: DataFrame, rights: Sequence[DataFrame], keys: Sequence[str]) -> DataFrame:
    """``left LEFT JOIN r1 USING (keys) LEFT JOIN r2 USING (keys) ...`` with
    inner joins only (see module doc); every frame is read twice at most.

    Output columns: keys, then the other columns of each frame in turn (those
    of ``rights`` NULL on unmatched rows).
    """
    keys = list(keys)
    rights = [_with_key(r, keys) for r in rights]
    sides = _sides([left, *rights], keys).where(~_lacks(0))
    out = left.select(*keys, *[c for c in left.columns if c not in keys])
    for i, right in enumerate(rights):
        out = _meet(out, _filled(right, sides.where(_lacks(i + 1)), keys), keys)
    return out


def left_outer_join(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``left LEFT JOIN right USING (keys)`` as an inner join with placeholders."""
    return left_outer_joins(left, [right], keys)


def full_outer_join(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``left FULL JOIN right USING (keys)`` with placeholders on both sides.
    Rows without a key match nothing and are kept on their own."""
    keys = list(keys)
    on_left, on_right = _with_key(left, keys), _with_key(right, keys)
    sides = _sides([on_left, on_right], keys)
    joined = _meet(_filled(on_left, sides.where(_lacks(0)), keys), _filled(on_right, sides.where(_lacks(1)), keys), keys)
    loose = lambda df: df.where(reduce(Column.__or__, (F.col(k).isNull() for k in keys)))
    return joined.unionByName(loose(left), allowMissingColumns=True).unionByName(loose(right), allowMissingColumns=True)

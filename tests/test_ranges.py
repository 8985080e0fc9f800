"""Operators cut into ranges equal one plain window, whatever the ranges,
hot entities, ties across edges and missing values."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from clinistar.functions import ranges
from clinistar.operators import generic as G


@pytest.fixture(autouse=True)
def short_ranges(monkeypatch):
    monkeypatch.setattr(ranges.with_range, "__defaults__", ("_range", 16))
    monkeypatch.setattr(ranges, "SAMPLE", 64)
    monkeypatch.setattr(G, "BLOCK", 7)


def bag(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def entities(spark):
    """One entity has most periods; some periods are missing, some counts are 0 or NULL."""
    rng = random.Random(1)
    rows = [("hot", p, rng.choice([0, 1, 5, None, 40])) for p in range(600) if rng.random() < 0.9]
    rows += [(e, p, rng.randrange(9)) for e in ("a", "b", None) for p in rng.sample(range(600), 20)]
    return spark.createDataFrame(rows, "e string, p int, n long").repartition(5)


def test_ranges_are_even_and_ordered(spark):
    df = spark.range(4000).select(F.md5(F.col("id").cast("string")).alias("v"))
    rows = ranges.with_range(df, "v").collect()
    assert all(a["_range"] <= b["_range"] for a, b in zip(sorted(rows), sorted(rows)[1:]))
    sizes = [sum(r["_range"] == k for r in rows) for k in range(16)]
    assert sum(sizes) == 4000 and max(sizes) < 800
    again = ranges.with_range(df.repartition(7), "v").collect()
    assert sorted(map(tuple, rows)) == sorted(map(tuple, again))  # whatever the partitions


@pytest.mark.parametrize("strict", [False, True])
def test_spread_lag_equals_lag(spark, strict):
    df = entities(spark)
    plain = G.period_change(df, ["e"], "p", "n", "prev", "change", strict=strict)
    spread = G.period_change(df, ["e"], "p", "n", "prev", "change", strict=strict, spread=True)
    assert spread.columns == plain.columns and bag(spread) == bag(plain)
    groups = ranges.with_range(df.withColumn("_place", F.struct("e", "p")), "_place").where("e = 'hot'").groupBy("_range").count().collect()
    assert len(groups) > 8 and max(r["count"] for r in groups) < 200  # the hot entity is split
    assert G.period_change(df.limit(0), ["e"], "p", "n", spread=True).count() == 0


@pytest.mark.parametrize("kind", ["double", "decimal(12,2)", "string", "date"])
def test_rank_of_any_measure_equals_rank(spark, kind):
    rng = random.Random(2)
    rows = [(rng.choice([1, 1, 1, 2, None]), rng.choice([None, 7, rng.randrange(300), rng.randrange(300)])) for _ in range(1500)]
    measure = {"date": F.date_add(F.lit("2020-01-01").cast("date"), F.col("m")), "string": F.col("m").cast("string")}.get(kind, (F.col("m") / 4).cast(kind))
    df = spark.createDataFrame(rows, "p int, m int").select("p", measure.alias("m"))
    want = df.withColumn("r", F.rank().over(Window.partitionBy("p").orderBy(F.desc("m"))).cast("int"))
    assert bag(G.rank_in_period(df, "p", "m", "r")) == bag(want)
    assert bag(G.rank_in_period(df, "p", "m", "r", k=5)) == bag(want.where("r <= 5"))
    assert G.rank_in_period(df.limit(0), "p", "m", "r").count() == 0


@pytest.mark.parametrize("n", [1, 3, 7, 8, 25])
@pytest.mark.parametrize("calendar", [False, True])
def test_blocks_with_a_halo_equal_one_window(spark, n, calendar):
    rng = random.Random(3)
    rows = [(p, rng.random() < 0.3) for p in rng.sample(range(400), 150) for _ in range(rng.randrange(1, 4))]
    df = spark.createDataFrame(rows, "p int, hit boolean")
    index = F.col("p") if calendar else None
    one, many = (G.rolling_rate(df, F.col("p"), "p", F.col("hit"), "rate", "mean", n=n, calendar_index=index, many_periods=m) for m in (False, True))
    assert bag(many) == bag(one)
    plan = many._jdf.queryExecution().executedPlan().toString()
    assert not calendar or "SinglePartition" not in plan


@pytest.mark.parametrize("n", [0, 1, 17, 400, 999, 1000, 5000])
def test_top_rows_of_any_length(spark, n):
    df = spark.range(1000).select("id", (F.col("id") % 7).alias("m"))
    got = ranges.top_rows(df, F.struct((-F.col("m")).alias("m"), "id"), n)
    assert got.columns == ["id", "m"]
    assert bag(got) == bag(df.orderBy(F.desc("m"), "id").limit(n))


def test_a_range_is_found_by_bisection(spark):
    """Lambdas sort and pick the bounds; none runs over all of them for each row."""
    rows = [(v,) for v in [None, float("nan"), float("-inf"), 0.0, -0.0] + [i / 8 for i in range(-300, 300)] * 2]
    df = ranges.with_range(spark.createDataFrame(rows, "v double").repartition(3), "v")
    assert df._jdf.queryExecution().analyzed().toString().count("lambdafunction(") == 2
    got = sorted(((r["v"] is not None, r["v"] != r["v"], r["v"]), r["_range"]) for r in df.collect() if r["v"] is None or r["v"] == r["v"])
    assert [k for _, k in got] == sorted(k for _, k in got) and got[0][1] == 0
    every = {k for _, k in got}
    assert every == set(range(max(every) + 1)) and 8 <= len(every) <= 17  # no range is skipped
    same = {v: k for (_, _, v), k in got}
    assert all(same[v] == k for (_, _, v), k in got)

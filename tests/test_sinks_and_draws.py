"""Sinks, session settings, the CSV source, and seeded draws."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from clinistar.functions.scalar import draw_edge, pct_round2
from clinistar.operators import analytics as A
from clinistar.operators import derive as E
from clinistar.plans import builders as B
from clinistar.plans.model import Warehouse
from clinistar.session import ensure_checkpoint_dir, get_spark, scale_conf
from clinistar.sources import files, proxy

SF = "/root/testdata/sf0.001"


def test_rebuild_with_fewer_years_replaces_the_fact(spark, tmp_path):
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        star = proxy.star(spark, SF)
        B.materialize(star, str(tmp_path), tables=("Fact_PatientInteractions",))
        late = star.fact().where(F.year("AppointmentDateTime") >= 1999)
        again = Warehouse("star", star.tables | {"Fact_PatientInteractions": late})
        written = B.materialize(again, str(tmp_path), tables=("Fact_PatientInteractions",))
        assert written.fact().count() == late.count() < star.fact().count()
    finally:
        spark.conf.unset("spark.sql.sources.partitionOverwriteMode")


def test_priority_target_may_not_hold_or_lie_in_the_source(spark, tmp_path):
    star = proxy.star(spark, SF)
    wh = B.materialize(star, str(tmp_path / "wh"), tables=("Fact_PatientInteractions",))
    fact = tmp_path / "wh" / "Fact_PatientInteractions"
    for target in (fact, fact / "inside", tmp_path / "wh"):
        with pytest.raises(ValueError, match="elsewhere"):
            A.write_treatment_priority(wh, str(target))
    A.write_treatment_priority(wh, str(tmp_path / "wh" / "Fact_PatientInteractions2"))


def test_session_keeps_the_platforms_partitions(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "777")
    try:
        assert get_spark().conf.get("spark.sql.shuffle.partitions") == "777"
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_no_local_checkpoint_folder_on_a_cluster():
    class Conf:
        def get(self, key, default=None):
            return default

    class Context:
        master = "spark://host:7077"
        getConf = staticmethod(Conf)

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext, conf = Context(), Conf()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(Session())


def test_scale_conf_has_no_cap():
    assert int(scale_conf(100 * 1024**4)["spark.sql.shuffle.partitions"]) == 100 * 1024**4 // (128 * 1024**2)


def test_csv_header_is_checked(spark, tmp_path):
    schema = StructType([StructField("FirstName", StringType()), StructField("LastName", StringType())])
    for name, text in (("ok", "FirstName,LastName\nAnn,Smith\n"), ("swapped", "LastName,FirstName\nSmith,Ann\n"), ("short", "FirstName\nAnn\n")):
        (tmp_path / f"{name}.csv").write_text(text)
    assert files.read_csv(spark, str(tmp_path / "ok.csv"), schema).first().FirstName == "Ann"
    for name in ("swapped", "short"):
        with pytest.raises(Exception):
            files.read_csv(spark, str(tmp_path / f"{name}.csv"), schema).collect()


def test_fine_shares(spark):
    n = 100_000
    df = spark.range(n).select(
        E.weighted_bucket("id", (("a", 0.004), ("b", 0.125), ("c", 0.871)), "s").alias("c"),
        E.null_out_fraction("id", 0.004, "id", "t").alias("x"),
    )
    counts = {r.c: r["count"] for r in df.groupBy("c").count().collect()}
    assert abs(counts["a"] - 400) < 100 and abs(counts["b"] - 12_500) < 600
    assert abs(df.where("x is null").count() - 400) < 100
    assert draw_edge(0.1) == 2**60 // 10 and draw_edge(1) == 2**60


def test_each_key_draws_on_its_own(spark):
    df = spark.range(6).withColumnRenamed("id", "key").withColumn("item", F.explode(F.sequence(F.lit(1), F.lit(50))))
    got = E.sample_k_per_key(df, "key", "item", 3, "s").groupBy("key").agg(F.sort_array(F.collect_list("item")).alias("items"))
    drawn = {tuple(r["items"]) for r in got.collect()}
    assert len(drawn) > 3 and all(len(set(x)) == 3 for x in drawn)
    per = E.sample_k_per_key(df, "key", "item", F.pmod("key", F.lit(4)).cast("int"), "s").groupBy("key").count().collect()
    assert {r.key: r["count"] for r in per} == {1: 1, 2: 2, 3: 3, 5: 1}


def test_rounding_is_applied_once(spark):
    df = spark.createDataFrame([(11704, 328303), (-11704, 328303), (1, 8), (-1, 8), (5, 0), (0, 7)], "a long, b long")
    assert [r[0] for r in df.select(pct_round2("a", "b")).collect()] == [3.56, -3.56, 12.5, -12.5, None, 0.0]


def test_dates(spark):
    df = spark.range(40).select(F.lit(dt.datetime(2020, 2, 28)).cast("timestamp_ntz").alias("ts"), "id")
    days = {(r.EndDate - r.StartDate).days for r in E.derive_period(df, "ts", "id").collect()}
    assert min(days) >= 7 and max(days) <= 30 and len(days) > 5

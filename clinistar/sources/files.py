"""File sources and sinks: headered CSV (the generator's format) and Parquet.

Reads always carry an explicit schema. Writes go to directories (Spark
writes one file per task); the reference's single zip archive is not
reproduced.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from clinistar.schemas import OLTP_SCHEMAS
from clinistar.session import ensure_checkpoint_dir


def read_csv(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("mode", "FAILFAST")
        .option("enforceSchema", False)  # the header must name the schema's columns in order
        .option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss[.SSSSSS]")
        .csv(path)
    )


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Headered CSV without an index column, like the generator's output."""
    df.write.mode(mode).option("header", True).option(
        "timestampNTZFormat", "yyyy-MM-dd HH:mm:ss[.SSSSSS]"
    ).csv(path)


def read_oltp(spark: SparkSession, root: str, fmt: str = "csv") -> dict[str, DataFrame]:
    """The 14 OLTP tables under ``root`` (``<Table>.csv`` or ``<Table>.parquet``
    files or directories), each with its declared schema."""
    root = root.rstrip("/")
    out = {}
    for name, schema in OLTP_SCHEMAS.items():
        if fmt == "csv":
            out[name] = read_csv(spark, f"{root}/{name}.csv", schema)
        elif fmt == "parquet":
            out[name] = spark.read.schema(schema).parquet(f"{root}/{name}.parquet")
        else:
            raise ValueError(f"unknown format {fmt!r}")
    return out


def write_oltp(tables: dict[str, DataFrame], root: str, fmt: str = "csv") -> None:
    root = root.rstrip("/")
    for name, df in tables.items():
        if fmt == "csv":
            write_csv(df, f"{root}/{name}.csv")
        else:
            df.write.mode("overwrite").parquet(f"{root}/{name}.parquet")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh folder under the shared checkpoint folder (never machine-local
    on a cluster: that folder is the one the cluster names)."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/{label}-{uuid.uuid4().hex}"


def csv_roundtrip(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as headered CSV and read it back with its own schema."""
    path = scratch_path(df.sparkSession, f"csv-{label}")
    write_csv(df, path)
    return read_csv(df.sparkSession, path, df.schema)

"""Spark session defaults and the shared checkpoint folder.

Every operator in the library is lazy DataFrame code. ``get_spark`` adds the
few settings that the results or plans rely on (session zone, adaptive
execution) and leaves sizes, such as shuffle partitions, to the platform.
"""

from __future__ import annotations

import os
import re
import tempfile

from pyspark.sql import SparkSession

#: Settings every session of ours carries. AQE re-plans joins at runtime
#: (broadcast conversion from measured shuffle sizes, skew splitting,
#: partition coalescing); timestamps have no zone in the model, so the
#: session zone is pinned to UTC.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_spark(
    master: str | None = None,
    app_name: str = "clinistar",
    shuffle_partitions: int | None = None,
    extra_conf: dict[str, str] | None = None,
) -> SparkSession:
    """Build (or reuse) a session with the library defaults. The number of
    shuffle partitions is the platform's unless one is given."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.setdefault("spark.driver.memory", os.environ.get("CLINISTAR_DRIVER_MEMORY", "8g"))
    conf.update(extra_conf or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, creating a local one only when unset.

    A cluster names its shared (distributed) folder in ``spark.checkpoint.dir``;
    that setting always wins. Only a session without one - a test or a local
    benchmark - gets a fresh scratch folder.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect: no SparkContext on the client
        sc = None
    if sc is not None and sc.getCheckpointDir():
        return sc.getCheckpointDir()
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured and sc is not None:
        configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        master = sc.master if sc is not None else spark.conf.get("spark.master", "")
        if not re.match(r"local(\[|$)", master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        configured = tempfile.mkdtemp(prefix="clinistar-ckpt-")
        if sc is None:
            spark.conf.set("spark.checkpoint.dir", configured)
    if sc is None:
        return configured
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scale_conf(
    input_bytes: int,
    target_partition_bytes: int = 128 * 1024**2,
    broadcast_bytes: int = 64 * 1024**2,
) -> dict[str, str]:
    """Session settings sized for an input of ``input_bytes`` (e.g. the
    fact's Parquet size).

    Shuffle partitions are set so the largest possible shuffle - the whole
    input - splits into ~``target_partition_bytes`` pieces; AQE then
    coalesces the many small partitions of aggregated shuffles back to the
    advisory size at runtime, and splits any partition over 4x that size in
    joins (skew). Scans read splits of the same size. The broadcast
    threshold is the size check for dimensions: anything larger is joined by
    shuffle.
    """
    parts = max(8, -(-input_bytes // target_partition_bytes))
    return {
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * target_partition_bytes),
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.autoBroadcastJoinThreshold": str(broadcast_bytes),
        "spark.sql.adaptive.autoBroadcastJoinThreshold": str(broadcast_bytes),
    }


def apply_conf(spark: SparkSession, conf: dict[str, str]) -> None:
    """Set runtime SQL settings on a live session."""
    for key, value in conf.items():
        spark.conf.set(key, value)

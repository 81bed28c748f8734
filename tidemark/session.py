"""Session construction and cluster-wide settings the engine relies on."""

from __future__ import annotations

import os
import re
import tempfile

from pyspark.sql import SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
CONF_HELP = f"set {CHECKPOINT_CONF} to a folder that the driver and all executors share"


def pin_utc(spark: SparkSession) -> None:
    """All time arithmetic in the engine assumes a UTC session clock."""
    if spark.conf.get("spark.sql.session.timeZone", None) != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def get_session(
    master: str | None = None,
    app: str = "tidemark",
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Local/test session with the settings the operators are tuned for.

    On a cluster the session normally comes from the platform; callers there
    should only apply :func:`pin_utc` and make sure ``spark.checkpoint.dir``
    names a shared folder.
    """
    cpus = os.environ.get("BENCH_CPUS", "8")
    builder = (
        SparkSession.builder.master(master or f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions or cpus))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("SPARK_DRIVER_MEMORY", "16g"))
        .config("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    )
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    pin_utc(spark)
    checkpoint_root(spark)
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder for lineage cuts, versioned tables and stream checkpoints.

    Read from ``spark.checkpoint.dir``. Only a local master may leave it unset
    (tests): a scratch folder is then made, as all tasks share the machine. A
    cluster session must name a folder that driver and executors share.
    """
    root = spark.conf.get(CHECKPOINT_CONF, None)
    if not root:
        if not re.fullmatch(r"local(\[[^]]*\])?", spark.conf.get("spark.master", "")):
            raise RuntimeError(CONF_HELP)
        root = tempfile.mkdtemp(prefix="tidemark-ckpt-")
        spark.conf.set(CHECKPOINT_CONF, root)
    try:
        if spark.sparkContext.getCheckpointDir() is None:
            spark.sparkContext.setCheckpointDir(root)
    except Exception:  # noqa: BLE001 -- Spark Connect has no SparkContext
        pass
    return root.rstrip("/")

"""Session construction and shared folders."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def get_spark(app: str = "access_lake", master: str | None = None,
              shuffle_partitions: int | None = None) -> SparkSession:
    """Return a session tuned for the DataFrame plans in this package.

    On a cluster ``master`` stays ``None`` and the launcher decides. The
    settings below override a cluster's own defaults for this session.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = {
        "spark.ui.enabled": "false",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        # timestamps without zone, like the reference's timestamp(6)
        "spark.sql.timestampType": "TIMESTAMP_NTZ",
        "spark.sql.sources.partitionOverwriteMode": "dynamic",
    }
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if master and master.startswith("local"):
        # local mode: the driver JVM is the only executor
        conf["spark.driver.memory"] = os.environ.get("ACCESS_LAKE_DRIVER_MEMORY", "16g")
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, setting one only when unset.

    On a cluster ``spark.checkpoint.dir`` names a shared folder and is used
    as is. A private temporary folder is chosen only under a local master
    with nothing set (tests); a cluster without the setting is an error.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not current:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        current = tempfile.mkdtemp(prefix="access-lake-ckpt-")
        sc.setCheckpointDir(current)
    elif not sc.getCheckpointDir():
        sc.setCheckpointDir(current)
    return sc.getCheckpointDir() or current


def work_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder for written intermediate tables, below the shared
    checkpoint folder (never a machine-local path on a cluster)."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/access_lake/{name}-{uuid.uuid4().hex[:12]}"


"""Spark session construction and the shared storage root.

The storage root is where versioned tables, checkpoints and streaming state
live.  On a cluster it is the shared folder named by ``spark.checkpoint.dir``;
we only pick our own folder when the session has none (local runs, tests).
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

#: Of the tables that jobs write for later jobs: a quarter less than Spark's default on flat rows.
STORED_CODEC = "zstd"

DEFAULT_CONF = {
    "spark.ui.enabled": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Parquet timestamps without a zone stay timestamp_ntz (clinical wall-clock time).
    "spark.sql.parquet.inferTimestampNTZ.enabled": "true",
}


def build_session(master: str | None = None, app: str = "chartfold",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    storage_root(spark)
    return spark


def storage_root(spark: SparkSession) -> str:
    """Shared folder for written tables; ``spark.checkpoint.dir`` when set."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getCheckpointDir()
        if root:
            # getCheckpointDir appends a per-application uuid folder.
            root = os.path.dirname(root.rstrip("/"))
    if not root:
        # Executors of a cluster would each write to their own disk.
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = tempfile.mkdtemp(prefix="chartfold-")
        spark.conf.set("spark.checkpoint.dir", root)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(root.rstrip("/") + "/rdd-checkpoints")
    return root.rstrip("/")


def scratch_path(spark: SparkSession, *parts: str) -> str:
    """A fresh, unique path under the shared storage root."""
    import uuid
    return "/".join([storage_root(spark), "chartfold", *parts, uuid.uuid4().hex])

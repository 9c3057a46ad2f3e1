"""Spark session helpers: a local session for tests and the shared work folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Broadcast limit for model tables, in entries (rows x values carried per row).
# Model tables are bounded by the model, not by the packet data; the checks
# against this limit are the proof before a broadcast hint. Above it the same
# joins run as shuffle joins.
MAX_BROADCAST_ROWS = 2_000_000


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A local session configured the way the tests and bench expect."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("pktsieve")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def work_dir(spark: SparkSession) -> str:
    """Shared folder for checkpoints, stream sinks and written tables.

    Taken from ``spark.checkpoint.dir`` (the cluster's shared folder). Only a
    local-mode session with no such setting gets a fresh scratch folder.
    """
    sc = spark.sparkContext
    conf_dir = sc.getConf().get("spark.checkpoint.dir", None)
    current = sc.getCheckpointDir() if hasattr(sc, "getCheckpointDir") else None
    base = current or conf_dir
    if base is None:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
        base = tempfile.mkdtemp(prefix="pktsieve-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    if current is None:
        sc.setCheckpointDir(base)
        base = sc.getCheckpointDir() or base
    return base


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared work folder."""
    base = work_dir(spark).rstrip("/")
    return f"{base}/pktsieve/{name}/{uuid.uuid4().hex}"


def checkpointed(df):
    """``df.checkpoint()`` into the shared work folder (reliable, lineage cut)."""
    work_dir(df.sparkSession)
    return df.checkpoint()

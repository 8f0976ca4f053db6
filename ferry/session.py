"""Session helpers: a local session for tests and the shared scratch folder."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  driver_memory: str = "8g", warehouse: str | None = None) -> SparkSession:
    """Session for tests and the local bench; a cluster passes its own session."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("ferry")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.ansi.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", driver_memory)
        .config("spark.scheduler.mode", "FAIR")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.warehouse.dir", warehouse or tempfile.mkdtemp(prefix="ferry-warehouse-"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    shared_dir(spark)
    return spark


def shared_dir(spark: SparkSession, *parts: str) -> str:
    """A fresh folder under the cluster's shared checkpoint folder.

    The folder comes from the session (``spark.checkpoint.dir`` or the
    context's checkpoint directory). Only when neither is set and the master is local,
    as in a test run, a folder under the system temp directory is chosen and made the
    session's checkpoint directory; a cluster without one raises, because its executors
    would each write to a disk of their own.
    """
    sc = spark.sparkContext
    base = sc.getCheckpointDir()
    if not base:
        base = spark.conf.get("spark.checkpoint.dir", None)
        if base:
            sc.setCheckpointDir(base)
        elif not re.match(r"local(\[|$)", sc.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        else:
            sc.setCheckpointDir(tempfile.mkdtemp(prefix="ferry-ckpt-"))
        base = sc.getCheckpointDir()
    if not parts:
        return base
    return "/".join([base.rstrip("/"), *parts])


def fresh_dir(spark: SparkSession, label: str) -> str:
    """Unique path under the shared folder for one run's output (not created)."""
    return shared_dir(spark, "ferry", f"{label}-{uuid.uuid4().hex[:12]}")


"""Session settings the operators rely on, and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid
from functools import cache

from pyspark.sql import SparkSession

# Safe to set on a running session; all are SQL settings read at plan time.
SQL_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}

# Fixed once a session runs; worth setting on a cluster too. Plans here are built from many
# small expressions, and recording the Python line of each costs several calls to the JVM.
START_SETTINGS = {
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def prepare(spark: SparkSession) -> SparkSession:
    """Pin UTC day buckets and adaptive execution on a session made elsewhere."""
    for name, value in SQL_SETTINGS.items():
        if spark.conf.get(name, None) != value:
            spark.conf.set(name, value)
    return spark


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "sieveline") -> SparkSession:
    """A session for tests and the bench; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("SIEVELINE_DRIVER_MEMORY", "8g"))
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    )
    for name, value in (SQL_SETTINGS | START_SETTINGS).items():
        builder = builder.config(name, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


@cache
def _local_folder() -> str:
    return tempfile.mkdtemp(prefix="sieveline-")


def scratch_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh path under the shared folder in ``spark.checkpoint.dir``.

    Without that setting a machine-local folder is used, in local mode only:
    executors on other hosts could not read what the driver's disk holds.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        shared = _local_folder()
    return f"{shared.rstrip('/')}/sieveline/{purpose}-{uuid.uuid4().hex}"

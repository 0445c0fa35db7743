"""Session settings and the shared scratch area.

Nothing here is global state of the library: every operator takes DataFrames
and works with whatever session they belong to.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import SparkSession

RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # A hot key is split at run time even when that costs one more exchange.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


def local_session(app: str, cores: str | int = "*", memory: str = "8g") -> SparkSession:
    """A single-JVM session for tests and the benchmark."""
    n = os.cpu_count() if cores == "*" else int(cores)
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(n))
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    for key, value in RUNTIME_SETTINGS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch_root(spark: SparkSession) -> str:
    """The shared folder for checkpoints and staged tables.

    The cluster names it in ``spark.checkpoint.dir``.  A local session
    without that setting uses a folder in its warehouse.
    """
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not root:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        root = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/scratch"
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(root)
    return root


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, unused path below the shared scratch folder."""
    return f"{scratch_root(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"

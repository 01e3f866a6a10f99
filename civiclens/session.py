"""Session defaults for local runs, and the shared folder that stage tables go to."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"


def local_session(cores: str | int = 8, name: str = "civiclens", **settings: str) -> SparkSession:
    """A single-machine session for tests and the benchmark; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", os.environ.get("SPARK_DRIVER_MEMORY", "12g"))
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
    )
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    if not spark.sparkContext.getCheckpointDir():
        # One machine is the whole cluster here, so a folder of its own will do.
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="civiclens-"))
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors reach: ``spark.checkpoint.dir``, or the context's checkpoint folder.

    There is no fallback: a folder of one machine would be lost with it.
    """
    folder = spark.conf.get(CHECKPOINT_KEY, None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        raise ValueError(f"set {CHECKPOINT_KEY} to a folder all executors share")
    return folder.rstrip("/")

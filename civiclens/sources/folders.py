"""Folders of a table that grows by loads: one sub-folder per load, numbered from 0."""

from __future__ import annotations

import gc
import time
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

LOAD = "load"
CODEC = "zstd"
"""Codec of the tables written: a third smaller than with Spark's default on request rows."""
SLICES, SLICE_BYTES = 8, 16 << 20
"""A table is read so many times at most, and a slice of fewer bytes is not made."""
UNKNOWN_SIZE = 1 << 62
"""Spark's estimate for rows that lie in no file is beyond this."""


def listed(spark: SparkSession, folder: str) -> list[str]:
    """Names in a folder; none if it is not there."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    system = path.getFileSystem(spark._jsc.hadoopConfiguration())
    return [s.getPath().getName() for s in system.listStatus(path)] if system.exists(path) else []


def finished_loads(spark: SparkSession, folder: str) -> list[int]:
    """Numbers of the loads whose write was committed (Spark then leaves ``_SUCCESS``)."""
    loads = [name for name in listed(spark, folder) if name.startswith(f"{LOAD}=")]
    return sorted(int(name[len(LOAD) + 1 :]) for name in loads if "_SUCCESS" in listed(spark, f"{folder}/{name}"))


def read_loads(spark: SparkSession, folder: str, schema: StructType | str) -> DataFrame:
    """Rows of all finished loads under the schema, which may have more columns than a load's files."""
    loads = finished_loads(spark, folder)
    if not loads:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*[f"{folder}/{LOAD}={n}" for n in loads])


def release(spark: SparkSession) -> None:
    """Let go of finished jobs' shuffle files before the next large exchange.

    Executors delete them once the driver's JVM has collected the job, which it may not do for long. The first
    collection only gets to what holds the job.
    """
    gc.collect()
    spark._jvm.System.gc()
    time.sleep(0.05)
    spark._jvm.System.gc()


def slices_of(frame: DataFrame, key: str = "sr_number") -> list[DataFrame]:
    """The frame in slices by the hash of a key, to be worked on one after the other.

    All rows of a key are in one slice, so work by key gives the same rows, and at any time only one slice of the wide
    rows is in shuffle files. A frame is one slice if it is small or its size is not known; give one that is cheap to read again.
    """
    size = int(str(frame._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    n = 1 if size >= UNKNOWN_SIZE else max(1, min(SLICES, size // SLICE_BYTES))
    if n == 1:
        return [frame]
    return [frame.where(F.pmod(F.xxhash64(key), F.lit(n)) == i) for i in range(n)]


def release_after(frame: DataFrame) -> None:
    """``release`` after a job over the frame, if the tables it reads are large (or of unknown size): collecting takes some tenths of a second."""
    leaves = frame._jdf.queryExecution().optimizedPlan().collectLeaves()
    if sum(int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size())) >= SLICE_BYTES:
        release(frame.sparkSession)


def write_slices(slices: Iterable[DataFrame], path: str) -> None:
    """Write frames one after the other into one table, replacing it; only one's shuffle files are on disk at a time."""
    for n, part in enumerate(slices):
        part.write.mode("append" if n else "overwrite").option("compression", CODEC).parquet(path)
        release_after(part)


def drop_folder(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)

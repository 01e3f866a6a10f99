"""Reading the corpus tables and staging intermediate ones in the folder all executors share."""

from __future__ import annotations

import gc
import uuid
from collections.abc import Callable, Iterable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import civiclens
from civiclens.session import shared_folder

Batches = Iterator[pa.RecordBatch]

WORKER_SETTINGS = {
    "OMP_NUM_THREADS": "1",
    "OPENBLAS_NUM_THREADS": "1",
    "ARROW_DEFAULT_MEMORY_POOL": "system",
    "MALLOC_ARENA_MAX": "1",
    "MALLOC_MMAP_THRESHOLD_": str(1 << 20),
    "MALLOC_TRIM_THRESHOLD_": str(4 << 20),
}
"""A task has one core, so the linear algebra in it gets one thread. Workers outlive their tasks, and an executor holds
several: what a task has freed goes back to the machine instead of staying with an idle worker."""
BATCH_KEY, SPARK_BATCH, BATCH = "spark.sql.execution.arrow.maxBytesPerBatch", "67108864b", "4m"
"""Bytes of a batch on its way to Python, unless the session has a setting of its own. Spark's default holds a whole split of texts, twice."""


def ready_workers(spark: SparkSession) -> None:
    """Let Python workers on this machine import the library from wherever the driver did.

    On a cluster the library comes with ``--py-files`` or the image; the path then finds nothing.
    """
    root, environment = str(Path(civiclens.__file__).parents[1]), spark.sparkContext.environment
    for name, value in WORKER_SETTINGS.items():
        environment.setdefault(name, value)
    if spark.conf.get(BATCH_KEY) == SPARK_BATCH:
        spark.conf.set(BATCH_KEY, BATCH)
    known = environment.get("PYTHONPATH", "").split(":")
    if root not in known:
        environment["PYTHONPATH"] = ":".join([root, *filter(None, known)])


def map_batches(frame: DataFrame, run: Callable[[Batches], Batches], schema: str) -> DataFrame:
    ready_workers(frame.sparkSession)
    return frame.mapInArrow(run, schema)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


class Scratch:
    """Intermediate tables of one operator call, in a folder of their own below the shared one.

    Writing a table cuts lineage: a lost executor costs a re-read of it, not the work before it.
    """

    def __init__(self, spark: SparkSession, label: str):
        ready_workers(spark)
        self.spark = spark
        self.root = f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex[:12]}"

    def stage(self, frame: DataFrame, name: str) -> DataFrame:
        path = f"{self.root}/{name}"
        frame.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(frame.schema).parquet(path)

    def release(self) -> None:
        """Let go of finished jobs' shuffle files before the next large exchange.

        Executors delete them once the driver's JVM has collected the job, which it may not do for long.
        """
        gc.collect()
        self.spark._jvm.System.gc()

    def drop(self, name: str = "") -> None:
        """Remove a table that nothing reads any more."""
        jvm, conf = self.spark._jvm, self.spark._jsc.hadoopConfiguration()
        path = jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")
        path.getFileSystem(conf).delete(path, True)


def utf8(column: str) -> Column:
    """The UTF-8 bytes of a text; of NULL, no bytes."""
    return F.coalesce(F.col(column).cast("binary"), F.lit(b""))


def free_name(taken: Iterable[str], name: str) -> str:
    """The name, with underscores behind it until no column has it."""
    known = {t.lower() for t in taken}
    while name.lower() in known:
        name += "_"
    return name


def parts_for(rows: int, per_part: int, least: int, most: int) -> int:
    """How many parts to deal rows into: about ``per_part`` rows each, within fixed bounds."""
    return max(least, min(most, -(-rows // per_part)))


HOT_PARTS = 1000
"""A key with more than one in so many rows is hot, so there are fewer hot keys than this."""


def join_counted(rows: DataFrame, firsts: DataFrame, keys: list[str], places: str) -> DataFrame:
    """Inner join of ``rows`` with one row per key, where ``places`` says how many rows the key has.

    Rows of a hot key are dealt to parts of a ``HOT_PARTS``-th of all rows, and the key's row goes to each of them, so no key fills a task.
    Which keys these are, fewer than ``HOT_PARTS`` whatever the input, is broadcast; every row is looked at once. Give staged frames.
    """
    most = max(1, -(-rows.count() // HOT_PARTS))
    parts, part = free_name([*rows.columns, *firsts.columns], "parts"), free_name([*rows.columns, *firsts.columns], "part")
    several = F.ceil(F.col(places) / F.lit(most)).cast("int")
    hot = F.col(places) > most
    known = F.broadcast(firsts.where(hot).select(*keys, several.alias(parts)))
    others = [c for c in rows.columns if c not in keys]
    deal = F.pmod(F.xxhash64(*others), F.col(parts)).cast("int")
    dealt = rows.join(known, keys, "left").withColumn(part, F.when(F.col(parts).isNull(), F.lit(0)).otherwise(deal)).drop(parts)
    spread = F.explode(F.sequence(F.lit(0), F.when(hot, several - 1).otherwise(F.lit(0))))
    return dealt.join(firsts.withColumn(part, spread), [*keys, part]).drop(part)


def bit_field(frame: DataFrame, bucket: Column, bits: int) -> Broadcast:
    """A bit for each of ``2**bits`` buckets, set where a row is, packed into bytes; its size does not depend on the rows.

    Tasks merge bitmaps of 4 KB, and the driver puts these together.
    """
    marks = frame.select((bucket + 1).alias("bucket"))  # bitmaps are numbered from 1
    number, place = F.bitmap_bucket_number("bucket"), F.bitmap_bit_position("bucket")
    found = marks.groupBy(number.alias("number")).agg(F.bitmap_construct_agg(place).alias("bits"))
    packed = np.zeros(1 << bits - 3, dtype=np.uint8)
    for row in found.collect():
        part = np.frombuffer(bytes(row["bits"]), dtype=np.uint8)
        start = (row["number"] - 1) * len(part)
        packed[start : start + len(part)] = part
    return frame.sparkSession.sparkContext.broadcast(packed)


def has_bit(packed: np.ndarray, buckets: np.ndarray) -> np.ndarray:
    return (packed[buckets >> 3] >> (buckets & 7).astype(np.uint8) & 1).astype(bool)

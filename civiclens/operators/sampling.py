"""Row samples."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

_PREFIX = 4
"""Hex digits of the hash that name a bucket."""


def first_rows(frame: DataFrame, limit: int = 10) -> DataFrame:
    """The first ``limit`` rows by content, NULLs last, the same on every run."""
    return frame.orderBy(*[F.col(c).asc_nulls_last() for c in frame.columns]).limit(limit)


def hash_sample(frame: DataFrame, size: int, keys: Sequence[str] = (), seed: int = 42) -> DataFrame:
    """Exactly ``size`` pseudo-random rows (all rows if there are fewer), the same on every run.

    Rows are ranked by a seeded MD5 of their key columns (by default all), then by content, so that any
    engine picks the same. A count per hash bucket finds the
    bucket in which the ``size``-th row falls, and rows above it are filtered out inside the
    scan: without that, every task would send ``size`` rows to the one that merges them.
    """
    parts = [F.col(c).cast("string") for c in keys or frame.columns]
    hashed = frame.withColumn("_hash", F.md5(F.concat_ws("|", *parts, F.lit(str(seed)))))
    bucket = F.substring("_hash", 1, _PREFIX)
    per_bucket = hashed.groupBy(bucket.alias("_bucket")).agg(F.count("*").alias("_rows"))
    running = per_bucket.select(
        "_bucket", F.sum("_rows").over(Window.orderBy("_bucket")).alias("_running")
    )
    cutoff = running.where(F.col("_running") >= size).agg(F.min("_bucket")).scalar()
    last_bucket = F.coalesce(cutoff, F.lit("f" * _PREFIX))
    order = ["_hash", *[F.col(c).asc_nulls_last() for c in frame.columns]]
    return hashed.where(bucket <= last_bucket).orderBy(*order).limit(size).drop("_hash")

"""Deduplication of raw requests."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from civiclens.functions.keys import nulls_last


def dedup_requests(raw: DataFrame) -> DataFrame:
    """Keep the earliest record of each request number; ``rn`` (always 1) stays in the table.

    Catalyst turns the rank filter into a group limit below the shuffle, so each map task
    sends at most one row per number and a hot or NULL number cannot fill one task. A hash
    of the whole row settles ties, so a re-run task picks the same row.
    """
    content = [c for c in raw.columns]
    order = [*nulls_last("created_date"), F.xxhash64(*content)]
    rank = F.row_number().over(Window.partitionBy("sr_number").orderBy(*order))
    return raw.withColumn("rn", rank).where(F.col("rn") == 1)

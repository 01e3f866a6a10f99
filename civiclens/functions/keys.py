"""Content hashes and dense surrogate ids."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from civiclens.functions.text import as_column, trimmed_or_empty

Stage = Callable[[DataFrame, str], DataFrame]
"""Writes a frame to the shared folder under a label and returns it re-read."""

BLOCK = "_block"
_POSITION_BITS = 33


def nulls_last(*columns: str | Column) -> list[Column]:
    """Ascending order with NULLs at the end, spelled out since Spark puts them first."""
    return [as_column(c).asc_nulls_last() for c in columns]


def trimmed_hash(*columns: str | Column) -> Column:
    """md5 over the ``|``-joined trimmed values, NULL counting as empty."""
    return F.md5(F.concat_ws("|", *[trimmed_or_empty(c) for c in columns]))


# What stands for a missing part of a place, in hash order.
LOCATION_PARTS = {
    "street_address": "NO_ADDRESS",
    "city": "NO_CITY",
    "zip_code": "NO_ZIP",
    "latitude": "NO_LAT",
    "longitude": "NO_LON",
    "ward": "NO_WARD",
}


def location_hash(cleaned: Mapping[str, Column]) -> Column:
    """Content hash of a place, over its cleaned columns."""
    parts = [
        F.coalesce(cleaned[name].cast("string"), F.lit(missing))
        for name, missing in LOCATION_PARTS.items()
    ]
    return F.md5(F.concat_ws("|", *parts))


def address_key() -> Column:
    """The request-side key of the fact load: md5 of house number, street name and zip."""
    return F.md5(F.concat(*[trimmed_or_empty(c) for c in ("street_number", "street_name", "zip_code")]))


def dense_ids(frame: DataFrame, order: Sequence[Column], id_column: str, stage: Stage) -> DataFrame:
    """Number the rows 1..n in the given order, without a single-partition window.

    A global sort range-partitions the rows, so a hot value of the leading key is split as
    long as later keys differ. The sorted rows are staged with their position inside their
    block (sort partition); a row's id is that position plus the rows of all earlier
    blocks. The offsets hold one row per block, so broadcasting them is bounded by the
    number of shuffle partitions. Give a total order: ties would make ids arbitrary.
    """
    positioned = frame.sort(*order).withColumn("_position", F.monotonically_increasing_id())
    staged = stage(positioned, id_column).withColumn(
        BLOCK, F.shiftright("_position", _POSITION_BITS)
    )
    earlier = Window.orderBy(BLOCK).rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        staged.groupBy(BLOCK)
        .agg(F.count("*").alias("_rows"))
        .select(BLOCK, F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_offset"))
    )
    inside = F.col("_position").bitwiseAND(F.lit((1 << _POSITION_BITS) - 1))
    return (
        staged.join(F.broadcast(offsets), BLOCK)
        .withColumn(id_column, F.col("_offset") + inside + 1)
        .drop("_position", "_offset")
    )


def numbered(
    frame: DataFrame, order: Sequence[Column], id_column: str, stage: Stage, group: str | None = None, rank: str | None = None
) -> DataFrame:
    """``dense_ids`` and, for a group that leads the order and is never NULL, the rank inside it."""
    rows = dense_ids(frame, order, id_column, stage)
    if group:
        rows = rank_within(rows, group, id_column, rank)
    return rows.drop(BLOCK)


Number = Callable[..., DataFrame]
"""``numbered`` or something with its arguments, such as ``Registry.number``."""


def rank_within(numbered: DataFrame, group: str, id_column: str, rank_column: str) -> DataFrame:
    """Rank of each row inside its group, for rows numbered by ``dense_ids`` with the group
    as the leading sort key.

    A group is a contiguous run of ids, so the rank is the distance to the run's first id.
    That first id is found from one row per (block, group); no task sees a whole group.
    """
    runs = numbered.groupBy(BLOCK, group).agg(F.min(id_column).alias("_run_start"))
    starts = runs.withColumn("_group_start", F.min("_run_start").over(Window.partitionBy(group)))
    return (
        numbered.join(starts.drop("_run_start"), [BLOCK, group])
        .withColumn(rank_column, F.col(id_column) - F.col("_group_start") + 1)
        .drop("_group_start")
    )

"""Surrogate keys that stay the same from load to load."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from civiclens.functions.keys import Stage, numbered
from civiclens.sources.folders import LOAD, finished_loads, read_loads

col = F.col


def same_members(left: DataFrame, right: DataFrame, columns: Sequence[str]) -> Column:
    """Equality of all columns, NULLs being equal; planned as a hash or sort-merge join."""
    return reduce(and_, [left[c].eqNullSafe(right[c]) for c in columns])


class Registry:
    """The members of the dimensions with the ids they got first, one table per id column.

    A load writes only the members that are new, in a folder of its own below ``root``. Ids go on after the largest one, so they
    have no gaps, and members never leave. A load that is repeated finds its members known and adds
    none. One load at a time may write.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root

    def known(self, id_column: str, schema: StructType) -> DataFrame:
        return read_loads(self.spark, f"{self.root}/{id_column}", schema)

    def number(
        self,
        frame: DataFrame,
        order: Sequence[Column],
        id_column: str,
        stage: Stage,
        group: str | None = None,
        rank: str | None = None,
    ) -> DataFrame:
        """All members known after this load with their ids; the arguments are those of ``numbered``.

        New members are numbered in the given order behind the known ones. Ranks inside a group go on
        behind its largest one.
        """
        members = [f.name for f in frame.schema]
        kept = StructType([*frame.schema]).add(id_column, "long")
        if rank:
            kept.add(rank, "long")
        known = self.known(id_column, kept)
        fresh = stage(frame.join(known, same_members(frame, known, members), "left_anti"), f"{id_column}-fresh")
        if not fresh.isEmpty():
            top = known.agg(F.coalesce(F.max(id_column), F.lit(0))).first()[0]
            added = numbered(fresh, order, id_column, stage, group, rank)
            if rank:
                tops = known.groupBy(group).agg(F.max(rank).alias("_top")).withColumnRenamed(group, "_group")
                added = added.join(tops, col(group).eqNullSafe(col("_group")), "left")
                added = added.withColumn(rank, col(rank) + F.coalesce("_top", F.lit(0))).drop("_group", "_top")
            added = added.withColumn(id_column, col(id_column) + top)
            load = len(finished_loads(self.spark, f"{self.root}/{id_column}"))
            added.select(*[col(f.name).cast(f.dataType) for f in kept]).write.mode("overwrite").parquet(
                f"{self.root}/{id_column}/{LOAD}={load}"
            )
        return self.known(id_column, kept)

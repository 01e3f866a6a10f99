"""The benchmark reports over the request fact."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def counts_by(frame: DataFrame, *keys: str) -> DataFrame:
    return frame.groupBy(*keys).agg(F.count("*").alias("cnt"))


def top_counts(frame: DataFrame, *keys: str, limit: int = 10) -> DataFrame:
    """The most frequent keys; equal counts are ordered by key."""
    order = [F.desc("cnt"), *[F.col(k).asc_nulls_last() for k in keys]]
    return counts_by(frame, *keys).orderBy(*order).limit(limit)


def counts_per_month(frame: DataFrame, date: Column) -> DataFrame:
    """Rows per ``yyyy-MM``. Rows are grouped by the first day of the month and only the
    groups are formatted, which is far cheaper than formatting every row."""
    grouped = counts_by(frame.select(F.trunc(date, "MM").alias("_first")), "_first")
    return grouped.select(F.date_format("_first", "yyyy-MM").alias("month"), "cnt").orderBy(
        F.col("month").asc_nulls_last()
    )


def requests_by_month(fact: DataFrame) -> DataFrame:
    """Requests per ``yyyy-MM``, from the fact's partition columns: no column is read from its files."""
    dated = counts_by(fact, "year", "month").where("year IS NOT NULL")
    month = F.format_string("%04d-%02d", F.col("year").cast("int"), F.col("month").cast("int"))
    undated = counts_by(fact.where("year IS NULL").select(F.lit(None).cast("string").alias("month")), "month")
    return dated.select(month.alias("month"), "cnt").union(undated).orderBy(F.col("month").asc_nulls_last())


def service_department_pairs(
    fact: DataFrame, dim_service: DataFrame, dim_department: DataFrame, limit: int = 10
) -> DataFrame:
    """Most frequent (service name, department name) pairs.

    The fact is counted per id pair before the joins, so only distinct id pairs reach them;
    several ids may share a name, hence the second count.
    """
    pairs = counts_by(fact, "service_id", "department_id")
    named = pairs.join(
        dim_service.select("service_id", "service_name"), "service_id", "left"
    ).join(dim_department.select("department_id", "department_name"), "department_id", "left")
    totals = named.groupBy("service_name", "department_name").agg(F.sum("cnt").alias("cnt"))
    order = [
        F.desc("cnt"),
        F.col("service_name").asc_nulls_last(),
        F.col("department_name").asc_nulls_last(),
    ]
    return totals.orderBy(*order).limit(limit)


def service_lookup(fact: DataFrame, dim_service: DataFrame, limit: int = 10) -> DataFrame:
    """Requests with their service name, first by fact id (INNER join: known services only).

    The limit is taken after the join because rows of unknown services do not count.
    """
    names = dim_service.select("service_id", "service_name")
    joined = fact.select("fact_id", "sr_number", "service_id").join(names, "service_id")
    return joined.select("fact_id", "sr_number", "service_name").orderBy("fact_id").limit(limit)

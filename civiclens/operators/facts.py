"""Star joins and the two request facts.

No join carries a broadcast hint. The dimensions are read from written tables, so Spark
knows their size and broadcasts one only below ``spark.sql.autoBroadcastJoinThreshold``;
above it the join is a shuffled one and adaptive execution splits hot keys.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from civiclens.functions.keys import Stage, address_key, dense_ids, location_hash, nulls_last
from civiclens.functions.text import strict_timestamp, try_timestamp
from civiclens.operators.dimensions import (
    clean_department_keys,
    clean_geography_keys,
    clean_infrastructure_keys,
    clean_location,
    clean_service_keys,
    created_day,
)

col = F.col

UNKNOWN_MEMBER = -1
HASH_LENGTH = 32


def unique_members(dimension: DataFrame, keys: list[str], id_column: str) -> DataFrame:
    """One row per business key with its lowest id, so a join on the key cannot fan out."""
    return dimension.groupBy(*keys).agg(F.min(id_column).alias(id_column))


def attach(
    requests: DataFrame,
    members: DataFrame,
    keys: dict[str, Column],
    id_column: str,
    null_safe: bool = False,
) -> DataFrame:
    """LEFT join of requests to dimension members on cleaned request columns.

    ``keys`` maps a member column to the request expression it must equal. Null-safe keys
    treat two NULLs as equal; Catalyst still plans them as a hash or sort-merge join.
    """
    right = members.select(col(id_column), *[col(k).alias(f"_member_{k}") for k in keys])
    left = requests.withColumns({f"_request_{k}": c for k, c in keys.items()})

    def match(key: str) -> Column:
        mine, theirs = col(f"_request_{key}"), col(f"_member_{key}")
        return mine.eqNullSafe(theirs) if null_safe else mine == theirs

    helpers = [f"_{side}_{k}" for side in ("request", "member") for k in keys]
    return left.join(right, reduce(and_, map(match, keys)), "left").drop(*helpers)


def attach_service(requests: DataFrame, members: DataFrame) -> DataFrame:
    return attach(requests, members, clean_service_keys(), "service_id")


def attach_department(requests: DataFrame, members: DataFrame) -> DataFrame:
    return attach(requests, members, clean_department_keys(), "department_id")


def attach_geography(requests: DataFrame, members: DataFrame) -> DataFrame:
    return attach(requests, members, clean_geography_keys(), "geography_id", null_safe=True)


def attach_infrastructure(requests: DataFrame, members: DataFrame) -> DataFrame:
    return attach(requests, members, clean_infrastructure_keys(), "infrastructure_id", null_safe=True)


def attach_time(requests: DataFrame, dim_time: DataFrame) -> DataFrame:
    """Adds ``created_date_id``, NULL when the creation date has no calendar row."""
    days = dim_time.select(col("date_id").alias("created_date_id"))
    keyed = requests.withColumn("_day", created_day())
    return keyed.join(days, col("_day") == col("created_date_id"), "left").drop("_day")


def first_locations(dim_location: DataFrame) -> DataFrame:
    """Content hash and id of the first-ranked location of each hash."""
    rank = F.substring_index("location_key", "_", -1)
    return dim_location.where(rank == "1").select(
        F.substring("location_key", 1, HASH_LENGTH).alias("location_hash"), "location_id"
    )


def attach_location(requests: DataFrame, dim_location: DataFrame) -> DataFrame:
    """Location id by the content hash, computed alike on both sides."""
    return attach(
        requests, first_locations(dim_location), {"location_hash": location_hash(clean_location())}, "location_id"
    )


def fact_star(
    requests: DataFrame,
    dim_service: DataFrame,
    dim_department: DataFrame,
    dim_location: DataFrame,
    dim_time: DataFrame,
    dim_geography: DataFrame,
    dim_infrastructure: DataFrame,
) -> DataFrame:
    """One row per request with six dimension ids; NULL where no member matches."""
    services = unique_members(dim_service, list(clean_service_keys()), "service_id")
    departments = unique_members(dim_department, list(clean_department_keys()), "department_id")
    geographies = unique_members(dim_geography, list(clean_geography_keys()), "geography_id")
    networks = unique_members(dim_infrastructure, list(clean_infrastructure_keys()), "infrastructure_id")

    joined = attach_service(requests, services)
    joined = attach_department(joined, departments)
    joined = attach_time(joined, dim_time)
    joined = attach_geography(joined, geographies)
    joined = attach_infrastructure(joined, networks)
    joined = attach_location(joined, dim_location)
    return joined.select(
        "sr_number",
        "status",
        try_timestamp("created_date").alias("created_ts"),
        try_timestamp("last_modified_date").alias("last_modified_ts"),
        try_timestamp("closed_date").alias("closed_ts"),
        "duplicate",
        "legacy_record",
        "legacy_sr_number",
        "parent_sr_number",
        "service_id",
        "department_id",
        "created_date_id",
        "location_id",
        "geography_id",
        "infrastructure_id",
    )


def with_location_key(requests: DataFrame) -> DataFrame:
    """Requests with the address key the fact load looks locations up by."""
    return requests.withColumn("location_key", address_key())


def attach_by_address_key(requests: DataFrame, dim_location: DataFrame) -> DataFrame:
    """Location id by exact location key, -1 where none matches.

    Request keys are bare hashes while location keys normally carry a rank suffix. Only
    keys of the request's length can match; if the dimension holds none, the answer is the
    unknown member for every row and shuffling the requests would be wasted.
    """
    candidates = dim_location.where(F.length("location_key") == HASH_LENGTH)
    if candidates.isEmpty():
        return requests.withColumn("location_id", F.lit(UNKNOWN_MEMBER).cast("bigint"))
    members = unique_members(candidates, ["location_key"], "location_id")
    joined = requests.join(members, "location_key", "left")
    return joined.withColumn("location_id", F.coalesce("location_id", F.lit(UNKNOWN_MEMBER)))


def fact_rows(
    requests: DataFrame, dim_service: DataFrame, dim_department: DataFrame, dim_location: DataFrame, *carried: str
) -> DataFrame:
    """One row per request with the ids of its members, -1 where unknown, and the request columns to carry on.

    Departments match the *creating* department against names that come from owning
    departments, as the source system does.
    """
    services = unique_members(dim_service, ["service_name"], "service_id")
    departments = unique_members(dim_department, ["department_name"], "department_id")
    joined = attach(requests, services, {"service_name": F.trim("sr_type")}, "service_id")
    joined = attach(
        joined, departments, {"department_name": F.trim("created_department")}, "department_id"
    )
    joined = attach_by_address_key(with_location_key(joined), dim_location)
    return joined.select(
        "sr_number",
        strict_timestamp("created_date").alias("created_date"),
        strict_timestamp("closed_date").alias("closed_date"),
        "status",
        F.coalesce("service_id", F.lit(UNKNOWN_MEMBER)).alias("service_id"),
        F.coalesce("department_id", F.lit(UNKNOWN_MEMBER)).alias("department_id"),
        "location_id",
        strict_timestamp("created_date").cast("date").alias("date_id"),
        *carried,
    )


def fact_requests(
    requests: DataFrame,
    dim_service: DataFrame,
    dim_department: DataFrame,
    dim_location: DataFrame,
    stage: Stage,
) -> DataFrame:
    """The fact the reports read; ``year`` and ``month`` are the partition columns."""
    rows = fact_rows(requests, dim_service, dim_department, dim_location)
    numbered = dense_ids(rows, nulls_last("date_id", "sr_number"), "fact_id", stage)
    return numbered.select(
        "fact_id",
        "sr_number",
        "created_date",
        "closed_date",
        "status",
        "service_id",
        "department_id",
        "location_id",
        "date_id",
        F.lit(1).alias("request_count"),
        F.current_timestamp().alias("created_at"),
        F.year("date_id").alias("year"),
        F.month("date_id").alias("month"),
    )


def month_slice(fact: DataFrame, year: int, month: int) -> DataFrame:
    """The rows of one month; a partition filter on the fact table."""
    return fact.where((col("year") == year) & (col("month") == month))

"""The six dimensions of the star schema.

Every builder takes the deduplicated requests, reduces them to distinct keys first and
classifies those, so the CASE ladders run on few rows. Members are distinct over the raw
text: padded and blank variants of one name are separate members, as in the source system.
``number`` gives the ids: anew for each build, or from a registry that keeps those of earlier loads.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from civiclens.functions import rules
from civiclens.functions.calendar import calendar_attributes
from civiclens.functions.keys import (
    Number,
    Stage,
    location_hash,
    nulls_last,
    numbered,
    trimmed_hash,
)
from civiclens.functions.text import clean, clean_or, try_double, try_int, try_timestamp

col = F.col

SERVICE_KEYS = ("sr_type", "sr_short_code", "origin")
DEPARTMENT_KEYS = ("owner_department", "created_department")
GEOGRAPHY_KEYS = (
    "community_area",
    "ward",
    "police_district",
    "police_beat",
    "police_sector",
    "precinct",
)
INFRASTRUCTURE_KEYS = ("electrical_district", "electricity_grid", "sanitation_division_days")


def any_present(*columns: str) -> Column:
    return reduce(or_, [col(c).isNotNull() for c in columns])


def clean_service_keys() -> dict[str, Column]:
    """Cleaned request columns, named as in the service dimension."""
    return {
        "service_name": clean_or("sr_type", "Unknown Service"),
        "service_short_code": clean_or("sr_short_code", "UNK"),
        "service_origin": clean_or("origin", "Unknown Origin"),
    }


def clean_department_keys() -> dict[str, Column]:
    return {
        "department_name": clean_or("owner_department", "Unknown Department"),
        "created_department": clean_or("created_department", "Unknown Creator"),
    }


def clean_geography_keys() -> dict[str, Column]:
    cleaned = {name: clean(name) for name in GEOGRAPHY_KEYS}
    cleaned["ward"] = try_int(clean("ward"))
    return cleaned


def clean_infrastructure_keys() -> dict[str, Column]:
    return {name: clean(name) for name in INFRASTRUCTURE_KEYS}


def created_day() -> Column:
    return try_timestamp("created_date").cast("date")


def _named(columns: dict[str, Column]) -> list[Column]:
    return [column.alias(name) for name, column in columns.items()]


def _filled(default: str, *names: str) -> list[Column]:
    return [F.coalesce(col(name), F.lit(default)) for name in names]


def dim_service(requests: DataFrame, stage: Stage, number: Number = numbered) -> DataFrame:
    keys = requests.select(*SERVICE_KEYS).where(any_present(*SERVICE_KEYS)).distinct()
    order = [*_filled("", *SERVICE_KEYS), *nulls_last(*SERVICE_KEYS)]
    kind = col("sr_type")
    return number(keys, order, "service_id", stage).select(
        "service_id",
        *_named(clean_service_keys()),
        rules.service_category(kind).alias("service_category"),
        rules.service_subcategory(kind).alias("service_subcategory"),
        rules.service_priority(kind).alias("priority_level"),
        rules.service_emergency(kind).alias("is_emergency"),
        rules.service_resolution_days(kind).alias("typical_resolution_days"),
        trimmed_hash(*SERVICE_KEYS).alias("service_hash"),
        F.current_timestamp().alias("created_at"),
        F.current_timestamp().alias("updated_at"),
    )


def dim_department(requests: DataFrame, stage: Stage, number: Number = numbered) -> DataFrame:
    keys = requests.select(*DEPARTMENT_KEYS).distinct()
    order = [*clean_department_keys().values(), *nulls_last(*DEPARTMENT_KEYS)]
    owner = col("owner_department")
    return number(keys, order, "department_id", stage).select(
        "department_id",
        *_named(clean_department_keys()),
        rules.department_type(owner).alias("department_type"),
        rules.department_hierarchy(owner).alias("department_hierarchy"),
        clean("owner_department").isNull().alias("is_missing_data"),
        rules.department_capacity(owner).alias("agency_capacity"),
        rules.department_hours(owner).alias("operating_hours"),
        trimmed_hash(*DEPARTMENT_KEYS).alias("department_hash"),
        F.current_timestamp().alias("created_at"),
        F.current_timestamp().alias("updated_at"),
    )


def dim_time(requests: DataFrame) -> DataFrame:
    """One row per day with a request; its key is the date itself."""
    days = requests.select(created_day().alias("date_id")).where("date_id IS NOT NULL").distinct()
    return days.select(
        "date_id",
        *_named(calendar_attributes(col("date_id"))),
        F.current_timestamp().alias("created_at"),
    )


def dim_geography(requests: DataFrame, stage: Stage, number: Number = numbered) -> DataFrame:
    keys = (
        requests.select(*GEOGRAPHY_KEYS)
        .where(any_present("community_area", "ward", "police_district"))
        .distinct()
    )
    order = [
        *_filled("Unknown", "community_area", "ward", "police_district"),
        *nulls_last(*GEOGRAPHY_KEYS),
    ]
    area, district, ward = col("community_area"), col("police_district"), try_int("ward")
    cleaned = clean_geography_keys()
    return number(keys, order, "geography_id", stage).select(
        "geography_id",
        cleaned["community_area"].alias("community_area"),
        rules.labelled("Community Area ", clean("community_area")).alias("community_area_name"),
        cleaned["ward"].alias("ward"),
        rules.labelled("Ward ", ward).alias("ward_name"),
        cleaned["police_district"].alias("police_district"),
        cleaned["police_beat"].alias("police_beat"),
        cleaned["police_sector"].alias("police_sector"),
        cleaned["precinct"].alias("precinct"),
        rules.labelled("Alderman Ward ", ward).alias("alderman_name"),
        rules.ward_cluster(ward, area).alias("geographic_cluster"),
        rules.service_area(district, ward).alias("service_area"),
        rules.ward_density(ward).alias("population_density"),
        rules.ward_income(ward).alias("socioeconomic_level"),
        trimmed_hash(*GEOGRAPHY_KEYS).alias("geography_hash"),
        F.current_timestamp().alias("created_at"),
    )


def infrastructure_profile() -> dict[str, Column]:
    """Derived infrastructure columns over the raw keys, in table order."""
    district, grid, days = (col(name) for name in INFRASTRUCTURE_KEYS)
    return {
        "utility_type": rules.utility_type(district, grid, days),
        "service_reliability": rules.service_reliability(district, grid, days),
        "maintenance_schedule": rules.maintenance_schedule(district, days),
        "infrastructure_age": rules.infrastructure_age(try_int(district)),
        "capacity_level": rules.capacity_level(district, grid, days),
    }


def dim_infrastructure(requests: DataFrame, stage: Stage, number: Number = numbered) -> DataFrame:
    keys = requests.select(*INFRASTRUCTURE_KEYS).where(any_present(*INFRASTRUCTURE_KEYS)).distinct()
    order = [*_filled("Unknown", *INFRASTRUCTURE_KEYS), *nulls_last(*INFRASTRUCTURE_KEYS)]
    return number(keys, order, "infrastructure_id", stage).select(
        "infrastructure_id",
        *_named(clean_infrastructure_keys()),
        *_named(infrastructure_profile()),
        trimmed_hash(*INFRASTRUCTURE_KEYS).alias("infrastructure_hash"),
        F.current_timestamp().alias("created_at"),
    )


def clean_location() -> dict[str, Column]:
    """The 21 cleaned location columns, in table order."""
    text = {name: clean(name) for name in (
        "street_number", "street_name", "street_type", "street_direction", "street_address",
    )}
    text["city"] = clean_or("city", "Chicago")
    text["state"] = clean_or("state", "IL")
    text["zip_code"] = clean("zip_code")
    text["community_area"] = clean("community_area")
    text["ward"] = try_int(clean("ward"))
    for name in (
        "police_district", "police_beat", "police_sector", "precinct",
        "sanitation_division_days", "electrical_district", "electricity_grid",
    ):
        text[name] = clean(name)
    for name in ("latitude", "longitude", "x_coordinate", "y_coordinate"):
        text[name] = try_double(name)
    return text


def dim_location(requests: DataFrame, stage: Stage, number: Number = numbered) -> DataFrame:
    """One row per distinct cleaned place, hashed after the DISTINCT. The key is the content hash plus the rank of the
    row among those sharing the hash; all remaining columns settle the order."""
    columns = list(clean_location())
    places = requests.select(*_named(clean_location())).distinct()
    places = places.withColumn("location_hash", location_hash({c: col(c) for c in columns}))
    order = nulls_last("location_hash", *columns)
    ranked = number(places, order, "location_id", stage, group="location_hash", rank="_rank")

    address, street, ward = col("street_address"), col("street_name"), col("ward")
    latitude, longitude = col("latitude"), col("longitude")
    return ranked.select(
        "location_id",
        *columns,
        F.concat("location_hash", F.lit("_"), col("_rank").cast("string")).alias("location_key"),
        rules.address_completeness(address, street, col("zip_code"), latitude, longitude).alias(
            "address_completeness"
        ),
        rules.geographic_region(ward, col("community_area"), latitude, longitude).alias(
            "geographic_region"
        ),
        rules.spatial_quality(address, ward, latitude, longitude).alias("spatial_quality_score"),
        (latitude.isNotNull() & longitude.isNotNull()).alias("is_geocoded"),
        rules.coordinate_precision(address, street, latitude, longitude).alias("coordinate_precision"),
        F.current_timestamp().alias("created_at"),
        F.current_timestamp().alias("updated_at"),
    )

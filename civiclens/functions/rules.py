"""Classification rules held as data and folded into CASE expressions.

Each ladder is tried top to bottom and the first match wins, so the order of the entries
is part of the rule.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

KeywordRules = Sequence[tuple[object, Sequence[str]]]

# Keyword lists and labels of the service and department rules.
SERVICE_CATEGORY = (
    ("Sanitation", ("graffiti", "litter", "garbage", "refuse", "waste", "debris", "dumping")),
    ("Transportation", ("pothole", "street", "traffic", "sidewalk", "curb", "pavement", "road")),
    ("Environment", ("tree", "vegetation", "park", "landscape", "green")),
    ("Infrastructure", ("light", "electrical", "power", "utility", "signal")),
    ("Utilities", ("water", "sewer", "drain", "flood", "leak", "pipe")),
    ("Animal Services", ("animal", "rodent", "pest", "stray", "wildlife")),
    ("Property", ("abandon", "building", "property", "vacant", "structure", "housing")),
    ("Public Safety", ("noise", "police", "crime", "safety", "security")),
    ("Regulatory", ("permit", "license", "violation", "inspection", "code")),
    ("Health Services", ("health", "medical", "food", "restaurant")),
)
SERVICE_SUBCATEGORY = (
    ("Graffiti Removal", ("graffiti",)),
    ("Road Maintenance", ("pothole",)),
    ("Tree Services", ("tree",)),
    ("Street Lighting", ("light",)),
    ("Water Services", ("water",)),
)
EMERGENCY_WORDS = ("emergency", "urgent", "danger", "hazard")
SERVICE_PRIORITY = (
    ("High", ("emergency", "urgent", "danger", "hazard", "leak")),
    ("Medium", ("safety", "traffic", "signal", "water")),
)
RESOLUTION_DAYS = (
    (1, ("emergency", "urgent", "danger", "hazard")),
    (3, ("graffiti", "litter", "light")),
    (7, ("pothole", "tree", "water")),
    (14, ("building", "property")),
)
DEPARTMENT_TYPE = (
    ("Utilities", ("water", "sewer", "utility")),
    ("Transportation", ("transport", "street", "traffic", "cdot")),
    ("Environmental", ("sanitation", "environment", "fleet", "waste")),
    ("Public Safety", ("police", "fire", "emergency", "oemc")),
    ("Development", ("building", "housing", "planning", "zoning")),
    ("Health & Human Services", ("health", "family", "social", "human")),
    ("Parks & Recreation", ("park", "recreation", "cultural")),
)
DEPARTMENT_HIERARCHY = (
    ("Executive", ("commissioner", "director", "chief")),
    ("Management", ("manager", "supervisor", "coordinator")),
    ("Operational", ("officer", "inspector", "specialist")),
)
AGENCY_CAPACITY = (
    ("High", ("police", "fire", "water", "transport")),
    ("Medium", ("health", "building", "environment")),
)
OPERATING_HOURS = (
    ("24/7", ("police", "fire", "emergency", "water")),
    ("Extended Hours", ("sanitation", "transport", "street")),
)

# Ward and district ranges (both ends inclusive) and ward lists.
WARD_CLUSTER = ((1, 17, "North Side Cluster"), (18, 34, "Central Cluster"), (35, 50, "South Side Cluster"))
WARD_REGION = (
    (1, 10, "North Chicago"),
    (11, 20, "Northwest Chicago"),
    (21, 30, "Central Chicago"),
    (31, 40, "Southwest Chicago"),
    (41, 50, "South Chicago"),
)
DISTRICT_AGE = (
    (1, 10, "Newer Infrastructure"),
    (11, 20, "Mature Infrastructure"),
    (21, None, "Older Infrastructure"),
)
DENSITY_WARDS = (
    ("High Density", (1, 2, 8, 32, 42, 43)),
    ("Low Density", (19, 23, 38, 44, 46, 47, 48, 49, 50)),
)
INCOME_WARDS = (
    ("Higher Income", (1, 2, 18, 19, 38, 39, 40, 41, 43)),
    ("Lower Income", (15, 16, 17, 20, 24, 28, 29, 34)),
)
CITY_BOX = {"latitude": (41.6, 42.1), "longitude": (-87.9, -87.5)}


def first_match(branches: Sequence[tuple[Column, Column]], default: Column) -> Column:
    """CASE with the given (condition, value) branches."""
    (condition, value), *rest = branches
    chain = F.when(condition, value)
    for condition, value in rest:
        chain = chain.when(condition, value)
    return chain.otherwise(default)


def mentions(text: Column, words: Sequence[str]) -> Column:
    """Does the text hold any of the words, ignoring case? NULL text holds none."""
    lowered = F.lower(F.coalesce(text, F.lit("")))
    return reduce(or_, [lowered.contains(word) for word in words])


def by_keyword(
    text: Column,
    rules: KeywordRules,
    default: object,
    extra: Sequence[tuple[Column, Column]] = (),
) -> Column:
    """Label of the first rule with a keyword in the text; ``extra`` branches come last."""
    branches = [(mentions(text, words), F.lit(label)) for label, words in rules]
    return first_match([*branches, *extra], F.lit(default))


def by_range(value: Column, rules: Sequence[tuple[int, int | None, str]]) -> list[tuple[Column, Column]]:
    """(condition, label) branches of inclusive ranges; an open upper end is ``None``."""
    return [
        (value >= low if high is None else value.between(low, high), F.lit(label))
        for low, high, label in rules
    ]


def by_member(value: Column, rules: Sequence[tuple[str, Sequence[int]]], default: str) -> Column:
    return first_match([(value.isin(*members), F.lit(label)) for label, members in rules], F.lit(default))


def service_category(sr_type: Column) -> Column:
    return by_keyword(sr_type, SERVICE_CATEGORY, "Other")


def service_subcategory(sr_type: Column) -> Column:
    return by_keyword(sr_type, SERVICE_SUBCATEGORY, "General")


def service_priority(sr_type: Column) -> Column:
    return by_keyword(sr_type, SERVICE_PRIORITY, "Standard")


def service_emergency(sr_type: Column) -> Column:
    return mentions(sr_type, EMERGENCY_WORDS)


def service_resolution_days(sr_type: Column) -> Column:
    return by_keyword(sr_type, RESOLUTION_DAYS, 7)


def department_type(owner: Column) -> Column:
    cleaned = F.coalesce(F.nullif(F.trim(owner), F.lit("")), F.lit("Unknown Department"))
    missing = (cleaned == "Unknown Department", F.lit("Missing Data"))
    return by_keyword(owner, DEPARTMENT_TYPE, "Administrative", extra=[missing])


def department_hierarchy(owner: Column) -> Column:
    return by_keyword(owner, DEPARTMENT_HIERARCHY, "Standard")


def department_capacity(owner: Column) -> Column:
    return by_keyword(owner, AGENCY_CAPACITY, "Standard")


def department_hours(owner: Column) -> Column:
    return by_keyword(owner, OPERATING_HOURS, "Business Hours")


def ward_cluster(ward: Column, community_area: Column) -> Column:
    return first_match(
        [
            *by_range(ward, WARD_CLUSTER),
            (community_area.isNotNull(), F.lit("Community Based Cluster")),
        ],
        F.lit("Unassigned Cluster"),
    )


def ward_density(ward: Column) -> Column:
    return by_member(ward, DENSITY_WARDS, "Medium Density")


def ward_income(ward: Column) -> Column:
    return by_member(ward, INCOME_WARDS, "Mixed Income")


def service_area(police_district: Column, ward: Column) -> Column:
    return first_match(
        [
            (police_district.isNotNull(), F.concat(F.lit("Police District "), police_district)),
            (ward.isNotNull(), F.concat(F.lit("Ward Service Area "), ward.cast("string"))),
        ],
        F.lit("Unassigned Service Area"),
    )


def labelled(prefix: str, value: Column) -> Column:
    """Prefix and value, NULL when the value is."""
    return F.concat(F.lit(prefix), value.cast("string"))


def inside_city_box(latitude: Column, longitude: Column) -> Column:
    return latitude.between(*CITY_BOX["latitude"]) & longitude.between(*CITY_BOX["longitude"])


def geographic_region(ward: Column, community_area: Column, latitude: Column, longitude: Column) -> Column:
    return first_match(
        [
            *by_range(ward, WARD_REGION),
            (community_area.isNotNull(), F.lit("Chicago (Community Based)")),
            (inside_city_box(latitude, longitude), F.lit("Chicago (Coordinate Based)")),
        ],
        F.lit("Unknown Region"),
    )


def utility_type(district: Column, grid: Column, days: Column) -> Column:
    return first_match(
        [
            (district.isNotNull() & grid.isNotNull(), F.lit("Electrical")),
            (days.isNotNull(), F.lit("Sanitation")),
            (district.isNotNull(), F.lit("Power Distribution")),
        ],
        F.lit("General Utility"),
    )


def service_reliability(district: Column, grid: Column, days: Column) -> Column:
    return first_match(
        [
            (district.isNotNull() & grid.isNotNull(), F.lit("High Reliability")),
            (days.contains("DAILY") | days.contains("MON"), F.lit("High Frequency")),
            (district.isNotNull() | grid.isNotNull(), F.lit("Standard Reliability")),
        ],
        F.lit("Variable"),
    )


def maintenance_schedule(district: Column, days: Column) -> Column:
    return first_match(
        [
            (days.isNotNull(), F.concat(F.lit("Sanitation: "), days)),
            (district.isNotNull(), F.lit("Electrical: Scheduled Maintenance")),
        ],
        F.lit("Standard Schedule"),
    )


def infrastructure_age(district_number: Column) -> Column:
    return first_match(by_range(district_number, DISTRICT_AGE), F.lit("Mixed Age"))


def capacity_level(district: Column, grid: Column, days: Column) -> Column:
    return first_match(
        [
            (district.isNotNull() & grid.isNotNull() & days.isNotNull(), F.lit("High Capacity")),
            (district.isNotNull() & grid.isNotNull(), F.lit("Medium Capacity")),
            (district.isNotNull() | days.isNotNull(), F.lit("Standard Capacity")),
        ],
        F.lit("Limited Capacity"),
    )


def address_completeness(
    address: Column, street_name: Column, zip_code: Column, latitude: Column, longitude: Column
) -> Column:
    located = latitude.isNotNull() & longitude.isNotNull()
    return first_match(
        [
            (address.isNotNull() & zip_code.isNotNull() & located, F.lit("Complete")),
            (address.isNotNull() & (zip_code.isNotNull() | located), F.lit("Good")),
            (street_name.isNotNull() | latitude.isNotNull(), F.lit("Partial")),
        ],
        F.lit("Poor"),
    )


def spatial_quality(address: Column, ward: Column, latitude: Column, longitude: Column) -> Column:
    located = latitude.isNotNull() & longitude.isNotNull()
    return first_match(
        [
            (located & address.isNotNull() & ward.isNotNull(), F.lit(1.0)),
            (located & address.isNotNull(), F.lit(0.8)),
            (located, F.lit(0.6)),
            (address.isNotNull() & ward.isNotNull(), F.lit(0.4)),
            (address.isNotNull(), F.lit(0.2)),
        ],
        F.lit(0.0),
    )


def coordinate_precision(address: Column, street_name: Column, latitude: Column, longitude: Column) -> Column:
    located = latitude.isNotNull() & longitude.isNotNull()
    return first_match(
        [
            (located & address.isNotNull(), F.lit("Address Level")),
            (located & street_name.isNotNull(), F.lit("Street Level")),
            (located, F.lit("Area Level")),
        ],
        F.lit("No Coordinates"),
    )


def season(month: Column) -> Column:
    return first_match(
        [
            (month.isin(12, 1, 2), F.lit("Winter")),
            (month.isin(3, 4, 5), F.lit("Spring")),
            (month.isin(6, 7, 8), F.lit("Summer")),
        ],
        F.lit("Fall"),
    )

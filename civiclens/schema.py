"""The raw service-request table: 39 columns, text except where noted."""

from __future__ import annotations

from pyspark.sql import types as T

# Column names of the published request feed, in feed order.
EXPECTED_COLUMNS = (
    "sr_number", "sr_type", "sr_short_code", "owner_department", "status", "origin",
    "created_date", "last_modified_date", "closed_date", "street_address", "city", "state",
    "zip_code", "street_number", "street_direction", "street_name", "street_type",
    "duplicate", "legacy_record", "legacy_sr_number", "community_area", "ward",
    "electrical_district", "electricity_grid", "police_sector", "police_district",
    "police_beat", "precinct", "sanitation_division_days", "created_hour",
    "created_day_of_week", "created_month", "x_coordinate", "y_coordinate", "latitude",
    "longitude", "location", "parent_sr_number", "created_department",
)
BOOLEAN_COLUMNS = ("duplicate", "legacy_record")


def _type_of(column: str) -> T.DataType:
    if column in BOOLEAN_COLUMNS:
        return T.BooleanType()
    if column == "location":
        return T.StructType(
            [T.StructField("latitude", T.StringType()), T.StructField("longitude", T.StringType())]
        )
    return T.StringType()


RAW_SCHEMA = T.StructType([T.StructField(c, _type_of(c)) for c in EXPECTED_COLUMNS])

"""Profiles, checks and the validation report."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from civiclens.functions.text import clean_or, is_blank, try_date, try_int, try_timestamp
from civiclens.schema import EXPECTED_COLUMNS

col = F.col

# Names of the published checks and the columns they are about.
CRITICAL_TEXT = {
    "missing_sr_number": "sr_number",
    "missing_sr_type": "sr_type",
    "missing_status": "status",
    "missing_created_dept": "created_department",
}
CARDINALITY_COLUMNS = {
    "unique_service_types": "sr_type",
    "unique_short_codes": "sr_short_code",
    "unique_origins": "origin",
    "unique_created_depts": "created_department",
    "unique_owner_depts": "owner_department",
    "unique_community_areas": "community_area",
    "unique_wards": "ward",
    "unique_police_districts": "police_district",
    "unique_police_sectors": "police_sector",
    "unique_police_beats": "police_beat",
    "unique_electrical_districts": "electrical_district",
    "unique_electricity_grids": "electricity_grid",
    "unique_addresses": "street_address",
    "unique_zip_codes": "zip_code",
    "unique_cities": "city",
}
FACT_KEYS = ("fact_id", "service_id", "department_id", "location_id", "date_id")


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def critical_field_nulls(requests: DataFrame) -> DataFrame:
    """Rows, and rows with a missing value, of the five fields nothing works without."""
    missing = {name: is_blank(column) for name, column in CRITICAL_TEXT.items()}
    missing["missing_created_date"] = col("created_date").isNull()
    return requests.agg(
        F.count("*").alias("total_records"),
        *[F.count_if(condition).alias(name) for name, condition in missing.items()],
    )


def dimension_cardinality(requests: DataFrame) -> DataFrame:
    """Exact number of distinct values of 18 expressions, as one row.

    The expressions are turned into (metric, value) pairs and counted in two steps. Several
    COUNT(DISTINCT …) in one aggregate would carry all 18 columns through every shuffled row
    instead. Pairs are combined before the shuffle, so a frequent value costs one row per task.
    """
    coordinates = F.concat_ws(",", "x_coordinate", "y_coordinate")
    values = {name: clean_or(column, "Unknown") for name, column in CARDINALITY_COLUMNS.items()}
    values["unique_coordinate_pairs"] = F.when(
        col("x_coordinate").isNotNull() & col("y_coordinate").isNotNull(), coordinates
    ).otherwise("Unknown")
    values["unique_dates"] = try_date(F.left("created_date", F.lit(10))).cast("string")
    values["unique_hours"] = try_int(F.substring("created_date", 12, 2)).cast("string")

    wide = requests.select(*[value.alias(f"_{n}") for n, value in enumerate(values.values())])
    pairs = wide.unpivot([], wide.columns, "metric", "value").where(col("value").isNotNull()).distinct()
    counts = pairs.groupBy("metric").agg(F.count("*").alias("distinct_values"))
    return counts.agg(
        *[
            F.coalesce(F.max(F.when(col("metric") == f"_{n}", col("distinct_values"))), F.lit(0)).alias(name)
            for n, name in enumerate(values)
        ]
    )


def date_range(requests: DataFrame) -> DataFrame:
    """First and last creation time, and the number of years and months between them that
    have requests. Years and months are counted from one distinct list of months."""
    dated = requests.select("created_date", try_timestamp("created_date").alias("ts")).where(
        col("ts").isNotNull()
    )
    months = dated.groupBy(F.left("created_date", F.lit(7)).alias("month")).agg(
        F.min("ts").alias("first"), F.max("ts").alias("last")
    )
    return months.agg(
        F.min("first").alias("earliest_date"),
        F.max("last").alias("latest_date"),
        F.count_distinct(try_int(F.left("month", F.lit(4)))).alias("unique_years"),
        F.count_distinct("month").alias("unique_months"),
    )


def non_null_counts(frame: DataFrame) -> DataFrame:
    """(column_name, non_null, n_rows) for every column, from one pass over the table."""
    columns = frame.columns
    totals = frame.agg(
        F.count("*").alias("n_rows"), *[F.count(col(c)).alias(f"_{c}") for c in columns]
    )
    renamed = totals.withColumnsRenamed({f"_{c}": c for c in columns if c != "n_rows"})
    return renamed.unpivot(["n_rows"], columns, "column_name", "non_null")


def missing_values(frame: DataFrame) -> DataFrame:
    """Missing count and percentage per column, worst first."""
    missing = col("n_rows") - col("non_null")
    return (
        non_null_counts(frame)
        .select(
            "column_name",
            missing.alias("missing_cnt"),
            (F.lit(100.0) * missing / col("n_rows")).alias("missing_pct"),
        )
        .orderBy(F.desc("missing_pct"), "column_name")
    )


def overview(frame: DataFrame) -> DataFrame:
    """Shape and, per column, type and number of values present."""
    types = F.create_map(*[F.lit(x) for pair in frame.dtypes for x in pair])
    positions = F.create_map(*[F.lit(x) for i, c in enumerate(frame.columns) for x in (c, i + 1)])
    return non_null_counts(frame).select(
        positions[col("column_name")].alias("position"),
        "column_name",
        types[col("column_name")].alias("data_type"),
        "non_null",
        "n_rows",
        F.lit(len(frame.columns)).alias("n_columns"),
    )


def column_validation(frame: DataFrame, expected: Sequence[str] = EXPECTED_COLUMNS) -> DataFrame:
    """Expected against actual columns, ignoring case: present, missing or extra, as the table's
    schema tells."""
    wanted = [c.lower() for c in expected]
    actual = [c.lower() for c in frame.columns]
    status = [(c, "present" if c in actual else "missing") for c in wanted]
    status += [(c, "extra") for c in actual if c not in wanted]
    return frame.sparkSession.createDataFrame(status, "column_name string, column_status string")


def validated_columns(frame: DataFrame, expected: Sequence[str] = EXPECTED_COLUMNS) -> DataFrame:
    """``column_validation`` with the values that each column has in the table; NULL for a missing one."""
    filled = non_null_counts(frame).select(F.lower("column_name").alias("column_name"), "non_null")
    return column_validation(frame, expected).join(filled, "column_name", "left")


def duplicate_keys(frame: DataFrame, key: str = "sr_number") -> DataFrame:
    return frame.groupBy(key).agg(F.count("*").alias("cnt")).where("cnt > 1")


def duplicate_key_total(frame: DataFrame, key: str = "sr_number") -> DataFrame:
    return duplicate_keys(frame, key).agg(F.count("*").alias("duplicated_keys"))


def table_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    return union_all(
        [
            frame.agg(F.count("*").alias("n_rows")).select(F.lit(name).alias("table_name"), "n_rows")
            for name, frame in tables.items()
        ]
    )


def drop_ratio(raw: DataFrame, fact: DataFrame) -> DataFrame:
    """Raw rows that did not become fact rows."""
    counts = table_counts({"raw": raw, "fact": fact})
    totals = counts.agg(
        F.max(F.when(col("table_name") == "raw", col("n_rows"))).alias("raw_rows"),
        F.max(F.when(col("table_name") == "fact", col("n_rows"))).alias("fact_rows"),
    )
    dropped = col("raw_rows") - col("fact_rows")
    return totals.select(
        "raw_rows",
        "fact_rows",
        dropped.alias("dropped_rows"),
        F.when(col("raw_rows") > 0, dropped.cast("double") / col("raw_rows")).alias("dropped_ratio"),
    )


def fact_null_checks(fact: DataFrame) -> DataFrame:
    return fact.agg(*[F.count_if(col(c).isNull()).alias(f"null_{c}") for c in FACT_KEYS])


def ref_integrity(fact: DataFrame, dimensions: Mapping[str, DataFrame]) -> DataFrame:
    """Fact rows whose key has no member, per key column; NULL and -1 count as missing.

    One pass counts the rows of every (key column, value), so a key that fills the whole fact (the
    unknown location) is a single row in the anti-join.
    """

    def pairs(key: str) -> Column:
        return F.struct(F.lit(key).alias("key_column"), col(key).cast("string").alias("member"))

    counted = (
        fact.select(F.inline(F.array(*map(pairs, dimensions)))).groupBy("key_column", "member").agg(F.count("*").alias("cnt"))
    )
    members = union_all([d.select(pairs(key).alias("p")).select("p.*") for key, d in dimensions.items()])
    missing = counted.join(members, ["key_column", "member"], "left_anti").groupBy("key_column").agg(
        F.sum("cnt").alias("missing_refs")
    )
    keys = fact.sparkSession.createDataFrame([(key,) for key in dimensions], "key_column string")
    return keys.join(missing, "key_column", "left").select("key_column", F.coalesce("missing_refs", F.lit(0)).alias("missing_refs"))


def validation_report(
    raw: DataFrame,
    fact: DataFrame,
    tables: Mapping[str, DataFrame],
    dimensions: Mapping[str, DataFrame],
) -> DataFrame:
    """All checks as one long table: (check_name, subject, value).

    The fact is read twice: once for its rows and NULLs, once for the values of its keys.
    """

    def long(name: str, frame: DataFrame, subject: str, value: str) -> DataFrame:
        columns = [F.lit(name).alias("check_name"), col(subject).alias("subject"), col(value).cast("double").alias("value")]
        return frame.select(*columns)

    nulls = {f"null_{c}": F.count_if(col(c).isNull()) for c in FACT_KEYS}
    profile = fact.agg(F.count("*").alias("fact_rows"), *[n.alias(name) for name, n in nulls.items()])
    raw_rows = raw.agg(F.count("*")).scalar()
    profile = profile.withColumn("raw_rows", raw_rows).withColumn("dropped_rows", col("raw_rows") - col("fact_rows"))
    ratio = F.when(col("raw_rows") > 0, col("dropped_rows").cast("double") / col("raw_rows"))
    facts = {("row_count", name): "fact_rows" for name, table in tables.items() if table is fact}
    facts |= {("row_drop", c): c for c in ("raw_rows", "fact_rows", "dropped_rows", "dropped_ratio")}
    facts |= {("null_check", c): c for c in nulls}
    lines = [
        F.struct(F.lit(check).alias("check_name"), F.lit(subject).alias("subject"), col(c).cast("double").alias("value"))
        for (check, subject), c in facts.items()
    ]
    others = {name: table for name, table in tables.items() if table is not fact}
    return union_all(
        [
            profile.withColumn("dropped_ratio", ratio).select(F.inline(F.array(*lines))),
            long("row_count", table_counts(others), "table_name", "n_rows"),
            long("missing_refs", ref_integrity(fact, dimensions), "key_column", "missing_refs"),
        ]
    )


PROFILES = {
    "dim_service": ("service_id", ("service_name", "service_category")),
    "dim_department": ("department_id", ("department_name", "department_type")),
    "dim_location": ("location_id", ("street_address", "ward")),
    "dim_time": ("date_id", ("year", "month", "season")),
    "dim_geography": ("geography_id", ("ward", "police_district")),
    "dim_infrastructure": ("infrastructure_id", ("electrical_district", "utility_type")),
}


def dim_profile(dimensions: Mapping[str, DataFrame]) -> DataFrame:
    """Rows, duplicate ids and, per key column, the share of NULL, blank or 'Unknown'."""

    def profile(name: str) -> DataFrame:
        id_column, keys = PROFILES[name]
        frame = dimensions[name]
        empty = {
            key: is_blank(col(key).cast("string")) | (col(key).cast("string") == "Unknown")
            for key in keys
        }
        # Counting ids first keeps the rest of the profile free of COUNT(DISTINCT).
        per_id = frame.groupBy(id_column).agg(
            F.count("*").alias("n"),
            *[F.count_if(condition).alias(key) for key, condition in empty.items()],
        )
        totals = per_id.agg(
            F.sum("n").alias("total_records"),
            (F.sum("n") - F.count(id_column)).alias("pk_duplicates"),
            *[F.sum(key).alias(key) for key in keys],
        )
        wide = totals.select(
            "total_records",
            "pk_duplicates",
            *[(col(key) / col("total_records").cast("double")).alias(key) for key in keys],
        )
        return wide.unpivot(
            ["total_records", "pk_duplicates"], list(keys), "column_name", "null_rate"
        ).withColumn("table_name", F.lit(name))

    return union_all([profile(name) for name in PROFILES])

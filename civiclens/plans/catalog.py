"""Every query by name: how it is composed from the stage tables and the operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from civiclens.functions import rules
from civiclens.functions.calendar import calendar_attributes
from civiclens.functions.keys import location_hash, trimmed_hash
from civiclens.functions.text import clean, clean_or, try_date, try_double, try_int, try_timestamp
from civiclens.operators import eda, facts, features, quality, reports
from civiclens.operators.dimensions import (
    DEPARTMENT_KEYS,
    GEOGRAPHY_KEYS,
    INFRASTRUCTURE_KEYS,
    SERVICE_KEYS,
    clean_department_keys,
    clean_geography_keys,
    clean_infrastructure_keys,
    clean_location,
    clean_service_keys,
    infrastructure_profile,
)
from civiclens.operators.funnel import reduction_funnel
from civiclens.operators.incremental import Lake
from civiclens.operators.sampling import first_rows, hash_sample
from civiclens.plans.workspace import DIMENSIONS, Workspace, workspace
from civiclens.schema import RAW_SCHEMA
from civiclens.sources import files, ingest
from civiclens.streaming.landing import ingest_stream

col = F.col

FACT_DIMENSIONS = {
    "service_id": "dim_service",
    "department_id": "dim_department",
    "location_id": "dim_location",
    "date_id": "dim_time",
}


def _without_load_times(frame: DataFrame) -> DataFrame:
    return frame.drop("created_at", "updated_at")


# --- classification rules, applied to distinct keys with the rows behind each ----------


def _classified(requests: DataFrame, keys: list[str], **labels: Column) -> DataFrame:
    counted = requests.groupBy(*keys).agg(F.count("*").alias("cnt"))
    return counted.select(*keys, *[c.alias(n) for n, c in labels.items()], "cnt")


def _by_type(name: str, rule: Callable[[Column], Column]) -> Callable[[Workspace], DataFrame]:
    return lambda ws: _classified(ws.requests, ["sr_type"], **{name: rule(col("sr_type"))})


def _by_owner(name: str, rule: Callable[[Column], Column]) -> Callable[[Workspace], DataFrame]:
    return lambda ws: _classified(ws.requests, ["owner_department"], **{name: rule(col("owner_department"))})


def ward_region(ws: Workspace) -> DataFrame:
    places = _cleaned_places(ws.requests, "ward", "community_area", "latitude", "longitude")
    region = rules.geographic_region(*[col(c) for c in places.columns])
    return reports.counts_by(places.select("ward", region.alias("geographic_region")), "ward", "geographic_region")


def ward_cluster(ws: Workspace) -> DataFrame:
    return _classified(
        ws.requests,
        ["ward", "community_area"],
        geographic_cluster=rules.ward_cluster(try_int("ward"), col("community_area")),
    )


def ward_density(ws: Workspace) -> DataFrame:
    return _classified(ws.requests, ["ward"], population_density=rules.ward_density(try_int("ward")))


def ward_income(ws: Workspace) -> DataFrame:
    return _classified(ws.requests, ["ward"], socioeconomic_level=rules.ward_income(try_int("ward")))


def infra_age(ws: Workspace) -> DataFrame:
    return _classified(
        ws.requests,
        ["electrical_district"],
        infrastructure_age=rules.infrastructure_age(try_int("electrical_district")),
    )


def infra_profile(ws: Workspace) -> DataFrame:
    return _classified(ws.requests, list(INFRASTRUCTURE_KEYS), **infrastructure_profile())


def service_area(ws: Workspace) -> DataFrame:
    return _classified(
        ws.requests,
        ["police_district", "ward"],
        service_area=rules.service_area(col("police_district"), try_int("ward")),
    )


def geo_bbox(ws: Workspace) -> DataFrame:
    inside = F.coalesce(
        rules.inside_city_box(try_double("latitude"), try_double("longitude")), F.lit(False)
    )
    return _classified(ws.requests, ["latitude", "longitude"], inside_city=inside)


def geo_labels(ws: Workspace) -> DataFrame:
    ward = try_int("ward")
    return _classified(
        ws.requests,
        ["community_area", "ward", "police_district", "sanitation_division_days"],
        community_area_name=rules.labelled("Community Area ", clean("community_area")),
        ward_name=rules.labelled("Ward ", ward),
        alderman_name=rules.labelled("Alderman Ward ", ward),
        police_label=rules.labelled("Police District ", col("police_district")),
        sanitation_label=rules.labelled("Sanitation: ", col("sanitation_division_days")),
    )


def _cleaned_places(requests: DataFrame, *columns: str) -> DataFrame:
    cleaned = clean_location()
    return requests.select(*[cleaned[c].alias(c) for c in columns])


def address_completeness(ws: Workspace) -> DataFrame:
    parts = ["street_address", "street_name", "zip_code", "latitude", "longitude"]
    label = rules.address_completeness(*map(col, parts))
    return _classified(_cleaned_places(ws.requests, *parts), parts, address_completeness=label)


def spatial_quality(ws: Workspace) -> DataFrame:
    parts = ["street_address", "ward", "latitude", "longitude"]
    return _classified(
        _cleaned_places(ws.requests, *parts),
        parts,
        spatial_quality_score=rules.spatial_quality(*map(col, parts)),
        is_geocoded=col("latitude").isNotNull() & col("longitude").isNotNull(),
    )


def coordinate_precision(ws: Workspace) -> DataFrame:
    parts = ["street_address", "street_name", "latitude", "longitude"]
    label = rules.coordinate_precision(*map(col, parts))
    return _classified(_cleaned_places(ws.requests, *parts), parts, coordinate_precision=label)


# --- projections -------------------------------------------------------------------------


def clean_strings(ws: Workspace) -> DataFrame:
    return ws.raw.select(
        "sr_number",
        "created_date",
        clean_or("sr_type", "Unknown Service").alias("service_name"),
        clean_or("sr_short_code", "UNK").alias("service_short_code"),
        clean_or("origin", "Unknown Origin").alias("service_origin"),
        clean_or("owner_department", "Unknown Department").alias("department_name"),
        clean_or("created_department", "Unknown Creator").alias("created_department"),
        clean_or("city", "Chicago").alias("city"),
        clean_or("state", "IL").alias("state"),
        clean_or("zip_code", "Unknown").alias("zip_code"),
        *[
            clean(c).alias(c)
            for c in ("street_direction", "street_name", "street_type", "ward", "police_beat", "precinct")
        ],
    )


def safe_casts(ws: Workspace) -> DataFrame:
    return ws.raw.select(
        "sr_number",
        "created_date",
        try_timestamp("created_date").alias("created_ts"),
        try_timestamp("closed_date").alias("closed_ts"),
        try_date(F.left("created_date", F.lit(10))).alias("created_day"),
        try_int("created_hour").alias("created_hour"),
        try_int("ward").alias("ward"),
        try_double("latitude").alias("latitude"),
        try_double("x_coordinate").alias("x_coordinate"),
    )


def location_key(ws: Workspace) -> DataFrame:
    return facts.with_location_key(ws.requests).select("sr_number", "location_key")


def content_hashes(ws: Workspace) -> DataFrame:
    return ws.requests.select(
        "sr_number",
        trimmed_hash(*SERVICE_KEYS).alias("service_hash"),
        trimmed_hash(*DEPARTMENT_KEYS).alias("department_hash"),
        trimmed_hash(*GEOGRAPHY_KEYS).alias("geography_hash"),
        trimmed_hash(*INFRASTRUCTURE_KEYS).alias("infrastructure_hash"),
        location_hash(clean_location()).alias("location_hash"),
    )


def calendar_table(ws: Workspace) -> DataFrame:
    days = reports.counts_by(ws.raw.select(try_timestamp("created_date").cast("date").alias("day_id")), "day_id")
    return days.select("day_id", "cnt", *[c.alias(n) for n, c in calendar_attributes(col("day_id")).items()])


def distinct_months(ws: Workspace) -> DataFrame:
    created = try_timestamp("created_date")
    months = ws.requests.select(F.year(created).alias("year"), F.month(created).alias("month"))
    return months.distinct().orderBy("year", "month")


def _fact_columns(fact: DataFrame) -> DataFrame:
    return _without_load_times(fact).drop("year", "month")


# --- ingestion ----------------------------------------------------------------------------


def _landing(ws: Workspace) -> str:
    """Raw requests as landed JSON, one folder per month; landed once for all queries of the workspace."""

    def land(folder: str) -> None:
        files.write_landing(ws.raw.withColumn(ingest.MONTH_COLUMN, ingest.created_month()), folder)

    return ws.once("landing", land)


def _loaded(ws: Workspace, table: DataFrame) -> DataFrame:
    return table.select(*_flat(ws.raw).columns, ingest.MONTH_COLUMN)


def _flat(raw: DataFrame) -> DataFrame:
    """All columns but the struct."""
    return raw.drop("location")


def ingest_append(ws: Workspace) -> DataFrame:
    """Land everything, load it, then load again: the second run finds nothing pending."""
    landing, target, log = _landing(ws), ws.folder("ingested"), ws.folder("ingestion_log")
    table = f"raw.requests_{target[-8:]}"
    for _ in range(2):
        ingest.ingest_landing(ws.spark, landing, table, target, log)
    return _loaded(ws, ws.spark.table(table))


def resumable_ingest(ws: Workspace) -> DataFrame:
    """The same load as a stream that is run twice over the same landing folder."""
    landing, target, checkpoint = _landing(ws), ws.folder("streamed"), ws.folder("stream_checkpoint")
    for _ in range(2):
        ingest_stream(ws.spark, landing, target, checkpoint)
    loaded = ws.spark.read.schema(ingest.with_month(RAW_SCHEMA)).parquet(target)
    return _loaded(ws, loaded)


def _legacy_and_current(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Two batches with different columns: the late columns appear only in the second."""
    legacy = raw.where("coalesce(legacy_record, false)").select("sr_number", "sr_type", "legacy_sr_number", "created_date")
    current = raw.where("NOT coalesce(legacy_record, false)").select(
        "sr_number", "created_date", "sr_type", "created_department", "parent_sr_number"
    )
    return legacy, current


def schema_evolution(ws: Workspace) -> DataFrame:
    return ingest.evolve(*_legacy_and_current(ws.raw))


def aligned_append(ws: Workspace) -> DataFrame:
    location = ws.folder("appended")
    table = f"raw.appended_{location[-8:]}"
    for batch in _legacy_and_current(ws.raw):
        monthly = batch.withColumn(ingest.MONTH_COLUMN, ingest.created_month())
        spread = monthly.hint("rebalance", col(ingest.MONTH_COLUMN))
        ingest.append_batch(ws.spark, table, spread, location, ingest.MONTH_COLUMN)
    return ws.spark.table(table)


def csv_roundtrip(ws: Workspace) -> DataFrame:
    """All flat columns written and read again."""
    folder = ws.folder("export")
    export = _flat(ws.raw)
    files.write_csv(export, folder)
    return files.read_csv(ws.spark, folder, export.schema)


def feed_batches(raw: DataFrame) -> list[DataFrame]:
    """The feed in three batches: the older requests, the newer ones, and corrections that date one month's back by 40 days."""
    day = F.date_sub(F.left("created_date", F.lit(10)).cast("date"), 40).cast("string")
    corrected = F.concat(day, F.substring("created_date", 11, 100))
    older = col("created_date") < "1995-01-01"
    return [
        raw.where(older),
        raw.where(F.coalesce(~older, F.lit(True))),
        raw.where(ingest.created_month() == "1996-03").withColumn("created_date", corrected),
    ]


def _lake(ws: Workspace) -> Lake:
    """Three batches merged and loaded one by one, with the members as they were after the first two."""

    def fill(folder: str) -> None:
        lake = Lake(ws.spark, folder)
        for n, batch in enumerate(feed_batches(ws.raw), start=1):
            lake.merge(batch)
            lake.load_fact()
            if n < 3:
                members = _members(lake).withColumn("load", F.lit(n))
                members.write.parquet(f"{folder}/members_after/{n}")

    return Lake(ws.spark, ws.once("lake", fill))


def _members(lake: Lake) -> DataFrame:
    services = lake.dimension("dim_service").select(
        F.lit("dim_service").alias("dimension"), col("service_id").alias("member_id"), col("service_hash").alias("member_key")
    )
    return services.union(lake.dimension("dim_location").select(F.lit("dim_location"), "location_id", "location_key"))


def incremental_dedup(ws: Workspace) -> DataFrame:
    """The earliest record of each request over three merges."""
    return _lake(ws).requests().select("sr_number", "created_date", "sr_type", ingest.MONTH_COLUMN)


def stable_keys(ws: Workspace) -> DataFrame:
    """Members with their ids after the first and after the second load."""
    root = _lake(ws).root
    schema = "dimension string, member_id long, member_key string, load int"
    return ws.spark.read.schema(schema).parquet(f"{root}/members_after/1", f"{root}/members_after/2")


def incremental_fact(ws: Workspace) -> DataFrame:
    """The fact after three loads with the names of its members."""
    lake = _lake(ws)
    services = lake.dimension("dim_service").select("service_id", "service_name")
    departments = lake.dimension("dim_department").select("department_id", "department_name")
    named = lake.fact().join(services, "service_id", "left").join(departments, "department_id", "left")
    return named.select(
        "fact_id", "sr_number", "created_date", "status", "service_name", "department_name", "date_id", "year", "month"
    )


def pending_months(ws: Workspace) -> DataFrame:
    """Months still to load when the log holds all months before 1996."""
    months = reports.counts_by(
        ws.raw.select(ingest.created_month().alias(ingest.MONTH_COLUMN)), ingest.MONTH_COLUMN
    )
    return ingest.pending_months(months, months.where(col(ingest.MONTH_COLUMN) < "1996-01"))


# --- model features -----------------------------------------------------------------------


def _features(ws: Workspace) -> DataFrame:
    return features.feature_table(
        ws.table("fact_star"), ws.table("dim_service"), ws.table("dim_department"), ws.table("dim_time")
    )


def feature_table(ws: Workspace) -> DataFrame:
    return _features(ws).withColumn("hours_to_close", F.round("hours_to_close", 6))


def time_split(ws: Workspace) -> DataFrame:
    split = features.time_split(_features(ws), ws.train_until)
    return split.select("sr_number", "created_day", "is_closed", "split")


def _staged_split(ws: Workspace, label: str) -> DataFrame:
    """Training passes over its input many times, so it reads a written table."""
    return ws.stage(features.time_split(_features(ws), ws.train_until), f"features/{label}")


def model_input(ws: Workspace) -> DataFrame:
    """What the models learn from and are measured on: rows, positives and means per part."""
    split = features.time_split(_features(ws), ws.train_until)
    return split.groupBy("split").agg(
        F.count("*").alias("n_rows"),
        F.sum(col("is_closed").cast("long")).alias("n_closed"),
        F.round(F.avg("hours_to_close"), 4).alias("avg_hours_to_close"),
    )


def _unique(ws: Workspace, table: str, keys: dict[str, Column], id_column: str) -> DataFrame:
    """Members with distinct cleaned keys, so that a star join keeps one row per request."""
    return facts.unique_members(ws.table(table), list(keys), id_column)


QUERIES: dict[str, Callable[[Workspace], DataFrame]] = {
    # benchmark reports
    "count_requests_per_service": lambda ws: reports.counts_by(ws.table("fact_requests"), "service_id"),
    "top_10_services": lambda ws: reports.top_counts(ws.table("fact_requests"), "service_id"),
    "requests_per_department": lambda ws: reports.counts_by(ws.table("fact_requests"), "department_id"),
    "requests_per_location": lambda ws: reports.top_counts(ws.table("fact_requests"), "location_id"),
    "requests_by_month": lambda ws: reports.requests_by_month(ws.table("fact_requests")),
    "join_service_department": lambda ws: reports.service_department_pairs(
        ws.table("fact_requests"), ws.table("dim_service"), ws.table("dim_department")
    ),
    "fact_service_lookup": lambda ws: reports.service_lookup(ws.table("fact_requests"), ws.table("dim_service")),
    # sources and ingestion
    "window_extract": lambda ws: ingest.window_extract(ws.raw, "1995-03-01", "1996-02-29").select(
        "sr_number", "created_date", "sr_type", "status"
    ),
    "month_calendar": lambda ws: ingest.month_calendar(ws.raw),
    "ingest_append": ingest_append,
    "resumable_ingest": resumable_ingest,
    "incremental_dedup": incremental_dedup,
    "stable_keys": stable_keys,
    "incremental_fact": incremental_fact,
    "schema_evolution": schema_evolution,
    "aligned_append": aligned_append,
    "csv_roundtrip": csv_roundtrip,
    "pending_months": pending_months,
    "debug_sample": lambda ws: first_rows(_flat(ws.raw)),
    "location_key": location_key,
    # projections and predicates
    "clean_strings": clean_strings,
    "safe_casts": safe_casts,
    "service_category": _by_type("service_category", rules.service_category),
    "service_subcategory": _by_type("service_subcategory", rules.service_subcategory),
    "service_priority": _by_type("priority_level", rules.service_priority),
    "service_emergency": _by_type("is_emergency", rules.service_emergency),
    "service_resolution_days": _by_type("typical_resolution_days", rules.service_resolution_days),
    "department_type": _by_owner("department_type", rules.department_type),
    "department_hierarchy": _by_owner("department_hierarchy", rules.department_hierarchy),
    "department_capacity": _by_owner("agency_capacity", rules.department_capacity),
    "department_hours": _by_owner("operating_hours", rules.department_hours),
    "ward_region": ward_region,
    "ward_cluster": ward_cluster,
    "ward_density": ward_density,
    "ward_income": ward_income,
    "infra_age": infra_age,
    "infra_profile": infra_profile,
    "service_area": service_area,
    "geo_bbox": geo_bbox,
    "geo_labels": geo_labels,
    "address_completeness": address_completeness,
    "spatial_quality": spatial_quality,
    "coordinate_precision": coordinate_precision,
    "month_slice": lambda ws: _fact_columns(facts.month_slice(ws.table("fact_requests"), 1995, 3)),
    "geo_points": lambda ws: eda.geo_points(ws.raw),
    "rename_columns": lambda ws: eda.friendly(ws.raw),
    "distinct_months": distinct_months,
    # joins
    "star_join_service": lambda ws: facts.attach_service(
        ws.requests, _unique(ws, "dim_service", clean_service_keys(), "service_id")
    ).select(
        "sr_number", "service_id"
    ),
    "star_join_department": lambda ws: facts.attach_department(
        ws.requests, _unique(ws, "dim_department", clean_department_keys(), "department_id")
    ).select("sr_number", "department_id"),
    "star_join_geography": lambda ws: facts.attach_geography(
        ws.requests, _unique(ws, "dim_geography", clean_geography_keys(), "geography_id")
    ).select(
        "sr_number", "geography_id"
    ),
    "star_join_infrastructure": lambda ws: facts.attach_infrastructure(
        ws.requests, _unique(ws, "dim_infrastructure", clean_infrastructure_keys(), "infrastructure_id")
    ).select("sr_number", "infrastructure_id"),
    "star_join_time": lambda ws: facts.attach_time(ws.requests, ws.table("dim_time")).select(
        "sr_number", "created_date_id"
    ),
    "star_join_location": lambda ws: facts.attach_location(ws.requests, ws.table("dim_location")).select(
        "sr_number", "location_id"
    ),
    "dim_unique": lambda ws: quality.union_all(
        [
            facts.unique_members(ws.table(table), [name], key).select(
                F.lit(table).alias("table_name"), col(name).alias("member_name"), col(key).alias("member_id")
            )
            for table, name, key in (
                ("dim_service", "service_name", "service_id"),
                ("dim_department", "department_name", "department_id"),
                ("dim_location", "location_key", "location_id"),
            )
        ]
    ),
    "ref_integrity": lambda ws: quality.ref_integrity(
        ws.table("fact_requests"), {key: ws.table(name) for key, name in FACT_DIMENSIONS.items()}
    ),
    # aggregations
    "top_complaint_types": lambda ws: reports.top_counts(ws.raw, "sr_type", limit=20),
    "top_zip": lambda ws: eda.top_zip(ws.raw),
    "complaints_per_month": lambda ws: eda.complaints_per_month(ws.raw),
    "complaints_by_zip": lambda ws: eda.complaints_by_zip(ws.raw),
    "duplicate_keys": lambda ws: quality.duplicate_keys(ws.raw),
    "top_duplicate_keys": lambda ws: quality.duplicate_keys(ws.raw)
    .orderBy(F.desc("cnt"), "sr_number")
    .limit(20),
    "duplicate_key_total": lambda ws: quality.duplicate_key_total(ws.raw),
    "critical_field_nulls": lambda ws: quality.critical_field_nulls(ws.requests),
    "fact_null_checks": lambda ws: quality.fact_null_checks(ws.table("fact_requests")),
    "missing_values": lambda ws: quality.missing_values(ws.raw),
    "dimension_cardinality": lambda ws: quality.dimension_cardinality(ws.requests),
    "date_range": lambda ws: quality.date_range(ws.requests),
    "closure_stats": lambda ws: eda.closure_stats(ws.raw),
    "closure_histogram": lambda ws: eda.closure_histogram(ws.raw),
    "days_histogram": lambda ws: eda.days_histogram(ws.raw),
    "channel_usage": lambda ws: eda.channel_usage(ws.raw),
    "weekday_counts": lambda ws: eda.weekday_counts(ws.raw),
    "monthly_type_pivot": lambda ws: eda.monthly_type_pivot(ws.raw),
    "season_type_pivot": lambda ws: eda.season_type_pivot(ws.raw),
    "season_of_month": lambda ws: eda.season_of_month(ws.raw),
    "efficiency_by_type": lambda ws: eda.efficiency_by_type(ws.raw),
    "days_to_close": lambda ws: eda.closing_days(ws.raw),
    "time_features": lambda ws: eda.time_features(ws.raw),
    "table_counts": lambda ws: quality.table_counts(_all_tables(ws)),
    "drop_ratio": lambda ws: quality.drop_ratio(ws.raw, ws.table("fact_requests")),
    "overview": lambda ws: quality.overview(ws.raw),
    # windows, samples
    "dedup_requests": lambda ws: _flat(ws.requests),
    "fact_id_dense": lambda ws: ws.table("fact_requests").select("fact_id", "date_id", "sr_number"),
    "closure_sample": lambda ws: eda.closure_sample(ws.raw),
    "geo_point_sample": lambda ws: hash_sample(eda.geo_points(ws.raw), eda.MAP_POINTS, ["sr_number", "created_date"]),
    "geo_sample": lambda ws: hash_sample(eda.geo_points(ws.raw), eda.MAP_MARKERS, ["sr_number", "created_date"]),
    # composite builders and validators
    "dim_service": lambda ws: _without_load_times(ws.table("dim_service")),
    "dim_department": lambda ws: _without_load_times(ws.table("dim_department")),
    "dim_time": lambda ws: _without_load_times(ws.table("dim_time")),
    "dim_geography": lambda ws: _without_load_times(ws.table("dim_geography")),
    "dim_infrastructure": lambda ws: _without_load_times(ws.table("dim_infrastructure")),
    "dim_location": lambda ws: _without_load_times(ws.table("dim_location")),
    "fact_star": lambda ws: ws.table("fact_star"),
    "fact_requests": lambda ws: _fact_columns(ws.table("fact_requests")),
    "column_validation": lambda ws: quality.validated_columns(ws.raw),
    "validation_report": lambda ws: quality.validation_report(
        ws.raw,
        ws.table("fact_requests"),
        _all_tables(ws),
        {key: ws.table(name) for key, name in FACT_DIMENSIONS.items()},
    ),
    "dim_profile": lambda ws: quality.dim_profile({name: ws.table(name) for name in DIMENSIONS}),
    "calendar_attributes": calendar_table,
    "content_hashes": content_hashes,
    # documented extensions
    "feature_table": feature_table,
    "time_split": time_split,
    "model_input": model_input,
    "model_benchmark": lambda ws: features.model_benchmark(_staged_split(ws, "classification")),
    "closure_regression": lambda ws: features.closure_regression(_staged_split(ws, "regression")),
    "reduction_funnel": lambda ws: reduction_funnel(ws.raw, ws.requests),
}


def _all_tables(ws: Workspace) -> dict[str, DataFrame]:
    return {name: ws.table(name) for name in (*DIMENSIONS, "fact_requests")}


def run(name: str, spark: SparkSession, folder: str) -> DataFrame:
    """The named query over the tables in ``folder``."""
    return QUERIES[name](workspace(spark, folder))

"""Exploratory summaries over the raw requests."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from civiclens.functions.rules import season
from civiclens.functions.text import seconds_between, strict_timestamp, try_timestamp
from civiclens.operators.reports import counts_by, counts_per_month
from civiclens.operators.sampling import hash_sample

col = F.col

WEEKDAYS = ("Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday")
# Rows of the closure, point-map and marker-map samples.
CLOSURE_SAMPLE = 500_000
MAP_POINTS = 200_000
MAP_MARKERS = 500
# Friendly names of the upper-case export columns.
FRIENDLY_NAMES = {
    "SR_NUMBER": "service_request_number",
    "SR_TYPE": "service_request_type",
    "STATUS": "status",
    "ORIGIN": "how_reported",
    "CREATED_DATE": "creation_date",
    "CLOSED_DATE": "completion_date",
    "ZIP_CODE": "zip_code",
    "WARD": "ward",
    "POLICE_DISTRICT": "police_district",
    "COMMUNITY_AREA": "community_area",
}


def friendly(raw: DataFrame) -> DataFrame:
    """The ten exported columns under their friendly names; matching ignores case."""
    return raw.select(*FRIENDLY_NAMES).withColumnsRenamed(FRIENDLY_NAMES)


def complaints_per_month(raw: DataFrame) -> DataFrame:
    return counts_per_month(raw, strict_timestamp("created_date").cast("date"))


def complaints_by_zip(raw: DataFrame) -> DataFrame:
    present = raw.select("zip_code").dropna()
    return counts_by(present, "zip_code").orderBy(F.desc("cnt"), "zip_code")


def channel_usage(raw: DataFrame) -> DataFrame:
    present = raw.select("origin").dropna()
    return counts_by(present, "origin").orderBy(F.desc("cnt"), "origin")


def top_zip(raw: DataFrame, limit: int = 10) -> DataFrame:
    return complaints_by_zip(raw).limit(limit)


def time_features(raw: DataFrame) -> DataFrame:
    """Year-month, weekday name and hour of each request; NULL where the date is malformed."""
    created = try_timestamp("created_date")
    return raw.select(
        "sr_number",
        "created_date",
        F.date_format(created, "yyyy-MM").alias("year_month"),
        F.date_format(created, "EEEE").alias("weekday"),
        F.hour(created).alias("hour"),
    )


def weekday_counts(raw: DataFrame) -> DataFrame:
    """Requests per weekday, Monday first; a weekday without requests has a NULL count."""
    domain = raw.sparkSession.createDataFrame(
        list(enumerate(WEEKDAYS, start=1)), "position int, weekday string"
    )
    position = (F.weekday(try_timestamp("created_date")) + 1).alias("position")
    counted = counts_by(raw.select(position), "position")
    return domain.join(counted, "position", "left").select("position", "weekday", "cnt").orderBy("position")


def closure_hours() -> Column:
    """Hours from creation to closure; negative where the feed closes before it creates."""
    return seconds_between(strict_timestamp("created_date"), strict_timestamp("closed_date")) / F.lit(3600.0)


def days_to_close() -> Column:
    """Whole days from creation to closure, rounded towards minus infinity."""
    seconds = seconds_between(try_timestamp("created_date"), try_timestamp("closed_date"))
    return F.floor(seconds / F.lit(86400.0))


def closure_stats(raw: DataFrame) -> DataFrame:
    hours = raw.where(col("closed_date").isNotNull()).select(closure_hours().alias("hours"))
    return hours.agg(
        F.round(F.avg("hours"), 6).alias("avg_hours"),
        F.round(F.min("hours"), 6).alias("min_hours"),
        F.round(F.max("hours"), 6).alias("max_hours"),
    )


def closure_times(raw: DataFrame) -> DataFrame:
    return raw.where(col("closed_date").isNotNull()).select(closure_hours().alias("closure_time"))


def closure_sample(raw: DataFrame, size: int = CLOSURE_SAMPLE) -> DataFrame:
    """Closure hours of sampled requests. Requests are sampled before the hours are taken:
    a hash of the hours alone would keep or lose all requests of equal duration together."""
    closed = raw.where(col("closed_date").isNotNull()).select("sr_number", "created_date", "closed_date")
    return closure_times(hash_sample(closed, size, ["sr_number", "created_date"]))


def closing_days(raw: DataFrame) -> DataFrame:
    return raw.select("sr_number", "created_date", days_to_close().alias("days_to_close"))


def histogram(values: DataFrame, column: str, bins: int) -> DataFrame:
    """Equal-width histogram with all bins, empty ones included; the last bin is closed.

    The bounds come from a scalar subquery, so the table is scanned twice and shuffled as
    one row per bin and task.
    """
    x = col(column).cast("double")
    present = values.select(x.alias("x")).where(col("x").isNotNull())
    flat = F.min("x") == F.max("x")
    ends = present.agg(
        F.when(flat, F.min("x") - 0.5).otherwise(F.min("x")).alias("low"),
        F.when(flat, F.max("x") + 0.5).otherwise(F.max("x")).alias("high"),
    )
    # One struct, so that all uses below are the same subquery and Spark runs it once.
    bounds = ends.select(F.struct("low", ((col("high") - col("low")) / bins).alias("width"))).scalar()
    low, width = bounds.getField("low"), bounds.getField("width")
    position = F.least(F.floor((col("x") - low) / width), F.lit(bins - 1))
    counted = counts_by(present.select(position.alias("bin")), "bin")
    domain = values.sparkSession.range(bins).select(col("id").alias("bin"))
    return domain.join(counted, "bin", "left").select(
        "bin",
        F.round(low + col("bin") * width, 6).alias("lower_edge"),
        F.round(low + (col("bin") + 1) * width, 6).alias("upper_edge"),
        F.coalesce("cnt", F.lit(0)).alias("cnt"),
    )


def closure_histogram(raw: DataFrame, bins: int = 100) -> DataFrame:
    return histogram(closure_times(raw), "closure_time", bins)


def days_histogram(raw: DataFrame, bins: int = 10) -> DataFrame:
    return histogram(closing_days(raw), "days_to_close", bins)


def efficiency_by_type(raw: DataFrame, limit: int = 10) -> DataFrame:
    """The request types closed fastest, by mean whole days."""
    typed = raw.where(col("sr_type").isNotNull()).select("sr_type", days_to_close().alias("days"))
    means = typed.groupBy("sr_type").agg(F.round(F.avg("days"), 6).alias("avg_days_to_close"))
    return means.orderBy(col("avg_days_to_close").asc_nulls_last(), "sr_type").limit(limit)


def pivot_counts(frame: DataFrame, index: str, column: str, values: Sequence[str] | None = None) -> DataFrame:
    """Counts of index × column as a wide table, 0 where there are none.

    Pass the column values to spare the job that lists them; unlisted values would be
    dropped, so the list must be complete. Without it Spark lists them itself and stops at
    ``spark.sql.pivotMaxValues``.
    """
    present = frame.select(index, column).dropna()
    grouped = present.groupBy(index).pivot(column, list(values) if values else None)
    return grouped.agg(F.count(F.lit(1))).fillna(0).orderBy(index)


def monthly_type_pivot(raw: DataFrame, values: Sequence[str] | None = None) -> DataFrame:
    first = F.trunc(try_timestamp("created_date").cast("date"), "MM").alias("month")
    wide = pivot_counts(raw.select(first, "sr_type"), "month", "sr_type", values)
    return wide.withColumn("month", F.date_format("month", "yyyy-MM"))


def season_of_month(raw: DataFrame) -> DataFrame:
    """Requests per month number with its season. An undated request has no month and, as
    the last branch of the rule, counts as Fall."""
    month = F.month(try_timestamp("created_date"))
    return counts_by(raw.select(month.alias("month"), season(month).alias("season")), "month", "season")


def season_type_pivot(raw: DataFrame, values: Sequence[str] | None = None) -> DataFrame:
    label = season(F.month(try_timestamp("created_date"))).alias("season")
    return pivot_counts(raw.select(label, "sr_type"), "season", "sr_type", values)


def geo_points(raw: DataFrame) -> DataFrame:
    """The map columns of every request that has coordinates."""
    return raw.select("sr_number", "sr_type", "created_date", "latitude", "longitude").dropna(
        subset=["latitude", "longitude"]
    )

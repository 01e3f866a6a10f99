"""Cleaning and safe-cast column helpers shared by every table."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

NUMERIC_TEXT = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"


def as_column(value: str | Column) -> Column:
    return F.col(value) if isinstance(value, str) else value


def clean(value: str | Column) -> Column:
    """Trimmed text, NULL when blank."""
    return F.nullif(F.trim(as_column(value)), F.lit(""))


def clean_or(value: str | Column, default: str) -> Column:
    """Trimmed text, ``default`` when blank or NULL."""
    return F.coalesce(clean(value), F.lit(default))


def trimmed_or_empty(value: str | Column) -> Column:
    return F.coalesce(F.trim(as_column(value)), F.lit(""))


def is_blank(value: str | Column) -> Column:
    column = as_column(value)
    return column.isNull() | (F.trim(column) == "")


def try_int(value: str | Column) -> Column:
    """Text to INT, NULL when it is no number. Decimal and exponent forms round half away
    from zero, which a plain Spark cast would turn into NULL."""
    column = as_column(value)
    rounded = F.when(
        column.rlike(NUMERIC_TEXT), F.round(column.try_cast("double")).try_cast("int")
    )
    return F.coalesce(column.try_cast("int"), rounded)


def try_double(value: str | Column) -> Column:
    """Text to DOUBLE, NULL when it is no number. Java's ``1.0d`` spelling is no number."""
    column = as_column(value)
    return F.when(~column.rlike(r"[0-9.][dDfF]\s*$"), column.try_cast("double"))


def try_timestamp(value: str | Column) -> Column:
    """ISO text to a zone-less timestamp, NULL when malformed. Spark would read a bare
    ``2018`` as January 1st; anything shorter than a full date is rejected here."""
    column = as_column(value)
    return F.when(F.length(F.trim(column)) >= 10, column.try_cast("timestamp_ntz"))


def try_date(value: str | Column) -> Column:
    """ISO text to a date, NULL when malformed or shorter than a full date."""
    column = as_column(value)
    return F.when(F.length(F.trim(column)) >= 10, column.try_cast("date"))


def strict_timestamp(value: str | Column) -> Column:
    """ISO text to a zone-less timestamp; malformed text fails the job (ANSI cast)."""
    return as_column(value).cast("timestamp_ntz")


def seconds_between(start: Column, end: Column) -> Column:
    """Signed seconds from ``start`` to ``end`` as DOUBLE, for zone-less timestamps.

    Subtracting them never consults the session time zone, whose clock changes would
    otherwise shift times that fall into them.
    """
    return (end - start).cast("interval second").cast("decimal(20,6)").cast("double")

"""Calendar attributes of a date column."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from civiclens.functions.rules import first_match, season

# Month-day keys of the fixed holidays.
NAMED_FIXED_HOLIDAYS = (
    ("01-01", "New Years Day"),
    ("07-04", "Independence Day"),
    ("12-25", "Christmas Day"),
    ("11-11", "Veterans Day"),
)
UNNAMED_FIXED_HOLIDAYS = ("02-14", "10-31")
# Fixed values: (name, month, weekday with Sunday = 0, first day, last day).
FLOATING_HOLIDAYS = (
    ("Martin Luther King Jr Day", 1, 1, 15, 21),
    ("Presidents Day", 2, 1, 15, 21),
    ("Memorial Day", 5, 1, 25, 31),
    ("Labor Day", 9, 1, 1, 7),
    ("Thanksgiving", 11, 4, 22, 28),
)


def weekday_number(date: Column) -> Column:
    """0 = Sunday … 6 = Saturday."""
    return F.dayofweek(date) - 1


def _month_day(date: Column) -> Column:
    return F.date_format(date, "MM-dd")


def _floating(date: Column, name: str) -> Column:
    _, month, weekday, first, last = next(rule for rule in FLOATING_HOLIDAYS if rule[0] == name)
    return (
        (F.month(date) == month)
        & (weekday_number(date) == weekday)
        & F.dayofmonth(date).between(first, last)
    )


def is_weekend(date: Column) -> Column:
    return weekday_number(date).isin(0, 6)


def is_holiday(date: Column) -> Column:
    fixed = [key for key, _ in NAMED_FIXED_HOLIDAYS] + list(UNNAMED_FIXED_HOLIDAYS)
    found = _month_day(date).isin(*fixed)
    for name, *_ in FLOATING_HOLIDAYS:
        found = found | _floating(date, name)
    return found


def is_business_day(date: Column) -> Column:
    """Weekdays except the four named fixed holidays and Thanksgiving; the Monday holidays
    count as business days."""
    closed = _month_day(date).isin(*[key for key, _ in NAMED_FIXED_HOLIDAYS])
    return ~(is_weekend(date) | closed | _floating(date, "Thanksgiving"))


def holiday_name(date: Column) -> Column:
    branches = [(_month_day(date) == key, F.lit(name)) for key, name in NAMED_FIXED_HOLIDAYS]
    branches += [(_floating(date, name), F.lit(name)) for name, *_ in FLOATING_HOLIDAYS]
    return first_match(branches, F.lit(None).cast("string"))


def service_season(month: Column) -> Column:
    return first_match(
        [
            (month.isin(11, 12, 1, 2, 3), F.lit("Winter Service Peak")),
            (month.isin(6, 7, 8), F.lit("Summer Service Peak")),
        ],
        F.lit("Regular Season"),
    )


def fiscal_year(date: Column) -> Column:
    """Fiscal years start in July and carry the year they end in."""
    return F.year(date) + F.when(F.month(date) >= 7, 1).otherwise(0)


def fiscal_quarter(date: Column) -> Column:
    return (F.quarter(date) + 1) % 4 + 1


def business_days_in_month(month: Column) -> Column:
    """A constant per month length, not a count."""
    return first_match(
        [(month == 2, F.lit(20)), (month.isin(1, 3, 5, 7, 8, 10, 12), F.lit(23))], F.lit(22)
    )


def calendar_attributes(date: Column) -> dict[str, Column]:
    """Every attribute of the date dimension, by name, in table order."""
    month, day = F.month(date), F.dayofmonth(date)
    month_end = date == F.last_day(date)
    return {
        "year": F.year(date),
        "month": month,
        "day": day,
        "quarter": F.quarter(date),
        "day_of_week": weekday_number(date),
        "day_name": F.date_format(date, "EEEE"),
        "month_name": F.date_format(date, "MMMM"),
        "is_weekend": is_weekend(date),
        "is_holiday": is_holiday(date),
        "is_business_day": is_business_day(date),
        "season": season(month),
        "service_season": service_season(month),
        "fiscal_year": fiscal_year(date),
        "fiscal_quarter": fiscal_quarter(date),
        "week_of_year": F.weekofyear(date),
        "week_of_month": F.ceil(day / F.lit(7.0)).cast("int"),
        "day_of_year": F.dayofyear(date),
        "is_month_start": day == 1,
        "is_month_end": month_end,
        "is_quarter_start": (day == 1) & month.isin(1, 4, 7, 10),
        "is_quarter_end": month_end & month.isin(3, 6, 9, 12),
        "is_year_start": _month_day(date) == "01-01",
        "is_year_end": _month_day(date) == "12-31",
        "holiday_name": holiday_name(date),
        "business_days_in_month": business_days_in_month(month),
    }

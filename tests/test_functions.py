import datetime as dt

import pytest
from pyspark.sql import functions as F

from civiclens.functions import rules, text
from civiclens.functions.calendar import calendar_attributes


def one(spark, column, value, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(column.alias("y")).first().y


@pytest.mark.parametrize(
    "value, number",
    [("12", 12), (" 12 ", 12), ("3.7", 4), ("-3.5", -4), ("1e2", 100), ("bad", None), ("", None), (None, None),
     ("99999999999", None), ("NaN", None), (" 7 ", 7)],
)
def test_try_int(spark, value, number):
    assert one(spark, text.try_int("x"), value) == number


@pytest.mark.parametrize("value, number", [("41.5", 41.5), ("1e2", 100.0), ("1.0d", None), ("x", None), (None, None)])
def test_try_double(spark, value, number):
    assert one(spark, text.try_double("x"), value) == number


@pytest.mark.parametrize(
    "value, stamp",
    [("2018-12-01T00:29:55.000", dt.datetime(2018, 12, 1, 0, 29, 55)), ("2018", None), ("2018-12", None), ("bad", None),
     ("2018-12-01", dt.datetime(2018, 12, 1)), ("2018-13-01T00:00:00", None), ("", None), (None, None)],
)
def test_try_timestamp(spark, value, stamp):
    assert one(spark, text.try_timestamp("x"), value) == stamp


def test_strict_timestamp_fails_on_bad_text(spark):
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        one(spark, text.strict_timestamp("x"), "bad")


@pytest.mark.parametrize("value, cleaned", [(" a ", "a"), ("", None), ("   ", None), (None, None)])
def test_clean(spark, value, cleaned):
    assert one(spark, text.clean("x"), value) == cleaned
    assert one(spark, text.clean_or("x", "d"), value) == (cleaned or "d")
    assert one(spark, text.is_blank("x"), value) is (cleaned is None)


@pytest.mark.parametrize(
    "ladder, rule",
    [
        (rules.SERVICE_CATEGORY, rules.service_category),
        (rules.SERVICE_SUBCATEGORY, rules.service_subcategory),
        (rules.SERVICE_PRIORITY, rules.service_priority),
        (rules.RESOLUTION_DAYS, rules.service_resolution_days),
        (rules.DEPARTMENT_TYPE, rules.department_type),
        (rules.DEPARTMENT_HIERARCHY, rules.department_hierarchy),
        (rules.AGENCY_CAPACITY, rules.department_capacity),
        (rules.OPERATING_HOURS, rules.department_hours),
    ],
)
def test_every_keyword_gives_the_first_label_that_mentions_it(spark, ladder, rule):
    words = [w for _, ws in ladder for w in ws]
    texts = [f"A {w.upper()} b" for w in words]
    first = [next(label for label, ws in ladder if any(k in t.lower() for k in ws)) for t in texts]
    frame = spark.createDataFrame([(t,) for t in texts], "x string")
    assert [r.y for r in frame.select(rule(F.col("x")).alias("y")).collect()] == first


@pytest.mark.parametrize(
    "kind, category, subcategory",
    [("Street Light Out Complaint", "Transportation", "Tree Services"), ("Tree Emergency", "Environment", "Tree Services"),
     (None, "Other", "General"), ("", "Other", "General"), ("  POTHOLE ", "Transportation", "Road Maintenance")],
)
def test_service_rules_keep_their_order(spark, kind, category, subcategory):
    assert one(spark, rules.service_category(F.col("x")), kind) == category
    assert one(spark, rules.service_subcategory(F.col("x")), kind) == subcategory


@pytest.mark.parametrize("owner, label", [(None, "Missing Data"), (" ", "Missing Data"), ("Aviation", "Administrative")])
def test_missing_department(spark, owner, label):
    assert one(spark, rules.department_type(F.col("x")), owner) == label


@pytest.mark.parametrize(
    "day, name, holiday, business",
    [
        ("2024-01-01", "New Years Day", True, False),
        ("2024-01-15", "Martin Luther King Jr Day", True, True),
        ("2024-02-14", None, True, True),
        ("2024-02-19", "Presidents Day", True, True),
        ("2024-05-27", "Memorial Day", True, True),
        ("2024-07-04", "Independence Day", True, False),
        ("2024-09-02", "Labor Day", True, True),
        ("2024-10-31", None, True, True),
        ("2024-11-11", "Veterans Day", True, False),
        ("2024-11-28", "Thanksgiving", True, False),
        ("2024-12-25", "Christmas Day", True, False),
        ("2024-12-29", None, False, False),
        ("2024-12-30", None, False, True),
    ],
)
def test_holidays(spark, day, name, holiday, business):
    date = F.to_date("x")
    attributes = calendar_attributes(date)
    row = spark.createDataFrame([(day,)], "x string").select(*[c.alias(n) for n, c in attributes.items()]).first()
    assert (row.holiday_name, row.is_holiday, row.is_business_day) == (name, holiday, business)


@pytest.mark.parametrize("day", ["2023-12-31", "2024-01-01", "2024-02-29", "2024-03-31", "2024-06-30", "2024-07-01", "2024-12-30"])
def test_calendar_against_python(spark, day):
    date = dt.date.fromisoformat(day)
    tomorrow = date + dt.timedelta(days=1)
    row = spark.createDataFrame([(day,)], "x string").select(
        *[c.alias(n) for n, c in calendar_attributes(F.to_date("x")).items()]
    ).first()
    assert (row.year, row.month, row.day, row.quarter) == (date.year, date.month, date.day, (date.month + 2) // 3)
    assert row.day_of_week == date.isoweekday() % 7
    assert (row.day_name, row.month_name) == (date.strftime("%A"), date.strftime("%B"))
    assert row.week_of_year == date.isocalendar().week
    assert row.week_of_month == -(-date.day // 7)
    assert row.day_of_year == date.timetuple().tm_yday
    assert row.is_month_end == (tomorrow.day == 1)
    assert row.is_quarter_end == (tomorrow.day == 1 and tomorrow.month in (1, 4, 7, 10))
    assert row.is_quarter_start == (date.day == 1 and date.month in (1, 4, 7, 10))
    assert row.fiscal_year == date.year + (date.month >= 7)
    assert row.fiscal_quarter == {7: 1, 8: 1, 9: 1, 10: 2, 11: 2, 12: 2, 1: 3, 2: 3, 3: 3}.get(date.month, 4)

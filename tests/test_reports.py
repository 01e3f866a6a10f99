"""Summaries, checks, samples and the funnel against brute force on small inputs."""

import datetime as dt
import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from civiclens.operators import eda, quality, reports
from civiclens.operators.funnel import reduction_funnel
from civiclens.operators.dedup import dedup_requests
from civiclens.operators.sampling import first_rows, hash_sample
from civiclens.plans.summaries import write_summaries


def request(number, **fields):
    return {"sr_number": number, "created_date": "2024-01-02T03:04:05.000", **fields}


@pytest.mark.parametrize("values", [[0.0, 0.5, 1.0, 9.99, 10.0, None, -3.25], [4.0, 4.0], list(map(float, range(-50, 51)))])
@pytest.mark.parametrize("bins", [1, 4, 10])
def test_histogram_matches_numpy(spark, values, bins):
    frame = spark.createDataFrame([(v,) for v in values], "v double")
    rows = eda.histogram(frame, "v", bins).orderBy("bin").collect()
    counts, edges = np.histogram([v for v in values if v is not None], bins=bins)
    assert [r.cnt for r in rows] == counts.tolist()
    assert [r.lower_edge for r in rows] == pytest.approx(edges[:-1].tolist(), abs=1e-6)
    assert [r.upper_edge for r in rows] == pytest.approx(edges[1:].tolist(), abs=1e-6)


def test_weekdays_without_requests_are_listed(raw_frame):
    rows = eda.weekday_counts(raw_frame(request("1"), request("2"), request("3", created_date="bad"))).collect()
    assert [(r.weekday, r.cnt) for r in rows if r.cnt] == [("Tuesday", 2)]
    assert [r.weekday for r in rows] == list(eda.WEEKDAYS)


def test_pivot_finds_its_values(raw_frame):
    raw = raw_frame(
        request("1", sr_type="A"), request("2", sr_type="A"), request("3", sr_type="B"), request("4"),
        request("5", sr_type="B", created_date="2024-07-01T00:00:00.000"),
    )
    assert [r.asDict() for r in eda.monthly_type_pivot(raw).collect()] == [
        {"month": "2024-01", "A": 2, "B": 1},
        {"month": "2024-07", "A": 0, "B": 1},
    ]
    assert {r.season: (r.A, r.B) for r in eda.season_type_pivot(raw).collect()} == {"Summer": (0, 1), "Winter": (2, 1)}


def test_negative_days_round_down(raw_frame):
    raw = raw_frame(
        request("1", closed_date="2024-01-02T03:04:04.000"),
        request("2", closed_date="2024-01-03T03:04:05.000"),
        request("3"),
    )
    assert {r.sr_number: r.days_to_close for r in eda.closing_days(raw).collect()} == {"1": -1, "2": 1, "3": None}
    stats = eda.closure_stats(raw).first()
    assert (stats.min_hours, stats.max_hours) == (pytest.approx(-1 / 3600, abs=1e-6), 24.0)


def test_equal_counts_are_ordered_by_key(spark):
    frame = spark.createDataFrame([("b",), ("a",), (None,), ("c",), ("c",)], "k string")
    assert [r.k for r in reports.top_counts(frame, "k", limit=3).collect()] == ["c", "a", "b"]


def test_names_shared_by_ids_are_added_up(spark):
    fact = spark.createDataFrame([(1, 1), (2, 1), (-1, 1)], "service_id bigint, department_id bigint")
    services = spark.createDataFrame([(1, "S"), (2, "S")], "service_id bigint, service_name string")
    departments = spark.createDataFrame([(1, "D")], "department_id bigint, department_name string")
    rows = reports.service_department_pairs(fact, services, departments).collect()
    assert [tuple(r) for r in rows] == [("S", "D", 2), (None, "D", 1)]


def test_missing_values_and_validation(raw_frame):
    raw = raw_frame(request("1", status="x"), request("2")).withColumn("surplus", F.lit("s")).drop("location")
    missing = {r.column_name: r.missing_pct for r in quality.missing_values(raw).collect()}
    assert (missing["status"], missing["sr_number"], missing["ward"]) == (50.0, 0.0, 100.0)
    status = {r.column_name: r.column_status for r in quality.column_validation(raw).collect()}
    assert (status["surplus"], status["location"], status["status"]) == ("extra", "missing", "present")
    assert len(status) == 40
    filled = {r.column_name: (r.column_status, r.non_null) for r in quality.validated_columns(raw).collect()}
    assert filled["status"] == ("present", 1) and filled["surplus"] == ("extra", 2) and filled["location"] == ("missing", None)


def test_cardinality_counts_blank_as_unknown(raw_frame):
    row = quality.dimension_cardinality(raw_frame(
        request("1", sr_type=" a ", x_coordinate="1", y_coordinate="2"),
        request("2", sr_type="a", x_coordinate="1"),
        request("3", sr_type=" "),
        request("4", created_date="bad"),
    )).first()
    assert (row.unique_service_types, row.unique_coordinate_pairs, row.unique_wards) == (2, 2, 1)
    assert (row.unique_dates, row.unique_hours) == (1, 1)


def test_integrity_counts_null_and_unknown_keys(spark):
    fact = spark.createDataFrame([(1,), (1,), (-1,), (None,), (9,)], "service_id bigint")
    dimension = spark.createDataFrame([(1,), (2,)], "service_id bigint")
    rows = quality.ref_integrity(fact, {"service_id": dimension}).collect()
    assert [tuple(r) for r in rows] == [("service_id", 3)]


def test_date_range_ignores_malformed_dates(raw_frame):
    row = quality.date_range(raw_frame(
        request("1"), request("2", created_date="2023-05-01T00:00:00.000"), request("3", created_date="2018"),
    )).first()
    assert row.earliest_date == dt.datetime(2023, 5, 1) and row.unique_years == 2 and row.unique_months == 2


def test_samples(spark):
    frame = spark.range(3000).select(F.col("id"), (F.col("id") % 3 == 0).alias("hot"))
    for size in (1, 17, 500, 2999, 3000, 5000):
        sample = hash_sample(frame, size, seed=7).collect()
        assert len(sample) == len({r.id for r in sample}) == min(size, 3000)
    again = [r.id for r in hash_sample(frame.repartition(5), 100, seed=7).collect()]
    ranked = sorted(range(3000), key=lambda i: hashlib.md5(f"{i}|{str(i % 3 == 0).lower()}|7".encode()).hexdigest())
    assert again == ranked[:100]
    by_key = hash_sample(frame, 5, ["id"], seed=7).collect()
    assert [r.id for r in by_key] == sorted(range(3000), key=lambda i: hashlib.md5(f"{i}|7".encode()).hexdigest())[:5]
    assert [r.id for r in first_rows(frame.repartition(7), 10).collect()] == list(range(10))


def test_pivots_keep_every_type(raw_frame):
    raw = raw_frame(
        request("1", sr_type="Alley Light Out"), request("2", sr_type="Alley Light Out"), request("3", sr_type="Tree Trim")
    )
    for wide in (eda.monthly_type_pivot(raw), eda.season_type_pivot(raw)):
        cells = [r.asDict() for r in wide.collect()]
        assert sum(sum(v for v in row.values() if isinstance(v, int)) for row in cells) == 3
        assert {"Alley Light Out", "Tree Trim"} <= set(wide.columns)


def test_months_come_from_the_partitions(spark):
    fact = spark.createDataFrame([(2024, 1), (2024, 1), (2023, 12), (None, None)], "year int, month int")
    assert [tuple(r) for r in reports.requests_by_month(fact).collect()] == [("2023-12", 1), ("2024-01", 2), (None, 1)]


def test_sample_of_equal_rows(spark):
    assert hash_sample(spark.range(1000).select(F.lit(1).alias("x")), 10).count() == 10


def test_funnel(raw_frame):
    good = dict(status="Completed", duplicate=False, legacy_record=False)
    place = dict(street_address="1 A", latitude="41.8", longitude="-87.6")
    raw = raw_frame(
        request("1", **good, **place),
        request("1", **(good | {"created_date": "2025-01-01T00:00:00.000"}), **place),
        request("2", **(good | {"duplicate": True})),
        request("3", **(good | {"status": "Open"})),
        request("4", **(good | {"legacy_record": True})),
        request("5", parent_sr_number="1", **good),
        request("6", **good),
    )
    rows = reduction_funnel(raw, dedup_requests(raw)).collect()
    assert [(r.stage, r.n_rows) for r in rows] == [
        ("raw", 7), ("deduplicated", 5), ("closed", 4), ("non_legacy", 3), ("parent_merged", 2), ("located", 1),
    ]


def test_durations_ignore_the_session_time_zone(spark, raw_frame):
    raw = raw_frame(
        request("1", created_date="2024-03-09T12:00:00.000", closed_date="2024-03-10T12:00:00.000"),
        request("2", created_date="2024-03-10T01:30:00.000", closed_date="2024-03-10T02:30:00.000"),
    )
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Chicago")
    try:
        assert sorted(r.closure_time for r in eda.closure_times(raw).collect()) == [1.0, 24.0]
        assert [r.hour for r in eda.time_features(raw).orderBy("sr_number").collect()] == [12, 1]
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_summaries_are_written_as_tables_and_csv(spark, ws, tmp_path):
    names = write_summaries(ws, str(tmp_path))
    for name in names:
        table = spark.read.parquet(f"{tmp_path}/tables/{name}")
        assert spark.read.option("header", True).csv(f"{tmp_path}/csv/{name}").count() == table.count() > 0

"""Deduplication, dimensions and facts on hand-written requests, and invariants on all rows."""

import time

from pyspark.sql import functions as F

from civiclens.__main__ import main
from civiclens.operators import facts
from civiclens.operators.dedup import dedup_requests
from civiclens.plans.catalog import QUERIES
from civiclens.plans.workspace import DIMENSIONS, Workspace
from civiclens.sources import folders
from civiclens.sources.folders import release
from civiclens.sources.tables import raw_requests


def request(number, **fields):
    return {"sr_number": number, "created_date": "2024-01-02T03:04:05.000", **fields}


def test_dedup_keeps_the_earliest_and_one_null_number(raw_frame):
    raw = raw_frame(
        request("A", created_date="2024-01-02T00:00:00.000", status="late"),
        request("A", created_date="2024-01-01T00:00:00.000", status="early"),
        request("A", created_date=None, status="undated"),
        *[request(None, status=str(i)) for i in range(3)],
        request("B", status="only"),
    )
    rows = dedup_requests(raw).collect()
    assert {r.sr_number: r.status for r in rows if r.sr_number} == {"A": "early", "B": "only"}
    assert len(rows) == 3 and {r.rn for r in rows} == {1}


def test_dedup_settles_ties_alike_in_any_input_order(raw_frame):
    records = [request("A", status=str(i)) for i in range(20)]
    first = dedup_requests(raw_frame(*records)).first().status
    assert dedup_requests(raw_frame(*reversed(records)).repartition(5)).first().status == first


def test_dedup_limits_groups_before_the_shuffle(ws):
    plan = dedup_requests(ws.raw)._jdf.queryExecution().executedPlan().toString()
    assert plan.index("row_number(), 1, Final") < plan.index("Exchange hashpartitioning(sr_number")
    assert plan.index("Exchange hashpartitioning(sr_number") < plan.index("row_number(), 1, Partial")


def test_service_members_are_distinct_raw_texts(raw_frame, space):
    w = space(raw_frame(
        request("1", sr_type="Pothole", sr_short_code="PHF"),
        request("2", sr_type=" Pothole ", sr_short_code="PHF"),
        request("3", sr_type="", origin=""),
        request("4", sr_type=None, origin=""),
        request("5"),
    ))
    rows = {r.service_id: r for r in w.table("dim_service").collect()}
    # NULL and '' share an order key; '' comes first because NULLs are last in the tie-break.
    assert [rows[i].service_name for i in (1, 2, 3, 4)] == ["Unknown Service", "Unknown Service", "Pothole", "Pothole"]
    assert len(rows) == 4  # the request without any service field makes no member
    joined = facts.attach_service(w.requests, w.table("dim_service"))
    assert joined.where("sr_number = '1'").count() == 2
    star = w.table("fact_star")
    assert star.count() == 5
    assert {r.sr_number: r.service_id for r in star.collect()}["2"] == 3


def test_infrastructure_null_patterns(raw_frame, space):
    patterns = [
        dict(electrical_district=e, electricity_grid=g, sanitation_division_days=s)
        for e in ("5", None) for g in ("F1", None) for s in ("DAILY", None)
    ]
    more = [dict(electrical_district=d) for d in ("10", "11", "20", "21", "x")]
    more += [dict(sanitation_division_days=d) for d in ("MON", "Monday")]
    w = space(raw_frame(*[request(str(i), **p) for i, p in enumerate(patterns + more)]))
    rows = w.table("dim_infrastructure").collect()
    got = {(r.electrical_district, r.electricity_grid, r.sanitation_division_days): r for r in rows}
    assert (None, None, None) not in got and len(got) == len(patterns) - 1 + len(more)
    assert got["5", "F1", "DAILY"].utility_type == "Electrical"
    assert got["5", None, "DAILY"].utility_type == "Sanitation"
    assert got["5", None, None].utility_type == "Power Distribution"
    assert got[None, "F1", None].utility_type == "General Utility"
    assert got["5", "F1", None].service_reliability == "High Reliability"
    assert got[None, None, "MON"].service_reliability == "High Frequency"
    assert got[None, None, "Monday"].service_reliability == "Variable"
    assert got[None, "F1", None].service_reliability == "Standard Reliability"
    assert got["5", "F1", "DAILY"].capacity_level == "High Capacity"
    assert got["5", "F1", None].capacity_level == "Medium Capacity"
    assert got["5", None, None].capacity_level == "Standard Capacity"
    assert got[None, "F1", None].capacity_level == "Limited Capacity"
    assert got["5", None, "DAILY"].maintenance_schedule == "Sanitation: DAILY"
    ages = {d: got[d, None, None].infrastructure_age.split()[0] for d in ("5", "10", "11", "20", "21", "x")}
    assert ages == {"5": "Newer", "10": "Newer", "11": "Mature", "20": "Mature", "21": "Older", "x": "Mixed"}


def test_locations_sharing_a_hash_are_ranked_and_requests_find_the_first(raw_frame, space):
    place = dict(street_address="1 A ST", zip_code="60601", latitude="41.8", longitude="-87.6", ward="3")
    w = space(raw_frame(
        request("1", police_beat="2", **place),
        request("2", police_beat="1", **place),
        request("3", police_beat="1", **(place | {"street_address": " 1 A ST "})),
        request("4"),
    ))
    rows = w.table("dim_location").orderBy("location_id").collect()
    assert [r.location_id for r in rows] == [1, 2, 3]
    shared = [r for r in rows if r.street_address]
    assert [r.location_key[-2:] for r in shared] == ["_1", "_2"]
    assert [r.police_beat for r in shared] == ["1", "2"]
    assert {r.geographic_region for r in shared} == {"North Chicago"}
    found = {r.sr_number: r.location_id for r in w.table("fact_star").collect()}
    assert found["1"] == found["2"] == found["3"] == shared[0].location_id
    assert found["4"] == next(r.location_id for r in rows if not r.street_address)


def test_geography_joins_null_to_null(raw_frame, space):
    w = space(raw_frame(
        request("1", community_area="5", ward=" 7 "),
        request("2", community_area="5", ward="x"),
        request("3", police_beat="9"),
    ))
    rows = {r.sr_number: r.geography_id for r in w.table("fact_star").collect()}
    assert rows["1"] is not None and rows["2"] is not None and rows["1"] != rows["2"]
    assert rows["3"] is None


def test_fact_uses_minus_one_for_unknown_members(raw_frame, space):
    w = space(raw_frame(
        request("1", sr_type="Pothole", owner_department="Health", created_department="Health"),
        request("2", sr_type="  ", owner_department="Health", created_department="Nobody"),
    ))
    rows = {r.sr_number: r for r in w.table("fact_requests").collect()}
    assert rows["1"].service_id > 0 and rows["1"].department_id > 0
    assert (rows["2"].service_id, rows["2"].department_id) == (-1, -1)
    assert {r.location_id for r in rows.values()} == {-1}
    assert [rows[n].fact_id for n in ("1", "2")] == [1, 2]


def test_address_keys_match_when_the_dimension_holds_them(spark, raw_frame):
    requests = facts.with_location_key(raw_frame(request("1", street_number="1"), request("2", street_number="2")))
    key = requests.where("sr_number = '1'").first().location_key
    dimension = spark.createDataFrame([(key, 8), (key, 7), (key + "_1", 9)], "location_key string, location_id bigint")
    rows = facts.attach_by_address_key(requests, dimension).collect()
    assert {r.sr_number: r.location_id for r in rows} == {"1": 7, "2": -1}


def test_joins_do_not_change_the_number_of_requests(ws):
    n = ws.requests.count()
    assert n == ws.raw.select("sr_number").distinct().count()
    assert ws.table("fact_star").count() == n
    assert ws.table("fact_requests").count() == n


def test_ids_are_dense(ws):
    ids = {"fact_requests": "fact_id"} | {d: d.replace("dim_", "") + "_id" for d in DIMENSIONS if d != "dim_time"}
    for table, column in ids.items():
        row = ws.table(table).agg(F.min(column).alias("lo"), F.max(column).alias("hi"), F.count("*").alias("n"),
                                  F.count_distinct(column).alias("d")).first()
        assert (row.lo, row.hi, row.n) == (1, row.n, row.d), table


def test_month_slice_prunes_partitions(ws):
    plan = facts.month_slice(ws.table("fact_requests"), 1995, 3)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in plan


def test_a_later_run_reads_what_an_earlier_one_finished(spark, raw_frame, tmp_path):
    rows = raw_frame(request("1", sr_type="Pothole"), request("2", sr_type="Tree"))
    rows.write.parquet(str(tmp_path / "raw"))
    raw = lambda: spark.read.parquet(str(tmp_path / "raw"))
    root = str(tmp_path / "star")
    first = Workspace(spark, raw(), root)
    stamp = first.table("dim_service").first().created_at
    again = Workspace(spark, raw(), root, reuse=True)
    assert again.table("dim_service").first().created_at == stamp
    assert again.table("dim_time").count() == 1  # was not there yet
    assert Workspace(spark, raw(), root).table("dim_service").first().created_at > stamp
    assert not (tmp_path / "star" / "numbering" / "dim_service-ids").exists()
    # Rows that arrive later make all finished tables out of date.
    assert Workspace(spark, raw(), root).table("fact_requests").count() == 2
    raw_frame(request("3", sr_type="Rodent")).write.mode("append").parquet(str(tmp_path / "raw"))
    later = Workspace(spark, raw(), root, reuse=True)
    assert later.table("dim_service").count() == 3
    assert QUERIES["drop_ratio"](later).first().dropped_rows == 0


def test_star_joins_keep_one_row_per_request(spark, space, raw_frame):
    ws = space(raw_frame(request("1", sr_type="Pothole"), request("2", sr_type=" Pothole "), request("3", sr_type="Tree")))
    rows = QUERIES["star_join_service"](ws).collect()
    assert sorted(r.sr_number for r in rows) == ["1", "2", "3"]
    fanned = facts.attach_service(ws.requests, ws.table("dim_service"))
    assert fanned.count() == 5, "joined to raw members, every padded variant multiplies its requests"


def test_models_of_another_period(spark, raw_frame):
    from civiclens.plans.workspace import Workspace as Space

    days = [f"20{y}-0{m}-0{d}" for y in (18, 19) for m in range(1, 9) for d in range(1, 9)]
    rows = [
        request(str(n), created_date=f"{day}T01:00:00.000", closed_date=f"{day}T09:00:00.000" if n % 3 else None)
        for n, day in enumerate(days)
    ]
    ws = Space(spark, raw_frame(*rows, request("undated", created_date=None)), train_until="2018-12-31")
    parts = {r.split: r.n_rows for r in QUERIES["model_input"](ws).collect()}
    assert parts == {"train": 64, "test": 64, None: 1}
    assert QUERIES["model_benchmark"](ws).count() == 6


def test_command_line(spark, raw_frame, tmp_path, capsys):
    raw = str(tmp_path / "raw")
    raw_frame(request("1", sr_type="Pothole"), request("2", sr_type="Tree")).write.parquet(raw)
    main(["build", raw, str(tmp_path / "star")])
    main(["report", raw, str(tmp_path / "star"), "join_service_department"])
    assert "Pothole" in capsys.readouterr().out
    main(["summaries", raw, str(tmp_path / "star"), str(tmp_path / "eda")])
    assert (tmp_path / "eda" / "csv" / "summary_complaints_by_zip").is_dir()


def test_dedup_in_slices_is_the_whole_dedup(spark, raw_frame, tmp_path, monkeypatch):
    raw = raw_frame(
        *[{"sr_number": n, "created_date": f"2024-01-0{d}", "status": s} for n in ("1", "2", "3", "4", None) for d in (3, 2) for s in ("a", "b")],
        {"sr_number": "1"}, {"sr_number": "5"}, {"sr_number": ""}, {"sr_number": "1", "created_date": "2024-01-02", "status": "a"},
    )
    raw.write.parquet(str(tmp_path / "raw"))
    stored = spark.read.parquet(str(tmp_path / "raw"))
    assert len(folders.slices_of(raw)) == len(folders.slices_of(stored)) == 1
    monkeypatch.setattr(folders, "SLICE_BYTES", 1)
    slices = folders.slices_of(stored)
    assert len(slices) == folders.SLICES
    assert sum(s.count() for s in slices) == raw.count()
    whole = dedup_requests(raw)
    requests = Workspace(spark, stored).requests
    assert requests.schema.names == whole.schema.names
    assert sorted(map(str, requests.collect())) == sorted(map(str, whole.collect()))


def test_a_staged_table_leaves_no_shuffle_files(spark, space, raw_frame, monkeypatch):
    def shuffled():
        files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        return {f for f in str(files.mkString("\n")).split("\n") if "/shuffle_" in f}

    monkeypatch.setattr(folders, "SLICE_BYTES", 1)
    ws = space(raw_frame())
    release(spark)
    time.sleep(2)  # the files go in the background
    before = shuffled()
    ws.stage(spark.range(1000).repartition(4, "id"), "dealt")
    until = time.time() + 20
    while shuffled() - before and time.time() < until:
        time.sleep(0.2)
    assert shuffled() - before == set()


def test_raw_requests_shuffle_the_lines_once(spark, folder):
    plan = raw_requests(spark, folder)._jdf.queryExecution().executedPlan().toString()
    assert "REBALANCE" not in plan
    assert plan.count("Exchange hashpartitioning(l_orderkey") == 1
    assert "(o_custkey" not in plan[: plan.index("Exchange hashpartitioning(l_orderkey")]

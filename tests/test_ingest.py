import os
import shutil
import subprocess
import sys
import uuid
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from civiclens import session
from civiclens.schema import EXPECTED_COLUMNS, RAW_SCHEMA
from civiclens.sources import files, folders, ingest
from civiclens.streaming import landing as streaming
from civiclens.streaming.landing import ingest_stream


@pytest.fixture
def place(tmp_path):
    name = f"raw.t_{uuid.uuid4().hex[:8]}"
    return name, str(tmp_path / "table"), str(tmp_path / "landing"), str(tmp_path / "log")


def land(raw, folder):
    files.write_landing(raw.withColumn("ingest_month", ingest.created_month()), folder)


def request(number, day, **fields):
    return {"sr_number": number, "created_date": f"{day}T01:00:00.000", **fields}


def test_expected_columns():
    assert len(EXPECTED_COLUMNS) == len(set(EXPECTED_COLUMNS)) == len(RAW_SCHEMA) == 39


def test_insert_creates_evolves_and_aligns(spark, place):
    table, location, *_ = place
    first = spark.createDataFrame([(1, "Alice"), (2, "Bob"), (3, "Charlie")], "id bigint, name string")
    ingest.append_batch(spark, table, first, location)
    ingest.append_batch(spark, table, spark.createDataFrame([("x", 4)], "extra string, id bigint"), location)
    ingest.append_batch(spark, table, first, location)
    rows = sorted(map(tuple, spark.table(table).collect()), key=str)
    assert spark.table(table).columns == ["id", "name", "extra"]
    assert rows == sorted([(1, "Alice", None), (2, "Bob", None), (3, "Charlie", None)] * 2 + [(4, None, "x")], key=str)


def test_evolve_keeps_all_columns(spark):
    one = spark.createDataFrame([(1, 2)], "a int, b int")
    two = spark.createDataFrame([(3, 4)], "b int, c int")
    assert sorted(map(tuple, ingest.evolve(one, two).collect()), key=str) == [(1, 2, None), (None, 3, 4)]


def test_landing_is_loaded_once_and_grows(spark, raw_frame, place):
    table, location, landing, log = place
    land(raw_frame(request("1", "2024-01-05", ward=" "), request("2", "2024-02-05")), landing)
    load = lambda: [r[0] for r in ingest.ingest_landing(spark, landing, table, location, log).collect()]
    assert load() == ["2024-01", "2024-02"]
    assert load() == []
    files_of_march = raw_frame(request("3", "2024-03-05")).withColumn("ingest_month", ingest.created_month())
    files_of_march.write.mode("append").partitionBy("ingest_month").json(landing)
    assert load() == ["2024-03"]
    rows = spark.table(table).orderBy("sr_number").collect()
    assert [(r.sr_number, r.ingest_month, r.ward) for r in rows] == [
        ("1", "2024-01", " "), ("2", "2024-02", None), ("3", "2024-03", None),
    ]


def test_a_load_that_died_before_logging_is_repeated_without_duplicates(spark, raw_frame, place, tmp_path):
    table, location, landing, log = place
    land(raw_frame(request("1", "2024-01-05"), request("2", "2024-02-05")), landing)
    ingest.ingest_landing(spark, landing, table, location, log)
    ingest.ingest_landing(spark, landing, table, location, str(tmp_path / "lost_log"))
    assert spark.table(table).count() == 2


def land_lines(folder, month, *lines, name=None):
    path = Path(folder, f"ingest_month={month}")
    path.mkdir(parents=True, exist_ok=True)
    (path / f"part-{name or uuid.uuid4().hex}.json").write_text("\n".join(lines) + "\n")


def test_late_columns_are_loaded_by_default(spark, place):
    table, location, landing, log = place
    land_lines(landing, "2024-01", '{"sr_number": "1", "created_date": "2024-01-05T01:00:00.000"}')
    ingest.ingest_landing(spark, landing, table, location, log)
    land_lines(landing, "2024-02", '{"sr_number": "2", "late": "v", "od`d": {"a": 1}}', '{"sr_number": "3"}')
    ingest.ingest_landing(spark, landing, table, location, log)
    rows = spark.table(table).select("sr_number", "late", "`od``d`", "ingest_month").orderBy("sr_number").collect()
    assert [tuple(r) for r in rows] == [
        ("1", None, None, "2024-01"), ("2", "v", '{"a":1}', "2024-02"), ("3", None, None, "2024-02"),
    ]


def test_undated_rows_late_files_and_broken_lines(spark, raw_frame, place):
    table, location, landing, log = place
    land(raw_frame(request("1", "2024-01-05"), {"sr_number": "2"}, {"sr_number": "3", "created_date": "bad"}), landing)
    load = lambda: [tuple(r) for r in ingest.ingest_landing(spark, landing, table, location, log).collect()]
    assert load() == [("2024-01", 1, 0), ("unknown", 2, 0)]
    land_lines(landing, "2024-01", '{"sr_number": "4"}', "{broken", "", "[1]", '{"sr_number": "5", "duplicate": "x"}')
    assert load() == [("2024-01", 2, 3)]
    assert load() == []
    rows = spark.table(table).select("sr_number", "ingest_month").collect()
    assert sorted(map(tuple, rows)) == [("1", "2024-01"), ("2", "unknown"), ("3", "unknown"), ("4", "2024-01")]
    rejected = ["[1]", "{broken", '{"sr_number": "5", "duplicate": "x"}']
    assert sorted(r.line for r in spark.read.parquet(f"{log}/rejects").collect()) == sorted(rejected)
    land_lines(landing, "2024-01", "{broken", name="more")
    assert load() == [("2024-01", 2, 4)]
    lines = [(r.line, r.ingest_month) for r in spark.read.parquet(f"{log}/rejects").collect()]
    assert sorted(lines) == sorted((line, "2024-01") for line in [*rejected, "{broken"])


def test_a_load_that_died_before_the_log_is_repeated(spark, raw_frame, place):
    table, location, landing, log = place
    land_lines(landing, "2024-01", '{"sr_number": "1"}', "{broken")
    load = lambda: [tuple(r) for r in ingest.ingest_landing(spark, landing, table, location, log).collect()]
    assert load() == [("2024-01", 1, 1)]
    shutil.rmtree(f"{log}/files")
    assert load() == [("2024-01", 1, 1)]
    assert spark.table(table).count() == spark.read.parquet(f"{log}/rejects").count() == 1


def test_a_month_with_rejects_only_has_no_rows(spark, raw_frame, place):
    table, location, landing, log = place
    load = lambda: [tuple(r) for r in ingest.ingest_landing(spark, landing, table, location, log).collect()]
    land_lines(landing, "2024-01", '{"sr_number": "1"}', name="a")
    land_lines(landing, "2024-02", '{"sr_number": "2"}', "{broken", name="a")
    assert load() == [("2024-01", 1, 0), ("2024-02", 1, 1)]
    land_lines(landing, "2024-01", "{broken, and longer", name="a")
    land_lines(landing, "2024-02", '{"sr_number": "2", "status": "Open"}', name="a")
    assert load() == [("2024-01", 0, 1), ("2024-02", 1, 0)]
    assert [(r.sr_number, r.ingest_month) for r in spark.table(table).collect()] == [("2", "2024-02")]
    assert [r.line for r in spark.read.parquet(f"{log}/rejects").collect()] == ["{broken, and longer"]


def test_a_new_application_goes_on(spark, raw_frame, place):
    """A catalog in memory forgets the table; folder and log stay."""
    table, location, landing, log = place
    land_lines(landing, "2024-01", '{"sr_number": "1", "late": "v"}')
    ingest.ingest_landing(spark, landing, table, location, log)
    spark.sql(f"DROP TABLE {table}")
    land_lines(landing, "2024-02", '{"sr_number": "2"}')
    assert ingest.ingest_landing(spark, landing, table, location, log).count() == 1
    rows = spark.table(table).select("sr_number", "late", "ingest_month").orderBy("sr_number").collect()
    assert [tuple(r) for r in rows] == [("1", "v", "2024-01"), ("2", None, "2024-02")]


def test_rows_without_a_legacy_flag_are_kept(raw_frame):
    from types import SimpleNamespace

    from civiclens.plans.catalog import schema_evolution

    raw = raw_frame({"sr_number": "1", "legacy_record": True}, {"sr_number": "2", "legacy_record": False}, {"sr_number": "3"})
    assert sorted(r.sr_number for r in schema_evolution(SimpleNamespace(raw=raw)).collect()) == ["1", "2", "3"]


def test_csv_as_other_tools_read_it(spark, tmp_path):
    import csv

    frame = spark.createDataFrame([(1, 'say "hi"\nthere, \\ friend'), (2, None), (3, " x ")], "id int, t string")
    files.write_csv(frame, str(tmp_path / "csv"))
    read = [row for f in Path(tmp_path, "csv").glob("*.csv") for row in csv.DictReader(f.open(newline=""))]
    assert {(r["id"], r["t"]) for r in read} == {("1", 'say "hi"\nthere, \\ friend'), ("2", ""), ("3", " x ")}
    back = files.read_csv(spark, str(tmp_path / "csv"), frame.schema)
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, frame.collect()))


def test_stream_resumes(spark, raw_frame, tmp_path):
    landing, target, checkpoint = (str(tmp_path / n) for n in ("landing", "target", "checkpoint"))
    land(raw_frame(request("1", "2024-01-05")), landing)
    for _ in range(2):
        ingest_stream(spark, landing, target, checkpoint)
    assert spark.read.parquet(target).count() == 1
    more = raw_frame(request("2", "2024-01-06")).withColumn("ingest_month", ingest.created_month())
    more.write.mode("append").partitionBy("ingest_month").json(landing)
    land_lines(landing, "2024-02", '{"sr_number": "3", "late": "v"}', "{broken")
    ingest_stream(spark, landing, target, checkpoint)
    rows = spark.read.option("mergeSchema", True).parquet(target).select("sr_number", "late").collect()
    assert sorted(map(tuple, rows)) == [("1", None), ("2", None), ("3", "v")]
    assert [r.line for r in spark.read.parquet(f"{target}-rejects").collect()] == ["{broken"]


def test_window_is_inclusive(raw_frame):
    raw = raw_frame(
        {"sr_number": "1", "created_date": "2024-01-01T00:00:00.000"},
        {"sr_number": "2", "created_date": "2024-01-31T23:59:59.999"},
        {"sr_number": "3", "created_date": "2024-02-01T00:00:00.000"},
        {"sr_number": "4"},
    )
    assert sorted(r.sr_number for r in ingest.window_extract(raw, "2024-01-01", "2024-01-31").collect()) == ["1", "2"]


def test_months_without_requests_are_in_the_calendar(raw_frame):
    rows = ingest.month_calendar(raw_frame(request("1", "2023-12-05"), request("2", "2024-02-05"))).collect()
    assert [(str(r.month_start), str(r.month_end)) for r in rows] == [
        ("2023-12-01", "2023-12-31"), ("2024-01-01", "2024-01-31"), ("2024-02-01", "2024-02-29"),
    ]


def test_csv_types_can_be_inferred(spark, tmp_path):
    frame = spark.createDataFrame([(1, " a ", None), (2, "b,\"c\"", 1.5)], "id int, t string, d double")
    files.write_csv(frame, str(tmp_path / "csv"))
    back = files.read_csv(spark, str(tmp_path / "csv"))
    assert sorted(map(tuple, back.collect())) == [(1, " a ", None), (2, 'b,"c"', 1.5)]
    assert dict(back.dtypes) == {"id": "int", "t": "string", "d": "double"}


class FakeSession:
    def __init__(self, settings, checkpoint_folder=None):
        self.settings = settings
        self.conf = self.sparkContext = self
        self.getCheckpointDir = lambda: checkpoint_folder

    def get(self, key, default=None):
        return self.settings.get(key, default)


def test_shared_folder_comes_from_the_cluster():
    cluster = FakeSession({"spark.master": "yarn", "spark.checkpoint.dir": "hdfs://nn/shared/"})
    assert session.shared_folder(cluster) == "hdfs://nn/shared"
    assert session.shared_folder(FakeSession({}, "hdfs://nn/set/by/hand")) == "hdfs://nn/set/by/hand"
    for master in ("spark://host:7077", "local[4]"):
        with pytest.raises(ValueError):
            session.shared_folder(FakeSession({"spark.master": master}))


def test_real_session_without_the_setting_has_a_shared_folder(tmp_path):
    """In a process of its own: the setting is fixed once a context has started."""
    (tmp_path / "spark-defaults.conf").write_text("")
    code = (
        "from civiclens.session import local_session, shared_folder;"
        "from civiclens.plans.workspace import Workspace;"
        "s = local_session(2); assert s.conf.get('spark.checkpoint.dir', None) is None;"
        "ws = Workspace(s, s.range(3).toDF('id'));"
        "assert ws.root.startswith(shared_folder(s));"
        "assert ws.stage(ws.raw, 'x').count() == 3; print('ok')"
    )
    done = subprocess.run(
        [sys.executable, "-c", code],
        cwd=Path(__file__).resolve().parent.parent,
        env=os.environ | {"SPARK_CONF_DIR": str(tmp_path)},
        capture_output=True,
        text=True,
        timeout=180,
    )
    assert done.stdout.strip().endswith("ok"), done.stderr[-2000:]


def test_a_load_in_groups_of_months_is_the_whole_load(spark, raw_frame, place, tmp_path, monkeypatch):
    _, location, landing, log = place
    raw = raw_frame(*[request(f"{m}-{d}", f"2024-{m:02d}-{d:02d}", ward=" ") for m in range(1, 6) for d in range(1, 4)], {"sr_number": "x"})
    raw.write.parquet(str(tmp_path / "raw"))
    monkeypatch.setattr(folders, "SLICE_BYTES", 1)
    monkeypatch.setattr(ingest, "SLICE_BYTES", 1)
    land(spark.read.parquet(str(tmp_path / "raw")), landing)
    assert all(p.suffix == ".gz" for p in Path(landing).rglob("part-*"))
    land_lines(landing, "2024-03", '{"sr_number": "y", "late": "v"}', "{broken")
    loads, taken = [], []
    plain = ingest.read_landing
    monkeypatch.setattr(ingest, "read_landing", lambda *a: taken.append(a[2]) or plain(*a))
    for n in range(2):
        loads.append([tuple(r) for r in ingest.ingest_landing(spark, landing, place[0], location, log).collect()])
    assert len(taken) > 1 and sorted(sum(taken, [])) == sorted(p.name for p in Path(landing).iterdir() if p.is_dir())
    assert loads == [[(f"2024-{m:02d}", 4 if m == 3 else 3, int(m == 3)) for m in range(1, 6)] + [("unknown", 1, 0)], []]
    rows = {r.sr_number: (r.late, r.ward, r.ingest_month) for r in spark.table(place[0]).collect()}
    assert len(rows) == spark.table(place[0]).count() == 17 and rows["y"] == ("v", None, "2024-03") and rows["5-3"] == (None, " ", "2024-05")
    assert not [p for p in Path(log).iterdir() if p.name.startswith("scratch")]


def test_groups_of_months_are_even_and_whole():
    months = [(n, [f"m{n}"]) for n in (30 << 20, 30 << 20, 1, 200 << 20, 30 << 20)]
    assert ingest.month_groups([]) == [] and ingest.month_groups([(0, ["a"]), (5, ["b"])]) == [["a", "b"]]
    groups = ingest.month_groups(months)
    assert sum(groups, []) == [m for _, (m,) in months] and 1 < len(groups) <= ingest.SLICES


def test_the_stream_keeps_nothing_of_a_batch(spark, raw_frame, tmp_path, monkeypatch):
    landing, target, checkpoint = (str(tmp_path / n) for n in ("landing", "target", "checkpoint"))
    land(raw_frame(request("1", "2024-01-05"), request("2", "2024-02-05"), request("3", "2024-03-05")), landing)
    monkeypatch.setattr(streaming, "BATCH_BYTES", 1)
    ingest_stream(spark, landing, target, checkpoint)
    assert sorted(r.sr_number for r in spark.read.parquet(target).collect()) == ["1", "2", "3"]
    assert len([p for p in Path(target).iterdir() if p.is_dir()]) == 3
    assert not list(Path(f"{target}-scratch").iterdir())

import os
import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from civiclens.functions.keys import numbered
from civiclens.operators import incremental
from civiclens.operators.dedup import dedup_requests
from civiclens.operators.incremental import Lake
from civiclens.operators.registry import Registry
from civiclens.sources import folders


def request(number, day, **more):
    return {"sr_number": number, "created_date": day and f"{day}T10:00:00.000", "sr_type": "Tree", "status": "Open"} | more


def rows(frame, *columns):
    return sorted((tuple(r) for r in frame.select(*columns).collect()), key=str)


def files(root, table):
    return {p.relative_to(root).as_posix(): p.stat().st_mtime_ns for p in Path(root, table).rglob("*.parquet")}


def months_of(names):
    return {name.split("ingest_month=")[1].split("/")[0] for name in names}


@pytest.fixture
def lake(spark, tmp_path):
    return Lake(spark, str(tmp_path / "lake"))


BATCHES = (
    [request("1", "2024-01-05"), request("1", "2024-01-07"), request("2", "2024-02-05"), request(None, "2024-02-06"), request("9", None)],
    [request("3", "2024-03-05"), request("2", "2024-02-09"), request("9", None, status="Done"), request(None, "2024-03-01")],
    # A late earlier record moves request 3 from March to January; 9 gets a date.
    [request("3", "2024-01-02"), request("4", "2024-01-03"), request("9", "2024-04-01"), request("1", "2024-05-05")],
)


def test_three_merges_equal_one_dedup(raw_frame, lake):
    for batch in BATCHES:
        lake.merge(raw_frame(*batch))
    whole = dedup_requests(raw_frame(*[r for batch in BATCHES for r in batch]))
    columns = [c for c in whole.columns if c != "rn"]
    assert rows(lake.requests(), *columns) == rows(whole, *columns)


def test_random_merges_equal_one_dedup(raw_frame, lake):
    rnd = random.Random(4)
    day = lambda: rnd.choice([None, "bad", *(f"2024-{m:02d}-{d:02d}" for m in range(1, 7) for d in (1, 9))])
    batches = [[request(str(rnd.randrange(30)), day(), status=rnd.choice("ab")) for _ in range(rnd.randint(1, 25))] for _ in range(4)]
    for batch in batches:
        lake.merge(raw_frame(*batch))
    whole = dedup_requests(raw_frame(*[r for batch in batches for r in batch]))
    columns = [c for c in whole.columns if c != "rn"]
    assert rows(lake.requests(), *columns) == rows(whole, *columns)


def test_only_changed_months_are_read_and_written(raw_frame, lake):
    for batch in BATCHES[:2]:
        lake.merge(raw_frame(*batch))
    before = files(lake.root, "requests")
    read = []
    plain = lake.requests
    lake.requests = lambda months=None: read.append(plain(months)) or read[-1]
    merge = lake.merge(raw_frame(*BATCHES[2]))
    after = files(lake.root, "requests")
    # January gains 3 and 4, March loses 3 (and is empty), the unknown month loses 9, April gains it; 1 was earlier already.
    changed = {"2024-01", "2024-03", "2024-04", "unknown"}
    assert months_of({n for n in before.keys() ^ after.keys()}) == changed
    assert not {n for n in before.keys() & after.keys() if before[n] != after[n]}
    plan = read[0]._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [ingest_month" in plan and "2024-02" not in plan
    assert not any("2024-03" in n for n in after) and not any("unknown" in n for n in after)
    log = rows(lake.changes().where(F.col("merge") == merge), "ingest_month", "n_added", "n_removed")
    assert log == [("2024-01", 2, 0), ("2024-03", 0, 1), ("2024-04", 1, 0), ("unknown", 0, 1)]


def test_a_merge_that_died_is_repeated(raw_frame, lake, monkeypatch):
    lake.merge(raw_frame(*BATCHES[0]))
    lake.merge(raw_frame(*BATCHES[1]))
    dropped = []

    def die(spark, folder):
        dropped.append(folder)
        raise RuntimeError("lost")

    monkeypatch.setattr(incremental, "drop_folder", die)
    with pytest.raises(RuntimeError):
        lake.merge(raw_frame(*BATCHES[2]))  # data written, neither keys nor log
    monkeypatch.undo()
    assert lake.merge(raw_frame(*BATCHES[2])) == 2
    assert lake.merge(raw_frame(*BATCHES[2])) == 3  # the same batch once more changes nothing
    whole = dedup_requests(raw_frame(*[r for batch in BATCHES for r in batch]))
    assert rows(lake.requests(), "sr_number", "created_date", "status") == rows(whole, "sr_number", "created_date", "status")
    assert rows(lake.changes().where("merge = 3"), "ingest_month", "n_added") == [(None, 0)]


def test_later_columns_and_empty_batches(spark, raw_frame, lake):
    lake.merge(raw_frame())
    lake.merge(raw_frame(request("1", "2024-01-05")))
    lake.merge(raw_frame(request("2", "2024-01-06"), request("3", "2024-02-06")).withColumn("late", F.lit("x")))
    lake.merge(raw_frame(request("4", "2024-02-01")))
    assert rows(lake.requests(), "sr_number", "late") == [("1", None), ("2", "x"), ("3", "x"), ("4", None)]


def load(registry, stage, *members):
    frame = registry.spark.createDataFrame(list(members), "kind string, part string")
    order = [F.col("kind").asc_nulls_last(), F.col("part").asc_nulls_last()]
    found = registry.number(frame, order, "kind_id", stage, group="kind", rank="n")
    return {(r.kind, r.part): (r.kind_id, r.n) for r in found.collect()}


def test_ids_stay_and_have_no_gaps(spark, stage, tmp_path):
    registry = Registry(spark, str(tmp_path))
    first = load(registry, stage, ("b", "x"), ("b", None), ("a", "x"), ("z", None))
    assert first == {("a", "x"): (1, 1), ("b", "x"): (2, 1), ("b", None): (3, 2), ("z", None): (4, 1)}
    second = load(registry, stage, ("b", "a"), ("b", None), ("a", "w"), ("z", None), ("c", "1"), ("z", "1"))
    assert {k: v for k, v in second.items() if k in first} == first
    assert sorted(i for i, _ in second.values()) == list(range(1, 9))
    assert second["b", "a"] == (6, 3) and second["a", "w"] == (5, 2) and second["z", "1"] == (8, 2)
    assert load(registry, stage, ("b", "a")) == second and load(registry, stage) == second
    assert len(os.listdir(tmp_path / "kind_id")) == 2


def test_a_registry_of_one_load_numbers_like_a_build(ws, spark, tmp_path):
    from civiclens.operators.dimensions import dim_location

    registry = Registry(spark, str(tmp_path))
    columns = ["location_id", "location_key", "street_address", "ward"]
    found = dim_location(ws.requests, ws.stage, registry.number)
    assert rows(found, *columns) == rows(dim_location(ws.requests, ws.stage, numbered), *columns)


def fact_of(lake):
    return rows(lake.fact(), "fact_id", "sr_number", "created_date", "service_id", "year", "month")


def test_fact_loads_only_changed_months(raw_frame, spark, lake, tmp_path):
    dated = [[r for r in batch if r["sr_number"]] for batch in BATCHES]
    dated[2].append(request("7", "2024-02-20", sr_type="Noise"))
    for batch in dated[:2]:
        lake.merge(raw_frame(*batch))
    assert lake.load_fact() == ["2024-01", "2024-02", "2024-03", "unknown"]
    assert lake.load_fact() == []
    before = files(lake.root, "fact")
    merge = raw_frame(request("5", "2024-01-30", sr_type="Graffiti"))
    lake.merge(merge)
    assert lake.load_fact() == ["2024-01"]
    after = files(lake.root, "fact")
    assert months_of(before.keys() ^ after.keys()) == {"2024-01"}
    lake.merge(raw_frame(*dated[2]))
    lake.load_fact()
    assert months_of(files(lake.root, "fact")) == {"2024-01", "2024-02", "2024-04"}
    whole = Lake(spark, str(tmp_path / "whole"))
    whole.merge(raw_frame(*[r for batch in dated for r in batch], *[r.asDict() for r in merge.collect()]))
    whole.load_fact()
    names = lambda at: {r.service_id: r.service_name for r in at.dimension("dim_service").collect()}
    mine, theirs = names(lake), names(whole)
    named = lambda at, known: [(*r[:3], known.get(r[3]), *r[4:]) for r in fact_of(at)]
    assert named(lake, mine) == named(whole, theirs)
    assert [r[0] for r in fact_of(lake)] == list(range(1, len(fact_of(lake)) + 1))


def test_sliced_merges_equal_one_dedup(spark, raw_frame, lake, tmp_path, monkeypatch):
    monkeypatch.setattr(folders, "SLICE_BYTES", 1)
    monkeypatch.setattr(folders, "SLICES", 2)
    staged, plain = [], lake._stage
    lake._stage = lambda frame, label: staged.append(label) or plain(frame, label)
    for n, batch in enumerate(BATCHES):
        raw_frame(*batch).write.parquet(str(tmp_path / str(n)))
        lake.merge(spark.read.parquet(str(tmp_path / str(n))))
    assert staged.count("best/slice") == len(BATCHES) * folders.SLICES and staged.count("months/group") > len(BATCHES)
    whole = dedup_requests(raw_frame(*[r for batch in BATCHES for r in batch]))
    columns = [c for c in whole.columns if c != "rn"]
    assert rows(lake.requests(), *columns) == rows(whole, *columns)
    assert not Path(lake.root, "scratch").exists()

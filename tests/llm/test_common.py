import os

import pyarrow as pa
from pyspark.sql import functions as F

from civiclens.llm.common import WORKER_SETTINGS, join_counted, map_batches


def test_workers_give_freed_memory_back(spark):
    def run(batches):
        for batch in batches:
            pool, found = pa.default_memory_pool().backend_name, [os.environ.get(name, "") for name in WORKER_SETTINGS]
            yield pa.RecordBatch.from_arrays([pa.array([pool]), pa.array([found])], ["pool", "found"])

    row = map_batches(spark.range(1), run, "pool string, found array<string>").first()
    assert row.pool == "system"
    assert row.found == list(WORKER_SETTINGS.values()) and WORKER_SETTINGS["MALLOC_MMAP_THRESHOLD_"] == "1048576"


def test_batches_are_bounded_by_bytes(spark):
    def run(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.nbytes])], ["size"])

    texts = spark.range(0, 400, 1, 1).selectExpr("repeat('abcdefghij', 10000) AS text")
    sizes = [r.size for r in map_batches(texts, run, "size long").collect()]
    assert sum(sizes) >= 40_000_000 and max(sizes) < 9_000_000


def test_rows_of_a_hot_key_are_dealt_to_parts(spark):
    rows = spark.range(0, 6000, 1, 4).selectExpr("IF(id % 3 = 0, 7, id % 40 + 100) AS key", "id AS at")
    firsts = rows.groupBy("key").agg(F.min("at").alias("first"), F.count("*").alias("places")).where("key <> 120")
    found = join_counted(rows, firsts, ["key"], "places")
    assert found.columns == ["key", "at", "first", "places"]
    assert sorted(found.collect()) == sorted(rows.join(firsts, "key").collect())
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    # Rows meet the broadcast keys once and go one way, whether many or few of them are hot.
    assert "LeftAnti" not in plan and "Union" not in plan and plan.count("Join LeftOuter") == 1
    assert join_counted(rows.limit(0), firsts.limit(0), ["key"], "places").count() == 0

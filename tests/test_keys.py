import hashlib

from pyspark.sql import functions as F

from civiclens.functions.keys import BLOCK, address_key, dense_ids, nulls_last, rank_within, trimmed_hash


def test_dense_ids_number_all_rows_in_order(spark, stage):
    frame = spark.range(5000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.sha1(F.col("id").cast("string"))).alias("k"), "id"
    )
    rows = dense_ids(frame.repartition(7), nulls_last("k", "id"), "n", stage).collect()
    expected = sorted((r.k, r.id) for r in frame.collect())
    assert [(r.k, r.id) for r in sorted(rows, key=lambda r: r.n)] == expected
    assert sorted(r.n for r in rows) == list(range(1, 5001))


def test_dense_ids_split_a_hot_leading_key_over_blocks(spark, stage):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        frame = spark.range(20000).select(F.lit("same").alias("k"), "id")
        numbered = dense_ids(frame, nulls_last("k", "id"), "n", stage)
        ranked = rank_within(numbered, "k", "n", "rank")
        assert numbered.select(BLOCK).distinct().count() > 1
        assert ranked.where("rank <> n OR n <> id + 1").count() == 0
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_rank_restarts_in_each_group(spark, stage):
    frame = spark.range(3000).select((F.col("id") % 7).cast("string").alias("g"), "id")
    ranked = rank_within(dense_ids(frame, nulls_last("g", "id"), "n", stage), "g", "n", "rank")
    assert ranked.where(F.col("rank") != F.floor(F.col("id") / 7) + 1).count() == 0


def test_nulls_sort_last(spark, stage):
    frame = spark.createDataFrame([(None,), ("b",), ("a",)], "k string")
    rows = dense_ids(frame, nulls_last("k"), "n", stage).collect()
    assert {r.k: r.n for r in rows} == {"a": 1, "b": 2, None: 3}


def test_dense_ids_of_nothing(spark, stage):
    assert dense_ids(spark.createDataFrame([], "k string"), nulls_last("k"), "n", stage).count() == 0


def test_hashes(spark):
    frame = spark.createDataFrame([(" a ", None, "c")], "x string, y string, z string")
    assert frame.select(trimmed_hash("x", "y", "z").alias("h")).first().h == hashlib.md5(b"a||c").hexdigest()
    place = spark.createDataFrame(
        [("10", None, " 60601 ")], "street_number string, street_name string, zip_code string"
    )
    assert place.select(address_key().alias("h")).first().h == hashlib.md5(b"1060601").hexdigest()

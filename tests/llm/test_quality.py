import random
import zlib

from civiclens.llm.quality import accepted, features, op9_pairwise_quality


def corpus(spark, n=300):
    rnd = random.Random(3)
    word = lambda: "".join(rnd.choice("abcdefghij") for _ in range(rnd.randint(2, 9)))
    rows, labels = [], []
    for i in range(n):
        words = [word() for _ in range(rnd.randint(20, 300))]
        poor = i % 6 == 0
        if poor:
            words = [w + rnd.choice(["***", "###"]) for w in words] if i % 12 else [w for w in words[:20] for _ in range(9)]
        rows.append((i, " ".join(words), "x"))
        labels.append((i, int(not poor), 0))
    docs = spark.createDataFrame(rows, "doc_id long, text string, _features string")
    return docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_clean_documents_stay_and_poor_ones_go(spark):
    docs, labels = corpus(spark)
    kept = accepted(docs, labels)
    assert kept.columns == docs.columns
    ids = {r.doc_id for r in kept.collect()}
    assert ids == {i for i in range(300) if i % 6}


def test_odd_labels_and_texts(spark):
    docs, labels = corpus(spark, 120)
    odd = spark.createDataFrame([(900, None, "x"), (901, "", "x"), (None, "some text here", "x"), (1, "a", None)], docs.schema)
    more = spark.createDataFrame([(5, 0, 0), (7, None, None), (None, 0, 0), (8, 3, 0), (9, 1, 0)], labels.schema)
    assert accepted(docs.union(odd), labels.union(more)).count() >= 100
    assert accepted(docs, labels.where("false")).count() == 120, "without labels nothing is rejected"
    assert accepted(docs, labels.where("quality = 1")).count() == 120
    assert accepted(docs.where("false"), labels).collect() == []
    assert features(b" \n") == [0.0] * len(features(b"a"))
    assert len(features(b"word " * 400_000)) == len(features(b"a"))


def test_held_out_labels(spark, tmp_path):
    rows = op9_pairwise_quality(spark, "/root/testdata/sf0.01").collect()
    labels = {r.doc_id: r.quality for r in spark.read.parquet("/root/testdata/sf0.01/labels.parquet").collect()}
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    held = [(r.predicted, labels[r.doc_id]) for r in rows if r.held_out and r.doc_id in labels]
    assert sum(p == q for p, q in held) / len(held) > 0.97


def test_accepted_keeps_columns_with_names_of_helpers(spark):
    from civiclens.llm.quality import accepted

    rows = [(i, f"some plain text number {i}", "b", [0.5], "r", 1) for i in range(3)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, _body string, _features array<double>, row string, `a.b` int")
    kept = accepted(frame, spark.createDataFrame([], "doc_id long, quality int"))
    assert kept.columns == frame.columns and sorted(map(tuple, kept.collect())) == rows


def test_pairs_come_from_all_labelled_rows(spark, monkeypatch):
    """Also where a class has more than 10,000 rows, or rows share an id."""
    from pyspark.sql import functions as F

    from civiclens.llm import quality
    from civiclens.llm.common import Scratch

    seen = []

    class Seen(Exception):
        pass

    class Regression:
        def __init__(self, **settings):
            pass

        def fit(self, pairs):
            seen.extend(pairs.collect())
            raise Seen

    monkeypatch.setattr(quality, "LogisticRegression", Regression)
    # The first two features tell a good and a poor row; every third poor row comes twice, under one id with other features.
    zeros = [F.lit(0.0)] * (len(quality.FEATURES) - 2)
    rows = spark.range(34_000).withColumn("quality", (F.col("id") % 17 > 7).cast("int"))
    rows = rows.withColumn("copy", F.explode(F.when(F.expr("quality = 0 AND id % 3 = 0"), F.array(F.lit(0), F.lit(100_000))).otherwise(F.array(F.lit(0)))))
    number = (F.col("id") + F.col("copy") + 1).cast("double")
    vector = F.array(F.when(F.col("quality") == 1, number).otherwise(0.0), F.when(F.col("quality") == 0, number).otherwise(0.0), *zeros)
    featured = rows.select(F.col("id").alias("doc_id"), vector.alias("_features"))
    labels = rows.select(F.col("id").alias("doc_id"), "quality").distinct()
    try:
        quality.fit_ranking(featured, labels, Scratch(spark, "test"))
    except Seen:
        pass
    trained = rows.where(F.crc32(F.col("id").cast("string").cast("binary")) % 5 != 0).select("quality", number.alias("n")).collect()
    used = [{abs(r.features[i]) for r in seen} for i in (1, 0)]
    assert [{r.n for r in trained if r.quality == q} for q in (0, 1)] == used
    assert min(map(len, used)) > 10_000 and len(seen) == quality.PARTNERS * len(trained)
    assert all((r.features[0] > 0 > r.features[1]) == (r.label == 1.0) for r in seen)
    assert 0.4 < sum(r.label for r in seen) / len(seen) < 0.6

import zlib
from collections import Counter

import numpy as np

from civiclens.llm.shards import communication_matrix, draw_count, shard_documents


def test_matrix_has_the_given_sums():
    blocks, shards = [5, 0, 17, 100, 3], [25] * 5
    matrix = np.array(communication_matrix(blocks, shards, 3))
    assert matrix.sum(axis=1).tolist() == blocks and matrix.sum(axis=0).tolist() == shards
    assert communication_matrix([0], [0], 1) == [[0]]


def test_draws_follow_the_hypergeometric_law():
    rng = np.random.default_rng(1)
    draws = np.array([draw_count(rng, 30, 70, 20) for _ in range(20_000)])
    assert abs(draws.mean() - 6) < 0.05
    assert abs(draws.var() - 20 * 0.3 * 0.7 * 80 / 99) < 0.1
    want = np.bincount(rng.hypergeometric(30, 70, 20, 20_000), minlength=21)
    got = np.bincount(draws, minlength=21)
    assert (abs(got - want) < 6 * np.sqrt(want + 10)).all()
    large = [draw_count(rng, 3 * 10**10, 7 * 10**10, 10**7) for _ in range(50)]
    assert abs(np.mean(large) - 3 * 10**6) < 5 * 1450 / 50**0.5
    assert draw_count(rng, 0, 5, 3) == 0 and draw_count(rng, 5, 0, 3) == 3


def check(rows, documents):
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in rows) == Counter(
        (i, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t in documents
    )
    counts = Counter(r.shard for r in rows)
    sizes = [counts.get(s, 0) for s in range(24)]
    assert max(sizes) - min(sizes) <= 1 and set(counts) <= set(range(24))
    for shard in counts:
        assert sorted(r.slot for r in rows if r.shard == shard) == list(range(counts[shard]))
    assert all(r.law == "rows" and r.grown_shard is None for r in rows)


def test_shards_are_even_and_gapless(texts):
    documents = [(i, f"text {i % 7}") for i in range(500)] + [(1000, None), (1001, ""), (None, "a"), (None, "a"), (3, "text 3")]
    rows = shard_documents(texts(*documents)).collect()
    check(rows, documents)
    again = shard_documents(texts(*reversed(documents))).collect()
    assert Counter(rows) == Counter(again), "the order of the input must not matter"
    check(shard_documents(texts((1, "x"))).collect(), [(1, "x")])
    assert shard_documents(texts()).collect() == []


def test_every_row_reaches_every_shard_alike(spark):
    """Over many seeds, shard and slot of a row are uniform."""
    from pyspark.sql import functions as F

    frame = spark.range(48).select(F.col("id").alias("doc_id"), F.lit("same").alias("text"))
    places = Counter()
    for seed in range(25):
        places.update((r.shard, r.slot) for r in shard_documents(frame, seed=seed).where("doc_id = 5").collect())
    assert len({s for s, _ in places}) >= 10 and {slot for _, slot in places} == {0, 1}

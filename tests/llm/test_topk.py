import math
import random

import numpy as np

from civiclens.llm.topk import best_rows, quantised, top_k


def brute(rows, k=5):
    vectors = {}
    for i, v in rows:
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            vectors[i] = [math.floor(256 * np.float32(x).astype(float)) for x in v]
    out = set()
    for q in vectors:
        if q % 50 == 0:
            scores = sorted((-sum(a * b for a, b in zip(vectors[q], vectors[r])), r) for r in vectors if r != q)
            out |= {(q, n, r, -s) for n, (s, r) in enumerate(scores[:k], 1)}
    return out


def found(spark, rows):
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>").selectExpr("*", "1 AS shard", "2 AS weights")
    vectors = quantised(frame)
    return [tuple(r) for r in top_k(vectors, vectors.where("vec_id % 50 = 0"), 5).collect()]


def test_unusable_tied_and_repeated_vectors(spark):
    rnd = random.Random(4)
    rows = [(i, [rnd.choice([-1.0, -0.3, 0.0, 0.25, 1.0]) for _ in range(6)]) for i in range(180)]
    rows += [(400, None), (401, [None] + [1.0] * 5), (402, [math.nan] * 6), (403, [math.inf] + [0.0] * 5), (None, [1.0] * 6)]
    rows += [(i, [0.5] * 6) for i in range(500, 540)] + [rows[7], rows[50], (600, [1.0, 1.0]), (650, []), (700, [1e6] * 6)]
    got = found(spark, rows)
    assert len(got) == len(set(got)) and set(got) == brute(rows)
    assert found(spark, []) == []
    assert found(spark, [(50, [1.0])]) == []
    assert set(found(spark, [(50, [1.0]), (1, [2.0])])) == {(50, 1, 1, 256 * 512)}


def test_pruning_finds_the_best():
    rng = np.random.default_rng(2)
    for dims in (1, 5, 40):
        for spread in (3, 300):
            rows = rng.integers(-spread, spread + 1, size=(400, dims))
            ids = rng.permutation(400)
            for q in range(0, 400, 37):
                hits, scores = best_rows(np.ascontiguousarray(rows.T), ids, rows[q], ids[q], 5)
                all_scores = rows @ rows[q]
                order = [i for i in np.lexsort((ids, -all_scores)) if i != q][:5]
                assert hits.tolist() == ids[order].tolist() and scores.tolist() == all_scores[order].tolist()

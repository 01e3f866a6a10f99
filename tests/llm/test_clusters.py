import random

import numpy as np
import pytest

from civiclens.llm.clusters import LONG, VantageTree, clustered


def plain(points, vector):
    return min((sum((a - b) ** 2 for a, b in zip(p, vector)), k) for k, p in enumerate(points))


@pytest.mark.parametrize("spread", [2, 60, 1 << 40])
@pytest.mark.parametrize("n", [1, 2, 3, 5, 16, 40])
def test_nearest_centroids_are_those_of_brute_force(n, spread):
    rnd = random.Random(n * spread)
    points = [tuple(rnd.randint(-spread, spread) for _ in range(4)) for _ in range(n)]
    points += points[: n // 3]
    vectors = [[rnd.randint(-spread, spread) for _ in range(4)] for _ in range(300)] + [list(p) for p in points]
    matrix = np.array(vectors, dtype=np.int64 if spread < 1 << 27 else object)
    nearest, squares = VantageTree(points).nearest(matrix)
    assert [(int(s), int(k)) for s, k in zip(squares, nearest)] == [plain(points, v) for v in vectors]


def brute(rows, clusters, rounds, components, scale):
    import hashlib
    import math

    kept = [(i, [math.floor(x) * scale if abs(x) >= 1 << 53 else math.floor(x * scale) for x in v]) for i, v in rows if v and len(v) == components and all(x is not None and math.isfinite(x) for x in v)]
    digest = lambda i: hashlib.sha256(f"1:{i}".encode()).hexdigest()
    points = [v for _, v in sorted(kept, key=lambda r: (r[0] is None, digest(r[0]), r[1]))[:clusters]]
    for _ in range(rounds):
        groups = {}
        for _, v in kept:
            groups.setdefault(plain(points, v)[1], []).append(v)
        for k, members in groups.items():
            points[k] = [sum(c) // len(members) for c in zip(*members)]
    found = [(i, *plain(points, v)) for i, v in kept]
    inertia = {}
    for _, d, k in found:
        inertia[k] = inertia.get(k, 0) + d
    fits = lambda n: n if n <= LONG else None
    inside = lambda k: None if any(d > LONG for _, d, c in found if c == k) else fits(inertia[k])
    whole = None if any(inside(k) is None and any(d > LONG for _, d, c in found if c == k) for k in inertia) else fits(sum(inertia.values()))
    return sorted([(i is None, i or 0, k, fits(d), inside(k), whole, [str(x) for x in points[k]]) for i, d, k in found], key=str)


def result(frame, **options):
    rows = clustered(frame, **options).collect()
    return sorted([(r.vec_id is None, r.vec_id or 0, r.cluster, r.distance, r.cluster_inertia, r.inertia, r.centroid) for r in rows], key=str)


@pytest.mark.parametrize("case", ["ties", "wide", "few"])
def test_clusters_are_those_of_brute_force(spark, case):
    rnd = random.Random(5)
    value = {"ties": lambda: rnd.randint(-1, 1), "wide": lambda: rnd.choice([-1e30, 1e9, 3e37, 0.1]), "few": lambda: rnd.random()}[case]
    rows = [(i, [float(value()) for _ in range(3)]) for i in range(3 if case == "few" else 200)]
    rows += [(5, rows[0][1]), rows[1], (None, rows[2][1]), (901, None), (902, [1.0, None, 2.0]), (903, [1.0, float("nan"), 2.0])]
    rows += [(904, [1.0, float("inf"), 2.0]), (905, [1.0]), (906, []), (907, [1.0] * 4)]
    schema = "vec_id long, embedding array<double>, cluster string, distance string, vector int"
    frame = spark.createDataFrame([(*r, "x", "y", 1) for r in rows], schema).repartition(5)
    options = {"clusters": 6, "rounds": 3, "components": 3, "scale": 64}
    assert result(frame, **options) == brute(rows, 6, 3, 3, 64)


def test_no_vectors(spark):
    empty = spark.createDataFrame([(1, None)], "vec_id long, embedding array<float>")
    assert clustered(empty).collect() == []
    assert clustered(empty.where("false")).columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid"]

"""Centroid clustering of whole-number vectors, each assigned through a vantage-point tree of the centroids.

Every round builds a tree over the centroids on the driver (as many points as clusters, whatever the
table) and broadcasts it. A node has a vantage point and two halves of the other points by their
distance from it, with the least and largest of these distances. A vector opens the open node with the least bound first, as
long as that bound does not pass its best distance; equal counts, since an equally near centroid may
have the smaller number. Bounds are floats with a margin for rounding; distances are exact integers.
Each task sends one partial sum per cluster and component.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from civiclens.llm.common import Batches, Scratch, map_batches, table

col = F.col

COMPONENTS = 64
SCALE = 64
CLUSTERS = 16
ROUNDS = 3
LEAF = 2
"""Centroids of a leaf."""
NARROW = 1 << 27
"""Components below this have squared distances of up to 1,000 components within 64 bits; others are counted as Python integers."""
MARGIN = 1e-12
"""Part of the distances that the rounding of a bound stays below."""
FAR = 1e300
"""Distances from here on count as equal in bounds, which only prunes less."""
LIMB = 62
"""Bits of the parts that sums travel in."""
LONG = (1 << 63) - 1


def usable(frame: DataFrame, id_column: str, vector: str, components: int) -> DataFrame:
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    kept = frame.where((F.size(vector) == components) & F.forall(vector, finite))
    return kept.select(col(id_column).cast("long").alias("vec_id"), col(vector).cast("array<double>").alias("vector"))


def _integers(vectors: np.ndarray, scale: int) -> np.ndarray:
    """``floor(scale * x)`` of every component, as 64-bit integers where distances stay in 64 bits."""
    if np.abs(vectors).max(initial=0) * scale < NARROW:
        return np.floor(vectors * scale).astype(np.int64)
    exact = lambda x: math.floor(x) * scale if abs(x) >= 1 << 53 else math.floor(x * scale)
    return np.array([[exact(x) for x in row] for row in vectors.tolist()], dtype=object)


def _squared(vectors: np.ndarray, centroid: Sequence[int]) -> np.ndarray:
    narrow = vectors.dtype != object and max(map(abs, centroid)) < NARROW
    point = np.array(centroid, dtype=np.int64 if narrow else object)
    apart = (vectors if narrow else vectors.astype(object)) - point
    return (apart * apart).sum(axis=1)


def _roots(squares: np.ndarray) -> np.ndarray:
    if squares.dtype != object:
        return np.sqrt(squares.astype(np.float64))
    return np.array([min(FAR, float(min(math.isqrt(s), int(FAR)))) if s > 1 << 100 else math.sqrt(s) for s in squares])


@dataclass
class VantageTree:
    """Nodes in preorder: (vantage point, [(child, least, largest distance)]) or (None, members of a leaf)."""

    points: list[tuple[int, ...]]
    nodes: list[tuple] = field(default_factory=list)

    def __post_init__(self) -> None:
        self._grow(list(range(len(self.points))))

    def _grow(self, members: list[int]) -> int:
        place = len(self.nodes)
        self.nodes.append((None, members))
        if len(members) > LEAF:
            vantage, rest = members[0], members[1:]
            matrix = np.array([self.points[m] for m in rest], dtype=object)
            away = dict(zip(rest, _roots(_squared(matrix, self.points[vantage])).tolist()))
            rest.sort(key=lambda m: (away[m], m))
            halves = [half for half in (rest[: len(rest) // 2], rest[len(rest) // 2 :]) if half]
            children = [(self._grow(half), away[half[0]], away[half[-1]]) for half in halves]
            self.nodes[place] = (vantage, children)
        return place

    def nearest(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number of the nearest point (the smaller of equally near ones) and the squared distance, per vector.

        All vectors advance together, each by the node that its own bounds put first.
        """
        n = len(vectors)
        bounds = np.full((n, len(self.nodes)), np.inf)
        bounds[:, 0] = 0
        best = np.full(n, -1)
        square = np.zeros(n, dtype=vectors.dtype if self._narrow() else object)
        radius = np.full(n, np.inf)
        active = np.arange(n)

        def meet(rows: np.ndarray, point: int) -> np.ndarray:
            found = _squared(vectors[rows], self.points[point])
            better = (best[rows] < 0) | (found < square[rows]) | ((found == square[rows]) & (point < best[rows]))
            won = rows[better.astype(bool)]
            square[won], best[won] = found[better.astype(bool)], point
            away = _roots(found)
            radius[won] = away[better.astype(bool)]
            return away

        while len(active):
            first = bounds[active].argmin(axis=1)
            least = bounds[active, first]
            open_ = np.isfinite(least) & (least <= radius[active])
            active, first = active[open_], first[open_]
            for place in np.unique(first):
                rows = active[first == place]
                bound = bounds[rows, place].copy()
                bounds[rows, place] = np.inf
                vantage, children = self.nodes[place]
                if vantage is None:
                    for member in children:
                        meet(rows, member)
                    continue
                away = meet(rows, vantage)
                for child, low, high in children:
                    apart = np.maximum(low - away, away - high) - MARGIN * (away + high)
                    bounds[rows, child] = np.maximum(bound, apart)
        return best, square

    def _narrow(self) -> bool:
        return all(abs(x) < NARROW for point in self.points for x in point)


def _matrices(batches: Batches, scale: int, components: int):
    """Whole-number vectors with the batch they are of."""
    for batch in batches:
        if batch.num_rows:
            values = batch.column(1).flatten().to_numpy(zero_copy_only=False)
            yield batch, _integers(values.reshape(batch.num_rows, components), scale)


def _limbs(value: int):
    low = (1 << LIMB) - 1
    while not -low <= value <= low:
        yield value & low
        value >>= LIMB
    yield value


def _sums(vectors: DataFrame, tree, scale: int, components: int) -> dict[int, list[int]]:
    """Per cluster the sum of every component and, last, the number of vectors: clusters x components numbers."""

    def run(batches: Batches) -> Batches:
        totals: dict[int, np.ndarray] = {}
        for _, matrix in _matrices(batches, scale, components):
            nearest, _ = tree.value.nearest(matrix)
            order = np.argsort(nearest, kind="stable")
            heads = np.flatnonzero(np.append(True, np.diff(nearest[order]) > 0))
            sums = np.add.reduceat(matrix[order], heads, axis=0).astype(object)
            counts = np.diff(np.append(heads, len(order)))
            for k, row, n in zip(nearest[order][heads].tolist(), sums, counts.tolist()):
                totals[k] = totals.get(k, 0) + np.append(row, n)
        rows = [
            (k, at, part, limb)
            for k, row in totals.items()
            for at, value in enumerate(row.tolist())
            for part, limb in enumerate(_limbs(value))
        ]
        kinds = (pa.int32(), pa.int32(), pa.int32(), pa.int64())
        columns = list(zip(*rows)) or [()] * 4
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], ["cluster", "place", "part", "total"])

    partial = map_batches(vectors, run, "cluster int, place int, part int, total long")
    summed = partial.groupBy("cluster", "place", "part").agg(F.sum(col("total").cast("decimal(28,0)")).alias("total"))
    out: dict[int, list[int]] = {}
    for r in summed.collect():
        row = out.setdefault(r["cluster"], [0] * (components + 1))
        row[r["place"]] += int(r["total"]) << (LIMB * r["part"])
    return out


def _starts(vectors: DataFrame, clusters: int, scale: int) -> list[tuple[int, ...]]:
    digest = F.sha2(F.concat(F.lit("1:"), col("vec_id").cast("string")), 256)
    first = vectors.select(digest.alias("digest"), "vector").orderBy(F.asc_nulls_last("digest"), "vector").limit(clusters)
    return [tuple(_integers(np.array([r["vector"]]), scale)[0].tolist()) for r in first.collect()]


def clustered(
    frame: DataFrame,
    id_column: str = "vec_id",
    vector: str = "embedding",
    clusters: int = CLUSTERS,
    rounds: int = ROUNDS,
    components: int = COMPONENTS,
    scale: int = SCALE,
) -> DataFrame:
    """vec_id, cluster, distance (squared), cluster_inertia, inertia and centroid (its components) of every usable vector.

    Vectors that are NULL, have another number of components or a NULL or non-finite one take no
    part. Centroids 0, 1, ... start as the vectors with the smallest SHA-256 of ``1:<vec_id>``, ties by
    their components; vectors without an id come last in that order, but are assigned like others. With fewer
    vectors than clusters each is a centroid. Rows repeated whole count each. A distance or an
    inertia beyond 64 bits is NULL; what is decided by it is exact all the same. No vectors, no rows.
    """
    spark = frame.sparkSession
    scratch = Scratch(spark, "clusters")
    vectors = usable(frame, id_column, vector, components)
    centroids = _starts(vectors, clusters, scale)
    for _ in range(rounds if centroids else 0):
        tree = spark.sparkContext.broadcast(VantageTree(centroids))
        for k, row in _sums(vectors, tree, scale, components).items():
            centroids[k] = tuple(total // row[-1] for total in row[:-1])
        tree.unpersist()
    tree = spark.sparkContext.broadcast(VantageTree(centroids))

    def run(batches: Batches) -> Batches:
        for batch, matrix in _matrices(batches, scale, components):
            nearest, squares = tree.value.nearest(matrix)
            distance = pa.array([int(s) if s <= LONG else None for s in squares.tolist()], pa.int64())
            columns = [batch.column(0), pa.array(nearest.astype(np.int32)), distance]
            yield pa.RecordBatch.from_arrays(columns, ["vec_id", "cluster", "distance"])

    assigned = scratch.stage(map_batches(vectors, run, "vec_id long, cluster int, distance long"), "assigned")
    total = F.when(F.count("distance") == F.count("*"), F.sum(col("distance").cast("decimal(19,0)")))
    inertia = {r["cluster"]: r["total"] for r in assigned.groupBy("cluster").agg(total.alias("total")).collect()}
    within = lambda n: int(n) if n is not None and n <= LONG else None
    whole = None if None in inertia.values() else sum(inertia.values())
    # One row per cluster.
    described = [(k, within(n), within(whole), [str(x) for x in centroids[k]]) for k, n in inertia.items()]
    about = spark.createDataFrame(described, "cluster int, cluster_inertia long, inertia long, centroid array<string>")
    return assigned.join(F.broadcast(about), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid"
    )


def op12_vantage_clusters(spark: SparkSession, folder: str) -> DataFrame:
    """Cluster of every vector, with the digest of its centroid."""
    found = clustered(table(spark, folder, "embeddings").select("vec_id", "embedding"))
    digest = F.sha2(F.concat_ws(",", "centroid"), 256)
    return found.select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", digest.alias("centroid_sha256"))


def _oracle() -> str:
    parts = [
        f"""WITH kept AS MATERIALIZED (
    SELECT row_number() OVER (ORDER BY vec_id) AS r, vec_id, embedding
    FROM embeddings
    WHERE len(embedding) = {COMPONENTS} AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {COMPONENTS}
), parts AS MATERIALIZED (
    SELECT r, i, CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS BIGINT) AS x
    FROM (SELECT r, unnest(embedding) AS x, unnest(range({COMPONENTS})) AS i FROM kept)
), starts AS (
    SELECT r, row_number() OVER (ORDER BY sha256('1:' || vec_id)) - 1 AS k
    FROM kept QUALIFY k < {CLUSTERS}
), c0 AS MATERIALIZED (SELECT k, i, x FROM starts JOIN parts USING (r))"""
    ]
    for n in range(ROUNDS + 1):
        parts.append(
            f"""a{n} AS MATERIALIZED (
    SELECT r, k, d FROM (SELECT p.r, c.k, sum((p.x - c.x) * (p.x - c.x)) AS d FROM parts p JOIN c{n} c USING (i) GROUP BY p.r, c.k)
    QUALIFY row_number() OVER (PARTITION BY r ORDER BY d, k) = 1
)"""
        )
        if n < ROUNDS:
            parts.append(
                f"""m{n} AS (
    SELECT k, i, sum(x) AS s, count(*) AS n FROM a{n} JOIN parts USING (r) GROUP BY k, i
), c{n + 1} AS MATERIALIZED (
    SELECT c.k, c.i, coalesce((s - ((s % n) + n) % n) // n, c.x) AS x FROM c{n} c LEFT JOIN m{n} m USING (k, i)
)"""
            )
    last = ROUNDS
    parts.append(
        f"""digests AS (SELECT k, sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY i)) AS h FROM c{last} GROUP BY k)
SELECT vec_id, CAST(k AS INTEGER) AS cluster, CAST(d AS BIGINT) AS distance,
    CAST(sum(d) OVER (PARTITION BY k) AS BIGINT) AS cluster_inertia, CAST(sum(d) OVER () AS BIGINT) AS inertia,
    h AS centroid_sha256
FROM a{last} JOIN kept USING (r) JOIN digests USING (k)"""
    )
    return ", ".join(parts)


ORACLE = _oracle()

"""Exact top-k inner products by MaxScore.

A vector is a document whose terms are its dimensions. Rows are dealt into shards and queries
into blocks; each (shard, block) pair is one task of bounded size that keeps a posting list per
dimension with its least and largest weight. For a query, a dimension contributes at least its
lower bound; what it adds above that is an impact between 0 and a known bound. Dimensions whose bounds
cannot lift a row over the current k-th score together are non-essential: only the
other lists are traversed, and the rest are probed while a row can still compete. The tasks' lists
are merged by query.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from civiclens.llm.common import Scratch, parts_for, table

col = F.col

SHARD_ROWS = 8192
BLOCK_QUERIES = 1024
STEP = 8
"""Lists probed at a time before rows are pruned."""

RESULT = "query_id long, vec_id long, score long"


def quantised(frame: DataFrame, id_column: str = "vec_id", vector: str = "embedding", scale: int = 256) -> DataFrame:
    """vec_id and whole-number weights; rows without an id or with an unusable component are left out."""
    usable = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    return (
        frame.where(col(id_column).isNotNull() & col(vector).isNotNull() & F.forall(vector, usable))
        .select(
            col(id_column).alias("vec_id"),
            F.transform(vector, lambda x: F.floor(x.cast("double") * scale)).alias("weights"),
        )
        .distinct()
    )


def _matrix(rows: pd.Series, width: int) -> np.ndarray:
    out = np.zeros((len(rows), width), dtype=np.int64)
    for i, row in enumerate(rows):
        out[i, : len(row)] = row
    return out


def best_rows(postings: np.ndarray, ids: np.ndarray, query: np.ndarray, own: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids and scores of the k best rows for a query; ``postings`` has one row per dimension."""
    least, most = postings.min(axis=1), postings.max(axis=1)
    low = np.minimum(query * least, query * most)
    bound = np.maximum(query * least, query * most) - low
    order = np.argsort(-bound, kind="stable")
    order = order[bound[order] > 0]
    base = int(low.sum())
    rest = bound[order].sum() - np.concatenate([[0], np.cumsum(bound[order])])
    allowed = ids != own

    def keep_best(scores: np.ndarray, rows: np.ndarray) -> np.ndarray:
        return np.lexsort((ids[rows], -scores))[:k]

    # A first threshold: score the rows with the largest impact in the leading lists.
    threshold = None
    if len(order) and allowed.sum() > 4 * k:
        lead = order[:STEP]
        sketch = (query[lead] @ postings[lead]).astype(np.float64)
        sketch[~allowed] = -np.inf
        probe = np.argpartition(-sketch, 4 * k)[: 4 * k]
        threshold = int(np.sort(query @ postings[:, probe])[-k])

    # Rows without an impact in the essential lists stay below the threshold.
    essential = len(order)
    if threshold is not None and base + rest[-1] < threshold:
        essential = int(np.argmax(base + rest < threshold))
    lists = order[:essential]
    partial = base + query[lists] @ postings[lists] - low[lists].sum()
    rows = np.flatnonzero(allowed)
    partial, done = partial[rows], essential
    while threshold is not None:
        competitive = partial + rest[done] >= threshold
        rows, partial = rows[competitive], partial[competitive]
        if done == len(order):
            break
        dims = order[done : done + STEP]
        partial = partial + query[dims] @ postings[np.ix_(dims, rows)] - low[dims].sum()
        done += len(dims)
    best = keep_best(partial, rows)
    return ids[rows[best]], partial[best]


def _search(k: int):
    def search(_key: tuple, rows: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        if not len(rows) or not len(queries):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []}, dtype="int64")
        width = max(1, rows["weights"].map(len).max(), queries["weights"].map(len).max())
        postings = np.ascontiguousarray(_matrix(rows["weights"], width).T)
        asked, ids = _matrix(queries["weights"], width), rows["vec_id"].to_numpy()
        # Doubles are exact below 2**53 and use the fast matrix product.
        if float(np.abs(postings).max()) * float(np.abs(asked).max()) * width < 2.0**50:
            postings, asked = postings.astype(np.float64), asked.astype(np.float64)
        found = []
        for own, query in zip(queries["vec_id"].to_numpy(), asked):
            hits, scores = best_rows(postings, ids, query, own, k)
            found.append(pd.DataFrame({"query_id": own, "vec_id": hits, "score": scores.astype(np.int64)}))
        return pd.concat(found)

    return search


def top_k(rows: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """Each query's k highest inner products among all other rows, ties to the smaller id.

    Both frames are as ``quantised`` gives them. A shorter vector has weight 0 in the missing
    dimensions. Rows under the query's own id are no candidates. Empty frames give no rows.
    """
    scratch = Scratch(rows.sparkSession, "topk")
    rows, queries = scratch.stage(rows, "rows"), scratch.stage(queries, "queries")
    shards = parts_for(rows.count(), SHARD_ROWS, 24, 1 << 20)
    blocks = parts_for(queries.count(), BLOCK_QUERIES, 1, 1 << 20)
    deal = lambda parts: F.pmod(F.xxhash64("vec_id"), F.lit(parts))
    every = lambda parts: F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))
    pair = ["shard", "block"]
    sharded = rows.withColumn("shard", deal(shards).cast("int")).withColumn("block", every(blocks))
    asked = queries.withColumn("block", deal(blocks).cast("int")).withColumn("shard", every(shards))
    found = sharded.groupBy(*pair).cogroup(asked.groupBy(*pair)).applyInPandas(_search(k), RESULT)
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(best)).where(col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def op8_maxscore_top5(spark: SparkSession, folder: str) -> DataFrame:
    """The five best other rows for every row whose id is divisible by 50."""
    rows = quantised(table(spark, folder, "embeddings"))
    return top_k(rows, rows.where(col("vec_id") % 50 == 0), 5)


ORACLE = """
WITH v AS (
  SELECT DISTINCT vec_id, [floor(x::DOUBLE * 256) FOR x IN embedding] AS w
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
), s AS (
  SELECT q.vec_id AS query_id, r.vec_id, list_dot_product(q.w, r.w)::BIGINT AS score
  FROM v q JOIN v r ON q.vec_id <> r.vec_id WHERE q.vec_id % 50 = 0
), k AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM s
)
SELECT query_id, rank, vec_id, score FROM k WHERE rank <= 5
"""

"""Uniform shuffle of documents into shards of exact size.

Rows fall into blocks by a hash. For each block the number of its rows that go to each shard is
drawn without replacement from what the shards still have room for (a multivariate hypergeometric
draw), which gives the matrix of block-to-shard counts that a uniform permutation would have. Rows are
permuted within their block, dealt out by the matrix, and permuted again within their shard.
Every step but the draw of the matrix (a bounded table of counts) is DataFrame code.
"""

from __future__ import annotations

import json

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from civiclens.llm.common import Scratch, parts_for, table, utf8

col = F.col

SHARDS = 24
BLOCK_ROWS = 200_000
MOST_BLOCKS = 4096
"""Blocks grow beyond this many, so the matrix stays a table of at most 4096 rows."""


def draw_count(rng: np.random.Generator, marked: int, others: int, drawn: int) -> int:
    """How many of ``drawn`` rows out of ``marked + others`` are marked: a hypergeometric draw.

    Weights are built outwards from the mode by their exact ratios, so populations of any size
    work; terms further than 12 standard deviations out weigh nothing in a double.
    """
    total = marked + others
    low, high = max(0, drawn - others), min(drawn, marked)
    if low == high:
        return low
    mode = min(high, max(low, (drawn + 1) * (marked + 1) // (total + 2)))
    share = marked / total
    spread = (drawn * share * (1 - share) * (total - drawn) / max(1, total - 1)) ** 0.5
    reach = int(12 * spread) + 30
    up = np.arange(mode, min(high, mode + reach), dtype=float)
    down = np.arange(mode, max(low, mode - reach), -1, dtype=float)
    rise = np.log((marked - up) * (drawn - up)) - np.log((up + 1) * (others - drawn + up + 1))
    fall = np.log(down * (others - drawn + down)) - np.log((marked - down + 1) * (drawn - down + 1))
    logs = np.concatenate([np.cumsum(fall)[::-1], [0.0], np.cumsum(rise)])
    weights = np.cumsum(np.exp(logs))
    return mode - len(down) + int(np.searchsorted(weights, rng.random() * weights[-1], side="right"))


def communication_matrix(block_rows: list[int], shard_rows: list[int], seed: int) -> list[list[int]]:
    """Rows of each block that go to each shard; sums to ``block_rows`` and ``shard_rows``."""
    rng = np.random.default_rng(seed)
    room = list(shard_rows)
    matrix = []
    for rows in block_rows:
        counts, left, rest = [], rows, sum(room)
        for j, free in enumerate(room):
            rest -= free
            take = draw_count(rng, free, rest, left)
            counts.append(take)
            left -= take
            room[j] -= take
        matrix.append(counts)
    return matrix


def _key(seed: int):
    return F.xxhash64(F.lit(seed), "doc_id", "size", "text_crc32")


def shard_documents(
    frame: DataFrame, id_column: str = "doc_id", text: str = "text", shards: int = SHARDS, seed: int = 7
) -> DataFrame:
    """Deal all rows to shards whose row counts differ by at most one.

    Returns doc_id, size, text_crc32, law, shard, slot and grown_shard (NULL: the law is `rows`).
    A NULL text has no bytes and CRC 0. Rows that agree in id, size and CRC are interchangeable, so
    their order cannot change the result; equal texts under other ids move independently. An
    empty table gives an empty result.
    """
    spark = frame.sparkSession
    scratch = Scratch(spark, "shards")
    body = utf8(text)
    measured = frame.select(
        col(id_column).alias("doc_id"),
        (F.length(body) + F.lit(8)).cast("long").alias("size"),
        F.crc32(body).alias("text_crc32"),
    )
    measured = scratch.stage(measured, "measured")
    total = measured.count()
    blocks = parts_for(total, BLOCK_ROWS, 64, MOST_BLOCKS)

    blocked = measured.withColumn("key", _key(seed)).withColumn("block", F.pmod("key", F.lit(blocks)).cast("int"))
    counted = {r["block"]: r["count"] for r in blocked.groupBy("block").count().collect()}
    quota = [total // shards + (j < total % shards) for j in range(shards)]
    matrix = communication_matrix([counted.get(b, 0) for b in range(blocks)], quota, seed)
    bounds = [{"block": b, "ends": np.cumsum(row).tolist()} for b, row in enumerate(matrix)]
    ends = spark.range(1).select(
        F.inline(F.from_json(F.lit(json.dumps(bounds)), "array<struct<block: int, ends: array<bigint>>>"))
    )

    # Permute within the block by a second hash, then deal out by the matrix.
    identity = ["doc_id", "size", "text_crc32"]
    local = Window.partitionBy("block").orderBy(_key(seed + 1), *identity)
    place = F.row_number().over(local) - 1
    dealt = (
        blocked.withColumn("place", place)
        .join(F.broadcast(ends), "block")
        .withColumn("shard", F.size(F.filter("ends", lambda end: end <= col("place"))))
        .select(*identity, "shard")
    )
    dealt = scratch.stage(dealt, "dealt")

    # Permute within the shard: order by a third hash, whose leading bits split a shard into parts.
    bits = max(3, (parts_for(total // shards, BLOCK_ROWS, 1, MOST_BLOCKS) - 1).bit_length())
    keyed = dealt.withColumn("key", _key(seed + 2)).withColumn("part", F.shiftright("key", 64 - bits))
    sizes = keyed.groupBy("shard", "part").count()
    before = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("shard", "part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("offset"))
    within = Window.partitionBy("shard", "part").orderBy("key", *identity)
    return (
        keyed.withColumn("place", F.row_number().over(within) - 1)
        .join(F.broadcast(offsets), ["shard", "part"])
        .select(
            *identity,
            F.lit("rows").alias("law"),
            col("shard").cast("int").alias("shard"),
            (col("offset") + col("place")).cast("long").alias("slot"),
            F.lit(None).cast("int").alias("grown_shard"),
        )
    )


def op5_hypergeometric_shards(spark: SparkSession, folder: str) -> DataFrame:
    """All documents in shards 0 to 23, counts at most one apart."""
    return shard_documents(table(spark, folder, "documents"))

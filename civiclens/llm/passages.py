"""Removal of passages that start earlier in the corpus, by suffix arrays.

Every byte covered by a 100-byte string that also starts earlier is removed; see ``repeats`` for how equal
strings meet and are sorted.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from civiclens.llm.common import Batches, Scratch, map_batches, table, utf8
from civiclens.llm.repeats import merged, repeats

col = F.col

LENGTH = 100
GRAM = 20


def without_repeats(
    frame: DataFrame, id_column: str = "doc_id", text: str = "text", length: int = LENGTH, gram: int = GRAM
) -> DataFrame:
    """doc_id, n_bytes, spans (maximal removed runs of bytes) and kept (the bytes left) of every row.

    Texts are UTF-8 bytes, NULL is empty; strings do not cross texts and are judged on the input.
    Earlier means a smaller id, or the same text and an earlier start. A row without an id takes no
    part and is kept whole; rows repeated whole are one text and lose the same, and two texts under one id are two, in the
    order of their hashes.
    """
    scratch = Scratch(frame.sparkSession, "passages")
    named = frame.select(col(id_column).cast("long").alias("doc_id"), utf8(text).alias("body"))
    named = named.withColumn("tag", F.xxhash64("body"))
    bodies = named.where("doc_id IS NOT NULL").select(col("doc_id").alias("doc"), "tag", F.lit(0).cast("long").alias("salt"), "body")
    found = repeats(bodies, length, gram, False, scratch)
    by_row = found.groupBy(col("doc").alias("doc_id"), "tag").agg(F.collect_list(F.struct("start", "end")).alias("found"))
    joined = named.join(by_row, ["doc_id", "tag"], "left").select("doc_id", "body", "found")

    def run(batches: Batches) -> Batches:
        for batch in batches:
            sizes, spans, kept = [], [], []
            for body, found in zip(batch.column(1), batch.column(2)):
                body = body.as_py()
                runs = merged([(s["start"], s["end"]) for s in found.as_py() or ()])
                edges = [0, *(edge for run in runs for edge in run), len(body)]
                sizes.append(len(body))
                spans.append([{"start": a, "end": b} for a, b in runs])
                kept.append(b"".join(body[a:b] for a, b in zip(edges[::2], edges[1::2])))
            kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(spans, kind), pa.array(kept, pa.binary())],
                ["doc_id", "n_bytes", "spans", "kept"],
            )

    schema = "doc_id long, n_bytes long, spans array<struct<start: int, end: int>>, kept binary"
    return map_batches(joined, run, schema)


def op6_suffix_passages(spark: SparkSession, folder: str) -> DataFrame:
    """What every document loses, and the digest of what it keeps."""
    return without_repeats(table(spark, folder, "documents")).select(
        "doc_id",
        "n_bytes",
        (col("n_bytes") - F.length("kept")).alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )

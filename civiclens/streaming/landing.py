"""Resumable ingestion as a file-source stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from civiclens.schema import RAW_SCHEMA
from civiclens.sources.files import LINE, late_columns, parse_landing, records
from civiclens.sources.folders import CODEC, drop_folder, release_after
from civiclens.sources.ingest import MONTH_COLUMN, with_month

BATCH = "batch_id"
BATCH_BYTES = 256 << 20
"""Bytes of landed files that a micro-batch takes."""


def ingest_stream(
    spark: SparkSession,
    landing: str,
    target: str,
    checkpoint: str,
    schema: StructType = RAW_SCHEMA,
) -> None:
    """Append all landed files not seen before, then stop.

    Every micro-batch is written to a folder of its own below ``target``, which a repeated batch
    replaces, so a run that is repeated or was interrupted adds each record once. A batch takes so many files as ``BATCH_BYTES`` allows; its
    lines are parsed once into a scratch table, ``target``-scratch, which goes with the batch. Fields that ``schema``
    does not name become text columns of the batch that has them; read the target with ``mergeSchema``.
    Lines that are no such record go to ``target``-rejects.
    """

    def write(lines: DataFrame, batch: int) -> None:
        scratch = f"{target}-scratch/{BATCH}={batch}"
        parsed = parse_landing(lines, schema)
        parsed.write.mode("overwrite").option("compression", CODEC).parquet(scratch)
        parsed = spark.read.schema(parsed.schema).parquet(scratch)
        good = records(parsed, late_columns(parsed))
        good.write.mode("overwrite").option("compression", CODEC).partitionBy(MONTH_COLUMN).parquet(f"{target}/{BATCH}={batch}")
        rejected = parsed.where("line IS NOT NULL").select("line", MONTH_COLUMN)
        rejected.write.mode("overwrite").parquet(f"{target}-rejects/{BATCH}={batch}")
        release_after(parsed)
        drop_folder(spark, scratch)

    landed = spark.readStream.schema(with_month(LINE)).option("maxBytesPerTrigger", str(BATCH_BYTES)).text(landing)
    query = (
        landed.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()

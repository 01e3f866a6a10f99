"""How many requests survive each rule on the way to a cleaned fact."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from civiclens.functions.text import clean, try_double

col = F.col

STAGES = (
    "raw",
    "deduplicated",
    "closed",
    "non_legacy",
    "parent_merged",
    "located",
)
CLOSED_STATUSES = ("Completed", "Closed")


def reduction_funnel(raw: DataFrame, requests: DataFrame) -> DataFrame:
    """Rows left after each stage, in stage order.

    Deduplicated: one row per number and not flagged duplicate. Parent-merged: children
    fold into their parent's request. Located: some member of the merged request has an
    address and coordinates. The four later counts come from one grouping by merged request.
    """
    flagged = requests.select(
        F.coalesce(clean("parent_sr_number"), col("sr_number")).alias("merged_number"),
        (~F.coalesce("duplicate", F.lit(False))).alias("kept"),
        F.coalesce(col("status").isin(*CLOSED_STATUSES), F.lit(False)).alias("closed"),
        (~F.coalesce("legacy_record", F.lit(False))).alias("current"),
        (
            clean("street_address").isNotNull()
            & try_double("latitude").isNotNull()
            & try_double("longitude").isNotNull()
        ).alias("placed"),
    )
    kept = col("kept")
    closed = kept & col("closed")
    current = closed & col("current")
    merged = flagged.groupBy("merged_number").agg(
        F.count_if(kept).alias("deduplicated"),
        F.count_if(closed).alias("closed"),
        F.count_if(current).alias("non_legacy"),
        F.coalesce(F.max(F.when(current, 1)), F.lit(0)).alias("parent_merged"),
        F.coalesce(F.max(F.when(current & col("placed"), 1)), F.lit(0)).alias("located"),
    )
    later = STAGES[1:]
    counts = merged.agg(*[F.coalesce(F.sum(s), F.lit(0)).cast("bigint").alias(s) for s in later])
    first = raw.agg(F.count("*").alias("n_rows")).select(F.lit(STAGES[0]).alias("stage"), "n_rows")
    rows = first.unionByName(counts.unpivot([], list(later), "stage", "n_rows"))
    step = F.array_position(F.array(*[F.lit(s) for s in STAGES]), col("stage"))
    return rows.select(step.cast("int").alias("step"), "stage", "n_rows").orderBy("step")

"""Rarest hashes first: the prefixes of which sets that overlap enough share at least one element.

Of two sets that must share m elements, the first ``size - m + 1`` elements in any common order share one.
The order is by how often an element's bucket occurs in all sets, so elements that many sets hold come last.
"""

from __future__ import annotations

import numpy as np
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BUCKETS = 1 << 18


def frequencies(frame: DataFrame, hashes: str = "hashes") -> Broadcast:
    """How often each bucket of hashes occurs; 2 MB whatever the input."""
    bucket = F.explode(F.transform(hashes, lambda h: F.pmod(h, F.lit(BUCKETS)).cast("int")))
    found = frame.select(bucket.alias("bucket")).groupBy("bucket").agg(F.count("*").alias("n")).toArrow()
    counts = np.zeros(BUCKETS, dtype=np.int64)
    counts[found.column("bucket").to_numpy()] = found.column("n").to_numpy()
    return frame.sparkSession.sparkContext.broadcast(counts)


def rarest(hashes: np.ndarray, counts: np.ndarray, n: int) -> np.ndarray:
    """The first ``n`` of the (signed, distinct) hashes by the count of their bucket and their value."""
    return hashes[np.lexsort((hashes, counts[hashes % BUCKETS]))[:n]]

"""Quality scores learned from preference pairs (Bradley-Terry).

A document's strength is linear in features of its text. That a good document is preferred to a poor one has
the probability sigmoid(strength difference), so the weights come from a logistic regression without
intercept on feature differences. A document is accepted if its strength reaches the quantile of all
labelled training strengths at which the poor documents' share ends.

All labelled rows outside the held-out fold take part: every poor and every good one is in pairs, and the classes' shares
and the quantile are taken over all of them. The model is a row of weights, so documents are scored where they lie, without a
shuffle of texts.
"""

from __future__ import annotations

import operator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from civiclens.llm.common import Batches, Scratch, map_batches, parts_for, table, utf8

col = F.col

PARTNERS = 4
"""Rows of the other class drawn for each labelled row; so every row is in that many pairs at least."""
MOST_BUCKETS = 4_096
"""Most buckets that a class is numbered in."""
FOLDS = 5
ACCEPT = 0.3
MARGIN = 0.005
"""The threshold is the middle of the strengths this far to either side of the quantile."""

WINDOW_BYTES = 512
WINDOW_WORDS = 64

UPPER, DIGIT, STOP, SYMBOL = 1, 2, 3, 4
FEATURES = (
    "upper",
    "digits",
    "stops",
    "symbols",
    "upper_most",
    "digits_most",
    "stops_most",
    "symbols_most",
    "symbols_per_word",
    "repeats",
    "repeats_most",
    "variety",
    "variety_least",
    "word_bytes",
    "words",
)


def _kinds() -> np.ndarray:
    """Kind of each byte; bytes of letters beyond ASCII count as small letters."""
    kinds = np.zeros(256, dtype=np.int8)
    for byte in range(33, 127):
        sign = chr(byte)
        if sign.isupper():
            kinds[byte] = UPPER
        elif sign.isdigit():
            kinds[byte] = DIGIT
        elif sign in ".,":
            kinds[byte] = STOP
        elif not sign.isalpha():
            kinds[byte] = SYMBOL
    return kinds


KINDS = _kinds()


def features(text: bytes) -> list[float]:
    """Shares of character kinds and of repeated words, over the whole text and in its worst window.

    A text without words has all features 0.
    """
    words = text.split()
    if not words:
        return [0.0] * len(FEATURES)
    kinds = KINDS[np.frombuffer(text, dtype=np.uint8)]
    starts = np.arange(0, len(kinds), WINDOW_BYTES)
    sizes = np.minimum(WINDOW_BYTES, len(kinds) - starts).clip(64)
    whole, worst = [], []
    for kind in (UPPER, DIGIT, STOP, SYMBOL):
        counts = np.add.reduceat((kinds == kind).astype(np.int64), starts)
        whole.append(counts.sum() / len(kinds))
        worst.append((counts / sizes).max())
    n = len(words)
    same = np.fromiter(map(operator.eq, words, words[1:]), dtype=np.int64, count=n - 1)
    runs = [
        same[i : i + WINDOW_WORDS].sum() / max(16, len(same[i : i + WINDOW_WORDS])) for i in range(0, n - 1, WINDOW_WORDS)
    ]
    fresh = [
        len(set(part)) / len(part)
        for part in (words[i : i + WINDOW_WORDS] for i in range(0, n, WINDOW_WORDS))
        if len(part) >= 16 or n < 16
    ]
    values = [*whole, *worst, whole[3] * len(kinds) / n, same.mean() if n > 1 else 0.0, max(runs, default=0.0)]
    return [
        *(float(np.log1p(50 * v)) for v in values),
        float(np.log1p(len(set(words))) / np.log1p(n)),
        float(min(fresh, default=1.0)),
        float(np.log1p(len(text) / n)),
        float(np.log1p(n)) / 10,
    ]


def with_features(frame: DataFrame, text: str = "text") -> DataFrame:
    """All columns and ``_features``; a NULL text is empty. A column of that name is replaced."""
    kept = [c for c in frame.columns if c != "_features"]
    picked = frame.select(*kept, utf8(text).alias("_body"))
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in picked.schema.fields[:-1]]

    def run(batches: Batches) -> Batches:
        for batch in batches:
            found = [features(v.as_py()) for v in batch.column(batch.num_columns - 1)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(found, pa.list_(pa.float64()))], [*batch.schema.names[:-1], "_features"]
            )

    return map_batches(picked, run, ", ".join([*fields, "_features array<double>"]))


def fold(id_column: str = "doc_id") -> Column:
    """Remainder that marks the held-out rows (0); a NULL id is held out."""
    return F.coalesce(F.crc32(col(id_column).cast("string").cast("binary")), F.lit(0)) % FOLDS


@dataclass(frozen=True)
class Ranking:
    """Weights of the features, the strength accepted from, and the unit of strength for scores."""

    weights: tuple[float, ...]
    threshold: float
    unit: float

    def strength(self) -> Column:
        return sum((F.get("_features", F.lit(i)) * w for i, w in enumerate(self.weights)), F.lit(0.0))

    def score(self) -> Column:
        """From 0 to 1; exactly ``ACCEPT`` at the threshold."""
        odds = F.lit(float(np.log(ACCEPT / (1 - ACCEPT))))
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-((self.strength() - self.threshold) / self.unit + odds)))


INDIFFERENT = Ranking((0.0,) * len(FEATURES), 0.0, 1.0)
"""Without a single pair all documents are accepted."""


def _drawn(rows: DataFrame, others: DataFrame, seed: int) -> DataFrame:
    """nth, own, other: for each row ``PARTNERS`` of the others, by hash.

    The others are numbered without gaps, in buckets: only the buckets' sizes come to the driver, and every draw finds a row.
    """
    spark, n = rows.sparkSession, others.count()
    buckets = parts_for(n, 1_000, 1, MOST_BUCKETS)
    dealt = others.withColumn("bucket", F.pmod(F.xxhash64(F.lit(seed), "doc_id", "_features"), F.lit(buckets)))
    offsets, before = [], 0
    for bucket, size in sorted(map(tuple, dealt.groupBy("bucket").count().collect())):
        offsets.append((bucket, before))
        before += size
    offsets = F.broadcast(spark.createDataFrame(offsets, "bucket long, before long"))
    place = F.row_number().over(Window.partitionBy("bucket").orderBy("doc_id", "_features")) - 1
    numbered = dealt.withColumn("place", place).join(offsets, "bucket")
    numbered = numbered.select((col("before") + col("place")).alias("number"), col("_features").alias("other"))
    draws = rows.withColumn("nth", F.explode(F.sequence(F.lit(1), F.lit(PARTNERS))))
    drawn = F.pmod(F.xxhash64(F.lit(seed + 1), "doc_id", "_features", "nth"), F.lit(n))
    return draws.select(drawn.alias("number"), "nth", col("_features").alias("own")).join(numbered, "number").drop("number")


def fit_ranking(featured: DataFrame, labels: DataFrame, scratch: Scratch) -> Ranking:
    """Learn from rows outside the held-out fold.

    ``featured`` has doc_id and _features, ``labels`` doc_id and quality. Labels other than 0 and 1, NULLs and ids
    with both labels are left out. The held-out rows' labels are not read.
    """
    judged = (
        labels.where(fold() != 0)
        .where("doc_id IS NOT NULL AND quality IN (0, 1)")
        .groupBy("doc_id")
        .agg(F.min("quality").alias("quality"), F.max("quality").alias("other"))
        .where("quality = other")
        .drop("other")
    )
    known = scratch.stage(featured.join(judged, "doc_id").select("doc_id", "quality", "_features"), "labelled")
    counts = {r["quality"]: r["count"] for r in known.groupBy("quality").count().collect()}
    if len(counts) < 2:
        return INDIFFERENT
    good, poor = (known.where(col("quality") == label).select("doc_id", "_features") for label in (1, 0))
    by_good = _drawn(good, poor, 11).select("nth", col("own").alias("better"), col("other").alias("worse"))
    by_poor = _drawn(poor, good, 21).select("nth", col("other").alias("better"), col("own").alias("worse"))
    # Pairs go in either direction, so that both classes of the regression are there.
    lead = F.zip_with("better", "worse", lambda a, b: a - b)
    pairs = by_good.union(by_poor).select(F.when(col("nth") % 2 == 0, 1.0).otherwise(0.0).alias("label"), lead.alias("lead"))
    pairs = pairs.select(
        "label",
        array_to_vector(F.transform("lead", lambda x: F.when(col("label") == 1.0, x).otherwise(-x))).alias("features"),
    )
    pairs = scratch.stage(pairs, "pairs")
    if pairs.select("label").distinct().count() < 2:
        return INDIFFERENT
    fitted = LogisticRegression(fitIntercept=False, regParam=1e-3, maxIter=100).fit(pairs)
    ranking = Ranking(tuple(float(w) for w in fitted.coefficients), 0.0, 1.0)

    poor_share = counts[0] / (counts[0] + counts[1])
    points = [max(0.0, poor_share - MARGIN), min(1.0, poor_share + MARGIN), 0.02, 0.98]
    below, above, low, high = known.select(ranking.strength().alias("s")).agg(F.percentile_approx("s", points, 10_000)).first()[0]
    return Ranking(ranking.weights, (below + above) / 2, max(1e-9, (high - low) / 12))


def op9_pairwise_quality(spark: SparkSession, folder: str) -> DataFrame:
    """Score of every document; learned without the held-out fold."""
    scratch = Scratch(spark, "quality")
    featured = with_features(table(spark, folder, "documents").select("doc_id", "text")).select("doc_id", "_features")
    featured = scratch.stage(featured, "features")
    ranking = fit_ranking(featured, table(spark, folder, "labels"), scratch)
    scored = featured.withColumn("score", ranking.score())
    return scored.select(
        "doc_id",
        (fold() == 0).alias("held_out"),
        "score",
        F.when(col("score") >= ACCEPT, 1).otherwise(0).cast("int").alias("predicted"),
    )


def accepted(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents whose score reaches the threshold, with their columns; empty texts are judged alike."""
    scratch = Scratch(documents.sparkSession, "quality")
    featured = scratch.stage(with_features(documents.select("doc_id", "text")).select("doc_id", "_features"), "features")
    ranking = fit_ranking(featured, labels, scratch)
    # Only the text goes to Python. The columns travel in one of their own, so none has a name that a helper has.
    measured = F.pandas_udf(_measured, "array<double>").asNondeterministic()(utf8("text"))
    packed = documents.select(F.struct(*[documents[f"`{c}`"] for c in documents.columns]).alias("row"), measured.alias("_features"))
    return packed.where(ranking.score() >= ACCEPT).select("row.*")


def _measured(bodies: pd.Series) -> pd.Series:
    return bodies.map(features)

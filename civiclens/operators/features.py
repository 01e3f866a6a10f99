"""Features, time split and model benchmarks on request closure."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.evaluation import (
    BinaryClassificationEvaluator,
    MulticlassClassificationEvaluator,
    RegressionEvaluator,
)
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.regression import GBTRegressor, LinearRegression
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from civiclens.functions.text import seconds_between

col = F.col

# Labels of the rule ladders: their number is fixed by the rules, not by the data.
CATEGORIES = ("service_category", "priority_level", "department_type")
NUMBERS = (
    "created_hour",
    "day_of_week",
    "month",
    "is_weekend",
    "is_business_day",
    "is_emergency",
    "is_located",
    "is_child",
)


def frequency_codes(counts: DataFrame, column: str) -> DataFrame:
    """(label, code) from rows of (labels…, n): labels numbered from 0, the most frequent
    first. For columns with few distinct labels: the numbering runs over them in one task."""
    totals = counts.groupBy(column).agg(F.sum("n").alias("_n"))
    order = Window.orderBy(F.desc("_n"), col(column).asc_nulls_last())
    return totals.select(column, (F.row_number().over(order) - 1).alias(f"{column}_code"))


def feature_table(
    star: DataFrame, dim_service: DataFrame, dim_department: DataFrame, dim_time: DataFrame
) -> DataFrame:
    """One row per request: hours to close, closure label, calendar, flags and categories.

    Labels come from the dimensions by id, so the keyword rules are not run again per row.
    Their frequencies come from counts per id pair. The code tables are broadcast: the rule
    ladders fix their number of rows.
    """
    services = dim_service.select("service_id", "service_category", "priority_level", "is_emergency")
    departments = dim_department.select("department_id", "department_type")
    days = dim_time.select(
        col("date_id").alias("created_date_id"), "day_of_week", "month", "is_weekend", "is_business_day"
    )

    def with_labels(frame: DataFrame) -> DataFrame:
        joined = frame.join(services, "service_id", "left").join(departments, "department_id", "left")
        return joined.withColumns({c: F.coalesce(c, F.lit("Unknown")) for c in CATEGORIES})

    def flag(condition: Column) -> Column:
        return F.coalesce(condition.cast("int"), F.lit(0))

    table = with_labels(star).join(days, "created_date_id", "left").select(
        "sr_number",
        col("created_date_id").alias("created_day"),
        (seconds_between(col("created_ts"), col("closed_ts")) / F.lit(3600.0)).alias("hours_to_close"),
        col("closed_ts").isNotNull().cast("int").alias("is_closed"),
        F.hour("created_ts").alias("created_hour"),
        "day_of_week",
        "month",
        flag(col("is_weekend")).alias("is_weekend"),
        flag(col("is_business_day")).alias("is_business_day"),
        flag(col("is_emergency")).alias("is_emergency"),
        col("location_id").isNotNull().cast("int").alias("is_located"),
        col("parent_sr_number").isNotNull().cast("int").alias("is_child"),
        *CATEGORIES,
    )
    labels = with_labels(star.groupBy("service_id", "department_id").agg(F.count("*").alias("n")))
    for category in CATEGORIES:
        table = table.join(F.broadcast(frequency_codes(labels, category)), category, "left")
    return table


def time_split(features: DataFrame, train_until: str) -> DataFrame:
    """Adds ``split``: 'train' up to and including the given day, 'test' after it; undated rows are in neither."""
    last = F.lit(train_until).cast("date")
    return features.withColumn(
        "split", F.when(col("created_day") <= last, "train").when(col("created_day") > last, "test")
    )


def _vectorizer() -> Pipeline:
    indexed = [f"{c}_index" for c in CATEGORIES]
    encoded = [f"{c}_vector" for c in CATEGORIES]
    return Pipeline(
        stages=[
            StringIndexer(inputCols=list(CATEGORIES), outputCols=indexed, handleInvalid="keep"),
            OneHotEncoder(inputCols=indexed, outputCols=encoded),
            VectorAssembler(inputCols=[*NUMBERS, *encoded], outputCol="features"),
        ]
    )


def _compare(split: DataFrame, label: str, models: dict, evaluators: dict) -> DataFrame:
    """Fit each model on the train part and score it on the test part."""
    complete = split.fillna(-1, subset=list(NUMBERS))
    train, test = (complete.where(col("split") == part) for part in ("train", "test"))
    vectorizer = _vectorizer().fit(train)
    # The vectors are made once for all models, the predictions once for all metrics.
    train, test = (vectorizer.transform(part).select(label, "features").persist() for part in (train, test))
    scores = []
    for model_name, model in models.items():
        predicted = model.fit(train).transform(test).drop("features").persist()
        for metric, evaluator in evaluators.items():
            scores.append((model_name, metric, float(evaluator.evaluate(predicted))))
        predicted.unpersist()
    train.unpersist()
    test.unpersist()
    return split.sparkSession.createDataFrame(scores, "model string, metric string, value double")


def model_benchmark(split: DataFrame) -> DataFrame:
    """Logistic regression and random forest on the closure label; metrics on the test part."""
    label = "is_closed"
    return _compare(
        split,
        label,
        {
            "logistic_regression": LogisticRegression(labelCol=label, maxIter=20),
            "random_forest": RandomForestClassifier(labelCol=label, numTrees=20, maxDepth=5, seed=42),
        },
        {
            "auc": BinaryClassificationEvaluator(labelCol=label),
            "accuracy": MulticlassClassificationEvaluator(labelCol=label, metricName="accuracy"),
            "f1": MulticlassClassificationEvaluator(labelCol=label, metricName="f1"),
        },
    )


def closure_regression(split: DataFrame) -> DataFrame:
    """Linear and boosted-tree regression of the hours to close, on closed requests."""
    label = "hours_to_close"
    return _compare(
        split.where(col(label).isNotNull()),
        label,
        {
            "linear_regression": LinearRegression(labelCol=label, maxIter=20),
            "boosted_trees": GBTRegressor(labelCol=label, maxIter=5, maxDepth=4, seed=42),
        },
        {m: RegressionEvaluator(labelCol=label, metricName=m) for m in ("rmse", "mae", "r2")},
    )

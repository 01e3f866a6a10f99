"""Corpus preparation: the stages that turn raw documents into token sequences."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from civiclens.llm import stages
from civiclens.session import shared_folder

STAGES = [
    ("quality", stages.quality),
    ("lines", stages.lines),
    ("near_duplicates", stages.near_duplicates),
    ("decontamination", stages.decontamination),
    ("tokens", stages.tokens),
]

ORACLE_SQL = None
"""The learned scores and the hashes of the stages have no SQL form."""


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``; each result is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    root = f"{shared_folder(spark)}/corpus-{uuid.uuid4().hex[:12]}"
    for name, stage in STAGES:
        path = f"{root}/{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs

"""The corpus pipeline's stages: each takes the documents its predecessor kept.

All but the last return the columns of ``documents``. Rows without an id pass every filter that
goes by id, since nothing can name them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from civiclens.llm import bpe, decontam, simhash
from civiclens.llm import lines as line_dedup
from civiclens.llm import quality as ranking
from civiclens.llm.common import table, utf8


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose quality score reaches the threshold."""
    return ranking.accepted(docs, table(spark, sf_dir, "labels"))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines that repeat an earlier one up to one word."""
    return line_dedup.deduplicated(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that with the smallest id, of every near-duplicate class."""
    return simhash.representatives(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no benchmark item leaks into."""
    return decontam.clean(docs, table(spark, sf_dir, "benchmark"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, n_tokens and token_ids (packed) of every document.

    The ids are decoded again; a document that they do not give back ends the job. A text that is no
    UTF-8 cannot come back and is not compared.
    """
    kept = ("doc_id", "lang", "source")
    coded = bpe.encode(docs.select(*kept, "text"), keep=(*kept, "text"), round_trip=True)
    same = (F.col("decoded") == utf8("text")) | ~F.is_valid_utf8(F.coalesce("text", F.lit("")))
    wrong = F.raise_error(F.concat(F.lit("tokens do not give back document "), F.col("doc_id").cast("string")))
    return coded.select(*kept, F.when(same, F.col("n_tokens")).otherwise(wrong.cast("long")).alias("n_tokens"), "token_ids")

import re

import pytest

import __spark_entry__
import corpus_pipeline
import oracle_check
from civiclens.llm.queries import ORACLE, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_agrees_with_its_sql(spark, folder, name):
    assert not oracle_check.compare(QUERIES[name](spark, folder), ORACLE[name], oracle_check.connect(folder))


def test_all_operators_are_registered():
    numbers = sorted(int(re.match(r"op(\d+)_", name)[1]) for name in QUERIES)
    assert numbers == list(range(1, 14))
    assert set(QUERIES) | {"pipeline"} <= set(__spark_entry__.queries())


def test_pipeline(spark, folder):
    rows = corpus_pipeline.run(spark, folder)
    assert rows.columns == ["doc_id", "lang", "source", "n_tokens", "token_ids"]
    ids = [r.doc_id for r in rows.select("doc_id").collect()]
    assert 0 < len(ids) == len(set(ids))
    documents = spark.read.parquet(f"{folder}/documents.parquet")
    assert set(ids) < {r.doc_id for r in documents.select("doc_id").collect()}
    empty = documents.where("false")
    for _, stage in corpus_pipeline.STAGES:
        empty = stage(spark, empty, folder)
        assert empty.count() == 0

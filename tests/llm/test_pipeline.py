"""The queries and the pipeline on the smallest tables."""

from __future__ import annotations

import pytest
from oracle import compare, connect

import corpus_pipeline
from gaugeflow.llm.queries import ORACLE, QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, name):
    rows, problems = compare(spark, connect(SF_DIR), name, QUERIES[name], ORACLE.get(name), SF_DIR)
    assert rows > 0
    assert not problems, problems


def test_stages_follow_each_other(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    n = docs.count()
    for _, function in corpus_pipeline.STAGES[:-1]:
        out = function(spark, docs, SF_DIR)
        assert out.dtypes == docs.dtypes
        docs = spark.createDataFrame(out.toPandas(), docs.schema)
    assert n * 0.5 < docs.count() <= 2 * n
    assert corpus_pipeline.run(spark, SF_DIR).count() > 0

"""Queries over the smallest tables against SQL, and what holds for all of them."""

import re

import pytest
from oracle_check import connect, differences

import __spark_entry__ as driver
import corpus_pipeline
from tidemill.llm.queries import ORACLES, QUERIES

FOLDER = "/root/testdata/sf0.001"


def test_one_query_of_each_operator():
    numbers = sorted(int(re.match(r"op(\d+)_", n).group(1)) for n in QUERIES if n != "pipeline")
    assert numbers == list(range(1, 14))
    assert set(QUERIES) <= set(driver.queries()) and set(ORACLES) <= set(driver.oracle_sql())


@pytest.mark.parametrize("name", ORACLES)
def test_against_sql(spark, name):
    assert differences(QUERIES[name](spark, FOLDER), connect(FOLDER), ORACLES[name]) is None


def test_pipeline_keeps_columns_and_decisions(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns, counts = docs.columns, [docs.count()]
    for name, stage in corpus_pipeline.STAGES[:3]:
        docs = stage(spark, docs, FOLDER)
        assert docs.columns == columns, name
        docs = spark.createDataFrame(docs.collect(), docs.schema)
        counts.append(docs.count())
    assert counts == sorted(counts, reverse=True) and counts[-1] > 0.6 * counts[0]
    ids = [r[0] for r in docs.select("doc_id").collect()]
    assert len(ids) == len(set(ids))
    mixed = corpus_pipeline.STAGES[3][1](spark, docs, FOLDER)
    assert mixed.columns == columns
    tokens = corpus_pipeline.STAGES[4][1](spark, mixed, FOLDER)
    assert {r[0] for r in tokens.select("doc_id").distinct().collect()} <= set(ids)

"""A corpus from raw documents to tokens: clean of toxic texts, copies and secrets, mixed and encoded.

Each stage takes (spark, docs, folder) and returns a DataFrame, which is written and read again as the next one's
documents. All but the last keep the columns of `documents`.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tidemill.llm import bpe, jaccard_join, mixture, secret_scan, toxicity
from tidemill.llm.common import written

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")


def toxic_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a toxicity of the threshold or more go."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic")
    return toxicity.keep_clean(docs, toxicity.train(docs, labels))


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by a Jaccard similarity of 0.8 of five-word shingles the one with the least id stays."""
    return jaccard_join.keep_one(docs, k=5, percent=80)


def secrets_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with secrets go."""
    return secret_scan.keep_clean(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return mixture.mixed(docs)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Number of tokens of each document and digests of its tokens, and of the text that they decode to.

    Written here, so that texts pass to Python by the thousand and not ten times as many at once.
    """
    return written(bpe.digests(docs, VOCABULARY), "pipeline-digests")


STAGES = [
    ("toxicity", toxic_out),
    ("n-gram Jaccard join", one_of_each_group),
    ("secret scans", secrets_out),
    ("mixing sources", mixed),
    ("BPE", encoded),
]

# The model of the first stage cannot be expressed in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), "pipeline-" + name.split()[0])
    return STAGES[-1][1](spark, docs, sf_dir)

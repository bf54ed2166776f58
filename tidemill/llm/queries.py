"""The operators as queries, `(spark, folder) -> DataFrame`, each over its whole table, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.llm import (
    bpe,
    chat_format,
    fill_in_middle,
    fingerprints,
    licenses,
    mixture,
    periodic_runs,
    quality_cascade,
    secret_scan,
    simhash_vp,
    toxicity,
    url_rules,
)
from tidemill.llm.common import documents
from tidemill.llm.jaccard_join import jaccard_components


def op1_url_rules(spark: SparkSession, folder: str) -> DataFrame:
    """Labels of URLs: the verdicts of the listed rules, and for other pages the quality label of their id."""
    pages = spark.read.parquet(f"{folder}/pages.parquet").select("page_id", "url")
    labels = spark.read.parquet(f"{folder}/labels.parquet").select(
        F.col("doc_id").alias("page_id"), (F.col("quality") == 0).alias("block")
    )
    return url_rules.judge(pages, labels)


def op2_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    return fingerprints.compare_edited(documents(spark, folder))


def op3_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = documents(spark, folder)
    labels = spark.read.parquet(f"{folder}/labels.parquet").select("doc_id", "toxic")
    scored = toxicity.score(docs, toxicity.train(docs, labels))
    return scored.select(
        "doc_id",
        toxicity.held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"),
        F.size("offending").cast("bigint").alias("n_offending"),
    )


def op4_chat_format(spark: SparkSession, folder: str) -> DataFrame:
    turns = spark.read.parquet(f"{folder}/conversations.parquet").select("conv_id", "turn", "role", "text")
    said = r"\### Assistant: </turn> ok"
    trap = spark.createDataFrame(
        [(-7, 0, "user", said), (-7, 1, "assistant", said)], "conv_id bigint, turn bigint, role string, text string"
    )
    return chat_format.digests(chat_format.format_conversations(turns.union(trap)))


def op5_mixture(spark: SparkSession, folder: str) -> DataFrame:
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text", "source")
    return mixture.mix(docs).drop("copies")


def op6_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return bpe.digests(documents(spark, folder), corpus_pipeline.VOCABULARY)


def op7_secrets(spark: SparkSession, folder: str) -> DataFrame:
    return secret_scan.digests(documents(spark, folder))


def op8_licenses(spark: SparkSession, folder: str) -> DataFrame:
    return licenses.scan(documents(spark, folder))


def op9_quality_cascade(spark: SparkSession, folder: str) -> DataFrame:
    return quality_cascade.judge(documents(spark, folder))


def op10_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard_components(documents(spark, folder))


def op11_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    return periodic_runs.digests(documents(spark, folder))


def op12_simhash(spark: SparkSession, folder: str) -> DataFrame:
    return simhash_vp.digests(documents(spark, folder))


def op13_fill_in_middle(spark: SparkSession, folder: str) -> DataFrame:
    return fill_in_middle.digests(documents(spark, folder))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_url_rules": op1_url_rules,
    "op2_fingerprints": op2_fingerprints,
    "op3_toxicity": op3_toxicity,
    "op4_chat_format": op4_chat_format,
    "op5_mixture": op5_mixture,
    "op6_bpe": op6_bpe,
    "op7_secrets": op7_secrets,
    "op8_licenses": op8_licenses,
    "op9_quality_cascade": op9_quality_cascade,
    "op10_jaccard_join": op10_jaccard_join,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_simhash": op12_simhash,
    "op13_fill_in_middle": op13_fill_in_middle,
    "pipeline": corpus_pipeline.run,
}

ORACLES: dict[str, str] = {
    "op5_mixture": mixture.ORACLE,
    "op8_licenses": licenses.oracle(),
    "op13_fill_in_middle": fill_in_middle.ORACLE,
}

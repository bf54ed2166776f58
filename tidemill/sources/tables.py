"""Scans of named Parquet tables, and the raw frames the models start from."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The tables of a data folder.
TABLES = (
    "region",
    "nation",
    "customer",
    "supplier",
    "part",
    "orders",
    "lineitem",
    "events",
    "documents",
    "embeddings",
    "pages",
    "benchmark",
    "labels",
    "conversations",
)

# Order status codes and the names the models use.
STATUS = {"F": "completed", "O": "cancelled", "P": "pending"}


def load(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def register_all(spark: SparkSession, folder: str, names: Iterable[str] = TABLES) -> None:
    """Temporary views over a data folder, for ad-hoc SQL."""
    for name in names:
        load(spark, folder, name).createOrReplaceTempView(name)


def pruned_scan(df: DataFrame, row_filter: Column, columns: Iterable[str]) -> DataFrame:
    """Rows that meet the filter, chosen columns only; both reach the Parquet reader."""
    return df.filter(row_filter).select(*columns)


def query_table(df: DataFrame, template: str) -> DataFrame:
    """Run SQL that names the frame as `{table}`."""
    return df.sparkSession.sql(template, table=df)


def query_tables(spark: SparkSession, template: str, **frames: DataFrame) -> DataFrame:
    """Run SQL over several frames, each named as `{name}`."""
    return spark.sql(template, **frames)


def customers(spark: SparkSession, folder: str) -> DataFrame:
    """`customer` in the shape of the customers feed."""
    c = load(spark, folder, "customer")
    return c.select(
        F.col("c_custkey").alias("customer_id"),
        F.split_part("c_name", F.lit("#"), F.lit(1)).alias("first_name"),
        F.split_part("c_name", F.lit("#"), F.lit(2)).alias("last_name"),
        F.concat(F.lower(F.replace("c_name", F.lit("#"), F.lit("."))), F.lit("@example.com")).alias("email"),
        F.concat(F.lit("2024-01-"), F.lpad((F.col("c_nationkey") + 1).cast("string"), 2, "0")).alias("created_at"),
    )


def orders(spark: SparkSession, folder: str, priority: str | None = None) -> DataFrame:
    """`orders` in the shape of the orders feed, one order priority only if named."""
    o = load(spark, folder, "orders")
    if priority is not None:
        o = o.filter(F.col("o_orderpriority") == priority)
    status = F.col("o_orderstatus")
    named = F.lit(None).cast("string")
    for code, name in STATUS.items():
        named = F.when(status == code, name).otherwise(named)
    return o.select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderdate").alias("order_date"),
        F.col("o_totalprice").alias("amount"),
        named.alias("status"),
    )


def products(spark: SparkSession, folder: str) -> DataFrame:
    """`part` in the shape of the products feed."""
    return load(spark, folder, "part").select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_name").alias("name"),
        F.col("p_type").alias("category"),
        F.col("p_retailprice").alias("price"),
        F.concat(F.lit("2024-"), F.lpad((F.col("p_size") % 12 + 1).cast("string"), 2, "0"), F.lit("-01")).alias(
            "created_at"
        ),
    )


def order_items(spark: SparkSession, folder: str) -> DataFrame:
    """`lineitem` as order lines with a product each."""
    return load(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("line_number"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_extendedprice").cast("decimal(10,2)").alias("amount"),
    )

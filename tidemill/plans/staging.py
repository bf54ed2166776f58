"""Staging models: explicit columns with their final types, evaluated lazily."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def stg_customers(raw: DataFrame) -> DataFrame:
    return raw.select(
        "customer_id",
        "first_name",
        "last_name",
        "email",
        F.col("created_at").cast("date").alias("created_at"),
    )


def stg_orders(raw: DataFrame) -> DataFrame:
    return raw.select(
        "order_id",
        "customer_id",
        F.col("order_date").cast("date").alias("order_date"),
        F.col("amount").cast("decimal(10,2)").alias("amount"),
        "status",
    )


def stg_products(raw: DataFrame) -> DataFrame:
    return raw.select(
        "product_id",
        "name",
        "category",
        F.col("price").cast("decimal(10,2)").alias("price"),
        F.col("created_at").cast("date").alias("created_at"),
    )

"""Mart models."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.functions import customer_tier, money
from tidemill.operators.lookup import lookup_join

ATTRIBUTES = ("customer_id", "first_name", "last_name", "email")


def orders_per_customer(orders: DataFrame) -> DataFrame:
    """Order figures by customer. Each of them can be merged with those of other orders."""
    completed = F.when(F.col("status") == "completed", F.col("amount"))
    return orders.groupBy("customer_id").agg(
        F.count("order_id").alias("total_orders"),
        money(F.coalesce(F.sum(completed), F.lit(0))).alias("total_revenue"),
        F.min("order_date").alias("first_order_date"),
        F.max("order_date").alias("last_order_date"),
    )


def attach_customers(customers: DataFrame, figures: DataFrame) -> DataFrame:
    """Left join of customers with their figures, and the tier.

    The figures hold one row per customer, so a customer with a huge number of orders weighs
    no more in the join than any other. Equal customer rows fall into one group, as they would
    if the orders had been joined before grouping.
    """
    return (
        customers.select(*ATTRIBUTES)
        .join(figures, "customer_id", "left")
        .groupBy(*ATTRIBUTES)
        .agg(
            F.sum(F.coalesce("total_orders", F.lit(0))).alias("total_orders"),
            money(F.sum(F.coalesce("total_revenue", F.lit(0)))).alias("total_revenue"),
            F.min("first_order_date").alias("first_order_date"),
            F.max("last_order_date").alias("last_order_date"),
        )
        .withColumn("customer_tier", customer_tier(F.col("total_orders")))
    )


def customer_orders(customers: DataFrame, orders: DataFrame) -> DataFrame:
    """One row per customer: orders, completed revenue, first and last date, tier."""
    return attach_customers(customers, orders_per_customer(orders))


def order_products(orders: DataFrame, items: DataFrame, products: DataFrame) -> DataFrame:
    """Order lines with their order and their product; lines without either are kept."""
    line = ("order_id", "line_number")
    with_order = lookup_join(
        items, orders.select("order_id", "customer_id", "order_date", "status"), "order_id", spread_by=line
    )
    names = products.select("product_id", F.col("name").alias("product_name"), "category")
    return lookup_join(with_order, names, "product_id", spread_by=line, keys_from=items).select(
        "order_id",
        "line_number",
        "customer_id",
        "order_date",
        "product_name",
        "category",
        "amount",
        "status",
    )

"""Reporting queries on the marts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemill.functions import full_name, mean_money, money, total_money
from tidemill.operators.ordering import ordered_windows

# Order ids per list in order_lists; a list holds at most this many ids, however many a customer has.
LIST_SPAN = 1000


def tier_summary(mart: DataFrame, drop_null_keys: bool = False) -> DataFrame:
    """Customers, orders, revenue and mean revenue by tier."""
    if drop_null_keys:
        mart = mart.filter(F.col("customer_tier").isNotNull())
    return mart.groupBy("customer_tier").agg(
        F.count(F.lit(1)).alias("customer_count"),
        F.sum("total_orders").alias("total_orders"),
        total_money(F.sum("total_revenue")).alias("total_revenue"),
        mean_money(F.sum("total_revenue"), F.count("total_revenue")).alias("avg_revenue"),
    )


def tier_counts(mart: DataFrame) -> DataFrame:
    return mart.groupBy("customer_tier").agg(F.count(F.lit(1)).alias("n"))


def by_revenue(df: DataFrame, *tie_break: str) -> DataFrame:
    """Highest revenue first, rows without revenue last."""
    return df.orderBy(F.col("total_revenue").desc_nulls_last(), *(F.col(c).asc_nulls_last() for c in tie_break))


def sorted_by(df: DataFrame, *columns: str) -> DataFrame:
    """Ascending on several columns, NULLs last."""
    return df.orderBy(*(F.col(c).asc_nulls_last() for c in columns))


def customer_names(mart: DataFrame) -> DataFrame:
    return mart.select("customer_id", full_name(F.col("first_name"), F.col("last_name")).alias("full_name"))


def revenue_rank(mart: DataFrame) -> DataFrame:
    """Rank of each customer by revenue over the whole mart, ties share a rank."""
    ranked = ordered_windows(mart, "total_revenue", ["customer_id"])
    return ranked.select(
        "customer_id",
        full_name(F.col("first_name"), F.col("last_name")).alias("full_name"),
        "total_orders",
        "total_revenue",
        F.col("rank").alias("revenue_rank"),
    )


def rank_within_tier(mart: DataFrame) -> DataFrame:
    """Three kinds of rank, and revenue so far, within each tier."""
    ranked = ordered_windows(mart, "total_revenue", ["customer_id"], ["customer_tier"], ["total_revenue"])
    return ranked.select(
        "customer_tier",
        "customer_id",
        "total_revenue",
        "row_number",
        "rank",
        "dense_rank",
        total_money(F.col("running_total_revenue")).alias("running_revenue"),
    )


def running_revenue(orders: DataFrame) -> DataFrame:
    """Completed revenue by day, the day before, the last seven entries, and so far.

    The window sees one row per calendar day, however many orders there are.
    """
    completed = F.when(F.col("status") == "completed", F.col("amount"))
    daily = orders.groupBy("order_date").agg(money(F.coalesce(F.sum(completed), F.lit(0))).alias("revenue"))
    day = W.orderBy("order_date")
    return daily.select(
        "order_date",
        "revenue",
        F.lag("revenue").over(day).alias("previous_revenue"),
        total_money(F.sum("revenue").over(day.rowsBetween(-6, 0))).alias("week_revenue"),
        total_money(F.sum("revenue").over(day.rowsBetween(W.unboundedPreceding, 0))).alias("running_revenue"),
    )


def order_lists(orders: DataFrame, span: int = LIST_SPAN) -> DataFrame:
    """Ids of the completed orders of each customer, in sorted lists; a repeated row is listed as often as it comes.

    A list covers `span` consecutive order ids; a customer with many orders has many lists, which different tasks
    build. Equal rows are counted before they are listed, so copies are spelled out only in the result.
    """
    block = F.expr(f"order_id div {int(span)} - if(order_id % {int(span)} < 0, 1, 0)")  # rounds down
    counted = orders.groupBy("customer_id", block.alias("id_block"), "order_id", "status").agg(
        F.count(F.lit(1)).alias("copies")
    )
    done = F.when(F.col("status") == "completed", F.struct("order_id", "copies"))
    listed = counted.groupBy("customer_id", "id_block").agg(
        F.sum("copies").alias("orders_in_block"), F.array_sort(F.collect_list(done)).alias("items")
    )
    ids = F.flatten(F.transform("items", lambda item: F.array_repeat(item["order_id"], item["copies"].cast("int"))))
    return listed.select("customer_id", "id_block", "orders_in_block", ids.alias("completed_ids"))

"""Append of new rows only, and marts kept up to date from partial results."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.functions import mean_money, money, total_money
from tidemill.operators.lookup import lookup_join
from tidemill.plans.marts import attach_customers, orders_per_customer
from tidemill.sources.store import Store


def new_rows(incoming: DataFrame, existing: DataFrame, key: Sequence[str], since: str | None = None) -> DataFrame:
    """Incoming rows whose key is not in the table yet; a missing key value equals a missing one.

    With `since`, a column that does not change for a key (such as the event time), only the part of
    the table from the oldest incoming value on is searched, and the rows without a value; the bound reaches the
    Parquet reader.
    """
    known = existing
    if since is not None:
        oldest = incoming.agg(F.min(since)).first()[0]
        if oldest is not None:
            bound = F.lit(oldest).cast(incoming.schema[since].dataType)
            known = existing.filter((F.col(since) >= bound) | F.col(since).isNull())
    known = known.select(*(F.col(c).alias(f"_known_{c}") for c in key))
    same = reduce(and_, (F.col(c).eqNullSafe(F.col(f"_known_{c}")) for c in key))
    return incoming.join(known, same, "left_anti")


def incremental_append(
    store: Store, incoming: DataFrame, table: str, key: Sequence[str], since: str | None = None
) -> int | None:
    """Append what the table lacks; the number of the new batch, or None if it lacks nothing.

    Of several incoming rows with one key one enters, any if they differ.
    """
    incoming = incoming.dropDuplicates(list(key))
    existing = store.read_if_exists(table)
    if existing is not None:
        incoming = new_rows(incoming, existing, key, since)
        if incoming.isEmpty():
            return None
    return store.append_or_create(incoming, table)


# -- daily figures -----------------------------------------------------------------------------


def daily_figures(events: DataFrame) -> DataFrame:
    """Figures by day and event type. Sum and count are kept, so that means can be merged."""
    amount = F.col("value").cast("decimal(18,2)")
    return events.groupBy(F.to_date("ts").alias("day"), "event_type").agg(
        F.count(F.lit(1)).alias("n"),
        F.count("value").alias("n_values"),
        total_money(F.sum(amount)).alias("total_value"),
        money(F.min(amount)).alias("min_value"),
        money(F.max(amount)).alias("max_value"),
    )


def merge_daily(state: DataFrame, new: DataFrame) -> DataFrame:
    return (
        state.unionByName(new)
        .groupBy("day", "event_type")
        .agg(
            F.sum("n").alias("n"),
            F.sum("n_values").alias("n_values"),
            total_money(F.sum("total_value")).alias("total_value"),
            F.min("min_value").alias("min_value"),
            F.max("max_value").alias("max_value"),
        )
    )


def with_mean(state: DataFrame) -> DataFrame:
    return state.withColumn("avg_value", mean_money(F.col("total_value"), F.col("n_values"))).drop("n_values")


# -- customer mart -----------------------------------------------------------------------------


def merge_figures(state: DataFrame, new: DataFrame) -> DataFrame:
    """Order figures per customer of two sets of different orders."""
    return (
        state.unionByName(new)
        .groupBy("customer_id")
        .agg(
            F.sum("total_orders").alias("total_orders"),
            money(F.sum("total_revenue")).alias("total_revenue"),
            F.min("first_order_date").alias("first_order_date"),
            F.max("last_order_date").alias("last_order_date"),
        )
    )


def advance_figures(store: Store, new_orders: DataFrame, table: str) -> int:
    """Merge orders never seen before into the figures per customer kept in `table`."""
    figures, known = orders_per_customer(new_orders), store.read_if_exists(table)
    return store.materialize(figures if known is None else merge_figures(known, figures), table)


def mart_from_figures(store: Store, customers: DataFrame, table: str) -> DataFrame:
    return attach_customers(customers, store.read(table))


def refresh_customers(figures: DataFrame, orders: DataFrame, changed: DataFrame) -> DataFrame:
    """Figures after orders of the `changed` customers were altered: theirs are computed afresh.

    A touched customer may hold a large share of the orders, so these are found by a lookup join,
    which splits hot keys.
    """
    touched = changed.select("customer_id").distinct()
    kept = figures.join(touched, "customer_id", "left_anti")
    marked = lookup_join(orders, touched.withColumn("_touched", F.lit(True)), "customer_id", ["order_id"])
    fresh = orders_per_customer(marked.filter("_touched"))
    return kept.unionByName(fresh)


def altered_figures(figures: DataFrame, orders: DataFrame, changes: DataFrame) -> DataFrame:
    """Figures per customer after orders were changed, removed or added.

    `changes` lists the rows that differ, as `version_diff` reports them; `orders` are all orders as they are now. Counts
    and sums take what was added and give back what was removed. First and last dates only move outwards that way, so a
    customer whose first or last date may be among what was removed, or who may have no order left, is computed
    afresh, and only those.
    """
    added = F.col("side") == "added"
    copies = F.when(added, F.col("copies")).otherwise(-F.col("copies"))
    revenue = F.when(F.col("status") == "completed", F.col("amount")) * copies.cast("decimal(19,0)")
    moved = changes.groupBy("customer_id").agg(
        F.sum(F.when(F.col("order_id").isNotNull(), copies)).alias("total_orders"),
        F.sum(revenue).cast("decimal(38,2)").alias("total_revenue"),
        F.min(F.when(added, F.col("order_date"))).alias("first_order_date"),
        F.max(F.when(added, F.col("order_date"))).alias("last_order_date"),
        F.min(F.when(~added, F.col("order_date"))).alias("gone_first"),
        F.max(F.when(~added, F.col("order_date"))).alias("gone_last"),
        F.max(~added).alias("gone"),
    )
    known = figures.select(
        "*", F.col("first_order_date").alias("known_first"), F.col("last_order_date").alias("known_last")
    )
    merged = known.unionByName(moved, allowMissingColumns=True).groupBy("customer_id").agg(
        F.sum("total_orders").alias("total_orders"),
        money(F.coalesce(F.sum("total_revenue"), F.lit(0))).alias("total_revenue"),
        F.min("first_order_date").alias("first_order_date"),
        F.max("last_order_date").alias("last_order_date"),
        (
            F.coalesce(F.max("gone"), F.lit(False))
            & (
                F.coalesce((F.min("gone_first") <= F.min("known_first")) | (F.max("gone_last") >= F.max("known_last")), F.lit(False))
                | (F.coalesce(F.sum("total_orders"), F.lit(0)) <= 0)
            )
        ).alias("_doubt"),
    )
    touched = merged.filter("_doubt").select("customer_id")
    settled = merged.filter(~F.col("_doubt")).drop("_doubt").withColumn("total_orders", F.coalesce("total_orders", F.lit(0)))
    marked = lookup_join(orders, touched.withColumn("_touched", F.lit(True)), "customer_id", ["order_id"])
    again = orders_per_customer(marked.filter(F.col("_touched") | F.col("customer_id").isNull()))
    mine = touched.select(F.col("customer_id").alias("_customer"))
    fresh = again.join(mine, F.col("customer_id").eqNullSafe(F.col("_customer")), "left_semi")
    return settled.unionByName(fresh)

"""Ranks and running totals over a whole table, or over few large groups, without one task per group.

A plain window sorts each group in one task. Here the rows are range-partitioned by group, order
and tie-break, so that even a group or a value with a third of all rows is spread evenly; windows
run within (range, group), and what precedes each range is added from a table of one row per
(range, group).
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemill.session import scratch_dir


def _sorted(name: str, descending: bool) -> Column:
    return F.col(name).desc_nulls_last() if descending else F.col(name).asc_nulls_last()


def ordered_windows(
    df: DataFrame,
    order_by: str,
    tie_break: Sequence[str],
    group_by: Sequence[str] = (),
    running: Iterable[str] = (),
    descending: bool = True,
) -> DataFrame:
    """Add row_number, rank, dense_rank and running_<column> (bigint or exact decimal sums).

    rank and dense_rank look at `order_by` alone; row_number and the running sums also follow
    `tie_break`, which should make the order unique.
    """
    running = list(running)
    group_by = list(group_by)
    spark = df.sparkSession
    order = [_sorted(order_by, descending), *(F.col(c).asc_nulls_last() for c in tie_break)]

    # The range a row belongs to is fixed by writing it down: it is read twice below, and a range
    # computed again after the loss of an executor must not differ.
    ranged = (
        df.repartitionByRange(*(F.col(c).asc_nulls_last() for c in group_by), *order)
        .sortWithinPartitions(*(F.col(c).asc_nulls_last() for c in group_by), *order)
        .withColumn("_range", F.spark_partition_id())
        .withColumn("_position", F.monotonically_increasing_id())
    )
    path = scratch_dir(spark, "ordered")
    ranged.write.parquet(path)
    ranged = spark.read.parquet(path)

    # One row per (range, group, value), then one per (range, group).
    values = ranged.groupBy("_range", *group_by, order_by).agg(
        F.count(F.lit(1)).alias("_n"),
        F.min("_position").alias("_start"),
        *(F.sum(c).alias(f"_sum_{c}") for c in running),
    )
    value = F.struct(F.col(order_by).alias("v"))
    pieces = values.groupBy("_range", *group_by).agg(
        F.sum("_n").alias("_rows"),
        F.count(F.lit(1)).alias("_distinct"),
        F.min_by(value, "_start").alias("_first"),
        F.max_by(value, "_start").alias("_last"),
        (F.max("_start") - F.min("_start")).alias("_last_at"),
        *(F.sum(f"_sum_{c}").alias(f"_sum_{c}") for c in running),
    )

    # Few rows: one per range, plus one for each group that begins inside a range.
    by_range = W.partitionBy(*(group_by or [F.lit(0)])).orderBy("_range")
    before = by_range.rowsBetween(W.unboundedPreceding, -1)
    carried = F.lag("_last").over(by_range).eqNullSafe(F.col("_first"))
    starts = (
        pieces.withColumn("_rows_before", F.coalesce(F.sum("_rows").over(before), F.lit(0)))
        .withColumn("_carried", carried)
        .withColumn("_new", F.col("_distinct") - F.when(F.col("_carried"), 1).otherwise(0))
        .withColumn("_values_before", F.coalesce(F.sum("_new").over(before), F.lit(0)))
        .withColumn("_values_before", F.col("_values_before") - F.when(F.col("_carried"), 1).otherwise(0))
    )
    for c in running:
        starts = starts.withColumn(f"_sum_{c}", F.coalesce(F.sum(f"_sum_{c}").over(before), F.lit(0)))
    # A first value carried over began where the last value of an earlier range did: the latest
    # range whose last value was new to it, or in which that value was not the only one.
    began_here = (F.col("_distinct") > 1) | ~F.col("_carried")
    began_at = F.when(began_here, F.col("_rows_before") + F.col("_last_at"))
    starts = starts.withColumn("_began", F.last(began_at, ignorenulls=True).over(before)).select(
        "_range",
        *group_by,
        "_rows_before",
        "_values_before",
        F.when(F.col("_carried"), F.col("_began")).alias("_carried_from"),
        *(F.col(f"_sum_{c}").alias(f"_before_{c}") for c in running),
    )

    piece = W.partitionBy("_range", *group_by)
    by_value = piece.orderBy(_sorted(order_by, descending))
    by_position = piece.orderBy("_position")
    upto = by_position.rowsBetween(W.unboundedPreceding, W.currentRow)
    local = ranged.select(
        "*",
        F.row_number().over(by_position).cast("bigint").alias("_row"),
        F.rank().over(by_value).cast("bigint").alias("_rank"),
        F.dense_rank().over(by_value).cast("bigint").alias("_dense"),
        *(F.sum(c).over(upto).alias(f"_local_{c}") for c in running),
    )
    keys = ["_range", *group_by]
    joined = local.alias("l").join(
        starts.alias("s"), [F.col(f"l.{k}").eqNullSafe(F.col(f"s.{k}")) for k in keys], "inner"
    )
    tied_over = (F.col("_rank") == 1) & F.col("_carried_from").isNotNull()
    return joined.select(
        *(F.col(f"l.{c}") for c in df.columns),
        (F.col("_rows_before") + F.col("_row")).cast("bigint").alias("row_number"),
        F.when(tied_over, F.col("_carried_from") + 1)
        .otherwise(F.col("_rows_before") + F.col("_rank"))
        .cast("bigint")
        .alias("rank"),
        (F.col("_values_before") + F.col("_dense")).cast("bigint").alias("dense_rank"),
        *((F.col(f"_before_{c}") + F.col(f"_local_{c}")).alias(f"running_{c}") for c in running),
    )

"""Shape and content of tables."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.sources.store import file_list


def describe_columns(df: DataFrame) -> list[tuple[int, str, str, bool]]:
    """Position, name, type and nullability of each column."""
    return [
        (i, f.name, f.dataType.simpleString(), f.nullable) for i, f in enumerate(df.schema.fields, start=1)
    ]


def table_profile(df: DataFrame, approximate: bool = False) -> DataFrame:
    """One row per column: type, rows, NULLs, distinct values, smallest and largest value as text.

    Each column is grouped by value on its own, so a columnar file gives up each column once, equal
    values are merged before the shuffle, and the figures are taken from the distinct values.
    `approximate` estimates the distinct values instead, in one pass over all columns and with no
    shuffle by value.
    """
    if approximate:
        return _estimated_profile(df)
    profiles = []
    for column in describe_columns(df):
        value = F.col("_value")
        values = df.select(F.col(f"`{column[1]}`").alias("_value")).groupBy("_value").agg(F.count(F.lit(1)).alias("_n"))
        profiles.append(
            values.agg(
                F.coalesce(F.sum("_n"), F.lit(0)).alias("rows"),
                F.coalesce(F.sum(F.when(value.isNull(), F.col("_n"))), F.lit(0)).alias("nulls"),
                F.count(value).alias("distinct"),
                F.min(value).cast("string").alias("low"),
                F.max(value).cast("string").alias("high"),
            ).select(*_profile_row(column, *map(F.col, ("rows", "nulls", "distinct", "low", "high"))))
        )
    return reduce(DataFrame.unionByName, profiles)


def _profile_row(column: tuple[int, str, str, bool], rows, nulls, distinct, low, high) -> list[Column]:
    position, name, dtype, nullable = column
    return [
        F.lit(position).cast("bigint").alias("position"),
        F.lit(name).alias("column_name"),
        F.lit(dtype).alias("data_type"),
        F.lit(nullable).alias("nullable"),
        rows.alias("row_count"),
        nulls.alias("null_count"),
        distinct.alias("distinct_count"),
        low.alias("min_value"),
        high.alias("max_value"),
    ]


def _estimated_profile(df: DataFrame) -> DataFrame:
    figures, entries = [F.count(F.lit(1)).alias("rows")], []
    for column in describe_columns(df):
        i, c = column[0], F.col(f"`{column[1]}`")
        figures += [
            F.count_if(c.isNull()).alias(f"nulls_{i}"),
            F.approx_count_distinct(c).alias(f"distinct_{i}"),
            F.min(c).cast("string").alias(f"low_{i}"),
            F.max(c).cast("string").alias(f"high_{i}"),
        ]
        names = ("rows", f"nulls_{i}", f"distinct_{i}", f"low_{i}", f"high_{i}")
        entries.append(F.struct(*_profile_row(column, *map(F.col, names))))
    return df.agg(*figures).select(F.inline(F.array(*entries)))


def table_inventory(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Rows, columns, files and bytes of each table, told by file footers and the file listing."""
    entries = []
    for name, df in tables.items():
        entries.append(
            file_list(df).agg(
                F.lit(name).alias("table_name"),
                F.coalesce(F.sum("record_count"), F.lit(0)).alias("row_count"),
                F.lit(len(df.columns)).cast("bigint").alias("column_count"),
                F.count(F.lit(1)).alias("file_count"),
                F.coalesce(F.sum("file_size_in_bytes"), F.lit(0)).alias("total_bytes"),
            )
        )
    return reduce(DataFrame.unionByName, entries)


def arrow_profile(df: DataFrame) -> DataFrame:
    """Rows, columns and bytes the frame takes up as Arrow, summed over executors."""

    def sizes(batches: Iterable):
        import pyarrow as pa

        rows = size = 0
        for batch in batches:
            rows += batch.num_rows
            size += batch.nbytes
        yield pa.RecordBatch.from_pydict({"rows": pa.array([rows], pa.int64()), "bytes": pa.array([size], pa.int64())})

    return df.mapInArrow(sizes, "rows bigint, bytes bigint").agg(
        F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"),
        F.lit(len(df.columns)).cast("bigint").alias("columns"),
        F.coalesce(F.sum("bytes"), F.lit(0)).alias("bytes"),
    )

"""Left join of a large table with a lookup table, safe for hot keys."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Hash buckets per part in the search for hot keys.
BUCKETS_PER_PART = 16

# A lookup table is broadcast up to this many bytes, measured.
BROADCAST_BYTES = 64 * 1024 * 1024


def fits(df: DataFrame, limit: int) -> bool:
    """Whether all values of a frame take up no more than `limit` bytes, by measure.

    The number of rows alone (Parquet footers tell it) rules out most large frames; only a frame
    that passes is read, once, for the length of its strings.
    """
    per_row = 16 * len(df.columns)
    if df.count() * per_row > limit:
        return False
    size = F.lit(per_row).cast("bigint")
    for field in df.schema.fields:
        if isinstance(field.dataType, T.StringType | T.BinaryType):
            size = size + F.coalesce(F.octet_length(F.col(field.name)), F.lit(0))
        elif isinstance(field.dataType, T.ArrayType | T.MapType | T.StructType):
            size = size + F.coalesce(F.octet_length(F.to_json(F.struct(field.name))), F.lit(0))
    return (df.agg(F.sum(size)).first()[0] or 0) <= limit


@dataclass(frozen=True)
class HotKeys:
    """Keys with more than 1/parts of the rows and the number of parts for each; whether NULL is one."""

    splits: list[tuple]
    null: bool


def hot_keys(fact: DataFrame, key: str, parts: int) -> HotKeys:
    """Find the keys that hold more than 1/parts of the rows; fewer than `parts` keys can.

    Rows are first counted by a few hash buckets per part, which shuffles next to nothing. Only
    the keys of buckets that are too full are then counted one by one; mostly there are none.
    """
    value = F.col(key)
    bucket = F.when(value.isNotNull(), F.pmod(F.xxhash64(key), F.lit(BUCKETS_PER_PART * parts)))
    sizes = dict(map(tuple, fact.groupBy(bucket.alias("bucket")).count().collect()))  # one row per bucket
    total = sum(sizes.values())
    crowded = [b for b, n in sizes.items() if b is not None and n * parts > total]
    found = []
    if crowded:
        counts = fact.filter(bucket.isin(crowded)).groupBy(key).count()
        hot = counts.filter(F.col("count") * parts > total).collect()  # fewer than `parts` rows
        found = [(k, -(-n * parts // total)) for k, n in hot]
    return HotKeys(found, sizes.get(None, 0) * parts > total)


def lookup_join(
    fact: DataFrame,
    lookup: DataFrame,
    key: str,
    spread_by: Iterable[str],
    broadcast_bytes: int = BROADCAST_BYTES,
    keys_from: DataFrame | None = None,
) -> DataFrame:
    """`fact` left join `lookup` on `key`.

    A lookup table within `broadcast_bytes` is broadcast: the fact table is not shuffled. A larger
    one is joined by shuffle, and if there are hot keys, each is split: its fact rows are spread by a
    hash of `spread_by` and its lookup rows repeated once per part. So are rows without a key.

    `keys_from` is where hot keys are looked for, by default `fact`: if that is itself the result of
    a join, name the table its keys come from, and the join need not run to find them.
    """
    if fits(lookup, broadcast_bytes):
        return fact.join(F.broadcast(lookup), key, "left")
    spark = fact.sparkSession
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 2)
    hot = hot_keys(fact if keys_from is None else keys_from, key, parts)
    if not hot.splits and not hot.null:
        return fact.join(lookup, key, "left")
    schema = T.StructType([fact.schema[key], T.StructField("_splits", T.IntegerType())])
    splits = F.broadcast(spark.createDataFrame(hot.splits, schema))  # fewer than `parts` rows
    row_hash = F.xxhash64(*spread_by)
    spread = (
        F.when(F.col(key).isNull(), F.pmod(row_hash, F.lit(parts)))
        .when(F.col("_splits").isNotNull(), F.pmod(row_hash, F.col("_splits")))
        .otherwise(0)
        .cast("int")
    )
    left = fact.join(splits, key, "left").withColumn("_part", spread).drop("_splits")
    numbers = F.sequence(F.lit(0), F.coalesce(F.col("_splits") - 1, F.lit(0)))
    right = lookup.join(splits, key, "left").withColumn("_part", F.explode(numbers)).drop("_splits")
    return left.join(right, [key, "_part"], "left").drop("_part")

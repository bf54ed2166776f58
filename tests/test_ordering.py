import pytest
from conftest import rows
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemill.operators.ordering import ordered_windows

KEYS = ("row_number", "rank", "dense_rank")


def plain(df, groups, descending):
    """The same by plain windows."""
    group = W.partitionBy(*(groups or [F.lit(0)]))
    by = F.col("v").desc_nulls_last() if descending else F.col("v").asc_nulls_last()
    by_value, by_row = group.orderBy(by), group.orderBy(by, "id")
    return df.select(
        "id",
        F.row_number().over(by_row).alias("row_number"),
        F.rank().over(by_value).alias("rank"),
        F.dense_rank().over(by_value).alias("dense_rank"),
        F.sum("a").over(by_row.rowsBetween(W.unboundedPreceding, 0)).alias("running_a"),
    )


@pytest.fixture
def uncoalesced(spark):
    """Keep ranges apart, however small, so that values and groups span them."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


@pytest.mark.parametrize("distinct", [1, 3, 60, 100000])
@pytest.mark.parametrize("groups", [(), ("g",)])
@pytest.mark.parametrize("descending", [True, False])
def test_equals_plain_windows(spark, uncoalesced, distinct, groups, descending):
    value = F.pmod(F.xxhash64("id"), F.lit(distinct))
    df = spark.range(2000).select(
        "id",
        F.when(F.col("id") % 11 == 0, None).when(F.col("id") % 3 == 0, 0).otherwise(value).alias("v"),
        F.when(F.col("id") % 5 == 0, None).otherwise(F.col("id") % 2).alias("g"),
        (F.col("id") % 13).cast("decimal(10,2)").alias("a"),
    )
    got = ordered_windows(df, "v", ["id"], groups, ["a"], descending)
    assert got.columns == ["id", "v", "g", "a", *KEYS, "running_a"]
    columns = ("id", *KEYS, "running_a")
    assert rows(got, *columns) == rows(plain(df, groups, descending), *columns)


def test_a_value_with_most_rows_is_spread(spark, uncoalesced):
    df = spark.range(8000).select("id", F.when(F.col("id") % 10 == 0, F.col("id")).otherwise(0).alias("v"))
    got = ordered_windows(df, "v", ["id"])
    # 799 values lie above zero
    assert got.agg(F.max("row_number"), F.max("rank")).first() == (8000, 800)
    assert got.filter("v = 0").agg(F.min("rank"), F.max("rank"), F.count("*")).first() == (800, 800, 7201)


def test_no_rows(spark):
    df = spark.createDataFrame([], "id bigint, v bigint")
    assert ordered_windows(df, "v", ["id"]).count() == 0

"""All queries against their SQL on the smallest tables, and plans that must hold at any size."""

import re

import pytest
from conftest import plan
from oracle_check import connect, differences
from pyspark.sql import functions as F

import __spark_entry__ as driver
from tidemill.plans import catalog, oracles
from tidemill.sources import tables

FOLDER = "/root/testdata/sf0.001"
# Python in the data path, or all pairs of two tables.
SLOW_NODES = {"CartesianProduct", "BroadcastNestedLoopJoin", "ArrowEvalPython", "BatchEvalPython", "MapInPandas"}
QUERIES, ORACLES = catalog.QUERIES, oracles.ORACLES  # the corpus queries have their own tests


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, con, name):
    df = QUERIES[name](spark, FOLDER)
    if name != "arrow_profile":
        assert not SLOW_NODES & set(re.findall(r"\w+", plan(df)))
    assert differences(df, con, ORACLES[name]) is None


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(driver.queries()) and set(ORACLES) <= set(driver.oracle_sql())


def test_entry(spark):
    assert driver.entry(spark).count() == tables.load(spark, FOLDER, "customer").count()


def test_filter_and_columns_reach_the_reader(spark):
    text = plan(catalog.pruned_scan(spark, FOLDER))
    assert "GreaterThanOrEqual(total_orders,2)" in text
    schema = re.search(r"ReadSchema: struct<(.*)>", text).group(1)
    assert "email" not in schema and "first_order_date" not in schema


def test_tests_read_each_model_once(spark):
    text = plan(catalog.test_report(spark, FOLDER)).split("\n\n")[0]
    assert text.count("Scan parquet") == 4


def test_mart_reads_only_its_columns(spark):
    schemas = re.findall(r"ReadSchema: struct<(.*)>", plan(catalog.customer_orders(spark, FOLDER)))
    assert "o_orderpriority" not in "".join(schemas)
    assert "c_acctbal" not in "".join(schemas)


def test_batch_bounds_reach_the_reader(spark):
    text = plan(next(catalog._weeks(tables.load(spark, FOLDER, "events"))))
    assert "GreaterThanOrEqual(ts," in text and "LessThan(ts," in text


def test_windows_over_all_rows_are_avoided(spark):
    """Only reports over days or batches may sort all their rows in one task."""
    for name in ("revenue_rank", "rank_within_tier"):
        text = plan(QUERIES[name](spark, FOLDER)).split("\n\n")[0]
        assert "RangePartitioning" not in text
        assert text.count("SinglePartition") == 0


def test_templated_sql(spark):
    df = spark.range(5).withColumn("v", F.col("id") % 2)
    assert tables.query_table(df, "SELECT v, count(*) AS n FROM {table} GROUP BY v").count() == 2
    tables.register_all(spark, FOLDER, ("region",))
    assert spark.sql("SELECT * FROM region").count() == 5

from datetime import date
from decimal import Decimal as D

import pytest
from conftest import plan, rows
from pyspark.sql import functions as F

from tidemill.operators import compare as cmp
from tidemill.plans import reports
from tidemill.plans.catalog import MART_SQL
from tidemill.plans.marts import customer_orders, order_products
from tidemill.plans.staging import stg_customers, stg_orders, stg_products
from tidemill.sources.feeds import CUSTOMERS, ORDERS, PRODUCTS, read_feed
from tidemill.sources.tables import query_tables


@pytest.fixture
def customers(spark, seeds):
    return stg_customers(read_feed(spark, f"{seeds}/customers.csv", CUSTOMERS.schema))


@pytest.fixture
def orders(spark, seeds):
    return stg_orders(read_feed(spark, f"{seeds}/orders.csv", ORDERS.schema))


GOLDEN = [
    (1, 3, D("455.50"), date(2024, 6, 1), date(2024, 7, 1), "high"),
    (2, 2, D("89.99"), date(2024, 6, 2), date(2024, 6, 20), "medium"),
    (3, 2, D("0.00"), date(2024, 6, 10), date(2024, 7, 5), "medium"),
    (4, 2, D("740.00"), date(2024, 6, 15), date(2024, 7, 10), "medium"),
    (5, 1, D("199.99"), date(2024, 6, 25), date(2024, 6, 25), "low"),
]
FIGURES = ("customer_id", "total_orders", "total_revenue", "first_order_date", "last_order_date", "customer_tier")


def test_mart_golden(customers, orders):
    assert rows(customer_orders(customers, orders), *FIGURES) == GOLDEN


def test_mart_types(customers, orders):
    assert dict(customer_orders(customers, orders).dtypes) == {
        "customer_id": "bigint",
        "first_name": "string",
        "last_name": "string",
        "email": "string",
        "total_orders": "bigint",
        "total_revenue": "decimal(18,2)",
        "first_order_date": "date",
        "last_order_date": "date",
        "customer_tier": "string",
    }


def test_customer_without_orders(customers, orders):
    mart = customer_orders(customers, orders.filter("customer_id <> 5"))
    assert rows(mart.filter("customer_id = 5"), *FIGURES) == [(5, 0, D("0.00"), None, None, "low")]


def test_orders_without_customer_are_left_out(spark, customers, orders):
    stray = spark.createDataFrame(
        [(1, None, date(2024, 1, 1), D("9.00"), "completed"), (2, 99, date(2024, 1, 1), D("9.00"), "completed")],
        orders.schema,
    )
    assert rows(customer_orders(customers, orders.unionByName(stray)), *FIGURES) == GOLDEN


def test_mart_equals_join_before_grouping_with_repeated_customers(spark, customers, orders):
    twice = customers.unionByName(customers.filter("customer_id = 1"))
    ours = customer_orders(twice, orders).drop("customer_tier")
    plain = (
        twice.join(orders, "customer_id", "left")
        .groupBy("customer_id", "first_name", "last_name", "email")
        .agg(
            F.count("order_id").alias("total_orders"),
            F.sum(F.when(F.col("status") == "completed", F.col("amount")).otherwise(0)).alias("total_revenue"),
            F.min("order_date").alias("first_order_date"),
            F.max("order_date").alias("last_order_date"),
        )
    )
    assert plain.filter("customer_id = 1").first().total_orders == 6
    assert cmp.compare(ours, plain, ["customer_id"]).first()["identical"]


def test_mart_as_sql(spark, customers, orders):
    ours = customer_orders(customers, orders).drop("customer_tier")
    in_sql = query_tables(spark, MART_SQL, customers=customers, orders=orders)
    assert cmp.compare(ours, in_sql, ["customer_id"]).first()["identical"]


def test_mart_shuffles_each_side_once(spark, customers, orders):
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(customer_orders(customers, orders))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    tree = text.split("\n\n")[0]
    assert tree.count("Exchange") == 2
    assert "SortMergeJoin" in tree


def test_tier_summary_golden(customers, orders):
    summary = reports.tier_summary(customer_orders(customers, orders))
    got = [tuple(r) for r in reports.by_revenue(summary).collect()]
    assert got == [
        ("medium", 3, 6, D("829.99"), D("276.66")),
        ("high", 1, 3, D("455.50"), D("455.50")),
        ("low", 1, 1, D("199.99"), D("199.99")),
    ]


def test_tier_summary_null_tier(customers, orders):
    mart = customer_orders(customers, orders).withColumn(
        "customer_tier", F.when(F.col("customer_tier") != "low", F.col("customer_tier"))
    )
    assert {r[0] for r in reports.tier_summary(mart).collect()} == {"high", "medium", None}
    assert {r[0] for r in reports.tier_summary(mart, drop_null_keys=True).collect()} == {"high", "medium"}


def test_tier_counts_add_up(customers, orders):
    counts = reports.tier_counts(customer_orders(customers, orders))
    assert counts.agg(F.sum("n")).first()[0] == customers.count()


def test_revenue_rank_golden(customers, orders):
    ranked = reports.revenue_rank(customer_orders(customers, orders))
    assert rows(ranked, "customer_id", "full_name", "revenue_rank") == [
        (1, "Alice Smith", 2),
        (2, "Bob Jones", 4),
        (3, "Charlie Brown", 5),
        (4, "Diana Prince", 1),
        (5, "Eve Wilson", 3),
    ]


def test_order_of_output(customers, orders):
    mart = customer_orders(customers, orders)
    assert [r.customer_id for r in reports.by_revenue(mart, "customer_id").collect()] == [4, 1, 5, 2, 3]
    tiers = reports.sorted_by(mart, "customer_tier", "customer_id")
    assert [r.customer_id for r in tiers.collect()] == [1, 5, 2, 3, 4]


def test_ascending_sort_puts_null_last(spark):
    df = spark.createDataFrame([(None,), (2,), (1,)], "v int")
    assert [r.v for r in reports.sorted_by(df, "v").collect()] == [1, 2, None]


def test_full_name_is_null_if_a_part_is(spark):
    df = spark.createDataFrame([(1, "A", "B"), (2, None, "B"), (3, "A", None)], "customer_id int, first_name string, last_name string")
    assert rows(reports.customer_names(df)) == [(1, "A B"), (2, None), (3, None)]


def test_order_products_keeps_unknown_products_and_orders(spark, seeds, orders):
    products = stg_products(read_feed(spark, f"{seeds}/products.csv", PRODUCTS.schema))
    items = spark.createDataFrame(
        [(1001, 1, 1, D("10.00")), (1001, 2, 99, D("11.00")), (7, 1, 2, D("12.00")), (1002, 1, None, D("13.00"))],
        "order_id bigint, line_number int, product_id bigint, amount decimal(10,2)",
    )
    got = order_products(orders, items, products)
    assert rows(got, "order_id", "line_number", "customer_id", "product_name", "category", "status") == [
        (1001, 1, 1, "Widget A", "electronics", "completed"),
        (1001, 2, 1, None, None, "completed"),
        (1002, 1, 2, None, None, "completed"),
        (7, 1, None, "Widget B", "electronics", None),
    ]


def test_order_lists_are_bounded_and_whole(spark):
    orders = spark.range(5000).select(
        F.col("id").alias("order_id"),
        F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id") % 7).alias("customer_id"),
        F.when(F.col("id") % 2 == 0, "completed").otherwise("pending").alias("status"),
    )
    lists = reports.order_lists(orders, span=100)
    assert lists.agg(F.max(F.size("completed_ids"))).first()[0] <= 100
    flat = lists.select("customer_id", F.explode("completed_ids").alias("order_id"))
    want = orders.filter("status = 'completed'").select("customer_id", "order_id")
    assert cmp.multiset_diff(flat, want).count() == 0


def test_order_lists_keep_copies(spark):
    orders = spark.createDataFrame(
        [(5, 1, "completed"), (5, 1, "completed"), (7, 1, "pending"), (-1, 1, "completed")], "order_id bigint, customer_id int, status string"
    )
    got = sorted((r.id_block, r.orders_in_block, r.completed_ids) for r in reports.order_lists(orders, span=10).collect())
    assert got == [(-1, 1, [-1]), (0, 3, [5, 5])]


def test_running_revenue(spark, orders):
    got = [tuple(r) for r in reports.running_revenue(orders).orderBy("order_date").collect()]
    assert got[0] == (date(2024, 6, 1), D("150.00"), None, D("150.00"), D("150.00"))
    assert got[-1] == (date(2024, 7, 10), D("430.00"), D("0.00"), D("1024.99"), D("1485.48"))

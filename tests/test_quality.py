from datetime import date
from decimal import Decimal as D

import pytest
from conftest import rows

from tidemill.operators import quality as q
from tidemill.plans.build import MART_TESTS, PRODUCT_TESTS, STAGING_TESTS
from tidemill.plans.staging import stg_customers, stg_orders, stg_products
from tidemill.sources.feeds import CUSTOMERS, ORDERS, PRODUCTS, read_feed


@pytest.fixture
def models(spark, seeds):
    return {
        "stg_customers": stg_customers(read_feed(spark, f"{seeds}/customers.csv", CUSTOMERS.schema)),
        "stg_orders": stg_orders(read_feed(spark, f"{seeds}/orders.csv", ORDERS.schema)),
        "stg_products": stg_products(read_feed(spark, f"{seeds}/products.csv", PRODUCTS.schema)),
    }


def test_sample_passes_all_tests(models):
    report = q.run_tests(models, {**STAGING_TESTS, **PRODUCT_TESTS})
    assert report.count() == 11
    assert report.filter("status <> 'pass' or failures <> 0").count() == 0


def test_broken_rows_fail(spark, models):
    bad = spark.createDataFrame(
        [
            (1001, 1, date(2024, 1, 1), D("1.00"), "completed"),
            (2000, None, date(2024, 1, 1), D("1.00"), "completed"),
            (2001, 99, date(2024, 1, 1), D("1.00"), "lost"),
            (2002, 99, date(2024, 1, 1), D("1.00"), "lost"),
            (None, 1, date(2024, 1, 1), D("1.00"), None),
            (None, 1, date(2024, 1, 1), D("1.00"), None),
        ],
        models["stg_orders"].schema,
    )
    models["stg_orders"] = models["stg_orders"].unionByName(bad)
    status = {"status": [{"accepted_values": ["completed", "pending", "cancelled"]}]}
    spec = {"stg_orders": {**STAGING_TESTS["stg_orders"], **status}}
    report = {(r.column_name, r.test): (r.failures, r.status) for r in q.run_tests(models, spec).collect()}
    assert report == {
        ("order_id", "unique"): (1, "fail"),  # NULL is no value
        ("order_id", "not_null"): (2, "fail"),
        ("customer_id", "not_null"): (1, "fail"),
        ("customer_id", "relationships"): (2, "fail"),  # NULL needs no parent
        ("status", "accepted_values"): (1, "fail"),  # one value, in two rows
    }
    orphans = q.failing_rows(models, "stg_orders", "customer_id", {"relationships": ("stg_customers", "customer_id")}, ["order_id"])
    assert rows(orphans, "order_id") == [(2001,), (2002,)]
    assert q.failing_rows(models, "stg_orders", "order_id", "unique", ["amount"]).count() == 2
    assert q.failing_rows(models, "stg_orders", "order_id", "not_null", []).count() == 2
    assert rows(q.failing_rows(models, "stg_orders", "status", status["status"][0], []), "order_id") == [(2001,), (2002,)]


def test_unknown_test_is_refused(models):
    with pytest.raises(ValueError):
        q.run_tests(models, {"stg_orders": {"order_id": [{"between": (1, 2)}]}})


def test_mart_has_tests():
    assert "customer_orders" in MART_TESTS

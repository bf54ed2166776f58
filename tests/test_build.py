from conftest import CUSTOMERS_CSV, ORDERS_CSV, PRODUCTS_CSV, rows

from tidemill.plans.build import PRODUCT_TESTS, STAGING_TESTS, raw_sources, run_build, seed
from tidemill.sources.ingest import ingest


def test_seed_run_test(store, seeds):
    seed(store, seeds, ("customers", "orders", "products"))
    report = run_build(store, raw_sources(store))
    assert report.count() == 15
    assert report.filter("status <> 'pass'").count() == 0
    assert store.read("customer_orders").count() == 5
    assert rows(store.spark.table("stg_orders"), "order_id")[0] == (1001,)


def test_a_new_delivery_reaches_the_mart(store, tmp_path):
    (tmp_path / "customers.csv").write_text(CUSTOMERS_CSV)
    (tmp_path / "orders.csv").write_text(ORDERS_CSV)
    ingest(store, str(tmp_path))
    run_build(store, raw_sources(store))
    (tmp_path / "orders_20240801.csv").write_text(ORDERS_CSV.splitlines()[0] + "\n1011,5,2024-08-01,5.00,completed\n")
    ingest(store, str(tmp_path))
    run_build(store, raw_sources(store))
    assert rows(store.read("customer_orders").filter("customer_id = 5"), "total_orders", "customer_tier") == [(2, "medium")]
    assert store.read("customer_orders", as_of=1).filter("customer_id = 5").first().total_orders == 1


def test_marts_wait_for_sound_staging(store, tmp_path):
    (tmp_path / "customers.csv").write_text(CUSTOMERS_CSV)
    (tmp_path / "orders.csv").write_text(ORDERS_CSV + "1012,99,2024-08-01,5.00,completed\n")
    ingest(store, str(tmp_path))
    report = run_build(store, raw_sources(store))
    assert rows(report.filter("status = 'fail'"), "model", "test", "failures") == [("stg_orders", "relationships", 1)]
    assert report.filter("status = 'skipped'").count() == 4
    assert not store.exists("customer_orders")


def test_layers_can_be_chosen(store, seeds):
    seed(store, seeds, ("customers", "orders", "products"))
    staging = run_build(store, raw_sources(store), select=["staging"], tests={**STAGING_TESTS, **PRODUCT_TESTS})
    assert staging.count() == 11
    assert not store.exists("customer_orders")
    run_build(store, raw_sources(store), select=["marts"])
    assert store.read("customer_orders").count() == 5


def test_order_lines_reach_their_mart_from_deliveries(store, tmp_path):
    (tmp_path / "customers.csv").write_text(CUSTOMERS_CSV)
    (tmp_path / "orders.csv").write_text(ORDERS_CSV)
    (tmp_path / "products.csv").write_text(PRODUCTS_CSV)
    (tmp_path / "order_items.csv").write_text("order_id,line_number,product_id,amount\n1001,1,1,29.99\n1001,2,5,199.99\n1002,1,3,12.50\n")
    ingest(store, str(tmp_path))
    report = run_build(store, raw_sources(store))
    assert report.filter("status <> 'pass'").count() == 0
    assert {"stg_products", "order_products"} <= {r.model for r in report.collect()}
    assert rows(store.read("order_products"), "order_id", "product_name") == [(1001, "Thingamajig"), (1001, "Widget A"), (1002, "Gadget C")]
    (tmp_path / "order_items_20240801.csv").write_text("order_id,line_number,product_id,amount\n1003,1,99,1.00\n")
    ingest(store, str(tmp_path))
    report = run_build(store, raw_sources(store))
    assert rows(report.filter("status = 'fail'"), "model", "column_name", "failures") == [("order_products", "product_name", 1)]
    assert store.read("order_products").count() == 3  # readers keep the sound one

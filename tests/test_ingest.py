import os
import time
from datetime import date
from decimal import Decimal as D

import pytest
from conftest import CUSTOMERS_CSV, ORDERS_CSV, PRODUCTS_CSV, plan, rows
from pyspark.sql import functions as F

from tidemill.functions import archive_name, feed_date, feed_name
from tidemill.operators.validate import split_valid, with_reasons
from tidemill.sources import ingest as ing
from tidemill.sources.feeds import (
    FEEDS,
    ORDERS,
    PRODUCTS,
    Feed,
    external_table,
    landing_files,
    load_seed,
    read_feed,
)


@pytest.fixture
def landing(tmp_path):
    folder = tmp_path / "incoming"
    folder.mkdir()
    return folder


def raw(store, table):
    return store.read(table).drop("batch_id")


def statuses(store):
    return {(r.file_name, r.status, r.rows, r.quarantined) for r in ing.ledger(store).collect()}


# -- names -------------------------------------------------------------------------------------


def test_feed_names(spark):
    names = {
        "products.csv": "products",
        "transactions_20240615.csv": "transactions",
        "sales_orders_20240601.csv": "sales_orders",
        "sales_orders.csv": "sales_orders",
        "a_1.csv": "a_1",
        "file:/in/orders_20240601.csv/part-00000-abc.csv": "orders",
        "file:/in/orders.csv/part-00000-abc.csv": "orders",
        "file:/in/daily_orders_20240601.csv": "daily_orders",
    }
    df = spark.createDataFrame([(n,) for n in names], "n string")
    assert {r[0]: r[1] for r in df.select("n", feed_name(F.col("n"))).collect()} == names


def test_feed_dates_and_archive_names(spark):
    df = spark.createDataFrame([("orders_20240601.csv",), ("orders.csv",), ("orders_20241301.csv",)], "n string")
    assert [r[0] for r in df.select(feed_date(F.col("n"))).collect()] == [date(2024, 6, 1), None, None]
    at = F.lit("2024-07-01 09:08:07").cast("timestamp")
    assert df.select(archive_name(F.col("n"), at)).first()[0] == "orders_20240601_20240701_090807.csv"


# -- reading -----------------------------------------------------------------------------------


def test_declared_types(spark, seeds):
    got = read_feed(spark, f"{seeds}/products.csv", PRODUCTS.schema)
    assert got.dtypes[3:] == [("price", "decimal(10,2)"), ("created_at", "date")]
    assert rows(got.limit(1)) == [(1, "Widget A", "electronics", D("29.99"), date(2024, 1, 10))]


def test_swapped_header_is_refused(spark, tmp_path):
    path = tmp_path / "orders.csv"
    path.write_text(ORDERS_CSV.replace("order_id,customer_id", "customer_id,order_id"))
    with pytest.raises(Exception, match="(?i)header"):
        read_feed(spark, str(path), ORDERS.schema).collect()


def test_bad_value_is_refused(spark, tmp_path):
    path = tmp_path / "orders.csv"
    path.write_text(ORDERS_CSV.replace("150.00", "abc"))
    with pytest.raises(Exception, match="MALFORMED"):
        read_feed(spark, str(path), ORDERS.schema).collect()


def test_seed_replaces_and_overrides_types(store, seeds):
    for _ in range(2):
        load_seed(store, f"{seeds}/products.csv", "products", column_types={"price": "decimal(10,2)"})
    got = store.read("products")
    assert got.count() == 5
    assert dict(got.dtypes)["price"] == "decimal(10,2)"


def test_external_table(spark, seeds):
    spark.sql("DROP TABLE IF EXISTS products_outside")
    got = external_table(spark, "products_outside", f"{seeds}/products.csv", PRODUCTS.columns)
    assert got.filter("price > 20").count() == 3
    spark.sql("DROP TABLE products_outside")


def test_split_valid(spark):
    df = spark.createDataFrame([(1,), (-1,), (None,)], "v int")
    clean, bad = split_valid(df, {"negative": F.col("v") < 0, "missing": F.col("v").isNull()})
    assert rows(clean) == [(1,)]
    assert rows(bad) == [(-1, ["negative"]), (None, ["missing"])]


# -- landing zone ------------------------------------------------------------------------------


def test_rules_are_compiled(spark):
    df = spark.sql("SELECT * FROM VALUES (1, 'x'), (-1, NULL), (NULL, '5') AS t(v, w)")
    marked = with_reasons(df, {"": F.col("v") < 0, "missing": F.col("v").isNull(), "bad": F.col("w").try_cast("int").isNull()})
    assert rows(marked, "v", "reasons") == rows(spark.sql("SELECT * FROM VALUES (1, array('bad')), (-1, array('', 'bad')), (NULL, array('missing'))"))
    assert "lambda" not in plan(marked)  # a function per element has all below it interpreted, row by row


def test_empty_and_missing_landing_zone(store, landing):
    assert ing.ingest(store, str(landing)) == []
    assert ing.ingest(store, str(landing / "nowhere")) == []


def test_each_file_is_loaded_once(store, landing):
    (landing / "orders_20240601.csv").write_text(ORDERS_CSV)
    (landing / "customers.csv").write_text(CUSTOMERS_CSV)
    for _ in range(2):
        ing.ingest(store, str(landing))
    assert raw(store, "orders").count() == 10
    assert raw(store, "customers").count() == 5
    assert statuses(store) == {("orders_20240601.csv", "loaded", 10, 0), ("customers.csv", "loaded", 5, 0)}


def test_a_new_delivery_under_the_same_name_is_loaded(store, landing):
    (landing / "orders.csv").write_text(ORDERS_CSV)
    ing.ingest(store, str(landing))
    (landing / "orders.csv").write_text(ORDERS_CSV.splitlines()[0] + "\n1011,5,2024-07-11,1.00,completed\n")
    os.utime(landing / "orders.csv", (time.time() + 5, time.time() + 5))
    ing.ingest(store, str(landing))
    assert raw(store, "orders").count() == 11
    assert store.last_batch("orders") == 2


def test_two_files_of_a_feed_in_one_batch_and_in_two(store, landing):
    head, *lines = ORDERS_CSV.splitlines()
    for i, line in enumerate(lines[:3]):
        (landing / f"orders_2024060{i + 1}.csv").write_text(f"{head}\n{line}\n")
    done = ing.ingest(store, str(landing), max_files=2)
    assert [(f["batch_id"], f["files"]) for f in done] == [(1, 2), (2, 1)]
    assert raw(store, "orders").count() == 3


def test_bad_rows_go_to_quarantine(store, landing):
    (landing / "orders.csv").write_text(
        "order_id,customer_id,order_date,amount,status\n"
        "1,1,2024-06-01,1.00,completed\n"
        "2,1,2024-13-01,1.00,completed\n"
        "3,1,2024-06-01,abc,completed\n"
        "4,1,2024-06-01,1.00\n"
        "5,1,2024-06-01,1.00,completed,more\n"
        ",1,2024-06-01,1.00,completed\n"
        "7,,2024-06-01,,\n"
    )
    ing.ingest(store, str(landing))
    assert rows(raw(store, "orders"), "order_id") == [(1,), (7,)]
    bad = store.read(ing.quarantine_table("orders"))
    assert {(r.order_id, *r.reasons) for r in bad.collect()} == {
        ("2", "bad date in order_date"),
        ("3", "bad decimal(10,2) in amount"),
        ("4", "wrong number of fields"),
        ("5", "wrong number of fields"),
        (None, "missing order_id"),
    }
    assert statuses(store) == {("orders.csv", "loaded", 2, 5)}


def test_swapped_header_sets_one_file_aside(store, landing):
    (landing / "orders_20240601.csv").write_text(ORDERS_CSV)
    (landing / "orders_20240602.csv").write_text(ORDERS_CSV.replace("order_id,customer_id", "customer_id,order_id"))
    (landing / "orders_20240603.csv").write_text(ORDERS_CSV.replace(",status", ""))
    for _ in range(2):
        ing.ingest(store, str(landing))
    assert raw(store, "orders").count() == 10
    assert {(f, s) for f, s, *_ in statuses(store)} == {
        ("orders_20240601.csv", "loaded"),
        ("orders_20240602.csv", "rejected"),
        ("orders_20240603.csv", "rejected"),
    }


def test_header_only_file(store, landing):
    (landing / "orders.csv").write_text(ORDERS_CSV.splitlines()[0] + "\n")
    ing.ingest(store, str(landing))
    assert raw(store, "orders").count() == 0
    assert statuses(store) == {("orders.csv", "loaded", 0, 0)}


def test_crash_after_writing_loads_nothing_twice(store, landing, monkeypatch):
    (landing / "orders.csv").write_text(ORDERS_CSV)

    def crash(*args):
        raise RuntimeError("lost")

    with monkeypatch.context() as patched:
        patched.setattr(ing, "note_outcome", crash)
        with pytest.raises(RuntimeError):
            ing.ingest(store, str(landing))
    assert raw(store, "orders").count() == 10
    (landing / "orders_20240701.csv").write_text(ORDERS_CSV.splitlines()[0] + "\n1011,5,2024-07-11,1.00,completed\n")
    done = ing.ingest(store, str(landing))
    assert [(f["batch_id"], f["files"], f["rows"]) for f in done] == [(1, 1, 10), (2, 1, 1)]
    assert raw(store, "orders").count() == 11


def test_an_unfinished_batch_is_taken_up_whole(store, landing, monkeypatch):
    head, *lines = ORDERS_CSV.splitlines()
    for i, line in enumerate(lines[:3]):
        (landing / f"orders_2024060{i + 1}.csv").write_text(f"{head}\n{line}\n")

    def crash(*args):
        raise RuntimeError("lost")

    with monkeypatch.context() as patched:
        patched.setattr(ing, "_load", crash)
        with pytest.raises(RuntimeError):
            ing.ingest(store, str(landing))
    done = ing.ingest(store, str(landing), max_files=1)
    assert [(f["batch_id"], f["files"]) for f in done] == [(1, 3)]
    assert raw(store, "orders").count() == 3


def test_archive(store, landing, tmp_path):
    (landing / "orders_20240601.csv").write_text(ORDERS_CSV)
    archive = tmp_path / "archive"
    ing.ingest(store, str(landing), archive=str(archive))
    (entry,) = ing.ledger(store).collect()
    assert not (landing / "orders_20240601.csv").exists()
    assert (archive / entry["archived_as"]).read_text() == ORDERS_CSV
    assert entry["archived_as"] == entry["loaded_at"].strftime("orders_20240601_%Y%m%d_%H%M%S.csv")
    assert ing.ingest(store, str(landing), archive=str(archive)) == []


def test_crash_while_archiving_loses_nothing(store, landing, tmp_path, monkeypatch):
    (landing / "orders.csv").write_text(ORDERS_CSV)

    def crash(*args):
        raise RuntimeError("lost")

    with monkeypatch.context() as patched:
        patched.setattr(ing, "_archive", crash)
        with pytest.raises(RuntimeError):
            ing.ingest(store, str(landing), archive=str(tmp_path / "archive"))
    assert ing.ingest(store, str(landing), archive=str(tmp_path / "archive")) == []
    assert raw(store, "orders").count() == 10
    assert not (landing / "orders.csv").exists()  # archived by the run after


def test_many_files_are_one_batch(store, landing):
    head = PRODUCTS_CSV.splitlines()[0]
    for i in range(1500):
        (landing / f"products_{20200000 + i}.csv").write_text(f"{head}\n{i},n,other,1.00,2024-01-01\n")
    (done,) = ing.ingest(store, str(landing))
    assert (done["batch_id"], done["files"], done["rows"]) == (1, 1500, 1500)
    assert raw(store, "products").select("product_id").distinct().count() == 1500


def test_undeclared_files_with_swapped_columns_go_by_name(store, landing):
    (landing / "shops_20240601.csv").write_text("id,name\n1,a\n")
    (landing / "shops_20240602.csv").write_text("name,id\nc,7\n")
    (landing / "shops_20240603.csv").write_text("id,name,more\n9,x,y\n")
    ing.ingest(store, str(landing))
    assert rows(raw(store, "shops"), "id", "name") == [(1, "a"), (7, "c")]
    assert statuses(store) == {
        ("shops_20240601.csv", "loaded", 1, 0),
        ("shops_20240602.csv", "loaded", 1, 0),
        ("shops_20240603.csv", "rejected", 0, 0),
    }


def test_feeds_named_like_ledger_and_quarantine(store, landing):
    (landing / "ledger.csv").write_text("id\n1\n")
    (landing / "orders_quarantine.csv").write_text("id\n1\n2\n")
    (landing / "orders.csv").write_text(ORDERS_CSV + "x,1,2024-06-01,1.00,completed\n")
    for _ in range(2):
        ing.ingest(store, str(landing))
    assert (raw(store, "ledger").count(), raw(store, "orders_quarantine").count()) == (1, 2)
    assert store.read(ing.quarantine_table("orders")).count() == 1


def test_a_poisoned_batch_does_not_block_others(store, landing):
    (landing / "shops.csv").write_text("id\n1\n")
    ing.ingest(store, str(landing))
    (landing / "shops_20240601.csv").write_text("id\nx\n")
    (landing / "zz.csv").write_text("id\n1\n")
    done = ing.ingest(store, str(landing))
    assert [(f["feed"], f["status"], f["rows"], f["quarantined"]) for f in done] == [("shops", "loaded", 0, 1), ("zz", "loaded", 1, 0)]
    assert ing.ingest(store, str(landing)) == []
    assert (raw(store, "shops").count(), raw(store, "zz").count()) == (1, 1)
    assert rows(store.read(ing.quarantine_table("shops")), "id", "reasons") == [("x", ["bad int in id"])]


def test_one_bad_value_of_an_undeclared_feed_costs_one_row(store, landing):
    (landing / "shops.csv").write_text("id,name\n1,a\n")
    ing.ingest(store, str(landing))
    (landing / "shops_20240601.csv").write_text("id,name\nx,b\n2,c\n")
    (landing / "shops_20240602.csv").write_text("name,id\nd,3\n")
    ing.ingest(store, str(landing))
    assert rows(raw(store, "shops"), "id", "name") == [(1, "a"), (2, "c"), (3, "d")]


def test_undeclared_feed_is_inferred(store, landing):
    (landing / "shops.csv").write_text("id,name,opened\n1,North,2024-01-01\n2,South,2024-02-01\n")
    ing.ingest(store, str(landing))
    (landing / "shops_20240701.csv").write_text("name,id,opened\nEast,3,2024-03-01\n")
    ing.ingest(store, str(landing))
    assert rows(raw(store, "shops")) == [
        (1, "North", date(2024, 1, 1)),
        (2, "South", date(2024, 2, 1)),
        (3, "East", date(2024, 3, 1)),
    ]


def test_folder_delivery_and_blank_in_path(spark, store, tmp_path):
    landing = tmp_path / "in coming"
    df = spark.createDataFrame([(i, f"n{i}", "other", D("1.00"), date(2024, 1, 1)) for i in range(20)], PRODUCTS.schema)
    df.repartition(3).write.option("header", True).csv(f"{landing}/products_20240601.csv")
    (landing / "customers.csv").write_text(CUSTOMERS_CSV)
    assert landing_files(spark, str(landing)).count() == 4
    archive = tmp_path / "archive"
    ing.ingest(store, str(landing), archive=str(archive))
    assert raw(store, "products").count() == 20
    totals = ing.ledger(store).groupBy("file_name").agg(F.sum("rows"))
    assert rows(totals) == [("customers.csv", 5), ("products_20240601.csv", 20)]
    assert len(list(archive.glob("products_20240601_*.csv/part-*.csv"))) == 3


def test_reader_options(store, landing):
    (landing / "products.csv").write_text(PRODUCTS_CSV.replace(",", ";"))
    feeds = {**FEEDS, "products": Feed("products", PRODUCTS.columns, options={"sep": ";"})}
    ing.ingest(store, str(landing), feeds)
    assert raw(store, "products").count() == 5

import time

import pytest
from conftest import CUSTOMERS_CSV, ORDERS_CSV, rows

from pyspark.sql import functions as F

from tidemill.functions import delivery_name, feed_date, feed_name
from tidemill.plans.build import raw_sources, run_build
from tidemill.sources import ingest as ing
from tidemill.sources.feeds import ORDERS
from tidemill.streaming import ingest as streaming
from tidemill.streaming.ingest import checked_files, stream_ingest

HEAD, *LINES = ORDERS_CSV.splitlines()


@pytest.fixture
def landing(tmp_path):
    folder = tmp_path / "incoming"
    folder.mkdir()
    return folder


def drop(landing, name, lines):
    (landing / name).write_text("\n".join([HEAD, *lines]) + "\n")


def run(store, landing, checkpoint, **options):
    query = stream_ingest(store, str(landing), ORDERS, str(checkpoint), every=None, **options)
    query.awaitTermination()
    return query


def test_three_drops_and_restarts(store, landing, tmp_path):
    drop(landing, "orders_20240601.csv", LINES[:3])
    (landing / "orders_items_20240601.csv").write_text("a\n1\n")  # another feed
    run(store, landing, tmp_path / "cp")
    drop(landing, "orders_20240602.csv", LINES[3:7])
    drop(landing, "orders.csv", LINES[7:9])
    run(store, landing, tmp_path / "cp")
    run(store, landing, tmp_path / "cp")
    drop(landing, "orders_20240603.csv", [*LINES[9:], "x,1,2024-06-01,1.00,completed"])
    run(store, landing, tmp_path / "cp")
    assert store.read("orders").count() == 10
    assert rows(store.read("orders").groupBy("batch_id").count()) == [(1, 3), (2, 6), (3, 1)]
    assert rows(store.read(ing.quarantine_table("orders")), "order_id", "batch_id") == [("x", 3)]


def test_replayed_batch_replaces_itself(store, landing, tmp_path):
    drop(landing, "orders_20240601.csv", LINES[:3])
    crashed = []

    def crash_once(store, epoch):
        if not crashed:
            crashed.append(epoch)
            raise RuntimeError("lost after writing")

    with pytest.raises(Exception, match="lost after writing"):
        run(store, landing, tmp_path / "cp", on_batch=crash_once)
    assert store.read("orders").count() == 3
    run(store, landing, tmp_path / "cp", on_batch=crash_once)
    assert store.read("orders").count() == 3
    assert crashed == [0]


def test_mart_is_refreshed_after_each_batch(spark, store, landing, tmp_path):
    (tmp_path / "seed").mkdir()
    (tmp_path / "seed" / "customers.csv").write_text(CUSTOMERS_CSV)
    ing.ingest(store, str(tmp_path / "seed"))
    totals = []

    def refresh(store, epoch):
        report = run_build(store, raw_sources(store, ("customers", "orders")))
        assert report.filter("status <> 'pass'").count() == 0
        totals.append(store.read("customer_orders").selectExpr("sum(total_orders)").first()[0])

    for i, name in enumerate(("orders_20240601.csv", "orders_20240602.csv")):
        drop(landing, name, LINES[i * 5 : i * 5 + 5])
        run(store, landing, tmp_path / "cp", on_batch=refresh)
    assert totals == [5, 10]


def test_archive_by_the_file_source(store, landing, tmp_path):
    archive = tmp_path / "archive"
    for i in range(3):
        drop(landing, f"orders_2024060{i + 1}.csv", LINES[i : i + 1])
        run(store, landing, tmp_path / "cp", archive=str(archive))
    assert store.read("orders").count() == 3
    assert list(archive.rglob("orders_20240601.csv"))  # files move in the course of later batches


def test_a_bad_header_stops_nothing(store, landing, tmp_path):
    drop(landing, "orders_20240601.csv", LINES[:3])
    (landing / "orders_20240602.csv").write_text(ORDERS_CSV.replace("order_id,customer_id", "customer_id,order_id"))
    run(store, landing, tmp_path / "cp")
    assert store.read("orders").count() == 3
    entries = ing.ledger(store).select("file_name", "status", "rows").collect()
    assert sorted(map(tuple, entries)) == [("orders_20240601.csv", "loaded", 3), ("orders_20240602.csv", "rejected", 0)]


def test_batches_and_streams_share_one_line_of_numbers(store, landing, tmp_path):
    drop(landing, "orders_20240601.csv", LINES[:1])
    ing.ingest(store, str(landing))
    for i in (1, 2):  # each stream finds the files of the others taken
        drop(landing, f"orders_2024070{i}.csv", LINES[i : i + 1])
        run(store, landing, tmp_path / f"checkpoint_{i}")
    drop(landing, "orders_20240901.csv", LINES[9:])
    ing.ingest(store, str(landing))
    entries = ing.ledger(store).filter("status = 'loaded'")
    assert entries.count() == len(list(landing.glob("*.csv"))) == store.read("orders").count()
    assert entries.select("batch_id").distinct().count() == store.snapshots("orders").filter("added_records > 0").count()


def test_a_replayed_epoch_replaces_only_its_own_rows(store, landing, tmp_path):
    drop(landing, "orders_20240601.csv", LINES[:2])
    ing.ingest(store, str(landing))
    drop(landing, "orders_20240602.csv", LINES[2:5])
    crashed = []

    def crash_once(store, epoch):
        if not crashed:
            crashed.append(epoch)
            raise RuntimeError("lost after writing")

    with pytest.raises(Exception, match="lost after writing"):
        run(store, landing, tmp_path / "cp", on_batch=crash_once)
    (landing / "other").mkdir()
    drop(landing / "other", "orders_20240603.csv", LINES[5:9])
    ing.ingest(store, str(landing / "other"))
    run(store, landing, tmp_path / "cp", on_batch=crash_once)
    assert rows(store.read("orders").groupBy("batch_id").count()) == [(1, 2), (2, 3), (3, 4)]


def test_a_half_written_micro_batch_is_not_seen(store, landing, tmp_path, monkeypatch):
    drop(landing, "orders_20240601.csv", LINES[:2])
    write = type(store)._write

    def crash(self, df, table, kind, number, buckets=None):
        write(self, df, table, kind, number, buckets)
        raise RuntimeError("lost before the log")

    with monkeypatch.context() as patched:
        patched.setattr(type(store), "_write", crash)
        with pytest.raises(Exception, match="lost before the log"):
            run(store, landing, tmp_path / "cp")
    (landing / "other").mkdir()
    drop(landing / "other", "orders_20240603.csv", LINES[5:9])
    ing.ingest(store, str(landing / "other"))
    assert rows(store.read("orders").groupBy("batch_id").count()) == [(2, 4)]
    run(store, landing, tmp_path / "cp")
    assert rows(store.read("orders").groupBy("batch_id").count()) == [(1, 2), (2, 4)]


def test_stream_entries_name_their_place_in_the_archive(store, landing, tmp_path):
    archive = tmp_path / "archive"
    for i in range(3):
        drop(landing, f"orders_2024060{i + 1}.csv", LINES[i : i + 1])
        run(store, landing, tmp_path / "cp", archive=str(archive))
    (entry,) = ing.ledger(store).filter("file_name = 'orders_20240601.csv'").collect()
    assert (archive / entry["archived_as"]).exists()


def test_names_are_asked_once_per_file(spark):
    line = "'file:/in/orders_20240601.csv/part-' || id % 2 AS uri", "timestamp'2024-06-01' AS modified_at", "9L AS bytes"
    files = checked_files(spark.range(1000).selectExpr(*line))
    top, *below = files._jdf.queryExecution().optimizedPlan().toString().splitlines()
    keys = top.partition("Aggregate [")[2].partition("]")[0]
    assert keys and "regexp_extract" not in keys + "".join(below)
    assert [(r.file_name, r.feed) for r in files.collect()] == [("orders_20240601.csv", "orders")] * 2


def test_names_do_not_depend_on_the_folders_above(spark):
    began = time.time()
    deep = F.concat(F.lit("file:/"), F.repeat(F.lit("a_20240601.csv-"), 1000), F.lit("/orders_20240602.csv/part-0"), F.col("id"))
    names = spark.range(50).select(feed_name(deep).alias("f"), delivery_name(deep).alias("d"), feed_date(deep).cast("string").alias("day"))
    assert {tuple(r) for r in names.collect()} == {("orders", "orders_20240602.csv", "2024-06-02")}
    assert time.time() - began < 20  # each place of the folder's name tried: minutes


def test_only_files_to_load_are_parsed(store, landing, tmp_path, monkeypatch):
    drop(landing, "orders_20240601.csv", LINES[:2])
    ing.ingest(store, str(landing))
    (landing / "orders_20240602.csv").mkdir()
    drop(landing / "orders_20240602.csv", "part-[0].csv", LINES[2:5])  # no pattern
    (landing / "orders_20240603.csv").write_text("")
    parsed, check = [], streaming.checked_rows

    def seen(lines, feed):
        parsed.extend(r["uri"].rsplit("/", 2)[1] for r in lines.select("uri").distinct().collect())
        return check(lines, feed)

    monkeypatch.setattr(streaming, "checked_rows", seen)
    run(store, landing, tmp_path / "cp")
    assert parsed == ["orders_20240602.csv"]
    assert rows(store.read("orders").groupBy("batch_id").count()) == [(1, 2), (2, 3)]
    # A file without a line has no entry.
    assert {r["file_name"] for r in ing.ledger(store).collect()} == {"orders_20240601.csv", "orders_20240602.csv"}

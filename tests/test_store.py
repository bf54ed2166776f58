from datetime import date
from decimal import Decimal as D

import pytest
from conftest import plan, rows
from pyspark.sql import functions as F

from tidemill.operators.compare import version_diff
from tidemill.operators.incremental import (
    altered_figures,
    incremental_append,
    merge_figures,
    refresh_customers,
)
from tidemill.operators.profile import table_profile
from tidemill.plans.build import MART_TESTS, publish_if_passing
from tidemill.plans.marts import orders_per_customer
from tidemill.sources.feeds import ORDERS, read_feed
from tidemill.sources.store import SchemaMismatch, Store


def numbers(spark, start, stop):
    return spark.range(start, stop).select("id", (F.col("id") * 2).alias("v"))


def test_append_is_by_name(spark, store):
    store.append_or_create(numbers(spark, 0, 3), "t")
    store.append_or_create(numbers(spark, 3, 5).select("v", "id"), "t")
    assert rows(store.read("t"), "id", "v", "batch_id") == [(0, 0, 1), (1, 2, 1), (2, 4, 1), (3, 6, 2), (4, 8, 2)]


def test_other_columns_are_refused(spark, store):
    store.append_or_create(numbers(spark, 0, 3), "t")
    with pytest.raises(SchemaMismatch):
        store.append_or_create(numbers(spark, 3, 5).withColumn("x", F.lit(1)), "t")
    with pytest.raises(SchemaMismatch):
        store.append_or_create(numbers(spark, 3, 5).drop("v"), "t")
    assert store.read("t").count() == 3


def test_a_batch_written_again_replaces_itself(spark, store):
    store.append_or_create(numbers(spark, 0, 3), "t")
    for _ in range(2):
        store.append_or_create(numbers(spark, 3, 5), "t", batch_id=2)
    assert store.read("t").count() == 5
    assert store.snapshots("t").count() == 2


def test_an_unlogged_batch_is_not_seen(spark, store):
    store.append_or_create(numbers(spark, 0, 3), "t")
    numbers(spark, 3, 5).write.parquet(f"{store.data_path('t')}/batch_id=2")
    assert store.read("t").count() == 3


def test_as_of_and_history(spark, store):
    for i in range(3):
        store.append_or_create(numbers(spark, i * 10, i * 10 + i + 1), "t")
    assert [store.read("t", n).count() for n in (1, 2, 3, 9)] == [1, 3, 6, 6]
    history = store.history("t").orderBy("snapshot_id")
    assert [(r.snapshot_id, r.operation, r.added_records, r.total_records) for r in history.collect()] == [
        (1, "append", 1, 1),
        (2, "append", 2, 3),
        (3, "append", 3, 6),
    ]
    assert store.data_files("t").agg(F.sum("record_count")).first()[0] == 6


def test_as_of_prunes_batches(spark, store):
    for i in range(3):
        store.append_or_create(numbers(spark, i, i + 1), "t")
    text = plan(store.read("t", 1))
    assert "batch_id" in text.split("PartitionFilters:")[1].splitlines()[0]


def test_rebuild_twice_gives_the_same_rows(spark, store):
    for _ in range(2):
        store.materialize(numbers(spark, 0, 4), "t")
    assert (store.current_version("t"), store.read("t").count()) == (2, 4)
    assert version_diff(store, "t", 1, 2).count() == 0
    assert store.read("t", as_of=1).count() == 4
    assert rows(store.history("t"), "snapshot_id", "total_records") == [(1, 4), (2, 4)]


def test_version_diff(spark, store):
    store.materialize(numbers(spark, 0, 4), "t")
    store.materialize(numbers(spark, 1, 5), "t")
    assert rows(version_diff(store, "t", 1, 2), "id", "side", "copies") == [(0, "removed", 1), (4, "added", 1)]


def test_failing_candidate_stays_invisible(spark, store):
    mart = spark.createDataFrame([(1, "high"), (2, "low")], "customer_id bigint, customer_tier string")
    models = {"stg_customers": mart.select("customer_id")}
    tests = MART_TESTS["customer_orders"]
    passed, report = publish_if_passing(store, mart, "m", tests, models)
    assert passed and report.filter("status = 'fail'").count() == 0
    passed, report = publish_if_passing(store, mart.unionByName(mart), "m", tests, models)
    assert not passed
    assert rows(report.filter("status = 'fail'"), "test", "failures") == [("unique", 2)]
    assert (store.current_version("m"), store.read("m").count()) == (1, 2)
    publish_if_passing(store, mart.limit(1), "m", tests, models)
    assert (store.current_version("m"), store.read("m").count()) == (3, 1)


def test_inventory_and_properties(spark, store):
    assert store.inventory().count() == 0
    for i in range(2):
        store.append_or_create(numbers(spark, i, i + 1), "a")
    store.materialize(numbers(spark, 0, 4), "b")
    store.stage_version(numbers(spark, 0, 4), "b")
    assert rows(store.inventory(), "table_name", "kind", "snapshot_count", "current_snapshot") == [
        ("a", "batch_id", 2, 2),
        ("b", "version", 1, 1),
    ]
    assert dict(map(tuple, store.properties("b").collect())) == {
        "format": "parquet",
        "location": store.data_path("b"),
        "kind": "version",
        "current_snapshot": "1",
    }


def test_another_file_format(spark, store):
    orc = Store(spark, store.root, format="orc")
    for i in range(2):
        orc.append_or_create(numbers(spark, i * 3, i * 3 + 3), "t")
    assert orc.read("t").count() == 6
    assert rows(orc.history("t"), "snapshot_id", "total_records") == [(1, 3), (2, 6)]


def test_missing_table(store):
    assert not store.exists("none")
    with pytest.raises(LookupError):
        store.read("none")


def test_incremental_append_takes_new_keys_only(spark, store):
    incremental_append(store, numbers(spark, 0, 10), "t", ["id"])
    assert incremental_append(store, numbers(spark, 5, 15), "t", ["id"], since="id") == 2
    assert incremental_append(store, numbers(spark, 5, 15), "t", ["id"]) is None
    assert rows(store.read("t"), "id") == sorted([(i,) for i in range(15)], key=repr)


def test_merged_figures_equal_full_figures(spark, seeds):
    orders = read_feed(spark, f"{seeds}/orders.csv", ORDERS.schema)
    old, new = orders.filter("order_id <= 1005"), orders.filter("order_id > 1005")
    merged = merge_figures(orders_per_customer(old), orders_per_customer(new))
    assert rows(merged) == rows(orders_per_customer(orders))


def test_altered_orders_are_computed_afresh(spark, seeds):
    orders = read_feed(spark, f"{seeds}/orders.csv", ORDERS.schema)
    done = F.when(F.col("order_id") == 1004, "completed").otherwise(F.col("status"))
    altered = orders.withColumn("status", done)
    changed = altered.filter("order_id = 1004").select("customer_id")
    got = refresh_customers(orders_per_customer(orders), altered, changed)
    assert rows(got) == rows(orders_per_customer(altered))
    assert rows(got) != rows(orders_per_customer(orders))


def test_profile(spark):
    df = spark.createDataFrame([(1, "a"), (2, None), (2, "b")], "id bigint, s string")
    assert rows(table_profile(df), "column_name", "data_type", "row_count", "null_count", "distinct_count", "min_value", "max_value") == [
        ("id", "bigint", 3, 0, 2, "1", "2"),
        ("s", "string", 3, 1, 2, "a", "b"),
    ]
    assert table_profile(df, approximate=True).count() == 2


def test_a_batch_written_again_keeps_the_columns(spark, store):
    store.append_or_create(numbers(spark, 0, 3), "t")
    store.append_or_create(numbers(spark, 3, 5), "t", batch_id=2)
    with pytest.raises(SchemaMismatch):
        store.append_or_create(numbers(spark, 3, 5).withColumnRenamed("v", "w"), "t", batch_id=2)
    assert rows(store.read("t").drop("batch_id"), "id", "v") == [(i, 2 * i) for i in range(5)]


def test_batches_and_rebuilds_do_not_mix(spark, store):
    store.append_or_create(numbers(spark, 0, 3), "grown")
    store.materialize(numbers(spark, 0, 3), "built")
    with pytest.raises(ValueError):
        store.materialize(numbers(spark, 0, 1), "grown")
    with pytest.raises(ValueError):
        store.append_or_create(numbers(spark, 3, 4), "built")
    assert store.read("grown").count() == store.read("built").count() == 3


def test_only_published_versions_are_read(spark, store):
    bad = store.stage_version(numbers(spark, 0, 99), "t")
    store.reject("t", bad)
    store.materialize(numbers(spark, 0, 3), "t")
    staged = store.stage_version(numbers(spark, 0, 50), "t")
    assert store.read("t", as_of=staged).count() == 3
    with pytest.raises(LookupError):
        store.read("t", as_of=bad)


def test_incremental_append_of_missing_keys_and_copies(spark, store):
    def delivery(*keys):
        return spark.createDataFrame([(k, 1) for k in keys], "id int, v int")

    incremental_append(store, delivery(1, 1, None, None), "t", ["id"])
    assert incremental_append(store, delivery(None, 1), "t", ["id"], since="id") is None
    assert incremental_append(store, delivery(None, 2, 2), "t", ["id"], since="id") == 2
    assert store.read("t").count() == 3


def test_counts_come_from_the_writing_job(spark, store):
    """Every file is listed, empty ones, too; nothing that was written is opened to count it."""
    store.append_or_create(numbers(spark, 0, 100).repartition(5), "t")
    store.append_or_create(numbers(spark, 0, 0), "t")
    files = store.data_files("t")
    got = {r.file_path.rsplit("/", 1)[1]: r.record_count for r in files.collect()}
    true = store.read("t").groupBy("_metadata.file_name").count().collect()
    assert {n: c for n, c in got.items() if c} == {r[0]: r[1] for r in true}
    assert sum(got.values()) == 100 and 0 in got.values()
    assert rows(store.snapshots("t"), "snapshot_id", "added_files", "added_records") == [(1, 5, 100), (2, 1, 0)]
    for df in (files, store.snapshots("t"), store.history("t")):
        assert "/data" not in plan(df)
    assert files.filter("file_size_in_bytes > 0").count() == len(got)


def test_files_of_a_batch_written_again(spark, store):
    store.append_or_create(numbers(spark, 0, 3), "t")
    for n in (50, 7):
        store.append_or_create(numbers(spark, 0, n), "t", batch_id=2)
    assert store.data_files("t").agg(F.sum("record_count")).first()[0] == 10
    assert rows(store.history("t"), "snapshot_id", "total_records") == [(1, 3), (2, 10)]


def test_a_version_published_again(spark, store):
    for n in (4, 9):
        store.materialize(numbers(spark, 0, n), "t")
    store.publish("t", 1)
    assert (store.read("t").count(), store.current_version("t")) == (4, 1)
    assert store.data_files("t").agg(F.sum("record_count")).first()[0] == 4
    assert rows(store.snapshots("t"), "snapshot_id", "added_records") == [(1, 4), (2, 9)]


def test_origins_keep_their_numbers(spark, store):
    assert store.append_or_create(numbers(spark, 0, 2), "t", origin="a/0") == 1
    assert store.append_or_create(numbers(spark, 2, 4), "t") == 2
    assert store.append_or_create(numbers(spark, 4, 6), "t", origin="b/0", above=7) == 8
    assert store.append_or_create(numbers(spark, 0, 1), "t", origin="a/0") == 1
    assert rows(store.read("t"), "id") == [(0,), (2,), (3,), (4,), (5,)]


def rows_read(df):
    """Rows that the scans of a frame gave out when it ran."""
    query = df._jdf.queryExecution()
    df._jdf.collectToPython()
    total, todo = 0, [query.executedPlan()]
    while todo:
        node = todo.pop()
        if "AdaptiveSparkPlan" in node.nodeName():
            todo.append(node.executedPlan())
        elif "QueryStage" in node.nodeName():
            todo.append(node.plan())
        if "Scan" in node.nodeName() and node.metrics().contains("numOutputRows"):
            total += node.metrics().apply("numOutputRows").value()
        todo += [node.children().apply(i) for i in range(node.children().size())]
    return total


def test_versions_with_checksums_are_compared_by_the_buckets_that_differ(spark, store):
    base = numbers(spark, 0, 20_000).unionByName(numbers(spark, 0, 50)).unionByName(spark.range(3000).selectExpr("7 id", "14 v"))
    changed = F.when(F.col("id") == 777, -1).otherwise(F.col("v"))
    altered = base.filter("id <> 5").withColumn("v", changed).unionByName(numbers(spark, 0, 1)).unionByName(numbers(spark, 9, 10))
    for name, buckets in (("plain", None), ("quick", 128)):
        store.materialize(base, name, buckets)
        store.materialize(altered, name, buckets)
    want = rows(version_diff(store, "plain", 1, 2))
    quick = version_diff(store, "quick", 1, 2)
    assert rows(quick) == want and len(want) == 5
    assert rows_read(quick) < 0.1 * 2 * 23_050 < rows_read(version_diff(store, "plain", 1, 2))
    assert version_diff(store, "quick", 2, 2).count() == 0


def test_checksums_of_empty_and_otherwise_shaped_versions(spark, store):
    store.materialize(numbers(spark, 0, 10), "t", 4)
    store.materialize(numbers(spark, 0, 0), "t", 4)
    store.materialize(numbers(spark, 0, 10).withColumn("v", F.col("v").cast("double")), "t", 4)
    assert version_diff(store, "t", 1, 2).count() == 10
    assert version_diff(store, "t", 2, 1).agg(F.max("side")).first()[0] == "added"
    assert version_diff(store, "t", 1, 3).count() == 0


def test_altered_figures_equal_figures_of_the_altered_orders(spark, store):
    order = "order_id bigint, customer_id bigint, order_date date, amount decimal(10,2), status string"

    def orders(*given):
        return spark.createDataFrame([(i, c, date(2024, 1, d), D(a), s) for i, c, d, a, s in given], order)

    keep = [(1, 1, 1, "5.00", "completed"), (2, 1, 9, "7.00", "pending"), (3, None, 2, "1.00", "completed"), (4, None, 7, "1.50", "completed")]
    old = orders(*keep, (5, 1, 20, "3.00", "completed"), (6, 2, 4, "8.00", "completed"), (7, 3, 5, "2.00", "completed"),
                 (7, 3, 5, "2.00", "completed"), (8, None, 1, "9.00", "completed"), (10, 5, 3, "4.00", "pending"), (None, 6, 3, "4.00", "completed"))
    new = orders(*keep, (7, 3, 5, "2.00", "completed"), (9, 4, 6, "2.50", "completed"), (11, 1, 30, "1.00", "completed"),
                 (10, 5, 3, "4.00", "completed"), (12, 2, 4, "1.00", "cancelled"))
    for name, buckets in (("plain", None), ("quick", 16)):
        store.materialize(old, name, buckets)
        store.materialize(new, name, buckets)
        got = altered_figures(orders_per_customer(old), new, version_diff(store, name, 1, 2))
        assert rows(got) == rows(orders_per_customer(new))
    got = altered_figures(orders_per_customer(old), old, version_diff(store, "plain", 1, 1))
    assert rows(got) == rows(orders_per_customer(old))

"""Every job of the package as a query over a data folder, `(spark, folder) -> DataFrame`.

Jobs that keep state write it to a fresh folder below the shared scratch folder.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from datetime import datetime, timedelta
from itertools import islice

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.functions import archive_name, customer_tier, feed_date, feed_name
from tidemill.operators import compare as cmp
from tidemill.operators import incremental as inc
from tidemill.operators import quality
from tidemill.operators.profile import arrow_profile, table_inventory, table_profile
from tidemill.operators.validate import split_valid, type_rules
from tidemill.plans import marts, reports, staging
from tidemill.plans.build import MART_TESTS, PRODUCT_TESTS, STAGING_TESTS, TESTS, publish_if_passing, raw_sources, run_build
from tidemill.session import scratch_dir
from tidemill.sources import tables
from tidemill.sources.feeds import ORDERS, PRODUCTS, Feed, external_table, load_seed, read_feed
from tidemill.sources.ingest import ingest, ledger, quarantine_table
from tidemill.sources.store import Store
from tidemill.streaming.ingest import stream_ingest

Query = Callable[[SparkSession, str], DataFrame]
URGENT = "1-URGENT"
EVENT_TYPES = ("view", "signup", "error", "click", "purchase")
PART_TYPES = ("ECONOMY", "MEDIUM", "PROMO", "LARGE", "SMALL", "STANDARD")
# Buckets of rows with a checksum each, for versions that are compared.
BUCKETS = 16


# -- models ------------------------------------------------------------------------------------


def stg_customers(spark: SparkSession, folder: str) -> DataFrame:
    return staging.stg_customers(tables.customers(spark, folder))


def stg_orders(spark: SparkSession, folder: str, priority: str | None = None) -> DataFrame:
    return staging.stg_orders(tables.orders(spark, folder, priority))


def stg_products(spark: SparkSession, folder: str) -> DataFrame:
    return staging.stg_products(tables.products(spark, folder))


def customer_orders(spark: SparkSession, folder: str) -> DataFrame:
    return marts.customer_orders(stg_customers(spark, folder), stg_orders(spark, folder))


def customer_orders_sparse(spark: SparkSession, folder: str) -> DataFrame:
    """Urgent orders only, so that some customers have none and all tiers occur."""
    return marts.customer_orders(stg_customers(spark, folder), stg_orders(spark, folder, URGENT))


def order_products(spark: SparkSession, folder: str) -> DataFrame:
    return marts.order_products(
        stg_orders(spark, folder), tables.order_items(spark, folder), stg_products(spark, folder)
    )


# -- scans and reports -------------------------------------------------------------------------


def scan_full(spark: SparkSession, folder: str) -> DataFrame:
    return tables.load(spark, folder, "orders")


def pruned_scan(spark: SparkSession, folder: str) -> DataFrame:
    """Filter and six of nine columns on the stored mart."""
    store = _store(spark)
    store.materialize(customer_orders(spark, folder), "customer_orders")
    columns = ("customer_id", "first_name", "last_name", "total_orders", "total_revenue", "customer_tier")
    return tables.pruned_scan(store.read("customer_orders"), F.col("total_orders") >= 2, columns)


def mart_filter_orders(spark: SparkSession, folder: str) -> DataFrame:
    return customer_orders(spark, folder).filter(F.col("total_orders") >= 2)


def mart_filter_tier(spark: SparkSession, folder: str) -> DataFrame:
    return customer_orders(spark, folder).filter(F.col("customer_tier") == "high")


def filter_not_in(spark: SparkSession, folder: str) -> DataFrame:
    return tables.load(spark, folder, "events").filter(~F.col("event_type").isin("view", "click"))


def sorted_multi(spark: SparkSession, folder: str) -> DataFrame:
    return reports.sorted_by(customer_orders(spark, folder), "customer_tier", "first_order_date", "customer_id")


def mart_by_revenue(spark: SparkSession, folder: str) -> DataFrame:
    return reports.by_revenue(customer_orders(spark, folder), "customer_id")


TIER_SQL = """
    SELECT customer_tier,
           count(*) AS customer_count,
           sum(total_orders) AS total_orders,
           cast(round(sum(total_revenue), 2) AS decimal(18,2)) AS total_revenue
    FROM {table}
    GROUP BY customer_tier
    ORDER BY total_revenue DESC
"""


def templated_sql(spark: SparkSession, folder: str) -> DataFrame:
    return tables.query_table(customer_orders(spark, folder), TIER_SQL)


def tier_summary(spark: SparkSession, folder: str) -> DataFrame:
    return reports.tier_summary(customer_orders(spark, folder))


def tier_summary_nonnull(spark: SparkSession, folder: str) -> DataFrame:
    """The summary over a mart in which customers without orders have no tier."""
    mart = customer_orders(spark, folder)
    untiered = mart.withColumn("customer_tier", F.when(F.col("total_orders") > 0, F.col("customer_tier")))
    return reports.tier_summary(untiered, drop_null_keys=True)


def tier_counts(spark: SparkSession, folder: str) -> DataFrame:
    return reports.tier_counts(customer_orders(spark, folder))


def full_names(spark: SparkSession, folder: str) -> DataFrame:
    return reports.customer_names(stg_customers(spark, folder))


def order_list_per_customer(spark: SparkSession, folder: str) -> DataFrame:
    lists = reports.order_lists(stg_orders(spark, folder))
    ids = F.transform("completed_ids", lambda i: i.cast("string"))
    return lists.select("customer_id", "id_block", "orders_in_block", F.array_join(ids, ",").alias("completed_ids"))


def revenue_rank(spark: SparkSession, folder: str) -> DataFrame:
    return reports.revenue_rank(customer_orders(spark, folder))


def rank_within_tier(spark: SparkSession, folder: str) -> DataFrame:
    return reports.rank_within_tier(customer_orders(spark, folder))


def running_revenue(spark: SparkSession, folder: str) -> DataFrame:
    return reports.running_revenue(stg_orders(spark, folder))


# -- data tests --------------------------------------------------------------------------------


def _some_customers(spark: SparkSession, folder: str) -> DataFrame:
    """Customers outside one market segment: parents that some orders lack."""
    c = tables.load(spark, folder, "customer").filter(F.col("c_mktsegment") != "MACHINERY")
    return c.select(F.col("c_custkey").alias("customer_id"))


def test_unique_pass(spark: SparkSession, folder: str) -> DataFrame:
    return quality.test_unique(stg_orders(spark, folder), "stg_orders", "order_id")


def test_unique_fail(spark: SparkSession, folder: str) -> DataFrame:
    return quality.test_unique(tables.order_items(spark, folder), "order_items", ("order_id", "line_number"))


def test_not_null_pass(spark: SparkSession, folder: str) -> DataFrame:
    return quality.test_not_null(stg_orders(spark, folder), "stg_orders", "order_id", "customer_id")


def test_not_null_fail(spark: SparkSession, folder: str) -> DataFrame:
    mart = customer_orders_sparse(spark, folder)
    return quality.test_not_null(mart, "customer_orders", "customer_id", "first_order_date")


def test_relationships_pass(spark: SparkSession, folder: str) -> DataFrame:
    customers = stg_customers(spark, folder)
    return quality.test_relationships(stg_orders(spark, folder), "stg_orders", "customer_id", customers, "customer_id")


def test_relationships_fail(spark: SparkSession, folder: str) -> DataFrame:
    parents = _some_customers(spark, folder)
    return quality.test_relationships(stg_orders(spark, folder), "stg_orders", "customer_id", parents, "customer_id")


def accepted_values_pass(spark: SparkSession, folder: str) -> DataFrame:
    return quality.test_accepted_values(tables.load(spark, folder, "events"), "events", "event_type", EVENT_TYPES)


def accepted_values_fail(spark: SparkSession, folder: str) -> DataFrame:
    """Values that are not accepted, with their rows."""
    accepted = [t for t in EVENT_TYPES if t != "error"]
    return quality.unaccepted_values(tables.load(spark, folder, "events"), "event_type", accepted)


def _models(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    return {
        "stg_customers": stg_customers(spark, folder),
        "stg_orders": stg_orders(spark, folder),
        "order_items": tables.order_items(spark, folder),
        "events": tables.load(spark, folder, "events"),
        "some_customers": _some_customers(spark, folder),
    }


def test_report(spark: SparkSession, folder: str) -> DataFrame:
    spec = {
        **STAGING_TESTS,
        "order_items": {
            ("order_id", "line_number"): ["unique"],
            "order_id": [{"relationships": ("stg_orders", "order_id")}],
        },
        "events": {"event_type": ["not_null", {"accepted_values": [t for t in EVENT_TYPES if t != "error"]}]},
    }
    return quality.run_tests(_models(spark, folder), spec)


def failing_rows_relationships(spark: SparkSession, folder: str) -> DataFrame:
    test = {"relationships": ("some_customers", "customer_id")}
    return quality.failing_rows(_models(spark, folder), "stg_orders", "customer_id", test, ["order_id"])


def failing_rows_unique(spark: SparkSession, folder: str) -> DataFrame:
    key = ("order_id", "line_number")
    spread = ["product_id", "amount"]
    return quality.failing_rows(_models(spark, folder), "order_items", key, "unique", spread)


# -- comparison --------------------------------------------------------------------------------


def _altered_orders(spark: SparkSession, folder: str) -> DataFrame:
    """Orders with changed, missing, added and doubled rows."""
    orders = stg_orders(spark, folder)
    pending, large = F.col("status") == "pending", F.col("amount") >= 400000
    kept = orders.filter(~((F.col("status") == "cancelled") & (F.col("amount") < 5000)))
    changed = kept.withColumn("status", F.when(pending & large, "completed").otherwise(F.col("status")))
    added = orders.filter(F.col("amount") >= 495000).withColumn("order_id", -F.col("order_id") - 1)
    doubled = orders.filter((F.col("status") == "completed") & (F.col("amount") < 3000))
    return changed.unionByName(added).unionByName(doubled)


def _flat(report: DataFrame) -> DataFrame:
    """Report with its lists as text."""
    lists = [f.name for f in report.schema.fields if f.dataType.typeName() == "array"]
    return report.withColumns({name: F.array_join(name, ",") for name in lists})


def compare_equal(spark: SparkSession, folder: str) -> DataFrame:
    store = _store(spark)
    mart = customer_orders(spark, folder)
    store.materialize(mart, "customer_orders")
    return _flat(cmp.compare(mart, store.read("customer_orders"), ["customer_id"], "computed", "stored"))


def compare_diff(spark: SparkSession, folder: str) -> DataFrame:
    altered = _altered_orders(spark, folder).withColumn("note", F.lit("x"))
    return _flat(cmp.compare(stg_orders(spark, folder), altered, ["order_id"], "orders", "altered"))


def compare_diff_rows(spark: SparkSession, folder: str) -> DataFrame:
    rows = cmp.compare_rows(stg_orders(spark, folder), _altered_orders(spark, folder), ["order_id"])
    return _flat(rows.filter(F.col("status") != "matched"))


MART_SQL = """
    WITH figures AS (
        SELECT customer_id,
               count(order_id) AS n,
               sum(amount) FILTER (WHERE status = 'completed') AS revenue,
               min(order_date) AS first_order_date,
               max(order_date) AS last_order_date
        FROM {orders}
        GROUP BY customer_id
    )
    SELECT customer_id, first_name, last_name, email,
           coalesce(n, 0) AS total_orders,
           coalesce(revenue, 0) AS total_revenue,
           first_order_date, last_order_date
    FROM {customers} LEFT JOIN figures USING (customer_id)
"""


def compare_pairs(spark: SparkSession, folder: str) -> DataFrame:
    """The mart by three ways: computed, stored and read back, and written as SQL."""
    store = _store(spark)
    customers, orders = stg_customers(spark, folder), stg_orders(spark, folder)
    computed = marts.customer_orders(customers, orders)
    store.materialize(computed, "customer_orders")
    stored = store.read("customer_orders")
    in_sql = tables.query_tables(spark, MART_SQL, customers=customers, orders=orders)
    in_sql = in_sql.withColumn("customer_tier", customer_tier(F.col("total_orders")))
    frames = {"computed": computed, "stored": stored, "sql": in_sql}
    return _flat(cmp.compare_many(frames, ["customer_id"]))


def except_all_diff(spark: SparkSession, folder: str) -> DataFrame:
    return cmp.multiset_diff(stg_orders(spark, folder), _altered_orders(spark, folder))


# -- feeds -------------------------------------------------------------------------------------


def _store(spark: SparkSession) -> Store:
    return Store(spark, scratch_dir(spark, "store"))


def _csv_products(spark: SparkSession, folder: str) -> str:
    path = scratch_dir(spark, "products")
    tables.products(spark, folder).write.option("header", True).csv(path)
    return path


def csv_scan(spark: SparkSession, folder: str) -> DataFrame:
    """Products written as CSV and read with their declared schema."""
    return read_feed(spark, _csv_products(spark, folder), PRODUCTS.schema)


def external_scan(spark: SparkSession, folder: str) -> DataFrame:
    """Products as a catalog table over CSV files where they lie."""
    path = _csv_products(spark, folder)
    return external_table(spark, f"products_{path.rsplit('-', 1)[1]}", path, PRODUCTS.columns)


def seed_load(spark: SparkSession, folder: str) -> DataFrame:
    """Products loaded as a seed, twice, with one column type overridden."""
    store, path = _store(spark), _csv_products(spark, folder)
    for _ in range(2):
        load_seed(store, path, "products", PRODUCTS.schema, {"price": "decimal(12,3)"})
    return store.read("products")


def feed_routing(spark: SparkSession, folder: str) -> DataFrame:
    """Feeds and dates told from file names of several kinds, one set per event type and day."""
    daily = tables.load(spark, folder, "events").groupBy("event_type", F.to_date("ts").alias("day")).count()
    kind, digits = F.col("event_type"), F.date_format("day", "yyyyMMdd")
    names = F.array(
        F.concat(kind, F.lit("_"), digits, F.lit(".csv")),
        F.concat(F.lit("daily_"), kind, F.lit("_"), digits, F.lit(".csv")),
        F.concat(kind, F.lit("_1.csv")),
        F.concat(kind, F.lit(".csv")),
    )
    files = daily.select(F.explode(names).alias("file_name"), F.col("count").alias("n"))
    files = files.groupBy("file_name").agg(F.sum("n").alias("n"))
    return files.select(
        "file_name", feed_name(F.col("file_name")).alias("feed"), feed_date(F.col("file_name")).alias("feed_date"), "n"
    )


def archive_names(spark: SparkSession, folder: str) -> DataFrame:
    """Archive names of one file per event type and day, loaded at the last event's time."""
    events = tables.load(spark, folder, "events")
    files = events.groupBy("event_type", F.to_date("ts").alias("day")).agg(F.max("ts").alias("loaded_at"))
    name = F.concat("event_type", F.lit("_"), F.date_format("day", "yyyyMMdd"), F.lit(".csv"))
    return files.select(
        name.alias("file_name"), "loaded_at", archive_name(name, F.col("loaded_at")).alias("archived_as")
    )


def _dirty_orders(spark: SparkSession, folder: str) -> DataFrame:
    """Orders as text, some with an amount or a date that is none, some without a customer."""
    o = tables.load(spark, folder, "orders")
    low, pending = F.col("o_orderpriority") == "5-LOW", F.col("o_orderstatus") == "P"
    nobody = pending & (F.col("o_totalprice") < 50000)
    return o.select(
        F.col("o_orderkey").cast("string").alias("order_id"),
        F.when(~nobody, F.col("o_custkey").cast("string")).alias("customer_id"),
        F.when(pending & low, F.lit("2024-13-01"))
        .otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
        .alias("order_date"),
        F.when(low, F.lit("n/a"))
        .otherwise(F.col("o_totalprice").cast("decimal(10,2)").cast("string"))
        .alias("amount"),
        F.col("o_orderstatus").alias("status"),
    )


DIRTY_FEED = Feed("orders", ORDERS.columns, ("order_id", "customer_id"))


def quarantine(spark: SparkSession, folder: str) -> DataFrame:
    """Which of the dirty orders are clean, and what is wrong with the others."""
    clean, bad = split_valid(_dirty_orders(spark, folder), type_rules(DIRTY_FEED.schema, DIRTY_FEED.required))
    clean = clean.withColumn("reasons", F.lit(""))
    return clean.unionByName(bad.withColumn("reasons", F.array_join("reasons", "; "))).select("order_id", "reasons")


def _deliveries(spark: SparkSession, folder: str) -> list[DataFrame]:
    """The dirty orders, one delivery per order status and one of the rest."""
    orders, known = _dirty_orders(spark, folder), ("F", "O", "P")
    rest = ~F.coalesce(F.col("status").isin(*known), F.lit(False))
    parts = [F.col("status") == status for status in known]
    if not orders.filter(rest).isEmpty():
        parts.append(rest)
    return [orders.filter(part) for part in parts]


def _deliver(landing: str, day: int, delivery: DataFrame) -> None:
    """As part files in a folder."""
    delivery.write.option("header", True).csv(f"{landing}/orders_2024010{day}.csv")


def _landing(spark: SparkSession, folder: str) -> str:
    """A landing zone with all deliveries."""
    landing = scratch_dir(spark, "landing")
    for day, delivery in enumerate(_deliveries(spark, folder), start=1):
        _deliver(landing, day, delivery)
    return landing


def _ingested(spark: SparkSession, folder: str) -> Store:
    """Two runs of the ingest over the same landing zone; the second finds nothing to do."""
    store, landing = _store(spark), _landing(spark, folder)
    feeds = {DIRTY_FEED.name: DIRTY_FEED}
    ingest(store, landing, feeds)
    ingest(store, landing, feeds)
    return store


def landing_ingest(spark: SparkSession, folder: str) -> DataFrame:
    return _ingested(spark, folder).read("orders").drop("batch_id")


def landing_quarantine(spark: SparkSession, folder: str) -> DataFrame:
    bad = _ingested(spark, folder).read(quarantine_table("orders"))
    reasons = F.array_join("reasons", "; ").alias("reasons")
    return bad.select("order_id", "customer_id", "order_date", "amount", "status", "file_name", reasons)


def landing_ledger(spark: SparkSession, folder: str) -> DataFrame:
    """What became of each delivery."""
    entries = ledger(_ingested(spark, folder))
    return entries.groupBy("feed", "file_name", "status").agg(
        F.sum("rows").alias("rows"), F.sum("quarantined").alias("quarantined")
    )


def landing_stream(spark: SparkSession, folder: str) -> DataFrame:
    """The same deliveries as a stream, run twice from one checkpoint; the second run finds nothing new."""
    store, landing = _store(spark), _landing(spark, folder)
    checkpoint = scratch_dir(spark, "checkpoint")
    for _ in range(2):
        stream_ingest(store, landing, DIRTY_FEED, checkpoint, every=None).awaitTermination()
    return store.read("orders").drop("batch_id")


def landing_mixed(spark: SparkSession, folder: str) -> DataFrame:
    """Deliveries by batch, by a stream whose micro-batch is lost and run again, by a second stream, and by batch again."""
    store, landing = _store(spark), scratch_dir(spark, "landing")
    feeds, checkpoint = {DIRTY_FEED.name: DIRTY_FEED}, scratch_dir(spark, "checkpoint")
    first, second, *others = _deliveries(spark, folder)
    _deliver(landing, 1, first)
    ingest(store, landing, feeds)
    _deliver(landing, 2, second)

    def lost(store: Store, epoch: int) -> None:
        raise RuntimeError("lost after writing")

    try:
        stream_ingest(store, landing, DIRTY_FEED, checkpoint, every=None, on_batch=lost).awaitTermination()
    except StreamingQueryException:
        pass
    for day, delivery in enumerate(others, start=3):
        _deliver(landing, day, delivery)
    ingest(store, landing, feeds)
    stream_ingest(store, landing, DIRTY_FEED, checkpoint, every=None).awaitTermination()
    stream_ingest(store, landing, DIRTY_FEED, scratch_dir(spark, "checkpoint"), every=None).awaitTermination()
    return store.read("orders").drop("batch_id")


def stream_rebuild(spark: SparkSession, folder: str) -> DataFrame:
    """The mart that readers see after two micro-batches, each with a build: the second brings an order of nobody."""
    store, landing = _store(spark), scratch_dir(spark, "landing")
    checkpoint = scratch_dir(spark, "checkpoint")
    store.materialize(tables.customers(spark, folder), "customers")
    first, second, *_ = _deliveries(spark, folder)

    def build(store: Store, epoch: int) -> None:
        run_build(store, raw_sources(store, ("customers", "orders")))

    nobody = second.limit(1).withColumns({"order_id": F.lit("-1"), "customer_id": F.lit("-1")})
    for day, delivery in ((1, first), (2, second.unionByName(nobody))):
        _deliver(landing, day, delivery)
        stream_ingest(store, landing, DIRTY_FEED, checkpoint, every=None, on_batch=build).awaitTermination()
    return store.read("customer_orders")


# -- tables with history -----------------------------------------------------------------------


def _weeks(events: DataFrame) -> Iterator[DataFrame]:
    """Events week by week, counted from the first day; the bounds reach the Parquet reader."""
    first, last = events.agg(F.min("ts"), F.max("ts")).first()
    if first is None:  # one batch without rows
        yield events
        return
    start = datetime(first.year, first.month, first.day)
    while start <= last:
        end = start + timedelta(days=7)
        yield _between(events, "ts", start, end)
        start = end


def _between(df: DataFrame, column: str, start: datetime, end: datetime) -> DataFrame:
    """Bounds in the type of the column, so that the Parquet reader gets them."""
    dtype = df.schema[column].dataType
    return df.filter((F.col(column) >= F.lit(start).cast(dtype)) & (F.col(column) < F.lit(end).cast(dtype)))


def _weekly(spark: SparkSession, folder: str) -> Store:
    store = _store(spark)
    for batch in _weeks(tables.load(spark, folder, "events")):
        store.append_or_create(batch, "events")
    return store


def ingest_append(spark: SparkSession, folder: str) -> DataFrame:
    return _weekly(spark, folder).read("events")


def read_as_of(spark: SparkSession, folder: str) -> DataFrame:
    return _weekly(spark, folder).read("events", as_of=2)


def snapshots(spark: SparkSession, folder: str) -> DataFrame:
    return _weekly(spark, folder).snapshots("events").select("snapshot_id", "operation", "added_records")


def history(spark: SparkSession, folder: str) -> DataFrame:
    log = _weekly(spark, folder).history("events")
    return log.select("snapshot_id", "operation", "added_records", "total_records")


def store_inventory(spark: SparkSession, folder: str) -> DataFrame:
    """Tables of a store with an appended and a rebuilt one."""
    store = _weekly(spark, folder)
    for _ in range(2):
        store.materialize(stg_products(spark, folder), "products")
    return store.inventory().select("table_name", "kind", "snapshot_count", "current_snapshot")


def data_files(spark: SparkSession, folder: str) -> DataFrame:
    """Rows of each batch as the list of its files tells them, and whether all files have a size."""
    files = _weekly(spark, folder).data_files("events")
    batch = F.regexp_extract("file_path", r"/batch_id=(\d+)/", 1).cast("bigint")
    return files.groupBy(batch.alias("batch_id")).agg(
        F.sum("record_count").alias("record_count"), F.min(F.col("file_size_in_bytes") > 0).alias("sized")
    )


def store_formats(spark: SparkSession, folder: str) -> DataFrame:
    """Products appended in two batches to a store of another file format, cheap ones first."""
    store, products = Store(spark, scratch_dir(spark, "store"), format="orc"), stg_products(spark, folder)
    for part in (F.col("price") < 1200, F.col("price") >= 1200):
        store.append_or_create(products.filter(part), "products")
    return store.read("products")


def store_properties(spark: SparkSession, folder: str) -> DataFrame:
    """Properties of a table that was rebuilt twice; its place differs from run to run."""
    store = _store(spark)
    for _ in range(2):
        store.materialize(stg_products(spark, folder), "products")
    return store.properties("products").filter(F.col("key") != "location")


def incremental_append(spark: SparkSession, folder: str) -> DataFrame:
    """Two overlapping deliveries of events; each event arrives once."""
    store, events = _store(spark), tables.load(spark, folder, "events")
    first, *later = islice(_weeks(events), 2)
    second = later[0] if later else first
    inc.incremental_append(store, first.unionByName(second) if later else first, "events", ["event_id"])
    from_second = second.agg(F.min("ts")).first()[0]
    if from_second is None:
        return store.read("events").drop("batch_id")
    late = events.filter(F.col("ts") >= F.lit(from_second).cast(events.schema["ts"].dataType))
    inc.incremental_append(store, late, "events", ["event_id"], since="ts")
    return store.read("events").drop("batch_id")


def incremental_daily(spark: SparkSession, folder: str) -> DataFrame:
    """Daily figures kept up to date week by week."""
    store = _store(spark)
    for batch in _weeks(tables.load(spark, folder, "events")):
        figures, known = inc.daily_figures(batch), store.read_if_exists("daily")
        store.materialize(figures if known is None else inc.merge_daily(known, figures), "daily")
    return inc.with_mean(store.read("daily"))


def _years(orders: DataFrame) -> Iterator[DataFrame]:
    first, last = orders.agg(F.min(F.year("order_date")), F.max(F.year("order_date"))).first()
    if first is None:
        yield orders
        return
    for year in range(first, last + 1):
        yield _between(orders, "order_date", datetime(year, 1, 1), datetime(year + 1, 1, 1))


def incremental_altered_orders(spark: SparkSession, folder: str) -> DataFrame:
    """The customer mart after orders were changed, removed, doubled and added late, from the rows that differ."""
    store = _store(spark)
    older = store.materialize(stg_orders(spark, folder), "stg_orders", buckets=BUCKETS)
    store.materialize(marts.orders_per_customer(store.read("stg_orders")), "order_figures")
    newer = store.materialize(_altered_orders(spark, folder), "stg_orders", buckets=BUCKETS)
    changes = cmp.version_diff(store, "stg_orders", older, newer)
    store.materialize(inc.altered_figures(store.read("order_figures"), store.read("stg_orders"), changes), "order_figures")
    return inc.mart_from_figures(store, stg_customers(spark, folder), "order_figures")


def incremental_customer_orders(spark: SparkSession, folder: str) -> DataFrame:
    """The customer mart after one batch of orders per year."""
    store = _store(spark)
    for batch in _years(tables.orders(spark, folder)):
        inc.advance_figures(store, staging.stg_orders(batch), "order_figures")
    return inc.mart_from_figures(store, stg_customers(spark, folder), "order_figures")


def version_diff(spark: SparkSession, folder: str) -> DataFrame:
    """Rows of the mart that differ between two rebuilds: urgent orders of all years, then all orders."""
    store = _store(spark)
    older = store.materialize(customer_orders_sparse(spark, folder), "customer_orders")
    newer = store.materialize(customer_orders(spark, folder), "customer_orders")
    return cmp.version_diff(store, "customer_orders", older, newer)


def version_diff_few(spark: SparkSession, folder: str) -> DataFrame:
    """Rows that differ between two nearly equal versions of the orders; only buckets with other checksums are read."""
    store, orders = _store(spark), stg_orders(spark, folder)
    raised = F.when(F.col("amount") >= 499000, F.col("amount") + 1).otherwise(F.col("amount")).cast("decimal(10,2)")
    older = store.materialize(orders, "stg_orders", buckets=BUCKETS)
    doubled = orders.filter(F.col("amount") < 1000)
    newer = store.materialize(orders.withColumn("amount", raised).unionByName(doubled), "stg_orders", buckets=BUCKETS)
    return cmp.version_diff(store, "stg_orders", older, newer)


def published_mart(spark: SparkSession, folder: str) -> DataFrame:
    """The mart as readers see it after a good candidate and one that fails its tests."""
    store = _store(spark)
    mart = customer_orders(spark, folder)
    models = {"stg_customers": stg_customers(spark, folder)}
    publish_if_passing(store, mart, "customer_orders", MART_TESTS["customer_orders"], models)
    bad = mart.unionByName(mart.filter(F.col("customer_tier") == "high"))
    publish_if_passing(store, bad, "customer_orders", MART_TESTS["customer_orders"], models)
    return store.read("customer_orders")


def build_report(spark: SparkSession, folder: str) -> DataFrame:
    sources = {
        "customers": tables.customers(spark, folder),
        "orders": tables.orders(spark, folder),
        "products": tables.products(spark, folder),
        "order_items": tables.order_items(spark, folder),
    }
    products = {**PRODUCT_TESTS["stg_products"], "category": ["not_null", {"accepted_values": list(PART_TYPES)}]}
    return run_build(_store(spark), sources, tests={**TESTS, "stg_products": products})


# -- inspection --------------------------------------------------------------------------------


def profile_orders(spark: SparkSession, folder: str) -> DataFrame:
    return table_profile(stg_orders(spark, folder)).drop("nullable")


def inventory(spark: SparkSession, folder: str) -> DataFrame:
    frames = {name: tables.load(spark, folder, name) for name in tables.TABLES}
    return table_inventory(frames).select("table_name", "row_count", "column_count")


def arrow_size(spark: SparkSession, folder: str) -> DataFrame:
    """Rows and columns of the mart as Arrow, and whether it takes at least a byte for each value."""
    got = arrow_profile(customer_orders(spark, folder))
    return got.select("rows", "columns", (F.col("bytes") >= F.col("rows") * F.col("columns")).alias("measured"))


QUERIES: dict[str, Query] = {
    "stg_customers": stg_customers,
    "stg_orders": stg_orders,
    "stg_products": stg_products,
    "customer_orders": customer_orders,
    "customer_orders_sparse": customer_orders_sparse,
    "order_products": order_products,
    "scan_full": scan_full,
    "pruned_scan": pruned_scan,
    "mart_filter_orders": mart_filter_orders,
    "mart_filter_tier": mart_filter_tier,
    "mart_by_revenue": mart_by_revenue,
    "filter_not_in": filter_not_in,
    "sorted_multi": sorted_multi,
    "templated_sql": templated_sql,
    "tier_summary": tier_summary,
    "tier_summary_nonnull": tier_summary_nonnull,
    "tier_counts": tier_counts,
    "full_name": full_names,
    "order_list_per_customer": order_list_per_customer,
    "revenue_rank": revenue_rank,
    "rank_within_tier": rank_within_tier,
    "running_revenue": running_revenue,
    "test_unique_pass": test_unique_pass,
    "test_unique_fail": test_unique_fail,
    "test_not_null_pass": test_not_null_pass,
    "test_not_null_fail": test_not_null_fail,
    "test_relationships_pass": test_relationships_pass,
    "test_relationships_fail": test_relationships_fail,
    "accepted_values_pass": accepted_values_pass,
    "accepted_values_fail": accepted_values_fail,
    "test_report": test_report,
    "failing_rows_relationships": failing_rows_relationships,
    "failing_rows_unique": failing_rows_unique,
    "compare_equal": compare_equal,
    "compare_diff": compare_diff,
    "compare_diff_rows": compare_diff_rows,
    "compare_pairs": compare_pairs,
    "except_all_diff": except_all_diff,
    "csv_scan": csv_scan,
    "external_scan": external_scan,
    "seed_load": seed_load,
    "feed_routing": feed_routing,
    "archive_name": archive_names,
    "quarantine": quarantine,
    "landing_ingest": landing_ingest,
    "landing_quarantine": landing_quarantine,
    "landing_ledger": landing_ledger,
    "landing_stream": landing_stream,
    "landing_mixed": landing_mixed,
    "stream_rebuild": stream_rebuild,
    "ingest_append": ingest_append,
    "incremental_append": incremental_append,
    "incremental_daily": incremental_daily,
    "incremental_customer_orders": incremental_customer_orders,
    "incremental_altered_orders": incremental_altered_orders,
    "read_as_of": read_as_of,
    "version_diff": version_diff,
    "version_diff_few": version_diff_few,
    "published_mart": published_mart,
    "build_report": build_report,
    "snapshots": snapshots,
    "history": history,
    "store_inventory": store_inventory,
    "store_formats": store_formats,
    "store_properties": store_properties,
    "table_profile": profile_orders,
    "table_inventory": inventory,
    "data_files": data_files,
    "arrow_profile": arrow_size,
}

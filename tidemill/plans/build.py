"""The whole build: raw tables, staging, marts, tests, in order of dependence."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession

from tidemill.functions.columns import TIERS
from tidemill.operators.quality import Spec, run_tests
from tidemill.plans.marts import customer_orders, order_products
from tidemill.plans.staging import stg_customers, stg_orders, stg_products
from tidemill.sources.feeds import FEEDS, load_seed
from tidemill.sources.store import Store

STAGING_TESTS: Spec = {
    "stg_customers": {"customer_id": ["unique", "not_null"]},
    "stg_orders": {
        "order_id": ["unique", "not_null"],
        "customer_id": ["not_null", {"relationships": ("stg_customers", "customer_id")}],
    },
}
PRODUCT_TESTS: Spec = {
    "stg_products": {
        "product_id": ["unique", "not_null"],
        "price": ["not_null"],
        "category": ["not_null", {"accepted_values": ["electronics", "accessories", "other"]}],
    }
}
MART_TESTS: Spec = {
    "customer_orders": {
        "customer_id": ["unique", "not_null", {"relationships": ("stg_customers", "customer_id")}],
        "customer_tier": [{"accepted_values": list(TIERS)}],
    },
    "order_products": {
        "order_id": ["not_null", {"relationships": ("stg_orders", "order_id")}],
        "product_name": ["not_null"],
    },
}
TESTS: Spec = {**STAGING_TESTS, **PRODUCT_TESTS, **MART_TESTS}

STAGING: dict[str, tuple[str, Callable[[DataFrame], DataFrame]]] = {
    "stg_customers": ("customers", stg_customers),
    "stg_orders": ("orders", stg_orders),
    "stg_products": ("products", stg_products),
}
MARTS: dict[str, tuple[tuple[str, ...], Callable[..., DataFrame]]] = {
    "customer_orders": (("stg_customers", "stg_orders"), customer_orders),
    "order_products": (("stg_orders", "order_items", "stg_products"), order_products),
}
LAYERS = ("staging", "marts")


def staging_models(sources: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """Lazy staging frames for the raw tables at hand."""
    return {name: build(sources[raw]) for name, (raw, build) in STAGING.items() if raw in sources}


def register_views(models: Mapping[str, DataFrame]) -> None:
    for name, df in models.items():
        df.createOrReplaceTempView(name)


def seed(store: Store, folder: str, names: Sequence[str] = ("customers", "orders")) -> None:
    """Replace raw tables by the CSV files of a folder."""
    for name in names:
        load_seed(store, f"{folder}/{name}.csv", name, FEEDS[name].schema)


def raw_sources(store: Store, names: Sequence[str] = tuple(FEEDS)) -> dict[str, DataFrame]:
    """Raw tables that exist, without the batch numbers."""
    found = {name: store.read_if_exists(name) for name in names}
    return {name: df.drop("batch_id") for name, df in found.items() if df is not None}


def run_build(
    store: Store,
    sources: Mapping[str, DataFrame],
    select: Sequence[str] = LAYERS,
    tests: Spec | None = None,
) -> DataFrame:
    """Stage, test, build marts, test; returns the report of all tests that ran.

    A mart is built as a new version and published only if its tests pass. Nothing downstream of a
    model with failing tests is built; its tests are reported as skipped.
    """
    tests = TESTS if tests is None else tests
    models = {**sources, **staging_models(sources)}
    reports: list[DataFrame] = []
    failed: set[str] = set()
    if "staging" in select:
        staged = {m: spec for m, spec in tests.items() if m in models}
        if staged:
            failed |= _test(store.spark, models, staged, reports)
        register_views({n: models[n] for n in STAGING if n in models})
    if "marts" in select:
        for name, (needs, build) in MARTS.items():
            if any(n not in models for n in needs):
                continue
            if failed & set(needs):
                failed.add(name)
                if name in tests:
                    reports.append(_skipped(store.spark, name, tests[name]))
                continue
            version = store.stage_version(build(*(models[n] for n in needs)), name)
            models[name] = store.read_version(name, version)
            if name in tests and name in _test(store.spark, models, {name: tests[name]}, reports):
                failed.add(name)
                store.reject(name, version)
            else:
                store.publish(name, version)
    if not reports:
        return store.spark.createDataFrame([], REPORT_SCHEMA)
    return reduce(DataFrame.unionByName, reports)


REPORT_SCHEMA = "model string, column_name string, test string, failures bigint, status string"


def _test(spark: SparkSession, models: Mapping[str, DataFrame], spec: Spec, reports: list[DataFrame]) -> set[str]:
    """Run tests once, keep the report, return the models that failed."""
    rows = run_tests(models, spec).collect()  # one row per declared test
    reports.append(spark.createDataFrame(rows, REPORT_SCHEMA))
    return {row["model"] for row in rows if row["status"] != "pass"}


def _skipped(spark: SparkSession, model: str, columns: Mapping) -> DataFrame:
    rows = []
    for column, declared in columns.items():
        label = column if isinstance(column, str) else ", ".join(column)
        rows += [(model, label, t if isinstance(t, str) else next(iter(t)), None, "skipped") for t in declared]
    return spark.createDataFrame(rows, REPORT_SCHEMA)


def publish_if_passing(
    store: Store, df: DataFrame, table: str, columns: Mapping, models: Mapping[str, DataFrame] | None = None
) -> tuple[bool, DataFrame]:
    """Write the next version apart, test it there, and show it to readers only if all tests pass."""
    version = store.stage_version(df, table)
    candidate = {**(models or {}), table: store.read_version(table, version)}
    reports: list[DataFrame] = []
    failed = _test(store.spark, candidate, {table: columns}, reports)
    if failed:
        store.reject(table, version)
    else:
        store.publish(table, version)
    return not failed, reports[0]

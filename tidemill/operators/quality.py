"""Declarative data tests: unique, not_null, relationships, accepted_values.

A test is a query for failing results; it passes when there are none. `failures` counts what such
a query returns: values that occur twice, rows without a value, rows without a parent, values
that are not accepted.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemill.operators.lookup import lookup_join

# {model: {column: ["unique", "not_null", {"accepted_values": [...]}, {"relationships": (model, column)}]}}
# A column may be a tuple of columns for `unique`.
Spec = Mapping[str, Mapping[str | tuple[str, ...], Sequence]]
REPORT = ("model", "column_name", "test")


def _label(column: str | Sequence[str]) -> str:
    return column if isinstance(column, str) else ", ".join(column)


def _report(counted: DataFrame, model: str, column: str | Sequence[str], test: str) -> DataFrame:
    """`counted` has one row with one column, failures."""
    return counted.select(
        F.lit(model).alias("model"),
        F.lit(_label(column)).alias("column_name"),
        F.lit(test).alias("test"),
        F.coalesce(F.col("failures"), F.lit(0)).cast("bigint").alias("failures"),
    ).withColumn("status", F.when(F.col("failures") == 0, "pass").otherwise("fail"))


def duplicate_values(df: DataFrame, column: str | Sequence[str]) -> DataFrame:
    """Values that occur more than once, with their number of rows; NULL is no value."""
    columns = [column] if isinstance(column, str) else list(column)
    present = reduce(lambda a, b: a & b, (F.col(c).isNotNull() for c in columns))
    counts = df.filter(present).groupBy(*columns).agg(F.count(F.lit(1)).alias("n_records"))
    return counts.filter(F.col("n_records") > 1)


def unaccepted_values(df: DataFrame, column: str, accepted: Sequence) -> DataFrame:
    """Values outside the accepted list, with their number of rows; NULL is no value."""
    return (
        df.filter(~F.col(column).isin(list(accepted)))
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("n_records"))
    )


def null_rows(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNull())


def orphan_values(child: DataFrame, column: str, parent: DataFrame, field: str) -> DataFrame:
    """Child values without a parent, with their number of rows.

    Child rows are counted by value before the join, so both sides hold each value once.
    """
    counts = child.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n_records"))
    return counts.join(parent.select(F.col(field).alias(column)).distinct(), column, "left_anti")


def orphan_rows(
    child: DataFrame, column: str, parent: DataFrame, field: str, spread_by: Sequence[str]
) -> DataFrame:
    """Child rows whose value has no parent."""
    known = parent.select(F.col(field).alias(column)).distinct().withColumn("_known", F.lit(True))
    joined = lookup_join(child.filter(F.col(column).isNotNull()), known, column, spread_by)
    return joined.filter(F.col("_known").isNull()).select(*child.columns)


def test_unique(df: DataFrame, model: str, column: str | Sequence[str]) -> DataFrame:
    failing = duplicate_values(df, column).agg(F.count(F.lit(1)).alias("failures"))
    return _report(failing, model, column, "unique")


def test_not_null(df: DataFrame, model: str, *columns: str) -> DataFrame:
    """One row per column, all counted in one pass over the model."""
    counted = df.agg(*(F.count_if(F.col(c).isNull()).alias(c) for c in columns))
    pairs = F.array(*(F.struct(F.lit(c).alias("column_name"), F.col(c).alias("failures")) for c in columns))
    rows = counted.select(F.inline(pairs))
    return rows.select(
        F.lit(model).alias("model"), "column_name", F.lit("not_null").alias("test"), "failures"
    ).withColumn("status", F.when(F.col("failures") == 0, "pass").otherwise("fail"))


def test_relationships(child: DataFrame, model: str, column: str, parent: DataFrame, field: str) -> DataFrame:
    failing = orphan_values(child, column, parent, field).agg(F.sum("n_records").alias("failures"))
    return _report(failing, model, column, "relationships")


def test_accepted_values(df: DataFrame, model: str, column: str, accepted: Sequence) -> DataFrame:
    failing = unaccepted_values(df, column, accepted).agg(F.count(F.lit(1)).alias("failures"))
    return _report(failing, model, column, "accepted_values")


def _common_type(child: DataFrame, column: str, parent: DataFrame, field: str) -> T.DataType:
    """Type in which Spark would compare the two columns."""
    return child.select(column).union(parent.select(field)).schema[0].dataType


def run_tests(models: Mapping[str, DataFrame], spec: Spec) -> DataFrame:
    """Report with one row per declared test: model, column_name, test, failures, status.

    All tests of all models become one job that reads each model once. A row gives one entry for each test it has a say in:
    the test's number, whether it speaks as a parent, and its value as 128 bits of hash. Entries are counted
    by test and value, before the shuffle first, so a value with most of the rows is one entry of each task.
    """
    declared: list[tuple[str, str, str]] = []
    entries: dict[str, list[Column]] = {}

    def enter(model: str, applies: Column, test: int, parent: bool, *values: Column) -> None:
        hashes = [F.xxhash64(F.lit(i), *values) if values else F.lit(0).cast("bigint") for i in (1, 2)]
        number = F.when(applies, F.lit(test))
        parts = (number.alias("number"), F.lit(parent).alias("parent"), hashes[0].alias("h1"), hashes[1].alias("h2"))
        entries.setdefault(model, []).append(F.struct(*parts))

    for model, columns in spec.items():
        for column, tests in columns.items():
            names = [column] if isinstance(column, str) else list(column)
            present = reduce(and_, (F.col(c).isNotNull() for c in names))
            for test in tests:
                kind = test if isinstance(test, str) else next(iter(test))
                number = len(declared)
                declared.append((model, _label(column), kind))
                if kind == "not_null":
                    enter(model, F.col(column).isNull(), number, False)
                elif kind == "unique":
                    enter(model, present, number, False, *(F.col(c) for c in names))
                elif kind == "accepted_values":
                    enter(model, present & ~F.col(column).isin(list(test[kind])), number, False, F.col(column))
                elif kind == "relationships":
                    parent, field = test[kind]
                    dtype = _common_type(models[model], column, models[parent], field)
                    enter(model, present, number, False, F.col(column).cast(dtype))
                    enter(parent, F.col(field).isNotNull(), number, True, F.col(field).cast(dtype))
                else:
                    raise ValueError(f"unknown test {test!r} on {model}.{_label(column)}")
    said = reduce(
        DataFrame.unionByName, (models[m].select(F.inline(F.array(*e))).filter(F.col("number").isNotNull()) for m, e in entries.items())
    )
    values = said.groupBy("number", "h1", "h2").agg(F.count_if(~F.col("parent")).alias("n"), F.max("parent").alias("known"))
    number_of = {kind: [i for i, d in enumerate(declared) if d[2] == kind] for kind in {d[2] for d in declared}}
    is_kind = lambda kind: F.col("number").isin(number_of.get(kind, []))
    failing = (
        F.when(is_kind("not_null"), F.col("n"))
        .when(is_kind("unique"), (F.col("n") > 1).cast("bigint"))
        .when(is_kind("relationships"), F.when(F.col("known"), 0).otherwise(F.col("n")))
        .otherwise(1)
    )
    counted = values.groupBy("number").agg(F.sum(failing).alias("failures"))
    rows = F.array(*(F.struct(F.lit(i).alias("number"), *(F.lit(v).alias(n) for v, n in zip(d, REPORT))) for i, d in enumerate(declared)))
    all_tests = models[next(iter(spec))].sparkSession.range(1).select(F.inline(rows))
    failures = F.coalesce("failures", F.lit(0)).cast("bigint")
    return all_tests.join(F.broadcast(counted), "number", "left").select(
        *REPORT, failures.alias("failures"), F.when(failures == 0, "pass").otherwise("fail").alias("status")
    )


def failing_rows(models: Mapping[str, DataFrame], model: str, column: str, test, spread_by: Sequence[str]) -> DataFrame:
    """Rows of the model that make a test fail."""
    df = models[model]
    if test == "not_null":
        return null_rows(df, column)
    if test == "unique":
        columns = [column] if isinstance(column, str) else list(column)
        key = F.struct(*columns)
        twice = duplicate_values(df, column).select(key.alias("_key"), F.lit(True).alias("_twice"))
        return lookup_join(df.withColumn("_key", key), twice, "_key", spread_by).filter("_twice").select(*df.columns)
    if "accepted_values" in test:
        return df.filter(~F.col(column).isin(list(test["accepted_values"])))
    parent, field = test["relationships"]
    return orphan_rows(df, column, models[parent], field, spread_by)


# pytest must not take the functions above for its own.
for _function in (test_unique, test_not_null, test_relationships, test_accepted_values):
    _function.__test__ = False

"""Separation of good rows from bad ones."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

REASONS = "reasons"


def with_reasons(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """Add the names of the rules each row breaks. A rule is a condition for a bad row.

    Unlike `array_compact`, whose function per element has the conditions below it interpreted, removing a value is compiled.
    """
    none = ""
    while none in rules:
        none += " "
    broken = [F.when(F.coalesce(bad, F.lit(False)), F.lit(name)).otherwise(F.lit(none)) for name, bad in rules.items()]
    found = F.array_remove(F.array(*broken), none) if broken else F.array().cast("array<string>")
    return df.withColumn(REASONS, found)


def type_rules(schema: T.StructType, required: tuple[str, ...] = ()) -> dict[str, Column]:
    """Rules for text columns: a text that cannot take the declared type, a missing required value."""
    rules = {
        f"bad {f.dataType.simpleString()} in {f.name}": F.col(f.name).isNotNull()
        & F.col(f.name).try_cast(f.dataType).isNull()
        for f in schema.fields
        if not isinstance(f.dataType, T.StringType)
    }
    rules.update({f"missing {name}": F.col(name).isNull() for name in required})
    return rules


def typed(df: DataFrame, schema: T.StructType) -> DataFrame:
    return df.select(*(F.col(f.name).try_cast(f.dataType).alias(f.name) for f in schema.fields))


def split_valid(df: DataFrame, rules: Mapping[str, Column]) -> tuple[DataFrame, DataFrame]:
    """Rows that break no rule, and the other rows with the rules they break."""
    marked = with_reasons(df, rules)
    return marked.filter(F.size(REASONS) == 0).drop(REASONS), marked.filter(F.size(REASONS) > 0)

"""Comparison of datasets: by key, as multisets, and in pairs."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


# What can be said of a key.
STATUSES = ("matched", "changed", "left_only", "right_only", "duplicate")


def plain_names(df: DataFrame) -> DataFrame:
    """Column names without a `table.` prefix."""
    return df.toDF(*(name.split(".")[-1] for name in df.columns))


def _comparable(left: T.DataType, right: T.DataType) -> bool:
    if isinstance(left, T.NumericType) and isinstance(right, T.NumericType):
        return True
    return type(left) is type(right)


def schema_differences(left: DataFrame, right: DataFrame) -> dict[str, list[str]]:
    """Columns on one side only, and columns whose types cannot be compared as they are."""
    l, r = plain_names(left).schema, plain_names(right).schema
    return {
        "left_only_columns": [c for c in l.names if c not in r.names],
        "right_only_columns": [c for c in r.names if c not in l.names],
        "retyped_columns": [
            c for c in l.names if c in r.names and not _comparable(l[c].dataType, r[c].dataType)
        ],
    }


def _side_by_side(frames: Sequence[DataFrame], key: Sequence[str]) -> DataFrame:
    """One row per key: how often each frame holds it (`_n<i>`), and each frame's values (`_<i>_<column>`).

    All frames go through one aggregation by key. There is no join, so duplicates cannot multiply,
    copies are merged before the shuffle, NULL keys meet each other, and each frame is read once.
    """
    tagged = [
        df.select(*key, F.lit(i).alias("_side"), *(F.col(c).alias(f"_{i}_{c}") for c in df.columns if c not in key))
        for i, df in enumerate(frames)
    ]
    both = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)
    values = [c for c in both.columns if c not in key and c != "_side"]
    return both.groupBy(*key).agg(
        *(F.count_if(F.col("_side") == i).alias(f"_n{i}") for i in range(len(frames))),
        *(F.first(c, ignorenulls=True).alias(c) for c in values),
    )


class _Pair:
    """Expressions over `_side_by_side` for frames i and j."""

    def __init__(self, frames: Sequence[DataFrame], key: Sequence[str], i: int, j: int):
        left, right = frames[i], frames[j]
        self.schema = schema_differences(left, right)
        self.shared = [c for c in left.columns if c in right.columns and c not in key]
        nl, nr = F.col(f"_n{i}"), F.col(f"_n{j}")
        single = (nl == 1) & (nr == 1)
        self.differs = {}
        for c in self.shared:
            l, r = F.col(f"_{i}_{c}"), F.col(f"_{j}_{c}")
            if c in self.schema["retyped_columns"]:
                l, r = l.cast("string"), r.cast("string")
            self.differs[c] = single & ~l.eqNullSafe(r)
        changed = reduce(lambda a, b: a | b, self.differs.values(), F.lit(False))
        self.status = (
            F.when((nl == 0) & (nr == 0), None)
            .when((nl > 1) | (nr > 1), "duplicate")
            .when(nr == 0, "left_only")
            .when(nl == 0, "right_only")
            .when(changed, "changed")
            .otherwise("matched")
        )


def _names_where(conditions: Mapping[str, Column]) -> Column:
    """Array of the names whose condition holds."""
    names = [F.when(condition, F.lit(name)) for name, condition in conditions.items()]
    return F.array_compact(F.array(*names)) if names else F.array().cast("array<string>")


def compare_rows(left: DataFrame, right: DataFrame, key: Sequence[str]) -> DataFrame:
    """One row per key: its status and the columns that differ.

    Status is matched, changed, left_only, right_only, or duplicate when a side holds the key more
    than once.
    """
    frames = [plain_names(left), plain_names(right)]
    pair = _Pair(frames, key, 0, 1)
    return _side_by_side(frames, key).select(
        *key, pair.status.alias("status"), _names_where(pair.differs).alias("changed_columns")
    )


def compare_many(frames: Mapping[str, DataFrame], key: Sequence[str]) -> DataFrame:
    """One row per pair of named datasets: keys by status, changed columns, schema differences."""
    names = list(frames)
    plain = [plain_names(df) for df in frames.values()]
    flags, counts, reports = [], [], []
    for i, j in combinations(range(len(plain)), 2):
        pair = _Pair(plain, key, i, j)
        tag = f"_{i}_{j}"
        flags.append(pair.status.alias(f"status{tag}"))
        counts += [F.count_if(F.col(f"status{tag}") == s).alias(f"{s}{tag}") for s in STATUSES]
        for c, differs in pair.differs.items():
            flags.append(differs.alias(f"differs{tag}_{c}"))
            counts.append(F.count_if(f"differs{tag}_{c}").alias(f"differing{tag}_{c}"))
        apart = reduce(lambda a, b: a + b, (F.col(f"{s}{tag}") for s in STATUSES if s != "matched"))
        reports.append(
            F.struct(
                F.lit(names[i]).alias("left_name"),
                F.lit(names[j]).alias("right_name"),
                ((apart == 0) & F.lit(not any(pair.schema.values()))).alias("identical"),
                *(F.col(f"{s}{tag}").alias("duplicate_keys" if s == "duplicate" else s) for s in STATUSES),
                _names_where({c: F.col(f"differing{tag}_{c}") > 0 for c in pair.shared}).alias("changed_columns"),
                *(
                    F.array(*map(F.lit, columns)).cast("array<string>").alias(kind)
                    for kind, columns in pair.schema.items()
                ),
            )
        )
    return _side_by_side(plain, key).select(*flags).agg(*counts).select(F.inline(F.array(*reports)))


def compare(
    left: DataFrame, right: DataFrame, key: Sequence[str], left_name: str = "left", right_name: str = "right"
) -> DataFrame:
    """One-row report on two datasets."""
    if left_name == right_name:
        raise ValueError("the two datasets need different names")
    return compare_many({left_name: left, right_name: right}, key)


def multiset_diff(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows that one side holds more often than the other, with the side and the surplus.

    EXCEPT ALL both ways in one aggregation; copies are merged before the shuffle.
    """
    columns = left.columns
    tagged = left.withColumn("_copies", F.lit(1)).unionByName(right.withColumn("_copies", F.lit(-1)))
    net = tagged.groupBy(*columns).agg(F.sum("_copies").alias("_net")).filter(F.col("_net") != 0)
    return net.select(
        *columns,
        F.when(F.col("_net") > 0, "left").otherwise("right").alias("side"),
        F.abs("_net").cast("bigint").alias("copies"),
    )


def version_diff(store, table: str, older: int, newer: int) -> DataFrame:
    """Rows removed and rows added between two versions of a table, with the number of copies.

    Versions laid out in the same buckets are compared by their checksums first; rows of equal buckets are not read.
    """
    known = store.differing_buckets(table, older, newer)
    if known is None:
        left, right = store.read_version(table, older), store.read_version(table, newer)
    else:
        left, right = (store.read_buckets(table, version, known[1]) for version in (older, newer))
    diff = multiset_diff(left, right)
    return diff.withColumn("side", F.when(F.col("side") == "left", "removed").otherwise("added"))

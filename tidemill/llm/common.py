"""Helpers shared by the operators of this folder."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.session import scratch_dir

# Fixed value: the white space of the contracts; everything else is part of a word.
SPACE = r"[\x20\x09-\x0D]+"
# A task works on so many bytes of text at a time, so its memory does not grow with the batch.
PIECE = 1 << 20
# Rows that pass to Python at once while a table is written.
BATCH, BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch", 1000
# Bits of a membership filter: fixed, so what is sent to the executors never grows with the data.
BLOOM_BITS = 1 << 23


def documents(spark: SparkSession, folder: str) -> DataFrame:
    """`doc_id` and `text` of the whole table; other columns are left unread."""
    return spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")


def written(df: DataFrame, label: str) -> DataFrame:
    """The frame as a table in the shared folder: lineage ends here and a lost executor costs nothing before it."""
    spark = df.sparkSession
    path = scratch_dir(spark, label)
    before = spark.conf.get(BATCH, None)
    spark.conf.set(BATCH, min(int(before or BATCH_ROWS), BATCH_ROWS))
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(BATCH, before) if before else spark.conf.unset(BATCH)
    # Shuffle files go when the driver collects the plan they belong to, which it may not do for half an hour.
    spark.sparkContext._jvm.System.gc()
    return spark.read.schema(df.schema).parquet(path)


def pieces(batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = PIECE) -> Iterator[pa.RecordBatch]:
    """The same rows in slices of about `limit` bytes of one text column (a longer text is a slice of its own)."""
    for batch in batches:
        if not batch.num_rows:
            continue
        ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False))
        start = 0
        while start < batch.num_rows:
            base = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, base + limit, side="right")))
            yield batch.slice(start, stop - start)
            start = stop


def word_count(text: Column) -> Column:
    """Words between white space; NULL counts as an empty text."""
    trimmed = F.regexp_replace(F.coalesce(text, F.lit("")), rf"^{SPACE}|{SPACE}$", "")
    return F.when(trimmed == "", F.lit(0)).otherwise(F.size(F.split(trimmed, SPACE))).cast("bigint")


@dataclass
class Membership:
    """A filter of fixed size that knows ids for certain which are not in a set, and guesses the rest."""

    bits: object  # broadcast numpy array

    @staticmethod
    def bit(column: str) -> Column:
        return F.pmod(F.xxhash64(column), F.lit(BLOOM_BITS)).cast("int")

    @classmethod
    def words(cls, ids: DataFrame, column: str) -> DataFrame:
        """The filter as a table: `w, b`, the 64 bits from 64 * w, where any is set."""
        bit = cls.bit(column)
        mask = F.call_function("shiftleft", F.lit(1).cast("bigint"), bit % 64)
        set_ = ids.where(F.col(column).isNotNull()).select((bit / 64).cast("int").alias("w"), mask.alias("b"))
        return set_.groupBy("w").agg(F.bit_or("b").alias("b"))

    @classmethod
    def of(cls, ids: DataFrame, column: str) -> Membership:
        """At most BLOOM_BITS / 64 rows come to the driver, whatever the number of ids."""
        words = cls.words(ids, column).toArrow()
        bits = np.zeros(BLOOM_BITS // 64, np.int64)
        bits[words["w"].to_numpy()] = words["b"].to_numpy()
        return cls(ids.sparkSession.sparkContext.broadcast(bits.view(np.uint64)))


def holds(bits: np.ndarray, bit: np.ndarray) -> np.ndarray:
    """Which positions are set."""
    return (bits[bit >> 6] >> (bit & 63).astype(np.uint64)) & np.uint64(1) == 1


def without(docs: DataFrame, leaving: DataFrame, doubtful: DataFrame | None = None) -> DataFrame:
    """The documents whose id is not in `leaving`, with all their columns; rows without an id stay.

    Of rows with an id in `doubtful`, those of one text stay once. A filter of fixed size lets most documents pass where
    they lie; only those that it cannot rule out are joined with the ids.
    """
    asked = leaving.select("doc_id") if doubtful is None else leaving.select("doc_id").union(doubtful.select("doc_id"))
    # The table of the filter is small, and read by both of the joins.
    bits = written(Membership.words(asked, "doc_id").toDF("_w", "_b"), "leaving-bits")
    bit = Membership.bit("doc_id")
    found = F.call_function("shiftright", F.col("_b"), bit % 64).bitwiseAND(F.lit(1)) == 1
    here = ((bit / 64).cast("int") == F.col("_w")) & found & F.col("doc_id").isNotNull()
    ids = leaving.select(F.col("doc_id").alias("leaving_id")).distinct()
    some = docs.join(F.broadcast(bits), here, "left_semi")
    some = some.join(ids, some["doc_id"] == ids["leaving_id"], "left_anti")
    if doubtful is not None:
        some = some.dropDuplicates(["doc_id", "text"])
    return docs.join(F.broadcast(bits), here, "left_anti").unionByName(some)

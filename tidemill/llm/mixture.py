"""Mixing sources to target weights without sorting: thresholds on a hash, found by nested histograms.

Each document has a hash of 60 bits. A source's budget is met by taking the documents below a threshold.
To find it, sizes are summed by source and the first 12 bits of the hash; the bucket in which the budget
falls is split by the next 12 bits, and so on. Only documents of that one bucket are looked at again,
and at most 4096 sums per source exist at a time. The documents below the threshold are then a filter,
so the same ones are taken at any partitioning, and a larger budget takes a superset.

A source whose target is more than its size is taken once as a whole, and the rest of the target from
below a threshold once more. The documents at the boundary (one, or several of one hash) are taken if
the sum comes nearer to the budget with them.

Defined results: NULL texts have size 0, NULL sources are a source of their own, the last; rows with
one doc_id have one hash and are taken together (without an id the text gives the hash); with nothing
to share all targets are 0.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemill.llm.common import word_count, written

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST = 2.0
HASH_BITS, STEP_BITS = 60, 12


def document_hash(doc_id: Column, text: Column) -> Column:
    """60 bits of the MD5 of the id, the same in every engine."""
    name = F.coalesce(doc_id.cast("string"), F.concat(F.lit("text:"), F.coalesce(text, F.lit(""))))
    return F.conv(F.substring(F.md5(name.cast("binary")), 1, HASH_BITS // 4), 16, 10).cast("bigint")


def targets(sized: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """`source, source_size, target`: weights repeat over the sources by name, NULL last.

    All targets are weight * level or the source's limit, whichever is less. The level is found in the
    order in which sources reach their limits. Windows run over one row per source.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    by_limit = Window.orderBy(F.col("cap") / F.col("w"), "rank")
    before = by_limit.rowsBetween(Window.unboundedPreceding, -1)
    everything = by_limit.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    sources = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    ranked = sources.withColumn("rank", F.row_number().over(by_name) - 1)
    w = F.element_at(F.array(*map(F.lit, weights)), F.col("rank") % len(weights) + 1)
    limited = ranked.withColumn("w", w.cast("bigint")).withColumn("cap", most * F.col("source_size"))
    level = (F.lit(share) * F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / (
        F.sum("w").over(everything) - F.coalesce(F.sum("w").over(before), F.lit(0))
    )
    levels = limited.withColumn("level", level).withColumn(
        "level", F.when(F.col("level") * F.col("w") <= F.col("cap"), F.col("level"))
    )
    first = F.first("level", ignorenulls=True).over(everything)
    return levels.select("source", "source_size", F.least("cap", F.col("w") * first).alias("target"))


def thresholds(sized: DataFrame, budgets: DataFrame) -> DataFrame:
    """`source, threshold, with_boundary`: documents with a lower hash are taken, those at it if so said.

    `sized`: `source, size, hash`; `budgets`: `source, budget`. Every level reads narrow rows and writes
    one row per source. A source whose budget is all it holds, or more, gets no row.
    """
    state = budgets.select("source", F.col("budget").alias("left"), F.lit(0).cast("bigint").alias("prefix"), F.lit(0).cast("bigint").alias("boundary"))
    for shift in range(HASH_BITS - STEP_BITS, -1, -STEP_BITS):
        one = state.select(F.col("source").alias("s"), "left", "prefix")
        bucket = F.shiftright("hash", shift)
        inside = sized.join(one, F.col("source").eqNullSafe(F.col("s")) & (F.shiftright("hash", shift + STEP_BITS) == F.col("prefix")))
        sums = inside.groupBy("s", "left", bucket.alias("bucket")).agg(F.sum("size").alias("sum"))
        upto = F.sum("sum").over(Window.partitionBy("s").orderBy("bucket"))
        split = (
            sums.withColumn("upto", upto)
            .where(F.col("upto") > F.col("left"))
            .groupBy("s")
            .agg(F.min(F.struct("bucket", "left", "upto", "sum")).alias("b"))
            .select("s", F.col("b.bucket").alias("prefix"), (F.col("b.left") - (F.col("b.upto") - F.col("b.sum"))).alias("left"), F.col("b.sum").alias("boundary"))
        )
        state = written(split.withColumnRenamed("s", "source"), "mixture-level")
    return state.select("source", F.col("prefix").alias("threshold"), (F.col("left") * 2 >= F.col("boundary")).alias("with_boundary"))


def _planned(docs: DataFrame, weights: Sequence[int], share: float, most: float) -> tuple[DataFrame, DataFrame]:
    """Sizes and hashes of the documents, and a row for each source: its target and what is taken how often."""
    if not 0 < share <= most <= 2:
        raise ValueError("a document can be taken twice at most")
    sized = written(
        docs.select("doc_id", "source", word_count(F.col("text")).alias("size"), document_hash(F.col("doc_id"), F.col("text")).alias("hash")), "mixture-sizes"
    )
    goals = written(targets(sized, weights, share, most), "mixture-targets")
    whole = F.when(F.col("target") >= F.col("source_size"), 1).otherwise(0)
    budget = F.col("target") - whole * F.col("source_size")
    limits = thresholds(sized, goals.select("source", budget.alias("budget")))
    plan = goals.withColumn("whole", whole).join(
        limits.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s")), "left"
    ).select(F.col("source").alias("mix_source"), "source_size", "target", "whole", "threshold", "with_boundary")
    return sized, written(plan, "mixture-plan")


def _copies(hash_: Column) -> Column:
    below = (hash_ < F.col("threshold")) | ((hash_ == F.col("threshold")) & F.col("with_boundary"))
    # no threshold: the budget is all that the source holds
    return F.col("whole") + F.coalesce(below, F.lit(True)).cast("int")


def mix(docs: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """`doc_id, size, source_size, target, copies, taken` for every row of documents `doc_id, text, source`."""
    sized, plan = _planned(docs, weights, share, most)
    copies = _copies(F.col("hash"))
    return sized.join(plan, F.col("source").eqNullSafe(F.col("mix_source"))).select(
        "doc_id", "size", "source_size", "target", copies.alias("copies"), (copies * F.col("size")).alias("taken")
    )


def mixed(docs: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """The documents that the mix takes, each as often as it does, with all their columns."""
    _, plan = _planned(docs, weights, share, most)
    # the columns of a document go along in a struct, where no name of the plan can clash with theirs
    rows = docs.select(F.struct(*(docs[c] for c in docs.columns)).alias("document"), document_hash(F.col("doc_id"), F.col("text")).alias("hash"))
    taken = rows.join(plan, F.col("document.source").eqNullSafe(F.col("mix_source")))
    return taken.select(F.explode(F.array_repeat("document", _copies(F.col("hash")))).alias("document")).select("document.*")


ORACLE = r"""
WITH sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
    ('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), 'text:' || coalesce(text, ''))), 1, 15))::BIGINT AS hash
  FROM documents
), ranked AS (
  SELECT source, sum(size)::BIGINT AS source_size,
    row_number() OVER (ORDER BY source NULLS LAST) - 1 AS rank
  FROM sized GROUP BY source
), capped AS (
  SELECT *, [5, 2, 1][(rank % 3 + 1)::INT] AS w, 2.0::DOUBLE * source_size AS cap FROM ranked
), leveled AS (
  SELECT *, (1.5::DOUBLE * (sum(source_size) OVER ())::DOUBLE
      - coalesce(sum(cap) OVER (ORDER BY cap / w, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / (sum(w) OVER () - coalesce(sum(w) OVER (ORDER BY cap / w, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE AS level
  FROM capped
), chosen AS (
  SELECT level FROM leveled WHERE level * w <= cap ORDER BY cap / w, rank LIMIT 1
), goals AS (
  SELECT source, source_size, least(cap, w * (SELECT level FROM chosen)) AS target FROM leveled
), running AS (
  SELECT s.doc_id, s.size, g.source_size, g.target,
    CASE WHEN g.target >= g.source_size THEN 1 ELSE 0 END AS whole,
    g.target - CASE WHEN g.target >= g.source_size THEN g.source_size ELSE 0 END AS budget,
    sum(s.size) OVER (PARTITION BY s.source, s.hash) AS same,
    sum(s.size) OVER (PARTITION BY s.source ORDER BY s.hash RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto
  FROM sized s JOIN goals g ON s.source IS NOT DISTINCT FROM g.source
)
SELECT doc_id, size, source_size, target,
  ((whole + CASE WHEN upto <= budget OR (upto - same <= budget AND (budget - (upto - same)) * 2 >= same) THEN 1 ELSE 0 END) * size)::BIGINT AS taken
FROM running
"""

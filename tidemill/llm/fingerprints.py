"""Document fingerprints: threshold-scaled sketches of five-word shingles.

A sketch keeps every shingle hash below a fixed fraction of the hash range. Which hashes that are does not depend
on the document, so a small document's sketch can be looked up in a large one's (containment), and the sketch of
two documents together is the union of theirs. Short documents have few or no hashes below the fraction; the `LEAST`
smallest are kept then, and two sketches are compared up to the lower of their limits. Merging stays exact:
the least hashes of a union are among the least of its parts.

Everything is SQL expressions over whole texts.

Defined results: NULL counts as an empty text. Texts without words have an empty fingerprint, like each other (1)
and nothing else (0). Fewer than five words form one shingle. Documents follow one another by falling doc_id, ties
by text, rows without id last; after the last comes the first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemill.llm.common import SPACE

WORDS = 5
FRACTION = 1 / 16
LEAST = 16
HASHES = (1 << 63) - 1
LIMIT = int(FRACTION * HASHES)
# Ranges of ids a task works on, for each shuffle partition.
RANGES, MOST_RANGES = 4, 4096


def with_sketch(df: DataFrame, text: str, name: str) -> DataFrame:
    """Adds the sketch of a text column as a sorted array of hashes."""
    # Word hashes are a column of their own, else they would be computed again for every shingle.
    words, shingles, low = (f"_{name}_{part}" for part in ("words", "shingles", "low"))
    hashed = F.transform(F.filter(F.split(text, SPACE), lambda w: w != ""), lambda w: F.xxhash64(w))
    df = df.withColumn(words, hashed)
    w, n = F.col(words), F.size(words)
    window = F.transform(
        F.sequence(F.lit(0), n - WORDS), lambda i: F.xxhash64(*(F.get(w, i + j) for j in range(WORDS))).bitwiseAND(F.lit(HASHES))
    )
    short = F.array(F.xxhash64(n, *(F.coalesce(F.get(w, F.lit(j)), F.lit(0)) for j in range(WORDS))).bitwiseAND(F.lit(HASHES)))
    none = F.array().cast("array<bigint>")
    df = df.withColumn(shingles, F.when(n >= WORDS, window).when(n > 0, short).otherwise(none))
    df = df.withColumn(low, F.array_distinct(F.filter(shingles, lambda v: v < LIMIT)))
    sketch = F.when(F.size(low) >= LEAST, F.sort_array(low)).otherwise(
        F.slice(F.sort_array(F.array_distinct(shingles)), 1, LEAST)
    )
    return df.withColumn(name, sketch).drop(words, shingles, low)


def limit(sketch: Column) -> Column:
    """Highest hash up to which a sketch has every hash of its document."""
    return F.when(F.size(sketch) < LEAST, F.lit(HASHES)).otherwise(F.greatest(F.lit(LIMIT - 1), F.element_at(sketch, -1)))


def common(a: Column, b: Column) -> tuple[Column, Column, Column]:
    """Numbers of hashes of both, of `a` and of `b`, up to the lower limit."""
    top = F.least(limit(a), limit(b))
    upto = lambda s: F.size(F.filter(s, lambda v: v <= top))
    return F.size(F.filter(F.array_intersect(a, b), lambda v: v <= top)), upto(a), upto(b)


def resemblance(a: Column, b: Column) -> Column:
    """Estimate of the Jaccard similarity."""
    both, n, m = common(a, b)
    return F.when((F.size(a) == 0) & (F.size(b) == 0), 1.0).when(n + m - both > 0, both / (n + m - both)).otherwise(0.0)


def containment(a: Column, b: Column) -> Column:
    """Estimate of the share of the smaller document's shingles that the larger one has."""
    both, n, m = common(a, b)
    return F.when((F.size(a) == 0) & (F.size(b) == 0), 1.0).when(F.least(n, m) > 0, both / F.least(n, m)).otherwise(0.0)


def merge(a: Column, b: Column) -> Column:
    """The sketch of two documents taken together."""
    union = F.sort_array(F.array_union(a, b))
    top = F.least(limit(a), limit(b))
    return F.when(F.size(F.filter(union, lambda v: v < LIMIT)) >= LEAST, F.filter(union, lambda v: v < LIMIT)).otherwise(
        F.slice(F.filter(union, lambda v: v <= top), 1, LEAST)
    )


def fingerprints(docs: DataFrame) -> DataFrame:
    """`doc_id, text, sketch` for every row of documents `doc_id, text`."""
    return with_sketch(docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")), "text", "sketch")


def _ranges(docs: DataFrame) -> list[int]:
    """Upper ends of ranges of about as many ids, the greatest id last; at most MOST_RANGES numbers."""
    n = min(MOST_RANGES, RANGES * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    found = docs.agg(F.percentile_approx("doc_id", [i / n for i in range(1, n)], 10 * n).alias("q"), F.max("doc_id").alias("m")).first()
    return sorted({*(found.q or []), found.m} - {None})


def followed(prints: DataFrame) -> DataFrame:
    """Adds `next_text` and `next_sketch`: those of the document that follows by falling id.

    Ids are dealt out in ranges. The last document of a range is followed by the greatest of the range below, so
    those are copied to the range above, and the greatest of all to the lowest range.
    """
    ends = _ranges(prints.select("doc_id"))
    table = F.array(*map(F.lit, ends)).cast("array<bigint>")
    # Binary search for the number of ends below an id: the highest bit first.
    steps = [1 << b for b in reversed(range(max(1, len(ends)).bit_length()))]
    range_ = F.aggregate(
        F.array(*map(F.lit, steps)), F.lit(0),
        lambda at, step: F.when((at + step <= len(ends)) & (F.get(table, at + step - 1) < F.col("doc_id")), at + step).otherwise(at),
    )
    placed = prints.withColumn("range", F.when(F.col("doc_id").isNotNull() & F.lit(bool(ends)), range_).otherwise(0))
    is_end = F.get(table, F.col("range")) == F.col("doc_id") if ends else F.lit(False)
    here = F.struct(F.col("range").alias("at"), F.lit(False).alias("copied"))
    above = F.struct(((F.col("range") + 1) % max(1, len(ends))).alias("at"), F.lit(True).alias("copied"))
    dealt = placed.withColumn("place", F.explode(F.when(is_end, F.array(here, above)).otherwise(F.array(here)))).drop("range")
    w = Window.partitionBy("place.at").orderBy("place.copied", F.col("doc_id").desc_nulls_last(), "text")
    after = F.struct("text", "sketch")
    follows = dealt.withColumn("after", F.lead(after).over(w))
    if not ends:  # no ids at all: one range
        follows = follows.withColumn("after", F.coalesce("after", F.first(after).over(w)))
    return follows.where(~F.col("place.copied")).select(
        "doc_id", "text", "sketch", F.col("after.text").alias("next_text"), F.col("after.sketch").alias("next_sketch")
    )


def as_text(sketch: str) -> Column:
    return F.array_join(F.transform(sketch, lambda v: F.lower(F.hex(v))), ",")


def compare_edited(docs: DataFrame) -> DataFrame:
    """Fingerprints of every text and of its edited text, and how like they are to it and to the next document."""
    rows = followed(fingerprints(docs)).withColumn("n_chars", F.length("text"))
    cut = F.floor(F.col("n_chars") / 3).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), F.col("n_chars") - cut), F.substring("next_text", F.lit(1), cut))
    rows = with_sketch(rows.withColumn("edited", edited), "edited", "edited_sketch")
    pair = lambda f, other: f(F.col("sketch"), F.col(other))
    return rows.select(
        "doc_id",
        F.col("n_chars").cast("bigint").alias("n_chars"),
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        as_text("sketch").alias("fingerprint"),
        as_text("edited_sketch").alias("edited_fingerprint"),
        pair(resemblance, "edited_sketch").alias("near_edited"),
        pair(resemblance, "next_sketch").alias("near_next"),
        pair(containment, "edited_sketch").alias("contained_edited"),
        pair(containment, "next_sketch").alias("contained_next"),
    )

"""Fill-in-middle transformation by a counted-quantifier regex.

A text is a row of units, letter runs or single other characters. `regexp_count` gives their number n; two
numbers from a hash of the id cut the row. A pattern made for the row, with possessive groups of `a` and
`b - a` units, then captures prefix, middle and suffix in one match, and the same call writes them down in
their new order. Possessive groups are matched in a loop without a way back, so long texts need no deep stack.

Defined results: NULL counts as an empty text, which is kept as it is (form `plain`), as is a text that holds
a mark, so every output can be turned back. A row without id is cut as if its id were empty. Repeated rows
are cut alike.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The marks, and a unit as it is counted.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
UNIT = "[A-Za-z]+|[^A-Za-z]"
MARK = f"{PREFIX}|{SUFFIX}|{MIDDLE}"
ONE = "(?:[A-Za-z]++|[^A-Za-z])"


def _number(digest: Column, group: int) -> Column:
    """An 8-digit group of a hexadecimal digest, counted from 0."""
    return F.conv(F.substring(digest, 8 * group + 1, 8), 16, 10).cast("bigint")


def fill_in_middle(docs: DataFrame, salt: str = "1:", plain_from: int = 90, spm_below: int = 20) -> DataFrame:
    """`doc_id, text, n, form, output` for every row; of 100 hash values those from `plain_from` on leave a text as it is."""
    text = F.coalesce(F.col("text"), F.lit(""))
    named = docs.select(
        "doc_id",
        text.alias("text"),
        F.regexp_count(text, F.lit(UNIT)).cast("bigint").alias("n"),
        F.sha2(F.concat(F.lit(salt), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).cast("binary"), 256).alias("digest"),
    )
    numbers = named.select("doc_id", "text", "n", *(_number(F.col("digest"), i).alias(f"h{i + 1}") for i in range(4)))
    one, two = (F.col(h) % (F.col("n") + 1) for h in ("h1", "h2"))
    plain = (F.col("n") == 0) | (F.col("h3") % 100 >= plain_from) | F.col("text").rlike(MARK)
    formed = numbers.select(
        "doc_id", "text", "n", F.least(one, two).alias("a"), F.greatest(one, two).alias("b"),
        F.when(plain, "plain").when(F.col("h4") % 100 < spm_below, "spm").otherwise("psm").alias("form"),
    )
    pattern = F.concat(
        F.lit(rf"(?s)\A({ONE}{{"), F.col("a"), F.lit(rf"}}+)({ONE}{{"), F.col("b") - F.col("a"), F.lit(r"}+)(.*+)\z")
    )
    order = F.when(F.col("form") == "psm", f"{PREFIX}$1{SUFFIX}$3{MIDDLE}$2").otherwise(f"{SUFFIX}$3{PREFIX}$1{MIDDLE}$2")
    output = F.when(F.col("form") == "plain", F.col("text")).otherwise(F.regexp_replace("text", pattern, order))
    return formed.select("doc_id", "text", "n", "form", output.alias("output"))


def pieces_of(output: Column, form: Column) -> Column:
    """Prefix, middle and suffix read back from an output; NULL if it is plain."""
    cut = F.split(output, MARK, -1)
    piece = lambda psm, spm: F.when(form == "psm", cut[psm]).otherwise(cut[spm])
    return F.when(form != "plain", F.struct(piece(1, 2).alias("prefix"), cut[3].alias("middle"), piece(2, 1).alias("suffix")))


def digests(docs: DataFrame) -> DataFrame:
    """`doc_id, n, form, prefix_chars, middle_chars, output_sha256, restored_sha256` for every row."""
    cut = fill_in_middle(docs).select(
        "doc_id", "n", "form", "output", pieces_of(F.col("output"), F.col("form")).alias("p")
    )
    sha = lambda text: F.sha2(text.cast("binary"), 256)
    restored = F.when(F.col("form") == "plain", F.col("output")).otherwise(F.concat("p.prefix", "p.middle", "p.suffix"))
    return cut.select(
        "doc_id", "n", "form",
        F.length("p.prefix").cast("bigint").alias("prefix_chars"),
        F.length("p.middle").cast("bigint").alias("middle_chars"),
        sha(F.col("output")).alias("output_sha256"),
        sha(restored).alias("restored_sha256"),
    )


ORACLE = f"""
WITH units AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '{UNIT}') AS u,
         sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS d FROM documents
), numbers AS (
  SELECT doc_id, t, u, len(u) AS n, ('0x' || d[1:8])::BIGINT AS h1, ('0x' || d[9:16])::BIGINT AS h2,
         ('0x' || d[17:24])::BIGINT AS h3, ('0x' || d[25:32])::BIGINT AS h4 FROM units
), cuts AS (
  SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
         CASE WHEN n = 0 OR h3 % 100 >= 90 OR regexp_matches(t, '{MARK}') THEN 'plain'
              WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM numbers
), parts AS (
  SELECT doc_id, t, n, form, array_to_string(u[1:a], '') AS p, array_to_string(u[a + 1:b], '') AS m,
         array_to_string(u[b + 1:n], '') AS s FROM cuts
)
SELECT doc_id, n, form,
       CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '{PREFIX}' || p || '{SUFFIX}' || s || '{MIDDLE}' || m
              ELSE '{SUFFIX}' || s || '{PREFIX}' || p || '{MIDDLE}' || m END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM parts
"""

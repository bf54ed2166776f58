"""Secret scan: named patterns, and long strings that pass a battery of randomness tests.

Every string of 20 or more characters of the usual alphabets is a candidate, within named spans as well. Its
encoding (hexadecimal, base 32, base 36, base 64) is inferred from its letters and gives each character a number.

Battery: a chi-squared test of a uniform alphabet, a runs test about the middle of the alphabet, and a test of
serial correlation at lag one ask whether these numbers look drawn at random. The least of the three p-values, times
three, is `p`; a string with a small one is not random. The same chi-squared value is held against
what text gives at that length: strings whose letters have the shares of `LETTERS` and whose cases and digits those
of `ENCODINGS`. `q` is the chance that such a text looks as flat; a small one speaks against text.

Control: candidates are grouped by encoding and length (in quarters of a power of two). In each group
Benjamini-Hochberg's procedure, over all documents, is applied twice: to `q`, so that at most `RATE` of the strings
that are called random are expected to be text, and to `p`, so that at most `RATE` of those that are dismissed as
uneven are expected to be random. A string is random if the first finds it and the second does not
dismiss it. It is reported as `random` unless a named pattern covers part of it already; the verdict on each
candidate is returned in any case. Groups have counts of binned p-values only.

Everything is SQL expressions over whole texts; places count code points.

Defined results: NULL counts as an empty text, which has no spans. Rows with the same id are separate. Short strings
have little power: 40 characters of base 64 are mostly told from text, 40 hexadecimal digits seldom.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemill.llm.common import without, written

# The patterns of the named kinds in the order in which they are listed.
KINDS = ("assign", "access", "hex", "random")
ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ASSIGN_HINT = r"(?i)(password|passwd|secret|token|api_?key)"
LEAST_VALUE = 12
# A run of 18 or 16 characters and more is the same as a longest run that is long enough.
ACCESS = r"AKIA[A-Z0-9]{14,}"
HEX = r"[0-9a-f]{16,}"

CANDIDATE = r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}+={0,2}"
UPPER, LOWER, DIGITS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz", "0123456789"
# Percentages of the letters a to z in English text.
LETTERS = (8.2, 1.5, 2.8, 4.3, 12.7, 2.2, 2.0, 6.1, 7.0, 0.15, 0.77, 4.0, 2.4, 6.7, 7.5, 1.9, 0.095, 6.0, 6.3, 9.1, 2.8, 0.98, 2.4, 0.15, 2.0, 0.074)
# Encoding, what its strings look like, its alphabet, and the shares of capitals, small letters and digits in strings
# of this form that are text. The first that fits counts; letters alone are words.
ENCODINGS = (
    ("hex", r"^(?=.*[0-9])(?=.*[a-fA-F])([0-9a-f]+|[0-9A-F]+)=*$", DIGITS + "abcdef", (0, 0.5, 0.5)),
    ("base32", r"^(?=.*[2-7])(?=.*[A-Z])[A-Z2-7]+=*$", UPPER + "234567", (0.9, 0, 0.1)),
    ("base36", r"^(?=.*[0-9])(?=.*[a-zA-Z])([0-9a-z]+|[0-9A-Z]+)=*$", DIGITS + LOWER, (0, 0.9, 0.1)),
    ("base64", r"^(?=.*[0-9])(?=.*[a-z])(?=.*[A-Z])[A-Za-z0-9+/_-]+=*$", UPPER + LOWER + DIGITS + "+/", (0.05, 0.85, 0.1)),
)
RATE = 0.05
BINS = 400  # p-values are binned by -20 * log10(p)
LONGEST_GROUP = 64
BLOCK = 256  # matches of a text

SPAN = "array<struct<start:int,kind:int,end:int>>"


def _escaped(pattern: str) -> str:
    return pattern.replace("\\", "\\\\").replace("'", "\\'")


def _spans(text: str, pattern: str, kind: int, extra: str = "", keep: str = "") -> str:
    """SQL for the spans of a pattern: texts between matches, and matches, give their places.

    `extra`: SQL of an array that goes along with the matches, as `2`; `keep`: a condition on it. Spans are gathered
    in blocks, as each append copies what there is: a block, and once a block all before it.
    """
    p = _escaped(pattern)
    zipped = f"arrays_zip(split({text}, '{p}'), regexp_extract_all({text}, '{p}', 0){', ' + extra if extra else ''})"
    start = "acc.at + length(x.`0`)"
    new = f"named_struct('start', {start}, 'kind', {kind}, 'end', {start} + length(x.`1`))"
    condition = "x.`1` IS NOT NULL" + (f" AND {keep}" if keep else "")
    empty = f"CAST(array() AS {SPAN})"
    step = (
        f"(acc, x) -> named_struct('at', {start} + coalesce(length(x.`1`), 0), "
        f"'out', if({condition}, array_append(acc.out, {new}), acc.out))"
    )
    block = f"aggregate(slice(all, b * {BLOCK} + 1, {BLOCK}), named_struct('at', sum.at, 'out', {empty}), {step})"
    # a transform over an array of one binds a value to a name
    joined = f"transform(array({block}), r -> named_struct('at', r.at, 'out', concat(sum.out, r.out)))[0]"
    return (
        f"transform(array({zipped}), all -> aggregate(sequence(0, cast((size(all) - 1) div {BLOCK} AS int)), "
        f"named_struct('at', 0, 'out', {empty}), (sum, b) -> {joined}, sum -> sum.out))[0]"
    )


def _when(condition: str, spans: str) -> Column:
    """Texts without a hint of the pattern are not cut."""
    return F.expr(f"CASE WHEN {condition} THEN {spans} ELSE CAST(array() AS {SPAN}) END")


def base_spans(text: str) -> tuple[Column, Column, Column]:
    """Spans of the three named kinds in the column `text`."""
    assign = _spans(text, ASSIGN, 0, f"regexp_extract_all({text}, '{_escaped(ASSIGN)}', 1)", f"length(x.`2`) >= {LEAST_VALUE}")
    return (
        _when(f"{text} RLIKE '{_escaped(ASSIGN_HINT)}'", assign),
        _when(f"contains({text}, 'AKIA')", _spans(text, ACCESS, 1)),
        _when(f"{text} RLIKE '{_escaped(HEX)}'", _spans(text, HEX, 2)),
    )


# -- the battery -------------------------------------------------------------------------------


def _upper_tail(z: Column) -> Column:
    """P(Z > z) of a standard normal variable, by a logistic curve (error below 0.0002)."""
    z = F.greatest(F.lit(-12.0), F.least(F.lit(12.0), z))
    return 1 / (1 + F.exp(1.5976 * z + 0.07056 * z * z * z))


def _two_sided(z: Column) -> Column:
    return 2 * _upper_tail(F.abs(z))


def text_moments(alphabet: str, shares: tuple[float, float, float]) -> tuple[float, float]:
    """Sums of squares and of cubes of the characters' shares in text-like strings of an encoding."""
    weight = dict(zip(LOWER, LETTERS))
    kinds = (UPPER, LOWER, DIGITS)
    held = [[weight.get(c.lower(), 1.0) for c in alphabet if c in kind] for kind in kinds]
    parts = [share * w / sum(ws) for share, ws in zip(shares, held) for w in ws]
    return sum(x**2 for x in parts), sum(x**3 for x in parts)


def _statistics(candidates: DataFrame) -> DataFrame:
    """`p` and `q` for rows with `value, alphabet, s2, s3` (the moments of text)."""
    k, n = F.length("alphabet").cast("double"), F.size("x").cast("double")
    numbers = F.transform(
        F.split(F.translate("value", "-_=", "+/"), ""), lambda c: F.position(c, F.col("alphabet")) - 1
    )
    rows = candidates.withColumn("x", F.filter(numbers, lambda v: v >= 0))
    squares = F.aggregate(
        F.sequence(F.lit(0), F.length("alphabet") - 1),
        F.lit(0).cast("bigint"),
        lambda acc, j: acc + F.pow(F.size(F.filter("x", lambda v: v == j)), 2).cast("bigint"),
    )
    chi = k / n * squares - n
    # mean k - 1, variance 2 (k - 1) (n - 1) / n, cube root of a chi-squared value near to normal
    f = 2 * F.pow(k - 1, 2) / (2 * (k - 1) * (n - 1) / n)
    z_chi = (F.cbrt(chi / (k - 1)) - (1 - 2 / (9 * f))) / F.sqrt(2 / (9 * f))
    high = F.transform("x", lambda v: (v * 2 >= F.length("alphabet")).cast("int"))
    pairs = lambda f: F.transform(F.sequence(F.lit(1), F.size("x") - 1), f)
    total = lambda a: F.aggregate(a, F.lit(0.0), lambda acc, v: acc + v)
    rows = rows.withColumn("high", high)
    n1 = total(F.col("high").cast("array<double>"))
    n2 = n - n1
    runs = 1 + total(pairs(lambda i: (F.get("high", i) != F.get("high", i - 1)).cast("double")))
    expected = 2 * n1 * n2 / n + 1
    variance = 2 * n1 * n2 * (2 * n1 * n2 - n) / (n * n * (n - 1))
    z_runs = F.when((n1 > 0) & (n2 > 0) & (variance > 0), (runs - expected) / F.sqrt(variance)).otherwise(F.lit(12.0))
    rows = rows.withColumn("mean", total(F.col("x").cast("array<double>")) / n)
    spread = total(F.transform("x", lambda v: F.pow(v - F.col("mean"), 2)))
    lagged = total(pairs(lambda i: (F.get("x", i) - F.col("mean")) * (F.get("x", i - 1) - F.col("mean"))))
    z_serial = F.when(spread > 0, (lagged / spread + 1 / n) * F.sqrt(n)).otherwise(F.lit(12.0))
    least = F.least(_upper_tail(z_chi), _two_sided(z_runs), _two_sided(z_serial))
    # mean and variance of the sum of squared counts of n characters with given shares
    mean = n * (n - 1) * F.col("s2") + n
    varies = 2 * n * (n - 1) * (F.col("s2") + 2 * (n - 2) * F.col("s3") - (2 * n - 3) * F.col("s2") * F.col("s2"))
    flat = (mean - squares) / F.sqrt(varies)
    return rows.withColumns({"p": F.least(F.lit(1.0), 3 * least), "q": _upper_tail(flat)}).drop("x", "high", "mean")


def rejected(binned: DataFrame) -> DataFrame:
    """`group, bin`: in each group, p-values of this bin and above (smaller ones) are rejected.

    `binned`: `group, bin, count`. Benjamini-Hochberg on bins: the largest p with p * m <= RATE * rank.
    """
    w = Window.partitionBy("group")
    up_to = F.sum("count").over(w.orderBy(F.col("bin").desc()))
    all_ = F.sum("count").over(w)
    # a bin's largest p-value
    p = F.pow(F.lit(10.0), -F.col("bin") / 20)
    return (
        binned.withColumn("rank", up_to).withColumn("m", all_).where(p * F.col("m") <= RATE * F.col("rank"))
        .groupBy("group").agg(F.min("bin").alias("bin"))
    )


def _bin(p: str) -> Column:
    return F.least(F.lit(BINS), F.floor(-20 * F.log10(F.greatest(F.lit(1e-30), F.col(p))))).cast("int")


def _of_encoding(values: list) -> Column:
    """The value that belongs to the number in the column `encoding`."""
    return F.element_at(F.array(*map(F.lit, values)), F.col("encoding") + 1)


def _covered(events: DataFrame) -> DataFrame:
    """The candidates among `row, span, value, encoding`, and whether a named span (no encoding) touches them.

    Spans of a row are swept once from either end, so work does not grow with their product.
    """
    named = F.col("encoding").isNull()
    row, begin, stop = Window.partitionBy("row"), F.col("span.start"), F.col("span.end")
    reach = F.max(F.when(named, stop)).over(row.orderBy(begin).rangeBetween(Window.unboundedPreceding, 0))
    next_ = F.min(F.when(named, begin)).over(row.orderBy(begin.desc()).rangeBetween(Window.unboundedPreceding, 0))
    touched = F.coalesce(reach > begin, F.lit(False)) | F.coalesce(next_ < stop, F.lit(False))
    return events.withColumn("covered", touched).where(~named)


def judge_strings(candidates: DataFrame) -> DataFrame:
    """Adds `p_bin`, `q_bin` and `random` to all strings `value, encoding` of a corpus."""
    alphabets = [a for _, _, a, _ in ENCODINGS]
    moments = [text_moments(a, shares) for _, _, a, shares in ENCODINGS]
    length = F.least(F.lit(LONGEST_GROUP), F.floor(4 * F.log2(F.length("value").cast("double"))))
    # capitals and small letters are the same digits in these
    plain = F.when(F.col("encoding").isin(0, 2), F.lower("value")).otherwise(F.col("value"))
    prepared = candidates.withColumns({
        "group": (F.col("encoding") * 100 + length).cast("int"), "alphabet": _of_encoding(alphabets), "value": plain,
        "s2": _of_encoding([a for a, _ in moments]), "s3": _of_encoding([b for _, b in moments]),
    })
    tested = _statistics(prepared).withColumns({"p_bin": _bin("p"), "q_bin": _bin("q")})
    tested = written(tested.drop("value", "alphabet", "s2", "s3", "p", "q"), "secrets-tested")
    # At most 400 groups exist, so the limits are tables of a fixed size.
    for kind in "pq":
        binned = tested.groupBy("group", F.col(f"{kind}_bin").alias("bin")).agg(F.count(F.lit(1)).alias("count"))
        tested = tested.join(F.broadcast(rejected(binned).withColumnRenamed("bin", f"{kind}_limit")), "group", "left")
    against_text = F.coalesce(F.col("q_bin") >= F.col("q_limit"), F.lit(False))
    uneven = F.coalesce(F.col("p_bin") >= F.col("p_limit"), F.lit(False))
    return tested.withColumn("random", against_text & ~uneven).drop("group", "p_limit", "q_limit")


def scan(docs: DataFrame) -> DataFrame:
    """`doc_id, n_assign, n_access, n_hex, base, spans, tested` for every row.

    Spans are `start, kind, end`, in order; `tested`: the verdict on each candidate, within named spans as well.
    """
    text = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    found = text.select(
        "doc_id",
        *(c.alias(k) for c, k in zip(base_spans("text"), KINDS)),
        _when(f"text RLIKE '{_escaped(CANDIDATE)}'", _spans("text", CANDIDATE, 3)).alias("random"),
        F.when(F.col("text").rlike(CANDIDATE), F.expr(f"regexp_extract_all(text, '{_escaped(CANDIDATE)}', 0)")).otherwise(F.array().cast("array<string>")).alias("value"),
    )
    found = found.withColumn("base", F.array_sort(F.concat("assign", "access", "hex")))
    encoding = lambda v: F.coalesce(*(F.when(v.rlike(pattern), F.lit(i)) for i, (_, pattern, _, _) in enumerate(ENCODINGS)))
    # Only candidates that have an encoding stay, with the row they belong to.
    pairs = F.filter(
        F.transform(F.arrays_zip("random", "value"), lambda r: F.struct(r["random"].alias("span"), r["value"].alias("value"), encoding(r["value"]).alias("encoding"))),
        lambda r: r["encoding"].isNotNull(),
    )
    size = lambda k: F.size(k).cast("bigint").alias(f"n_{k}")
    rows = written(
        found.select("doc_id", size("assign"), size("access"), size("hex"), "base", pairs.alias("candidates"))
        .withColumn("row", F.monotonically_increasing_id()),
        "secrets-found",
    )
    named = F.transform("base", lambda b: F.struct(b.alias("span"), F.lit(None).cast("string").alias("value"), F.lit(None).cast("int").alias("encoding")))
    events = rows.where(F.size("candidates") > 0).select("row", F.explode(F.concat("candidates", named)).alias("c")).select("row", "c.*")
    judged = judge_strings(_covered(events))
    verdicts = judged.groupBy("row").agg(
        F.collect_list(F.when(F.col("random") & ~F.col("covered"), F.col("span"))).alias("added"),
        F.sort_array(F.collect_list(F.struct("span.start", "span.end", "encoding", "p_bin", "q_bin", "random"))).alias("tested"),
    )
    none = F.array().cast("array<struct<start:int,end:int,encoding:int,p_bin:int,q_bin:int,random:boolean>>")
    return rows.join(verdicts, "row", "left").select(
        "doc_id", "n_assign", "n_access", "n_hex", "base",
        F.array_sort(F.concat("base", F.coalesce("added", F.array().cast(SPAN)))).alias("spans"),
        F.coalesce("tested", none).alias("tested"),
    )


def as_text(spans: str) -> Column:
    """`kind:start:end` of each span, joined by commas."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"], s["end"])), ","
    )


def digests(docs: DataFrame) -> DataFrame:
    """Spans, and for each string that went through the battery `start:end:encoding:p bin:q bin:verdict`."""
    encodings = F.array(*(F.lit(name) for name, *_ in ENCODINGS))
    battery = F.transform(
        "tested",
        lambda t: F.concat_ws(":", t["start"], t["end"], F.element_at(encodings, t["encoding"] + 1), t["p_bin"], t["q_bin"], F.when(t["random"], "random").otherwise("other")),
    )
    return scan(docs).select(
        "doc_id", "n_assign", "n_access", "n_hex", F.sha2(as_text("base").cast("binary"), 256).alias("base_sha256"), as_text("spans").alias("spans"),
        F.size("tested").cast("bigint").alias("n_tested"), F.array_join(battery, ",").alias("battery"),
    )


def keep_clean(docs: DataFrame) -> DataFrame:
    """The documents without any span, with all their columns. An id with a span in one row goes in all its rows."""
    found = written(scan(docs).where(F.size("spans") > 0).select("doc_id"), "secrets-ids")
    # a row without an id is judged where it lies, by the named kinds
    text = F.coalesce(F.col("text"), F.lit(""))
    bare = docs.where(F.col("doc_id").isNotNull() | ~(text.rlike(ASSIGN) | text.rlike(ACCESS) | text.rlike(HEX)))
    return without(bare, found)

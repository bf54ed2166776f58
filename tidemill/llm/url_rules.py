"""URL filter: listed host rules, and rules mined from labelled URLs by FP-growth.

Listed rules come first: the longest one that fits decides. For other URLs, combinations of URL tokens
(host labels, path segments and their words, query keys) that go with blocked URLs are mined from the labels, and
from nothing else: the verdicts of listed rules are not labels.

FP-growth runs over the blocked URLs. Tokens that lie in the same labelled URLs are one item for it, so that a
phrase of any length which always comes as a whole is one item and not a set with all its subsets; and of a URL it
gets the `WIDTH` items that tell most, which bounds the subsets of a URL. Support and confidence of what it
finds are then counted over all labelled URLs with all their tokens. A rule is kept if both suffice and no rule with
fewer of its tokens is as sure. Rules are matched by an inverted index: each is filed under its rarest token only,
so common tokens lead to no rules, and the few that a URL's tokens lead to are checked in full.

FP-growth, index and match run in the JVM. Equal URLs are judged once.

Defined results: a NULL URL or one without `://` has an empty host and path and no token, and is allowed;
conflicting labels of a URL all count; without labels nothing is mined and the default is to allow.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from math import ceil

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.llm.common import written


@dataclass(frozen=True)
class HostRule:
    host: str
    path: str
    block: bool

    @property
    def name(self) -> str:
        return self.host + self.path


# The listed rules.
LISTED = (
    HostRule("org", "/", False),
    HostRule("example.org", "/es/", True),
    HostRule("example.org", "/en/1", True),
    HostRule("com", "/fr/", False),
    HostRule("com", "/de/", True),
)
# A rule stands on this share of the blocked URLs and is right for this share of the labelled URLs that it fits,
SUPPORT, CONFIDENCE = 0.02, 0.6
# and on this many blocked URLs, as fewer are chance.
LEAST_URLS = 12
# So many items of a URL at most are combined with each other.
WIDTH = 10

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def host(url: str) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, URL, 1), F.lit("")), UPPER, LOWER)


def path(url: str) -> Column:
    return F.coalesce(F.regexp_extract(url, URL, 2), F.lit(""))


def listed(host_: Column, path_: Column, rules: Sequence[HostRule] = LISTED) -> tuple[Column, Column]:
    """Name and verdict of the longest listed rule that fits, both NULL without one."""
    name = verdict = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: len(r.name)):
        fits = F.concat(F.lit("."), host_).endswith("." + rule.host) & path_.startswith(rule.path)
        name = F.when(fits, F.lit(rule.name)).otherwise(name)
        verdict = F.when(fits, F.lit("block" if rule.block else "allow")).otherwise(verdict)
    return name, verdict


def tokens(url: str) -> Column:
    """Distinct tokens of a URL, each with the part it is from; a segment that is one word is that word only."""
    tagged = lambda tag, words: F.transform(F.filter(words, lambda w: w != ""), lambda w: F.concat(F.lit(tag), w))
    rest = F.regexp_extract(url, r"(?s)^.*?://[^?#]*\?([^#]*)", 1)
    return F.array_distinct(
        F.concat(
            tagged("host=", F.split(host(url), r"\.")),
            tagged("path=", F.filter(F.split(F.translate(path(url), UPPER, LOWER), "/"), lambda w: ~w.rlike(r"^\p{L}+$"))),
            tagged("word=", F.split(F.translate(path(url), UPPER, LOWER), r"[^\p{L}]+")),
            tagged("query=", F.transform(F.split(rest, "&"), lambda q: F.regexp_extract(q, r"^([^=]*)", 1))),
        )
    )


RULES = "tokens array<string>, rule string, support double, confidence double"


def _items(each: DataFrame, least: int) -> DataFrame:
    """`item, members, sure`: tokens of `least` blocked URLs or more, those that lie in the same URLs together.

    `each`: `url, bad, n, token`. Two hashes of a token's URLs, 128 bits, stand for the set. Members of an item are
    tokens of one URL, so their number does not grow with the table.
    """
    both = lambda seed: F.bit_xor(F.xxhash64(F.lit(seed), F.col("url")))
    frequent = (
        each.groupBy("token").agg(F.sum("bad").alias("bad"), F.sum("n").alias("n"), both(1).alias("x"), both(2).alias("y"))
        .where(F.col("bad") >= least)
    )
    same = frequent.groupBy("bad", "n", "x", "y").agg(F.sort_array(F.collect_list("token")).alias("members"))
    return same.select(F.col("members")[0].alias("item"), "members", (F.col("bad") / F.col("n")).alias("sure"))


def mine(labelled: DataFrame, support: float = SUPPORT, confidence: float = CONFIDENCE, width: int = WIDTH) -> DataFrame:
    """Rules `tokens, rule, support, confidence` from labelled URLs `url, block`, not pruned yet."""
    urls = written(
        labelled.where("url IS NOT NULL AND block IS NOT NULL")
        .groupBy("url").agg(F.sum(F.col("block").cast("bigint")).alias("bad"), F.count(F.lit(1)).alias("n"))
        .withColumn("items", tokens("url")),
        "url-labelled",
    )
    bad, n = urls.agg(F.coalesce(F.sum("bad"), F.lit(0)), F.coalesce(F.sum("n"), F.lit(0))).first()
    least = max(LEAST_URLS, ceil(support * bad))
    if bad < least:
        return labelled.sparkSession.createDataFrame([], RULES)
    each = urls.select("url", "bad", "n", F.explode("items").alias("token"))
    items = written(_items(each, least), "url-items")
    told = each.where("bad > 0").join(items, F.col("token") == F.col("item")).groupBy("url", "bad")
    best = F.slice(F.sort_array(F.collect_list(F.struct((-F.col("sure")).alias("unsure"), "item"))), 1, width)
    baskets = told.agg(best.getField("item").alias("items")).select("items", F.explode(F.sequence(F.lit(1), F.col("bad"))))
    baskets = written(baskets.select("items"), "url-baskets")
    size = baskets.count()
    if size < least:
        return labelled.sparkSession.createDataFrame([], RULES)
    # half a URL less, as the share is multiplied out again
    model = FPGrowth(itemsCol="items", minSupport=(least - 0.5) / size).fit(baskets)
    sets = model.freqItemsets.select(F.sort_array("items").alias("set")).select("set", F.explode("set").alias("item"))
    rules = (
        sets.join(items, "item").groupBy("set").agg(F.sort_array(F.flatten(F.collect_list("members"))).alias("tokens"))
        .select("tokens", F.array_join("tokens", " & ").alias("rule"))
    )
    rules = written(rules, "url-sets")
    counts = each.groupBy("token").agg(F.sum("n").alias("n"))
    fits = matches(urls.withColumnRenamed("url", "key"), index(rules, counts))
    return (
        fits.groupBy("rule", "tokens").agg(F.sum("bad").alias("b"), F.sum("n").alias("n"))
        .where((F.col("b") >= least) & (F.col("b") / F.col("n") >= confidence))
        .select("tokens", "rule", (F.col("b") / F.lit(n)).alias("support"), (F.col("b") / F.col("n")).alias("confidence"))
    )


def index(rules: DataFrame, counts: DataFrame) -> DataFrame:
    """Adds `token`: the rarest token of each rule by `counts` (`token, n`)."""
    each = rules.select("rule", F.explode("tokens").alias("token")).join(counts, "token", "left")
    rarest = each.groupBy("rule").agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "token")).getField("token").alias("token"))
    return rules.join(rarest, "rule")


def matches(rows: DataFrame, indexed: DataFrame) -> DataFrame:
    """Pairs of a row (`key, items`) and a rule all of whose tokens the row has, with the other columns of both."""
    return (
        rows.withColumn("token", F.explode("items"))
        .join(indexed, "token")
        .where(F.size(F.array_except("tokens", "items")) == 0)
        .drop("token", "items")
    )


def prune(rules: DataFrame, counts: DataFrame) -> DataFrame:
    """Without the rules that have a part which is a rule as sure: found by the same index."""
    inner = matches(rules.select(F.col("rule").alias("key"), F.col("tokens").alias("items")), index(rules, counts))
    better = inner.where(F.col("key") != F.col("rule")).select("key", F.col("confidence").alias("sure"))
    beaten = rules.join(better, rules["rule"] == better["key"]).where(F.col("sure") >= F.col("confidence")).select("rule")
    return rules.join(beaten.distinct(), "rule", "left_anti")


def judge(pages: DataFrame, labels: DataFrame, listed_rules: Sequence[HostRule] = LISTED) -> DataFrame:
    """`page_id, host, path, rule, verdict, mined_rule, confidence` for every row of pages `page_id, url`.

    `labels`: `page_id, block`, of any pages. Rules are mined from them only, and judge pages that no listed rule fits.
    """
    name, verdict = listed(F.col("host"), F.col("path"), listed_rules)
    parsed = pages.select("page_id", "url", host("url").alias("host"), path("url").alias("path")).withColumns(
        {"rule": name, "listed": verdict}
    )
    votes = labels.where("block IS NOT NULL AND page_id IS NOT NULL").select(F.col("page_id").alias("labelled"), "block")
    labelled = written(parsed.join(votes, F.col("page_id") == F.col("labelled")).select("url", "block"), "url-labels")
    if labelled.isEmpty():
        best = None
    else:
        open_ = parsed.where("listed IS NULL AND url IS NOT NULL").select(F.col("url").alias("key")).distinct()
        rows = open_.withColumn("items", tokens("key"))
        counts = rows.select(F.explode("items").alias("token")).groupBy("token").agg(F.count(F.lit(1)).alias("n"))
        rules = written(mine(labelled), "url-mined")
        kept = written(index(prune(rules, counts), counts), "url-index")
        best = matches(rows, kept).groupBy("key").agg(F.max(F.struct("confidence", "support", "rule")).alias("best"))
    if best is None:
        return parsed.select(
            "page_id", "host", "path", "rule", F.coalesce("listed", F.lit("allow")).alias("verdict"),
            F.lit(None).cast("string").alias("mined_rule"), F.lit(None).cast("double").alias("confidence"),
        )
    return parsed.join(best, F.col("url") == F.col("key"), "left").select(
        "page_id", "host", "path", "rule",
        F.coalesce("listed", F.when(F.col("best").isNotNull(), "block").otherwise("allow")).alias("verdict"),
        F.when(F.col("listed").isNull(), F.col("best.rule")).alias("mined_rule"),
        F.when(F.col("listed").isNull(), F.col("best.confidence")).alias("confidence"),
    )

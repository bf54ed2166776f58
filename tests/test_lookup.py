from conftest import plan
from pyspark.sql import functions as F

from tidemill.operators.compare import multiset_diff
from tidemill.operators.lookup import fits, hot_keys, lookup_join


def facts(spark):
    """A third of the rows on key 7, a tenth without a key, some keys unknown to the lookup."""
    key = F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 10 == 1, None).otherwise(F.col("id") % 500)
    return spark.range(6000).select("id", key.alias("k"))


def lookup(spark):
    return spark.range(450).select(F.col("id").alias("k"), F.concat(F.lit("name "), "id").alias("name"))


def test_split_join_equals_plain_join(spark):
    fact, names = facts(spark), lookup(spark)
    got = lookup_join(fact, names, "k", ["id"], broadcast_bytes=0).select("id", "k", "name")
    want = fact.join(names, "k", "left").select("id", "k", "name")
    assert got.count() == 6000
    assert multiset_diff(got, want).count() == 0


def test_repeated_lookup_keys_are_not_lost(spark):
    fact, names = facts(spark), lookup(spark)
    twice = names.unionByName(names.filter("k in (7, 8)").withColumn("name", F.lit("other")))
    got = lookup_join(fact, twice, "k", ["id"], broadcast_bytes=0).select("id", "k", "name")
    want = fact.join(twice, "k", "left").select("id", "k", "name")
    assert multiset_diff(got, want).count() == 0


def test_hot_keys_are_few_and_split_by_their_share(spark):
    hot = hot_keys(facts(spark), "k", 8)
    assert (hot.splits, hot.null) == ([(7, 3)], False)
    hot = hot_keys(facts(spark), "k", 100)
    assert hot.null and dict(hot.splits)[7] == 34 and len(hot.splits) < 100
    even = spark.range(1000)
    assert hot_keys(even, "id", 8).splits == []


def test_hot_keys_are_spread_over_the_shuffle(spark):
    """No task of the join gets much more than its share, and without hot keys nothing is split."""
    fact = facts(spark).filter("k is not null")
    tree = plan(lookup_join(fact, lookup(spark), "k", ["id"], broadcast_bytes=0))
    assert "_part" in tree
    even = spark.range(6000).select("id", (F.col("id") % 500).alias("k"))
    assert "_part" not in plan(lookup_join(even, lookup(spark), "k", ["id"], broadcast_bytes=0))


def test_small_lookup_is_broadcast_without_a_shuffle(spark):
    tree = plan(lookup_join(facts(spark), lookup(spark), "k", ["id"])).split("\n\n")[0]
    assert "BroadcastHashJoin" in tree
    assert "Exchange (" not in tree.replace("BroadcastExchange (", "")


def test_size_is_measured(spark):
    df = spark.range(100).select(F.repeat(F.lit("x"), 1000).alias("s"))
    assert not fits(df, 50_000)
    assert fits(df, 110_000)
    assert not fits(df, 100)
    assert fits(df.limit(0), 0)

from decimal import Decimal as D

from conftest import rows

from tidemill.operators import compare as cmp

SCHEMA = "customer_id bigint, total_revenue decimal(10,2), tier string"


def frame(spark, data, schema=SCHEMA):
    return spark.createDataFrame(data, schema)


def test_a_frame_equals_itself(spark):
    df = frame(spark, [(1, D("1.00"), "high"), (2, None, None), (None, D("3.00"), "low")])
    report = cmp.compare(df, df, ["customer_id"]).first()
    assert (report.identical, report.matched, report.changed_columns) == (True, 3, [])


def test_differences_are_told_apart(spark):
    left = frame(spark, [(1, D("1.00"), "a"), (2, D("2.00"), "b"), (3, None, "c"), (4, D("4.00"), "d"), (4, D("4.00"), "d")])
    right = frame(spark, [(1, D("1.00"), "a"), (2, D("2.01"), "b"), (3, D("0.00"), "c"), (5, D("5.00"), "e"), (4, D("4.00"), "d")])
    report = cmp.compare(left, right, ["customer_id"], "l", "r").first()
    assert (report.matched, report.changed, report.left_only, report.right_only, report.duplicate_keys) == (1, 2, 0, 1, 1)
    assert report.changed_columns == ["total_revenue"]
    assert not report.identical
    assert rows(cmp.compare_rows(left, right, ["customer_id"]), "customer_id", "status") == [
        (1, "matched"),
        (2, "changed"),
        (3, "changed"),
        (4, "duplicate"),
        (5, "right_only"),
    ]


def test_column_on_one_side_only(spark):
    left = frame(spark, [(1, D("1.00"), "a")])
    report = cmp.compare(left, left.drop("tier").selectExpr("*", "1 as x"), ["customer_id"]).first()
    assert (report.left_only_columns, report.right_only_columns, report.identical) == (["tier"], ["x"], False)


def test_scale_is_no_difference_but_type_is_reported(spark):
    left = frame(spark, [(1, D("1.00"), "7")])
    wide = left.selectExpr("customer_id", "cast(total_revenue as decimal(22,4)) total_revenue", "tier")
    assert cmp.compare(left, wide, ["customer_id"]).first().identical
    number = left.selectExpr("customer_id", "total_revenue", "cast(tier as int) tier")
    report = cmp.compare(left, number, ["customer_id"]).first()
    assert (report.retyped_columns, report.changed, report.identical) == (["tier"], 0, False)


def test_table_prefix_is_dropped(spark):
    left = frame(spark, [(1, D("1.00"), "a")])
    prefixed = left.toDF(*(f"mart.{c}" for c in left.columns))
    assert cmp.compare(left, prefixed, ["customer_id"]).first().identical


def test_pairs(spark):
    a = frame(spark, [(1, D("1.00"), "a")])
    b = frame(spark, [(1, D("1.00"), "b")])
    got = cmp.compare_many({"a": a, "a2": a, "b": b}, ["customer_id"])
    assert rows(got, "left_name", "right_name", "identical") == [("a", "a2", True), ("a", "b", False), ("a2", "b", False)]


def test_multiset_diff_counts_copies(spark):
    left = frame(spark, [(1, D("1.00"), "a")] * 3 + [(2, None, None)])
    right = frame(spark, [(1, D("1.00"), "a"), (2, None, None), (3, D("3.00"), "c")])
    assert rows(cmp.multiset_diff(left, right), "customer_id", "side", "copies") == [(1, "left", 2), (3, "right", 1)]


def test_multiset_diff_equals_except_all(spark):
    left = spark.range(300).selectExpr("id % 7 a", "cast(id % 3 as string) b")
    right = spark.range(280).selectExpr("id % 5 a", "cast(id % 4 as string) b")
    diff = cmp.multiset_diff(left, right)
    only_left = diff.filter("side = 'left'").selectExpr("explode(sequence(1L, copies)) i", "a", "b").select("a", "b")
    assert rows(only_left) == rows(left.exceptAll(right))

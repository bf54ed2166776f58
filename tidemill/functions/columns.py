"""Column expressions shared by the models; all of them stay inside Catalyst."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Amounts of one order, customer or day and kind; and totals over any number of them.
MONEY = "decimal(18,2)"
TOTAL = "decimal(38,2)"

# Tiers by number of orders, first match wins; accepted tier names.
HIGH_FROM = 3
MEDIUM_FROM = 2
TIERS = ("high", "medium", "low")

# A delivery is <table>.csv or <table>_YYYYMMDD.csv, a file or a folder of part files.
PART = r"(/part-[^/]*)?$"
FEED = r"([^/]+?)(_\d{8})?\.csv" + PART
FEED_DATE = r"_(\d{8})\.csv" + PART
DELIVERY = r"([^/]+\.csv)" + PART


def money(value: Column) -> Column:
    return value.cast(MONEY)


def total_money(value: Column) -> Column:
    return value.cast(TOTAL)


def mean_money(total: Column, count: Column) -> Column:
    """Mean of exact amounts, rounded half-up to cents; NULL when nothing was counted."""
    return F.round(total.cast("decimal(28,6)") / F.nullif(count, F.lit(0)), 2).cast(MONEY)


def customer_tier(total_orders: Column) -> Column:
    return (
        F.when(total_orders >= HIGH_FROM, "high")
        .when(total_orders >= MEDIUM_FROM, "medium")
        .otherwise("low")
    )


def full_name(first: Column, last: Column) -> Column:
    """First and last name with a blank between; NULL if either is NULL."""
    return F.concat(first, F.lit(" "), last)


def _end(path: Column) -> Column:
    """The last two parts of a path, which hold the name of a delivery; the pattern would try every place of all others."""
    return F.substring_index(path, "/", -2)


def feed_name(path: Column) -> Column:
    """Table a delivery belongs to: its name without `.csv` and without an eight-digit date."""
    return F.regexp_extract(_end(path), FEED, 1)


def delivery_name(path: Column) -> Column:
    """File name, or the name of the folder that a part file lies in."""
    return F.regexp_extract(_end(path), DELIVERY, 1)


def feed_date(path: Column) -> Column:
    """Date in the name of a delivery, NULL if there is none or it is no calendar date."""
    digits = F.nullif(F.regexp_extract(_end(path), FEED_DATE, 1), F.lit(""))
    return F.try_to_timestamp(digits, F.lit("yyyyMMdd")).cast("date")


def archive_name(file_name: Column, loaded_at: Column) -> Column:
    """`orders.csv` loaded at noon becomes `orders_20240601_120000.csv`."""
    stem = F.regexp_replace(file_name, r"\.csv$", "")
    return F.concat(stem, F.lit("_"), F.date_format(loaded_at, "yyyyMMdd_HHmmss"), F.lit(".csv"))

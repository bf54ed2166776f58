from tidemill.functions.columns import (
    archive_name,
    customer_tier,
    delivery_name,
    feed_date,
    feed_name,
    full_name,
    mean_money,
    money,
    total_money,
)

__all__ = [
    "archive_name",
    "customer_tier",
    "delivery_name",
    "feed_date",
    "feed_name",
    "full_name",
    "mean_money",
    "money",
    "total_money",
]

"""Daily conversion funnel by platform and UTM source."""

from __future__ import annotations

from datetime import date
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillmart.functions.ratios import conversion_rate
from tillmart.operators import attribution
from tillmart.schemas import DIRECT

KEYS = ("base_date", "platform", "utm_source")

# Event name to its count column.
EVENT_COUNTS = {
    "view_item": "product_views",
    "add_to_cart": "add_to_cart_count",
    "begin_checkout": "checkout_started_count",
    "purchase": "purchase_from_logs",
}


class Touches(NamedTuple):
    """Source of each session's first event and of each user's last one, over all history."""

    first: DataFrame
    last: DataFrame


def funnel_counts(
    logs: DataFrame,
    orders: DataFrame,
    window: tuple[date, date] | None = None,
    status: str | None = "PAID",
    first: DataFrame | None = None,
) -> DataFrame:
    """Distinct sessions and the four event counts per date, platform and source.

    Events are summed per session, user and day before any join, and per session, day and
    platform once the platform is known. A session or user with a very large share of the
    events is a few rows by the time it is shuffled on its own key, and the number of
    sessions is then a plain count.
    """
    counts = list(EVENT_COUNTS.values())
    per_user_day = (
        logs.where(attribution.in_window("event_date", window))
        .groupBy("session_id", "user_id", F.col("event_date").alias("base_date"))
        .agg(*[F.count_if(F.col("event_name") == name).alias(c) for name, c in EVENT_COUNTS.items()])
    )
    per_session_day = (
        attribution.add_platform(per_user_day, attribution.main_platform(orders, status))
        .groupBy("session_id", "base_date", "platform")
        .agg(*[F.sum(c).alias(c) for c in counts])
    )
    return (
        attribution.add_first_touch(
            per_session_day, attribution.first_touch(logs) if first is None else first
        )
        .groupBy(*KEYS)
        .agg(F.count("*").alias("total_visitors"), *[F.sum(c).alias(c) for c in counts])
    )


def confirmed_purchases(
    orders: DataFrame,
    logs: DataFrame,
    window: tuple[date, date] | None = None,
    status: str | None = "PAID",
    last: DataFrame | None = None,
) -> DataFrame:
    """Orders per date, platform and last-touch source of the buyer.

    ``orders`` has one row per order_id (staging is keyed by it), so orders are counted per
    user first and the join sees one row per user, day and platform.
    """
    per_user = (
        attribution.with_status(orders, status)
        .where(attribution.in_window("paid_date", window))
        .groupBy("user_id", F.col("paid_date").alias("base_date"), "platform")
        .agg(F.count("*").alias("n"))
    )
    return (
        per_user.join(attribution.last_touch(logs) if last is None else last, "user_id", "left")
        .withColumn("utm_source", F.coalesce("utm_source", F.lit(DIRECT)))
        .groupBy(*KEYS)
        .agg(F.sum("n").alias("purchase_from_orders"))
    )


def funnel_daily(
    orders: DataFrame,
    logs: DataFrame,
    window: tuple[date, date] | None = None,
    status: str | None = "PAID",
    touches: Touches | None = None,
) -> DataFrame:
    """The funnel mart: the larger of logged and confirmed purchases, and the capped rate.

    Groups without events do not appear, even when they have orders. With ``touches`` the logs are
    read for the window alone.
    """
    first, last = touches or (None, None)
    from_orders = F.coalesce("purchase_from_orders", F.lit(0))
    joined = funnel_counts(logs, orders, window, status, first).join(
        confirmed_purchases(orders, logs, window, status, last), list(KEYS), "left"
    )
    return joined.withColumn(
        "purchase_completed_count", F.greatest(from_orders, F.col("purchase_from_logs"))
    ).select(
        *KEYS,
        "total_visitors",
        "product_views",
        "add_to_cart_count",
        "checkout_started_count",
        "purchase_completed_count",
        conversion_rate(F.col("purchase_completed_count"), F.col("total_visitors")).alias(
            "final_conversion_rate"
        ),
    )

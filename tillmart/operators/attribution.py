"""Where a session came from and which platform a user belongs to."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillmart.operators.keyed import one_per_key
from tillmart.operators.lookup import lookup
from tillmart.schemas import DEFAULT_PLATFORM, DIRECT


def with_status(orders: DataFrame, status: str | None) -> DataFrame:
    return orders if status is None else orders.where(F.col("order_status") == status)


def in_window(day: str, window: tuple[date, date] | None) -> Column:
    """Both ends included; no window means every day."""
    return F.lit(True) if window is None else F.col(day).between(F.lit(window[0]), F.lit(window[1]))


def main_platform(orders: DataFrame, status: str | None = "PAID") -> DataFrame:
    """Platform with most orders of each user, over all history.

    Ties go to the platform with the newest payment, then to the first name. Orders are
    counted per user and platform first, so the ranking sees a few rows per user.
    """
    counted = (
        with_status(orders, status)
        .groupBy("user_id", "platform")
        .agg(F.count("*").alias("n_orders"), F.max("paid_at").alias("last_paid_at"))
    )
    return one_per_key(
        counted, "user_id", [F.desc("n_orders"), F.desc("last_paid_at"), F.asc("platform")]
    ).select("user_id", "platform")


def first_touch(logs: DataFrame) -> DataFrame:
    """UTM source of the first event of each session, over all history."""
    narrow = logs.select("session_id", "utm_source", "event_at", "log_id")
    return one_per_key(narrow, "session_id", [F.asc("event_at"), F.asc("log_id")]).select(
        "session_id", F.coalesce("utm_source", F.lit(DIRECT)).alias("utm_source")
    )


def last_touch(logs: DataFrame) -> DataFrame:
    """UTM source of the last event of each known user, over all history."""
    narrow = logs.where(F.col("user_id").isNotNull()).select(
        "user_id", "utm_source", "event_at", "log_id"
    )
    return one_per_key(narrow, "user_id", [F.desc("event_at"), F.desc("log_id")]).select(
        "user_id", F.coalesce("utm_source", F.lit(DIRECT)).alias("utm_source")
    )


def session_touches(logs: DataFrame) -> DataFrame:
    """First event of each session and day; mergeable, so a day's rows serve until the day changes."""
    touch = F.min(F.struct("event_at", "log_id", "utm_source"))
    return logs.groupBy("session_id", "event_date").agg(touch.alias("touch"))


def user_touches(logs: DataFrame) -> DataFrame:
    """Last event of each known user and day."""
    touch = F.max(F.struct("event_at", "log_id", "utm_source"))
    known = logs.where(F.col("user_id").isNotNull())
    return known.groupBy("user_id", "event_date").agg(touch.alias("touch"))


def _source(touch: Column) -> Column:
    return F.coalesce(touch["utm_source"], F.lit(DIRECT)).alias("utm_source")


def first_of(days: DataFrame) -> DataFrame:
    """``first_touch`` from ``session_touches`` of all days."""
    return days.groupBy("session_id").agg(F.min("touch").alias("t")).select("session_id", _source(F.col("t")))


def last_of(days: DataFrame) -> DataFrame:
    """``last_touch`` from ``user_touches`` of all days."""
    return days.groupBy("user_id").agg(F.max("touch").alias("t")).select("user_id", _source(F.col("t")))


def add_platform(rows: DataFrame, platforms: DataFrame) -> DataFrame:
    """Platform of the user; the default one for guests and users without orders."""
    return lookup(rows, platforms, "user_id", spread_by="session_id").withColumn(
        "platform", F.coalesce("platform", F.lit(DEFAULT_PLATFORM))
    )


def add_first_touch(rows: DataFrame, touches: DataFrame) -> DataFrame:
    """Source of the session's first event."""
    return lookup(rows, touches, "session_id", spread_by="base_date").withColumn(
        "utm_source", F.coalesce("utm_source", F.lit(DIRECT))
    )


def enriched_logs(
    logs: DataFrame,
    orders: DataFrame,
    window: tuple[date, date] | None = None,
    status: str | None = "PAID",
) -> DataFrame:
    """Events of the window with the platform of their user and the source of their session."""
    events = logs.where(in_window("event_date", window)).select(
        F.col("event_date").alias("base_date"), "session_id", "user_id", "event_name", "log_id"
    )
    placed = add_platform(events, main_platform(orders, status))
    return add_first_touch(placed, first_touch(logs)).select(
        "base_date", "platform", "utm_source", "session_id", "event_name", "log_id"
    )

"""Which batch dates a run reads and which mart dates it rebuilds."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillmart.schemas import BEHAVIOR_LOOKBACK_DAYS, ORDER_LOOKBACK_DAYS


def order_dates(run_date: date, lookback: int = ORDER_LOOKBACK_DAYS) -> list[date]:
    """Run date and the ``lookback`` days before it, oldest first."""
    return [run_date - timedelta(days=n) for n in range(lookback, -1, -1)]


def behavior_dates(run_date: date, lookback: int = BEHAVIOR_LOOKBACK_DAYS) -> list[date]:
    """Logs never change: the run date alone, or newest first when a lookback is asked for."""
    return [run_date - timedelta(days=n) for n in range(lookback + 1)]


def collection_plan(
    runs: DataFrame,
    order_lookback: int = ORDER_LOOKBACK_DAYS,
    behavior_lookback: int = BEHAVIOR_LOOKBACK_DAYS,
) -> DataFrame:
    """The same plan for a column ``run_date``: one row per run, feed and batch date."""

    def feed(name: str, lookback: int) -> DataFrame:
        days = F.sequence(F.date_sub("run_date", lookback), F.col("run_date"))
        return runs.select("run_date", F.lit(name).alias("feed"), F.explode(days).alias("batch_date"))

    return feed("orders", order_lookback).unionByName(feed("logs", behavior_lookback))


def refresh_window(
    target_dates: Iterable[date], lookback: int = ORDER_LOOKBACK_DAYS
) -> tuple[date, date]:
    """First and last mart date to rebuild; a long backfill widens the lookback."""
    days = sorted(target_dates)
    span = max(lookback, (days[-1] - days[0]).days)
    return days[-1] - timedelta(days=span), days[-1]


def recheck_candidates(
    orders: DataFrame, target_date: date, lookback: int = ORDER_LOOKBACK_DAYS
) -> DataFrame:
    """Paid orders of the ``lookback`` days before ``target_date`` (that day not included)."""
    start = target_date - timedelta(days=lookback)
    return orders.where(
        (F.col("order_status") == "PAID")
        & (F.col("paid_date") >= F.lit(start))
        & (F.col("paid_date") < F.lit(target_date))
    ).select(
        "order_id",
        "user_id",
        "product_id",
        "payment_amount",
        "discount_amount",
        "amount_before_fx",
        "currency_code",
        "platform",
        "paid_at",
        "fx_rate",
    )

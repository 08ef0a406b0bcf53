"""Staging to marts."""

from __future__ import annotations

from collections.abc import Collection, Iterable
from datetime import date, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillmart.operators import attribution
from tillmart.operators.funnel import Touches, funnel_daily
from tillmart.operators.rfm import rfm_segments
from tillmart.schemas import DEFAULT_PLATFORM, ORDER_LOOKBACK_DAYS
from tillmart.sources.day_table import DayTable


def _days(window: tuple[date, date]) -> list[date]:
    return [date.fromordinal(n) for n in range(window[0].toordinal(), window[1].toordinal() + 1)]


def refresh_funnel(
    mart: DayTable,
    orders: DataFrame,
    logs: DataFrame,
    window: tuple[date, date],
    touches: Touches | None = None,
    days: Collection[date] | None = None,
) -> None:
    """Recompute the days of the window, both ends included; other days stay as they are.

    With ``days`` only those among them; without any, nothing is written.
    """
    wanted = sorted(set(_days(window)) & set(days)) if days is not None else _days(window)
    if not wanted:
        return
    rows = funnel_daily(orders, logs, (wanted[0], wanted[-1]), touches=touches)
    rows = rows.where(F.col("base_date").isin(*map(F.lit, wanted)))
    mart.replace_days(rows.withColumn("refreshed_at", F.current_timestamp()), wanted)


def rebuild_rfm(mart: DayTable, orders: DataFrame, as_of: date) -> None:
    rows = rfm_segments(orders, as_of).withColumns(
        {"refreshed_at": F.current_timestamp(), "as_of": F.lit(as_of)}
    )
    mart.replace_all(rows)


def update_touches(
    sessions: DayTable, users: DayTable, logs: DayTable, days: Iterable[date]
) -> None:
    """Touches of the days of ``logs`` that changed; a day without logs any more loses its touches."""
    days = sorted(days)
    if not days:
        return
    changed = logs.read(days)
    sessions.replace_days(attribution.session_touches(changed), days)
    users.replace_days(attribution.user_touches(changed), days)


def touches(sessions: DayTable, users: DayTable) -> Touches:
    return Touches(attribution.first_of(sessions.read()), attribution.last_of(users.read()))


def _moved(before: DataFrame, after: DataFrame, key: str, value: str, default: str | None) -> DataFrame:
    """Keys of ``after`` or ``before`` whose value differs; a missing one counts as ``default``."""
    both = after.join(before.select(key, F.col(value).alias("_old")), key, "full")
    now, old = (F.coalesce(c, F.lit(default)) for c in (F.col(value), F.col("_old")))
    return both.where(~now.eqNullSafe(old)).select(key)


def _dates(rows: DataFrame, day: str) -> set[date]:
    return {r[0] for r in rows.select(day).distinct().collect()}  # calendar days


def days_moved(
    before: tuple[DataFrame, DataFrame, DataFrame],
    after: tuple[DataFrame, DataFrame, DataFrame],
    order_days: Collection[date],
    log_days: Collection[date],
) -> set[date]:
    """Days whose funnel a load has changed.

    ``before`` and ``after`` are session touches, user touches and orders. Besides the days that
    lost or gained rows: those with events of sessions whose first touch moved, those with orders
    of users whose last touch moved, and those with events of users whose main platform moved. Only
    sessions and users of the changed days are looked at, and they are looked for on the other days
    alone; where there are none nothing is compared.
    """
    days = {*order_days, *log_days}

    def others(rows: DataFrame, day: str) -> DataFrame | None:
        rest = rows.where(~F.col(day).isin(*map(F.lit, sorted(days))))
        return None if rest.isEmpty() else rest

    if log_days:
        in_days = F.col("event_date").isin(*map(F.lit, log_days))
        for n, key, merged in ((0, "session_id", attribution.first_of), (1, "user_id", attribution.last_of)):
            day = ("event_date", "paid_date")[n]
            rest = others((after[0], attribution.with_status(after[2], "PAID"))[n], day)
            if rest is None:
                continue
            seen = after[n].where(in_days).select(key).distinct()
            old, new = (merged(x[n].join(seen, key, "left_semi")) for x in (before, after))
            moved = _moved(old, new, key, "utm_source", None)
            days |= _dates(rest.join(moved, key, "left_semi"), day)
    rest = others(after[1], "event_date") if order_days else None
    if rest is not None:
        in_days = F.col("paid_date").isin(*map(F.lit, order_days))
        users = before[2].where(in_days).select("user_id").union(after[2].where(in_days).select("user_id"))
        users = users.distinct()
        old, new = (
            attribution.main_platform(x[2].join(users, "user_id", "left_semi")) for x in (before, after)
        )
        moved = _moved(old, new, "user_id", "platform", DEFAULT_PLATFORM)
        days |= _dates(rest.join(moved, "user_id", "left_semi"), "event_date")
    return days


def days_to_refresh(
    mart: DayTable, logs: DayTable, moved: Collection[date], window: tuple[date, date]
) -> set[date]:
    """Days of the window to recompute so that it equals a full rebuild.

    Those moved, those that only the logs or only the mart has, and all that lie before the window
    of the newest mart day: a change there was left out when it came.
    """
    had, have = set(mart.days()), set(logs.days())
    if not had:
        return set(_days(window))
    kept_from = max(had) - timedelta(days=ORDER_LOOKBACK_DAYS)
    return {d for d in _days(window) if d in moved or d < kept_from or (d in had) != (d in have)}

"""The three zones under one root folder, and the daily run over them."""

from __future__ import annotations

import logging
from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date
from functools import partial

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillmart.operators import collection, funnel, quality
from tillmart.plans import marts, reports, staging
from tillmart.schemas import (
    FUNNEL_MART,
    MIN_LOG_RECORDS,
    RFM_MART,
    SESSION_TOUCHES,
    STAGED_LOGS,
    STAGED_ORDERS,
    USER_TOUCHES,
)
from tillmart.sources import raw_zone
from tillmart.sources.day_table import DayTable
from tillmart.sources.shared import existing_json, scratch, side_by_side

logger = logging.getLogger(__name__)


@dataclass(frozen=True)
class Landed:
    """What one fetch brought: rows landed, rows put aside, status changes among all of them."""

    rows: int = 0
    rejected: int = 0
    cancelled: int = 0
    refunded: int = 0


@dataclass(frozen=True)
class RunStats:
    raw_orders: int
    raw_logs: int
    cancelled: int
    refunded: int
    orders: staging.LoadStats
    logs: staging.LoadStats
    funnel_rows: int
    rfm_rows: int
    enough_logs: bool


class Warehouse:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self.raw_orders_path = f"{self.root}/raw/ecommerce_orders"
        self.raw_logs_path = f"{self.root}/raw/user_behavior_logs"

        def table(name: str, schema: str, day: str, *args, **kwargs) -> DayTable:
            return DayTable(spark, f"{self.root}/{name}", schema, day, *args, **kwargs)

        self.orders = table(
            "stg/ecommerce_orders", STAGED_ORDERS, "paid_date", quality.order_rules, newest="paid_at"
        )
        self.logs = table(
            "stg/user_behavior_logs", STAGED_LOGS, "event_date", quality.log_rules, newest="event_at"
        )
        self.sessions = table("stg/session_touches", SESSION_TOUCHES, "event_date", unique=["session_id", "event_date"])
        self.users = table("stg/user_touches", USER_TOUCHES, "event_date", unique=["user_id", "event_date"])
        self.funnel = table(
            "mart/user_funnel_daily", FUNNEL_MART, "base_date", quality.funnel_rules, unique=funnel.KEYS
        )
        self.rfm = table(
            "mart/user_rfm_scores", f"{RFM_MART}, as_of date", "as_of", quality.rfm_rules, unique=["user_id"]
        )

    def land(
        self, orders: DataFrame | None, logs: DataFrame | None, on_reject: str = "fail"
    ) -> tuple[Landed, Landed]:
        """Append raw rows (see ``raw_zone.raw_rows``) and their JSON files; returns the counts.

        Rows that break a raw rule stop the landing of their feed, or go to the raw quarantine.
        """
        feeds = (
            (orders, self.raw_orders_path, "ecommerce_orders", quality.raw_order_rules()),
            (logs, self.raw_logs_path, "user_behavior_logs", quality.raw_log_rules()),
        )
        return tuple(
            Landed() if rows is None else self._land(rows, table, name, rules, on_reject)
            for rows, table, name, rules in feeds
        )

    def _land(
        self, rows: DataFrame, table: str, name: str, rules: quality.Rules, on_reject: str
    ) -> Landed:
        """Land the good rows of one fetch, counted while it is written for the first time.

        Payloads move once, before that: the table and the JSON files are written as they lie then.
        """
        flagged, seen = raw_zone.observed(raw_zone.by_partition(rows), rules)
        with scratch(flagged, "landing") as fetched:
            n = seen.get
            if n["bad"] and on_reject == "fail":
                raise staging.RejectedRows(f"{n['bad']} raw rows break a rule")
            if n["bad"]:
                bad = quality.rejected(fetched)
                bad = bad.withColumn("content", raw_zone.content_key(bad)).dropDuplicates(["content"])
                staging.put_aside(bad, f"{self.root}/quarantine/raw_{name}", ("content",))
            raw_zone.land(quality.clean(fetched), table, f"{self.root}/json/{name}", together=True)
            landed = Landed(n["n"] - n["bad"], n["bad"], n["cancelled"], n["refunded"])
            line = self.spark.createDataFrame([(name, landed.rows)], "feed string, n bigint")
            line.coalesce(1).write.mode("append").json(f"{self.root}/raw/landed")
            return landed

    def raw_counts(self) -> dict[str, int]:
        """Rows landed so far per feed, from the counts of the landings."""
        path = f"{self.root}/raw/landed"
        lines = existing_json(self.spark, path, "feed string, n bigint")
        if lines is None:
            return {}
        return {r.feed: r.n for r in lines.groupBy("feed").agg(F.sum("n").alias("n")).collect()}

    def _raw(self, path: str, batch_dates: Sequence[date] | None = None) -> DataFrame | None:
        try:
            return raw_zone.scan(self.spark, path, batch_dates)
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return None

    def run(
        self,
        run_dates: Sequence[date],
        as_of: date,
        raw_orders: DataFrame | None = None,
        raw_logs: DataFrame | None = None,
        on_reject: str = "quarantine",
    ) -> RunStats:
        """Land, load staging, refresh the marts.

        All run dates are loaded in one pass: versions carry their batch date, so the order
        of processing does not matter and a backfill needs no loop over days.
        """
        landed = self.land(raw_orders, raw_logs, on_reject)
        order_days = sorted({d for r in run_dates for d in collection.order_dates(r)})
        log_days = sorted({d for r in run_dates for d in collection.behavior_dates(r)})

        before = self._state()
        none = staging.LoadStats(0, 0)
        orders = self._raw(self.raw_orders_path, order_days)
        order_stats = none if orders is None else staging.load_orders(
            self.orders, orders, quarantine=f"{self.root}/quarantine/orders", on_reject=on_reject,
            references=partial(raw_zone.scan, self.spark, self.raw_orders_path),
        )
        logs = self._raw(self.raw_logs_path, log_days)
        log_stats = none if logs is None else staging.load_logs(
            self.logs, logs, quarantine=f"{self.root}/quarantine/logs", on_reject=on_reject,
            references=partial(raw_zone.scan, self.spark, self.raw_logs_path),
        )
        marts.update_touches(self.sessions, self.users, self.logs, log_stats.days)

        window = collection.refresh_window(run_dates)
        moved = marts.days_moved(before, self._state(), order_stats.days, log_stats.days)
        days = marts.days_to_refresh(self.funnel, self.logs, moved, window)
        touches = marts.touches(self.sessions, self.users)
        side_by_side(
            self.spark,
            lambda: marts.refresh_funnel(
                self.funnel, self.orders.read(), self.logs.read(), window, touches, days
            ),
            lambda: marts.rebuild_rfm(self.rfm, self.orders.read(), as_of),
        )

        enough = self.logs.size()[0] >= MIN_LOG_RECORDS
        if not enough:
            logger.warning("fewer than %d behaviour logs in staging", MIN_LOG_RECORDS)
        return RunStats(
            landed[0].rows,
            landed[1].rows,
            landed[0].cancelled,
            landed[0].refunded,
            order_stats,
            log_stats,
            self.funnel.size()[0],
            self.rfm.size()[0],
            enough,
        )

    def _state(self) -> tuple[DataFrame, DataFrame, DataFrame]:
        """Session touches, user touches and orders as they are published now."""
        return self.sessions.read(), self.users.read(), self.orders.read()

    def recheck(self, run_date: date) -> DataFrame:
        """Paid orders whose status a run of that date should ask for again."""
        return collection.recheck_candidates(self.orders.read(), run_date)

    def row_counts(self) -> DataFrame:
        """Rows of every table, from the lists of the tables and the landings; no data is read."""
        landed = self.raw_counts()
        counts = {
            "raw_ecommerce_orders": landed.get("ecommerce_orders"),
            "raw_user_behavior_logs": landed.get("user_behavior_logs"),
            "stg_ecommerce_orders": self.orders.size()[0],
            "stg_user_behavior_logs": self.logs.size()[0],
            "mart_user_funnel_daily": self.funnel.size()[0],
            "mart_user_rfm_scores": self.rfm.size()[0],
        }
        return self.spark.createDataFrame(list(counts.items()), "table_name string, row_count bigint")

    def healthy(self) -> bool:
        return reports.zone_health(self.row_counts()).first()["healthy"]

    def last_updated(self) -> DataFrame:
        """Newest event or payment in staging, from the lists of the tables."""
        newest = [t for t in (self.logs.size()[1], self.orders.size()[1]) if t]
        return self.spark.createDataFrame([(max(newest, default=None),)], "last_updated timestamp_ntz")

    def status_counts(self) -> DataFrame:
        return reports.status_counts(self.orders.read()).orderBy(F.desc("n_orders"))

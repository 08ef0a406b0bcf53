"""Raw zone to staging tables."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from tillmart.operators import keyed, quality, standardize
from tillmart.sources.day_table import DayTable
from tillmart.sources.shared import existing_parquet, scratch

#: Raw rows of the named batch dates.
Raw = Callable[[Sequence[date]], DataFrame]


@dataclass(frozen=True)
class LoadStats:
    submitted: int
    changed: int
    rejected: int = 0
    #: Days of the table that lost or gained rows.
    days: frozenset[date] = field(default=frozenset(), compare=False)


class RejectedRows(ValueError):
    """Rows broke a rule and the load was asked to fail on that."""


class MissingReferences(ValueError):
    """Rows name raw rows that are not in the raw zone."""


def put_aside(bad: DataFrame, path: str, place: Sequence[str]) -> None:
    """Add rejected rows to the quarantine; those it has already, by ``place``, stay as they are."""
    known = existing_parquet(bad.sparkSession, path, bad.schema)
    if known is not None:
        same = [F.col(f"b.{c}").eqNullSafe(F.col(f"k.{c}")) for c in place[1:]]
        on = reduce(Column.__and__, same, F.col(f"b.{place[0]}") == F.col(f"k.{place[0]}"))
        bad = bad.alias("b").join(known.select(*place).alias("k"), on, "left_anti")
    bad.write.mode("append").parquet(path)


def _counting(flagged: DataFrame) -> tuple[DataFrame, Observation]:
    """``flagged`` with its rejected rows counted by whatever writes it."""
    seen = Observation()
    bad = F.count_if(F.size("violations") > 0)
    return flagged.observe(seen, bad.alias("bad")), seen


def _accept(
    flagged: DataFrame, n_bad: int, quarantine: str | None, on_reject: str, place: Sequence[str]
) -> DataFrame:
    """Rows that keep every rule. The others go to ``quarantine``; without one the load stops."""
    if n_bad and (quarantine is None or on_reject == "fail"):
        raise RejectedRows(f"{n_bad} rows break a rule")
    if n_bad:
        put_aside(quality.rejected(flagged), quarantine, place)
    return quality.clean(flagged)


def _check_references(batch: DataFrame, raw: Raw | None) -> None:
    """Every raw_id of ``batch`` is in the raw zone; only the batches it names are read."""
    if raw is None:
        return
    named = batch.where("raw_id IS NOT NULL").select("batch_date", "raw_id")
    dates = [r[0] for r in named.select("batch_date").distinct().collect()]  # calendar days
    if dates and not quality.orphans(named.distinct(), raw(sorted(dates))).isEmpty():
        raise MissingReferences("rows name raw rows that are not in the raw zone")


def upsert_orders(
    table: DayTable,
    versions: DataFrame,
    quarantine: str | None = None,
    on_reject: str = "quarantine",
    references: Raw | None = None,
) -> LoadStats:
    """Merge order versions into staging; the newest good version of an order stays.

    Every version is held against the rules before the newest is chosen, so each bad one is put
    aside and none hides a good one. Versions are compared over all history, by the table's key log,
    so loading an old batch again cannot undo a newer status. Only days that lose a version
    are rewritten; those that only gain some are added to. With ``references`` the raw rows that the batch names must exist.
    """
    table = table.with_key("order_id", keyed.ORDER_VERSION)
    flagged, seen = _counting(quality.with_violations(versions, quality.order_rules()))
    with scratch(flagged, "versions") as flagged:
        n_bad = seen.get["bad"]
        good = _accept(flagged, n_bad, quarantine, on_reject, ("raw_id",))
        latest = keyed.latest_orders(good)
        with scratch(with_known(latest, table).drop("old_version"), "orders") as pairs:
            _check_references(pairs, references)
            # One line per pair of calendar days.
            moves = (
                pairs.groupBy("paid_date", "old_date")
                .agg(F.count("*").alias("n"), F.count_if("newer").alias("newer"))
                .collect()
            )
            moved = [m for m in moves if m["newer"]]
            gain, lose = ({m[c] for m in moved} - {None} for c in ("paid_date", "old_date"))
            if gain:
                new = pairs.where("newer").select(*latest.columns, "old_date")
                new = new.withColumn("loaded_at", F.current_timestamp())
                # Orders that staging has not yet meet no row of theirs; days that lose none grow.
                anew = lose | (gain & table.crowded())
                old_date, rows = F.col("old_date"), new.drop("old_date")
                again, first = (rows.where(known) for known in (old_date.isNotNull(), old_date.isNull()))
                staged = table.read(anew)
                if lose:
                    staged = keyed.latest_orders(staged.unionByName(again))
                table.replace_days(staged.unionByName(first), anew, changed=rows, grow=gain)
            return LoadStats(
                sum(m["n"] for m in moves), sum(m["newer"] for m in moves), n_bad, frozenset(gain | lose)
            )


def with_known(batch: DataFrame, table: DayTable) -> DataFrame:
    """``batch`` with the day its orders are staged under, and whether it is newer than that."""
    known = table.known_keys().select(
        F.col("key").alias("order_id"),
        F.col("day").alias("old_date"),
        F.struct(*keyed.ORDER_VERSION).alias("old_version"),
    )
    is_newer = F.struct(*keyed.ORDER_VERSION) > F.col("old_version")
    return batch.join(known, "order_id", "left").withColumn("newer", F.coalesce(is_newer, F.lit(True)))


def insert_logs(
    table: DayTable,
    logs: DataFrame,
    quarantine: str | None = None,
    on_reject: str = "quarantine",
    references: Raw | None = None,
) -> LoadStats:
    """Add logs whose log_id staging does not have yet; existing rows are never touched.

    As with orders, rows that break a rule are put aside before copies are dropped, and ids are
    compared over all history, whatever the date they come under.
    """
    table = table.with_key("log_id")
    rules = dict(quality.log_rules())
    if "unreadable" in logs.columns:
        rules["payload unreadable"] = F.col("unreadable")
    flagged, seen = _counting(quality.with_violations(logs, rules))
    with scratch(flagged, "logs") as flagged:
        n_bad = seen.get["bad"]
        good = _accept(flagged, n_bad, quarantine, on_reject, ("raw_id", "event_pos"))
        tally = Observation()
        batch = keyed.first_logs(good).observe(tally, F.count("*").alias("n"))
        with scratch(batch, "batch") as batch:
            _check_references(batch, references)
            fresh = unknown(batch, table)
            days = table.added(fresh.withColumn("loaded_at", F.current_timestamp()))
            return LoadStats(tally.get["n"], sum(days.values()), n_bad, frozenset(days))


def unknown(batch: DataFrame, table: DayTable) -> DataFrame:
    """Rows of ``batch`` whose log_id no live row of the table has."""
    known = table.known_keys().select(F.col("key").alias("log_id"))
    return batch.join(known, "log_id", "left_anti")


def load_orders(table: DayTable, raw: DataFrame, **kwargs) -> LoadStats:
    return upsert_orders(table, standardize.orders(raw), **kwargs)


def load_logs(table: DayTable, raw: DataFrame, **kwargs) -> LoadStats:
    return insert_logs(table, standardize.behavior_logs(raw), **kwargs)

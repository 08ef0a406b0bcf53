"""Parquet tables partitioned by day, with whole days replaced, added or dropped at once.

Plain Parquet has no MERGE or DELETE, and dynamic partition overwrite leaves the old rows of
a day that became empty. So rows are always written to a new folder, and one small JSON file
then lists every live folder of every day, with its rows and newest time. That file is the commit:
until it is there readers see the table as it was, and nothing that is being read is ever
overwritten. Opening a table reads the newest of these files and no other. One writer at a time
is assumed, as with any daily job.

A day that is added to again and again has many folders; from ``FOLD`` on the next addition writes
it anew as one.

The rules of the table are checked on the rows as written, before the commit. So is its key, if it
has one (``with_key``): no two rows of the written folder, nor one of them and a row of a live day
that stays, may have it in common. Keys of all history lie in a bucketed table (``key_log``), so
neither this check nor a load shuffles them.
"""

from __future__ import annotations

import re
import uuid
from collections import Counter
from collections.abc import Callable, Collection, Iterable, Sequence
from dataclasses import dataclass, field
from datetime import date, datetime

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillmart.operators.quality import Rules, breaks_any
from tillmart.sources.key_log import KeyLog

#: Folders a day may have before an addition writes it anew as one.
FOLD = 16

_LIST = (
    "day date, folder string, n bigint, newest timestamp_ntz, keyed boolean, "
    "keys array<string>, dropped array<struct<day: date, upto: string>>"
)


class BrokenRules(ValueError):
    """Rows that were to be published break a rule of the table."""


class DuplicateKeys(BrokenRules):
    """Rows that were to be published share a key with each other or with live rows."""


@dataclass(frozen=True)
class Folder:
    """Rows of one day in one folder."""

    day: date
    name: str
    n: int
    newest: datetime | None
    keyed: bool


@dataclass(frozen=True)
class Snapshot:
    """What one publish made live. ``keys`` and ``dropped`` say which entries of the key log count."""

    number: int = 0
    folders: tuple[Folder, ...] = ()
    keys: tuple[str, ...] = ()
    dropped: tuple[tuple[date, str], ...] = ()


@dataclass
class _Change:
    """What a publish takes away and brings."""

    gone: set[date] = field(default_factory=set)
    new: list[Folder] = field(default_factory=list)
    keys: list[str] | None = None
    dropped: list[tuple[date, str]] | None = None


class DayTable:
    def __init__(
        self,
        spark: SparkSession,
        root: str,
        schema: str,
        day: str,
        rules: Callable[[], Rules] | None = None,
        newest: str | None = None,
        unique: Sequence[str] = (),
    ):
        """``newest`` names the column whose latest value is listed; ``unique`` a key within a day."""
        self.spark = spark
        self.root = root.rstrip("/")
        self.schema = schema
        self.columns = T.StructType.fromDDL(schema).names
        self.day = day
        self.rules = rules
        self.newest = newest
        self.unique = tuple(unique)
        self.key_log: KeyLog | None = None

    def of(self, spark: SparkSession) -> DayTable:
        """The same table through another session."""
        other = DayTable(spark, self.root, self.schema, self.day, self.rules, self.newest, self.unique)
        if self.key_log:
            other.key_log = KeyLog(spark, self.root, self.key_log.key, self.key_log.versions)
        return other

    def with_key(self, key: str, versions: Sequence[str] = ()) -> DayTable:
        """The table with a key that is unique over all days, logged with the columns ``versions``.

        Rows that were published without their keys are looked up once and logged.
        """
        if self.key_log and (self.key_log.key, self.key_log.versions) == (key, tuple(versions)):
            table = self
        else:
            table = self.of(self.spark)
            table.key_log = KeyLog(self.spark, self.root, key, versions)
        now = table._snapshot()
        bare = [f for f in now.folders if not f.keyed]
        if bare:
            rows = table._rows_of(bare)
            if not rows.groupBy(key).count().where("count > 1").isEmpty():
                raise DuplicateKeys(f"rows of {self.root} share a {key}")
            keys = table._logged(rows, now)
            listed = [Folder(f.day, f.name, f.n, f.newest, True) for f in now.folders]
            table._publish(now, _Change({f.day for f in now.folders}, listed, keys))
        return table

    # -- reading -------------------------------------------------------------------------

    def _lists(self) -> dict[int, str]:
        """The file of every publish by number; file names only, none is opened."""
        try:
            files = self.spark.read.schema(_LIST).json(f"{self.root}/published").inputFiles()
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return {}
        return {int(re.search(r"publish=(\d+)/", f)[1]): f for f in files}

    def _snapshot(self) -> Snapshot:
        """The newest list: one small file, by days and folders."""
        lists = self._lists()
        if not lists:
            return Snapshot()
        number = max(lists)
        rows = self.spark.read.schema(_LIST).json(lists[number]).collect()
        head = next(r for r in rows if r["day"] is None)
        return Snapshot(
            number,
            tuple(Folder(r.day, r.folder, r.n, r.newest, r.keyed) for r in rows if r.day is not None),
            tuple(head["keys"]),
            tuple((d.day, d.upto) for d in head.dropped),
        )

    def _log(self) -> DataFrame:
        """One row for each publish so far."""
        return self.spark.createDataFrame([(n,) for n in sorted(self._lists())], "publish bigint")

    def days(self) -> list[date]:
        return sorted({f.day for f in self._snapshot().folders})

    def size(self) -> tuple[int, datetime | None]:
        """Rows and newest time, from the list alone."""
        folders = self._snapshot().folders
        return sum(f.n for f in folders), max((f.newest for f in folders if f.newest), default=None)

    def read(self, days: Iterable[date] | None = None) -> DataFrame:
        """The table, or some of its days; only folders of those days are listed."""
        wanted = None if days is None else set(days)
        return self._rows_of(
            [f for f in self._snapshot().folders if wanted is None or f.day in wanted]
        )

    def _rows_of(self, folders: Sequence[Folder]) -> DataFrame:
        paths = [
            f"{self.root}/data/folder={f.name}/{self.day}={f.day.isoformat()}" for f in folders
        ]
        if not paths:
            return self.spark.createDataFrame([], self.schema)
        return (
            self.spark.read.schema(f"{self.schema}, folder string")
            .option("basePath", f"{self.root}/data")
            .parquet(*paths)
            .select(*self.columns)
        )

    def known_keys(self) -> DataFrame:
        """Keys of all live rows (key, day, versions), where the key log has its buckets."""
        now = self._snapshot()
        return self.key_log.live(now.keys, now.dropped)

    # -- writing -------------------------------------------------------------------------

    def _write(self, rows: DataFrame) -> list[Folder]:
        """Write a new folder and check it. Small days share a task, large days are split over many."""
        folder = uuid.uuid4().hex
        path = f"{self.root}/data/folder={folder}"
        (
            rows.select(*self.columns)
            .hint("rebalance", self.day)
            .write.partitionBy(self.day)
            .parquet(path)
        )
        written = self.spark.read.schema(self.schema).parquet(path)
        bad = F.count_if(breaks_any(self.rules())) if self.rules else F.lit(0)
        newest = F.max(self.newest).cast("timestamp_ntz") if self.newest else F.lit(None)
        per_day = written.groupBy(self.day).agg(
            F.count("*").alias("n"), bad.alias("bad"), newest.alias("newest")
        ).collect()
        if any(r["bad"] for r in per_day):
            raise BrokenRules(f"{sum(r['bad'] for r in per_day)} rows break a rule of {self.root}")
        if self.unique:
            if not written.groupBy(*self.unique).count().where("count > 1").isEmpty():
                raise DuplicateKeys(f"rows of {self.root} share {self.unique}")
        return [Folder(r[self.day], folder, r["n"], r["newest"], False) for r in per_day]

    def _check_keys(self, folders: Sequence[Folder], now: Snapshot, replaced: set[date]) -> None:
        """No key twice in what was written, nor again on a live day that is not replaced."""
        key = self.key_log.key
        counted = self._rows_of(folders).groupBy(F.col(key).alias("key")).agg(F.count("*").alias("n"))
        live = self.key_log.live(now.keys, now.dropped).where(~F.col("day").isin(*map(F.lit, replaced)))
        shared = counted.join(live.select("key", F.lit(True).alias("live")), "key", "left")
        if not shared.where("n > 1 OR live").isEmpty():
            raise DuplicateKeys(f"rows of {self.root} share a {key} with each other or with live rows")

    def _logged(self, rows: DataFrame, now: Snapshot) -> list[str]:
        """Write the keys of ``rows`` to the log; returns the parts of it that count from now on."""
        return self.key_log.append(
            rows.withColumn("day", F.col(self.day)), now.number + 1, now.keys, now.dropped
        )

    def _publish(self, now: Snapshot, change: _Change) -> None:
        stay = [f for f in now.folders if f.day not in change.gone]
        keys = list(now.keys) if change.keys is None else change.keys
        dropped = list(now.dropped) if change.dropped is None else change.dropped
        lines = [(None, None, None, None, None, keys, dropped)]
        lines += [(f.day, f.name, f.n, f.newest, f.keyed, None, None) for f in (*stay, *change.new)]
        (
            self.spark.createDataFrame(lines, _LIST)
            .coalesce(1)
            .write.json(f"{self.root}/published/publish={now.number + 1}")
        )

    def crowded(self) -> set[date]:
        """Days of so many folders that the next addition writes them anew."""
        held = Counter(f.day for f in self._snapshot().folders)
        return {d for d, n in held.items() if n >= FOLD}

    def replace_days(
        self,
        rows: DataFrame,
        days: Iterable[date],
        changed: DataFrame | None = None,
        grow: Iterable[date] = (),
    ) -> None:
        """``rows`` become the whole content of ``days``; a day without rows is emptied.

        Rows of other days, if these are among ``grow``, are added to them. With a key log,
        ``changed`` are the rows that it does not have yet.
        """
        self._replace(rows, set(days), changed, set(grow))

    def replace_all(self, rows: DataFrame) -> None:
        self._replace(rows, None, None)

    def _replace(
        self,
        rows: DataFrame,
        days: set[date] | None,
        changed: DataFrame | None,
        grow: Collection[date] = (),
    ) -> None:
        now = self._snapshot()
        new = self._write(rows)
        gone = {f.day for f in (*new, *now.folders)} if days is None else days
        outside = sorted({f.day for f in new} - gone - set(grow))
        if outside:
            raise ValueError(f"rows outside the days to replace: {outside}")
        if self.key_log and changed is not None:
            self._check_keys(new, now, gone)
            keys = self._logged(changed, now)
            new = [Folder(f.day, f.name, f.n, f.newest, True) for f in new]
            self._publish(now, _Change(gone, new, keys, self.key_log.left(keys, now)))
        else:
            self._publish(now, _Change(gone, new, None, self._dropped(now, gone)))

    def _dropped(self, now: Snapshot, days: Iterable[date]) -> list[tuple[date, str]]:
        """The keys logged so far under ``days`` no longer count."""
        if not now.keys:
            return list(now.dropped)
        upto = {**dict(now.dropped), **{d: KeyLog.upto(now.number + 1) for d in days}}
        return sorted(upto.items())

    def add(self, rows: DataFrame) -> int:
        """Add rows to their days and return how many."""
        return sum(self.added(rows).values())

    def added(self, rows: DataFrame) -> dict[date, int]:
        """Add rows; returns how many each day got."""
        now = self._snapshot()
        new = self._write(rows)
        if not new:
            return {}
        counts = {f.day: f.n for f in new}
        keys = None
        if self.key_log:
            self._check_keys(new, now, set())
            keys = self._logged(self._rows_of(new), now)
            new = [Folder(f.day, f.name, f.n, f.newest, True) for f in new]
        full = counts.keys() & self.crowded()
        if full:
            many = [f for f in (*now.folders, *new) if f.day in full]
            one = [
                Folder(f.day, f.name, f.n, f.newest, self.key_log is not None)
                for f in self._write(self._rows_of(many))
            ]
            new = [f for f in new if f.day not in full] + one
        left = self.key_log.left(keys, now) if keys is not None else None
        self._publish(now, _Change(full, new, keys, left))
        return counts

    def drop_day(self, day: date) -> int:
        """Remove one day and return how many rows it had."""
        now = self._snapshot()
        gone = sum(f.n for f in now.folders if f.day == day)
        self._publish(now, _Change({day}, [], None, self._dropped(now, [day])))
        return gone

"""Keys of all history in buckets, so that a load joins them where they lie.

An append-only log of (key, day, versions), bucketed by key. A load shuffles its own keys into the same
buckets and joins; nothing of the history moves, whatever its size. The log is a catalog table
over files next to the data, which is declared again where a session does not know it.

Each append is a part of its own, named by the publish it was made for. A part counts once a publish lists
it, so the keys of a load that failed before its commit are never seen. A new log gets as many buckets
as the session has shuffle partitions; the names of the parts keep the number. When ``MOST_PARTS`` are live the
next append writes the live keys with its own, bucket by bucket, as one part.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterable, Sequence
from datetime import date
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

MOST_PARTS = 64

_TYPES = {"batch_date": "date", "fetched_at": "timestamp_ntz", "ingest_seq": "bigint"}


class KeyLog:
    def __init__(self, spark: SparkSession, root: str, key: str, versions: Sequence[str] = ()):
        self.spark, self.key, self.versions = spark, key, tuple(versions)
        self.path = f"{root.rstrip('/')}/keys"
        self.table = f"spark_catalog.default.day_keys_{hashlib.md5(self.path.encode()).hexdigest()}"

    def _open(self, parts: Sequence[str]) -> int:
        """Declare the table and its ``parts`` where this session's catalog lacks them; its buckets."""
        setting = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        buckets = int(parts[0].split("-")[1]) if parts else setting
        first = f"{self.table}_{buckets}"
        if not self.spark.catalog.tableExists(first):
            versions = "".join(f", {c} {_TYPES[c]}" for c in self.versions)
            self.spark.sql(
                f"CREATE TABLE {first} (key string, day date{versions}, part string) USING parquet "
                f"PARTITIONED BY (part) CLUSTERED BY (key) SORTED BY (key) INTO {buckets} BUCKETS "
                f"LOCATION '{self.path}'"
            )
        known = {r[0] for r in self.spark.sql(f"SHOW PARTITIONS {first}").collect()}
        if any(f"part={p}" not in known for p in parts):
            self.spark.sql(f"ALTER TABLE {first} RECOVER PARTITIONS")
        return buckets

    @staticmethod
    def upto(publish: int) -> str:
        """Sorts after every part made for that publish or an earlier one."""
        return f"{publish:010d}~"

    def left(self, keys: Sequence[str], now: Any) -> list[tuple[date, str]]:
        """Dropped days that still concern one of the parts ``keys``."""
        return [(d, upto) for d, upto in now.dropped if any(k <= upto for k in keys)]

    def _entries(self, parts: Sequence[str]) -> DataFrame:
        return self.spark.table(f"{self.table}_{self._open(parts)}").where(F.col("part").isin(*parts))

    @staticmethod
    def _dead(dropped: Iterable[tuple[date, str]]) -> Column:
        dead = F.lit(False)
        for day, upto in dropped:
            dead |= (F.col("day") == F.lit(day)) & (F.col("part") <= upto)
        return dead

    def live(self, parts: Sequence[str], dropped: Iterable[tuple[date, str]] = ()) -> DataFrame:
        """The newest entry of each key (key, day, versions), unless its day was dropped since."""
        newest = F.max(F.struct(*self.versions, "part", "day"))
        found = self._entries(parts).groupBy("key").agg(newest.alias("e")).select("key", "e.*")
        return found.where(~self._dead(dropped)).select("key", "day", *self.versions, "part")

    def append(
        self,
        rows: DataFrame,
        publish: int,
        parts: Sequence[str],
        dropped: Iterable[tuple[date, str]] = (),
    ) -> list[str]:
        """Log ``rows`` (key column, day, versions); returns the parts that hold all live keys then."""
        buckets = self._open(parts)
        part = f"{publish:010d}-{buckets}-{uuid.uuid4().hex[:8]}"
        new = rows.select(F.col(self.key).cast("string").alias("key"), "day", *self.versions)
        new = new.repartition(buckets, "key")
        if len(parts) >= MOST_PARTS:
            new = self.live(parts, dropped).drop("part").unionByName(new)
            new = new.repartition(buckets, "key")
            parts = ()
        (
            new.withColumn("part", F.lit(part))
            .write.mode("append")
            .format("parquet")
            .partitionBy("part")
            .bucketBy(buckets, "key")
            .sortBy("key")
            .saveAsTable(f"{self.table}_{buckets}")
        )
        return [*parts, part]

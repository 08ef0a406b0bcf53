"""One row per key: latest version, first version, insert-if-new.

``row_number() = 1`` is cut to one row per key on the map side, so a key with very many
versions never travels whole to one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ORDER_VERSION = ("batch_date", "fetched_at", "ingest_seq")


def one_per_key(rows: DataFrame, key: str, order: Sequence[Column]) -> DataFrame:
    place = F.row_number().over(Window.partitionBy(key).orderBy(*order))
    return rows.withColumn("_place", place).where(F.col("_place") == 1).drop("_place")


def latest_orders(rows: DataFrame) -> DataFrame:
    """Newest version of each order over all batches given."""
    return one_per_key(rows, "order_id", [F.desc(c) for c in ORDER_VERSION])


def first_logs(rows: DataFrame) -> DataFrame:
    """Logs never change: the first fetch that has a log_id wins, its last copy within it."""
    return one_per_key(
        rows,
        "log_id",
        [F.asc("batch_date"), F.asc("fetched_at"), F.desc("ingest_seq"), F.desc("event_pos")],
    )


def unseen(rows: DataFrame, existing: DataFrame, key: str) -> DataFrame:
    """Rows whose key is not in ``existing``.

    The existing table is far larger than a batch. It is reduced to the keys the batch also
    has first (the batch side of that semi join can be broadcast when it is small), and only
    those keys take part in the anti join.
    """
    seen = existing.select(key).join(rows.select(key), key, "left_semi")
    return rows.join(seen, key, "left_anti")

"""Left join to a table with one row per key, safe for very common and missing keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Rows without a key are spread over this many join keys that match nothing.
NULL_KEYS = 1024


def lookup(rows: DataFrame, table: DataFrame, key: str, spread_by: str) -> DataFrame:
    """Add the other columns of ``table`` to ``rows``; null where the key has no match.

    Rows without a key would all hash to one task, so they get made-up keys drawn from the
    column ``spread_by``; the leading letter keeps those apart from real keys.

    A key with a large share of the rows is split at run time, which Spark does only when
    both inputs come straight from a shuffle. A table made by a window or an aggregate over
    the same key would be joined where it lies; joining on an expression of the key asks for
    a shuffle of it instead, and it is the small side. A small enough table is broadcast.
    """

    def known() -> Column:
        return F.concat(F.lit("k"), F.col(key).cast("string"))

    missing = F.concat(F.lit("n"), F.pmod(F.xxhash64(spread_by), F.lit(NULL_KEYS)))
    left = rows.withColumn("_key", F.coalesce(known(), missing))
    right = table.withColumn("_key", known()).drop(key)
    return left.join(right, "_key", "left").drop("_key")

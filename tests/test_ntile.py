"""The distributed NTILE equals the window function."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import rows
from tillmart.operators.ntile import add_ntiles, tile_starts
from tillmart.sources.shared import stored


@pytest.mark.parametrize("n", [0, 1, 2, 3, 4, 5, 6, 7, 11, 23, 100, 101])
def test_tile_starts(n):
    sizes = [n // 5 + (1 if t < n % 5 else 0) for t in range(5)]
    expected = [1 + sum(sizes[:t]) for t in range(1, 5) if sizes[t] > 0]
    assert tile_starts(n, 5) == expected


def _same(spark, frame, measures):
    frame = stored(frame, "test-ntile")
    plain = frame
    for name, column in measures.items():
        plain = plain.withColumn(name, F.ntile(5).over(Window.orderBy(column, "id")))
    assert rows(add_ntiles(frame, measures, "id")) == rows(plain)


@pytest.mark.parametrize("n", [0, 1, 2, 3, 4, 5, 6, 7, 11, 23])
def test_small(spark, n):
    frame = spark.range(n).select(
        F.col("id").cast("string").alias("id"),
        (F.col("id") % 3).cast("int").alias("a"),
        (100 - F.col("id")).alias("b"),
    )
    _same(spark, frame, {"ta": "a", "tb": "b"})


def test_one_value_holds_most_rows(spark):
    """Ties that fill several partitions are still cut at the right row."""
    frame = spark.range(0, 20_000, 1, 16).select(
        F.sha2(F.col("id").cast("string"), 256).alias("id"),
        F.when(F.col("id") % 10 == 0, F.col("id")).otherwise(7).alias("a"),
        F.lit(1).alias("b"),
        (F.rand(3) * 1000).cast("decimal(18,2)").alias("c"),
    )
    _same(spark, frame, {"ta": "a", "tb": "b", "tc": "c"})


def test_no_step_runs_in_one_task(spark):
    frame = stored(spark.range(1000).select(F.col("id").cast("string").alias("id"), F.lit(1).alias("a")), "t")
    plan = add_ntiles(frame, {"t": "a"}, "id")._jdf.queryExecution().toString()
    assert "SinglePartition" not in plan and "Exchange" not in plan

"""The lookup join: right with missing keys, split at run time when one key is very common."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import rows
from tillmart.operators.lookup import lookup


def test_missing_and_unmatched_keys(spark):
    left = spark.createDataFrame([(1, "a"), (2, None), (3, "b"), (4, "")], "i int, k string")
    table = spark.createDataFrame([("a", 10), ("", 40), ("n7", 70)], "k string, v int")
    assert rows(lookup(left, table, "k", "i"), "i", "k", "v") == [
        (1, "a", 10), (2, None, None), (3, "b", None), (4, "", 40),
    ]


@pytest.fixture
def no_broadcast(spark):
    small = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "50KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "50KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {k: spark.conf.get(k, None) for k in small}
    for k, v in small.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_a_common_key_is_split(spark, no_broadcast):
    n = 200_000
    common = F.pmod(F.xxhash64("id"), F.lit(3)) == 0
    left = spark.range(0, n, 1, 16).select(
        "id",
        F.when(common, "hot").otherwise(F.col("id").cast("string")).alias("k"),
        F.sha2(F.col("id").cast("string"), 256).alias("payload"),
    )
    newest = F.row_number().over(Window.partitionBy("k").orderBy("id"))
    table = left.withColumn("no", newest).where("no = 1").select("k", F.col("id").alias("first"))
    joined = lookup(left, table, "k", "id")
    wrong = joined.where("first IS NULL OR (k <> 'hot' AND first <> id)")
    assert wrong.count() == 0
    joined.collect()
    assert "skew=true" in joined._jdf.queryExecution().executedPlan().toString()

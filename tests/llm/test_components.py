"""Connected components of graphs with hubs, chains and repeated edges."""

import random
from statistics import median

from pyspark.sql import functions as F

from tillmart.llm.components import components, with_least


def _brute(edges):
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            root[x] = x = root[root[x]]
        return x

    for a, b in edges:
        low, high = sorted((find(a), find(b)))
        root[high] = low
    return {x: find(x) for x in list(root)}


def test_components_equal_union_find(spark):
    rng = random.Random(4)
    edges = [(i, i + 1) for i in range(0, 60)] + [(500, 500 + i) for i in range(1, 400)]
    edges += [(rng.randrange(1000, 1300), rng.randrange(1000, 1300)) for _ in range(200)]
    edges += [(2000 + i, 3000) for i in range(50)] + [(5, 5), (1, 0), (0, 1)]
    rng.shuffle(edges)
    found = dict(components(spark.createDataFrame(edges, "a long, b long").repartition(5)).collect())
    for node, root in _brute(edges).items():
        assert found.get(node, node) == root
    none = spark.createDataFrame([], "a long, b long")
    assert components(none).count() == 0


def test_no_task_holds_a_hub(spark):
    star = spark.range(1, 100_001).select(F.lit(0).cast("long").alias("u"), F.col("id").alias("v"))
    names = {
        "spark.sql.adaptive.enabled": "false",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.shuffle.partitions": "8",
    }
    before = {n: spark.conf.get(n) for n in names}
    try:
        for n, value in names.items():
            spark.conf.set(n, value)
        joined = with_least(star, "u", "v")
        assert joined.where("m <> 1").isEmpty()
        sizes = [r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        for n, value in before.items():
            spark.conf.set(n, value)
    assert sum(sizes) == 100_000 and len(sizes) == 8 and max(sizes) < 3 * median(sizes)

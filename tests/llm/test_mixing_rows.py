"""Draws of the mix where doc_ids are null or repeated, rates are high, or column names clash."""

from conftest import rows

import corpus_pipeline
from tillmart.llm import mixing

SCHEMA = "doc_id long, text string, source string"


def test_null_and_hot_ids_are_copied_at_their_rate(spark, sf_dir):
    given = [(i, f"t{i}", f"s{i % 2}") for i in range(4000)]
    given += [(None, f"n{i}", f"s{i % 2}") for i in range(2000)]
    given += [(None, "same", "s0")] * 1000 + [(7, "hot", "s1")] * 500
    given += [(7, f"hot{i}", "s1") for i in range(500)]
    table = spark.createDataFrame(given, SCHEMA).repartition(4)
    found = corpus_pipeline.source_mix(spark, table, sf_dir).collect()
    for n, some in (
        (2000, [r for r in found if r.doc_id is None and r.text != "same"]),
        (1000, [r for r in found if r.text == "same"]),
        (500, [r for r in found if r.text == "hot"]),
        (500, [r for r in found if r.text.startswith("hot") and r.text != "hot"]),
    ):
        assert abs(len(some) - n) < 5 * n**0.5
    again = mixing.mixed(table.repartition(7))
    columns = (*table.columns, "copy", "shuffle_key")
    assert rows(again, *columns) == rows(mixing.mixed(table), *columns)
    keys = [r.shuffle_key for r in again.select("shuffle_key").collect()]
    assert len(set(keys)) == len(keys)


def test_high_rates_and_clashing_names(spark):
    names = ["_below", "_key", "_u", "_copies", "_source", "_place", "_h", "_at", "_n", "_first", "_row", "copy"]
    given = [(i, "t", "s", *range(i, i + len(names))) for i in range(3)]
    schema = f"{SCHEMA}, " + ", ".join(f"{n} int" for n in names)
    found = mixing.mixed(spark.createDataFrame(given, schema), {"s": 1.0}, total=60000)
    assert found.columns == ["doc_id", "text", "source", *names[:-1], "copy", "shuffle_key"]
    got = found.groupBy(*found.columns[:-2]).count().collect()
    assert {tuple(r)[3:-1] for r in got} == {g[3:-1] for g in given}
    assert all(abs(r["count"] - 20000) < 5 * 20000**0.5 for r in got)

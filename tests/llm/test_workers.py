"""What goes to the Python workers, and what comes back from them."""

from pyspark.sql import functions as F

from tillmart.llm import repeats, simhash

SCHEMA = "doc_id long, text string, source string"


def test_prints_bring_no_text_back(spark, monkeypatch):
    given = [(i, " ".join(f"w{i // 2}x{j}" for j in range(40)), "web") for i in range(6)]
    table = spark.createDataFrame([*given, (7, None, "web"), (None, None, "web")], SCHEMA).repartition(3)
    asked, found = [], simhash._with_prints
    monkeypatch.setattr(simhash, "_with_prints", lambda d, c: asked.append(c) or found(d, c))
    kept = simhash.kept_documents(table)
    assert asked == [["doc_id", "_row"]]
    assert kept.columns == table.columns
    assert {r.doc_id for r in kept.collect()} == {0, 2, 4, 7}


def test_texts_pass_the_workers_once_when_spans_are_joined(spark):
    passage = "A passage of words that is long enough to be found again, " * 5
    texts = ["one " + passage, passage + "two", None, "", "short"]
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(2)
    report = repeats.report(table)
    plan = report._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("MapInArrow") == 1
    removed = {r.doc_id: r.n_removed for r in report.collect()}
    assert min(removed[0], removed[1]) >= len(passage)
    assert removed[2] == removed[3] == removed[4] == 0


def test_text_keys_tell_texts_apart(spark):
    table = spark.createDataFrame([("a" * n,) for n in range(2000)] + [(None,)], "text string")
    k, k2 = repeats._key_columns(F.col("text"))
    assert table.select(k, k2).distinct().count() == 2000
    assert table.select(k).distinct().count() == 2000

"""The sample that language identification is fitted on."""

import zlib

import numpy as np
from pyspark.sql import functions as F

from tillmart.llm import language_id

WORDS = {"aa": "tala mira sono bela", "bb": "krut whox zyng qwer", "cc": "oooo eeee iiii uuuu"}


def test_sample_is_bounded_whatever_repeats(spark):
    given = [(7, WORDS["aa"], "aa")] * 3000 + [(7, f"{WORDS['aa']} {i}", "aa") for i in range(3000)]
    given += [(i, f"{WORDS['bb']} {i}", "bb") for i in range(2000)] + [(1, WORDS["cc"], "cc")]
    learn = spark.createDataFrame(given, "doc_id long, text string, lang string").repartition(5)
    drawn = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    learn = learn.withColumn("drawn", drawn)
    sizes = {
        r.lang: (r.n, r.low)
        for r in learn.groupBy("lang").agg(F.count("*").alias("n"), F.min("drawn").alias("low")).collect()
    }
    found = language_id._sample(learn, sizes, 300).collect()
    by_label = {s: [r for r in found if r.lang == s] for s in WORDS}
    assert [len(by_label[s]) for s in WORDS] == [100, 100, 1]
    for s in ("aa", "bb"):
        every = sorted({r.drawn for r in learn.where(F.col("lang") == s).select("drawn").collect()})
        assert sorted(r.drawn for r in by_label[s]) == every[:100]


def test_hot_doc_id_is_learned_from_and_predictions_are_a_softmax(spark):
    hot = next(i for i in range(9) if zlib.crc32(str(i).encode()) % 4 != 2)
    given = [(hot, f"{WORDS['aa']} {i}", "aa") for i in range(400)]
    given += [(i, f"{WORDS['bb']} {i}", "bb") for i in range(400)]
    table = spark.createDataFrame(given, "doc_id long, text string, lang string").repartition(3)
    model = language_id.train(table)
    assert model.labels == ["aa", "bb"]
    found = language_id.predicted(table, model).collect()
    right = {d: lang for d, _, lang in given if d != hot}
    assert all(r.lang_pred == right[r.doc_id] for r in found if r.doc_id in right)
    texts = sorted({t for _, t, _ in given})[:20]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    for r in language_id.predicted(rows, model).collect():
        words = [w.encode() for w in texts[r.doc_id].split()]
        buckets = language_id.grams(words)[0]
        weights = np.zeros((language_id.BUCKETS, 2))
        weights[model.buckets] = model.weights
        logits = model.bias + language_id.SCALE * weights[buckets].sum(0) / len(buckets)
        p = np.exp(logits / model.temperature)
        p /= p.sum()
        assert r.lang_pred == model.labels[p.argmax()] and abs(r.score - p.max()) < 1e-9

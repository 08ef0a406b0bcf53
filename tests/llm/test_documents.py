"""Line rules, near-duplicates, repeats, languages, mixing and the pipeline, on documents."""

import random
import zlib

import brute
import pytest
from compare import connect, differences
from conftest import rows
from pyspark.sql import functions as F

import corpus_pipeline
from tillmart.llm import language_id, line_rules, mixing, repeats, simhash
from tillmart.llm.suffixes import maximal_repeats

SCHEMA = "doc_id long, text string"


def frame(spark, given, schema=SCHEMA):
    return spark.createDataFrame(given, schema).repartition(3)


def documents(spark, sf_dir, n):
    table = spark.read.parquet(f"{sf_dir}/documents.parquet").orderBy("doc_id").limit(n)
    return [(r.doc_id, r.text) for r in table.collect()]


EDGES = [
    (1, None),
    (2, ""),
    (3, " \n\t\x0b\n"),
    (4, "word"),
    (5, "One two. " * 30),
    (6, "\n".join(f"Line {i} has some words of its own {i * 7}, {i * 13}." for i in range(12))),
    (7, "a | b | c | d\n" * 3 + "All rights reserved.\n" + "x" * 500),
    (8, "### one $$$ two %%%\n" * 20),
    (6, "\n".join(f"Line {i} has some words of its own {i * 7}, {i * 13}." for i in range(12))),
    (None, "Été 漢字. " * 40),
    (9, "q w e r t y. " * 4000),
]


def test_line_rules_equal_sql(spark, tmp_path):
    frame(spark, EDGES).write.parquet(str(tmp_path / "documents.parquet"))
    con = connect("/root/testdata/sf0.001")
    con.execute(
        "CREATE OR REPLACE VIEW documents AS SELECT * FROM "
        f"read_parquet('{tmp_path}/documents.parquet/*.parquet')"
    )
    table = spark.read.parquet(str(tmp_path / "documents.parquet"))
    assert differences(line_rules.report(table), con, line_rules.SQL) is None


def test_line_rules_verdicts(spark):
    good = "\n".join(f"Word{i} follows name{i} until place{i * i} ends." for i in range(12))
    given = [
        (1, good),
        (2, good + "\nAll rights reserved.\nHome | About | News | Login"),
        (3, good + "\n" + "alpha | beta | gamma | delta | eps\n" * 3 + "one | two | three\n" * 40),
        (4, "Short text."),
    ]
    table = frame(spark, given).selectExpr("*", "'x' AS n_words", "1 AS n_chars", "2 AS _w")
    kept = {r.doc_id: r for r in line_rules.cleaned(table).collect()}
    assert set(kept) == {1, 2}
    assert kept[1].text == kept[2].text == good
    assert kept[2].n_chars == len(good)
    assert kept[1].n_words == "x"
    assert line_rules.report(table.limit(0)).count() == 0


@pytest.mark.parametrize("cell", [4096, 5])
def test_simhash_equals_brute_force(spark, sf_dir, monkeypatch, cell):
    monkeypatch.setattr(simhash, "CELL", cell)
    rng = random.Random(4)
    base = [f"w{rng.randint(0, 400)}" for _ in range(300)]
    near = []
    for i in range(25):
        words = list(base)
        words[rng.randrange(300)] = f"new{i}"
        near.append((1000 + i, " ".join(words)))
    given = [*EDGES, *documents(spark, sf_dir, 120), *near, (None, near[0][1])]
    table = frame(spark, given).selectExpr("*", "1 AS fp", "2 AS node")
    want = brute.simhash(given)
    assert rows(simhash.near_duplicates(table)) == sorted(want, key=repr)
    ids = {c for *_, c in want if c is not None}
    kept = simhash.kept_documents(table)
    assert kept.columns == table.columns
    found = [r.doc_id for r in kept.collect()]
    assert {d for d in found if d is not None} == ids
    # One row for every component, also where components share a doc_id.
    assert len(found) == len(set(brute.groups(given)))


def test_simhash_of_nameless_and_no_rows(spark):
    table = frame(spark, [(None, "a b c d e"), (None, "a b c d e"), (None, None)])
    assert simhash.kept_documents(table).count() == 2
    assert simhash.near_duplicates(table.limit(0)).count() == 0
    assert simhash.kept_documents(table.limit(0)).count() == 0


def test_every_close_pair_shares_a_home_anchor():
    rng = random.Random(5)
    for _ in range(300):
        x = rng.getrandbits(64)
        y = x
        for bit in rng.sample(range(64), 4):
            y ^= 1 << bit
        met = False
        for first, bits in simhash.PARTS:
            a, b = (v >> first & ((1 << bits) - 1) for v in (x, y))
            s = simhash._syndrome(a)
            home = a ^ (1 << (s - 1)) if s else a
            met |= home in {b ^ m for m in simhash._masks(bits)[simhash._syndrome(b)]}
        assert met


def test_maximal_repeats_equal_brute_force():
    rng = random.Random(6)
    for turn in range(150):
        letters = b"ab" if turn % 2 else b"abc\x00"
        strings = [
            bytes(rng.choices(letters, k=rng.randint(0, 25))) for _ in range(rng.randint(0, 5))
        ]
        least, seen = rng.randint(2, 6), {}
        for i, s in enumerate(strings):
            for a in range(len(s)):
                for b in range(a + least, len(s) + 1):
                    seen.setdefault(s[a:b], []).append((i, a))

        def free(sides):
            return len(set(sides)) > 1 or -1 in sides

        want = [
            (len(w), sorted(at))
            for w, at in seen.items()
            if len(at) > 1
            and free([strings[i][a - 1] if a else -1 for i, a in at])
            and free([strings[i][a + len(w) :][:1] or -1 for i, a in at])
        ]
        assert sorted(maximal_repeats(strings, least)) == sorted(want)


def passages():
    rng = random.Random(7)

    def text(words):
        return " ".join("".join(rng.choices("abcdefgé", k=rng.randint(1, 6))) for _ in range(words))

    shared, out = [text(120) for _ in range(6)], []
    for i in range(150):
        body, kind = text(rng.randint(0, 150)), rng.random()
        passage = rng.choice(shared)
        if kind < 0.3:
            body += passage + text(rng.randint(0, 60))
        elif kind < 0.5:
            a = rng.randint(0, 200)
            body += passage[a : a + rng.choice([150, 199, 200, 201, 230, 300])] + text(10)
        elif kind < 0.6:
            a = rng.randrange(len(passage))
            body = passage[:a] + "#" + passage[a + 1 :]
        out.append((i, body))
    return out + [
        (900, out[3][1]), (900, out[3][1]), (902, "a" * 500), (903, "a" * 150), (904, "ab" * 400),
        (907, "x" * 199), (908, shared[0] * 3), (909, "line 1\n" * 100), (None, out[5][1]),
        (910, "0123456789" * 25), *EDGES,
    ]


@pytest.mark.parametrize("most, block", [(4096, 1 << 20), (8, 1000)])
def test_repeats_equal_brute_force(spark, sf_dir, monkeypatch, most, block):
    monkeypatch.setattr(repeats, "MOST", most)
    monkeypatch.setattr(repeats, "BLOCK", block)
    given = passages() + documents(spark, sf_dir, 150)
    table = frame(spark, given).selectExpr("*", "1 AS k", "2 AS pos", "'z' AS _at")
    assert rows(repeats.report(table)) == sorted(brute.covered(given), key=repr)


def test_repeats_leave_other_columns_and_empty_tables(spark):
    given = [(1, "ué" * 150 + " one", 5, "x"), (2, "ué" * 150 + " two", 6, None)]
    table = frame(spark, given, f"{SCHEMA}, n_chars int, k string")
    found = repeats.without_repeats(table)
    assert found.columns == table.columns
    # "ué" * 150 and the space after it are shared.
    assert rows(found) == [(1, "one", 3, "x"), (2, "two", 3, None)]
    assert repeats.report(table.limit(0)).count() == 0
    assert repeats.without_repeats(table.limit(0)).count() == 0


def test_language_on_held_out_documents(spark, sf_dir):
    table = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    hidden = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2
    # What must not be read for held-out documents is spoilt.
    spoilt = table.withColumn("lang", F.when(hidden, "xx").otherwise(F.col("lang")))
    found = language_id.identified(spoilt.withColumn("source", F.lit("zz"))).collect()
    truth = {r.doc_id: r.lang for r in table.collect()}
    assert len(found) == len(truth)
    for r in found:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        assert 0 <= r.score <= 1 and r.lang_pred != "xx"
    out = [r.lang_pred == truth[r.doc_id] for r in found if r.held_out]
    assert sum(out) >= 0.98 * len(out)


def test_language_edges(spark):
    schema = f"{SCHEMA}, lang string, score int"
    given = [(i, f"the cat and dog {i}", "en", 1) for i in range(40)]
    given += [(i, f"der hund und über {i}", "de", 1) for i in range(40, 80)]
    given += [(100, None, "en", 1), (101, "12 !?", "de", 1), (None, "the dog", None, 1), (102, "", "fr", 1)]
    given += [(103, "der hund " * 20000, None, 1), (103, "der hund", None, 1)]
    found = {}
    for r in language_id.identified(frame(spark, given, schema)).collect():
        found.setdefault(r.doc_id, r)
    assert [found[i].lang_pred for i in (0, 79, 100, 101, 102, 103, None)] == [
        "en", "de", "und", "und", "und", "de", "en",
    ]
    assert found[None].held_out is False and found[100].score == 0
    none = frame(spark, [(1, "text", None, 1)], schema)
    assert [r.lang_pred for r in language_id.identified(none).collect()] == ["und"]
    assert language_id.identified(none.limit(0)).count() == 0


def test_mixing_follows_the_weights(spark):
    given = [(i, f"t{i}", "big" if i % 10 else "small", i) for i in range(20000)]
    given += [(30000, None, None, 1), (30000, None, None, 1)]
    table = frame(spark, given, f"{SCHEMA}, source string, copy int")
    found = mixing.mixed(table, {"big": 1.0, "small": 3.0}, total=40000)
    n = dict(found.groupBy("source").count().collect())
    assert abs(n["big"] - 10000) < 400 and abs(n["small"] - 30000) < 700 and set(n) == {"big", "small"}
    keys = [r.shuffle_key for r in found.select("shuffle_key").where("source = 'big'").collect()]
    assert len(set(keys)) == len(keys)
    nulls = mixing.mixed(table, exponent=0.1).where("doc_id = 30000").collect()
    # Equal rows draw for themselves: their copies are numbered apart.
    assert nulls and sum(r.copy == 1 for r in nulls) in (1, 2)
    assert len({r.shuffle_key for r in nulls}) == len(nulls)
    assert mixing.mixed(table.limit(0)).count() == 0
    plain = mixing.MOST_ENTRIES
    mixing.MOST_ENTRIES = 0
    try:
        assert rows(mixing.mixed(table, {"big": 1.0, "small": 3.0}, total=40000)) == rows(found)
    finally:
        mixing.MOST_ENTRIES = plain


def test_mixing_equals_sql_on_edges(spark, tmp_path):
    given = [(i, None, f"s{i % 3}") for i in range(50)] + [(None, "x", None), (7, "y", "s1"), (7, "y", "s1")]
    frame(spark, given, f"{SCHEMA}, source string").write.parquet(str(tmp_path / "d"))
    con = connect("/root/testdata/sf0.001")
    con.execute(
        f"CREATE OR REPLACE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/d/*.parquet')"
    )
    table = spark.read.parquet(str(tmp_path / "d"))
    assert differences(mixing.mixed(table), con, mixing.sql(["doc_id", "text", "source"])) is None


def test_pipeline_stages(spark, sf_dir):
    table = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns, now = table.columns, table.cache()
    report = {r.doc_id: r for r in line_rules.report(table).collect()}
    for name, stage in corpus_pipeline.STAGES:
        before = now.collect()
        now = stage(spark, now, sf_dir).cache()
        after = now.collect()
        given = [(r.doc_id, r.text) for r in before]
        if name != "sequences":
            assert now.columns == columns
            assert all(r.n_chars == len(r.text) for r in after if name != "near_duplicates")
        if name == "quality_rules":
            assert {r.doc_id for r in after} == {d for d, r in report.items() if r.kept}
        elif name == "near_duplicates":
            assert {r.doc_id for r in after} == {c for *_, c in brute.simhash(given)}
            assert len({r.doc_id for r in after}) == len(after)
        elif name == "repeated_passages":
            left = {d: n - gone for d, n, gone, *_ in brute.covered(given)}
            assert all(0 <= left[r.doc_id] - len(r.text.encode()) <= 8 for r in after)
            assert {r.doc_id for r in after} == {d for d, n in left.items() if n > 8}
        elif name == "source_mix":
            assert {(r.doc_id, r.text) for r in after} <= set(given)
            assert 0.7 * len(before) < len(after) < 1.4 * len(before)
        else:
            total = sum(len(brute.ids(t)) for _, t in given)
            assert sum(r.length for r in after) == total
    assert corpus_pipeline.run(spark, sf_dir).count() > 0

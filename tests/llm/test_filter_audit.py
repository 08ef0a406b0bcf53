"""Posting lists and the filter audit against plain sets."""

from itertools import permutations

from brute import WORD
from conftest import rows
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tillmart.llm import filter_audit

ids = st.lists(st.integers(0, 400), unique=True).map(sorted)


@settings(deadline=None, max_examples=200)
@given(st.lists(ids, max_size=5), ids, st.integers(0, 401))
def test_merges_equal_sets(lists, own, sought):
    assert filter_audit.union(lists) == sorted(set().union(*lists))
    for other in lists:
        assert filter_audit.difference(own, other) == sorted(set(own) - set(other))
    for at in range(0, len(own) + 1, 3):
        want = next((n for n in range(at, len(own)) if own[n] >= sought), len(own))
        assert filter_audit.gallop(own, sought, at) == want


def fails(docs):
    """Bits of failed filters of every (doc_id, text, lang)."""
    out = []
    for doc_id, text, _ in docs:
        text = text or ""
        words = WORD.findall(text)
        earlier = [d for d, t, _ in docs if (t or "") == text and None not in (d, doc_id) and d < doc_id]
        out.append(
            (
                len(words) < 200,
                100 * len(set(words)) < 50 * len(words),
                100 * sum("A" <= c <= "Z" for c in text) > 3 * len(text),
                any(c in "#$%&*|" for c in text),
                bool(earlier),
            )
        )
    return out


def audited(docs, labels):
    good = {d for d, q, _ in labels if q == 1 and d is not None}
    toxic = {d for d, _, t in labels if t == 1 and d is not None}
    found = fails(docs)
    out = []
    for part in {lang or "" for *_, lang in docs}:
        own = [(d, f) for (d, _, lang), f in zip(docs, found, strict=True) if (lang or "") == part]
        total = [0] * 5
        rows_of = []
        for order in permutations(range(5)):
            left = own
            for step, n in enumerate(order, 1):
                gone = [x for x in left if x[1][n]]
                left = [x for x in left if not x[1][n]]
                total[n] += len(gone)
                failing = [x for x in own if x[1][n]]
                rows_of.append(
                    (
                        n,
                        part, "".join("ABCDE"[i] for i in order), step, len(left), len(gone),
                        len(failing) - len(gone), sum(sum(f) == 1 for _, f in failing),
                        sum(d in good for d, _ in gone), sum(d in toxic for d, _ in gone),
                    )
                )
        out += [(*r[1:], total[r[0]]) for r in rows_of]
    return sorted(out, key=repr)


LONG = " ".join(f"w{n}" for n in range(210))
EDGES = [
    (5, LONG, "en"), (3, LONG, "de"), (5, LONG, "en"), (None, LONG, "en"), (None, LONG, None),
    (1, None, "en"), (2, "", "en"), (9, "", None), (4, LONG + " 50%", "en"), (6, "A A a a a", "de"),
    (7, "x " * 300, "en"), (8, LONG.upper(), "en"), (10, "tab\tline\n" * 150, "fr"), (11, "é" * 5000, "fr"),
    (12, LONG + " |", None),
]
LABELS = [(5, 1, 0), (5, 0, 1), (4, 1, 1), (None, 1, 1), (12, None, 1), (1, 0, 0), (99, 1, 1)]


def frames(spark, docs, labels):
    given = spark.createDataFrame(docs, "doc_id long, text string, lang string")
    return (
        given.withColumns({"bits": F.lit("x"), "part": F.lit("y"), "_row": F.lit(0), "same": F.lit(1)}),
        spark.createDataFrame(labels, "doc_id long, quality int, toxic int"),
    )


def test_report_equals_brute_force_on_edges(spark):
    docs, labels = frames(spark, EDGES, LABELS)
    assert rows(filter_audit.report(docs, labels)) == audited(EDGES, LABELS)


def test_empty_tables(spark):
    docs, labels = frames(spark, [], [])
    assert filter_audit.report(docs, labels).count() == 0
    docs, labels = frames(spark, EDGES, [])
    assert rows(filter_audit.report(docs, labels)) == audited(EDGES, [])


def test_lists_of_a_common_id_and_part_are_cut_into_ranges(spark):
    docs = spark.range(1000).select(
        F.when(F.col("id") < 700, 7).otherwise(F.col("id")).alias("doc_id"),
        F.when(F.col("id") % 10 == 0, "b").otherwise("a").alias("part"),
        (F.col("id") % 3 == 0).alias("f"),
        (F.col("id") % 7 == 0).alias("m"),
    )
    lists = filter_audit.posting_lists(docs, F.col("part"), {"F": F.col("f")}, {"m": F.col("m")}, most=64)
    found = lists.select(F.size("ids").alias("n"), "ids", "F", "m").collect()
    assert max(r.n for r in found) == 64 and sum(r.n for r in found) == 1000
    assert all(list(r.ids) == sorted(r.ids) and list(r.F) == sorted(r.F) for r in found)
    want = docs.where("f").select("part", "doc_id")
    assert rows(filter_audit.failing(lists, "F")) == rows(want)
    audit = {(r.part, r.filter_order): r for r in filter_audit.audit(lists, ["F"], ["m"]).collect()}
    for part in "ab":
        own = docs.where(F.col("part") == part)
        row = audit[part, "F"]
        assert (row.removed, row.kept) == (own.where("f").count(), own.where("NOT f").count())
        assert row.m_lost == own.where("f AND m").count()
        assert (row.unique_fails, row.redundant, row.shapley) == (row.removed, 0, row.removed)

"""Codebooks and codes against a plain restatement with unbounded integers."""

import hashlib
import math

import numpy as np
import pytest
from conftest import rows
from pyspark.sql import functions as F

from tillmart.llm import vector_codes


def coded(table):
    """(vec_id, code, error, label_error, digest) of (vec_id, embedding, label)."""
    given = [
        (v, [math.floor(1024 * float(x)) for x in e], label)
        for v, e, label in table
        if e is not None and all(x is not None and math.isfinite(x) for x in e)
    ]
    given.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    if not given:
        return []
    size = len(given[0][1]) // 4
    parts = [[r[1][p * size : (p + 1) * size] for r in given] for p in range(4)]
    books = [own[:256] for own in parts]

    def nearest(p, x):
        return min((sum((a - b) ** 2 for a, b in zip(x, c, strict=True)), e) for e, c in enumerate(books[p]))

    for _ in range(4):
        new = []
        for p in range(4):
            held = [[] for _ in books[p]]
            for x in parts[p]:
                held[nearest(p, x)[1]].append(x)
            new.append(
                [[sum(c) // len(h) for c in zip(*h, strict=True)] if h else old
                 for h, old in zip(held, books[p], strict=True)]
            )
        books = new
    best = [[nearest(p, parts[p][i]) for p in range(4)] for i in range(len(given))]
    errors = [sum(q for q, _ in b) for b in best]
    by_label = {}
    for (_, _, label), e in zip(given, errors, strict=True):
        by_label[label] = by_label.get(label, 0) + e
    flat = ",".join(str(c) for book in books for entry in book for c in entry)
    digest = hashlib.sha256(flat.encode()).hexdigest()
    return [
        (v, "".join(f"{e:02x}" for _, e in b), err, by_label[label], digest)
        for (v, _, label), b, err in zip(given, best, errors, strict=True)
    ]


def frame(spark, table):
    given = spark.createDataFrame(table, "vec_id long, embedding array<float>, label int")
    return given.withColumns({"ints": F.lit(1), "code": F.lit("x"), "near": F.lit(0), "_l": F.lit("y")})


def drawn(n, size, steps, seed):
    """Vectors on a coarse grid, so that distances tie often."""
    r = np.random.default_rng(seed)
    grid = r.integers(-steps, steps + 1, (n, size)) / 64
    return [(int(i), [float(x) for x in v], int(i) % 5 or None) for i, v in enumerate(grid)]


@pytest.mark.parametrize("size, steps", [(8, 12), (4, 200), (16, 30)])
def test_report_equals_brute_force(spark, size, steps):
    table = drawn(420, size, steps, size)
    found = rows(vector_codes.report(frame(spark, table)))
    assert found == sorted(coded(table), key=repr)


def test_edges(spark):
    table = drawn(300, 8, 9, 1)
    nan, inf = float("nan"), float("inf")
    odd = [[nan] * 8, [inf] + [0.0] * 7, [None] + [0.0] * 7, None, [-inf] * 8]
    table += [(1000 + n, e, 1) for n, e in enumerate(odd)]
    table += [(None, [0.25] * 8, None), (None, [0.5] * 8, 3), (7, [0.125] * 8, 2), table[7], table[7]]
    table += [(-5, [-0.0001] * 8, 1), (2000, [90000.0] + [0.0] * 7, 1)]
    assert rows(vector_codes.report(frame(spark, table))) == sorted(coded(table), key=repr)


def test_few_or_no_rows_and_vectors_that_do_not_fit(spark):
    few = drawn(3, 8, 9, 2)
    assert rows(vector_codes.report(frame(spark, few))) == sorted(coded(few), key=repr)
    assert vector_codes.report(frame(spark, [])).count() == 0
    assert vector_codes.report(frame(spark, [(1, None, 1)])).count() == 0
    for bad in ([(1, [0.0] * 8, 1), (2, [0.0] * 4, 1)], [(1, [0.0] * 6, 1)]):
        with pytest.raises(ValueError, match="cannot be cut"):
            vector_codes.report(frame(spark, bad))
    with pytest.raises(Exception, match="not below"):
        vector_codes.report(frame(spark, [(1, [1e9] * 8, 1)]))


def test_bounds_spare_most_comparisons(spark):
    r = np.random.default_rng(3)
    centres = r.normal(0, 1, (300, 16))
    points = centres[r.integers(0, 300, 3000)] + r.normal(0, 0.05, (3000, 16))
    table = [(i, [float(x) for x in p], 1) for i, p in enumerate(points)]
    fitted = vector_codes.fit(frame(spark, table))
    assert fitted.work[0] == (0, 0, 12000)
    for certain, some, all_entries in fitted.work[1:]:
        assert certain + some + all_entries == 12000
        assert all_entries < 9000, fitted.work
    assert fitted.work[-1][0] > 6000 and fitted.work[-1][2] < 3000, fitted.work
    back = vector_codes.decoded(fitted.rows, fitted.codebooks)
    error = {r.vec_id: r.error for r in fitted.rows.collect()}
    for row in back.where("vec_id < 20").collect():
        gap = np.floor(points[row.vec_id].astype(np.float32).astype(float) * 1024) - np.array(row.embedding) * 1024
        assert round(float((gap * gap).sum())) == error[row.vec_id]

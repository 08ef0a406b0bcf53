"""WARC archives and embedding links."""

import numpy as np
import pytest
from brute import captures, vector_links
from conftest import rows

from tillmart.llm import vector_links as links
from tillmart.llm import warc
from tillmart.sources.shared import new_folder

PAGES = [
    (1000, "http://a/b\r\nc", "x\r\n\r\nWARC/1.0\r\nWARC-Type: response\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"),
    (1001, None, None), (1002, "http://[bad", ""), (None, "u", "dup"), (1003, "u", "dup"),
    (1004, "u", "dup"), (1004, "u", "dup"), (1003, "u", "dup"), (None, None, "lone"),
    (1005, "u", "WARC/1.0\r\n"), (1006, "é", "é漢\r\n\r\n\r\n"),
    (1007, "u", "WARC/1.0\r\nWARC/1.0\r\n\r\n\r\n"), (1008, "u", "long " * 100000),
]


@pytest.mark.parametrize("most", [200_000, 0])
def test_warc_round_trip(spark, sf_dir, monkeypatch, most):
    monkeypatch.setattr(warc, "MOST_BROADCAST", most)
    table = spark.read.parquet(f"{sf_dir}/pages.parquet").limit(30)
    given = [(r.page_id, r.url, r.html) for r in table.collect()] + PAGES
    pages = spark.createDataFrame(given, "page_id long, url string, html string").repartition(4)
    pages = pages.selectExpr("*", "1 AS first", "'x' AS value")
    path = new_folder(spark, "w")
    assert rows(warc.round_trip(pages, path)) == sorted(captures(given), key=repr)
    nested = warc.captures(warc.read(spark, path)).collect()
    assert len(nested) == len(given) == len({r.record_id for r in nested})
    assert all(len(r.requests) == len(r.metadata) == 1 for r in nested)
    payloads = {r.payload_digest: bytes(r.payload) for r in nested if r.type == "response"}
    assert set(payloads.values()) == {(h or "").encode() for *_, h in given}
    empty = new_folder(spark, "w")
    assert warc.round_trip(pages.limit(0), empty).count() == 0


def test_transactions_join_either_way(spark):
    record = [c.split()[0] for c in warc.RECORD.split(", ")]
    made = [
        {"record_id": "q", "type": "request", "concurrent_to": None},
        {"record_id": "r", "type": "response", "concurrent_to": "q"},
        {"record_id": "m", "type": "metadata", "concurrent_to": "q"},
        {"record_id": "alone", "type": "response", "concurrent_to": None},
        {"record_id": "lost", "type": "metadata", "concurrent_to": "nobody"},
        {"record_id": None, "type": "response", "target_uri": "a"},
        {"record_id": None, "type": "request"},
        {"record_id": None, "type": "response", "target_uri": "b"},
    ]
    table = spark.createDataFrame([tuple(m.get(c) for c in record) for m in made], warc.RECORD)
    captured = warc.captures(table).collect()
    # Records without ids are captures of their own.
    nameless = [r for r in captured if r.record_id is None]
    assert sorted(r.target_uri for r in nameless) == ["a", "b"]
    assert all(r.requests == [] for r in nameless)
    found = {r.record_id: r for r in captured if r.record_id is not None}
    assert set(found) == {"r", "alone"}
    assert [x.record_id for x in found["r"].requests] == ["q"]
    assert [x.record_id for x in found["r"].metadata] == ["m"]
    assert found["alone"].requests == []


def test_a_payload_full_of_marks_is_put_together_once(spark):
    html = "WARC/1.0\r\n" * 20_000
    pages = spark.createDataFrame([(1, "u", html), (2, "u", html), (3, "u", "x")], "page_id long, url string, html string")
    path = new_folder(spark, "w")
    found = {r.page_id: r for r in warc.round_trip(pages, path).collect()}
    assert {i: r.payload_bytes for i, r in found.items()} == {1: len(html), 2: len(html), 3: 1}
    assert found[2].refers_to == 1


@pytest.mark.parametrize("cell", [1024, 16])
def test_vector_links_equal_brute_force(spark, sf_dir, monkeypatch, cell):
    monkeypatch.setattr(links, "CELL", cell)
    rng = np.random.default_rng(1)
    base = rng.standard_normal(64)
    table = spark.read.parquet(f"{sf_dir}/embeddings.parquet").limit(150)
    given = [(r.vec_id, list(r.embedding)) for r in table.collect()]
    given += [(100000 + i, (base + rng.standard_normal(64) * 0.2).tolist()) for i in range(120)]
    given += [(200000 + i, base.tolist()) for i in range(5)]
    given += [
        (None, [1.0] * 64), (7, None), (8, [0.0] * 64), (9, [float("nan")] * 64), (10, [None] * 64),
        (11, [1.0] * 3), (12, [2.0] * 3), (13, []), (11, [1.0] * 3), (14, [1e300, 1e300]),
        (15, [3e299, 3e299]), (16, [float("inf"), 1.0]), (17, [1e-300, 1e-300]),
    ]
    frame = spark.createDataFrame(given, "vec_id long, embedding array<double>").repartition(4)
    frame = frame.selectExpr("*", "1 AS label", "2 AS node", "3 AS v")
    assert rows(links.near_duplicates(frame)) == sorted(vector_links(given), key=repr)
    assert links.near_duplicates(frame.limit(0)).count() == 0


def test_tables_reach_the_wanted_recall():
    depth, tables = links.shape(10**6)
    near = links.agreement(np.sqrt(2 - 2 * 0.95))
    assert (1 - near**depth) ** tables <= links.MISS
    rng = np.random.default_rng(2)
    a = rng.standard_normal((4000, 64))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    side = rng.standard_normal((4000, 64))
    side -= (side * a).sum(1, keepdims=True) * a
    side /= np.linalg.norm(side, axis=1, keepdims=True)
    b = 0.95 * a + np.sqrt(1 - 0.95**2) * side
    depth, tables = links.shape(10**4)
    assert (links.keys(a, depth, tables) == links.keys(b, depth, tables)).any(1).all()

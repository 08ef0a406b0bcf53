"""The registered queries over whole tables."""

import pytest
from brute import captures, covered, simhash, token_file
from conftest import rows

import __spark_entry__ as entry

QUERIES = entry.queries()
SQL = entry.oracle_sql()


def read(spark, sf_dir, name, *columns):
    return [tuple(r) for r in spark.read.parquet(f"{sf_dir}/{name}.parquet").select(*columns).collect()]


def test_one_query_for_each_operator():
    named = {q.split("_")[0] for q in QUERIES if q.startswith("op") and q[2].isdigit()}
    assert named == {f"op{n}" for n in range(1, 14)}
    assert "pipeline" in QUERIES
    assert {f"op{n}" for n in (3, 10, 11, 12, 13)} <= {q.split("_")[0] for q in SQL}


@pytest.mark.parametrize(
    "query, table, columns, want",
    [
        ("op2_repeats", "documents", ("doc_id", "text"), covered),
        ("op5_warc", "pages", ("page_id", "url", "html"), captures),
        ("op8_token_files", "documents", ("doc_id", "text"), token_file),
        ("op9_simhash", "documents", ("doc_id", "text"), simhash),
    ],
)
def test_query_equals_brute_force(spark, sf_dir, query, table, columns, want):
    given = read(spark, sf_dir, table, *columns)
    assert rows(QUERIES[query](spark, sf_dir)) == sorted(want(given), key=repr)


@pytest.mark.parametrize("query", ["op1_packing", "op4_language_id", "op6_vector_links", "op7_token_counts"])
def test_query_has_every_row(spark, sf_dir, query):
    table, key = ("embeddings", "vec_id") if query.startswith("op6") else ("documents", "doc_id")
    found = {r[0] for r in QUERIES[query](spark, sf_dir).select(key).collect()}
    assert found == {r[0] for r in read(spark, sf_dir, table, key)}

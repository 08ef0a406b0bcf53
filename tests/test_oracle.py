"""Every registered query agrees with its SQL counterpart."""

import pytest

import __spark_entry__ as entry
from compare import connect, differences
from tillmart import oracle, registry

QUERIES = entry.queries()
SQL = entry.oracle_sql()


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


def test_same_keys():
    assert set(registry.queries()) == set(oracle.oracle_sql())
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query(spark, sf_dir, con, name):
    assert differences(QUERIES[name](spark, sf_dir), con, SQL[name]) is None


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_session_time_zone_does_not_matter(spark, sf_dir, con):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        for name in ("std_timestamps", "std_events", "std_orders_amazon", "funnel_daily"):
            assert differences(QUERIES[name](spark, sf_dir), con, SQL[name]) is None
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)

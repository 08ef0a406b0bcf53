"""Day tables, raw zone, staging loads, the stream and a whole run."""

import json
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from conftest import rows
from tillmart.operators import collection, funnel, keyed, standardize
from tillmart.plans import marts, staging
from tillmart.plans.warehouse import Warehouse
from tillmart.schemas import FUNNEL_MART, STAGED_LOGS, STAGED_ORDERS
from tillmart.sources import raw_zone, star_tables
from tillmart.sources.day_table import BrokenRules, DayTable
from tillmart.sources.shared import PARSED_GROUP, stored
from tillmart.streaming.behavior_ingest import ingest_stream

DAY = date(2026, 8, 10)


def day(n):
    return DAY + timedelta(days=n)


def small(spark, *pairs):
    return spark.createDataFrame(list(pairs), "v int, d date")


@pytest.fixture
def table(spark, tmp_path):
    return DayTable(spark, str(tmp_path / "t"), "v int, d date", "d")


def test_empty_table(table):
    assert table.days() == [] and table.read().count() == 0


def test_replace_add_drop(spark, table):
    table.replace_days(small(spark, (1, day(0)), (2, day(1))), [day(0), day(1)])
    table.add(small(spark, (3, day(1)), (4, day(2))))
    assert rows(table.read()) == [(1, day(0)), (2, day(1)), (3, day(1)), (4, day(2))]
    assert rows(table.read([day(1)])) == [(2, day(1)), (3, day(1))]
    assert table.drop_day(day(1)) == 2
    assert rows(table.read()) == [(1, day(0)), (4, day(2))]
    table.add(small(spark, (5, day(1))))
    assert table.drop_day(day(3)) == 0
    assert rows(table.read()) == [(1, day(0)), (4, day(2)), (5, day(1))]


def test_a_replaced_day_without_rows_is_emptied_and_others_stay(spark, table):
    table.replace_days(small(spark, (1, day(0)), (2, day(1)), (3, day(2))), [day(0), day(1), day(2)])
    table.replace_days(small(spark, (9, day(2))), [day(1), day(2)])
    assert rows(table.read()) == [(1, day(0)), (9, day(2))]
    assert table.days() == [day(0), day(2)]


def test_rows_outside_the_named_days_are_refused(spark, table):
    table.replace_days(small(spark, (1, day(0))), [day(0)])
    with pytest.raises(ValueError):
        table.replace_days(small(spark, (2, day(5))), [day(0)])
    assert rows(table.read()) == [(1, day(0))]


def test_a_reader_keeps_its_rows_while_the_table_changes(spark, table):
    table.replace_days(small(spark, (1, day(0))), [day(0)])
    before = table.read()
    table.replace_days(before.withColumn("v", F.col("v") + 1), [day(0)])
    assert rows(before) == [(1, day(0))] and rows(table.read()) == [(2, day(0))]


def test_replace_all(spark, table):
    table.replace_all(small(spark, (1, day(0)), (2, day(1))))
    table.replace_all(small(spark, (3, day(1))))
    assert rows(table.read()) == [(3, day(1))]


# -- raw zone ----------------------------------------------------------------------------


def fetched(feed, batch):
    return raw_zone.raw_rows(
        feed,
        F.lit("naver_commerce_api"),
        raw_zone.payload_text(feed),
        F.lit(batch),
        F.lit("2026-08-11 02:00:00"),
    )


def test_landing_appends_rows_and_files(spark, tmp_path):
    feed = spark.createDataFrame([("1", "가"), ("2", None)], "orderNo string, buyerId string")
    table, files = str(tmp_path / "raw"), str(tmp_path / "json")
    for _ in range(2):
        raw_zone.land(fetched(feed, DAY), table, files)
    back = raw_zone.scan(spark, table, [DAY])
    assert back.count() == 4 and back.select("raw_id").distinct().count() == 4
    texts = sorted(r[0] for r in back.select("payload_json").distinct().collect())
    assert texts == ['{"orderNo":"1","buyerId":"가"}', '{"orderNo":"2"}']
    assert spark.read.text(files).count() == 4
    assert raw_zone.scan(spark, table, [day(1)]).count() == 0


def test_batch_scan_reads_only_its_folders(spark, tmp_path):
    feed = spark.createDataFrame([("1",)], "orderNo string")
    for n in range(3):
        raw_zone.land(fetched(feed, day(n)), str(tmp_path / "raw"))
    plan = raw_zone.scan(spark, str(tmp_path / "raw"), [day(1)])._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(batch_date" in plan


# -- collection --------------------------------------------------------------------------


def test_collection_dates():
    dates = collection.order_dates(day(0))
    assert len(dates) == 15 and dates[0] == day(-14) and dates[-1] == day(0)
    assert collection.behavior_dates(day(0)) == [day(0)]
    assert collection.behavior_dates(day(0), 2) == [day(0), day(-1), day(-2)]
    assert collection.refresh_window([day(0)]) == (day(-14), day(0))
    assert collection.refresh_window([day(0), day(-20), day(-3)]) == (day(-20), day(0))


# -- staging -----------------------------------------------------------------------------


def order_raw(spark, *versions):
    """(batch offset, order, status, paid offset, seq) to raw rows."""
    data = []
    for batch, order, status, paid, seq in versions:
        body = {
            "orderNo": order, "buyerId": "U", "productNo": "P", "totalPayment": 10,
            "paidDatetime": f"{day(paid).isoformat()}T10:00:00",
        }
        if status:
            body["orderStatus"] = status
        fetched = datetime.combine(day(batch + 1), datetime.min.time())
        data.append((f"r{batch}-{order}-{seq}", "naver_commerce_api", day(batch), json.dumps(body), fetched, seq))
    return spark.createDataFrame(
        data,
        "raw_id string, source_api string, batch_date date, payload_json string, "
        "fetched_at timestamp_ntz, ingest_seq bigint",
    )


@pytest.fixture
def staged(spark, tmp_path):
    return DayTable(spark, str(tmp_path / "orders"), STAGED_ORDERS, "paid_date")


def state(table):
    return rows(table.read(), "order_id", "order_status", "paid_date")


def test_latest_version_wins_and_an_old_batch_cannot_undo_it(spark, staged):
    first = order_raw(spark, (0, "A", None, 0, 1), (0, "B", None, 0, 2))
    later = order_raw(spark, (3, "A", "CANCELLED", 0, 1))
    assert staging.load_orders(staged, first) == staging.LoadStats(2, 2, 0)
    assert staging.load_orders(staged, later) == staging.LoadStats(1, 1, 0)
    expected = [("A", "CANCELLED", DAY), ("B", "PAID", DAY)]
    assert state(staged) == expected
    assert staging.load_orders(staged, first) == staging.LoadStats(2, 0, 0)
    assert state(staged) == expected


def test_last_copy_in_a_batch_wins(spark, staged):
    staging.load_orders(staged, order_raw(spark, (0, "A", None, 0, 1), (0, "A", "SHIPPED", 0, 2)))
    assert state(staged) == [("A", "SHIPPED", DAY)]


def test_loading_twice_changes_nothing(spark, staged):
    batch = order_raw(spark, (0, "A", None, 0, 1), (1, "B", "REFUNDED", 1, 1))
    staging.load_orders(staged, batch)
    before = state(staged)
    staging.load_orders(staged, batch)
    assert state(staged) == before


def test_an_order_that_moves_day_leaves_the_old_one(spark, staged):
    staging.load_orders(staged, order_raw(spark, (0, "A", None, 0, 1)))
    staging.load_orders(staged, order_raw(spark, (1, "A", None, 5, 1)))
    assert state(staged) == [("A", "PAID", day(5))]
    assert staged.days() == [day(5)]


def test_one_pass_equals_batch_by_batch(spark, staged, tmp_path):
    versions = [(0, "A", None, 0, 1), (0, "B", None, 0, 2), (2, "A", "SHIPPED", 0, 1), (5, "A", "REFUNDED", 0, 1)]
    for batch in (0, 2, 5):
        staging.load_orders(staged, order_raw(spark, *[v for v in versions if v[0] == batch]))
    other = DayTable(spark, str(tmp_path / "other"), STAGED_ORDERS, "paid_date")
    staging.load_orders(other, order_raw(spark, *versions))
    assert state(staged) == state(other)


def test_bad_rows_go_to_quarantine_or_stop_the_load(spark, staged, tmp_path):
    batch = order_raw(spark, (0, "A", "LOST", 0, 1), (0, "B", None, 0, 2))
    with pytest.raises(staging.RejectedRows):
        staging.load_orders(staged, batch, on_reject="fail")
    assert state(staged) == []
    bin_ = str(tmp_path / "bin")
    assert staging.load_orders(staged, batch, quarantine=bin_) == staging.LoadStats(1, 1, 1)
    assert rows(spark.read.parquet(bin_), "order_id", "violations") == [("A", ["order_status unknown"])]


def log_raw(spark, *fetches):
    """(batch offset, seq, [(log, event name)]) to raw rows."""
    data = []
    for batch, seq, events in fetches:
        body = {
            "session_id": "S",
            "events": [
                {"event_id": e, "session_id": "S", "event_name": name, "event_timestamp": f"{DAY.isoformat()}T10:00:00"}
                for e, name in events
            ],
        }
        fetched = datetime.combine(day(batch + 1), datetime.min.time())
        data.append((f"r{batch}-{seq}", "ga4_export", day(batch), json.dumps(body), fetched, seq))
    return spark.createDataFrame(
        data,
        "raw_id string, source_api string, batch_date date, payload_json string, "
        "fetched_at timestamp_ntz, ingest_seq bigint",
    )


@pytest.fixture
def staged_logs(spark, tmp_path):
    return DayTable(spark, str(tmp_path / "logs"), STAGED_LOGS, "event_date")


def test_logs_are_never_changed_once_in(spark, staged_logs):
    first = log_raw(spark, (0, 1, [("1", "view_item"), ("1", "purchase"), ("2", "view_item")]))
    again = log_raw(spark, (1, 1, [("1", "add_to_cart"), ("3", "view_item")]))
    assert staging.load_logs(staged_logs, first) == staging.LoadStats(2, 2, 0)
    assert staging.load_logs(staged_logs, again) == staging.LoadStats(2, 1, 0)
    assert staging.load_logs(staged_logs, again) == staging.LoadStats(2, 0, 0)
    expected = [("1", "purchase"), ("2", "view_item"), ("3", "view_item")]
    assert rows(staged_logs.read(), "log_id", "event_name") == expected


def test_logs_in_one_pass(spark, staged_logs):
    both = log_raw(
        spark,
        (1, 1, [("1", "add_to_cart"), ("3", "view_item")]),
        (0, 1, [("1", "view_item"), ("1", "purchase"), ("2", "view_item")]),
    )
    staging.load_logs(staged_logs, both)
    expected = [("1", "purchase"), ("2", "view_item"), ("3", "view_item")]
    assert rows(staged_logs.read(), "log_id", "event_name") == expected


def test_unknown_event_names_are_rejected(spark, staged_logs, tmp_path):
    batch = log_raw(spark, (0, 1, [("1", "error"), ("2", "purchase")]))
    with pytest.raises(staging.RejectedRows):
        staging.load_logs(staged_logs, batch)
    stats = staging.load_logs(staged_logs, batch, quarantine=str(tmp_path / "bin"))
    assert stats == staging.LoadStats(1, 1, 1)


def test_every_rejected_order_is_put_aside_once(spark, staged, tmp_path):
    good = order_raw(spark, (0, "A", None, 0, 1))
    bad = good.select(
        F.explode(F.sequence(F.lit(1), F.lit(3))).alias("n"), *good.columns
    ).select(
        F.concat(F.lit("bad"), F.col("n").cast("string")).alias("raw_id"), "source_api", "batch_date",
        F.lit("no json").alias("payload_json"), "fetched_at", "ingest_seq",
    )
    bin_ = str(tmp_path / "bin")
    for _ in range(2):
        stats = staging.load_orders(staged, good.unionByName(bad), quarantine=bin_)
        assert stats.rejected == 3
        assert rows(spark.read.parquet(bin_), "raw_id") == [("bad1",), ("bad2",), ("bad3",)]
    assert state(staged) == [("A", "PAID", DAY)]


def test_a_bad_newest_version_does_not_hide_a_good_one(spark, staged, tmp_path):
    both = order_raw(spark, (0, "A", None, 0, 1), (1, "A", "LOST", 0, 1))
    assert staging.load_orders(staged, both, quarantine=str(tmp_path / "b")).rejected == 1
    other = DayTable(spark, str(tmp_path / "other"), STAGED_ORDERS, "paid_date")
    for n in (0, 1):
        part = both.where(F.col("batch_date") == F.lit(day(n)))
        staging.load_orders(other, part, quarantine=str(tmp_path / "c"))
    assert state(staged) == state(other) == [("A", "PAID", DAY)]


def test_a_load_with_nothing_newer_publishes_nothing(spark, staged):
    batch = order_raw(spark, (0, "A", None, 0, 1), (0, "B", None, 1, 2))
    staging.load_orders(staged, batch)
    published = staged._log().count()
    assert staging.load_orders(staged, batch).changed == 0
    assert staged._log().count() == published
    staging.load_orders(staged, order_raw(spark, (1, "A", "SHIPPED", 0, 1)))
    assert staged._log().count() == published + 1


def test_unreadable_sessions_and_events_without_id_are_put_aside(spark, staged_logs, tmp_path):
    raw = log_raw(spark, (0, 1, [("1", "view_item"), (None, "view_item"), (None, "purchase")]))
    odd = ["no json", "[1]", '{"events": "none"}', '{"events": null}', '{"session_id": "S"}', '{"events": []}', None]
    more = spark.createDataFrame(
        [(f"odd{n}", text, n) for n, text in enumerate(odd)], "raw_id string, payload_json string, n int"
    )
    first = raw.first()
    more = more.select(
        "raw_id", F.lit(first.source_api).alias("source_api"), F.lit(first.batch_date).alias("batch_date"),
        "payload_json", F.lit(first.fetched_at).cast("timestamp_ntz").alias("fetched_at"),
        F.col("n").cast("bigint").alias("ingest_seq"),
    )
    bin_ = str(tmp_path / "bin")
    stats = staging.load_logs(staged_logs, raw.unionByName(more), quarantine=bin_)
    assert stats == staging.LoadStats(1, 1, 7)
    unreadable = spark.read.parquet(bin_).where(F.array_contains("violations", "payload unreadable"))
    assert rows(unreadable, "raw_id") == [("odd0",), ("odd1",), ("odd2",), ("odd3",), ("odd6",)]


def test_stream_equals_batch(spark, staged_logs, tmp_path, sf_dir):
    raw_path = str(tmp_path / "raw")
    raw_zone.land(star_tables.raw_sessions(spark, sf_dir), raw_path)
    streamed = DayTable(spark, str(tmp_path / "streamed"), STAGED_LOGS, "event_date")
    for _ in range(2):
        q = ingest_stream(
            spark, raw_path, streamed, str(tmp_path / "cp"), str(tmp_path / "bad"), files_per_batch=40
        )
        q.awaitTermination()
        assert q.exception() is None
    # A fetch that repeats old logs and brings a very late one.
    late = log_raw(spark, (0, 1, [("late", "view_item"), ("1", "view_item")]))
    raw_zone.land(late, raw_path)
    ingest_stream(
        spark, raw_path, streamed, str(tmp_path / "cp"), str(tmp_path / "bad")
    ).awaitTermination()
    staging.load_logs(staged_logs, raw_zone.scan(spark, raw_path), quarantine=str(tmp_path / "bad2"))
    keys = ("log_id", "event_name", "event_at", "session_id")
    assert rows(streamed.read(), *keys) == rows(staged_logs.read(), *keys)
    assert streamed.read().where("log_id = 'late'").count() == 1


# -- marts -------------------------------------------------------------------------------


def test_window_refresh_equals_full_rebuild_inside_and_keeps_the_rest(spark, tmp_path, sf_dir):
    orders, logs = star_tables.orders(spark, sf_dir), star_tables.logs(spark, sf_dir)
    mart = DayTable(spark, str(tmp_path / "funnel"), FUNNEL_MART, "base_date")
    stale = funnel.funnel_daily(orders, logs, status=None).withColumn("refreshed_at", F.current_timestamp())
    mart.replace_all(stale)
    window = (date(2024, 1, 16), date(2024, 1, 30))
    # One day of the window loses all its events.
    logs = logs.where(F.col("event_date") != F.lit(date(2024, 1, 20)))
    marts.refresh_funnel(mart, orders, logs, window)
    inside = F.col("base_date").between(*[F.lit(d) for d in window])
    columns = [c for c in stale.columns if c != "refreshed_at"]
    full = funnel.funnel_daily(orders, logs)
    assert rows(mart.read().where(inside), *columns) == rows(full.where(inside), *columns)
    assert rows(mart.read().where(~inside), *columns) == rows(stale.where(~inside), *columns)
    assert date(2024, 1, 20) not in mart.days()


def test_a_payment_after_the_analysis_date_stops_the_rfm_mart(spark, tmp_path, sf_dir):
    house = Warehouse(spark, str(tmp_path))
    orders = star_tables.orders(spark, sf_dir)
    marts.rebuild_rfm(house.rfm, orders, date(2024, 1, 31))
    before = rows(house.rfm.read(), "user_id", "recency_days", "segment_name")
    with pytest.raises(BrokenRules):
        marts.rebuild_rfm(house.rfm, orders, date(2024, 1, 20))
    assert rows(house.rfm.read(), "user_id", "recency_days", "segment_name") == before


def test_whole_run(spark, tmp_path, sf_dir):
    """Landing to marts in one pass equals the marts of the standardised frames."""
    house = Warehouse(spark, str(tmp_path))
    assert house.row_counts().where("row_count IS NULL").count() == 2
    raw_orders = star_tables.raw_orders(spark, sf_dir)
    raw_logs = star_tables.raw_sessions(spark, sf_dir)
    dates = [date(2024, 1, 1) + timedelta(days=n) for n in range(33)]
    stats = house.run(dates, date(2024, 2, 3), raw_orders, raw_logs)
    assert stats.raw_orders == raw_orders.count() and stats.raw_logs == raw_logs.count()
    assert stats.orders.rejected > 0 and stats.logs.rejected > 0
    assert stats.cancelled == raw_orders.where("payload_json LIKE '%CANCELLED%'").count()
    assert stats.refunded == 0
    unknown = raw_orders.limit(3).withColumn("source_api", F.lit("fax"))
    with pytest.raises(staging.RejectedRows):
        house.land(unknown, None)
    candidates = house.recheck(date(2024, 1, 30))
    assert candidates.count() == house.orders.read().where(
        "order_status = 'PAID' AND paid_date >= '2024-01-16' AND paid_date < '2024-01-30'"
    ).count()
    assert stats.orders.submitted == stats.orders.changed == house.orders.read().count()

    latest = keyed.latest_orders(standardize.orders(raw_orders)).where("product_id IS NOT NULL")
    logs = standardize.behavior_logs(raw_logs).where("event_name <> 'error'")
    expected = funnel.funnel_daily(latest, logs)
    assert rows(house.funnel.read(), *expected.columns) == rows(expected)
    assert house.rfm.read().count() == latest.where("order_status = 'PAID'").select("user_id").distinct().count()
    assert house.healthy() is True
    assert house.last_updated().first()[0] is not None
    assert house.status_counts().count() == 3

    # The same run again lands raw rows twice and changes nothing else.
    before = rows(house.funnel.read(), *expected.columns)
    again = house.run(dates, date(2024, 2, 3), raw_orders, raw_logs)
    assert again.logs.changed == 0 and again.funnel_rows == stats.funnel_rows
    assert rows(house.funnel.read(), *expected.columns) == before
    assert house.row_counts().where("table_name = 'raw_ecommerce_orders'").first()[1] == 2 * stats.raw_orders


def test_payloads_of_one_file_are_divided_among_tasks(spark):
    """Rows written by one task are parsed by several: the file has row groups of its own size."""
    text = F.concat(*[F.sha2(F.concat("id", F.lit(f"-{n}")), 256) for n in range(4)])
    raw = spark.range(0, 60_000, 1, 1).select(F.col("id").cast("string").alias("id")).withColumn("text", text)
    back = stored(raw, "payloads", PARSED_GROUP)
    held = back.repartition(1).select(F.sum(F.hash("id", "text").cast("long"))).first()
    assert held == raw.select(F.sum(F.hash("id", "text").cast("long"))).first()
    sizes = back.groupBy(F.spark_partition_id()).count().collect()
    assert len(sizes) > 1 and max(r["count"] for r in sizes) < 60_000

"""What a load reads and moves of a long history: key log, snapshots, rollups, changed days."""

from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from conftest import rows
from test_tables import day, log_raw, order_raw, small
from tillmart.operators import attribution, funnel, keyed, standardize
from tillmart.plans import marts, staging
from tillmart.plans.warehouse import Warehouse
from tillmart.schemas import STAGED_LOGS, STAGED_ORDERS
from tillmart.sources import day_table, key_log, raw_zone, star_tables
from tillmart.sources.day_table import DayTable, DuplicateKeys


@pytest.fixture
def staged(spark, tmp_path):
    return DayTable(spark, str(tmp_path / "orders"), STAGED_ORDERS, "paid_date")


@pytest.fixture
def staged_logs(spark, tmp_path):
    return DayTable(spark, str(tmp_path / "logs"), STAGED_LOGS, "event_date")


@pytest.fixture
def no_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def exchanges_above_keys(frame):
    """Exchanges between the root of the physical plan and the scan of the key log."""
    lines = frame._jdf.queryExecution().executedPlan().toString().splitlines()
    at = next(n for n, line in enumerate(lines) if "FileScan parquet" in line and "day_keys_" in line)
    depth = [len(line) - len(line.lstrip(" :+-*")) for line in lines]
    found, level = [], depth[at]
    for n in range(at - 1, -1, -1):
        if depth[n] < level:
            level = depth[n]
            if "Exchange" in lines[n]:
                found.append(lines[n])
    return found


def test_loads_do_not_move_the_keys_of_history(spark, staged, staged_logs, no_broadcast):
    first = order_raw(spark, (0, "A", None, 0, 1), (0, "B", None, 1, 2))
    staging.load_orders(staged, first)
    table = staged.with_key("order_id", keyed.ORDER_VERSION)
    batch = keyed.latest_orders(standardize.orders(first))
    pairs = staging.with_known(batch, table)
    assert exchanges_above_keys(pairs) == []
    assert [r.newer for r in pairs.collect()] == [False, False]

    logs = log_raw(spark, (0, 1, [("1", "view_item"), ("2", "view_item")]))
    staging.load_logs(staged_logs, logs)
    table = staged_logs.with_key("log_id")
    again = standardize.behavior_logs(log_raw(spark, (0, 1, [("2", "purchase"), ("3", "view_item")])))
    fresh = staging.unknown(again, table)
    assert exchanges_above_keys(fresh) == []
    assert rows(fresh, "log_id") == [("3",)]


def moved_day(raw, by):
    """The same payloads with their events on another day."""
    return raw.withColumn(
        "payload_json", F.replace("payload_json", F.lit(day(0).isoformat()), F.lit(day(by).isoformat()))
    )


def test_a_log_id_under_another_date_is_ignored_until_its_day_is_dropped(spark, staged_logs):
    first = log_raw(spark, (0, 1, [("1", "view_item"), ("2", "view_item")]))
    staging.load_logs(staged_logs, first)
    assert staging.load_logs(staged_logs, moved_day(first, 3)) == staging.LoadStats(2, 0, 0)
    assert staged_logs.days() == [day(0)]
    staged_logs.with_key("log_id").drop_day(day(0))
    assert staging.load_logs(staged_logs, moved_day(first, 3)) == staging.LoadStats(2, 2, 0)
    assert staging.load_logs(staged_logs, first) == staging.LoadStats(2, 0, 0)
    assert rows(staged_logs.read(), "log_id", "event_date") == [("1", day(3)), ("2", day(3))]


def test_keys_of_a_load_that_was_not_published_do_not_count(spark, staged_logs):
    staging.load_logs(staged_logs, log_raw(spark, (0, 1, [("1", "view_item")])))
    table = staged_logs.with_key("log_id")
    now = table._snapshot()
    lost = table.read().withColumn("log_id", F.lit("2"))
    table._logged(lost, now)  # and then the job dies
    assert staging.load_logs(staged_logs, log_raw(spark, (0, 2, [("2", "view_item")]))).changed == 1
    assert rows(staged_logs.read(), "log_id") == [("1",), ("2",)]


def test_rows_published_without_keys_are_logged_later(spark, staged_logs):
    logs = standardize.behavior_logs(log_raw(spark, (0, 1, [("1", "view_item")])))
    staged_logs.add(logs.withColumn("loaded_at", F.current_timestamp()))
    more = log_raw(spark, (1, 1, [("1", "purchase"), ("2", "purchase")]))
    assert staging.load_logs(staged_logs, more) == staging.LoadStats(2, 1, 0)


def test_many_parts_of_the_key_log_become_one(spark, staged_logs, monkeypatch):
    monkeypatch.setattr(key_log, "MOST_PARTS", 2)
    for n in range(4):
        staging.load_logs(staged_logs, log_raw(spark, (n, 1, [(str(n), "view_item"), ("x", "view_item")])))
    table = staged_logs.with_key("log_id")
    assert len(table._snapshot().keys) <= 2
    assert rows(table.known_keys(), "key") == [("0",), ("1",), ("2",), ("3",), ("x",)]


def test_duplicate_keys_are_not_published(spark, staged_logs):
    staging.load_logs(staged_logs, log_raw(spark, (0, 1, [("1", "view_item")])))
    table = staged_logs.with_key("log_id")
    before = rows(table.read(), "log_id", "event_date")
    row = table.read().withColumn("loaded_at", F.current_timestamp())
    twice = row.withColumn("log_id", F.lit("9"))
    for bad in (row.withColumn("event_date", F.lit(day(5))), twice.unionByName(twice)):
        with pytest.raises(DuplicateKeys):
            table.add(bad)
        assert rows(table.read(), "log_id", "event_date") == before


def test_keys_of_the_marts_are_checked(spark, tmp_path):
    table = DayTable(spark, str(tmp_path / "t"), "v int, d date", "d", unique=["d", "v"])
    table.replace_all(small(spark, (1, day(0)), (1, day(1))))
    with pytest.raises(DuplicateKeys):
        table.replace_days(small(spark, (2, day(0)), (2, day(0))), [day(0)])
    assert rows(table.read()) == [(1, day(0)), (1, day(1))]


def test_a_reader_opens_one_list_and_full_days_are_folded(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(day_table, "FOLD", 3)
    table = DayTable(spark, str(tmp_path / "t"), "v int, d date", "d", newest="d")
    for n in range(8):
        table.add(small(spark, (n, day(0)), (n, day(n))))
    lists = table._lists()
    assert len(lists) == 8
    opened = spark.read.text(lists[max(lists)])
    assert len(opened.inputFiles()) == 1
    assert sum(f.day == day(0) for f in table._snapshot().folders) <= 3
    assert sorted(rows(table.read())) == sorted([(n, day(0)) for n in range(8)] + [(n, day(n)) for n in range(8)])
    assert table.size()[0] == 16 and table.size()[1].date() == day(7)
    for n in lists:
        if n != max(lists):  # older lists are not needed
            spark.createDataFrame([], "x int").write.mode("overwrite").json(f"{table.root}/published/publish={n}")
    assert table.read().count() == 16


def test_references_to_missing_raw_rows_stop_the_load(spark, staged):
    raw = order_raw(spark, (0, "A", None, 0, 1), (1, "B", None, 0, 1))
    asked = []

    def kept(dates, gone=0):
        asked.append(list(dates))
        return raw.where(F.col("batch_date").isin(*map(F.lit, dates)) & (F.col("batch_date") >= F.lit(day(gone))))

    with pytest.raises(staging.MissingReferences):
        staging.load_orders(staged, raw, references=lambda d: kept(d, 1))
    assert staged.read().count() == 0
    assert staging.load_orders(staged, raw, references=kept).changed == 2
    assert asked[-1] == [day(0), day(1)]


def test_a_day_that_only_gains_orders_is_added_to(spark, staged, monkeypatch):
    monkeypatch.setattr(day_table, "FOLD", 3)
    folders = lambda d: [f.name for f in staged._snapshot().folders if f.day == d]
    staging.load_orders(staged, order_raw(spark, (0, "A", None, 0, 1), (0, "B", None, 1, 2)))
    first, other = folders(day(0)), folders(day(1))
    # C is new on the first day; B moves from the second day to the third.
    later = order_raw(spark, (1, "C", None, 0, 3), (1, "B", "SHIPPED", 2, 4))
    assert staging.load_orders(staged, later) == staging.LoadStats(2, 2, 0)
    assert first[0] in folders(day(0)) and len(folders(day(0))) == 2
    assert not set(other) & set(folders(day(1)))
    found = rows(staged.read(), "order_id", "order_status", "paid_date")
    assert found == [("A", "PAID", day(0)), ("B", "SHIPPED", day(2)), ("C", "PAID", day(0))]
    for n in range(3):
        staging.load_orders(staged, order_raw(spark, (2 + n, f"D{n}", None, 0, n)))
    assert len(folders(day(0))) <= 3  # a day of many folders is written anew
    assert staged.read().count() == 6


def test_payloads_move_once_when_they_land(spark, tmp_path, monkeypatch):
    plans = []
    land = raw_zone.land

    def seen(rows, *args, **kwargs):
        plans.append(kwargs.get("together", False))
        land(rows, *args, **kwargs)

    monkeypatch.setattr(raw_zone, "land", seen)
    house = Warehouse(spark, str(tmp_path))
    raw = order_raw(spark, (0, "A", None, 0, 1), (1, "B", None, 0, 1))
    assert house.land(raw, None)[0].rows == 2
    assert plans == [True]
    assert raw_zone.scan(spark, house.raw_orders_path).count() == 2
    texts = spark.read.text(f"{tmp_path}/json/ecommerce_orders")
    assert rows(texts, "value") == rows(raw, "payload_json")
    assert all(f.endswith(".gz") for f in texts.inputFiles())


# -- touches and changed days ------------------------------------------------------------


def expected(house):
    return funnel.funnel_daily(house.orders.read(), house.logs.read())


def sessions_raw(spark, *events):
    """(batch, seq, log, session, user, event, day, hour, source) to raw rows of one event each."""
    raw = log_raw(spark, *[(b, s, [(log, name)]) for b, s, log, _, _, name, *_ in events])
    changes = {
        f"r{b}-{s}": (session, user, f"{day(d).isoformat()}T{hour:02d}:00:00", source)
        for b, s, _, session, user, _, d, hour, source in events
    }
    table = spark.createDataFrame(
        [(k, *v) for k, v in changes.items()], "raw_id string, session string, user string, at string, source string"
    )
    body = F.from_json(
        "payload_json", "events array<struct<event_id: string, event_name: string>>"
    )
    event = F.struct(
        body["events"][0]["event_id"].alias("event_id"), F.col("session").alias("session_id"),
        F.col("user").alias("user_pseudo_id"), body["events"][0]["event_name"].alias("event_name"),
        F.struct(F.col("source")).alias("traffic_source"), F.col("at").alias("event_timestamp"),
    )
    return raw.join(table, "raw_id").withColumn(
        "payload_json", F.to_json(F.struct(F.array(event).alias("events")))
    ).select(*raw.columns)


def test_late_events_move_their_session_and_nothing_new_writes_nothing(spark, tmp_path):
    house = Warehouse(spark, str(tmp_path))
    dates = [day(n) for n in range(6)]
    orders = order_raw(spark, (1, "A", None, 1, 1), (2, "B", None, 2, 1))
    orders = orders.withColumn("payload_json", F.replace("payload_json", F.lit('"U"'), F.lit('"u1"')))
    logs = sessions_raw(
        spark,
        (1, 1, "1", "s1", "u1", "view_item", 1, 10, "google"), (2, 1, "2", "s1", "u1", "purchase", 2, 10, "google"),
        (3, 1, "3", "s2", None, "view_item", 3, 10, "naver"), (4, 1, "4", "s3", "u2", "view_item", 4, 10, None),
    )
    house.run(dates, day(6), orders, logs)
    assert rows(house.funnel.read(), *expected(house).columns) == rows(expected(house))

    published = len(house.funnel._lists())
    stats = house.run(dates, day(6))
    assert (stats.orders.changed, stats.logs.changed) == (0, 0)
    assert len(house.funnel._lists()) == published

    # An earlier event of s1 comes late, and a later one of u1: days 1, 2 and the orders of u1 move.
    before = {f.day: f.name for f in house.funnel._snapshot().folders}
    late = sessions_raw(
        spark, (5, 1, "5", "s1", "u1", "view_item", 0, 9, "kakao"), (5, 2, "6", "s9", "u1", "view_item", 5, 9, "meta")
    )
    house.run(dates, day(6), None, late)
    after = {f.day: f.name for f in house.funnel._snapshot().folders}
    assert rows(house.funnel.read(), *expected(house).columns) == rows(expected(house))
    assert {d for d in before if before[d] != after[d]} == {day(1), day(2)}

    # An order that is cancelled takes its user's platform along.
    house.run(dates, day(6), order_raw(spark, (5, "A", "CANCELLED", 1, 1), (5, "B", "CANCELLED", 2, 1)), None)
    assert rows(house.funnel.read(), *expected(house).columns) == rows(expected(house))


def test_rollups_equal_the_direct_form(spark, tmp_path, sf_dir):
    house = Warehouse(spark, str(tmp_path))
    logs = star_tables.logs(spark, sf_dir).where("event_name <> 'error'")
    parts = [F.col("ingest_seq") % 3 == n for n in range(3)]
    for part in parts:  # every load brings late events of every day
        days = house.logs.added(logs.where(part))
        marts.update_touches(house.sessions, house.users, house.logs, days)
    gone = date(2024, 1, 20)
    house.logs.drop_day(gone)
    marts.update_touches(house.sessions, house.users, house.logs, [gone])
    left = house.logs.read()
    touches = marts.touches(house.sessions, house.users)
    assert rows(touches.first) == rows(attribution.first_touch(left))
    assert rows(touches.last) == rows(attribution.last_touch(left))
    window = (gone - timedelta(days=4), gone + timedelta(days=2))
    orders = star_tables.orders(spark, sf_dir)
    assert rows(funnel.funnel_daily(orders, left, window, touches=touches)) == rows(
        funnel.funnel_daily(orders, left, window)
    )


def test_bad_raw_rows_go_to_quarantine_once_and_counts_need_no_data(spark, tmp_path):
    house = Warehouse(spark, str(tmp_path))
    raw = order_raw(spark, (0, "A", None, 0, 1), (0, "B", "REFUNDED", 0, 2), (1, "C", "CANCELLED", 0, 1))
    raw = raw.withColumn("source_api", F.when(F.col("ingest_seq") == 2, "fax").otherwise(F.col("source_api")))
    for _ in range(2):
        landed, _ = house.land(raw, None, on_reject="quarantine")
        assert (landed.rows, landed.rejected, landed.cancelled, landed.refunded) == (2, 1, 1, 1)
    bad = spark.read.parquet(f"{house.root}/quarantine/raw_ecommerce_orders")
    assert rows(bad, "raw_id", "violations") == [("r0-B-2", ["source_api unknown"])]
    counts = house.row_counts()
    assert counts.where("table_name = 'raw_ecommerce_orders'").first().row_count == 4
    for frame in (counts, house.last_updated()):
        assert "FileScan" not in frame._jdf.queryExecution().executedPlan().toString()

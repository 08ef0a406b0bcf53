"""Named queries over the test tables, one per operator."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillmart.functions import clock, money
from tillmart.operators import attribution, collection, funnel, keyed, quality, rfm, standardize
from tillmart.plans import marts, reports, staging
from tillmart.plans.warehouse import Warehouse
from tillmart.schemas import FUNNEL_MART, ORDER_LOOKBACK_DAYS, STAGED_LOGS, STAGED_ORDERS
from tillmart.sources import raw_zone, star_tables
from tillmart.sources.day_table import DayTable
from tillmart.sources.shared import PARSED_GROUP, new_folder, stored
from tillmart.streaming.behavior_ingest import ingest_stream

Query = Callable[[SparkSession, str], DataFrame]

# Dates of the test tables: events cover 2024-01-01 to 2024-01-30.
RUN_DATE = date(2024, 1, 30)
AS_OF = date(2024, 1, 31)
WINDOW = collection.refresh_window([RUN_DATE])
RAW_KEPT_FROM = date(2024, 1, 5)
SECOND_LOAD_FROM = date(2024, 1, 16)
#: One raw row in so many is made unreadable where rejects are looked at.
SPOILT_EVERY = 97

ORDER_COLUMNS = (
    "order_id",
    "user_id",
    "product_id",
    "payment_amount",
    "discount_amount",
    "amount_before_fx",
    "currency_code",
    "platform",
    "paid_at",
    "order_status",
    "fx_rate",
    "raw_id",
)
LOG_COLUMNS = (
    "log_id",
    "session_id",
    "user_id",
    "event_name",
    "utm_source",
    "utm_medium",
    "device_type",
    "event_at",
    "event_date",
    "raw_id",
)

_QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    _QUERIES[fn.__name__] = fn
    return fn


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


# -- raw zone ----------------------------------------------------------------------------


@query
def raw_landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star_tables.raw_orders(spark, sf_dir).select(
        "raw_id", "source_api", "batch_date", "payload_json", "ingest_seq"
    )


@query
def raw_batch_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = new_folder(spark, "raw-orders")
    raw_zone.land(star_tables.raw_orders(spark, sf_dir), table)
    batches = raw_zone.scan(spark, table, collection.order_dates(RUN_DATE))
    return batches.select("raw_id", "source_api", "batch_date", "payload_json")


@query
def raw_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payloads as they lie in the landed JSON files."""
    root = new_folder(spark, "raw-files")
    raw_zone.land(star_tables.raw_orders(spark, sf_dir), f"{root}/table", f"{root}/json")
    return spark.read.text(f"{root}/json").select(
        F.col("batch_date").cast("date").alias("batch_date"), "source_api", F.col("value").alias("payload_json")
    )


@query
def landing_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two fetches: rows landed and rejected, orders cancelled and refunded (some made so first)."""
    house = Warehouse(spark, new_folder(spark, "landing"))
    refunded = F.replace("payload_json", F.lit('"CANCELLED"'), F.lit('"REFUNDED"'))
    raw = star_tables.raw_orders(spark, sf_dir).withColumns(
        {
            "payload_json": F.when(F.col("ingest_seq") % 5 == 0, refunded).otherwise(F.col("payload_json")),
            "source_api": F.when(F.col("ingest_seq") % 97 != 0, F.col("source_api")),
        }
    )
    early = F.col("batch_date") < F.lit(SECOND_LOAD_FROM)
    fetches = [("early", raw.where(early)), ("late", raw.where(~early))]
    landed = [(name, house.land(rows, None, on_reject="quarantine")[0]) for name, rows in fetches]
    return spark.createDataFrame(
        [(name, x.rows, x.rejected, x.cancelled, x.refunded) for name, x in landed],
        "fetch string, n_rows bigint, rejected bigint, cancelled bigint, refunded bigint",
    )


#: Run dates that collect every raw row of the test tables.
ALL_RUNS = [date.fromordinal(date(2024, 1, 1).toordinal() + n) for n in range(33)]
HOUSE_AS_OF = date(2024, 2, 3)


@query
def warehouse_funnel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The funnel mart as two whole runs leave it; the second refreshes only what it changed."""
    house = Warehouse(spark, new_folder(spark, "house"))
    early = F.col("batch_date") < F.lit(SECOND_LOAD_FROM)
    orders = stored(star_tables.raw_orders(spark, sf_dir), "raw-orders", PARSED_GROUP)
    logs = stored(star_tables.raw_sessions(spark, sf_dir), "raw-sessions", PARSED_GROUP)
    for part, run_dates in ((early, ALL_RUNS[:15]), (~early, ALL_RUNS)):
        house.run(run_dates, HOUSE_AS_OF, orders.where(part), logs.where(part))
    return _shown(house.funnel.read().drop("refreshed_at"))


def _house(spark: SparkSession, sf_dir: str) -> Warehouse:
    """A warehouse after one run over all raw rows."""
    house = Warehouse(spark, new_folder(spark, "house"))
    orders, logs = star_tables.raw_orders(spark, sf_dir), star_tables.raw_sessions(spark, sf_dir)
    house.run(ALL_RUNS, HOUSE_AS_OF, orders, logs)
    return house


@query
def warehouse_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows, health and newest time of a loaded warehouse, from the lists of its tables."""
    house = _house(spark, sf_dir)
    rows = house.row_counts().select(F.col("table_name").alias("name"), F.col("row_count").cast("string").alias("value"))
    newest = house.last_updated().select(F.lit("last_updated").alias("name"), clock.kst_text(F.col("last_updated")).alias("value"))
    healthy = reports.zone_health(house.row_counts()).select(
        F.lit("healthy").alias("name"), F.col("healthy").cast("string").alias("value")
    )
    return rows.unionByName(newest).unionByName(healthy)


@query
def warehouse_dashboard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Breakdowns of the written funnel mart and segments of the written RFM mart, as (part, value)."""
    house = _house(spark, sf_dir)
    mart = house.funnel.read()
    parts = [
        reports.breakdown(mart, by).select(
            F.lit(by).alias("part"),
            F.col(by).alias("value"),
            F.col("total_visitors").alias("people"),
            F.col("cvr").alias("share"),
        )
        for by in ("platform", "utm_source")
    ]
    segments = reports.segment_counts(house.rfm.read()).select(
        F.lit("segment").alias("part"),
        F.col("segment_name").alias("value"),
        F.col("customer_count").alias("people"),
        F.col("pct").alias("share"),
    )
    return reduce(DataFrame.unionByName, [*parts, segments])


@query
def collection_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Plan of every batch date as run date, with the number of raw orders and payloads to read."""
    orders = star_tables.raw_orders(spark, sf_dir).select(F.lit("orders").alias("feed"), "batch_date")
    logs = star_tables.raw_sessions(spark, sf_dir).select(F.lit("logs").alias("feed"), "batch_date")
    sizes = orders.unionByName(logs).groupBy("feed", "batch_date").agg(F.count("*").alias("n"))
    runs = sizes.where(F.col("feed") == "orders").select(F.col("batch_date").alias("run_date"))
    plan = collection.collection_plan(runs)
    return plan.join(sizes, ["feed", "batch_date"], "left").select(
        "run_date", "feed", "batch_date", F.coalesce("n", F.lit(0)).alias("raw_rows")
    )


# -- standardisation ---------------------------------------------------------------------


@query
def fx_rate_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rate of each currency on each payment day, and the orders it applies to."""
    used = star_tables.orders(spark, sf_dir).groupBy("currency_code", "paid_date").agg(
        F.count("*").alias("n_orders")
    )
    return used.withColumn("fx_rate", money.fx_rate(F.lower("currency_code"), F.col("paid_date")))


@query
def std_currency(spark: SparkSession, sf_dir: str) -> DataFrame:
    amount = F.col("payment_amount")
    rated = star_tables.orders(spark, sf_dir).withColumn(
        "fx_rate", money.fx_rate(F.col("currency_code"), F.col("paid_date"))
    )
    return rated.select(
        "order_id",
        "currency_code",
        "fx_rate",
        amount.alias("amount_before_fx"),
        money.in_won(amount, F.col("currency_code"), F.col("fx_rate")).alias("payment_won"),
    )


@query
def std_timestamps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event time written in six ways and read back."""
    logs = star_tables.logs(spark, sf_dir, as_sent=True)
    wall = F.replace(F.col("event_at").cast("string"), F.lit(" "), F.lit("T"))
    forms = {
        "naive": wall,
        "spaced": F.col("event_at").cast("string"),
        "zulu": F.concat(wall, F.lit("Z")),
        "offset": F.concat(wall, F.lit("-05:30")),
        "fraction": F.concat(wall, F.lit(".987654+09:00")),
        "junk": F.concat(wall, F.lit(" (local)")),
    }
    written = logs.select("log_id", *[text.alias(name) for name, text in forms.items()])
    read = {name: clock.kst_timestamp(F.col(name)) for name in forms}
    return written.select(
        "log_id",
        *[at.alias(name) for name, at in read.items()],
        clock.kst_text(read["zulu"]).alias("zulu_text"),
        F.to_date(read["zulu"]).alias("zulu_date"),
    )


@query
def std_timestamps_odd(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event time in rarer forms; those without a reading give null."""
    logs = star_tables.logs(spark, sf_dir, as_sent=True)
    spaced = F.col("event_at").cast("string")
    wall = F.replace(spaced, F.lit(" "), F.lit("T"))
    basic = F.translate(wall, "-:", "")
    forms = {
        "basic": basic,
        "basic_offset": F.concat(basic, F.lit("+0800")),
        "comma": F.concat(wall, F.lit(",5Z")),
        "padded": F.concat(F.lit("  "), wall, F.lit(" ")),
        "minute": F.concat(F.substring(wall, 1, 16), F.lit("Z")),
        "hour_offset": F.concat(wall, F.lit("-03")),
        "date_only": F.substring(wall, 1, 10),
        "spaced_junk": F.concat(spaced, F.lit(" (local)")),
        "no_month": F.concat(F.lit("2024-13-"), F.substring(wall, 9, 11)),
    }
    return logs.select("log_id", *[clock.kst_timestamp(text).alias(name) for name, text in forms.items()])


@query
def std_orders_odd(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with other currencies, statuses, amounts and times than those of the test tables."""
    return standardize.orders(star_tables.odd_orders(spark, sf_dir)).select(*ORDER_COLUMNS)


@query
def std_orders_naver(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = star_tables.raw_orders(spark, sf_dir).where(F.col("source_api") == "naver_commerce_api")
    return standardize.naver_orders(raw).select(*ORDER_COLUMNS)


@query
def std_orders_amazon(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = star_tables.raw_orders(spark, sf_dir).where(F.col("source_api") == "amazon_sp_api")
    return standardize.amazon_orders(raw).select(*ORDER_COLUMNS)


@query
def orders_union_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return standardize.orders(star_tables.raw_orders(spark, sf_dir)).select(
        "order_id", "platform", "order_status", "batch_date", "payment_amount", "paid_date"
    )


@query
def sessions_explode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return standardize.session_events(star_tables.raw_sessions(spark, sf_dir)).select(
        "raw_id", "event_pos", "event.event_id", "event.session_id", "event.event_name"
    )


@query
def std_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return standardize.behavior_logs(star_tables.raw_sessions(spark, sf_dir)).select(*LOG_COLUMNS)


# -- staging writes ----------------------------------------------------------------------


def _logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Logs that keep the rules of staging."""
    flagged = quality.with_violations(star_tables.logs(spark, sf_dir), quality.log_rules())
    return quality.clean(flagged)


def _order_loads(
    spark: SparkSession, sf_dir: str
) -> tuple[DayTable, list[tuple[str, staging.LoadStats]]]:
    """Raw orders loaded in two batches, the earlier of which comes again at the end."""
    root = new_folder(spark, "stg-orders")
    table = DayTable(spark, f"{root}/stg", STAGED_ORDERS, "paid_date", quality.order_rules)
    raw = stored(star_tables.raw_orders(spark, sf_dir), "raw-orders", PARSED_GROUP)
    early = F.col("batch_date") < F.lit(SECOND_LOAD_FROM)
    loads = (("early", raw.where(early)), ("late", raw.where(~early)), ("early again", raw.where(early)))
    stats = [
        (name, staging.load_orders(table, part, quarantine=f"{root}/quarantine"))
        for name, part in loads
    ]
    return table, stats


@query
def orders_upsert_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Staging after all loads: the newest good version of every order."""
    table, _ = _order_loads(spark, sf_dir)
    return table.read().select(*ORDER_COLUMNS)


@query
def upsert_loads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each load of the upsert sink was handed, changed and rejected."""
    _, stats = _order_loads(spark, sf_dir)
    return spark.createDataFrame(
        [(name, s.submitted, s.changed, s.rejected) for name, s in stats],
        "load string, submitted bigint, changed bigint, rejected bigint",
    )


@query
def logs_insert_ignore(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Logs of the first twenty days are in staging; a load of the last twenty comes in."""
    table = DayTable(
        spark, new_folder(spark, "stg-logs"), STAGED_LOGS, "event_date", quality.log_rules
    )
    logs, loaded = _logs(spark, sf_dir), F.unix_micros("loaded_at")
    staging.insert_logs(table, logs.where(F.col("event_date") <= F.lit(date(2024, 1, 20))))
    first = table.read().agg(F.max(loaded)).first()[0]
    staging.insert_logs(table, logs.where(F.col("event_date") >= F.lit(date(2024, 1, 11))))
    return table.read().select(
        F.when(loaded <= first, "kept").otherwise("inserted").alias("origin"),
        "log_id",
        "session_id",
        "event_name",
        "event_at",
    )


@query
def upsert_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order versions handed over per batch, and how many of them are the newest of their order."""
    versions = standardize.orders(star_tables.raw_orders(spark, sf_dir))
    narrow = versions.select("order_id", *keyed.ORDER_VERSION)
    changed = keyed.latest_orders(narrow).groupBy("batch_date").agg(F.count("*").alias("changed"))
    submitted = reports.submitted_per_batch(narrow, "order_id")
    return submitted.join(changed, "batch_date", "left").select(
        "batch_date", "submitted", F.coalesce("changed", F.lit(0)).alias("changed")
    )


@query
def logs_drop_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Drop the run date from a staging table; what is left per day, and the count dropped."""
    table = DayTable(spark, new_folder(spark, "stg-logs"), STAGED_LOGS, "event_date")
    table.add(_logs(spark, sf_dir))
    dropped = table.drop_day(RUN_DATE)
    return (
        table.read()
        .groupBy("event_date")
        .agg(F.count("*").alias("n_logs"))
        .withColumn("n_dropped", F.lit(dropped).cast("bigint"))
    )


@query
def behavior_ingest_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw payload files, streamed into staging."""
    root = new_folder(spark, "stream")
    raw_zone.land(star_tables.raw_sessions(spark, sf_dir), f"{root}/raw")
    table = DayTable(spark, f"{root}/stg", STAGED_LOGS, "event_date")
    stream = ingest_stream(
        spark, f"{root}/raw", table, f"{root}/checkpoint", quarantine=f"{root}/quarantine"
    )
    stream.awaitTermination()
    return table.read().select(*LOG_COLUMNS)


@query
def status_recheck_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = star_tables.orders_with_items(spark, sf_dir).withColumns(
        {
            "amount_before_fx": F.col("payment_amount"),
            "fx_rate": money.fx_rate(F.col("currency_code"), F.col("paid_date")),
        }
    )
    return collection.recheck_candidates(orders, RUN_DATE)


# -- attribution and funnel --------------------------------------------------------------


@query
def user_platform(spark: SparkSession, sf_dir: str) -> DataFrame:
    return attribution.main_platform(star_tables.orders(spark, sf_dir))


@query
def first_touch_session(spark: SparkSession, sf_dir: str) -> DataFrame:
    return attribution.first_touch(_logs(spark, sf_dir))


@query
def last_touch_user(spark: SparkSession, sf_dir: str) -> DataFrame:
    return attribution.last_touch(_logs(spark, sf_dir))


@query
def enriched_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return attribution.enriched_logs(
        _logs(spark, sf_dir), star_tables.orders(spark, sf_dir), WINDOW
    )


@query
def funnel_agg(spark: SparkSession, sf_dir: str) -> DataFrame:
    return funnel.funnel_counts(
        _logs(spark, sf_dir), star_tables.orders(spark, sf_dir), WINDOW
    )


@query
def order_purchases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return funnel.confirmed_purchases(
        star_tables.orders(spark, sf_dir), _logs(spark, sf_dir), WINDOW
    )


def _funnel(spark: SparkSession, sf_dir: str, window: tuple[date, date] | None = None) -> DataFrame:
    return funnel.funnel_daily(
        star_tables.orders(spark, sf_dir), _logs(spark, sf_dir), window
    )


def _shown(mart: DataFrame) -> DataFrame:
    """The capped rate as a double, and the uncapped one next to it."""
    return mart.withColumns(
        {
            "final_conversion_rate": F.col("final_conversion_rate").cast("double"),
            "uncapped_rate": F.col("purchase_completed_count") / F.col("total_visitors"),
        }
    )


@query
def funnel_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shown(_funnel(spark, sf_dir))


@query
def funnel_daily_all_statuses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The older form of the mart: no date window and no status filter."""
    return _shown(
        funnel.funnel_daily(
            star_tables.orders(spark, sf_dir), _logs(spark, sf_dir), None, status=None
        )
    )


@query
def funnel_window_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A mart built from all statuses, then refreshed with paid orders for the window only."""
    orders, logs = star_tables.orders(spark, sf_dir), _logs(spark, sf_dir)
    mart = DayTable(spark, new_folder(spark, "funnel"), FUNNEL_MART, "base_date")
    first = funnel.funnel_daily(orders, logs, None, status=None)
    mart.replace_all(first.withColumn("refreshed_at", F.current_timestamp()))
    marts.refresh_funnel(mart, orders, logs, WINDOW)
    return _shown(mart.read().drop("refreshed_at"))


# -- RFM ---------------------------------------------------------------------------------


@query
def rfm_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rfm.rfm_base(star_tables.orders(spark, sf_dir), AS_OF)


@query
def rfm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rfm.rfm_scores(rfm.rfm_base(star_tables.orders(spark, sf_dir), AS_OF))


@query
def rfm_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rfm.rfm_segments(star_tables.orders(spark, sf_dir), AS_OF)


@query
def rfm_segments_all_statuses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rfm.rfm_segments(star_tables.orders(spark, sf_dir), AS_OF, status=None)


@query
def rfm_segment_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.segment_sample(rfm_segments(spark, sf_dir))


@query
def rfm_segment_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.segment_counts(rfm_segments(spark, sf_dir))


@query
def rfm_segment_kpis(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.segment_kpis(rfm_segments(spark, sf_dir))


# -- funnel reports ----------------------------------------------------------------------


@query
def dash_filtered_funnel(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = reports.filtered_funnel(
        _funnel(spark, sf_dir), ["NAVER"], ["google", "(direct)"], WINDOW
    )
    return _shown(reports.newest_first(rows))


@query
def dash_filter_options(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.filter_options(_funnel(spark, sf_dir))


@query
def dash_funnel_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.funnel_totals(_funnel(spark, sf_dir))


@query
def dash_kpis(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.kpis(_funnel(spark, sf_dir))


@query
def dash_stage_detail(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.stage_detail(_funnel(spark, sf_dir))


@query
def dash_biggest_drop(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.biggest_drop(reports.stage_detail(_funnel(spark, sf_dir)))


@query
def dash_funnel_trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.trend(_funnel(spark, sf_dir))


@query
def dash_breakdown_platform(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.breakdown(_funnel(spark, sf_dir), "platform")


@query
def dash_breakdown_utm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.breakdown(_funnel(spark, sf_dir), "utm_source")


# -- zones and runs ----------------------------------------------------------------------


def _zone_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.zone_row_counts(
        {
            "raw_ecommerce_orders": star_tables.raw_orders(spark, sf_dir),
            "raw_user_behavior_logs": star_tables.raw_sessions(spark, sf_dir),
            "stg_ecommerce_orders": star_tables.orders(spark, sf_dir),
            "stg_user_behavior_logs": _logs(spark, sf_dir),
            "mart_user_funnel_daily": _funnel(spark, sf_dir),
            "mart_user_rfm_scores": rfm.rfm_base(star_tables.orders(spark, sf_dir), AS_OF),
        }
    )


@query
def zone_row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _zone_counts(spark, sf_dir)


@query
def zone_health(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.zone_health(_zone_counts(spark, sf_dir))


@query
def data_freshness(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.freshness(_logs(spark, sf_dir), star_tables.orders(spark, sf_dir))


@query
def order_status_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    versions = standardize.orders(star_tables.raw_orders(spark, sf_dir))
    return reports.status_counts(keyed.latest_orders(versions))


@query
def status_change_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.status_changes(standardize.orders(star_tables.raw_orders(spark, sf_dir)))


@query
def run_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = standardize.orders(star_tables.raw_orders(spark, sf_dir))
    logs = standardize.behavior_logs(star_tables.raw_sessions(spark, sf_dir))
    sent = star_tables.raw_sessions(spark, sf_dir)
    runs = sent.select(F.col("batch_date").alias("run_date")).distinct()
    return reports.run_totals(collection.collection_plan(runs, ORDER_LOOKBACK_DAYS), orders, logs)


# -- data rules --------------------------------------------------------------------------


@query
def dq_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rules over staging-shaped orders; those without order lines have no product or discount."""
    orders = star_tables.orders_with_items(spark, sf_dir).withColumn(
        "amount_before_fx", F.col("payment_amount")
    )
    return quality.rule_counts(orders, quality.order_rules())


@query
def dq_orders_odd(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rules over orders that break all but those which defaults keep."""
    orders = standardize.orders(star_tables.odd_orders(spark, sf_dir))
    return quality.rule_counts(orders, quality.order_rules())


@query
def dq_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.rule_counts(
        star_tables.logs(spark, sf_dir, as_sent=True), quality.log_rules()
    )


@query
def dq_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every raw order and event that the loads put aside, after two loads of the same rows.

    Some payloads are made unreadable first: a list, and events that are no list.
    """
    root = new_folder(spark, "quarantine")
    spoilt = F.col("ingest_seq") % SPOILT_EVERY == 0
    orders = stored(star_tables.raw_orders(spark, sf_dir), "raw-orders", PARSED_GROUP)
    sessions = stored(star_tables.raw_sessions(spark, sf_dir), "raw-sessions", PARSED_GROUP)
    orders = orders.withColumn("payload_json", F.when(spoilt, "[1]").otherwise(F.col("payload_json")))
    sessions = sessions.withColumn(
        "payload_json", F.when(spoilt, '{"events": "none"}').otherwise(F.col("payload_json"))
    )
    staged_orders = DayTable(spark, f"{root}/orders", STAGED_ORDERS, "paid_date", quality.order_rules)
    staged_logs = DayTable(spark, f"{root}/logs", STAGED_LOGS, "event_date", quality.log_rules)
    for _ in range(2):
        staging.load_orders(staged_orders, orders, quarantine=f"{root}/bad-orders")
        staging.load_logs(staged_logs, sessions, quarantine=f"{root}/bad-logs")
    broken = F.array_join("violations", ", ").alias("violations")
    bad = spark.read.parquet(f"{root}/bad-orders")
    bad_logs = spark.read.parquet(f"{root}/bad-logs")
    return bad.select("raw_id", F.col("order_id").alias("key"), broken).unionByName(
        bad_logs.select("raw_id", F.col("log_id").alias("key"), broken)
    )


@query
def dq_marts(spark: SparkSession, sf_dir: str) -> DataFrame:
    funnel_counts = quality.rule_counts(_funnel(spark, sf_dir), quality.funnel_rules())
    rfm_counts = quality.rule_counts(rfm_segments(spark, sf_dir), quality.rfm_rules())
    return funnel_counts.select(F.lit("funnel").alias("mart"), "rule", "violations").unionByName(
        rfm_counts.select(F.lit("rfm").alias("mart"), "rule", "violations")
    )


@query
def dq_marts_odd(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rules over both marts with values spoilt by day, platform and user."""
    day, user = F.dayofmonth("base_date"), F.col("user_id").cast("bigint")
    spoilt_funnel = _funnel(spark, sf_dir).withColumns(
        {
            "final_conversion_rate": F.when(day % 5 != 0, F.col("final_conversion_rate") + day % 2),
            "platform": F.when(day % 7 == 0, "EBAY").when(day % 7 != 1, F.col("platform")),
            "utm_source": F.when(day % 11 != 0, F.col("utm_source")),
            "product_views": F.when(day % 3 == 0, -F.col("product_views")).otherwise(F.col("product_views")),
            "total_visitors": F.when(day % 4 == 0, -F.col("total_visitors")).otherwise(F.col("total_visitors")),
        }
    )
    spoilt_rfm = rfm_segments(spark, sf_dir).withColumns(
        {
            "r_score": F.when(user % 3 == 0, F.col("r_score") + 3).otherwise(F.col("r_score")),
            "f_score": F.col("f_score") - F.when(user % 5 == 0, 2).otherwise(0),
            "segment_name": F.when(user % 7 == 0, "OTHER").when(user % 7 != 1, F.col("segment_name")),
            "monetary_amount": F.when(user % 11 == 0, -F.col("monetary_amount")).otherwise(F.col("monetary_amount")),
            "recency_days": F.col("recency_days") - F.when(user % 2 == 0, 20).otherwise(0),
        }
    )
    return reduce(
        DataFrame.unionByName,
        [
            quality.rule_counts(rows, rules).select(F.lit(mart).alias("mart"), "rule", "violations")
            for mart, rows, rules in (
                ("funnel", spoilt_funnel, quality.funnel_rules()),
                ("rfm", spoilt_rfm, quality.rfm_rules()),
            )
        ],
    )


@query
def dq_duplicate_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with more than one version in the raw zone."""
    versions = standardize.orders(star_tables.raw_orders(spark, sf_dir))
    return quality.duplicate_keys(versions, "order_id")


@query
def dq_orphan_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Staged orders whose raw row is gone because old batches were purged."""
    raw = star_tables.raw_orders(spark, sf_dir)
    staged = keyed.latest_orders(standardize.orders(raw)).select("order_id", "raw_id", "batch_date")
    return quality.orphans(staged, raw.where(F.col("batch_date") >= F.lit(RAW_KEPT_FROM)))


@query
def dq_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw orders that the landing put aside, of two fetches of the same rows.

    Some come from a source nobody knows, some without a payload.
    """
    house = Warehouse(spark, new_folder(spark, "raw-rules"))
    raw = star_tables.raw_orders(spark, sf_dir).withColumns(
        {
            "source_api": F.when(F.col("ingest_seq") % 97 == 0, "fax").otherwise(F.col("source_api")),
            "payload_json": F.when(F.col("ingest_seq") % 89 != 0, F.col("payload_json")),
        }
    )
    for _ in range(2):
        house.land(raw, None, on_reject="quarantine")
    bad = spark.read.parquet(f"{house.root}/quarantine/raw_ecommerce_orders")
    return bad.select("raw_id", "source_api", F.array_join("violations", ", ").alias("violations"))


@query
def dq_table_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys that occur more than once in each table, some of whose rows are doubled first."""
    number = F.col("user_id").cast("bigint")
    tables = (
        ("orders", star_tables.orders(spark, sf_dir), F.col("order_id").cast("bigint") % 97 == 0, ["order_id"]),
        ("logs", _logs(spark, sf_dir), F.col("log_id").cast("bigint") % 97 == 0, ["log_id"]),
        ("funnel", _funnel(spark, sf_dir), F.col("total_visitors") % 2 == 0, list(funnel.KEYS)),
        ("rfm", rfm.rfm_base(star_tables.orders(spark, sf_dir), AS_OF), number % 97 == 0, ["user_id"]),
    )
    found = [
        quality.duplicate_keys(rows.unionByName(rows.where(again)), *key).select(
            F.lit(name).alias("table_name"),
            F.concat_ws("|", *[F.col(k).cast("string") for k in key]).alias("key"),
            "copies",
        )
        for name, rows, again, key in tables
    ]
    return reduce(DataFrame.unionByName, found)


@query
def dq_volume(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.volume(_logs(spark, sf_dir))

"""Report frames over the marts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillmart.functions.ratios import percent, score_label
from tillmart.schemas import CHURN_SEGMENT, FUNNEL_STAGES, SEGMENT_ACTIONS, SEGMENTS

STAGE_COLUMNS = [column for column, _ in FUNNEL_STAGES]


# -- funnel ------------------------------------------------------------------------------


def filtered_funnel(
    funnel: DataFrame,
    platforms: Sequence[str] = (),
    utm_sources: Sequence[str] = (),
    dates: tuple[date, date] | None = None,
) -> DataFrame:
    """Rows of the chosen platforms, sources and dates; an empty choice keeps everything."""
    rows = funnel
    if platforms:
        rows = rows.where(F.col("platform").isin(*platforms))
    if utm_sources:
        rows = rows.where(F.col("utm_source").isin(*utm_sources))
    if dates is not None and len(dates) == 2:
        rows = rows.where(F.col("base_date").between(F.lit(dates[0]), F.lit(dates[1])))
    return rows


def newest_first(funnel: DataFrame) -> DataFrame:
    return funnel.orderBy(F.desc("base_date"), "platform", "utm_source")


def filter_options(funnel: DataFrame) -> DataFrame:
    """Sorted choices for the filters, and the first and last date, as (field, value) rows."""
    choices = funnel.select(
        F.explode(
            F.create_map(
                F.lit("platform"), F.col("platform"), F.lit("utm_source"), F.col("utm_source")
            )
        ).alias("field", "value")
    ).distinct()
    ends = funnel.agg(
        F.min("base_date").cast("string").alias("min_date"),
        F.max("base_date").cast("string").alias("max_date"),
    ).unpivot([], ["min_date", "max_date"], "field", "value")
    return choices.unionByName(ends).orderBy("field", "value")


def _stage_sums(funnel: DataFrame) -> list[Column]:
    """Sums of the stage columns; 0 for no rows or an absent column."""
    return [
        (F.coalesce(F.sum(c), F.lit(0)) if c in funnel.columns else F.lit(0)).cast("bigint").alias(c)
        for c in STAGE_COLUMNS
    ]


def funnel_totals(funnel: DataFrame) -> DataFrame:
    return funnel.agg(*_stage_sums(funnel))


def _with_cvr(rows: DataFrame) -> DataFrame:
    return rows.withColumn(
        "cvr", percent(F.col("purchase_completed_count"), F.col("total_visitors"))
    )


def kpis(funnel: DataFrame) -> DataFrame:
    sums = funnel.agg(
        *_stage_sums(funnel),
        F.count_distinct("base_date").alias("n_dates"),
        F.count("*").alias("n_rows"),
    )
    return _with_cvr(sums).select(
        "total_visitors",
        F.col("purchase_completed_count").alias("total_purchases"),
        "cvr",
        "n_dates",
        "n_rows",
    )


def stage_detail(funnel: DataFrame) -> DataFrame:
    """Five rows: stage, count, share of the first stage, share of the previous, drop."""
    stages = funnel_totals(funnel).select(
        F.posexplode(
            F.array(
                *[F.struct(F.lit(label).alias("stage"), F.col(c).alias("n")) for c, label in FUNNEL_STAGES]
            )
        ).alias("pos", "s"),
        F.col(STAGE_COLUMNS[0]).alias("first"),
    )
    # One row of totals became five, so a window over all of them stays tiny.
    ordered = Window.partitionBy("first").orderBy("pos")
    kept = F.when(F.col("prev").isNull(), 100.0).otherwise(percent(F.col("n"), F.col("prev")))
    return (
        stages.select("pos", "s.stage", "s.n", "first")
        .withColumn("prev", F.lag("n").over(ordered))
        .select(
            (F.col("pos") + 1).alias("stage_no"),
            "stage",
            F.col("n").alias("visitors"),
            percent(F.col("n"), F.col("first")).alias("pct_of_total"),
            kept.alias("pct_of_prev"),
        )
        .withColumn("drop_rate", F.lit(100.0) - F.col("pct_of_prev"))
    )


def biggest_drop(detail: DataFrame) -> DataFrame:
    """Stage that loses most; the earlier one of equals, never the first stage."""
    return (
        detail.where(F.col("stage_no") > 1)
        .orderBy(F.desc("drop_rate"), "stage_no")
        .limit(1)
        .select("stage_no", "stage", "drop_rate")
    )


def trend(funnel: DataFrame) -> DataFrame:
    return _with_cvr(funnel.groupBy("base_date").agg(*_stage_sums(funnel))).orderBy("base_date")


def breakdown(funnel: DataFrame, dimension: str) -> DataFrame:
    rows = _with_cvr(funnel.groupBy(dimension).agg(*_stage_sums(funnel)))
    return rows.orderBy(F.desc("cvr"), dimension)


# -- segments ----------------------------------------------------------------------------


def segment_sample(rfm: DataFrame, per_segment: int = 2) -> DataFrame:
    """The best-paying users of each segment with score label and suggested action."""
    place = F.row_number().over(
        Window.partitionBy("segment_name").orderBy(F.desc("monetary_amount"), F.asc("user_id"))
    )
    labels = F.create_map(*[F.lit(v) for pair in SEGMENT_ACTIONS.items() for v in pair])
    segment_no = F.array_position(F.array(*[F.lit(s) for s in SEGMENTS]), F.col("segment_name"))
    return (
        rfm.where(F.col("segment_name").isin(*SEGMENTS))
        .withColumn("place", place)
        .where(F.col("place") <= per_segment)
        .select(
            segment_no.cast("int").alias("segment_no"),
            "place",
            "user_id",
            "last_purchase_date",
            score_label(F.col("r_score"), F.col("f_score"), F.col("m_score")).alias("rfm"),
            "monetary_amount",
            "segment_name",
            F.coalesce(labels[F.col("segment_name")], F.lit("-")).alias("action"),
        )
        .orderBy("segment_no", "place")
    )


def segment_counts(rfm: DataFrame) -> DataFrame:
    """Users per segment and their share in percent, rounded half-even to one digit."""
    counted = rfm.groupBy("segment_name").agg(F.count("*").alias("customer_count"))
    # One row per segment (four) is left when the total is taken.
    total = F.sum("customer_count").over(Window.partitionBy())
    share = F.col("customer_count").cast("decimal(20,0)") * 100 / total.cast("decimal(20,0)")
    return counted.select(
        "segment_name", "customer_count", F.bround(share, 1).cast("double").alias("pct")
    ).orderBy(F.desc("customer_count"), "segment_name")


def segment_kpis(rfm: DataFrame) -> DataFrame:
    """One row: users of every segment (0 if absent), churn users and their share."""
    counts = segment_counts(rfm)
    of = {s: F.col("segment_name") == s for s in SEGMENTS}
    return counts.agg(
        *[F.coalesce(F.sum(F.when(is_s, F.col("customer_count"))), F.lit(0)).alias(name)
          for name, is_s in zip(("vip", "at_risk", "new", "dormant"), of.values())],
        F.coalesce(F.sum(F.when(of[CHURN_SEGMENT], F.col("customer_count"))), F.lit(0)).alias("churn_count"),
        F.coalesce(F.sum(F.when(of[CHURN_SEGMENT], F.col("pct"))), F.lit(0.0)).alias("churn_pct"),
    )


# -- zones and runs ----------------------------------------------------------------------


def zone_row_counts(tables: Mapping[str, DataFrame | None]) -> DataFrame:
    """Rows per table; a table that does not exist counts as null."""
    rows: DataFrame | None = None
    missing = [name for name, frame in tables.items() if frame is None]
    for name, frame in tables.items():
        if frame is None:
            continue
        one = frame.agg(F.count("*").alias("row_count")).select(
            F.lit(name).alias("table_name"), "row_count"
        )
        rows = one if rows is None else rows.unionByName(one)
    if rows is None:
        raise ValueError("no table to count")
    if missing:
        absent = rows.sparkSession.createDataFrame(
            [(name, None) for name in missing], "table_name string, row_count bigint"
        )
        rows = rows.unionByName(absent)
    return rows


# Tables that must hold rows for the zones to count as healthy.
HEALTH_TABLES = ("raw_user_behavior_logs", "stg_user_behavior_logs", "mart_user_funnel_daily")


def zone_health(counts: DataFrame) -> DataFrame:
    ok = F.count_if(F.col("table_name").isin(*HEALTH_TABLES) & (F.col("row_count") > 0))
    return counts.agg((ok == len(HEALTH_TABLES)).alias("healthy"))


def freshness(logs: DataFrame, orders: DataFrame) -> DataFrame:
    newest = logs.agg(F.max("event_at").alias("at")).union(orders.agg(F.max("paid_at").alias("at")))
    return newest.agg(F.max("at").alias("last_updated"))


def status_counts(orders: DataFrame) -> DataFrame:
    return orders.groupBy("order_status").agg(F.count("*").alias("n_orders"))


def status_changes(versions: DataFrame) -> DataFrame:
    """Cancelled and refunded order versions per batch."""
    status = F.col("order_status")
    return (
        versions.where(status.isin("CANCELLED", "REFUNDED"))
        .groupBy("batch_date")
        .agg(
            F.count_if(status == "CANCELLED").alias("cancelled"),
            F.count_if(status == "REFUNDED").alias("refunded"),
        )
    )


def submitted_per_batch(versions: DataFrame, key: str) -> DataFrame:
    """Distinct keys per batch date: what one load of that batch hands to staging."""
    return (
        versions.groupBy("batch_date", key)
        .agg(F.lit(1).alias("one"))
        .groupBy("batch_date")
        .agg(F.count("*").alias("submitted"))
    )


def run_totals(plan: DataFrame, orders: DataFrame, logs: DataFrame) -> DataFrame:
    """Rows handed to staging by each run of the collection plan.

    A batch is counted by every run that reads it again, so orders exceed the distinct ones.
    """
    per_feed = submitted_per_batch(orders, "order_id").select(
        F.lit("orders").alias("feed"), "batch_date", "submitted"
    ).unionByName(
        submitted_per_batch(logs, "log_id").select(
            F.lit("logs").alias("feed"), "batch_date", "submitted"
        )
    )

    def of(feed: str) -> Column:
        return F.coalesce(F.sum(F.when(F.col("feed") == feed, F.col("submitted"))), F.lit(0))

    return (
        plan.join(per_feed, ["feed", "batch_date"], "left")
        .groupBy("run_date")
        .agg(of("orders").alias("submitted_orders"), of("logs").alias("submitted_logs"))
    )



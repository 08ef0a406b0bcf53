"""Data rules: flags per row, counts per rule, key and reference checks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillmart.schemas import (
    DEVICE_TYPES,
    EVENT_NAMES,
    LOG_SOURCES,
    MIN_LOG_RECORDS,
    ORDER_SOURCES,
    ORDER_STATUSES,
    PLATFORMS,
    SEGMENTS,
)

Rules = Mapping[str, Column]


def _required(*columns: str) -> dict[str, Column]:
    return {f"{c} missing": F.col(c).isNull() for c in columns}


def _one_of(column: str, allowed: Sequence[str]) -> dict[str, Column]:
    return {f"{column} unknown": ~F.col(column).isin(*allowed)}


def _not_negative(*columns: str) -> dict[str, Column]:
    return {f"{c} negative": F.col(c) < 0 for c in columns}


def _between(column: str, low: int, high: int) -> dict[str, Column]:
    return {f"{column} out of range": ~F.col(column).between(low, high)}


def raw_rules(sources: Sequence[str]) -> Rules:
    return {
        **_required("raw_id", "source_api", "batch_date", "payload_json", "fetched_at"),
        **_one_of("source_api", sources),
    }


def raw_order_rules() -> Rules:
    return raw_rules(ORDER_SOURCES)


def raw_log_rules() -> Rules:
    return raw_rules(LOG_SOURCES)


def order_rules() -> Rules:
    return {
        **_required(
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
        ),
        **_one_of("platform", PLATFORMS),
        **_one_of("order_status", ORDER_STATUSES),
        "currency_code length": F.length("currency_code") != 3,
        **_not_negative("payment_amount", "discount_amount", "amount_before_fx"),
    }


def log_rules() -> Rules:
    return {
        **_required(
            "log_id",
            "session_id",
            "event_name",
            "utm_source",
            "utm_medium",
            "device_type",
            "event_at",
            "event_date",
        ),
        **_one_of("event_name", EVENT_NAMES),
        **_one_of("device_type", DEVICE_TYPES),
    }


def funnel_rules() -> Rules:
    return {
        **_required("base_date", "platform", "utm_source", "final_conversion_rate"),
        **_one_of("platform", PLATFORMS),
        **_not_negative(
            "total_visitors",
            "product_views",
            "add_to_cart_count",
            "checkout_started_count",
            "purchase_completed_count",
        ),
        **_between("final_conversion_rate", 0, 1),
    }


def rfm_rules() -> Rules:
    return {
        **_required("user_id", "frequency_count", "monetary_amount", "segment_name"),
        **_between("r_score", 1, 5),
        **_between("f_score", 1, 5),
        **_between("m_score", 1, 5),
        **_one_of("segment_name", SEGMENTS),
        **_not_negative("frequency_count", "monetary_amount", "recency_days"),
    }


def breaks_any(rules: Rules) -> Column:
    return reduce(Column.__or__, [F.coalesce(bad, F.lit(False)) for bad in rules.values()])


def with_violations(rows: DataFrame, rules: Rules) -> DataFrame:
    """Add the names of the rules each row breaks. A rule that gives null is not broken.

    The names are put together only for rows that break one.
    """
    broken = F.array_compact(F.array(*[F.when(bad, F.lit(name)) for name, bad in rules.items()]))
    none = F.array().cast("array<string>")
    return rows.withColumn("violations", F.when(breaks_any(rules), broken).otherwise(none))


def clean(flagged: DataFrame) -> DataFrame:
    return flagged.where(F.size("violations") == 0).drop("violations")


def rejected(flagged: DataFrame) -> DataFrame:
    return flagged.where(F.size("violations") > 0)


def rule_counts(rows: DataFrame, rules: Rules) -> DataFrame:
    """Broken rows per rule, in one pass; rules that nothing breaks count 0."""
    sums = rows.agg(*[F.count_if(F.coalesce(bad, F.lit(False))).alias(n) for n, bad in rules.items()])
    return sums.unpivot([], list(rules), "rule", "violations")


def duplicate_keys(rows: DataFrame, *key: str) -> DataFrame:
    return rows.groupBy(*key).agg(F.count("*").alias("copies")).where(F.col("copies") > 1)


def orphans(rows: DataFrame, raw: DataFrame) -> DataFrame:
    """Rows whose raw_id is set but not in the raw zone.

    A raw row lies in its own batch, so only the batches that ``rows`` name are read.
    """
    return rows.where(F.col("raw_id").isNotNull()).join(
        raw.select("batch_date", "raw_id"), ["batch_date", "raw_id"], "left_anti"
    )


def volume(logs: DataFrame, floor: int = MIN_LOG_RECORDS) -> DataFrame:
    return logs.agg(F.count("*").alias("log_records")).select(
        "log_records",
        F.lit(floor).cast("bigint").alias("floor"),
        (F.col("log_records") >= floor).alias("enough"),
    )

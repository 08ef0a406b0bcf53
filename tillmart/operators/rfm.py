"""Recency, frequency and monetary scores per buyer."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillmart.operators.attribution import with_status
from tillmart.operators.ntile import add_ntiles
from tillmart.schemas import MONEY
from tillmart.sources.shared import stored


def rfm_base(orders: DataFrame, as_of: date, status: str | None = "PAID") -> DataFrame:
    """Last payment date, days since then, number of orders and total paid per user.

    ``orders`` has one row per order_id, so a plain count is the number of distinct orders.
    """
    return (
        with_status(orders, status)
        .groupBy("user_id")
        .agg(
            F.max("paid_date").alias("last_purchase_date"),
            F.count("*").alias("frequency_count"),
            F.sum("payment_amount").cast(MONEY).alias("monetary_amount"),
        )
        .select(
            "user_id",
            "last_purchase_date",
            F.date_diff(F.lit(as_of), "last_purchase_date").alias("recency_days"),
            "frequency_count",
            "monetary_amount",
        )
    )


def rfm_scores(base: DataFrame) -> DataFrame:
    """Scores 1 to 5: newest payment, most orders and largest total are best.

    Equal values are ordered by user_id.
    """
    tiled = add_ntiles(
        stored(base, "rfm-base"),
        {"_r": "recency_days", "f_score": "frequency_count", "m_score": "monetary_amount"},
        tie="user_id",
    )
    return tiled.withColumn("r_score", 6 - F.col("_r")).select(
        *base.columns, "r_score", "f_score", "m_score"
    )


def segment(r: Column, f: Column, m: Column, orders: Column) -> Column:
    """Segment rules, first match wins."""
    return (
        F.when((r >= 4) & (f >= 4) & (m >= 4), "VIP")
        .when((r <= 2) & ((f >= 3) | (m >= 3)), "이탈위기")
        .when((orders == 1) & (r >= 4), "신규")
        .when((r <= 2) & (f <= 2) & (m <= 2), "겨울잠")
        .when((r >= 3) & (f >= 3), "VIP")
        .when(r <= 2, "이탈위기")
        .otherwise("겨울잠")
    )


def rfm_segments(orders: DataFrame, as_of: date, status: str | None = "PAID") -> DataFrame:
    """The RFM mart. It is always rebuilt whole: every user's recency moves every day."""
    return rfm_scores(rfm_base(orders, as_of, status)).withColumn(
        "segment_name",
        segment(F.col("r_score"), F.col("f_score"), F.col("m_score"), F.col("frequency_count")),
    )

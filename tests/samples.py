"""Seven orders and nine events with known marts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# KIM buys on both platforms, CHOI equally often and at the same time on both, PARK without any event.
_ORDERS = [
    ("A1", "KIM", "P1", "50000.00", "1000.00", "50000.00", "KRW", "NAVER", "2025-03-02 08:00:00"),
    ("A2", "KIM", "P2", "30000.00", "0.00", "22.00", "USD", "AMAZON", "2025-03-04 20:15:00"),
    ("A3", "KIM", "P3", "10000.00", "0.00", "10000.00", "KRW", "NAVER", "2025-03-04 21:00:00"),
    ("B1", "LEE", "P1", "76000.00", "0.00", "56.00", "USD", "AMAZON", "2025-03-03 12:30:00"),
    ("C1", "PARK", "P4", "15000.00", "500.00", "15000.00", "KRW", "NAVER", "2025-01-15 09:00:00"),
    ("D1", "CHOI", "P5", "76000.00", "0.00", "76000.00", "KRW", "NAVER", "2025-03-04 10:00:00"),
    ("D2", "CHOI", "P5", "4000.00", "0.00", "3.00", "USD", "AMAZON", "2025-03-04 10:00:00"),
]
# LEE looks again through another campaign after buying; one session is a guest's without a source.
_LOGS = [
    ("L1", "s1", "KIM", "view_item", "google", "cpc", "mobile", "2025-03-02 07:50:00"),
    ("L2", "s1", "KIM", "purchase", "google", "cpc", "mobile", "2025-03-02 08:00:00"),
    ("L3", "s2", "LEE", "view_item", "kakao", "social", "app", "2025-03-03 12:00:00"),
    ("L4", "s2", "LEE", "add_to_cart", "kakao", "social", "app", "2025-03-03 12:10:00"),
    ("L5", "s2", "LEE", "begin_checkout", "kakao", "social", "app", "2025-03-03 12:20:00"),
    ("L6", "s3", "CHOI", "view_item", "naver", "cpc", "desktop", "2025-03-04 09:30:00"),
    ("L7", "s3", "CHOI", "add_to_cart", "naver", "cpc", "desktop", "2025-03-04 09:40:00"),
    ("L8", "s4", None, "view_item", None, None, "tablet", "2025-03-04 15:00:00"),
    ("L9", "s5", "LEE", "view_item", "instagram", "social", "app", "2025-03-04 18:00:00"),
]


def orders_frame(spark: SparkSession, rows=_ORDERS, status: str = "PAID") -> DataFrame:
    names = (
        "order_id string, user_id string, product_id string, pay string, disc string, before string, "
        "currency_code string, platform string, at string"
    )
    return spark.createDataFrame(rows, names).select(
        "order_id",
        "user_id",
        "product_id",
        F.col("pay").cast("decimal(18,2)").alias("payment_amount"),
        F.col("disc").cast("decimal(18,2)").alias("discount_amount"),
        F.col("before").cast("decimal(18,2)").alias("amount_before_fx"),
        "currency_code",
        "platform",
        F.col("at").cast("timestamp_ntz").alias("paid_at"),
        F.lit(status).alias("order_status"),
        F.to_date(F.substring("at", 1, 10)).alias("paid_date"),
    )


def logs_frame(spark: SparkSession, rows=_LOGS) -> DataFrame:
    names = (
        "log_id string, session_id string, user_id string, event_name string, utm_source string, "
        "utm_medium string, device_type string, at string"
    )
    return spark.createDataFrame(rows, names).select(
        "log_id",
        "session_id",
        "user_id",
        "event_name",
        "utm_source",
        "utm_medium",
        "device_type",
        F.col("at").cast("timestamp_ntz").alias("event_at"),
        F.to_date(F.substring("at", 1, 10)).alias("event_date"),
    )

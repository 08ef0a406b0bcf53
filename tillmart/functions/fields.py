"""Defaults for missing fields, code lists, and dotted source paths."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from tillmart.schemas import DEFAULT_DEVICE, DEVICE_TYPES, UNKNOWN_BUYER

# Source field to staging column. Amounts are computed by the loads.
NAVER_COLUMNS = {
    "orderNo": "order_id",
    "buyerId": "user_id",
    "productNo": "product_id",
    "currency": "currency_code",
    "paidDatetime": "paid_at",
    "orderStatus": "order_status",
}
AMAZON_COLUMNS = {
    "AmazonOrderId": "order_id",
    "BuyerEmail": "user_id",
    "ASIN": "product_id",
    "OrderTotal.CurrencyCode": "currency_code",
    "PurchaseDate": "paid_at",
    "OrderStatus": "order_status",
}
EVENT_COLUMNS = {
    "event_id": "log_id",
    "session_id": "session_id",
    "user_pseudo_id": "user_id",
    "event_name": "event_name",
    "traffic_source.source": "utm_source",
    "traffic_source.medium": "utm_medium",
    "device.category": "device_type",
    "event_timestamp": "event_at",
}


def mapped(source: str, columns: Mapping[str, str]) -> list[Column]:
    """Select list that renames the fields of struct ``source``; a missing level gives null."""
    return [F.col(f"{source}.{path}").alias(name) for path, name in columns.items()]


def blank_to(value: Column, default: str) -> Column:
    """``default`` for null and the empty string."""
    return F.coalesce(F.nullif(value, F.lit("")), F.lit(default))


def buyer(value: Column) -> Column:
    return blank_to(value, UNKNOWN_BUYER)


def device(value: Column) -> Column:
    """A known device, else the default one."""
    return F.when(value.isin(*DEVICE_TYPES), value).otherwise(DEFAULT_DEVICE)

"""Raw payload rows to staging-shaped rows.

Values that cannot be read become null here; the NOT NULL rules of
``operators.quality`` then send the row to quarantine.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillmart.functions import clock, fields, money
from tillmart.schemas import AMAZON_ORDER, BEHAVIOR_SESSION, DIRECT, NAVER_ORDER, NO_MEDIUM

_LINEAGE = ("raw_id", "batch_date", "fetched_at", "ingest_seq")


def _with_payload(raw: DataFrame, schema: str) -> DataFrame:
    return raw.select(*_LINEAGE, F.from_json("payload_json", schema).alias("p"))


def _status(value: Column) -> Column:
    """A missing status means PAID; an explicit null stays null."""
    return F.when(value.isNull(), "PAID").otherwise(money.json_text(value))


def _won_discount(value: Column) -> Column:
    """Missing, null, zero and the empty string all mean no discount."""
    empty = value.isNull() | money.is_json_null(value) | (F.coalesce(money.json_text(value), F.lit("")) == "")
    return F.when(empty, 0).otherwise(money.number(value))


def _promotion(value: Column) -> Column:
    """A missing object or a missing amount means no discount; a null one is an error."""
    amount = F.try_variant_get(value, "$.Amount", "variant")
    is_object = F.schema_of_variant(value).startswith("OBJECT")
    return F.when(value.isNull() | (amount.isNull() & is_object), 0).otherwise(money.number(amount))


def _read(p: DataFrame, currency: Column) -> DataFrame:
    """Mapped order fields with defaults filled in and times read."""
    return p.withColumns(
        {
            "user_id": fields.buyer(F.col("user_id")),
            "currency_code": currency,
            "paid_at": clock.kst_timestamp(F.col("paid_at")),
            "order_status": _status(F.col("order_status")),
        }
    )


def naver_orders(raw: DataFrame) -> DataFrame:
    """Orders of the first source. Rates are those of the batch date, not of the payment."""
    p = _with_payload(raw, NAVER_ORDER).select(
        *_LINEAGE,
        *fields.mapped("p", fields.NAVER_COLUMNS),
        money.number(F.col("p.totalPayment")).alias("net"),
        _won_discount(F.col("p.discountAmt")).alias("discount"),
    )
    currency = F.col("currency_code")
    p = _read(
        p,
        F.when(currency.isNull(), money.HOME_CURRENCY).otherwise(
            F.upper(money.json_text(currency))
        ),
    ).withColumn("fx_rate", money.fx_rate(F.col("currency_code"), F.col("batch_date")))
    currency, rate = F.col("currency_code"), F.col("fx_rate")
    return _staged_order(
        p,
        "NAVER",
        payment=money.in_won(F.col("net"), currency, rate),
        discount=money.in_won(F.col("discount"), currency, rate),
        before_fx=money.money(F.col("net")),
    )


def amazon_orders(raw: DataFrame) -> DataFrame:
    """Orders of the second source: every amount is multiplied by the rate, won included."""
    p = _with_payload(raw, AMAZON_ORDER).select(
        *_LINEAGE,
        *fields.mapped("p", fields.AMAZON_COLUMNS),
        money.number(F.col("p.OrderTotal.Amount")).alias("net"),
        _promotion(F.col("p.PromotionDiscount")).alias("discount"),
    )
    p = _read(p, F.col("currency_code")).withColumn("fx_rate", money.fx_rate(F.col("currency_code"), F.col("batch_date")))
    rate = F.col("fx_rate")
    return _staged_order(
        p,
        "AMAZON",
        payment=money.money(F.col("net") * rate),
        discount=money.money(F.col("discount") * rate),
        before_fx=money.money(F.col("net") + F.col("discount")),
    )


def _staged_order(
    p: DataFrame, platform: str, payment: Column, discount: Column, before_fx: Column
) -> DataFrame:
    return p.select(
        "order_id",
        "user_id",
        "product_id",
        payment.alias("payment_amount"),
        discount.alias("discount_amount"),
        before_fx.alias("amount_before_fx"),
        "currency_code",
        F.lit(platform).alias("platform"),
        "paid_at",
        "order_status",
        "fx_rate",
        *_LINEAGE,
        F.to_date("paid_at").alias("paid_date"),
    )


def orders(raw: DataFrame) -> DataFrame:
    """Route raw rows by source; rows of any other source are left out."""
    source = F.col("source_api")
    return naver_orders(raw.where(source == "naver_commerce_api")).unionByName(
        amazon_orders(raw.where(source == "amazon_sp_api"))
    )


def _sessions(raw: DataFrame) -> DataFrame:
    """One row per element of ``events``, and one for a payload that cannot be read.

    A payload is unreadable if it is no JSON object, or if it has ``events`` that are no array;
    without ``events`` it gives no row. The check looks at a payload again only where no events
    were found. An inner explode would make the optimizer test the array for size below it, and
    so parse every payload once more.
    """
    found = F.try_parse_json("payload_json")
    readable = F.schema_of_variant(found).startswith("OBJECT") & F.try_variant_get(
        found, "$.events", "variant"
    ).isNull()
    parsed = raw.select(
        *_LINEAGE, "payload_json", F.from_json("payload_json", BEHAVIOR_SESSION).alias("p")
    )
    unreadable = F.when(F.col("p.events").isNull(), ~F.coalesce(readable, F.lit(False)))
    return (
        parsed.withColumn("unreadable", F.coalesce(unreadable, F.lit(False)))
        .select(*_LINEAGE, "unreadable", F.posexplode_outer("p.events").alias("event_pos", "event"))
        .where(F.col("event_pos").isNotNull() | F.col("unreadable"))
    )


def session_events(raw: DataFrame) -> DataFrame:
    """One row per element of ``events`` of the payloads that can be read."""
    return _sessions(raw).where(~F.col("unreadable")).drop("unreadable")


def behavior_logs(raw: DataFrame) -> DataFrame:
    """Session payloads to log rows; ``unreadable`` marks the row of a payload that cannot be read."""
    named = _sessions(raw).select(
        *_LINEAGE, "event_pos", "unreadable", *fields.mapped("event", fields.EVENT_COLUMNS)
    )
    return named.withColumn("event_at", clock.kst_timestamp(F.col("event_at"))).select(
        "log_id",
        "session_id",
        "user_id",
        "event_name",
        fields.blank_to(F.col("utm_source"), DIRECT).alias("utm_source"),
        fields.blank_to(F.col("utm_medium"), NO_MEDIUM).alias("utm_medium"),
        fields.device(F.col("device_type")).alias("device_type"),
        "event_at",
        *_LINEAGE,
        "event_pos",
        F.to_date("event_at").alias("event_date"),
        "unreadable",
    )

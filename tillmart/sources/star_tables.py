"""The test tables (``events``, ``orders``, ``lineitem``, ``customer``) in staging and raw shape."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillmart.functions.clock import whole_second
from tillmart.functions.fields import device
from tillmart.schemas import DIRECT, MONEY, NO_MEDIUM
from tillmart.sources.raw_zone import raw_rows

# How codes of the test tables map to ours.
EVENT_OF = {"view": "view_item", "click": "add_to_cart", "signup": "begin_checkout", "purchase": "purchase"}
STATUS_OF = {"F": "PAID", "O": "SHIPPED", "P": "CANCELLED"}
UTM = ((None, None), ("google", "organic"), ("instagram", "social"), ("naver_blog", "cpc"))
DEVICES = ("mobile", "desktop", "tablet", "app", "tv")
AMAZON_PRIORITIES = ("1-URGENT", "2-HIGH")
RECHECK_AFTER_DAYS = 3
EVENTS_PER_PAYLOAD = 4


def _choose(codes: dict[str, str], value: Column) -> Column:
    return F.create_map(*[F.lit(v) for pair in codes.items() for v in pair])[value]


def _pick(values: tuple[str | None, ...], index: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index + 1).cast("int"))


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    day = F.to_date("ts")
    utm = F.get_json_object("props", "$.k").cast("int") % len(UTM)
    number = F.col("event_id")
    return events.select(
        number,
        F.col("event_id").cast("string").alias("log_id"),
        F.concat_ws("-", F.col("user_id").cast("string"), F.replace(day.cast("string"), F.lit("-"), F.lit(""))).alias("session_id"),
        F.when(number % 20 != 0, F.col("user_id").cast("string")).alias("user_id"),
        F.coalesce(_choose(EVENT_OF, F.col("event_type")), F.col("event_type")).alias("event_name"),
        _pick(tuple(s for s, _ in UTM), utm).alias("source"),
        _pick(tuple(m for _, m in UTM), utm).alias("medium"),
        _pick(DEVICES, number % len(DEVICES)).alias("device"),
        whole_second(F.col("ts")).alias("event_at"),
        day.alias("event_date"),
    )


def logs(spark: SparkSession, sf_dir: str, as_sent: bool = False) -> DataFrame:
    """Staging-shaped logs, those with a name staging rejects too; ``as_sent`` keeps odd devices."""
    return _events(spark, sf_dir).select(
        "log_id",
        "session_id",
        "user_id",
        "event_name",
        F.coalesce("source", F.lit(DIRECT)).alias("utm_source"),
        F.coalesce("medium", F.lit(NO_MEDIUM)).alias("utm_medium"),
        (F.col("device") if as_sent else device(F.col("device"))).alias("device_type"),
        "event_at",
        F.lit(None).cast("string").alias("raw_id"),
        F.col("event_date").alias("batch_date"),
        F.date_add("event_date", 1).cast("timestamp_ntz").alias("fetched_at"),
        F.col("event_id").alias("ingest_seq"),
        F.lit(0).alias("event_pos"),
        F.lit(None).cast("timestamp").alias("loaded_at"),
        "event_date",
    )


def _paid_date(ordered: Column) -> Column:
    """Order days folded onto the thirty days the events cover."""
    days = F.date_diff(ordered, F.lit("1995-01-01").cast("date"))
    return F.date_add(F.lit("2024-01-01").cast("date"), days % 30)


def _platform(priority: Column) -> Column:
    return F.when(priority.isin(*AMAZON_PRIORITIES), "AMAZON").otherwise("NAVER")


def _order_columns() -> dict[str, Column]:
    day = _paid_date(F.to_date("o_orderdate"))
    platform = _platform(F.col("o_orderpriority"))
    return {
        "order_id": F.col("o_orderkey").cast("string"),
        "user_id": F.col("o_custkey").cast("string"),
        "payment_amount": F.col("o_totalprice").cast(MONEY),
        "currency_code": F.when(platform == "AMAZON", "USD").otherwise("KRW"),
        "platform": platform,
        "paid_at": day.cast("timestamp_ntz"),
        "order_status": _choose(STATUS_OF, F.col("o_orderstatus")),
        "paid_date": day,
    }


def _select(rows: DataFrame, columns: dict[str, Column]) -> DataFrame:
    return rows.select(*[c.alias(name) for name, c in columns.items()])


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Staging-shaped orders without the columns that need the order lines."""
    return _select(spark.read.parquet(f"{sf_dir}/orders.parquet"), _order_columns())


def orders_with_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with product and discount; both are null for an order without lines."""
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    # Two two-digit numbers multiplied: summed as whole ten-thousandths, which is exact.
    discount = F.rint(F.col("l_extendedprice") * 100).cast("bigint") * F.rint(
        F.col("l_discount") * 100
    ).cast("bigint")
    per_order = lines.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.min("l_partkey").alias("part"),
        (F.sum(discount).cast("decimal(18,0)") * F.lit(Decimal("0.0001"))).cast(MONEY).alias("discount"),
    )
    joined = spark.read.parquet(f"{sf_dir}/orders.parquet").join(per_order, "o_orderkey", "left")
    return _select(
        joined,
        {
            **_order_columns(),
            "product_id": F.col("part").cast("string"),
            "discount_amount": F.col("discount"),
        },
    )


def _quoted(text: Column) -> Column:
    """JSON text of a value without quotes, backslashes or control characters."""
    return F.concat(F.lit('"'), text, F.lit('"'))


def _object(fields: dict[str, Column]) -> Column:
    """JSON object of values that are JSON already; null ones are left out, as ``to_json`` does."""
    given = [F.concat(F.lit(f'"{name}":'), value) for name, value in fields.items()]
    return F.concat(F.lit("{"), F.concat_ws(",", *given), F.lit("}"))


def raw_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order payloads: each order once as new, and again three days later if its status moved."""
    new = F.struct(
        F.lit(0).alias("no"), F.col("paid_date").alias("batch"), F.lit(None).cast("string").alias("status")
    )
    moved = F.struct(
        F.lit(1).alias("no"),
        F.date_add("paid_date", RECHECK_AFTER_DAYS).alias("batch"),
        F.col("order_status").alias("status"),
    )
    versions = F.when(F.col("order_status") == "PAID", F.array(new)).otherwise(F.array(new, moved))
    sent = orders_with_items(spark, sf_dir).withColumn("sent", F.explode(versions))

    def iso(at: Column) -> Column:
        return F.replace(at.cast("string"), F.lit(" "), F.lit("T"))

    # Numbers, times and codes: nothing in them needs escaping.
    order, buyer, product = (_quoted(F.col(c)) for c in ("order_id", "user_id", "product_id"))
    status = _quoted(F.col("sent.status"))
    paid, discount = (F.col(c).cast("string") for c in ("payment_amount", "discount_amount"))
    naver = {
        "orderNo": order,
        "buyerId": F.when(F.col("user_id").cast("bigint") % 50 == 0, '""').otherwise(buyer),
        "productNo": product,
        "totalPayment": paid,
        "discountAmt": discount,
        "currency": F.lit('"KRW"'),
        "paidDatetime": _quoted(iso(F.col("paid_at"))),
        "orderStatus": status,
    }

    def price(amount: Column) -> Column:
        return _object({"Amount": amount, "CurrencyCode": F.lit('"USD"')})

    utc = F.timestamp_add("HOUR", F.lit(-9), F.col("paid_at"))
    amazon = {
        "AmazonOrderId": order,
        "BuyerEmail": buyer,
        "ASIN": product,
        "OrderTotal": price(paid),
        "PromotionDiscount": F.when(discount.isNotNull(), price(discount)),
        "PurchaseDate": _quoted(F.concat(iso(utc), F.lit("Z"))),
        "OrderStatus": status,
    }
    is_naver = F.col("platform") == "NAVER"
    return raw_rows(
        sent,
        F.when(is_naver, "naver_commerce_api").otherwise("amazon_sp_api"),
        F.when(is_naver, _object(naver)).otherwise(_object(amazon)),
        batch_date=F.col("sent.batch"),
        fetched_at=F.date_add("sent.batch", 1),
        raw_id=F.concat_ws("-", F.lit("o"), F.col("order_id"), F.col("sent.no").cast("string")),
        ingest_seq=F.col("order_id").cast("bigint"),
    )


# Fixed values of the odd orders, chosen by the order number; an empty text leaves the field out.
ODD_CURRENCIES = ('"KRW"', '"usd"', '"JPY"', '"EUR"', '"WONS"', "")
ODD_STATUSES = ('"PAID"', '"SHIPPED"', '"CANCELLED"', '"REFUNDED"', '"LOST"', "null", "")
ODD_TIMES = ("T23:59:59", "T15:00:00Z", "T00:00:00+10:00")


def odd_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One payload for each order, with values that the test tables themselves never hold."""
    number = F.col("order_id").cast("bigint")
    net = F.col("payment_amount").cast("string")
    amount = (
        F.when(number % 11 == 0, F.concat(F.lit("-"), net))
        .when(number % 11 == 1, "null")
        .when(number % 11 == 2, F.concat(F.lit('"'), net, F.lit('"')))
        .otherwise(net)
    )
    discount = F.when(number % 13 == 0, "-1").when(number % 13 == 1, "").otherwise("2.005")
    currency = _pick(ODD_CURRENCIES, number % len(ODD_CURRENCIES))
    order = F.when(number % 19 != 0, F.col("order_id")).otherwise("")
    buyer = F.when(number % 4 == 0, '""').when(number % 4 == 1, "").otherwise(F.col("user_id"))
    paid = F.concat(
        F.lit('"'),
        F.when(number % 23 == 0, "soon").otherwise(
            F.concat(F.col("paid_date").cast("string"), _pick(ODD_TIMES, number % len(ODD_TIMES)))
        ),
        F.lit('"'),
    )
    product = F.coalesce("product_id", F.lit(""))
    status = _pick(ODD_STATUSES, number % len(ODD_STATUSES))

    def payload(fields: dict[str, Column]) -> Column:
        given = [F.when(v != "", F.concat(F.lit(f'"{name}":'), v)) for name, v in fields.items()]
        return F.concat(F.lit("{"), F.concat_ws(",", *given), F.lit("}"))

    def price(value: Column) -> Column:
        return payload({"Amount": value, "CurrencyCode": currency})

    naver = payload(
        {
            "orderNo": order,
            "buyerId": buyer,
            "productNo": product,
            "totalPayment": amount,
            "discountAmt": discount,
            "currency": currency,
            "paidDatetime": paid,
            "orderStatus": status,
        }
    )
    amazon = payload(
        {
            "AmazonOrderId": order,
            "BuyerEmail": buyer,
            "ASIN": product,
            "OrderTotal": price(amount),
            "PromotionDiscount": price(discount),
            "PurchaseDate": paid,
            "OrderStatus": status,
        }
    )
    is_naver = F.col("platform") == "NAVER"
    return raw_rows(
        orders_with_items(spark, sf_dir),
        F.when(is_naver, "naver_commerce_api").otherwise("amazon_sp_api"),
        F.when(is_naver, naver).otherwise(amazon),
        batch_date=F.col("paid_date"),
        fetched_at=F.date_add("paid_date", 1),
        raw_id=F.concat_ws("-", F.lit("x"), F.col("order_id")),
        ingest_seq=number,
    )


def raw_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Behaviour payloads: four neighbouring events each, and one without events per customer.

    Timestamps come in three forms: KST without offset, UTC with Z, KST with offset.
    """
    events = _events(spark, sf_dir)
    iso = F.replace(F.col("event_at").cast("string"), F.lit(" "), F.lit("T"))
    utc = F.replace(
        F.timestamp_add("HOUR", F.lit(-9), F.col("event_at")).cast("string"), F.lit(" "), F.lit("T")
    )
    form = F.col("event_id") % 3
    stamp = F.when(form == 0, iso).when(form == 1, F.concat(utc, F.lit("Z"))).otherwise(
        F.concat(iso, F.lit("+09:00"))
    )
    event = F.struct(
        "event_id",
        F.struct(
            F.col("log_id").alias("event_id"),
            "session_id",
            F.col("user_id").alias("user_pseudo_id"),
            "event_name",
            F.struct(F.col("source").alias("source"), F.col("medium").alias("medium")).alias("traffic_source"),
            F.struct(F.col("device").alias("category")).alias("device"),
            stamp.alias("event_timestamp"),
        ).alias("body"),
    )
    # The number of events per payload is fixed, so the lists stay short whatever the data.
    packs = (
        events.groupBy(F.floor(F.col("event_id") / EVENTS_PER_PAYLOAD).alias("pack"))
        .agg(F.sort_array(F.collect_list(event)).alias("list"), F.min("event_date").alias("day"))
        .select(
            F.concat(F.lit("s-"), F.col("pack").cast("string")).alias("session_id"),
            F.transform("list", lambda e: e["body"]).alias("events"),
            F.col("pack").alias("seq"),
            "day",
        )
    )
    idle = spark.read.parquet(f"{sf_dir}/customer.parquet").select(
        F.concat(F.lit("c-"), F.col("c_custkey").cast("string")).alias("session_id"),
        F.lit(None).cast(packs.schema["events"].dataType).alias("events"),
        F.col("c_custkey").alias("seq"),
        F.lit("2024-01-01").cast("date").alias("day"),
    )
    rows = packs.unionByName(idle)
    return raw_rows(
        rows,
        F.lit("ga4_export"),
        F.to_json(F.struct("session_id", "events")),
        batch_date=F.col("day"),
        fetched_at=F.date_add("day", 1),
        raw_id=F.col("session_id"),
        ingest_seq=F.col("seq"),
    )

"""Table schemas and the fixed values every layer shares."""

from __future__ import annotations

# Allowed codes of the staging and mart tables.
PLATFORMS = ("NAVER", "AMAZON")
DEFAULT_PLATFORM = "NAVER"
ORDER_STATUSES = ("PAID", "SHIPPED", "CANCELLED", "REFUNDED")
EVENT_NAMES = ("view_item", "add_to_cart", "begin_checkout", "purchase")
DEVICE_TYPES = ("mobile", "desktop", "tablet", "app")
ORDER_SOURCES = ("naver_commerce_api", "amazon_sp_api")
LOG_SOURCES = ("ga4_export", "internal_event_api")
SEGMENTS = ("VIP", "이탈위기", "신규", "겨울잠")
CHURN_SEGMENT = "이탈위기"

# Defaults for missing fields.
DIRECT = "(direct)"
NO_MEDIUM = "(none)"
UNKNOWN_BUYER = "UNKNOWN"
DEFAULT_DEVICE = "mobile"

# Collection cadence.
ORDER_LOOKBACK_DAYS = 14
BEHAVIOR_LOOKBACK_DAYS = 0
MIN_LOG_RECORDS = 1000

# Funnel stages in display order, and the action offered to each segment.
FUNNEL_STAGES = (
    ("total_visitors", "방문"),
    ("product_views", "상품 조회"),
    ("add_to_cart_count", "장바구니"),
    ("checkout_started_count", "결제 시작"),
    ("purchase_completed_count", "구매 완료"),
)
SEGMENT_ACTIONS = {
    "VIP": "얼리 액세스 · 리퍼럴 프로그램",
    "이탈위기": "Win-back 쿠폰 발송",
    "신규": "온보딩 시리즈 (D+1~D+7)",
    "겨울잠": "시즌 큐레이션 DM",
}

MONEY = "decimal(18,2)"

RAW_ROWS = (
    "raw_id string, source_api string, batch_date date, payload_json string, "
    "fetched_at timestamp_ntz, ingest_seq bigint"
)

# Where a staging row came from; orders the versions of one key.
LINEAGE = "batch_date date, fetched_at timestamp_ntz, ingest_seq bigint"

STAGED_ORDERS = (
    "order_id string, user_id string, product_id string, payment_amount decimal(18,2), "
    "discount_amount decimal(18,2), amount_before_fx decimal(18,2), currency_code string, "
    "platform string, paid_at timestamp_ntz, order_status string, fx_rate decimal(10,4), "
    f"raw_id string, {LINEAGE}, loaded_at timestamp, paid_date date"
)

STAGED_LOGS = (
    "log_id string, session_id string, user_id string, event_name string, utm_source string, "
    f"utm_medium string, device_type string, event_at timestamp_ntz, raw_id string, {LINEAGE}, "
    "event_pos int, loaded_at timestamp, event_date date"
)

_TOUCH = "touch struct<event_at: timestamp_ntz, log_id: string, utm_source: string>"
SESSION_TOUCHES = f"session_id string, {_TOUCH}, event_date date"
USER_TOUCHES = f"user_id string, {_TOUCH}, event_date date"

FUNNEL_MART = (
    "platform string, utm_source string, total_visitors bigint, product_views bigint, "
    "add_to_cart_count bigint, checkout_started_count bigint, purchase_completed_count bigint, "
    "final_conversion_rate decimal(8,4), refreshed_at timestamp, base_date date"
)

RFM_MART = (
    "user_id string, last_purchase_date date, recency_days int, frequency_count bigint, "
    "monetary_amount decimal(18,2), r_score int, f_score int, m_score int, "
    "segment_name string, refreshed_at timestamp"
)

# Payloads. VARIANT fields keep "missing" (SQL null) apart from an explicit JSON null.
NAVER_ORDER = (
    "orderNo string, buyerId string, productNo string, totalPayment variant, "
    "discountAmt variant, currency variant, paidDatetime string, orderStatus variant"
)
AMAZON_ORDER = (
    "AmazonOrderId string, BuyerEmail string, ASIN string, "
    "OrderTotal struct<Amount: variant, CurrencyCode: string>, PromotionDiscount variant, "
    "PurchaseDate string, OrderStatus variant"
)
BEHAVIOR_SESSION = (
    "session_id string, events array<struct<event_id: string, session_id: string, "
    "user_pseudo_id: string, event_name: string, "
    "traffic_source: struct<source: string, medium: string>, "
    "device: struct<category: string>, event_timestamp: string>>"
)

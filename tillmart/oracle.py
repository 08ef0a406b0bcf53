"""The same queries in SQL for an independent engine, over the same test tables."""

from __future__ import annotations

WINDOW = "BETWEEN DATE '2024-01-16' AND DATE '2024-01-30'"

# -- shared parts ------------------------------------------------------------------------

EVENTS = """
ev AS (
  SELECT event_id, CAST(event_id AS VARCHAR) AS log_id,
    CAST(user_id AS VARCHAR) || '-' || strftime(ts, '%Y%m%d') AS session_id,
    CASE WHEN event_id % 20 <> 0 THEN CAST(user_id AS VARCHAR) END AS user_id,
    CASE event_type WHEN 'view' THEN 'view_item' WHEN 'click' THEN 'add_to_cart'
      WHEN 'signup' THEN 'begin_checkout' ELSE event_type END AS event_name,
    CASE CAST(json_extract(props, '$.k') AS INTEGER) % 4 WHEN 0 THEN '(direct)' WHEN 1 THEN 'google'
      WHEN 2 THEN 'instagram' ELSE 'naver_blog' END AS utm_source,
    CASE CAST(json_extract(props, '$.k') AS INTEGER) % 4 WHEN 0 THEN '(none)' WHEN 1 THEN 'organic'
      WHEN 2 THEN 'social' ELSE 'cpc' END AS utm_medium,
    CASE event_id % 5 WHEN 0 THEN 'mobile' WHEN 1 THEN 'desktop' WHEN 2 THEN 'tablet'
      WHEN 3 THEN 'app' ELSE 'tv' END AS device,
    date_trunc('second', ts) AS event_at, CAST(ts AS DATE) AS event_date
  FROM events)"""

LOGS = f"""{EVENTS},
logs AS (
  SELECT log_id, session_id, user_id, event_name, utm_source, utm_medium,
    CASE WHEN device = 'tv' THEN 'mobile' ELSE device END AS device_type, event_at, event_date
  FROM ev WHERE event_name <> 'error')"""

ORDERS = """
ords AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS order_id, CAST(o_custkey AS VARCHAR) AS user_id,
    CAST(o_totalprice AS DECIMAL(18,2)) AS payment_amount,
    CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'USD' ELSE 'KRW' END AS currency_code,
    CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'AMAZON' ELSE 'NAVER' END AS platform,
    DATE '2024-01-01' + CAST(date_diff('day', DATE '1995-01-01', CAST(o_orderdate AS DATE)) % 30 AS INTEGER)
      AS paid_date,
    CASE o_orderstatus WHEN 'F' THEN 'PAID' WHEN 'O' THEN 'SHIPPED' ELSE 'CANCELLED' END AS order_status
  FROM orders)"""

ITEMS = """
items AS (
  SELECT CAST(l_orderkey AS VARCHAR) AS order_id, CAST(MIN(l_partkey) AS VARCHAR) AS product_id,
    CAST(SUM(CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(l_discount AS DECIMAL(4,2))) AS DECIMAL(18,2))
      AS discount_amount
  FROM lineitem GROUP BY 1),
full_ords AS (SELECT o.*, i.product_id, i.discount_amount FROM ords o LEFT JOIN items i USING (order_id))"""


def _rate(currency: str, day: str) -> str:
    step = f"((date_diff('day', DATE '1970-01-01', {day}) + 719163) % 7 - 3)"
    base = f"CASE {currency} WHEN 'KRW' THEN 10000 WHEN 'USD' THEN 13500000 WHEN 'JPY' THEN 92000 END"
    return f"CAST(CAST({base} AS DECIMAL(12,0)) * (1000 + 2 * {step}) * 0.0000001 AS DECIMAL(10,4))"


# Every order version as the raw zone has it, and as it is after standardisation.
VERSIONS = f"""{ORDERS},{ITEMS},
versions AS (
  SELECT *, CAST(NULL AS VARCHAR) AS sent_status, paid_date AS batch_date, 0 AS version FROM full_ords
  UNION ALL
  SELECT *, order_status, paid_date + 3, 1 FROM full_ords WHERE order_status <> 'PAID'),
std AS (
  SELECT order_id,
    CASE WHEN platform = 'NAVER' AND CAST(user_id AS BIGINT) % 50 = 0 THEN 'UNKNOWN' ELSE user_id END AS user_id,
    product_id,
    CASE WHEN platform = 'NAVER' THEN payment_amount
      ELSE CAST(payment_amount * {_rate('currency_code', 'batch_date')} AS DECIMAL(18,2)) END AS payment_amount,
    CASE WHEN platform = 'NAVER' THEN COALESCE(discount_amount, 0)
      ELSE CAST(COALESCE(discount_amount, 0) * {_rate('currency_code', 'batch_date')} AS DECIMAL(18,2)) END
      AS discount_amount,
    CASE WHEN platform = 'NAVER' THEN payment_amount
      ELSE CAST(payment_amount + COALESCE(discount_amount, 0) AS DECIMAL(18,2)) END AS amount_before_fx,
    currency_code, platform, CAST(paid_date AS TIMESTAMP) AS paid_at,
    COALESCE(sent_status, 'PAID') AS order_status,
    {_rate('currency_code', 'batch_date')} AS fx_rate,
    'o-' || order_id || '-' || CAST(version AS VARCHAR) AS raw_id, batch_date, version, paid_date
  FROM versions),
latest AS (SELECT * FROM std QUALIFY ROW_NUMBER() OVER (PARTITION BY order_id ORDER BY batch_date DESC, version DESC) = 1)"""

STD_COLUMNS = (
    "order_id, user_id, product_id, payment_amount, discount_amount, amount_before_fx, "
    "currency_code, platform, paid_at, order_status, fx_rate, raw_id"
)

# Payload text as it lies in the raw zone.
RAW = f"""{VERSIONS},
raw AS (
  SELECT 'o-' || order_id || '-' || CAST(version AS VARCHAR) AS raw_id,
    CASE platform WHEN 'NAVER' THEN 'naver_commerce_api' ELSE 'amazon_sp_api' END AS source_api,
    batch_date, CAST(order_id AS BIGINT) AS ingest_seq,
    CASE platform WHEN 'NAVER' THEN
      '{{"orderNo":"' || order_id || '","buyerId":"'
      || CASE WHEN CAST(user_id AS BIGINT) % 50 = 0 THEN '' ELSE user_id END || '"'
      || COALESCE(',"productNo":"' || product_id || '"', '')
      || ',"totalPayment":' || CAST(payment_amount AS VARCHAR)
      || COALESCE(',"discountAmt":' || CAST(discount_amount AS VARCHAR), '')
      || ',"currency":"KRW","paidDatetime":"' || strftime(paid_date, '%Y-%m-%d') || 'T00:00:00"'
      || COALESCE(',"orderStatus":"' || sent_status || '"', '') || '}}'
    ELSE
      '{{"AmazonOrderId":"' || order_id || '","BuyerEmail":"' || user_id || '"'
      || COALESCE(',"ASIN":"' || product_id || '"', '')
      || ',"OrderTotal":{{"Amount":' || CAST(payment_amount AS VARCHAR) || ',"CurrencyCode":"USD"}}'
      || COALESCE(',"PromotionDiscount":{{"Amount":' || CAST(discount_amount AS VARCHAR) || ',"CurrencyCode":"USD"}}', '')
      || ',"PurchaseDate":"' || strftime(paid_date - 1, '%Y-%m-%d') || 'T15:00:00Z"'
      || COALESCE(',"OrderStatus":"' || sent_status || '"', '') || '}}'
    END AS payload_json
  FROM versions)"""


def _platforms(status: str | None) -> str:
    keep = "" if status is None else f"WHERE order_status = '{status}'"
    return f"""
up AS (
  SELECT user_id, platform FROM ords {keep} GROUP BY user_id, platform
  QUALIFY ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY COUNT(*) DESC, MAX(paid_date) DESC, platform) = 1)"""


FIRST_TOUCH = """
ft AS (
  SELECT session_id, utm_source FROM logs
  QUALIFY ROW_NUMBER() OVER (PARTITION BY session_id ORDER BY event_at, log_id) = 1)"""

LAST_TOUCH = """
lt AS (
  SELECT user_id, utm_source FROM logs WHERE user_id IS NOT NULL
  QUALIFY ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY event_at DESC, log_id DESC) = 1)"""


def _funnel(window: str | None = None, status: str | None = "PAID", tag: str = "") -> str:
    """Funnel mart as CTE ``funnel<tag>`` on top of ``logs``, ``ords``, ``ft`` and ``lt``."""
    day = f"AND l.event_date {window}" if window else ""
    paid = f"AND o.paid_date {window}" if window else ""
    keep = f"AND o.order_status = '{status}'" if status else ""
    return f"""{_platforms(status).replace('up AS', f'up{tag} AS', 1)},
en{tag} AS (
  SELECT l.event_date AS base_date, COALESCE(up{tag}.platform, 'NAVER') AS platform,
    COALESCE(ft.utm_source, '(direct)') AS utm_source, l.session_id, l.event_name, l.log_id
  FROM logs l LEFT JOIN ft ON l.session_id = ft.session_id LEFT JOIN up{tag} ON l.user_id = up{tag}.user_id
  WHERE TRUE {day}),
agg{tag} AS (
  SELECT base_date, platform, utm_source, COUNT(DISTINCT session_id) AS total_visitors,
    COUNT(*) FILTER (event_name = 'view_item') AS product_views,
    COUNT(*) FILTER (event_name = 'add_to_cart') AS add_to_cart_count,
    COUNT(*) FILTER (event_name = 'begin_checkout') AS checkout_started_count,
    COUNT(*) FILTER (event_name = 'purchase') AS purchase_from_logs
  FROM en{tag} GROUP BY 1, 2, 3),
bought{tag} AS (
  SELECT o.paid_date AS base_date, o.platform, COALESCE(lt.utm_source, '(direct)') AS utm_source,
    COUNT(DISTINCT o.order_id) AS purchase_from_orders
  FROM ords o LEFT JOIN lt ON o.user_id = lt.user_id WHERE TRUE {paid} {keep} GROUP BY 1, 2, 3),
counted{tag} AS (
  SELECT a.*, GREATEST(COALESCE(b.purchase_from_orders, 0), a.purchase_from_logs) AS purchase_completed_count
  FROM agg{tag} a LEFT JOIN bought{tag} b ON a.base_date = b.base_date AND a.platform = b.platform
    AND a.utm_source = b.utm_source),
funnel{tag} AS (
  SELECT base_date, platform, utm_source, total_visitors, product_views, add_to_cart_count,
    checkout_started_count, purchase_completed_count,
    CASE WHEN purchase_completed_count >= total_visitors THEN 1.0
      ELSE CAST((20000 * purchase_completed_count + total_visitors) // (2 * total_visitors) AS DOUBLE) / 10000
      END::DOUBLE AS final_conversion_rate,
    CAST(purchase_completed_count AS DOUBLE) / total_visitors AS uncapped_rate
  FROM counted{tag})"""


FUNNEL_PARTS = f"{LOGS},{ORDERS},{FIRST_TOUCH},{LAST_TOUCH}"
FUNNEL = f"WITH {FUNNEL_PARTS},{_funnel()}"
SHOWN = (
    "base_date, platform, utm_source, total_visitors, product_views, add_to_cart_count, "
    "checkout_started_count, purchase_completed_count, final_conversion_rate, uncapped_rate"
)
STAGES = (
    ("total_visitors", "방문"),
    ("product_views", "상품 조회"),
    ("add_to_cart_count", "장바구니"),
    ("checkout_started_count", "결제 시작"),
    ("purchase_completed_count", "구매 완료"),
)
SUMS = ", ".join(f"CAST(COALESCE(SUM({c}), 0) AS BIGINT) AS {c}" for c, _ in STAGES)


def _rfm(status: str | None = "PAID") -> str:
    keep = f"WHERE order_status = '{status}'" if status else ""
    return f"""WITH {ORDERS},
base AS (
  SELECT user_id, MAX(paid_date) AS last_purchase_date,
    CAST(date_diff('day', MAX(paid_date), DATE '2024-01-31') AS INTEGER) AS recency_days,
    COUNT(DISTINCT order_id) AS frequency_count, CAST(SUM(payment_amount) AS DECIMAL(18,2)) AS monetary_amount
  FROM ords {keep} GROUP BY user_id),
scored AS (
  SELECT *, CAST(6 - NTILE(5) OVER (ORDER BY recency_days, user_id) AS INTEGER) AS r_score,
    CAST(NTILE(5) OVER (ORDER BY frequency_count, user_id) AS INTEGER) AS f_score,
    CAST(NTILE(5) OVER (ORDER BY monetary_amount, user_id) AS INTEGER) AS m_score FROM base),
rfm AS (
  SELECT *, CASE
    WHEN r_score >= 4 AND f_score >= 4 AND m_score >= 4 THEN 'VIP'
    WHEN r_score <= 2 AND (f_score >= 3 OR m_score >= 3) THEN '이탈위기'
    WHEN frequency_count = 1 AND r_score >= 4 THEN '신규'
    WHEN r_score <= 2 AND f_score <= 2 AND m_score <= 2 THEN '겨울잠'
    WHEN r_score >= 3 AND f_score >= 3 THEN 'VIP'
    WHEN r_score <= 2 THEN '이탈위기' ELSE '겨울잠' END AS segment_name FROM scored)"""


RFM = _rfm()
SEGMENT_COUNTS = f"""{RFM},
seg AS (SELECT segment_name, COUNT(*) AS customer_count FROM rfm GROUP BY 1),
tot AS (SELECT CAST(SUM(customer_count) AS BIGINT) AS t FROM seg),
-- half-even to one digit, in whole numbers
tenths AS (
  SELECT segment_name, customer_count, (1000 * customer_count) // t AS low, (1000 * customer_count) % t AS rest, t
  FROM seg, tot),
shares AS (
  SELECT segment_name, customer_count,
    CAST(low + CASE WHEN 2 * rest > t OR (2 * rest = t AND low % 2 = 1) THEN 1 ELSE 0 END AS DOUBLE) / 10 AS pct
  FROM tenths)"""

STAGE_DETAIL = f"""{FUNNEL},
sums AS (SELECT {SUMS} FROM funnel),
steps AS ({' UNION ALL '.join(
    f"SELECT {i + 1} AS stage_no, '{label}' AS stage, {c} AS visitors, "
    + (f"{STAGES[i - 1][0]}" if i else "CAST(NULL AS BIGINT)")
    + " AS prev, total_visitors AS first FROM sums" for i, (c, label) in enumerate(STAGES))}),
detail AS (
  SELECT CAST(stage_no AS INTEGER) AS stage_no, stage, visitors,
    CASE WHEN first > 0 THEN visitors / first * 100 ELSE 0.0 END::DOUBLE AS pct_of_total,
    CASE WHEN stage_no = 1 THEN 100.0 WHEN prev > 0 THEN visitors / prev * 100 ELSE 0.0 END::DOUBLE AS pct_of_prev
  FROM steps)"""

CVR = (
    "CASE WHEN total_visitors > 0 THEN purchase_completed_count / total_visitors * 100 ELSE 0.0 END::DOUBLE AS cvr"
)


def _rules(table: str, rules: dict[str, str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{name}' AS rule, COUNT(*) FILTER ({bad}) AS violations FROM {table}"
        for name, bad in rules.items()
    )


def _missing(*columns: str) -> dict[str, str]:
    return {f"{c} missing": f"{c} IS NULL" for c in columns}


def _negative(*columns: str) -> dict[str, str]:
    return {f"{c} negative": f"{c} < 0" for c in columns}


ORDER_RULES = {
    **_missing(
        "order_id", "user_id", "product_id", "payment_amount", "discount_amount",
        "amount_before_fx", "currency_code", "platform", "paid_at", "order_status",
    ),
    "platform unknown": "platform NOT IN ('NAVER', 'AMAZON')",
    "order_status unknown": "order_status NOT IN ('PAID', 'SHIPPED', 'CANCELLED', 'REFUNDED')",
    "currency_code length": "length(currency_code) <> 3",
    **_negative("payment_amount", "discount_amount", "amount_before_fx"),
}
LOG_RULES = {
    **_missing(
        "log_id", "session_id", "event_name", "utm_source", "utm_medium", "device_type",
        "event_at", "event_date",
    ),
    "event_name unknown": "event_name NOT IN ('view_item', 'add_to_cart', 'begin_checkout', 'purchase')",
    "device_type unknown": "device_type NOT IN ('mobile', 'desktop', 'tablet', 'app')",
}
FUNNEL_RULES = {
    **_missing("base_date", "platform", "utm_source", "final_conversion_rate"),
    "platform unknown": "platform NOT IN ('NAVER', 'AMAZON')",
    **_negative(
        "total_visitors", "product_views", "add_to_cart_count", "checkout_started_count",
        "purchase_completed_count",
    ),
    "final_conversion_rate out of range": "final_conversion_rate NOT BETWEEN 0 AND 1",
}
RFM_RULES = {
    **_missing("user_id", "frequency_count", "monetary_amount", "segment_name"),
    **{f"{c} out of range": f"{c} NOT BETWEEN 1 AND 5" for c in ("r_score", "f_score", "m_score")},
    "segment_name unknown": "segment_name NOT IN ('VIP', '이탈위기', '신규', '겨울잠')",
    **_negative("frequency_count", "monetary_amount", "recency_days"),
}

# Sizes of the raw feeds per batch date.
RAW_SIZES = f"""{ORDERS},{EVENTS},
raw_order_days AS (
  SELECT paid_date AS batch_date FROM ords UNION ALL
  SELECT paid_date + 3 FROM ords WHERE order_status <> 'PAID'),
raw_log_days AS (
  SELECT MIN(event_date) AS batch_date FROM ev GROUP BY event_id // 4 UNION ALL
  SELECT DATE '2024-01-01' FROM customer)"""

ZONES = f"""WITH {FUNNEL_PARTS},{_funnel()},
raw_order_days AS (
  SELECT 1 FROM ords UNION ALL SELECT 1 FROM ords WHERE order_status <> 'PAID'),
raw_log_days AS (SELECT 1 FROM ev GROUP BY event_id // 4 UNION ALL SELECT 1 FROM customer),
zones AS (
  SELECT 'raw_ecommerce_orders' AS table_name, COUNT(*) AS row_count FROM raw_order_days UNION ALL
  SELECT 'raw_user_behavior_logs', COUNT(*) FROM raw_log_days UNION ALL
  SELECT 'stg_ecommerce_orders', COUNT(*) FROM ords UNION ALL
  SELECT 'stg_user_behavior_logs', COUNT(*) FROM logs UNION ALL
  SELECT 'mart_user_funnel_daily', COUNT(*) FROM funnel UNION ALL
  SELECT 'mart_user_rfm_scores', COUNT(DISTINCT user_id) FROM ords WHERE order_status = 'PAID')"""

STD_EVENTS = f"""WITH {EVENTS}
SELECT log_id, session_id, user_id, event_name, utm_source, utm_medium,
  CASE WHEN device = 'tv' THEN 'mobile' ELSE device END AS device_type, event_at, event_date,
  's-' || CAST(event_id // 4 AS VARCHAR) AS raw_id FROM ev"""

# Orders with values the test tables never hold, after standardisation.
ODD_ORDERS = f"""{ORDERS},{ITEMS},
chosen AS (
  SELECT *, CAST(order_id AS BIGINT) AS k, platform = 'NAVER' AS naver,
    CASE k % 6 WHEN 0 THEN 'KRW' WHEN 1 THEN 'usd' WHEN 2 THEN 'JPY' WHEN 3 THEN 'EUR' WHEN 4 THEN 'WONS' END AS sent,
    CASE k % 11 WHEN 0 THEN -payment_amount WHEN 1 THEN NULL ELSE payment_amount END AS net,
    CASE k % 13 WHEN 0 THEN -1 WHEN 1 THEN 0 ELSE 2.005 END::DECIMAL(10,3) AS off,
    CAST(paid_date AS TIMESTAMP) AS d
  FROM full_ords),
currencies AS (SELECT *, CASE WHEN naver THEN upper(coalesce(sent, 'KRW')) ELSE sent END AS currency FROM chosen),
rates AS (SELECT *, {_rate('upper(currency)', 'paid_date')} AS fx_rate,
  CASE WHEN naver AND currency = 'KRW' THEN 1 ELSE {_rate('upper(currency)', 'paid_date')} END::DECIMAL(10,4) AS times
  FROM currencies),
odd AS (
  SELECT CASE WHEN k % 19 <> 0 THEN order_id END AS order_id,
    CASE WHEN k % 4 < 2 THEN 'UNKNOWN' ELSE user_id END AS user_id, product_id,
    CAST(net * times AS DECIMAL(18,2)) AS payment_amount, CAST(off * times AS DECIMAL(18,2)) AS discount_amount,
    CAST(CASE WHEN naver THEN net ELSE net + off END AS DECIMAL(18,2)) AS amount_before_fx,
    currency AS currency_code, platform,
    CASE WHEN k % 23 = 0 THEN NULL WHEN k % 3 = 0 THEN d + INTERVAL 86399 SECOND
      WHEN k % 3 = 1 THEN d + INTERVAL 1 DAY ELSE d - INTERVAL 1 HOUR END AS paid_at,
    CASE k % 7 WHEN 1 THEN 'SHIPPED' WHEN 2 THEN 'CANCELLED' WHEN 3 THEN 'REFUNDED' WHEN 4 THEN 'LOST'
      WHEN 5 THEN NULL ELSE 'PAID' END AS order_status,
    fx_rate, 'x-' || CAST(k AS VARCHAR) AS raw_id FROM rates)"""

# What a warehouse holds after all raw rows were loaded.
HOUSE = f"""WITH {VERSIONS}, staged AS (SELECT * FROM latest WHERE product_id IS NOT NULL),
{LOGS},{FIRST_TOUCH},{LAST_TOUCH},{_funnel().replace('ords', 'staged')}"""

QUERIES: dict[str, str] = {
    "raw_landing": f"WITH {RAW} SELECT raw_id, source_api, batch_date, payload_json, ingest_seq FROM raw",
    "raw_batch_scan": f"WITH {RAW} SELECT raw_id, source_api, batch_date, payload_json FROM raw WHERE batch_date {WINDOW}",
    "collection_plan": f"""WITH {RAW_SIZES},
runs AS (SELECT DISTINCT batch_date AS run_date FROM raw_order_days),
plan AS (
  SELECT run_date, 'orders' AS feed, run_date - CAST(n AS INTEGER) AS batch_date FROM runs, range(15) t(n)
  UNION ALL SELECT run_date, 'logs', run_date FROM runs),
sizes AS (
  SELECT 'orders' AS feed, batch_date, COUNT(*) AS n FROM raw_order_days GROUP BY 2 UNION ALL
  SELECT 'logs', batch_date, COUNT(*) FROM raw_log_days GROUP BY 2)
SELECT run_date, p.feed, p.batch_date, COALESCE(n, 0) AS raw_rows
FROM plan p LEFT JOIN sizes s ON p.feed = s.feed AND p.batch_date = s.batch_date""",
    "fx_rate_daily": f"""WITH {ORDERS}
SELECT currency_code, paid_date, COUNT(*) AS n_orders, {_rate('currency_code', 'paid_date')} AS fx_rate
FROM ords GROUP BY currency_code, paid_date""",
    "std_currency": f"""WITH {ORDERS},
rated AS (SELECT *, {_rate('currency_code', 'paid_date')} AS fx_rate FROM ords)
SELECT order_id, currency_code, fx_rate, payment_amount AS amount_before_fx,
  CASE WHEN currency_code = 'KRW' THEN payment_amount
    ELSE CAST(payment_amount * fx_rate AS DECIMAL(18,2)) END AS payment_won FROM rated""",
    "std_timestamps": f"""WITH {EVENTS}
SELECT log_id, event_at AS naive, event_at AS spaced, event_at + INTERVAL 9 HOUR AS zulu,
  event_at + INTERVAL 870 MINUTE AS "offset", event_at AS fraction, event_at AS junk,
  strftime(event_at + INTERVAL 9 HOUR, '%Y-%m-%d %H:%M:%S') AS zulu_text,
  CAST(event_at + INTERVAL 9 HOUR AS DATE) AS zulu_date FROM ev""",
    "std_orders_naver": f"WITH {VERSIONS} SELECT {STD_COLUMNS} FROM std WHERE platform = 'NAVER'",
    "std_orders_amazon": f"WITH {VERSIONS} SELECT {STD_COLUMNS} FROM std WHERE platform = 'AMAZON'",
    "orders_union_sources": f"WITH {VERSIONS} SELECT order_id, platform, order_status, batch_date, payment_amount, paid_date FROM std",
    "sessions_explode": f"""WITH {EVENTS}
SELECT 's-' || CAST(event_id // 4 AS VARCHAR) AS raw_id,
  CAST(ROW_NUMBER() OVER (PARTITION BY event_id // 4 ORDER BY event_id) - 1 AS INTEGER) AS event_pos,
  log_id AS event_id, session_id, event_name FROM ev""",
    "std_events": STD_EVENTS,
    "orders_upsert_latest": f"WITH {VERSIONS} SELECT {STD_COLUMNS} FROM latest WHERE product_id IS NOT NULL",
    "upsert_loads": f"""WITH {VERSIONS},
parts AS (SELECT *, batch_date < DATE '2024-01-16' AS early, product_id IS NOT NULL AS good FROM std)
SELECT 'early' AS load, COUNT(DISTINCT order_id) FILTER (good) AS submitted,
  COUNT(DISTINCT order_id) FILTER (good) AS changed, COUNT(*) FILTER (NOT good) AS rejected FROM parts WHERE early
UNION ALL SELECT 'late', COUNT(DISTINCT order_id) FILTER (good), COUNT(DISTINCT order_id) FILTER (good),
  COUNT(*) FILTER (NOT good) FROM parts WHERE NOT early
UNION ALL SELECT 'early again', COUNT(DISTINCT order_id) FILTER (good), 0, COUNT(*) FILTER (NOT good)
FROM parts WHERE early""",
    "logs_insert_ignore": f"""WITH {LOGS}
SELECT CASE WHEN event_date <= DATE '2024-01-20' THEN 'kept' ELSE 'inserted' END AS origin,
  log_id, session_id, event_name, event_at FROM logs""",
    "upsert_stats": f"""WITH {VERSIONS}
SELECT s.batch_date, COUNT(DISTINCT s.order_id) AS submitted,
  COUNT(DISTINCT CASE WHEN s.raw_id = l.raw_id THEN s.order_id END) AS changed
FROM std s JOIN latest l USING (order_id) GROUP BY s.batch_date""",
    "logs_drop_partition": f"""WITH {LOGS}
SELECT event_date, COUNT(*) AS n_logs,
  (SELECT COUNT(*) FROM logs WHERE event_date = DATE '2024-01-30') AS n_dropped
FROM logs WHERE event_date <> DATE '2024-01-30' GROUP BY event_date""",
    "behavior_ingest_stream": f"{STD_EVENTS} WHERE event_name <> 'error'",
    "status_recheck_candidates": f"""WITH {ORDERS},{ITEMS}
SELECT order_id, user_id, product_id, payment_amount, discount_amount,
  payment_amount AS amount_before_fx, currency_code, platform, CAST(paid_date AS TIMESTAMP) AS paid_at,
  {_rate('currency_code', 'paid_date')} AS fx_rate
FROM full_ords WHERE order_status = 'PAID' AND paid_date >= DATE '2024-01-16' AND paid_date < DATE '2024-01-30'""",
    "user_platform": f"WITH {ORDERS},{_platforms('PAID')} SELECT user_id, platform FROM up",
    "first_touch_session": f"WITH {LOGS},{FIRST_TOUCH} SELECT session_id, utm_source FROM ft",
    "last_touch_user": f"WITH {LOGS},{LAST_TOUCH} SELECT user_id, utm_source FROM lt",
    "enriched_logs": f"WITH {FUNNEL_PARTS},{_funnel(WINDOW)} SELECT * FROM en",
    "funnel_agg": f"WITH {FUNNEL_PARTS},{_funnel(WINDOW)} SELECT * FROM agg",
    "order_purchases": f"WITH {FUNNEL_PARTS},{_funnel(WINDOW)} SELECT * FROM bought",
    "funnel_daily": f"{FUNNEL} SELECT {SHOWN} FROM funnel",
    "funnel_daily_all_statuses": f"WITH {FUNNEL_PARTS},{_funnel(None, None)} SELECT {SHOWN} FROM funnel",
    "funnel_window_refresh": f"""WITH {FUNNEL_PARTS},{_funnel(None, None, '_old')},{_funnel(WINDOW, 'PAID', '_new')}
SELECT {SHOWN} FROM funnel_old WHERE base_date NOT {WINDOW} UNION ALL SELECT {SHOWN} FROM funnel_new""",
    "rfm_base": f"{RFM} SELECT * FROM base",
    "rfm_scores": f"{RFM} SELECT * FROM scored",
    "rfm_segments": f"{RFM} SELECT * FROM rfm",
    "rfm_segments_all_statuses": f"{_rfm(None)} SELECT * FROM rfm",
    "rfm_segment_sample": f"""{RFM},
placed AS (
  SELECT *, CAST(ROW_NUMBER() OVER (PARTITION BY segment_name ORDER BY monetary_amount DESC, user_id) AS INTEGER) AS place
  FROM rfm)
SELECT CAST(CASE segment_name WHEN 'VIP' THEN 1 WHEN '이탈위기' THEN 2 WHEN '신규' THEN 3 ELSE 4 END AS INTEGER)
    AS segment_no, place, user_id, last_purchase_date,
  'R' || r_score || ' · F' || f_score || ' · M' || m_score AS rfm, monetary_amount, segment_name,
  CASE segment_name WHEN 'VIP' THEN '얼리 액세스 · 리퍼럴 프로그램' WHEN '이탈위기' THEN 'Win-back 쿠폰 발송'
    WHEN '신규' THEN '온보딩 시리즈 (D+1~D+7)' ELSE '시즌 큐레이션 DM' END AS action
FROM placed WHERE place <= 2""",
    "rfm_segment_counts": f"{SEGMENT_COUNTS} SELECT segment_name, customer_count, pct FROM shares",
    "rfm_segment_kpis": f"""{SEGMENT_COUNTS}
SELECT CAST(COALESCE(SUM(customer_count) FILTER (segment_name = 'VIP'), 0) AS BIGINT) AS vip,
  CAST(COALESCE(SUM(customer_count) FILTER (segment_name = '이탈위기'), 0) AS BIGINT) AS at_risk,
  CAST(COALESCE(SUM(customer_count) FILTER (segment_name = '신규'), 0) AS BIGINT) AS "new",
  CAST(COALESCE(SUM(customer_count) FILTER (segment_name = '겨울잠'), 0) AS BIGINT) AS dormant,
  CAST(COALESCE(SUM(customer_count) FILTER (segment_name = '이탈위기'), 0) AS BIGINT) AS churn_count,
  COALESCE(SUM(pct) FILTER (segment_name = '이탈위기'), 0.0) AS churn_pct FROM shares""",
    "dash_filtered_funnel": f"""{FUNNEL} SELECT {SHOWN} FROM funnel
WHERE platform = 'NAVER' AND utm_source IN ('google', '(direct)') AND base_date {WINDOW}
ORDER BY base_date DESC, platform, utm_source""",
    "dash_filter_options": f"""{FUNNEL}
SELECT DISTINCT 'platform' AS field, platform AS value FROM funnel UNION ALL
SELECT DISTINCT 'utm_source', utm_source FROM funnel UNION ALL
SELECT 'min_date', CAST(MIN(base_date) AS VARCHAR) FROM funnel UNION ALL
SELECT 'max_date', CAST(MAX(base_date) AS VARCHAR) FROM funnel""",
    "dash_funnel_totals": f"{FUNNEL} SELECT {SUMS} FROM funnel",
    "dash_kpis": f"""{FUNNEL},
sums AS (SELECT {SUMS}, COUNT(DISTINCT base_date) AS n_dates, COUNT(*) AS n_rows FROM funnel)
SELECT total_visitors, purchase_completed_count AS total_purchases, {CVR}, n_dates, n_rows FROM sums""",
    "dash_stage_detail": f"{STAGE_DETAIL} SELECT *, 100.0::DOUBLE - pct_of_prev AS drop_rate FROM detail",
    "dash_biggest_drop": f"""{STAGE_DETAIL}
SELECT stage_no, stage, 100.0::DOUBLE - pct_of_prev AS drop_rate FROM detail
WHERE stage_no > 1 ORDER BY drop_rate DESC, stage_no LIMIT 1""",
    "dash_funnel_trend": f"""{FUNNEL}, daily AS (SELECT base_date, {SUMS} FROM funnel GROUP BY base_date)
SELECT *, {CVR} FROM daily ORDER BY base_date""",
    "dash_breakdown_platform": f"""{FUNNEL}, parts AS (SELECT platform, {SUMS} FROM funnel GROUP BY platform)
SELECT *, {CVR} FROM parts ORDER BY cvr DESC, platform""",
    "dash_breakdown_utm": f"""{FUNNEL}, parts AS (SELECT utm_source, {SUMS} FROM funnel GROUP BY utm_source)
SELECT *, {CVR} FROM parts ORDER BY cvr DESC, utm_source""",
    "zone_row_counts": f"{ZONES} SELECT table_name, row_count FROM zones",
    "zone_health": f"""{ZONES} SELECT COUNT(*) FILTER (row_count > 0 AND table_name IN
  ('raw_user_behavior_logs', 'stg_user_behavior_logs', 'mart_user_funnel_daily')) = 3 AS healthy FROM zones""",
    "data_freshness": f"""WITH {LOGS},{ORDERS}
SELECT MAX(latest) AS last_updated FROM (
  SELECT MAX(event_at) AS latest FROM logs UNION ALL SELECT MAX(CAST(paid_date AS TIMESTAMP)) FROM ords)""",
    "order_status_counts": f"WITH {VERSIONS} SELECT order_status, COUNT(*) AS n_orders FROM latest GROUP BY 1",
    "status_change_counts": f"""WITH {VERSIONS}
SELECT batch_date, COUNT(*) FILTER (order_status = 'CANCELLED') AS cancelled,
  COUNT(*) FILTER (order_status = 'REFUNDED') AS refunded
FROM std WHERE order_status IN ('CANCELLED', 'REFUNDED') GROUP BY 1""",
    "run_totals": f"""WITH {VERSIONS},{EVENTS},
packed AS (SELECT log_id, MIN(event_date) OVER (PARTITION BY event_id // 4) AS batch_date FROM ev),
runs AS (SELECT DISTINCT batch_date AS run_date FROM packed),
o AS (SELECT batch_date, COUNT(DISTINCT order_id) AS n FROM std GROUP BY 1),
l AS (SELECT batch_date, COUNT(DISTINCT log_id) AS n FROM packed GROUP BY 1)
SELECT run_date,
  CAST(COALESCE((SELECT SUM(n) FROM o WHERE o.batch_date BETWEEN run_date - 14 AND run_date), 0) AS BIGINT) AS submitted_orders,
  CAST(COALESCE((SELECT SUM(n) FROM l WHERE l.batch_date = run_date), 0) AS BIGINT) AS submitted_logs
FROM runs""",
    "dq_orders": f"""WITH {ORDERS},{ITEMS},
checked AS (SELECT *, payment_amount AS amount_before_fx, CAST(paid_date AS TIMESTAMP) AS paid_at FROM full_ords)
{_rules('checked', ORDER_RULES)}""",
    "dq_events": f"WITH {EVENTS}, checked AS (SELECT *, device AS device_type FROM ev) {_rules('checked', LOG_RULES)}",
    "dq_quarantine": f"""WITH {VERSIONS},{EVENTS},
spoilt_orders AS (
  SELECT raw_id, CAST(NULL AS VARCHAR) AS key, CASE platform
    WHEN 'NAVER' THEN 'order_id missing, product_id missing, payment_amount missing, amount_before_fx missing, paid_at missing'
    ELSE 'order_id missing, product_id missing, payment_amount missing, discount_amount missing, amount_before_fx missing, currency_code missing, paid_at missing' END AS violations
  FROM std WHERE CAST(order_id AS BIGINT) % 97 = 0),
spoilt_sessions AS (
  SELECT DISTINCT 's-' || CAST(event_id // 4 AS VARCHAR) AS raw_id FROM ev WHERE event_id // 4 % 97 = 0
  UNION ALL SELECT 'c-' || CAST(c_custkey AS VARCHAR) FROM customer WHERE c_custkey % 97 = 0)
SELECT * FROM spoilt_orders UNION ALL
SELECT raw_id, order_id, 'product_id missing' FROM std
WHERE product_id IS NULL AND CAST(order_id AS BIGINT) % 97 <> 0 UNION ALL
SELECT raw_id, NULL, 'log_id missing, session_id missing, event_name missing, event_at missing, event_date missing, payload unreadable'
FROM spoilt_sessions UNION ALL
SELECT 's-' || CAST(event_id // 4 AS VARCHAR), log_id, 'event_name unknown' FROM ev
WHERE event_name = 'error' AND event_id // 4 % 97 <> 0""",
    "dq_marts": f"""{FUNNEL}, {RFM.replace('WITH ', '', 1).replace(ORDERS + ',', '', 1)}
SELECT 'funnel' AS mart, * FROM ({_rules('funnel', FUNNEL_RULES)}) UNION ALL
SELECT 'rfm' AS mart, * FROM ({_rules('rfm', RFM_RULES)})""",
    "dq_duplicate_keys": f"WITH {VERSIONS} SELECT order_id, COUNT(*) AS copies FROM std GROUP BY 1 HAVING COUNT(*) > 1",
    "dq_orphan_raw": f"""WITH {VERSIONS}
SELECT raw_id, order_id, batch_date FROM latest WHERE raw_id NOT IN
  (SELECT raw_id FROM std WHERE batch_date >= DATE '2024-01-05')""",
    "dq_raw": f"""WITH {RAW}
SELECT raw_id, CASE WHEN ingest_seq % 97 = 0 THEN 'fax' ELSE source_api END AS source_api,
  CASE WHEN ingest_seq % 97 <> 0 THEN 'payload_json missing' WHEN ingest_seq % 89 <> 0 THEN 'source_api unknown'
    ELSE 'payload_json missing, source_api unknown' END AS violations
FROM raw WHERE ingest_seq % 97 = 0 OR ingest_seq % 89 = 0""",
    "dq_table_keys": f"""{FUNNEL}
SELECT 'orders' AS table_name, order_id AS key, 2 AS copies FROM ords WHERE CAST(order_id AS BIGINT) % 97 = 0
UNION ALL SELECT 'logs', log_id, 2 FROM logs WHERE CAST(log_id AS BIGINT) % 97 = 0
UNION ALL SELECT 'funnel', CAST(base_date AS VARCHAR) || '|' || platform || '|' || utm_source, 2 FROM funnel
WHERE total_visitors % 2 = 0
UNION ALL SELECT DISTINCT 'rfm', user_id, 2 FROM ords WHERE order_status = 'PAID' AND CAST(user_id AS BIGINT) % 97 = 0""",
    "raw_files": f"WITH {RAW} SELECT batch_date, source_api, payload_json FROM raw",
    "landing_stats": f"""WITH {VERSIONS},
sent AS (SELECT *, CAST(order_id AS BIGINT) AS k, batch_date < DATE '2024-01-16' AS early FROM versions)
SELECT CASE WHEN early THEN 'early' ELSE 'late' END AS fetch, COUNT(*) FILTER (k % 97 <> 0) AS n_rows,
  COUNT(*) FILTER (k % 97 = 0) AS rejected,
  COUNT(*) FILTER (sent_status = 'CANCELLED' AND k % 5 <> 0) AS cancelled,
  COUNT(*) FILTER (sent_status = 'CANCELLED' AND k % 5 = 0) AS refunded FROM sent GROUP BY early""",
    "warehouse_funnel": f"""WITH {VERSIONS}, staged AS (SELECT * FROM latest WHERE product_id IS NOT NULL),
{LOGS},{FIRST_TOUCH},{LAST_TOUCH},{_funnel().replace('ords', 'staged')} SELECT {SHOWN} FROM funnel""",
    "std_timestamps_odd": f"""WITH {EVENTS}
SELECT log_id, event_at AS basic, event_at + INTERVAL 1 HOUR AS basic_offset, event_at + INTERVAL 9 HOUR AS comma,
  event_at AS padded, date_trunc('minute', event_at) + INTERVAL 9 HOUR AS "minute",
  event_at + INTERVAL 12 HOUR AS hour_offset, CAST(event_date AS TIMESTAMP) AS date_only,
  CAST(NULL AS TIMESTAMP) AS spaced_junk, CAST(NULL AS TIMESTAMP) AS no_month FROM ev""",
    "std_orders_odd": f"WITH {ODD_ORDERS} SELECT {STD_COLUMNS} FROM odd",
    "dq_orders_odd": f"WITH {ODD_ORDERS} {_rules('odd', ORDER_RULES)}",
    "dq_marts_odd": f"""{FUNNEL}, {RFM.replace('WITH ', '', 1).replace(ORDERS + ',', '', 1)},
bad_funnel AS (
  SELECT * REPLACE (CASE WHEN day(base_date) % 5 <> 0 THEN final_conversion_rate + day(base_date) % 2 END AS final_conversion_rate,
    CASE day(base_date) % 7 WHEN 0 THEN 'EBAY' WHEN 1 THEN NULL ELSE platform END AS platform,
    CASE WHEN day(base_date) % 11 <> 0 THEN utm_source END AS utm_source,
    CASE WHEN day(base_date) % 3 = 0 THEN -product_views ELSE product_views END AS product_views,
    CASE WHEN day(base_date) % 4 = 0 THEN -total_visitors ELSE total_visitors END AS total_visitors) FROM funnel),
bad_rfm AS (
  SELECT * REPLACE (CASE WHEN u % 3 = 0 THEN r_score + 3 ELSE r_score END AS r_score,
    f_score - CASE WHEN u % 5 = 0 THEN 2 ELSE 0 END AS f_score,
    CASE u % 7 WHEN 0 THEN 'OTHER' WHEN 1 THEN NULL ELSE segment_name END AS segment_name,
    CASE WHEN u % 11 = 0 THEN -monetary_amount ELSE monetary_amount END AS monetary_amount,
    recency_days - CASE WHEN u % 2 = 0 THEN 20 ELSE 0 END AS recency_days)
  FROM (SELECT *, CAST(user_id AS BIGINT) AS u FROM rfm))
SELECT 'funnel' AS mart, * FROM ({_rules('bad_funnel', FUNNEL_RULES)}) UNION ALL
SELECT 'rfm' AS mart, * FROM ({_rules('bad_rfm', RFM_RULES)})""",
    "warehouse_state": f"""{HOUSE},
sizes AS (
  SELECT 'raw_ecommerce_orders' AS name, COUNT(*) AS n FROM versions UNION ALL
  SELECT 'raw_user_behavior_logs', (SELECT COUNT(DISTINCT event_id // 4) FROM ev) + (SELECT COUNT(*) FROM customer) UNION ALL
  SELECT 'stg_ecommerce_orders', COUNT(*) FROM staged UNION ALL
  SELECT 'stg_user_behavior_logs', COUNT(*) FROM logs UNION ALL
  SELECT 'mart_user_funnel_daily', COUNT(*) FROM funnel UNION ALL
  SELECT 'mart_user_rfm_scores', COUNT(DISTINCT user_id) FROM staged WHERE order_status = 'PAID'),
newest AS (SELECT MAX(event_at) AS latest FROM logs UNION ALL SELECT MAX(paid_at) FROM staged)
SELECT name, CAST(n AS VARCHAR) AS value FROM sizes UNION ALL
SELECT 'last_updated', strftime(MAX(latest), '%Y-%m-%d %H:%M:%S') FROM newest UNION ALL
SELECT 'healthy', CASE WHEN MIN(n) > 0 THEN 'true' ELSE 'false' END FROM sizes
WHERE name IN ('raw_user_behavior_logs', 'stg_user_behavior_logs', 'mart_user_funnel_daily')""",
    "warehouse_dashboard": f"""{HOUSE},
parts AS (
  SELECT 'platform' AS part, platform AS value, {SUMS} FROM funnel GROUP BY platform UNION ALL
  SELECT 'utm_source', utm_source, {SUMS} FROM funnel GROUP BY utm_source),
{SEGMENT_COUNTS.replace('WITH ' + ORDERS + ',', '', 1).replace('ords', 'staged').replace("DATE '2024-01-31'", "DATE '2024-02-03'")}
SELECT part, value, total_visitors AS people, cvr AS share FROM (SELECT *, {CVR} FROM parts) UNION ALL
SELECT 'segment', segment_name, customer_count, pct FROM shares""",
    "dq_volume": f"""WITH {LOGS}
SELECT COUNT(*) AS log_records, CAST(1000 AS BIGINT) AS floor, COUNT(*) >= 1000 AS enough FROM logs""",
}


def oracle_sql() -> dict[str, str]:
    return dict(QUERIES)

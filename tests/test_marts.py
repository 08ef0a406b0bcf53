"""Funnel and RFM on the sample rows, and the points where they are easy to get wrong."""

from datetime import date
from decimal import Decimal
from itertools import product

import pytest
from pyspark.sql import functions as F

from conftest import rows
from samples import logs_frame, orders_frame
from tillmart.operators import attribution, funnel, rfm
from tillmart.operators.lookup import NULL_KEYS

D = Decimal


def test_sample_funnel(spark):
    got = rows(funnel.funnel_daily(orders_frame(spark), logs_frame(spark)))
    assert got == [
        (date(2025, 3, 2), "NAVER", "google", 1, 1, 0, 0, 1, D("1.0000")),
        # LEE's order counts under the last campaign, which has no events on that day.
        (date(2025, 3, 3), "AMAZON", "kakao", 1, 1, 1, 1, 0, D("0.0000")),
        (date(2025, 3, 4), "AMAZON", "instagram", 1, 1, 0, 0, 0, D("0.0000")),
        (date(2025, 3, 4), "AMAZON", "naver", 1, 1, 1, 0, 1, D("1.0000")),
        (date(2025, 3, 4), "NAVER", "(direct)", 1, 1, 0, 0, 0, D("0.0000")),
    ]


def test_sample_rfm(spark):
    got = rows(rfm.rfm_segments(orders_frame(spark), date(2025, 3, 10)))
    assert got == [
        ("CHOI", date(2025, 3, 4), 6, 2, D("80000.00"), 5, 3, 3, "VIP"),
        ("KIM", date(2025, 3, 4), 6, 3, D("90000.00"), 4, 4, 4, "VIP"),
        ("LEE", date(2025, 3, 3), 7, 1, D("76000.00"), 3, 1, 2, "겨울잠"),
        ("PARK", date(2025, 1, 15), 54, 1, D("15000.00"), 2, 2, 1, "겨울잠"),
    ]


def test_window_ends_are_included(spark):
    window = (date(2025, 3, 2), date(2025, 3, 3))
    got = rows(funnel.funnel_daily(orders_frame(spark), logs_frame(spark), window), "base_date")
    assert got == [(date(2025, 3, 2),), (date(2025, 3, 3),)]


def test_first_touch_before_the_window_still_counts(spark):
    logs = logs_frame(
        spark,
        [
            ("1", "S", "U", "view_item", "google", "x", "app", "2026-08-01 10:00:00"),
            ("2", "S", "U", "purchase", "naver", "x", "app", "2026-08-05 10:00:00"),
        ],
    )
    day = (date(2026, 8, 5), date(2026, 8, 5))
    assert rows(funnel.funnel_counts(logs, orders_frame(spark), day), "utm_source") == [("google",)]


def test_ties(spark):
    orders = orders_frame(
        spark,
        [
            ("1", "U", "P", "1", "0", "1", "KRW", "NAVER", "2026-08-01 10:00:00"),
            ("2", "U", "P", "1", "0", "1", "USD", "AMAZON", "2026-08-01 10:00:00"),
            ("3", "V", "P", "1", "0", "1", "USD", "AMAZON", "2026-08-01 10:00:00"),
            ("4", "V", "P", "1", "0", "1", "KRW", "NAVER", "2026-08-02 10:00:00"),
        ],
    )
    assert rows(attribution.main_platform(orders)) == [("U", "AMAZON"), ("V", "NAVER")]
    logs = logs_frame(
        spark,
        [
            ("b", "S", "U", "view_item", "second", "x", "app", "2026-08-01 10:00:00"),
            ("a", "S", "U", "view_item", "first", "x", "app", "2026-08-01 10:00:00"),
        ],
    )
    assert rows(attribution.first_touch(logs)) == [("S", "first")]
    assert rows(attribution.last_touch(logs)) == [("U", "second")]


def test_session_with_guest_and_user_counts_on_both_platforms(spark):
    logs = logs_frame(
        spark,
        [
            ("1", "S", None, "view_item", "google", "x", "app", "2026-08-18 09:00:00"),
            ("2", "S", "LEE", "purchase", "google", "x", "app", "2026-08-18 09:10:00"),
        ],
    )
    got = rows(funnel.funnel_counts(logs, orders_frame(spark)), "platform", "total_visitors")
    assert got == [("AMAZON", 1), ("NAVER", 1)]


def test_one_visitor_per_session_even_with_two_users_on_a_platform(spark):
    logs = logs_frame(
        spark,
        [
            ("1", "S", "KIM", "view_item", "google", "x", "app", "2026-08-18 09:00:00"),
            ("2", "S", "PARK", "view_item", "google", "x", "app", "2026-08-18 09:10:00"),
            ("3", "S", None, "view_item", "google", "x", "app", "2026-08-18 09:11:00"),
        ],
    )
    got = rows(funnel.funnel_counts(logs, orders_frame(spark)), "total_visitors", "product_views")
    assert got == [(1, 3)]


def test_a_guest_never_matches_a_user_with_a_made_up_name(spark):
    logs = logs_frame(spark, [("1", "S", None, "view_item", None, None, "app", "2026-08-18 09:00:00")])
    names = [
        (str(n), f"{letter}{n}", "P", "1", "0", "1", "USD", "AMAZON", "2026-08-01 10:00:00")
        for n in range(NULL_KEYS)
        for letter in ("n", "k", "")
    ]
    placed = attribution.add_platform(logs, attribution.main_platform(orders_frame(spark, names)))
    assert rows(placed, "platform") == [("NAVER",)]


def test_only_paid_orders_count_unless_the_filter_is_off(spark):
    orders = orders_frame(spark, status="SHIPPED")
    assert rows(funnel.confirmed_purchases(orders, logs_frame(spark))) == []
    got = rows(funnel.confirmed_purchases(orders, logs_frame(spark), status=None), "purchase_from_orders")
    assert sum(n for (n,) in got) == 7


def test_rate_is_capped_and_orders_without_events_vanish(spark):
    logs = logs_frame(spark, [("1", "S", "U001", "view_item", "naver", "x", "app", "2026-08-18 09:00:00")])
    many = [
        (str(n), "U001", "P", "1", "0", "1", "KRW", "NAVER", f"2026-08-{17 + n % 2} 10:00:00")
        for n in range(6)
    ]
    got = rows(
        funnel.funnel_daily(orders_frame(spark, many), logs),
        "base_date", "purchase_completed_count", "final_conversion_rate",
    )
    assert got == [(date(2026, 8, 18), 3, D("1.0000"))]


SCORES = range(1, 6)


def _segment(r, f, m, n):
    if r >= 4 and f >= 4 and m >= 4:
        return "VIP"
    if r <= 2 and (f >= 3 or m >= 3):
        return "이탈위기"
    if n == 1 and r >= 4:
        return "신규"
    if r <= 2 and f <= 2 and m <= 2:
        return "겨울잠"
    return "VIP" if r >= 3 and f >= 3 else "겨울잠"


def test_segments_for_every_score(spark):
    cases = [(r, f, m, n) for r, f, m in product(SCORES, repeat=3) for n in (1, 2)]
    frame = spark.createDataFrame(cases, "r int, f int, m int, n bigint")
    got = frame.select("r", "f", "m", "n", rfm.segment(F.col("r"), F.col("f"), F.col("m"), F.col("n")))
    assert rows(got) == sorted(((*c, _segment(*c)) for c in cases), key=repr)


@pytest.mark.parametrize("users", [1, 3, 4])
def test_few_users_score_from_the_top_of_recency(spark, users):
    some = [
        (str(n), f"U{n}", "P", "1", "0", "1", "KRW", "NAVER", f"2026-08-0{n + 1} 10:00:00")
        for n in range(users)
    ]
    scored = rfm.rfm_scores(rfm.rfm_base(orders_frame(spark, some), date(2026, 8, 20)))
    assert [r for (r,) in rows(scored, "r_score")] == list(range(6 - users, 6))

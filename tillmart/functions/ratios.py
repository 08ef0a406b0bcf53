"""Rates and percentages with their zero rules."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def percent(part: Column, whole: Column) -> Column:
    """``part / whole * 100`` as a double; 0 when there is no whole."""
    return F.when(whole > 0, part / whole * 100).otherwise(0.0)


def conversion_rate(purchases: Column, visitors: Column) -> Column:
    """Purchases per visitor, at most 1, four digits; null without visitors."""
    ratio = purchases.cast("decimal(20,0)") / F.nullif(visitors, F.lit(0)).cast("decimal(20,0)")
    return F.when(visitors != 0, F.round(F.least(ratio, F.lit(1)), 4)).cast("decimal(8,4)")


def score_label(r: Column, f: Column, m: Column) -> Column:
    return F.format_string("R%d · F%d · M%d", r, f, m)

"""Amounts and exchange rates, in exact decimals with half-up rounding."""

from __future__ import annotations

from collections.abc import Mapping
from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

from tillmart.schemas import MONEY

# Won per unit of currency before the daily movement.
BASE_RATES = {"KRW": Decimal("1.0"), "USD": Decimal("1350.0"), "JPY": Decimal("9.2")}
HOME_CURRENCY = "KRW"

# Source amounts keep six decimals until the one rounding at the end.
SOURCE_AMOUNT = "decimal(22,6)"
RATE = "decimal(10,4)"

# Day 1 of the proleptic Gregorian calendar is 719163 days before 1970-01-01.
_ORDINAL_OF_EPOCH = 719163


def fx_rate(
    currency: Column, rate_date: Column, base_rates: Mapping[str, Decimal] = BASE_RATES
) -> Column:
    """Won per unit on ``rate_date``; null for a currency without a rate.

    The base rate moves in steps of 0.2 % over a seven-day cycle, three steps each way.
    The rate table is a literal in the plan (one entry per currency), so no join is needed.
    """
    table = F.create_map(
        *[F.lit(v) for code, rate in base_rates.items() for v in (code, rate.quantize(Decimal("0.0001")))]
    )
    step = F.pmod(F.unix_date(rate_date) + _ORDINAL_OF_EPOCH, F.lit(7)) - 3
    permille = (F.lit(1000) + step * 2).cast("decimal(5,0)")
    moved = table[F.upper(currency)].cast(RATE) * permille * F.lit(Decimal("0.001"))
    return F.round(moved, 4).cast(RATE)


def is_home(currency: Column) -> Column:
    return F.upper(currency) == HOME_CURRENCY


def money(amount: Column) -> Column:
    """Round to the stored scale; null when the value does not fit."""
    return F.round(amount, 2).try_cast(MONEY)


def in_won(amount: Column, currency: Column, rate: Column) -> Column:
    """Won value of ``amount``; won amounts are taken as they are."""
    return money(F.when(is_home(currency), amount).otherwise(amount * rate))


def number(value: Column) -> Column:
    """A JSON number or numeric string as a decimal; null when it is neither."""
    return F.try_variant_get(value, "$", SOURCE_AMOUNT)


def is_json_null(value: Column) -> Column:
    return F.coalesce(F.is_variant_null(value), F.lit(False))


def json_text(value: Column) -> Column:
    return F.try_variant_get(value, "$", "string")

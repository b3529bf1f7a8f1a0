"""Amounts and exact two-decimal ratios.

Ratios are rounded half-up (away from zero for refunds) in whole numbers: dividing decimals first
and rounding afterwards would round twice.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

from perennia.schema import AMOUNT, CURRENCY_SUFFIX, MONEY

_WIDE = "decimal(38,0)"
_RATIO = "decimal(14,2)"


def parse_amount(text: Column) -> Column:
    """`"12.34 USD"` to DECIMAL; NULL when no number is left after dropping the currency.

    `nan`, `inf` and digit groups such as `1_000` are no amounts here.
    """
    return F.replace(text, F.lit(CURRENCY_SUFFIX), F.lit("")).try_cast(AMOUNT)


#: Whether `total_amount` is a finite number, be it too large for an amount.
NUMBER_TEST = f"abs(try_cast(replace(total_amount, '{CURRENCY_SUFFIX}', '') AS DOUBLE)) < double('infinity')"


def _half_up(numerator: Column, denominator: Column) -> Column:
    """numerator / denominator rounded half-up to a whole number, for a denominator above 0."""
    n, d = F.abs(numerator).cast(_WIDE), denominator.cast(_WIDE)
    # Narrow literals keep the products inside 38 digits.
    doubled = (n + n + d).cast(_WIDE)
    return F.signum(numerator).cast("int") * F.call_function("div", doubled, (d + d).cast(_WIDE))


def per_unit(amount: Column, count: Column) -> Column:
    """amount / count in cents precision; 0 where count is 0 or missing."""
    units = (amount * F.lit(1_000_000)).cast(_WIDE)
    cents = _half_up(units, (count * F.lit(10_000)).cast(_WIDE))
    return F.when(count > 0, (cents * F.lit(Decimal("0.01"))).cast(MONEY)).otherwise(F.lit(0).cast(MONEY))


def count_ratio(numerator: Column, denominator: Column) -> Column:
    """Ratio of two counts with two decimals; 0 where the denominator is 0 or missing."""
    hundredths = _half_up(numerator * F.lit(100), denominator)
    return F.when(denominator > 0, (hundredths * F.lit(Decimal("0.01"))).cast(_RATIO)).otherwise(
        F.lit(0).cast(_RATIO)
    )


def lifetime_value(
    revenue_per_visit: Column, visits_per_week: Column, weeks_per_year: int = 52, lifespan_years: int | float = 10
) -> Column:
    """weeks x (revenue per visit x visits per week) x lifespan on the rounded factors, two decimals."""
    factor = F.lit(Decimal(str(weeks_per_year)) * Decimal(str(lifespan_years)))
    return F.round(factor * (revenue_per_visit * visits_per_week), 2).cast(MONEY)

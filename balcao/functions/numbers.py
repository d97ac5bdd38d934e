"""Numeric column helpers: rounding, guarded ratios, pt-BR text."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def rounded(value: Column, digits: int) -> Column:
    """Round a double half away from zero on the scaled value.

    `round(x, n)` of Spark works on the shortest decimal text of the double: it
    differs on ties from rounding `x * 10^n`, which the tables are defined by,
    and goes through BigDecimal for every row.
    """
    scaled = value.cast("double") * F.lit(float(10**digits))
    nearest = F.rint(scaled)
    tie = F.abs(scaled - nearest) == 0.5
    return F.when(tie, scaled + F.signum(scaled) * 0.5).otherwise(nearest) / F.lit(float(10**digits))


def cents(money: Column) -> Column:
    """Money as a whole number of cents, exact for doubles with two decimals."""
    return F.floor(money * 100 + F.lit(0.5)).cast("bigint")


def ratio(numerator: Column, denominator: Column) -> Column:
    """Quotient of doubles, NULL for a zero denominator."""
    return numerator.cast("double") / F.nullif(denominator.cast("double"), F.lit(0.0))


def weighted_discount(net: Column, gross: Column) -> Column:
    """Share of the gross value given away: 0 when nothing was sold."""
    share = rounded(1 - ratio(net, gross), 4)
    return F.when(gross == 0, F.lit(0.0)).otherwise(share)


def ptbr_number(value: Column, digits: int) -> Column:
    """Text with dot for thousands and comma for decimals."""
    text = F.format_number(rounded(value, digits), digits)
    return F.translate(text, ",.", ".,")


def ptbr_percent(value: Column, digits: int = 1) -> Column:
    return F.concat(ptbr_number(value.cast("double") * 100, digits), F.lit("%"))

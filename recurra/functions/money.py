"""Money and ratio expressions. Money stays DECIMAL until a ratio is taken."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def as_money(value: Column, precision: int = 12) -> Column:
    return value.cast(f"decimal({precision},2)")


def rounded(value: Column, digits: int = 2) -> Column:
    """Round a double half-up by arithmetic, the same on every engine."""
    scale = float(10 ** digits)
    return F.floor(value.cast("double") * F.lit(scale) + F.lit(0.5)) / F.lit(scale)


def ratio(part: Column, whole: Column, digits: int = 2) -> Column:
    """``part / whole`` rounded; NULL when the whole is zero."""
    return rounded(_quotient(part, whole), digits)


def percent(part: Column, whole: Column, digits: int = 2) -> Column:
    return rounded(_quotient(part, whole) * F.lit(100.0), digits)


def _quotient(part: Column, whole: Column) -> Column:
    return part.cast("double") / F.nullif(whole.cast("double"), F.lit(0.0))


def dollars_text(value: Column) -> Column:
    """``$1,234.50``; NULL reads ``$0.00``."""
    return F.concat(F.lit("$"), F.format_number(F.coalesce(value, F.lit(0)), 2))


def percent_text(value: Column) -> Column:
    """``12.3%``; NULL reads ``0.0%``."""
    filled = F.coalesce(value.cast("double"), F.lit(0.0))
    return F.concat(F.format_number(filled, 1), F.lit("%"))


def count_text(value: Column) -> Column:
    return F.format_number(value, 0)

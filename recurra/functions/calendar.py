"""Calendar keys and labels."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def date_sk(ts: Column) -> Column:
    """``YYYYMMDD`` as an integer."""
    return (F.year(ts) * 10000 + F.month(ts) * 100 + F.day(ts)).cast("int")


def month_index(ts: Column) -> Column:
    """Months since year 0 of the snapshot month an instant belongs to.

    A snapshot month ends at 23:59:59 of its last day, so the part of a second after
    that belongs to the next month.
    """
    edge = ts + F.expr("interval 999999 microseconds")
    return (F.year(edge) * 12 + F.month(edge) - 1).cast("int")


def index_of(year: int, month: int) -> int:
    return year * 12 + month - 1


def month_sk(index: Column) -> Column:
    """``YYYYMM`` from a month index."""
    year, month = _split(index)
    return (year * 100 + month).cast("int")


def month_end(index: Column) -> Column:
    """Last calendar day of a month index."""
    year, month = _split(index)
    return F.last_day(F.make_date(year, month, F.lit(1)))


def months_of_sk(sk: Column) -> Column:
    """Month index from ``YYYYMM`` (whole-number division, never ``/``)."""
    return (F.floor(sk / 100) * 12 + sk % 100 - 1).cast("int")


def _split(index: Column) -> tuple[Column, Column]:
    return F.floor(index / 12).cast("int"), (index % 12 + 1).cast("int")

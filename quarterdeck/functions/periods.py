"""Fiscal quarters as one integer, ``q_ord = year * 4 + quarter - 1``.

Ordering, equality and "n quarters later" are then plain integer arithmetic, which Parquet
statistics, range frames and equi-joins all understand.
"""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F


def fiscal_ordinal(day: Column, shift_days: int = 7) -> Column:
    """Fiscal quarter of a date: Feb-Apr is Q1, ..., Nov-Jan is Q4 of the year it starts in.

    A date after the 24th counts as belonging to the coming month (period ends drift by some
    days); ``shift_days=0`` turns that off.
    """
    day = day.cast("date")
    if shift_days:
        day = F.when(F.dayofmonth(day) > 24, F.date_add(day, shift_days)).otherwise(day)
    # Months counted from February, three to a quarter.
    return F.floor((F.year(day) * 12 + F.month(day) - 2) / 3).cast("int")


def ordinal(year: Column | int, quarter: Column | int) -> Column | int:
    return year * 4 + quarter - 1


def fiscal_year(q_ord: Column) -> Column:
    return F.floor(q_ord / 4).cast("int")


def fiscal_quarter(q_ord: Column) -> Column:
    return F.pmod(q_ord, F.lit(4)) + 1


def label(q_ord: Column) -> Column:
    """``1Q2020``."""
    return F.concat(fiscal_quarter(q_ord).cast("string"), F.lit("Q"),
                    fiscal_year(q_ord).cast("string"))


def parse_label(text: Column) -> Column:
    """Ordinal of ``1Q2020``; null for any other shape."""
    pattern = r"^([1-4])Q(\d{4})$"
    year = F.regexp_extract(text, pattern, 2).try_cast("int")
    quarter = F.regexp_extract(text, pattern, 1).try_cast("int")
    return year * 4 + quarter - 1


def quarter_date(q_ord: Column, day: int = 1) -> Column:
    """A date standing for the quarter: the given day of its third calendar month number."""
    return F.make_date(fiscal_year(q_ord), fiscal_quarter(q_ord) * 3, F.lit(day))


def parse_label_value(text: str) -> int:
    """Driver-side twin of :func:`parse_label` for parameters."""
    quarter, year = text.upper().split("Q")
    return ordinal(int(year), int(quarter))


def fiscal_ordinal_value(day: date, shift_days: int = 7) -> int:
    """Driver-side twin of :func:`fiscal_ordinal` for parameters."""
    if day.day > 24:
        day += timedelta(days=shift_days)
    return (day.year * 12 + day.month - 2) // 3

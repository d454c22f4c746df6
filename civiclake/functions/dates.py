"""Date and time parts (P12-P15) with explicit ISO-week semantics."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from civiclake.functions.clean import col_


def year_month(c: str | Column) -> tuple[Column, Column]:
    c = col_(c)
    return F.year(c), F.month(c)


def month_label(c: str | Column) -> Column:
    """``yyyy-MM`` label."""
    return F.date_format(col_(c), "yyyy-MM")


def iso_week(c: str | Column, legacy_year: bool = False) -> tuple[Column, Column]:
    """(year, week) of a date.

    ISO by default: 2024-12-30 is week 1 of 2025.  ``legacy_year=True``
    pairs the calendar year with the ISO week number, as the reference
    did (2024-12-30 -> (2024, 1)).
    """
    c = col_(c)
    week = F.weekofyear(c)
    year = F.year(c) if legacy_year else F.extract(F.lit("YEAROFWEEK"), c)
    return year, week


def week_start(c: str | Column) -> Column:
    """Monday of the ISO week containing ``c``."""
    return F.date_trunc("week", col_(c)).cast("date")


def duration_hours(start: str | Column, end: str | Column) -> Column:
    """(end - start) in hours on parsed timestamps (P15); NULL if either is NULL."""
    return F.timestamp_diff("SECOND", col_(start), col_(end)) / F.lit(3600.0)

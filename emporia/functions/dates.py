"""Calendar expressions whose numbering or naming differs from Spark's defaults."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from emporia.functions import labels


def month_key(day: Column) -> Column:
    return F.date_format(day, "yyyy-MM")


def sunday_week(day: Column) -> Column:
    """Week 0-53 of the calendar year, weeks start on Sunday (``weekofyear`` is ISO)."""
    return F.floor((F.dayofyear(day) + 7 - F.dayofweek(day)) / 7).cast("int")


def iso_year(day: Column) -> Column:
    return F.extract(F.lit("YEAROFWEEK"), day)


def iso_week_label(day: Column) -> Column:
    """ISO year and week such as ``2025-S01``."""
    return F.concat(iso_year(day).cast("string"), F.lit("-S"), iso_week_text(day))


def iso_week_text(day: Column) -> Column:
    return F.lpad(F.weekofyear(day).cast("string"), 2, "0")


def monday_weekday(day: Column) -> Column:
    """1 = Monday … 7 = Sunday."""
    return F.weekday(day) + 1


def day_name(day: Column, names: tuple[str, ...] = labels.DAYS_EN) -> Column:
    """Day name from a fixed list, independent of the session locale."""
    return F.element_at(F.array(*[F.lit(name) for name in names]), monday_weekday(day))

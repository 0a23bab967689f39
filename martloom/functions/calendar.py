"""Calendar and fiscal-calendar expressions over a DATE column."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from martloom.rules import DEFAULT_RULES, Rules


def month_start(day: Column) -> Column:
    return F.trunc(day, "month")


def month_name(day: Column) -> Column:
    return F.date_format(day, "MMMM")


def year_month(day: Column) -> Column:
    """``yyyy-MM``: the partition value of the stored fact table."""
    return F.date_format(day, "yyyy-MM")


def is_weekend(day: Column) -> Column:
    return (F.weekday(day) >= 5).cast("int")


def fiscal_start_year(day: Column, start_month: int = DEFAULT_RULES.fiscal_start_month) -> Column:
    """Calendar year in which the fiscal year of ``day`` begins."""
    return F.year(F.add_months(day, 1 - start_month))


def fiscal_label(start_year: Column) -> Column:
    """``2024`` becomes ``FY2024-25``."""
    closing = F.lpad(F.pmod(start_year + 1, F.lit(100)).cast("string"), 2, "0")
    return F.concat(F.lit("FY"), start_year.cast("string"), F.lit("-"), closing)


def fiscal_year(day: Column, start_month: int = DEFAULT_RULES.fiscal_start_month) -> Column:
    return fiscal_label(fiscal_start_year(day, start_month))


def fiscal_month(day: Column, start_month: int = DEFAULT_RULES.fiscal_start_month) -> Column:
    """1 is the first month of the fiscal year; ``pmod`` keeps early months positive."""
    return F.pmod(F.month(day) - start_month, F.lit(12)) + 1


def season(day: Column, seasons: Mapping[int, str] = DEFAULT_RULES.seasons) -> Column:
    lookup = F.create_map(*[F.lit(v) for pair in sorted(seasons.items()) for v in pair])
    return F.element_at(lookup, F.month(day))


def fiscal_bounds(label: str, rules: Rules = DEFAULT_RULES) -> tuple[dt.date, dt.date]:
    """First day of the labelled fiscal year and first day of the next one."""
    year = int(label[2:6])
    return (
        dt.date(year, rules.fiscal_start_month, 1),
        dt.date(year + 1, rules.fiscal_start_month, 1),
    )


def next_fiscal_label(label: str) -> str:
    year = int(label[2:6]) + 1
    return f"FY{year}-{(year + 1) % 100:02d}"

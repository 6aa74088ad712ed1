"""Calendar columns: quarters, crop years, season days, month arithmetic."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def month_start(col: str | Column) -> Column:
    return F.trunc(F.to_date(col), "month")


def yyyymm(col: str | Column) -> Column:
    return (F.year(col) * 100 + F.month(col)).cast("int")


def quarter_flags(month: Column, strict_reference: bool = False) -> dict[str, Column]:
    """0/1 quarter columns; ``strict_reference`` leaves April outside every quarter."""
    second_from = 5 if strict_reference else 4
    return {
        "quarter1": month.between(1, 3).cast("int"),
        "quarter2": month.between(second_from, 6).cast("int"),
        "quarter3": month.between(7, 9).cast("int"),
        "quarter4": (month >= 10).cast("int"),
    }


def month_flags(month: Column) -> dict[str, Column]:
    return {f"month{m}": (month == m).cast("int") for m in range(1, 13)}


def crop_year_number(day: str | Column, first_year: int | Column, n_years: int | Column) -> Column:
    """Number 1..n of the May-April crop year, the ends taking everything beyond them."""
    number = F.year(day) - F.lit(first_year) + (F.month(day) >= 5).cast("int")
    return F.least(F.lit(n_years), F.greatest(F.lit(1), number)).cast("int")


def rain_season_flag(day: str | Column) -> Column:
    return ((F.month(day) > 9) | (F.month(day) < 5)).cast("int")


def season_day(day: str | Column, legacy: bool = False) -> Column:
    """Days since 1 October counted from 1, October to February; null in other months.

    ``legacy`` keeps the published February offset of 120 instead of 123.
    """
    month, dom = F.month(day), F.dayofmonth(day)
    feb = 120 if legacy else 123
    return (
        F.when(month == 10, dom)
        .when(month == 11, dom + 31)
        .when(month == 12, dom + 61)
        .when(month == 1, dom + 92)
        .when(month == 2, dom + feb)
        .cast("int")
    )


def excel_date(serial: str | Column) -> Column:
    """Date of a spreadsheet serial number."""
    serial = F.col(serial) if isinstance(serial, str) else serial
    return F.date_add(F.lit("1899-12-30").cast("date"), serial.cast("int"))


def month_from_abbrev(name: Column) -> Column:
    """Month number of an English month name or abbreviation."""
    position = F.instr(F.lit("janfebmaraprmayjunjulaugsepoctnovdec"), F.lower(F.substring(name, 1, 3)))
    return F.when(position > 0, ((position - 1) / 3 + 1).cast("int"))

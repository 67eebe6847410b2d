"""Calendar arithmetic on a month index ``year * 12 + month``.

Three representations of a month occur: the index (all arithmetic), the integer
``yyyymm`` and a month-start date. In the index December is the value whose
remainder by 12 is zero.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, functions as F

# Public dates of the Lunar New Year, one per Gregorian year.
LUNAR_NEW_YEAR = {
    1990: "01-27", 1991: "02-15", 1992: "02-04",
    1993: "01-23", 1994: "02-10", 1995: "01-31", 1996: "02-19", 1997: "02-07",
    1998: "01-28", 1999: "02-16", 2000: "02-05", 2001: "01-24", 2002: "02-12",
    2003: "02-01", 2004: "01-22", 2005: "02-09", 2006: "01-29", 2007: "02-18",
    2008: "02-07", 2009: "01-26", 2010: "02-14", 2011: "02-03", 2012: "01-23",
    2013: "02-10", 2014: "01-31", 2015: "02-19", 2016: "02-08", 2017: "01-28",
    2018: "02-16", 2019: "02-05", 2020: "01-25", 2021: "02-12", 2022: "02-01",
    2023: "01-22", 2024: "02-10", 2025: "01-29", 2026: "02-17", 2027: "02-06",
    2028: "01-26", 2029: "02-13", 2030: "02-03", 2031: "01-23", 2032: "02-11",
    2033: "01-31", 2034: "02-19", 2035: "02-08", 2036: "01-28", 2037: "02-15",
    2038: "02-04", 2039: "01-24", 2040: "02-12", 2041: "02-01", 2042: "01-22",
    2043: "02-10", 2044: "01-30", 2045: "02-17", 2046: "02-06", 2047: "01-26",
    2048: "02-14", 2049: "02-02", 2050: "01-23",
}
# Day zero of the two spreadsheet serial-date conventions in use.
SERIAL_BASE_1900 = "1900-01-01"
SERIAL_BASE_1899 = "1899-12-30"
# Month spellings accepted in headers.
MONTH_FORMATS = ("yyyy-MM-dd", "MMMM yyyy", "MMM yyyy", "MMM-yy", "yyyyMM", "M/d/yyyy")


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def month_idx(date: Column | str) -> Column:
    date = _c(date)
    return (F.year(date) * 12 + F.month(date)).cast("int")


def ym_to_idx(ym: Column | str) -> Column:
    ym = _c(ym).cast("int")
    return (F.floor(ym / 100) * 12 + ym % 100).cast("int")


def idx_to_ym(idx: Column | str) -> Column:
    idx = _c(idx)
    return (F.floor((idx - 1) / 12) * 100 + (idx - 1) % 12 + 1).cast("int")


def idx_to_date(idx: Column | str) -> Column:
    idx = _c(idx)
    return F.make_date(F.floor((idx - 1) / 12).cast("int"), ((idx - 1) % 12 + 1).cast("int"), F.lit(1))


def idx_year(idx: Column | str) -> Column:
    return F.floor((_c(idx) - 1) / 12).cast("int")


def idx_month(idx: Column | str) -> Column:
    return ((_c(idx) - 1) % 12 + 1).cast("int")


def year_start_idx(idx: Column | str) -> Column:
    """Index of January of the same year."""
    idx = _c(idx)
    return (idx - (idx - 1) % 12).cast("int")


def month_start(date: Column | str) -> Column:
    return F.trunc(_c(date), "month")


def shift_ym(ym: Column | str, months: Column | int) -> Column:
    """``yyyymm`` moved by a number of months; a year always has twelve."""
    return idx_to_ym(ym_to_idx(ym) + months)


def horizon(dwp: Column | str, dtp: Column | str) -> Column:
    """Months from the origin ``yyyymm`` to the target ``yyyymm``."""
    return (ym_to_idx(dtp) - ym_to_idx(dwp)).cast("int")


def ym_range(start_ym: Column | str, end_ym: Column | str) -> Column:
    """Array of every ``yyyymm`` from start to end, both included."""
    return F.transform(F.sequence(ym_to_idx(start_ym), ym_to_idx(end_ym)), idx_to_ym)


def serial_to_date(serial: Column | str, base: str = SERIAL_BASE_1900) -> Column:
    return F.date_add(F.lit(base).cast("date"), _c(serial).cast("int"))


def parse_month(text: Column | str) -> Column:
    """Month-start date from any accepted spelling, null when none fits."""
    text = F.trim(_c(text))
    tries = [F.try_to_timestamp(text, F.lit(fmt)).cast("date") for fmt in MONTH_FORMATS]
    return F.trunc(F.coalesce(*tries), "month")


def make_month(year: Column | str, month: Column | str) -> Column:
    return F.make_date(_c(year).cast("int"), _c(month).cast("int"), F.lit(1))


def cycle_lag(day: Column | str) -> Column:
    """A cycle run after the 25th already counts the running month as closed."""
    return F.when(F.dayofmonth(_c(day)) > 25, 1).otherwise(0)


def in_cycle_window(date: Column | str, cycle: Column | str, first: int, last: int) -> Column:
    """Date lies in months ``first`` to ``last`` counted from the cycle month."""
    base = F.trunc(_c(cycle), "month")
    return F.trunc(_c(date), "month").between(F.add_months(base, first), F.add_months(base, last))


def lunar_month(year: Column | str, dates: Mapping[int, str] = LUNAR_NEW_YEAR) -> Column:
    """Month in which the Lunar New Year effect falls: one later when the day is past the 24th.

    ``dates`` holds the day of each year as ``MM-dd``. The job fails for a year that is not held; a null year gives null.
    """
    entries = []
    for y, month_day in dates.items():
        month, day = (int(part) for part in month_day.split("-"))
        entries += [F.lit(y), F.lit(month + (1 if day > 24 else 0))]
    year = _c(year).cast("int")
    missing = F.raise_error(F.concat(F.lit("no date of the Lunar New Year for "), year.cast("string"))).cast("int")
    return F.when(year.isNotNull(), F.coalesce(F.try_element_at(F.create_map(*entries), year), missing))


def season_terms(ym: Column | str) -> tuple[Column, Column, Column]:
    part = (_c(ym) % 100) / F.lit(12.0)
    return part, F.sin(F.pi() * part), F.cos(F.pi() * part)


def iso_week_mondays(month: Column | str) -> Column:
    """Mondays of the ISO weeks that belong to a month.

    A week belongs to the month of its Monday; week 1 always belongs to January.
    """
    start = F.trunc(_c(month), "month")
    days = F.sequence(F.date_sub(start, 7), F.last_day(start))

    def owner(monday: Column) -> Column:
        return F.when(
            (F.weekofyear(monday) == 1) & (F.month(monday) == 12), F.add_months(F.trunc(monday, "month"), 1)
        ).otherwise(F.trunc(monday, "month"))

    return F.filter(days, lambda day: (F.weekday(day) == 0) & (owner(day) == start))

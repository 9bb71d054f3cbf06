"""Partial ISO dates: strings of year, year-month or year-month-day."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Days of months; February has 28 in a completed date and 29 in a plausible one.
DAYS = (31, 28, 31, 30, 31, 30, 31, 31, 30, 31, 30, 31)
LONGEST = (31, 29, 31, 30, 31, 30, 31, 31, 30, 31, 30, 31)
ISO = r"^([0-9]{3,4})-([0-9]{1,2})-([0-9]{1,2})$"


def part(date: Column, n: int) -> Column:
    return F.regexp_extract(date, ISO, n).try_cast("int")


def ordinal(date: Column) -> Column:
    """Order of full dates, with months of 31 days; null for others."""
    return part(date, 1) * 372 + part(date, 2) * 31 + part(date, 3)


def impossible(date: Column, first_year: int = 1500, last_year: int = 1900) -> Column:
    """Whether a full date is out of range; null if it is not a full date."""
    y, m, d = (part(date, n) for n in (1, 2, 3))
    longest = F.coalesce(F.get(F.array(*map(F.lit, LONGEST)), m - 1), F.lit(0))
    return ~(y.between(first_year, last_year) & m.between(1, 12) & (d >= 1) & (d <= longest))


def completed(date: Column, end: bool) -> Column:
    """The first or last day that a partial date can mean."""
    n = F.size(F.split(date, "-"))
    month = F.get(F.split(date, "-"), F.lit(1)).try_cast("int")
    last = F.get(F.array(*map(F.lit, DAYS)), month - 1).cast("string")
    by_year, by_month = (F.lit("-12-31"), F.concat(F.lit("-"), last)) if end else (F.lit("-01-01"), F.lit("-01"))
    return F.when(n == 1, F.concat(date, by_year)).when(n == 2, F.concat(date, by_month)).otherwise(date)

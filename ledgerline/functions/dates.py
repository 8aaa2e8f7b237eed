"""Column functions on dates written in text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_MONTHS = "January|February|March|April|May|June|July|August|September|October|November|December"


def iso_date(text: Column) -> Column:
    """The date of a text as YYYY-MM-DD: ISO, M/D/YYYY, "Month d, yyyy" or "d Month yyyy"; null where none is valid.

    Month comes first in numeric dates and is never swapped with the day; years have four digits.
    A form that isn't a real day gives way to the next.
    """

    def read(pattern: str, order: tuple[int, int, int], shape: str) -> Column:
        parts = [F.regexp_extract(text, pattern, i) for i in order]
        return F.when(text.rlike(pattern), F.try_to_date(F.concat_ws("-", *parts), shape))

    forms = (
        read(r"(?<!\d)(\d{4})-(\d{1,2})-(\d{1,2})(?!\d)", (1, 2, 3), "y-M-d"),
        read(r"(?<!\d)(\d{1,2})/(\d{1,2})/(\d{4})(?!\d)", (3, 1, 2), "y-M-d"),
        read(rf"\b({_MONTHS})\s+(\d{{1,2}}),?\s+(\d{{4}})(?!\d)", (3, 1, 2), "y-MMMM-d"),
        read(rf"(?<!\d)(\d{{1,2}})\s+({_MONTHS}),?\s+(\d{{4}})(?!\d)", (3, 2, 1), "y-MMMM-d"),
    )
    return F.date_format(F.coalesce(*forms), "yyyy-MM-dd")


def maturity_from_name(name: Column) -> Column:
    """The end date a name states after "due": a full date, else the end of a month, else the end of a year.

    More than one distinct year after "due", or years joined by "and" or a comma, give null.
    """
    due = F.regexp_extract(name, r"(?i)\bdue\b(.*)$", 1)
    month_end = F.last_day(F.try_to_date(F.concat_ws("-", F.regexp_extract(due, rf"\b({_MONTHS})\s+(\d{{4}})", 2), F.regexp_extract(due, rf"\b({_MONTHS})\s+(\d{{4}})", 1), F.lit("1")), "y-MMMM-d"))
    years = F.array_distinct(F.regexp_extract_all(due, F.lit(r"\b((?:19|20)\d{2})\b"), 1))
    year_end = F.when((F.size(years) == 1) & ~due.rlike(r"(?i)\b\d{4}\s*(?:,|and)\s*\d{4}"), F.concat(years[0], F.lit("-12-31")))
    return F.when(due != "", F.coalesce(iso_date(due), F.date_format(month_end, "yyyy-MM-dd"), year_end))


def plus_tenor(date: Column, count: Column, unit: Column) -> Column:
    """A date plus a number of days, weeks, months or years; ends of months are clamped."""
    return (
        F.when(unit == "day", F.date_add(date, count))
        .when(unit == "week", F.date_add(date, count * 7))
        .when(unit == "month", F.add_months(date, count))
        .when(unit == "year", F.add_months(date, count * 12))
    )


def end_dates_compatible(left: Column, right: Column) -> Column:
    """Whether two end dates of year, month or day precision can be one: one is missing, or a prefix of the other."""
    return left.isNull() | right.isNull() | left.startswith(right) | right.startswith(left)

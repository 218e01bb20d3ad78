"""Dates: several text forms, integer keys, year/month/day ranges."""

from __future__ import annotations

import calendar
from collections.abc import Iterable
from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F

from tollbook.functions.text import _column

# Accepted forms in order of precedence.
FLEXI_DATE_FORMS = (
    "yyyy-MM-dd",
    "yyyyMMdd",
    "yyyy-MM-dd HH:mm:ss",
    "yyyyMMddHHmmss",
    "dd/MM/yyyy HH:mm:ss",
)
WEEKDAY_DATE_FORM = "MMM dd HH:mm:ss yyyy"
LEADING_WEEKDAY = r"^[A-Za-z]{3}\s+"
ICC_DATE_FORMS = ("dd/MM/yyyy HH:mm:ss", "yyyy-MM-dd", "yyyyMMdd")


def _first_match(text: Column, tries: Iterable[tuple[str, Column]]) -> Column:
    # A parse that fails costs far more than one that succeeds, so forms that cannot
    # match are sorted out by separators. No field can hold "/" or ":", which makes
    # those decide both ways; a year may have a sign, so "-" only rules out its absence.
    groups: dict[tuple[bool, bool], list[Column]] = {}
    for form, candidate in tries:
        parsed = F.try_to_date(candidate, form)
        if "-" in form:
            parsed = F.when(text.contains("-"), parsed)
        groups.setdefault(("/" in form, ":" in form), []).append(parsed)
    found = [
        F.when((text.contains("/") == slash) & (text.contains(":") == colon), F.coalesce(*parsed))
        for (slash, colon), parsed in groups.items()
    ]
    return F.coalesce(*found)


def first_date(c: Column | str, forms: Iterable[str]) -> Column:
    """Date by the first form that matches, NULL if none does."""
    text = _column(c)
    return _first_match(text, [(form, text) for form in forms])


def flexi_date(c: Column | str) -> Column:
    """Date of a flexi record: five numeric forms, then weekday-and-month text."""
    text = _column(c)
    after_weekday = F.regexp_replace(F.trim(text), LEADING_WEEKDAY, "")
    return _first_match(text, [*[(form, text) for form in FLEXI_DATE_FORMS], (WEEKDAY_DATE_FORM, after_weekday)])


def icc_date(c: Column | str) -> Column:
    """Date of an icc record."""
    return first_date(c, ICC_DATE_FORMS)


def date_key(c: Column | str) -> Column:
    """yyyyMMdd as an integer."""
    d = _column(c)
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("int")


def date_of_key(c: Column | str) -> Column:
    """Inverse of :func:`date_key`."""
    return F.to_date(_column(c).cast("string"), "yyyyMMdd")


def check_year_month_day(year: int | None, month: int | None, day: int | None) -> None:
    """Raise ValueError unless the parts given name days that exist; none may lack the larger parts."""
    parts = [year, month, day]
    known = next((n for n, part in enumerate(parts) if not part), 3)
    if any(parts[known:]):
        raise ValueError("a part of a date was given without the larger ones")
    if known:
        date(*[*parts[:known], 1, 1][:3])


def year_month_day_range(year: int, month: int | None = None, day: int | None = None) -> tuple[date, date]:
    """First and last date of the year, month or day named by the parts."""
    check_year_month_day(year, month, day)
    first = date(year, month or 1, day or 1)
    if day:
        return first, first
    last_month = month or 12
    return first, date(year, last_month, calendar.monthrange(year, last_month)[1])


def months_between(date_from: date, date_to: date) -> list[date]:
    """First days of the months that an inclusive range of dates touches."""
    count = 12 * (date_to.year - date_from.year) + date_to.month - date_from.month + 1
    first = 12 * date_from.year + date_from.month - 1
    return [date(n // 12, n % 12 + 1, 1) for n in range(first, first + count)]


def range_start(year: Column, month: Column | None = None, day: Column | None = None) -> Column:
    """Column form of the first date of a year, month or day."""
    return F.make_date(year, F.lit(1) if month is None else month, F.lit(1) if day is None else day)


def range_end(year: Column, month: Column | None = None, day: Column | None = None) -> Column:
    """Column form of the last date of a year, month or day."""
    if day is not None:
        return F.make_date(year, month, day)
    return F.last_day(F.make_date(year, F.lit(12) if month is None else month, F.lit(1)))

"""Dates that a page mentions, and windows of dates."""

from __future__ import annotations

import re
from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Separators of a date's parts.
SEPARATORS = "./-年月日"
DATE_PATTERN = r"\d{4}[-./年]\d{1,2}[-./月]\d{1,2}日?"


def parse(text: Column) -> Column:
    """A date of three parts, or null.

    Two-digit years that begin with 0 or 1 are of this century, others of the
    last; four-digit years begin with 19 or 20; a date that no calendar has, and
    parts that are not numbers, give null.
    """
    parts = F.filter(F.split(text, f"[{re.escape(SEPARATORS)}]"), lambda x: x != "")
    first = F.try_element_at(parts, F.lit(1))
    year = (
        F.when(first.rlike("^[01][0-9]$"), F.concat(F.lit("20"), first))
        .when(first.rlike("^[0-9]{2}$"), F.concat(F.lit("19"), first))
        .when(first.rlike("^(19|20)[0-9]{2}$"), first)
    )
    part = lambda i: F.when(F.try_element_at(parts, F.lit(i)).rlike("^[0-9]{1,9}$"), F.try_element_at(parts, F.lit(i)).cast("int").cast("string"))
    return F.when(F.size(parts) == 3, F.try_to_date(F.concat_ws("-", F.when(part(2).isNotNull() & part(3).isNotNull(), year), part(2), part(3)), "yyyy-M-d"))


def found(text: Column, pattern: str = DATE_PATTERN) -> Column:
    return F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), parse)


def latest(text: Column, pattern: str = DATE_PATTERN) -> Column:
    """The latest valid date in a text, or null."""
    return F.array_max(F.filter(found(text, pattern), lambda d: d.isNotNull()))


def check_window(start: str, end: str) -> tuple[date, date]:
    """Both ends of a window as dates; raises unless they are ``yyyy-MM-dd`` and in order."""
    for x in (start, end):
        if not re.fullmatch(r"\d{4}-\d{2}-\d{2}", x):
            raise ValueError(f"not a date: {x}")
    a, b = date.fromisoformat(start), date.fromisoformat(end)
    if a > b:
        raise ValueError("the window ends before it starts")
    return a, b


def in_window(day: Column, start: str, end: str, compat: bool = False) -> Column:
    """Whether a date lies in a window, both ends included; false for null.

    With ``compat`` a date in the year of the start is only held against the
    start, and else one in the year of the end only against the end, so that all
    dates of a window within one year pass.
    """
    a, b = check_window(start, end)
    if not compat:
        return F.coalesce(day.between(F.lit(a), F.lit(b)), F.lit(False))
    y = F.year(day)
    between_years = (y > a.year) & (y < b.year)
    return F.coalesce(between_years | ((y == a.year) & (day >= F.lit(a))) | ((y == b.year) & (day <= F.lit(b))), F.lit(False))

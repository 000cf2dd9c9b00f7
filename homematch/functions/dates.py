"""Date expressions. The current day is always a parameter."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, functions as F

from homematch.functions.text import lookup
from homematch.lookups import LISTING_AGE_DAYS, RECENCY_CLASSES, UNKNOWN_LISTING_AGE_DAYS

DATE_FORMATS = ["yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd HH:mm", "yyyy-MM-dd"]


def parsed_timestamp(text: Column, formats: list[str] | None = None) -> Column:
    """Timestamp in a text, null where no format fits."""
    return F.coalesce(*[F.try_to_timestamp(text, F.lit(f)) for f in formats or DATE_FORMATS])


def parsed_date(text: Column, formats: list[str] | None = None) -> Column:
    """Date in a text, null where no format fits."""
    return F.to_date(parsed_timestamp(text, formats or ["yyyy-MM-dd"]))


def listing_date(label: Column, as_of: dt.date) -> Column:
    """Estimated date of a listing from its age label."""
    days = F.coalesce(lookup(label, LISTING_AGE_DAYS), F.lit(UNKNOWN_LISTING_AGE_DAYS))
    return F.date_sub(F.lit(as_of), days)


def calendar_parts(date: Column) -> dict[str, Column]:
    """Year, month and weekday with Monday as 0."""
    return {"year": F.year(date), "month": F.month(date), "day_of_week": F.weekday(date)}


def days_since(date: Column, as_of: dt.date) -> Column:
    """Whole days from a date up to ``as_of``."""
    return F.datediff(F.lit(as_of), date)


def recency_class(days: Column) -> Column:
    """Recency class of a number of days; null for zero and negative days."""
    result = None
    for above, up_to, label in RECENCY_CLASSES:
        inside = (days > above) & (days <= up_to) if up_to is not None else days > above
        result = F.when(inside, label) if result is None else result.when(inside, label)
    return result


def in_year(date: Column, year: int) -> Column:
    """Year test written as a range, so that file statistics can prune."""
    return (date >= F.lit(dt.date(year, 1, 1))) & (date < F.lit(dt.date(year + 1, 1, 1)))

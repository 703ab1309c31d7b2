"""Dates and times in text. The session's time zone is taken to be UTC."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Tried in this order.
FORMATS = ["yyyy-MM-dd'T'HH:mm:ssXXX", "yyyy-MM-dd'T'HH:mm:ss", "yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd", "yyyy/MM/dd", "dd.MM.yyyy", "MM/dd/yyyy", "MMMM d, yyyy", "d MMMM yyyy"]


def parse_timestamp(text: Column) -> Column:
    """A timestamp by the first format that fits, null if none does; without a zone it is UTC."""
    return F.coalesce(*(F.try_to_timestamp(text, F.lit(f)) for f in FORMATS))


def to_iso(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'+00:00'")


def normalize_date(text: Column, form: str = "ISO8601") -> Column:
    """ISO8601, date, or a date_format pattern."""
    ts = parse_timestamp(text)
    return to_iso(ts) if form == "ISO8601" else F.date_format(ts, "yyyy-MM-dd" if form == "date" else form)


def relative_date(expression: Column, reference: Column) -> Column:
    """today, now, yesterday, tomorrow, or `N days/weeks/months/years [ago | from now | later]`; ago is the default."""
    e = F.lower(F.trim(expression))
    n = F.regexp_extract(e, r"^(\d+)\s+(day|week|month|year)s?", 1).try_cast("int")
    unit = F.regexp_extract(e, r"^(\d+)\s+(day|week|month|year)s?", 2)
    signed = F.when(e.rlike(r"from now|later"), n).otherwise(-n)
    moved = (
        F.when(unit == "day", F.date_add(reference, signed))
        .when(unit == "week", F.date_add(reference, signed * 7))
        .when(unit == "month", F.add_months(reference, signed))
        .when(unit == "year", F.add_months(reference, signed * 12))
    )
    return F.when(e.isin("today", "now"), reference).when(e == "yesterday", F.date_sub(reference, 1)).when(e == "tomorrow", F.date_add(reference, 1)).otherwise(moved)


def in_zone(ts: Column, zone: str) -> Column:
    """The wall-clock time of a UTC timestamp in a zone."""
    return F.from_utc_timestamp(ts, zone)


def date_range(text: Column) -> Column:
    """struct(start, end) texts of `from A to B` or `between A and B`; null without."""
    pattern = r"(?i)(?:from|between)\s+(\S+)\s+(?:to|and)\s+(\S+)"
    start, end = F.regexp_extract(text, pattern, 1), F.regexp_extract(text, pattern, 2)
    return F.when(start != "", F.struct(start.alias("start"), end.alias("end")))

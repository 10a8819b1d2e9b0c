"""Dates and times: parsing of mixed forms, periods, freshness."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Civil time of naive stamps, as an offset.
OFFSET = "+08:00"
#: Digits over this are milliseconds, up to it seconds (fixed value).
MILLIS_ABOVE = 10_000_000_000


def parse_time(text: Column) -> Column:
    """ISO text, epoch seconds or epoch milliseconds as a timestamp; naive text is in ``OFFSET``; else null."""
    t = F.trim(text)
    digits = t.rlike("^[0-9]{1,16}$")
    number = F.when(digits, t.cast("decimal(20,0)"))
    from_number = F.timestamp_millis(F.when(number > MILLIS_ABOVE, number).otherwise(number * 1000).cast("long"))
    zoned = t.rlike(r"(?:Z|[+-]\d{2}:?\d{2})$") & t.rlike(r"\d[T ]\d")
    date_only = t.rlike(r"^\d{4}-\d{2}-\d{2}$")
    iso = F.when(date_only, F.concat(t, F.lit("T00:00:00" + OFFSET))).when(zoned, t).otherwise(F.concat(t, F.lit(OFFSET)))
    return F.when(digits, from_number).when(t.rlike(r"^\d{4}-\d{2}-\d{2}"), F.try_to_timestamp(F.regexp_replace(iso, " ", "T")))


def form_of(text: Column) -> Column:
    """The form of a stamp: millis, seconds, zoned, naive, date or other."""
    number = F.when(text.rlike("^[0-9]{1,16}$"), text.cast("decimal(20,0)"))
    return (
        F.when(text.isNull() | (text == ""), "missing").when(number > MILLIS_ABOVE, "millis").when(number.isNotNull(), "seconds")
        .when(text.rlike(r"^\d{4}-\d{2}-\d{2}$"), "date").when(text.rlike(r"^\d{4}-\d{2}-\d{2}[T ].*(?:Z|[+-]\d{2}:?\d{2})$"), "zoned").when(text.rlike(r"^\d{4}-\d{2}-\d{2}[T ]"), "naive").otherwise("other")
    )


def first_date(text: Column) -> Column:
    """The first 20YY-MM-DD in a text that is a real date, else null."""
    return F.try_to_date(F.nullif(F.regexp_extract(text, r"(20\d{2}-\d{2}-\d{2})", 1), F.lit("")), "yyyy-MM-dd")


def iso_week(day: Column) -> Column:
    """``2025-W01``; the year is that of the week."""
    return F.concat(F.extract(F.lit("YEAROFWEEK"), day).cast("string"), F.lit("-W"), F.lpad(F.weekofyear(day).cast("string"), 2, "0"))


def freshness(at: Column, now: Column, limit_hours: Column, skew_minutes: int = 5) -> Column:
    """unknown, future, no_limit, invalid_limit, stale or fresh; exactly at the limit is fresh."""
    seconds = F.timestamp_diff("SECOND", at, now)
    return (
        F.when(at.isNull(), "unknown").when(seconds < -60 * skew_minutes, "future").when(limit_hours.isNull(), "no_limit")
        .when(limit_hours <= 0, "invalid_limit").when(seconds > limit_hours * 3600, "stale").otherwise("fresh")
    )


def window_start(last: Column, now: Column, overlap_days: int, window_days: int) -> Column:
    """Where an incremental read starts: the last one less an overlap, or a window before now."""
    return F.coalesce(last - F.make_interval(days=F.lit(overlap_days)), now - F.make_interval(days=F.lit(window_days)))

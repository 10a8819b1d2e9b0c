"""Numbers as text, progress, tolerance."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def format_seconds(seconds: Column) -> Column:
    """``1h 2m 3s``; leading zero parts are left out."""
    s = seconds.cast("long")
    hours, minutes = F.floor(s / 3600), F.floor(s / 60)
    part = lambda shown, value, unit: F.when(shown > 0, F.concat(value.cast("string"), F.lit(unit + " "))).otherwise("")
    return F.concat(part(hours, hours, "h"), part(minutes, minutes % 60, "m"), (s % 60).cast("string"), F.lit("s"))


def format_number(value: Column, unit: str = "") -> Column:
    """Whole numbers without, others with at most two decimals."""
    two = value.cast("decimal(18,2)")
    text = F.regexp_replace(two.cast("string"), r"(?:\.00|(?<=\.\d)0)$", "")
    return F.concat(text, F.lit(unit)) if unit else text


def percent(progress: Column) -> Column:
    """Progress as percent: ratios up to one are scaled, the result lies between 0 and 100."""
    return F.greatest(F.lit(0.0), F.least(F.lit(100.0), F.when(progress <= 1, progress * 100).otherwise(progress)))


def near(left: Column, right: Column, tolerance: int = 1000) -> Column:
    """Whether two millisecond stamps differ by less than the tolerance; null never."""
    return F.coalesce(F.abs(left - right) < tolerance, F.lit(False))


def spoken_seconds(seconds: Column) -> Column:
    """Hours, minutes and seconds with their units (fixed words); halves round to even; zero is 0 seconds."""
    whole = F.bround(seconds).cast("long")
    h, m, s = F.floor(whole / 3600), F.floor(whole % 3600 / 60), whole % 60
    part = lambda value, unit, shown: F.when(shown, F.concat(value.cast("string"), F.lit(unit))).otherwise("")
    return F.concat(part(h, "小时", h > 0), part(m, "分", m > 0), part(s, "秒", (s > 0) | (h + m == 0)))


def retry_delay(attempt: Column, jitter: Column, asked: Column, base: float = 0.5, most: float = 30.0) -> Column:
    """Seconds before the next try: doubled up to ``most``, times a half to one by ``jitter``, at least what was asked for."""
    grown = F.least(F.lit(most), base * F.pow(F.lit(2.0), attempt - 1))
    return F.greatest(grown * (0.5 + 0.5 * jitter), F.coalesce(asked, F.lit(0.0)))

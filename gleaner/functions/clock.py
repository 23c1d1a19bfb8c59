"""Time gates; `now` is always a parameter and both sides are of one timestamp kind."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DAY = 86_400_000_000


def micros(start: Column, end: Column) -> Column:
    return F.timestamp_diff("MICROSECOND", start, end)


def within(ts: Column, now: Column, days: int, future_hours: int = 24) -> Column:
    """Unknown dates pass; later than now by more than future_hours does not; else the age is at most `days`."""
    age = micros(ts, now)
    return ts.isNull() | ((age >= -future_hours * 3_600_000_000) & (age <= days * DAY))


def bucket(ts: Column, now: Column, recent_days: int = 7, fallback_days: int = 30) -> Column:
    """recent, fallback, unknown, or null outside the window."""
    age = F.greatest(micros(ts, now), F.lit(0))
    return F.when(ts.isNull(), "unknown").when(~within(ts, now, fallback_days), None).when(age <= recent_days * DAY, "recent").otherwise("fallback")


def age_label(ts: Column, now: Column) -> Column:
    """Label by whole days of age: below eight days counts as the last week."""
    days = F.floor(micros(ts, now) / DAY)
    return F.when(ts.isNull(), "unknown date").when(days < 0, "future").when(days <= 7, "last 7 days").when(days <= 30, "8-30 days").otherwise("older")


def floor_days_apart(left: Column, right: Column) -> Column:
    """Days from right to left, floored before the sign is dropped; so it matters which side is which."""
    return F.abs(F.floor(micros(right, left) / DAY))


def expired(deadline: Column, precision: Column, now: Column) -> Column:
    return F.when(precision == "date", F.to_date(now) > F.to_date(deadline)).otherwise(now > deadline)


def daily_window(now: Column) -> tuple[Column, Column]:
    """(start, end) of the last twenty-four hours."""
    return now - F.make_dt_interval(hours=F.lit(24)), now


def rolling_start(now: Column, months: int = 3) -> Column:
    """The same time of day some calendar months ago, the day cut to the month's length."""
    return now - F.make_ym_interval(months=F.lit(months))

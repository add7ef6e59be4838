"""Dates, instants, calendars and schedules. Nothing here reads a clock."""
from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, functions as F

from . import col, lit

MONDAY, TUESDAY, WEDNESDAY, THURSDAY, FRIDAY, SATURDAY, SUNDAY = range(7)
INBOUND_DAYS = (TUESDAY, FRIDAY)
DELIVERY_DAYS = (MONDAY, WEDNESDAY, FRIDAY)
CUTOFF_DAYS = (SUNDAY, TUESDAY, THURSDAY)

# The six parts of a store day, as label and first hour.
DAY_PARTS = (
    ("00:00–06:59", 0),
    ("07:00–09:59", 7),
    ("10:00–13:59", 10),
    ("14:00–16:59", 14),
    ("17:00–19:59", 17),
    ("20:00–23:59", 20),
)


def instant(v) -> Column:
    """Timestamp column from a Column, a datetime or text."""
    if isinstance(v, Column):
        return v
    if isinstance(v, datetime):
        v = v.strftime("%Y-%m-%d %H:%M:%S.%f")
    return F.lit(v).cast("timestamp")


def day_of(v) -> Column:
    if isinstance(v, Column):
        return F.to_date(v)
    if isinstance(v, (date, datetime)):
        v = v.strftime("%Y-%m-%d")
    return F.lit(v).cast("date")


def parse_instant(text) -> Column:
    """ISO-8601 text with an offset or Z; null when unreadable."""
    return F.try_to_timestamp(F.regexp_replace(F.trim(col(text)), "Z$", "+00:00"))


def days_until(day, now) -> Column:
    return F.datediff(col(day), lit(now))


def shift(ts, **units) -> Column:
    """ts plus an interval, for example shift("ts", mins=-60)."""
    return col(ts) + F.make_interval(**{k: F.lit(v) for k, v in units.items()})


def within_days(day, now, last: int) -> Column:
    left = days_until(day, now)
    return left.between(0, last)


def iso_week(day) -> Column:
    year = F.extract(F.lit("YEAROFWEEK"), col(day))
    return F.concat(year.cast("string"), F.lit("-W"), F.lpad(F.weekofyear(col(day)).cast("string"), 2, "0"))


def is_weekend(day) -> Column:
    return F.weekday(col(day)) >= SATURDAY


def falls_on(day, days) -> Column:
    return F.weekday(col(day)).isin(*days)


def day_part(ts) -> Column:
    hour = F.hour(col(ts))
    out = None
    for label, first in reversed(DAY_PARTS):
        out = F.when(hour >= first, label) if out is None else out.when(hour >= first, label)
    return out


def from_epoch(n) -> Column:
    """Epoch number to an instant; above 1e10 it is read as milliseconds."""
    v = col(n).cast("bigint")
    return F.when(v > 10_000_000_000, F.timestamp_millis(v)).otherwise(F.timestamp_seconds(v))


def epoch_ms_day(ms) -> Column:
    return F.to_date(F.timestamp_millis(col(ms).cast("bigint")))


def at_hour(day, hour: int, minute: int = 0) -> Column:
    return col(day).cast("timestamp") + F.make_interval(hours=F.lit(hour), mins=F.lit(minute))


def next_delivery(now, days=DELIVERY_DAYS, hour: int = 8, minute: int = 0) -> Column:
    """Next delivery day; today only while the delivery hour is still ahead."""
    ts = col(now)
    today = F.to_date(ts)
    ahead = F.sequence(today, F.date_add(today, 7))
    open_days = F.filter(
        ahead, lambda d: F.weekday(d).isin(*days) & ((d > today) | (ts < at_hour(d, hour, minute)))
    )
    return F.coalesce(F.array_min(open_days), F.date_add(today, 7))


def at_gate(ts, days, hour: int, minute: int = 0) -> Column:
    """The exact minute of a weekly gate (order cutoff, delivery)."""
    t = col(ts)
    return falls_on(t, days) & (F.hour(t) == hour) & (F.minute(t) == minute)


def in_lead_window(ts, days=CUTOFF_DAYS, hour: int = 12, minute: int = 0, lead_min: int = 5) -> Column:
    """From a few minutes before the cutoff until the end of that day."""
    t = col(ts)
    start = at_hour(F.to_date(t), hour, minute) - F.make_interval(mins=F.lit(max(0, lead_min)))
    return falls_on(t, days) & (t >= start)


def model_version(ts) -> Column:
    return F.date_format(col(ts), "yyyyMMdd_HHmmss")


def version_instant(version) -> Column:
    return F.try_to_timestamp(col(version), F.lit("yyyyMMdd_HHmmss"))


def version_in_path(path, model: str) -> Column:
    hit = F.regexp_extract(col(path), rf"(?:^|/){model}_(\d{{8}}_\d{{6}})(?:\.json)?/?$", 1)
    return F.when(hit != "", hit)


def week_days(start, end) -> Column:
    """Every day of a week row. The end day counts, except for a span of 7, where it is the next week."""
    s, e = col(start), col(end)
    last = F.when(F.datediff(e, s) == 7, F.date_add(e, -1)).otherwise(e)
    return F.when(last >= s, F.sequence(s, last)).otherwise(F.array().cast("array<date>"))

"""Date and time functions. "Now" is always an explicit ``as_of`` argument, never the clock."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidewater.functions._util import col


def _lit_ts(v) -> Column:
    if isinstance(v, Column):
        return v
    return F.lit(v).cast("timestamp_ntz")


def to_zone(ts, tz: str, days: int = 0, hours: int = 0, **other) -> Column:
    """UTC wall time -> wall time in ``tz`` (zone-less result), optionally minus days and hours.

    Hours are absolute time (subtracted before the zone shift); days are calendar days in the target zone.
    Any other unit is ignored, as in the source rule.
    """
    t = col(ts)
    if hours:
        t = t - F.make_dt_interval(F.lit(0), F.lit(hours))
    out = F.convert_timezone(F.lit("UTC"), F.lit(tz), t)
    if days:
        out = out - F.make_interval(F.lit(0), F.lit(0), F.lit(0), F.lit(days))
    return out


def format_zone_date(ts, tz: str = "America/New_York", fmt: str = "yyyy-MM-dd", **shift) -> Column:
    """Date text of a UTC time as seen in ``tz``."""
    return F.date_format(to_zone(ts, tz, **shift), fmt)


def previous_daily_run(ts, run_hour: int = 5, run_minute: int = 25, ready_hour: int = 5) -> Column:
    """Run time of a daily job that must be complete: yesterday at run_hour:run_minute, or the day before
    yesterday when the current hour is before ``ready_hour``."""
    t = col(ts)
    base = F.date_trunc("day", t) - F.expr("INTERVAL 1 DAY") + F.make_dt_interval(
        F.lit(0), F.lit(run_hour), F.lit(run_minute))
    base = base.cast("timestamp_ntz")
    return F.when(F.hour(t) < ready_hour, base - F.expr("INTERVAL 1 DAY")).otherwise(base)


def previous_slot(ts, slots, minute: int | None = 25) -> Column:
    """Latest slot hour at or before the time's hour, same day, minute set to ``minute`` (None: keep minutes).

    When no slot is at or before the hour, the nearest slot (smallest distance, then smallest hour) is taken and
    that many hours are subtracted from the time (kept as in the source rule; exact only for slot 1 at hour 0).
    """
    t = col(ts)
    if minute is not None:
        t = (F.date_trunc("hour", t) + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(minute))).cast("timestamp_ntz")
    h = F.hour(t)
    arr = F.array(*[F.lit(int(s)) for s in slots])
    below = F.array_max(F.filter(arr, lambda x: x <= h))
    same_day = F.date_trunc("day", t) + F.make_dt_interval(F.lit(0), below) + (t - F.date_trunc("hour", t))
    # no slot at or below: every slot is above the hour, the nearest is the smallest one
    fallback = t - F.make_dt_interval(F.lit(0), F.array_min(arr))
    return F.when(below.isNotNull(), same_day.cast("timestamp_ntz")).otherwise(fallback)


def shift_days_hours(ts, days: int = 0, hours: int = 0) -> Column:
    return col(ts) + F.make_dt_interval(F.lit(days), F.lit(hours))


def whole_days_between(start, end) -> Column:
    """Whole elapsed days from start to end (truncated toward zero)."""
    secs = F.unix_micros(col(end).cast("timestamp")) - F.unix_micros(col(start).cast("timestamp"))
    return (secs / F.lit(86_400_000_000)).cast("bigint")


def clamp_past(ts, as_of, max_days: int = 30) -> Column:
    """Times more than ``max_days`` whole days before ``as_of`` move forward by the excess whole days, keeping the
    time of day; later times are unchanged."""
    t = col(ts)
    d = whole_days_between(t, _lit_ts(as_of))
    return F.when(d > max_days, t + F.make_dt_interval(d - F.lit(max_days))).otherwise(t)


def throttle_ok(ts, last_ts, minutes: int = 15) -> Column:
    """True when at least ``minutes`` have passed since the last action (or there was none)."""
    return F.coalesce(col(ts) - F.make_dt_interval(F.lit(0), F.lit(0), F.lit(minutes)) >= col(last_ts), F.lit(True))


def iso_to_epoch(c, fmt: str = "yyyy-MM-dd'T'HH:mm:ss'Z'") -> Column:
    """``yyyy-MM-ddTHH:mm:ssZ`` text -> epoch seconds, read as UTC; unparsable text gives null."""
    return F.unix_seconds(F.try_to_timestamp(col(c), F.lit(fmt)))


def five_minute_window(ts) -> Column:
    """Start of the 5-minute interval the time falls in ([t, t+5m) half-open, so fractional seconds count)."""
    return F.window(col(ts), "5 minutes").start.cast("timestamp_ntz")


def date_series(start, end) -> Column:
    """Array of all dates from start to end inclusive."""
    return F.sequence(col(start).cast("date"), col(end).cast("date"), F.expr("INTERVAL 1 DAY"))


def key_date(c) -> Column:
    """Date carried by an object key: the text after the last ``date_``, up to the next `/`, after the last `=`;
    cut at ``T`` or, failing that, to at most three dash parts. Undated or unparsable -> null."""
    d = F.element_at(F.split(col(c), "date_", -1), -1)
    d = F.element_at(F.split(F.element_at(F.split(d, "/", -1), 1), "=", -1), -1)
    d = F.when(d.contains("T"), F.substring_index(d, "T", 1)).otherwise(F.substring_index(d, "-", 3))
    return F.when(col(c).contains("date_"), F.try_to_date(d, "yyyy-MM-dd"))


def name_date(c, prefix_regex: str = r"^tmp_.*\d{8}") -> Column:
    """Date in a temporary table name (first 8-digit run, yyyyMMdd) when the name matches ``prefix_regex``."""
    m = F.regexp_extract(col(c), r"(\d{8})", 1)
    return F.when(col(c).rlike(prefix_regex), F.try_to_date(m, "yyyyMMdd"))

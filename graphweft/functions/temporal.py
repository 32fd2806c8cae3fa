"""Temporal functions (F21–F25). Durations are structs of whole components."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

UNITS = ("years", "months", "days", "hours", "minutes", "seconds")
_DAY_US = 86_400_000_000
DAYS_PER_MONTH = 30.44  # fixed value of inMonths
_TRUNCATE = {"year": "year", "month": "month", "day": "day"}


def _part(parts: dict, name: str, default) -> Column:
    value = parts.get(name, default)
    return value.cast("int") if isinstance(value, Column) else F.lit(value).cast("int")


def _year(parts: dict) -> Column:
    return parts["year"].cast("int") if isinstance(parts.get("year"), Column) else (
        F.lit(parts["year"]) if "year" in parts else F.year(F.current_date())
    )


def timestamp_ms() -> Column:
    return F.unix_millis(F.current_timestamp())


def date(value: Column | None = None, **parts) -> Column:
    """date(), date(text or timestamp), date({year, month, day}) with month and day 1 by default."""
    if value is not None:
        return value.try_cast("date")
    if parts:
        return F.make_date(_year(parts), _part(parts, "month", 1), _part(parts, "day", 1))
    return F.current_date()


def datetime(value: Column | None = None, **parts) -> Column:
    """datetime() and localdatetime() in the same three forms; missing time parts are 0."""
    if value is not None:
        return value.try_cast("timestamp")
    if parts:
        clock = [_part(parts, name, 0) for name in ("hour", "minute")]
        second = _part(parts, "second", 0).cast("decimal(16,6)")
        return F.make_timestamp(_year(parts), _part(parts, "month", 1), _part(parts, "day", 1), *clock, second)
    return F.current_timestamp()


def time(value: Column | None = None, **parts) -> Column:
    """time() and localtime() as HH:mm:ss text."""
    if parts:
        return F.format_string("%02d:%02d:%02d", *[_part(parts, n, 0) for n in ("hour", "minute", "second")])
    return F.date_format(F.current_timestamp() if value is None else value.try_cast("timestamp"), "HH:mm:ss")


def from_epoch(seconds: Column) -> Column:
    return F.timestamp_seconds(seconds)


def from_epoch_millis(ms: Column) -> Column:
    return F.timestamp_millis(ms)


def truncate(unit: str, t: Column) -> Column:
    """date.truncate: first day of the year or month, or the day."""
    return F.date_trunc(_TRUNCATE[unit], t).cast("date")


def duration(**parts: int | Column) -> Column:
    unknown = set(parts) - set(UNITS)
    if unknown:
        raise ValueError(f"unknown duration parts: {sorted(unknown)}")
    return F.struct(*[_part(parts, u, 0).alias(u) for u in UNITS])


def _micros(a: Column, b: Column) -> Column:
    return F.unix_micros(b.cast("timestamp")) - F.unix_micros(a.cast("timestamp"))


def _whole(value: Column, unit: int) -> Column:
    return F.call_function("div", value, F.lit(unit).cast("long"))


def in_seconds(a: Column, b: Column) -> Column:
    return _whole(_micros(a, b), 1_000_000)


def in_days(a: Column, b: Column) -> Column:
    return _whole(_micros(a, b), _DAY_US)


def in_months(a: Column, b: Column) -> Column:
    return (_micros(a, b) / _DAY_US / DAYS_PER_MONTH).cast("long")


def between(a: Column, b: Column) -> Column:
    """Whole days and the seconds left over."""
    rest = _whole(_micros(a, b) % _DAY_US, 1_000_000)
    return duration(days=in_days(a, b), seconds=rest)


def _shift(t: Column, d: Column, sign: int) -> Column:
    parts = [d[u] * sign for u in UNITS]
    years, months, days, hours, minutes, seconds = parts
    return t + F.make_interval(years, months, F.lit(0), days, hours, minutes, seconds.cast("decimal(18,6)"))


def date_add(t: Column, d: Column) -> Column:
    """t plus a duration struct."""
    return _shift(t, d, 1)


def date_sub(t: Column, d: Column) -> Column:
    return _shift(t, d, -1)

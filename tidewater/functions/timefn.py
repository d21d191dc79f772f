"""Calendar and timestamp expressions (all native, all null-tolerant)."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

ISO_UTC_FORMAT = "yyyy-MM-dd'T'HH:mm:ss'Z'"


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def epoch_to_ts(epoch_seconds: Column | str) -> Column:
    """Epoch seconds -> TIMESTAMP without a string round trip."""
    return F.timestamp_seconds(_c(epoch_seconds))


def ts_to_epoch(ts: Column | str) -> Column:
    return F.unix_seconds(_c(ts).cast("timestamp"))


def parse_iso(text: Column | str) -> Column:
    """ISO-8601 text (``2024-01-01T10:00:00Z`` or with an offset) -> TIMESTAMP.

    Unparseable text gives NULL instead of failing the batch under ANSI.
    """
    return F.try_to_timestamp(_c(text))


def parse_iso_date(text: Column | str) -> Column:
    return F.try_to_date(_c(text))


def format_iso_utc(ts: Column | str) -> Column:
    """TIMESTAMP -> ``yyyy-MM-ddTHH:mm:ssZ`` in UTC, whatever the session's zone."""
    return F.date_format(F.to_utc_timestamp(_c(ts), F.current_timezone()), ISO_UTC_FORMAT)


def date_key(d: Column | str) -> Column:
    """Integer calendar key yyyymmdd of a date or timestamp."""
    d = _c(d)
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("int")


def iso_day_of_week(d: Column | str) -> Column:
    """Monday = 1 ... Sunday = 7."""
    return (F.pmod(F.dayofweek(_c(d)) - 2, F.lit(7)) + 1).cast("int")


def hour_bucket(ts: Column | str) -> Column:
    return F.date_trunc("hour", _c(ts))


def minute_bucket(ts: Column | str) -> Column:
    return F.date_trunc("minute", _c(ts))


def seconds_between(start: Column | str, end: Column | str) -> Column:
    """Whole elapsed seconds from ``start`` to ``end`` (truncated toward zero)."""
    return F.timestamp_diff("SECOND", _c(start), _c(end))

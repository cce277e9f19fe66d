"""Timestamp helpers matching the reference's naive-time conventions."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, functions as F

# The wall-clock zone of the load stamps and the text format of
# run times, as the reference writes them.
EASTERN = "US/Eastern"
SQL_DATETIME = "yyyy-MM-dd HH:mm:ss"


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def lit_ts(value: dt.datetime | str) -> Column:
    """A naive timestamp literal."""
    if isinstance(value, str):
        value = dt.datetime.fromisoformat(value)
    return F.lit(value).cast("timestamp_ntz")


def naive_ts(text: Column | str) -> Column:
    """Text -> naive timestamp; an offset suffix is dropped, not applied."""
    return _c(text).cast("timestamp_ntz")


def utc_to_eastern(ts: Column | str) -> Column:
    """A naive UTC instant shown as US/Eastern wall-clock time (10:00 -> 06:00 in April)."""
    return F.from_utc_timestamp(_c(ts).cast("timestamp"), EASTERN).cast("timestamp_ntz")


def zoned_reinterpret(ts: Column | str) -> Column:
    """The opposite shift: an Eastern wall-clock reading taken as UTC (10:00 -> 14:00)."""
    return F.to_utc_timestamp(_c(ts).cast("timestamp"), EASTERN).cast("timestamp_ntz")


def sql_datetime(ts: Column | str) -> Column:
    """``yyyy-MM-dd HH:mm:ss`` text, fraction of seconds dropped."""
    return F.date_format(_c(ts), SQL_DATETIME)


def plus_days(ts: Column, n: int) -> Column:
    return ts + F.expr(f"INTERVAL {int(n)} DAYS")


def minus_years(ts: Column, n: int) -> Column:
    return ts - F.expr(f"INTERVAL {int(n)} YEARS")

"""Date and time helpers.

Batch timestamps read from parquet are zone-less (``timestamp_ntz``); helpers keep
them zone-less unless a stream needs an instant (watermarks accept TIMESTAMP only).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .columns import col_of


def day_of(c: str | Column) -> Column:
    """``date(ts)``."""
    return F.to_date(col_of(c))


def month_start(c: str | Column) -> Column:
    """``date_trunc(date(ts), month)`` as DATE (F11); ``date_trunc`` would give TIMESTAMP."""
    return F.trunc(F.to_date(col_of(c)), "month")


def epoch_ms_to_timestamp(c: str | Column) -> Column:
    """Epoch milliseconds -> instant (F13, ``TO_TIMESTAMP_LTZ(x, 3)``)."""
    return F.timestamp_millis(col_of(c))


def timestamp_to_epoch_ms(c: str | Column) -> Column:
    """Timestamp -> epoch milliseconds."""
    return F.unix_millis(col_of(c).cast("timestamp"))


def parse_timestamp(c: str | Column, fmt: str = "yyyy-MM-dd HH:mm:ss") -> Column:
    """String -> timestamp by pattern, NULL on failure."""
    return F.try_to_timestamp(col_of(c), F.lit(fmt))


def format_timestamp(c: str | Column, fmt: str = "yyyy-MM-dd HH:mm:ss") -> Column:
    """Timestamp -> string."""
    return F.date_format(col_of(c), fmt)


def hours_between(start: str | Column, end: str | Column) -> Column:
    """Duration in hours from two timestamps at whole-second precision (P20)."""
    return (F.unix_timestamp(col_of(end)) - F.unix_timestamp(col_of(start))) / F.lit(3600)


def in_half_open(c: str | Column, start, end) -> Column:
    """``start <= c < end`` (P10)."""
    c = col_of(c)
    return (c >= F.lit(start)) & (c < F.lit(end))


def add_minutes(c: str | Column, minutes: str | Column) -> Column:
    return F.timestamp_add("MINUTE", col_of(minutes), col_of(c))


def add_hours(c: str | Column, hours: str | Column) -> Column:
    return F.timestamp_add("HOUR", col_of(hours), col_of(c))

"""Monitoring questions re-aimed as Spark jobs over event tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.columns import round_half_up
from ..sinks.writers import delete_path, list_folders
from .sequence import previous_row, trailing_range_max

SILENCE_SECONDS = 120        # producer silent for 2 minutes or more
DROP_WINDOW_SECONDS = 300    # price drop measured over 5 minutes
DROP_PCT = 3.0


def message_rate(messages: DataFrame, key: str = "symbol", ts: str = "ts", seconds: int = 60) -> DataFrame:
    """Messages per second per key over fixed windows."""
    start = F.window(F.col(ts), f"{seconds} seconds").start
    return (messages.groupBy(key, start.alias("window_start"))
                    .agg(F.count(F.lit(1)).alias("messages"))
                    .withColumn("rate_per_sec", round_half_up(F.col("messages") / F.lit(seconds), 6)))


def sent_failed(messages: DataFrame, failed: str, key: str = "symbol") -> DataFrame:
    """Sent / failed counters per key with a red/green state."""
    agg = messages.groupBy(key).agg(
        F.count_if(~F.col(failed)).alias("sent"),
        F.coalesce(F.sum(F.col(failed).cast("long")), F.lit(0)).alias("failed"))
    return agg.withColumn("state", F.when(F.col("failed") >= 1, F.lit("red")).otherwise(F.lit("green")))


def error_increase(messages: DataFrame, failed: str, key: str = "symbol", ts: str = "ts",
                   unit: str = "hour") -> DataFrame:
    """Failed count per key and period against the previous period with messages."""
    per = (messages.groupBy(key, F.date_trunc(unit, F.col(ts)).cast("timestamp_ntz").alias("period"))
                   .agg(F.count_if(F.col(failed)).alias("failed")))
    # One row per key and period: the window's size follows the time span, not the messages.
    w = Window.partitionBy(key).orderBy("period")
    with_prev = per.withColumn("prev_failed", F.lag("failed").over(w))
    return with_prev.withColumn("increased", F.coalesce(F.col("failed") > F.col("prev_failed"), F.lit(False)))


def _micros(c: str) -> Column:
    return F.unix_micros(F.col(c).cast("timestamp"))


def counter_increase(samples: DataFrame, value: str, key: str = "symbol", ts: str = "ts", order_tiebreak: str = "event_id",
                     range_seconds: int = 300, step_seconds: int = 60) -> DataFrame:
    """Increase and rate of a counter per key over a sliding range at evaluation steps.

    A step at ``t`` sees the samples in ``(t - range, t]``; steps are the multiples of
    ``step_seconds`` since the epoch.  A counter that falls has been reset: its whole value is
    the increase.  A step with fewer than two samples of a key gives no row; nothing is
    extrapolated.  Each sample is compared with the one before it (``previous_row``) and counts
    for the steps that see both, so rows are never joined with each other and a step's sum is
    combined before the shuffle.  Samples without a time or value play no part.
    """
    known = samples.select(key, ts, order_tiebreak, value).where(F.col(ts).isNotNull() & F.col(value).isNotNull())
    pairs = previous_row(known, [key], [ts, order_tiebreak], [ts, value])
    step, span = step_seconds * 1_000_000, range_seconds * 1_000_000

    # in whole microseconds: a double would lose the last digits of a time
    at, before = _micros(ts), _micros(f"prev_{ts}")
    first = at + F.pmod(-at, F.lit(step))
    last = before + F.lit(span) + F.pmod(-(before + F.lit(span)), F.lit(step)) - F.lit(step)
    gain = F.when(F.col(value) < F.col(f"prev_{value}"), F.col(value)).otherwise(F.col(value) - F.col(f"prev_{value}"))
    seen = pairs.select(key, gain.alias("gain"), first.alias("first"), last.alias("last")).where("first <= last")
    steps = seen.select(key, "gain", F.explode(F.sequence("first", "last", F.lit(step))).alias("step"))
    return (steps.groupBy(key, F.timestamp_micros("step").cast("timestamp_ntz").alias("step"))
                 .agg(F.sum("gain").alias("increase"))
                 .withColumn("rate_per_sec", round_half_up(F.col("increase") / F.lit(range_seconds), 6)))


def silence_gaps(messages: DataFrame, key: str = "symbol", ts: str = "ts", order_tiebreak: str = "event_id",
                 seconds: int = SILENCE_SECONDS, as_of=None) -> DataFrame:
    """Gaps of at least ``seconds`` between consecutive messages of a key.

    With ``as_of`` only messages up to then count, and a key that has been silent since its
    last one has an open gap: ``gap_end`` is NULL, ``gap_seconds`` lasts until ``as_of``.
    """
    rows = messages.select(key, ts, order_tiebreak)
    if as_of is not None:
        now = F.lit(as_of).cast(rows.schema[ts].dataType)
        rows = rows.where(F.col(ts) <= now)
    p = previous_row(rows, [key], [ts, order_tiebreak], [ts])
    closed = (p.withColumn("gap_seconds", (_micros(ts) - _micros(f"prev_{ts}")) / F.lit(1e6))
               .select(key, F.col(f"prev_{ts}").alias("gap_start"), F.col(ts).alias("gap_end"), "gap_seconds"))
    if as_of is not None:
        still = (F.unix_micros(now.cast("timestamp")) - _micros("gap_start")) / F.lit(1e6)
        last = rows.groupBy(key).agg(F.max(ts).alias("gap_start"))
        closed = closed.unionByName(last.withColumns({"gap_end": F.lit(None).cast(rows.schema[ts].dataType), "gap_seconds": still}))
    return closed.filter(F.col("gap_seconds") >= seconds)


def price_drops(ticks: DataFrame, key: str = "symbol", ts: str = "ts", price: str = "price",
                seconds: int = DROP_WINDOW_SECONDS, pct: float = DROP_PCT) -> DataFrame:
    """Ticks more than ``pct`` % below the highest price of the trailing window."""
    m = trailing_range_max(ticks, [key], ts, price, seconds, "max_price_window")
    drop = (F.col("max_price_window") - F.col(price)) / F.col("max_price_window") * F.lit(100)
    return (m.withColumn("drop_pct", drop).filter(F.col("drop_pct") > pct)
             .withColumn("drop_pct", round_half_up("drop_pct", 4)))


def recent_series(df: DataFrame, ts: str, as_of, minutes: int = 30, key: str | None = None, value=None) -> DataFrame:
    """Rows of one key (or all keys) in the ``minutes`` before ``as_of``."""
    as_of_col = F.lit(as_of).cast(df.schema[ts].dataType)
    out = df.filter((F.col(ts) >= F.timestamp_add("MINUTE", F.lit(-minutes), as_of_col)) & (F.col(ts) <= as_of_col))
    if key is not None and value is not None:
        out = out.filter(F.col(key) == value)
    return out


def retain(df: DataFrame, ts: str, days: int, as_of) -> DataFrame:
    """Rows younger than ``days`` at ``as_of``."""
    as_of_col = F.lit(as_of).cast(df.schema[ts].dataType)
    return df.filter(F.col(ts) >= F.timestamp_add("DAY", F.lit(-days), as_of_col))


def _day(parts: Sequence[str]) -> dt.date | None:
    """The day that folder values name: one ISO date (a time may follow), or year, month and day."""
    text = "-".join(parts) if len(parts) > 1 else parts[0][:10]
    try:
        return dt.date.fromisoformat(text)
    except ValueError:
        return None


def partition_days(spark: SparkSession, path: str, columns: Sequence[str]) -> dict[str, dt.date | None]:
    """Partition folders below ``path`` and the day of each; None for NULL and whatever is no day.

    ``columns``: one column of dates, or year, month and day (``yyyy=2024/MM=01/dd=31``, the
    JSON lake).  Other folders are passed over.  A listing, no data read.
    """
    found: dict[str, tuple[str, ...]] = {"": ()}
    for column in columns:
        found = {f"{folder}/{name}".lstrip("/"): (*parts, name.split("=", 1)[1]) for folder, parts in found.items()
                 for name in list_folders(spark, f"{path}/{folder}") if name.startswith(f"{column}=")}
    return {folder: _day(parts) for folder, parts in found.items()}


def drop_expired_partitions(spark: SparkSession, path: str, date_col: str | Sequence[str], days: int, as_of: dt.date) -> int:
    """Retention by partition drop (O07): folders of days older than ``days`` go.

    ``date_col`` is a date partition or the year, month and day partitions.  The NULL
    partition and folders that name no day have no age and stay.
    """
    columns = [date_col] if isinstance(date_col, str) else list(date_col)
    limit = as_of - dt.timedelta(days=days)
    expired = [f for f, day in partition_days(spark, path, columns).items() if day is not None and day < limit]
    for folder in expired:
        delete_path(spark, f"{path}/{folder}")
    return len(expired)


def retain_kinds(spark: SparkSession, root: str, kinds: dict[str, tuple[Sequence[str], int]], as_of: dt.date) -> dict[str, int]:
    """Retention of a lake (O07): each kind's folder with its partition columns and its days.

    Returns the folders dropped of each kind; a kind that has no folder yet drops none.
    """
    return {kind: drop_expired_partitions(spark, f"{root}/{kind}", columns, days, as_of) for kind, (columns, days) in kinds.items()}

"""Batch event-time windows (the batch forms of X03-X07) and their re-aggregation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def tumbling_totals(df: DataFrame, ts: str, size: str, keys: Sequence[str] = (),
                    measures: dict[str, str] | None = None) -> DataFrame:
    """Rows, and sums of ``measures`` (``{column: alias}``), per tumbling window and key.

    Grouping by (window, key) bounds every group by the window length, so a hot key is
    split across windows and pre-aggregated map-side.
    """
    w = F.window(F.col(ts), size)
    agg = df.groupBy(w.alias("w"), *keys).agg(
        F.count(F.lit(1)).alias("num_trips"),
        *[F.sum(c).alias(a) for c, a in (measures or {}).items()])
    return agg.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                      *keys, "num_trips", *(measures or {}).values())


def reaggregate(windows: DataFrame, by: Sequence[str], count_as: str, sums: dict[str, str]) -> DataFrame:
    """Second-level aggregate over window results (A16): rows and sums per ``by``."""
    return windows.groupBy(*by).agg(F.count(F.lit(1)).alias(count_as),
                                    *[F.sum(c).alias(a) for c, a in sums.items()])


def top_n(df: DataFrame, measure: str, n: int, tiebreak: Sequence[str]) -> DataFrame:
    """Top ``n`` rows by ``measure`` with a unique tie-breaker (T05, D5): TakeOrderedAndProject."""
    return df.orderBy(F.desc(measure), *tiebreak).limit(n)

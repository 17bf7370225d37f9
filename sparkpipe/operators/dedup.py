"""Deduplication and latest-row-per-key.

``row_number() OVER (PARTITION BY key ORDER BY ...) = 1`` sorts every row of a key
inside one task, so a key holding a third of the data would land on one executor.
Instead the survivor is picked with an aggregate: ``min``/``max`` of a struct whose
leading fields are the ordering columns and whose remaining fields are the rest of
the row.  Aggregates combine map-side, so a hot key is reduced to one row per input
partition before the shuffle.  The order is total (remaining ties are broken by every
other column), so the survivor is deterministic.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _pick(df: DataFrame, keys: Sequence[str], order: Sequence[str], take: str) -> DataFrame:
    keys = list(keys)
    order = [c for c in order if c not in keys]
    rest = [c for c in df.columns if c not in keys and c not in order]
    fields = order + rest
    packed = F.struct(*[F.col(c).alias(f"f{i}") for i, c in enumerate(fields)])
    agg = F.min(packed) if take == "first" else F.max(packed)
    picked = df.groupBy(*keys).agg(agg.alias("_row"))
    return picked.select(
        *[F.col(c) if c in keys else F.col(f"_row.f{fields.index(c)}").alias(c) for c in df.columns]
    )


def dedup(df: DataFrame, keys: Sequence[str], order: Sequence[str] | None = None) -> DataFrame:
    """Keep one row per key: the smallest by ``order`` then by all other columns.

    ``order`` is mandatory in spirit (D1): without it the survivor is still the
    smallest row by all non-key columns, never an arbitrary one.
    """
    return _pick(df, keys, list(order or []), "first")


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Latest row per key by ``order`` descending (T06): the ``max`` of the packed row."""
    return _pick(df, keys, order, "last")

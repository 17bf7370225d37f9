"""Joins (J01-J06) with a size-checked broadcast.

A side is broadcast only when its size is proven small:

1. Catalyst's size estimate of the optimised plan.  Without cost-based statistics the
   estimate is an upper bound for scans, filters, projections, aggregates and joins
   (a filter keeps the child's size, a join is bounded by the product), so a small
   estimate is a proof and costs no job.  Plans that can grow rows (``explode``) are
   not trusted.
2. Otherwise a bounded measurement: read at most ``max_rows + 1`` rows (``limit`` stops the
   scan early) and add up their bytes, so the check never grows with the data.

Beyond the bound the join is left to the planner (sort-merge / shuffle-hash, with AQE
free to convert at runtime from real sizes).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# A lookup larger than this is not treated as a dimension.
DEFAULT_BROADCAST_ROWS = 100_000
DEFAULT_BROADCAST_BYTES = 10 * 1024 * 1024
# A column file may be so many times smaller than its rows in memory.
DECOMPRESSION = 8
_ROW_GROWING = ("Generate", "Expand")


def estimated_bytes(df: DataFrame) -> int | None:
    """Catalyst's upper-bound size estimate of ``df``, or None when it cannot be trusted."""
    plan = df._jdf.queryExecution().optimizedPlan()
    text = plan.toString()
    if any(op in text for op in _ROW_GROWING):
        return None
    return int(str(plan.stats().sizeInBytes()))


def fits_broadcast(df: DataFrame, max_rows: int = DEFAULT_BROADCAST_ROWS,
                   max_bytes: int = DEFAULT_BROADCAST_BYTES) -> bool:
    """True when ``df`` is proven small in bytes.

    A trusted estimate must stay below ``max_bytes`` with a margin for compressed files.
    Otherwise at most ``max_rows + 1`` rows are measured: there must be no more than
    ``max_rows`` and they must take no more than ``max_bytes``.
    """
    est = estimated_bytes(df)
    if est is not None and est * DECOMPRESSION <= max_bytes:
        return True
    head = df.limit(max_rows + 1)
    fixed = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.NumericType, T.BooleanType, T.DatetimeType))]
    rest = [c for c in df.columns if c not in fixed]
    width = F.lit(16 * len(fixed))
    if rest:
        width = width + F.coalesce(F.octet_length(F.to_json(F.struct(*(F.col(f"`{c}`") for c in rest)))), F.lit(0))
    rows, size = head.agg(F.count(F.lit(1)), F.coalesce(F.sum(width), F.lit(0))).first()
    return rows <= max_rows and size <= max_bytes


def small_side(df: DataFrame, max_rows: int = DEFAULT_BROADCAST_ROWS,
               max_bytes: int = DEFAULT_BROADCAST_BYTES) -> DataFrame:
    """Mark ``df`` for broadcast if the check passes, else return it as is."""
    return F.broadcast(df) if fits_broadcast(df, max_rows, max_bytes) else df


def lookup_join(fact: DataFrame, dim: DataFrame, on, how: str = "inner",
                max_rows: int = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """Fact -> dimension join; the dimension is broadcast when proven small."""
    return fact.join(small_side(dim, max_rows), on, how)


def role_join(fact: DataFrame, dim: DataFrame, fact_key: str, dim_key: str,
              prefix: str, how: str = "inner", max_rows: int = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """Join the same dimension in a named role (J02): its columns get ``prefix``."""
    renamed = dim.select(*[F.col(c).alias(f"{prefix}{c}") for c in dim.columns])
    side = small_side(renamed, max_rows)
    return fact.join(side, fact[fact_key] == side[f"{prefix}{dim_key}"], how)


def anti_join(left: DataFrame, right: DataFrame, on) -> DataFrame:
    """Rows of ``left`` with no match in ``right`` (J04, the NOT MATCHED branch)."""
    return left.join(right, on, "left_anti")

"""Ordered per-key sequence operators that survive a hot key (W03-W05, X07 in batch).

A plain ``Window.partitionBy(key).orderBy(ts)`` puts every row of a key in one task.
With a handful of keys (six ticker symbols, 25 locations) one key can hold a third of
100 TB.  These operators split each key by a time bucket, shuffle the rows once by
``(key, bucket)`` and stitch the buckets back together exactly:

A bucket of more than ``max_rows`` rows (one hot minute of one key) is cut further: a sample of
its rows, taken by the hash of their order columns, gives cut points about ``max_rows`` rows
apart, and the rows between two cut points are a bucket of their own, whatever times they
have.  Which buckets are that full is counted first, map-side combined, unless the whole
input is no more than a task's work.

* ``previous_row`` — every bucket gets one carry row, the last row of the latest earlier
  non-empty bucket of the same key; one ``lag`` per bucket then sees it before the
  bucket's first row.  The carry rows come from a map-side combined aggregate with one
  row per ``(key, bucket)``: their number follows the time span, not the row count.
* ``trailing_range_max`` — a ``RANGE`` window no longer than one bucket; rows near the
  end of a bucket are also sent to the next bucket as read-only context (a halo).
* ``session_windows`` — sessions are cut and reduced inside each bucket; only the first
  and the last piece of a bucket can continue in a neighbour, so only those are stitched
  per key.  All other pieces are final.
"""

from __future__ import annotations

from collections.abc import Sequence

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .joins import small_side

BUCKET, SUB = "_bucket", "_sub"
#: Rows of a bucket, and sampled rows from one cut point to the next.
MAX_ROWS, SAMPLES = 1_000_000, 50
#: An input of so few bytes a row of a bucket is one task's work in any case.
LEAST_ROW_BYTES = 8
#: Cut points that are compared one by one.
CUTS = 32


def _bucketed(df: DataFrame, ts: str, unit: str) -> DataFrame:
    return df.withColumn(BUCKET, F.date_trunc(unit, F.col(ts)).cast("timestamp_ntz"))


def input_bytes(df: DataFrame) -> int:
    """Size of what the plan of ``df`` reads: Catalyst's sizes of its leaves, no job."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    return sum(int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size()))


def _same(keys: Sequence[str], prefix: str) -> Column:
    return reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"{prefix}{k}")) for k in keys])


def _cut_points(rows: DataFrame, hot: DataFrame, group: Sequence[str], order: Sequence[str], max_rows: int) -> DataFrame:
    """``_of_`` + group columns and _cuts of every hot bucket: its cut points in order, in blocks of CUTS."""
    of = hot.select(*[F.col(k).alias(f"_of_{k}") for k in group])
    sample = rows.where(F.pmod(F.xxhash64(*order), F.lit(max_rows)) < SAMPLES).select(*group, F.struct(*order).alias("_at"))
    found = sample.join(small_side(of), _same(group, "_of_")).groupBy(*[f"_of_{k}" for k in group]).agg(
        F.sort_array(F.collect_list("_at")).alias("_at"))
    cuts = F.filter("_at", lambda x, i: (i + 1) % SAMPLES == 0)
    blocks = F.transform(F.sequence(F.lit(0), F.floor((F.size("_cuts") - 1) / CUTS)),
                         lambda b: F.slice("_cuts", (b * CUTS + 1).cast("int"), F.lit(CUTS)))
    return found.select(*[f"_of_{k}" for k in group], cuts.alias("_cuts")).where(F.size("_cuts") > 0) \
        .withColumn("_cuts", blocks)


def _bounded(rows: DataFrame, keys: Sequence[str], order: Sequence[str], max_rows: int) -> tuple[DataFrame, list[str]]:
    """``rows`` with buckets of about ``max_rows`` rows at most, and the columns that name a bucket in order."""
    if input_bytes(rows) <= max_rows * LEAST_ROW_BYTES:
        return rows, [BUCKET]
    group = [*keys, BUCKET]
    hot = rows.groupBy(*group).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > max_rows)
    if hot.isEmpty():
        return rows, [BUCKET]
    # hot buckets, and with them cut points, are at most one for each max_rows rows
    cuts = small_side(_cut_points(rows, hot, group, order, max_rows))
    me = F.struct(*order)
    block = F.size(F.filter(F.transform("_cuts", lambda b: b[0]), lambda c: c <= me))
    inside = F.size(F.filter(F.get("_cuts", block - 1), lambda c: c <= me))
    sub = F.when(F.col("_cuts").isNull() | (block == 0), 0).otherwise((block - 1) * CUTS + inside)
    split = rows.join(cuts, _same(group, "_of_"), "left").withColumn(SUB, sub).select(*rows.columns, SUB)
    return split, [BUCKET, SUB]


def previous_row(df: DataFrame, keys: Sequence[str], order: Sequence[str], columns: Sequence[str],
                 prefix: str = "prev_", bucket_unit: str = "minute", max_rows: int = MAX_ROWS) -> DataFrame:
    """Add ``prefix + c`` = value of ``c`` on the previous row of the same key.

    ``order[0]`` must be the event time; the full ``order`` must be a total order
    within a key (append a unique id).  The first row of a key gets NULLs.  NULL keys are
    one key; rows without an event time come first.
    """
    keys, order, columns = list(keys), list(order), list(columns)
    rows, bucket = _bounded(_bucketed(df, order[0], bucket_unit), keys, order, max_rows)
    carried = list(dict.fromkeys(order + columns))
    last = F.max(F.struct(*[F.col(c) for c in carried]))
    by_key = Window.partitionBy(*keys).orderBy(*bucket)
    carry = (rows.groupBy(*keys, *bucket).agg(last.alias("_last"))
                 .withColumn("_last", F.lag("_last").over(by_key))
                 .filter(F.col("_last").isNotNull())
                 .select(*keys, *bucket, *[F.col("_last")[c].alias(c) for c in carried if c not in keys],
                         F.lit(True).alias("_carry")))
    both = rows.withColumn("_carry", F.lit(False)).unionByName(carry, allowMissingColumns=True)
    w = Window.partitionBy(*keys, *bucket).orderBy(F.desc("_carry"), *order)
    return (both.withColumns({f"{prefix}{c}": F.lag(c).over(w) for c in columns})
                .filter(~F.col("_carry")).drop("_carry", *bucket))


def trailing_range_max(df: DataFrame, keys: Sequence[str], ts: str, value: str, seconds: int,
                       out: str, bucket_unit: str = "hour") -> DataFrame:
    """``max(value)`` over rows of the same key with ``ts - seconds <= t <= ts``.

    Exact as long as ``seconds`` is at most one bucket.  Rows within ``seconds`` of the
    next bucket are also sent there as halo rows, which are dropped after the window.
    """
    unit_seconds = {"minute": 60, "hour": 3600, "day": 86400}[bucket_unit]
    if seconds > unit_seconds:
        raise ValueError("range longer than one bucket")
    own = F.date_trunc(bucket_unit, F.col(ts)).cast("timestamp_ntz")
    following = F.timestamp_add("SECOND", F.lit(unit_seconds), own).cast("timestamp_ntz")
    near_end = F.col(ts) >= F.timestamp_add("SECOND", F.lit(-seconds), following)
    both = df.select("*", F.posexplode(F.when(near_end, F.array(own, following)).otherwise(F.array(own)))
                     .alias("_halo", BUCKET))
    w = (Window.partitionBy(*keys, BUCKET)
         .orderBy(F.unix_micros(F.col(ts).cast("timestamp")))
         .rangeBetween(-seconds * 1_000_000, 0))
    return (both.withColumn(out, F.max(value).over(w))
                .filter(F.col("_halo") == 0)
                .drop("_halo", BUCKET))


def session_windows(df: DataFrame, keys: Sequence[str], order: Sequence[str], gap_seconds: int,
                    bucket_unit: str = "hour", max_rows: int = MAX_ROWS) -> DataFrame:
    """One row per (key, session): start, end (= last event + gap) and row count.

    A new session starts when ``ts > previous ts + gap``.  Two exchanges: the rows by
    ``(key, bucket)``, then the reduced pieces by key and, for the pieces that cannot
    continue in another bucket, by themselves.
    """
    keys, order = list(keys), list(order)
    ts = order[0]

    def starts(at: str, previous: str):
        new = F.col(at) > F.timestamp_add("SECOND", F.lit(gap_seconds), F.col(previous))
        return (F.col(previous).isNull() | new).cast("int")

    rows, bucket = _bounded(_bucketed(df.select(*keys, *order), ts, bucket_unit), keys, order, max_rows)
    w = Window.partitionBy(*keys, *bucket).orderBy(*order)
    cut = (rows
           .withColumn("_prev", F.lag(ts).over(w))
           .withColumn("_piece", F.sum(starts(ts, "_prev")).over(w.rowsBetween(Window.unboundedPreceding, 0))))
    pieces = cut.groupBy(*keys, *bucket, "_piece").agg(F.min(ts).alias("_from"), F.max(ts).alias("_to"),
                                                      F.count(F.lit(1)).alias("_rows"))
    in_bucket = Window.partitionBy(*keys, *bucket).orderBy("_piece")
    inner = (F.col("_piece") > 1) & F.lead("_piece").over(in_bucket).isNotNull()
    own = pieces.withColumn("_own", F.when(inner, F.struct(*bucket, "_piece")))
    by_key = Window.partitionBy(*keys, "_own").orderBy(*bucket, "_piece")
    linked = (own.withColumn("_prev", F.lag("_to").over(by_key))
                 .withColumn("_no", F.sum(starts("_from", "_prev"))
                             .over(by_key.rowsBetween(Window.unboundedPreceding, 0))))
    return (linked.groupBy(*keys, "_own", "_no")
                  .agg(F.min("_from").alias("session_start"),
                       F.timestamp_add("SECOND", F.lit(gap_seconds), F.max("_to")).alias("session_end"),
                       F.sum("_rows").alias("num_trips"))
                  .drop("_own", "_no"))

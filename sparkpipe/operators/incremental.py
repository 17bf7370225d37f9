"""Incremental publishing strategies on partitioned parquet.

Every strategy touches only the partitions it must: the target is read with a predicate on
its partition column (``PartitionFilters``), so a merge into a 100 TB table scans the days
the batch covers, not the table.

A target is a ``SnapshotTable`` or a path.  A snapshot table publishes by one rename: readers
see the old rows or the new ones, also if the job dies half-way.  A path is a folder of plain
partitions: replaced ones are staged under the shared checkpoint folder, swapped in with
dynamic partition overwrite (a path is never overwritten while the same job reads it), and
partitions that end up empty are dropped as folders; a job that dies between these steps
leaves some partitions new and some old.

A key may move to another partition: the merges look for the batch's keys in the whole
target (key and partition column only) and rewrite the partitions they find.  Where the
partition column is a function of the key (e.g. the day of a pickup time inside the key),
``keys_move=False`` leaves it at the batch's own partitions.  NULL is a key and a partition
like any other: a NULL key matches NULL.
"""

from __future__ import annotations

import datetime as dt
import functools
from collections.abc import Callable, Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import scratch_path
from ..sinks.snapshots import SnapshotTable
from ..sinks.writers import (NULL_PARTITION, balanced_for_write, delete_path, drop_partitions, list_partition_values,
                             path_exists)
from .dedup import latest_per_key


def append(df: DataFrame, path: str, partition_col: str | None = None) -> None:
    """``append`` (M01): add rows; re-runs duplicate them, dedup is downstream."""
    if partition_col:
        balanced_for_write(df, partition_col).write.mode("append").partitionBy(partition_col).parquet(path)
    else:
        df.write.mode("append").parquet(path)


def full_refresh(df: DataFrame, path: str, partition_col: str | None = None) -> None:
    """Create or replace."""
    if partition_col:
        df = balanced_for_write(df, partition_col)
    w = df.write.mode("overwrite").option("partitionOverwriteMode", "static")
    if partition_col:
        w = w.partitionBy(partition_col)
    w.parquet(path)


def _once(df: DataFrame) -> DataFrame:
    """Evaluate a batch once: a reliable checkpoint under ``spark.checkpoint.dir`` cuts its
    lineage, so the range probe, the semi/anti joins and the write all read the same rows
    (a non-deterministic source cannot change between them) and a lost executor re-reads
    the checkpoint instead of recomputing the source."""
    return df.checkpoint(eager=True)


def _values(*frames: DataFrame) -> dict:
    """Different partition values of the frames, each with its text: folder names, not rows, so they fit the driver."""
    out = {}
    for df in frames:
        (c,) = df.columns
        out.update((r[0], r[1]) for r in df.distinct().select(c, F.col(c).cast("string")).collect())
    return out


def _in_partitions(partition_col: str, values: Iterable[object]):
    """Partition filter that prunes folders; covers NULL."""
    values = list(values)
    known = [v for v in values if v is not None]
    cond = F.col(partition_col).isin(known) if known else F.lit(False)
    return cond | F.col(partition_col).isNull() if len(known) < len(values) else cond


def _matching(rows: DataFrame, keys: DataFrame, key: Sequence[str], how: str) -> DataFrame:
    """Semi or anti join on the key; NULL equals NULL."""
    other = keys.select(*[F.col(k).alias(f"_key{i}") for i, k in enumerate(key)]).distinct()
    same = functools.reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_key{i}")) for i, k in enumerate(key)])
    return rows.join(other, same, how)


def _touched(tgt: DataFrame, source: DataFrame, key: Sequence[str], partition_col: str, keys_move: bool) -> dict:
    """Partitions of the batch and, if keys can move, of the target rows with its keys."""
    own = source.select(partition_col)
    if not keys_move:
        return _values(own)
    hit = _matching(tgt.select(*dict.fromkeys([*key, partition_col])), source, key, "left_semi")
    return _values(own, hit.select(partition_col))


def _read_target(spark: SparkSession, target_path: str, source: DataFrame, partition_col: str) -> DataFrame:
    """The target, its partition column in the batch's type: guessed from folder names, '007' would become 7."""
    found = spark.read.parquet(target_path).schema
    kinds = [source.schema[f.name] if f.name == partition_col else f for f in found.fields]
    return spark.read.schema(T.StructType(kinds)).parquet(target_path)


class FolderTable:
    """A folder of plain partitions behind the same methods as ``SnapshotTable``."""

    def __init__(self, spark: SparkSession, path: str, partition_col: str | None):
        self.spark, self.path, self.partition_col = spark, path, partition_col

    def exists(self) -> bool:
        if self.partition_col:
            return bool(list_partition_values(self.spark, self.path, self.partition_col))
        return path_exists(self.spark, self.path)

    def read_as(self, source: DataFrame) -> DataFrame:
        if self.partition_col:
            return _read_target(self.spark, self.path, source, self.partition_col)
        return self.spark.read.parquet(self.path)

    def append(self, rows: DataFrame) -> None:
        append(rows, self.path, self.partition_col)

    def replace(self, rows: DataFrame, values: Iterable[str | None]) -> None:
        """Stage ``rows`` then overwrite exactly their partitions; drop touched ones left empty."""
        stage = scratch_path(self.spark, "stage")
        balanced_for_write(rows, self.partition_col).write.mode("overwrite").partitionBy(self.partition_col).parquet(stage)
        present = set(list_partition_values(self.spark, stage, self.partition_col))
        if present:
            (self.spark.read.schema(rows.schema).parquet(stage).write.mode("overwrite")
                 .option("partitionOverwriteMode", "dynamic").partitionBy(self.partition_col).parquet(self.path))
        drop_partitions(self.spark, self.path, self.partition_col, [v for v in values if (v or NULL_PARTITION) not in present])
        delete_path(self.spark, stage)


class _SnapshotTarget:
    """A snapshot table with the writer and token of this run, if there are any."""

    def __init__(self, table: SnapshotTable, run: tuple[str, int] | None):
        self.table, self.run = table, run or (None, None)
        self.exists = table.exists

    def read_as(self, source: DataFrame) -> DataFrame:
        return self.table.read()

    def append(self, rows: DataFrame) -> None:
        self.table.append(rows, *self.run)

    def replace(self, rows: DataFrame, values: Iterable[str | None]) -> None:
        self.table.replace(rows, values, *self.run)


def _target(spark: SparkSession, target: str | SnapshotTable, partition_col: str | None, run: tuple[str, int] | None = None):
    if not isinstance(target, SnapshotTable):
        return FolderTable(spark, target, partition_col)
    if target.partition_col != partition_col:
        raise ValueError(f"{target.path} is partitioned by {target.partition_col}, not {partition_col}")
    return _SnapshotTarget(target, run)


def merge_insert_only(spark: SparkSession, source: DataFrame, target_path: str | SnapshotTable, key: Sequence[str],
                      partition_col: str | None = None, keys_move: bool = True) -> None:
    """Insert-only MERGE (M04, J04): rows whose key is absent from the target are appended.

    Duplicates inside one batch are kept (D2); dedup the source first if unwanted.
    """
    key = list(key)
    source = _once(source)
    if source.isEmpty():
        return
    table = _target(spark, target_path, partition_col)
    if not table.exists():
        table.append(source)
        return
    tgt = table.read_as(source)
    if partition_col and not keys_move:
        tgt = tgt.filter(_in_partitions(partition_col, _values(source.select(partition_col))))
    table.append(_matching(source, tgt, key, "left_anti"))


def merge_upsert(spark: SparkSession, source: DataFrame, target_path: str | SnapshotTable, key: Sequence[str],
                 partition_col: str, order: Sequence[str] | None = None, keys_move: bool = True,
                 run: tuple[str, int] | None = None) -> None:
    """``merge`` upsert (M05, K14): matched keys take the source row, the rest are inserted.

    With ``order`` the source is first reduced to its latest row per key; without it a key
    that occurs twice in the source is an error.  ``run`` names the writer and the number of
    its batch: a snapshot table takes each batch once, whoever repeats it.
    """
    key = list(key)
    if run and isinstance(target_path, SnapshotTable) and target_path.done(*run):
        return
    src = _once(latest_per_key(source, key, order) if order else source)
    if not order and not src.groupBy(*key).count().where("count > 1").isEmpty():
        raise ValueError(f"the batch has a key {key} twice; give an order")
    _replace(src, _target(spark, target_path, partition_col, run), key, partition_col, keys_move)


def delete_insert(spark: SparkSession, source: DataFrame, target_path: str | SnapshotTable, key: Sequence[str],
                  partition_col: str, keys_move: bool = True) -> None:
    """``delete+insert`` (M06): every target row whose (non-unique) key occurs in the source
    is deleted, then all source rows are inserted."""
    _replace(_once(source), _target(spark, target_path, partition_col), list(key), partition_col, keys_move)


def _replace(src: DataFrame, table, key: list[str], partition_col: str, keys_move: bool) -> None:
    if src.isEmpty():
        return
    if not table.exists():
        table.append(src)
        return
    tgt = table.read_as(src)
    touched = _touched(tgt, src, key, partition_col, keys_move)
    kept = _matching(tgt.filter(_in_partitions(partition_col, touched)), src, key, "left_anti")
    table.replace(kept.unionByName(src), touched.values())


def _as_datetime(v) -> dt.datetime:
    if isinstance(v, dt.datetime):
        return v
    if isinstance(v, dt.date):
        return dt.datetime(v.year, v.month, v.day)
    return dt.datetime.fromisoformat(str(v))


def time_interval_refresh(spark: SparkSession, new_rows: DataFrame, target_path: str | SnapshotTable, ts_col: str,
                          start, end, partition_col: str, granularity: str = "timestamp") -> None:
    """``time_interval`` (M02): replace rows with ``start <= ts < end`` by the recomputed ones.

    The touched partitions, whatever their grain, are those of the new rows and of the target's
    rows inside the interval.  They are rewritten as (their rows outside the interval, or
    without a time) ∪ (new rows inside it); partitions left with no rows are dropped.  With
    ``granularity='date'`` the bounds are whole days.
    """
    s, e = _as_datetime(start), _as_datetime(end)
    if granularity == "date":
        s = dt.datetime(s.year, s.month, s.day)
        e = dt.datetime(e.year, e.month, e.day)
    if s >= e:
        return
    ts_type = new_rows.schema[ts_col].dataType
    inside = (F.col(ts_col) >= F.lit(s).cast(ts_type)) & (F.col(ts_col) < F.lit(e).cast(ts_type))
    new = _once(new_rows.filter(inside))
    table = _target(spark, target_path, partition_col)
    if not table.exists():
        table.append(new)
        return
    tgt = table.read_as(new)
    touched = _values(new.select(partition_col), tgt.filter(inside).select(partition_col))
    kept = tgt.filter(_in_partitions(partition_col, touched)).filter(~F.coalesce(inside, F.lit(False)))
    table.replace(kept.unionByName(new.select(*tgt.columns)), touched.values())


# -------------------------------------------------------------- month planning
def month_plan(df: DataFrame, group: Sequence[str], start_col: str, end_col: str, cap: str | None = None,
               max_months: int | None = None, inclusive_end: bool = False) -> DataFrame:
    """Month starts from ``start`` to ``end`` per group (M08), capped at ``cap``.

    The end is exclusive unless ``inclusive_end`` (D18).  More than ``max_months`` months
    fails the job with ``raise_error`` — the guard runs in the executors.
    """
    first = F.trunc(F.to_date(start_col), "month")
    end_day = F.col(end_col)
    end_month = F.trunc(F.to_date(end_day), "month")
    if inclusive_end:
        last = end_month
    else:
        last = F.when(end_day.cast("timestamp_ntz") == end_month.cast("timestamp_ntz"),
                      F.add_months(end_month, -1)).otherwise(end_month)
    if cap:
        last = F.least(last, F.trunc(F.lit(cap).cast("date"), "month"))
    months = F.when(last >= first, F.sequence(first, last, F.expr("INTERVAL 1 MONTH"))) \
              .otherwise(F.array().cast("array<date>"))
    planned = df.select(*group, months.alias("months"))
    if max_months is not None:
        planned = planned.withColumn("months", F.when(
            F.size("months") > max_months,
            F.raise_error(F.lit(f"more than {max_months} months requested"))).otherwise(F.col("months")))
    return planned.select(*group, F.posexplode("months").alias("month_index", "month_start"))


def chunk_plan(months: DataFrame, group: Sequence[str], chunk_months: int) -> DataFrame:
    """Month-chunked backfill plan (M09): chunk start, exclusive end, first chunk = full refresh."""
    chunk = F.floor(F.col("month_index") / F.lit(chunk_months)).cast("int")
    return (months.groupBy(*group, chunk.alias("chunk_no"))
                  .agg(F.min("month_start").alias("chunk_start"),
                       F.add_months(F.max("month_start"), 1).alias("chunk_end"))
                  .withColumn("full_refresh", F.col("chunk_no") == 0))


def backfill(start: dt.date, end: dt.date, chunk_months: int, job: Callable[[dt.date, dt.date, bool], None],
             cap: dt.date | None = None, dry_run: bool = False) -> list[tuple[dt.date, dt.date, bool]]:
    """Run ``job(chunk_start, chunk_end, full_refresh)`` per chunk of at most ``chunk_months``.

    Start is floored to its month, the inclusive end becomes exclusive, the inclusive cap
    bounds it; each chunk is one distributed Spark job.  ``dry_run`` only returns the chunks.
    """
    s = dt.date(start.year, start.month, 1)
    if chunk_months < 1:
        raise ValueError("chunk_months must be 1 or more")
    if end < start:
        raise ValueError("the end lies before the start")
    e = (min(end, cap) if cap else end) + dt.timedelta(days=1)
    chunks = []
    cur = s
    while cur < e:
        m = cur.month - 1 + chunk_months
        nxt = dt.date(cur.year + m // 12, m % 12 + 1, 1)
        stop = min(nxt, e)
        chunks.append((cur, stop, not chunks))
        cur = stop
    if not dry_run:
        for c in chunks:
            job(*c)
    return chunks


def backfill_table(table: SnapshotTable, rows: Callable[[dt.date, dt.date], DataFrame], start: dt.date, end: dt.date,
                   chunk_months: int, run: str, cap: dt.date | None = None) -> list[tuple[dt.date, dt.date, bool]]:
    """A backfill that can be resumed (M09): ``rows(chunk_start, chunk_end)`` of each chunk is published once.

    The first chunk replaces what the table holds, the others are added.  The table's versions
    are the ledger: each names the last chunk of ``run`` that it holds, and is committed
    together with the chunk's files.  The same ``run`` started again goes on behind that chunk;
    a new ``run`` begins anew.  Returns the chunks that this call published.
    """
    done = []

    def job(lo: dt.date, hi: dt.date, full: bool) -> None:
        number = chunks.index((lo, hi, full))
        if table.done(run, number):
            return
        (table.overwrite if full else table.append)(rows(lo, hi), run, number)
        done.append((lo, hi, full))

    chunks = backfill(start, end, chunk_months, job, cap, dry_run=True)
    for c in chunks:
        job(*c)
    return done

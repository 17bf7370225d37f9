"""Incremental loads run end to end on partitioned parquet.

Each query builds a target under the shared checkpoint folder from the test tables,
applies one strategy, and returns the published table read back — the "expected final
state" the oracle computes in SQL.  Scenarios are time-based, as real incremental loads
are: the target holds history up to a date, the batch covers an overlapping window.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import round_half_up
from ..functions.keys import row_hash
from ..operators import incremental as inc
from ..session import scratch_path
from ..sinks.snapshots import SnapshotTable
from ..sinks.writers import write_clustered
from ..sources.files import read_table
from . import bindings as B
from .questions import RANGE_END, RANGE_START

ORDER_COLS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]
HASH_COLS = ORDER_COLS                      # F01: with the amount
SHORT_HASH_COLS = ["o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority"]   # F02: without it
TARGET_UNTIL = "2000-01-01"                 # target history: orders before this day
BATCH_FROM = "1999-07-01"   # the batch overlaps the history by half a year and runs to the end of the data
SECOND_BATCH = "2000-07-01"   # the batch's first half ends here
INTERVAL_START, INTERVAL_END = "2024-01-10 12:00:00", "2024-01-13 06:00:00"   # mid-day bounds (M02)
PLAN_CAP, PLAN_MAX_MONTHS, CHUNK_MONTHS = "2001-06-01", 120, 3


def hashed_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read_table(spark, sf_dir, "orders").select(*ORDER_COLS)
    return o.withColumns({
        "unique_row_id": row_hash(HASH_COLS, o),
        "order_month": F.trunc(F.to_date("o_orderdate"), "month"),
    })


def row_hash_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Row hashes over two column sets, NULL as '' and no separator."""
    o = read_table(spark, sf_dir, "orders")
    return o.select("o_orderkey", row_hash(HASH_COLS, o).alias("unique_row_id"),
                    row_hash(SHORT_HASH_COLS, o).alias("short_row_id"))


def _in(c: str, lo: str, hi: str | None = None):
    cond = F.col(c) >= F.lit(lo).cast("timestamp_ntz")
    return cond if hi is None else cond & (F.col(c) < F.lit(hi).cast("timestamp_ntz"))


def _history_and_batch(spark: SparkSession, sf_dir: str):
    h = hashed_orders(spark, sf_dir)
    target = h.filter(F.col("o_orderdate") < F.lit(TARGET_UNTIL).cast("timestamp_ntz"))
    return target, h.filter(_in("o_orderdate", BATCH_FROM))


def _snapshots(spark: SparkSession, rows: DataFrame, partition_col: str) -> SnapshotTable:
    """A new snapshot table that holds ``rows``."""
    table = SnapshotTable(spark, scratch_path(spark, "snapshots"), partition_col)
    table.overwrite(rows)
    return table


def _read_back(spark: SparkSession, path: str, cols) -> DataFrame:
    return spark.read.parquet(path).select(*cols)


def merge_insert_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stage -> hash -> insert-only merge (M04, M07): only unseen row hashes are appended."""
    history, batch = _history_and_batch(spark, sf_dir)
    path = scratch_path(spark, "orders_target")
    inc.full_refresh(history, path, "order_month")
    inc.merge_insert_only(spark, batch, path, ["unique_row_id"], "order_month", keys_move=False)
    return _read_back(spark, path, ORDER_COLS + ["unique_row_id"])


def corrected_batch(batch: DataFrame) -> DataFrame:
    """The batch as a later extract: orders closed ('F') and amounts corrected by 1 %."""
    return batch.withColumns({
        "o_orderstatus": F.lit("F"),
        "o_totalprice": round_half_up(F.col("o_totalprice") * F.lit(1.01), 2),
    })


def merge_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Upsert by order key (M05): matched orders take the batch row, new ones are inserted.

    The snapshot table shows the merge as a whole (one rename).
    """
    history, batch = _history_and_batch(spark, sf_dir)
    table = _snapshots(spark, history, "order_month")
    inc.merge_upsert(spark, corrected_batch(batch), table, ["o_orderkey"], "order_month",
                     order=["o_orderdate", "o_totalprice"])
    return table.read().select(*ORDER_COLS)


def snapshot_time_travel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An older snapshot (M03, M05): the orders as they were between two upserts."""
    history, batch = _history_and_batch(spark, sf_dir)
    table = _snapshots(spark, history, "order_month")
    first = F.col("o_orderdate") < F.lit(SECOND_BATCH).cast("timestamp_ntz")
    for part in (batch.filter(first), batch.filter(~first)):
        inc.merge_upsert(spark, corrected_batch(part), table, ["o_orderkey"], "order_month",
                         order=["o_orderdate", "o_totalprice"])
    return table.read(version=table.versions()[-2]).select(*ORDER_COLS)


def merge_upsert_by_symbol(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Upsert into partitions named by symbol (M05): names that need escaping, keys that move to
    another symbol, and the NULL key, which is one key like any other."""
    ticks = B.tick_records(spark, sf_dir).select(
        F.when(F.col("event_id") % 100 != 7, F.col("event_id")).alias("tick_key"), "event_id", "symbol", "price")
    table = _snapshots(spark, ticks.filter(F.col("event_id") % 3 != 0), "symbol")
    moved = F.when(F.col("symbol") == "VIEW/USDT", "50%=VIEW: USDT").otherwise(F.col("symbol"))
    batch = ticks.filter(F.col("event_id") % 2 == 0).withColumns({"symbol": moved, "price": F.lit(0.0)})
    batch = batch.unionByName(ticks.filter(F.col("event_id") % 100 == 7))
    inc.merge_upsert(spark, batch, table, ["tick_key"], "symbol", order=["event_id"])
    return table.read()


def merge_upsert_moved_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Upsert of orders whose day moved by 31 days, so they leave their month's partition."""
    h = hashed_orders(spark, sf_dir).select(*ORDER_COLS, "order_month")
    path = scratch_path(spark, "orders_moved")
    inc.full_refresh(h, path, "order_month")
    moved = (h.filter(_in("o_orderdate", BATCH_FROM))
              .withColumn("o_orderdate", F.col("o_orderdate") + F.expr("INTERVAL 31 DAYS"))
              .withColumn("order_month", F.trunc(F.to_date("o_orderdate"), "month")))
    inc.merge_upsert(spark, moved, path, ["o_orderkey"], "order_month", order=["o_orderdate", "o_totalprice"])
    return _read_back(spark, path, ORDER_COLS)


def merge_null_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Upsert where a seventh of the orders has no partition value: none of them gets lost."""
    h = hashed_orders(spark, sf_dir).select(*ORDER_COLS, "order_month")
    month = F.when(F.col("o_orderkey") % 7 != 0, F.col("order_month"))
    h = h.withColumn("order_month", month)
    path = scratch_path(spark, "orders_null")
    inc.full_refresh(h.filter(F.col("o_orderkey") % 3 != 0), path, "order_month")
    inc.merge_upsert(spark, corrected_batch(h.filter(F.col("o_orderkey") % 2 == 0)), path, ["o_orderkey"], "order_month",
                     order=["o_orderdate", "o_totalprice"])
    return _read_back(spark, path, ORDER_COLS)


def interval_refresh_monthly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Time-interval replace of three days in a target partitioned by month."""
    trips = B.trips(spark, sf_dir).withColumn("pickup_part", F.trunc("pickup_datetime", "month"))
    path = scratch_path(spark, "trips_target")
    inc.full_refresh(trips, path, "pickup_part")
    _refresh(spark, trips, path)
    return _read_back(spark, path, trips.columns[:-1])


def delete_insert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Delete+insert by order day (M06): every target order on a batch day is replaced by
    the batch's orders of that day (here only the batch's 'O' orders, re-extracted)."""
    history, batch = _history_and_batch(spark, sf_dir)
    table = _snapshots(spark, history, "order_month")
    src = corrected_batch(batch.filter(F.col("o_orderstatus") == "O"))
    inc.delete_insert(spark, src, table, ["o_orderdate"], "order_month")
    return table.read().select(*ORDER_COLS)


def time_interval_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Time-interval replace with mid-day bounds (M02): trips partitioned by pickup day,
    the interval recomputed with corrected fares; edge days keep rows outside it."""
    trips = B.trips(spark, sf_dir).withColumn("pickup_part", F.to_date("pickup_datetime"))
    table = _snapshots(spark, trips, "pickup_part")
    _refresh(spark, trips, table)
    return table.read().select(*trips.columns[:-1])


def _refresh(spark: SparkSession, trips: DataFrame, target) -> None:
    recomputed = trips.withColumn("fare_amount", round_half_up(F.col("fare_amount") * F.lit(1.08), 2))
    inc.time_interval_refresh(spark, recomputed, target, "pickup_datetime", INTERVAL_START, INTERVAL_END,
                              "pickup_part", granularity="timestamp")


def months_to_process(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Months to load per service, from first to last order, capped."""
    o = read_table(spark, sf_dir, "orders")
    span = o.groupBy(F.col("o_orderstatus").alias("status")).agg(
        F.min("o_orderdate").alias("first_order"), F.max("o_orderdate").alias("last_order"))
    return inc.month_plan(span, ["status"], "first_order", "last_order", cap=PLAN_CAP,
                          max_months=PLAN_MAX_MONTHS)


def backfill_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chunks of at most three months per service; the first chunk is a full refresh."""
    return inc.chunk_plan(months_to_process(spark, sf_dir), ["status"], CHUNK_MONTHS)


def _optimized_lineitem(spark: SparkSession, sf_dir: str) -> str:
    li = read_table(spark, sf_dir, "lineitem").withColumn("dropoff_month", F.trunc(F.to_date("l_shipdate"), "month"))
    path = scratch_path(spark, "lineitem_optimized")
    write_clustered(li, path, "dropoff_month", ["l_shipdate", "l_suppkey"])
    return path


def _vendors_in_range(df: DataFrame) -> DataFrame:
    return (df.filter(F.col("l_shipdate").between(F.lit(RANGE_START).cast("timestamp_ntz"),
                                                  F.lit(RANGE_END).cast("timestamp_ntz")))
              .select(F.col("l_suppkey").alias("vendor_id")).distinct())


def _pruned(spark: SparkSession, path: str) -> DataFrame:
    return prune_by_month(spark.read.parquet(path), "dropoff_month", RANGE_START, RANGE_END)


def distinct_vendors_partitioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pruning pair (§4): same question as ``distinct_vendors_in_range`` on a copy
    partitioned by dropoff month and clustered by (dropoff day, vendor).

    The data spans seven years, so month folders (~85) keep files large; inside a folder
    rows are sorted by day, so parquet row-group min/max statistics skip the rest of
    the month.  A timestamp predicate does not prune a derived partition column, so the
    partition bounds are added explicitly (``prune_by_month``).
    """
    return _vendors_in_range(_pruned(spark, _optimized_lineitem(spark, sf_dir)))


def pruning_report(spark: SparkSession, sf_dir: str) -> dict:
    """Files and bytes the range question touches without and with the optimised layout."""
    def files(df: DataFrame):
        r = (df.select("_metadata.file_path", "_metadata.file_size").distinct()
               .agg(F.count(F.lit(1)).alias("n"), F.sum("file_size").alias("b")).first())
        return int(r["n"]), int(r["b"] or 0)
    plain = read_table(spark, sf_dir, "lineitem")
    path = _optimized_lineitem(spark, sf_dir)
    opt_all = spark.read.parquet(path)
    n0, b0 = files(plain)
    n1, b1 = files(opt_all)
    n2, b2 = files(_pruned(spark, path))
    return {"unpartitioned_files": n0, "unpartitioned_bytes": b0, "partitioned_total_files": n1,
            "partitioned_total_bytes": b1, "partitioned_read_files": n2, "partitioned_read_bytes": b2,
            "bytes_ratio": round(b0 / b2, 2) if b2 else None}


def prune_by_month(df: DataFrame, partition_col: str, start: str, end: str) -> DataFrame:
    """Add the month-partition bounds implied by a [start, end] time range."""
    lo = F.trunc(F.lit(start).cast("date"), "month")
    hi = F.trunc(F.lit(end).cast("date"), "month")
    return df.filter(F.col(partition_col).between(lo, hi))


QUERIES = {
    "row_hash": row_hash_query,
    "merge_insert_only": merge_insert_only,
    "merge_upsert": merge_upsert,
    "snapshot_time_travel": snapshot_time_travel,
    "merge_upsert_by_symbol": merge_upsert_by_symbol,
    "merge_upsert_moved_keys": merge_upsert_moved_keys,
    "merge_null_partition": merge_null_partition,
    "interval_refresh_monthly": interval_refresh_monthly,
    "delete_insert": delete_insert,
    "time_interval_refresh": time_interval_refresh,
    "months_to_process": months_to_process,
    "backfill_chunks": backfill_chunks,
    "distinct_vendors_partitioned": distinct_vendors_partitioned,
}

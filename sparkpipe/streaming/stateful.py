"""Stateful steps of a micro-batch over tables, one state per batch.

Each step is the batch operator over the batch's rows and the state that the batch before
left, so a busy symbol is spread over tasks as in the batch query.  A batch reads the latest
state before its own and writes its own, so a batch that runs again gives the same rows;
older states are dropped.  The clock is event time: the greatest time of any tick less a
delay, kept in the name of the state's folder.  Ticks that come behind what was already
published are kept in a side table.
"""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import monitor as M
from ..operators import ticks as TK
from ..operators.dedup import latest_per_key
from ..operators.joins import small_side
from ..sinks.writers import drop_partitions, list_partition_values

TICK_COLUMNS = ["symbol", "ts", "event_id", "price", "volume"]
CANDLE_MICROS = 60_000_000
_KIND = "_kind"


def at_once(spark: SparkSession, *steps: Callable[[], object]) -> None:
    """Run independent steps of a batch side by side; the first error is raised when all have ended."""
    with ThreadPoolExecutor(len(steps)) as pool:
        for done in [pool.submit(inheritable_thread_target(spark)(f)) for f in steps]:
            done.result()


def put(rows: DataFrame, path: str, batch_id: int) -> None:
    """A batch's own folder of an output; a batch that runs again replaces it."""
    rows.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")


class State:
    """What the batches before ``batch_id`` left in ``path/batch_id=<n>/clock=<microseconds>``."""

    def __init__(self, spark: SparkSession, path: str, batch_id: int):
        self.spark, self.path, self.batch_id = spark, path, batch_id
        known = sorted(int(n) for n in list_partition_values(spark, path, "batch_id"))
        self.before = [n for n in known if n < batch_id]
        self.clock = None
        if self.before:
            (clock,) = list_partition_values(spark, f"{path}/batch_id={self.before[-1]}", "clock")
            self.clock = int(clock) if clock else None

    def rows(self, schema) -> DataFrame:
        """The rows of the latest state; none before the first batch."""
        if not self.before:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(f"{self.path}/batch_id={self.before[-1]}/clock=*")

    def next_clock(self, newest: int | None, delay_seconds: int) -> int:
        """The clock after a batch with this greatest time: never back; before any time, the beginning."""
        now = [c for c in (self.clock, None if newest is None else newest - delay_seconds * 1_000_000) if c is not None]
        return max(now, default=-(1 << 62))

    def save(self, rows: DataFrame, clock: int) -> None:
        # a batch that ran half-way may have left another clock
        drop_partitions(self.spark, self.path, "batch_id", [self.batch_id])
        rows.write.mode("overwrite").parquet(f"{self.path}/batch_id={self.batch_id}/clock={clock}")
        drop_partitions(self.spark, self.path, "batch_id", self.before[:-1])


def newest_micros(ticks: DataFrame) -> int | None:
    """The greatest time of the ticks in microseconds; None if there is none."""
    return ticks.agg(F.max(F.unix_micros("ts"))).first()[0]


def with_late(ticks: DataFrame, last: DataFrame) -> DataFrame:
    """``ticks`` with _late: whether a tick comes before the one of its symbol in ``last``.

    The tables meet by the hash of the symbol: a broadcast with one long as its key takes the
    rows it has, one with a text key a whole memory page (16 to 64 MB) in every batch.
    """
    stored = last.select(F.xxhash64("symbol").alias("_hash"), F.col("symbol").alias("_of"), F.struct("ts", "event_id").alias("_last"))
    # not a second key of the join: equal hashes of different symbols are told apart
    same = F.coalesce(F.col("symbol") == F.col("_of"), F.lit(False))
    found = ticks.join(small_side(stored), (F.xxhash64("symbol") == F.col("_hash")) & same, "left")
    late = F.coalesce(F.struct("ts", "event_id") < F.col("_last"), F.lit(False))
    return found.select(*ticks.columns, late.alias("_late"))


def judge_ticks(batch: DataFrame, batch_id: int, path: str, state: str, late: str, delay_seconds: int = 0) -> None:
    """Previous-tick anomalies (X12) as ``path/batch_id=n``, in the order of event time.

    A reorder buffer in the state holds ticks newer than the clock; older ones are judged in
    order against the last judged tick of their symbol.  A tick that comes behind that one
    cannot be judged any more and goes to ``late/batch_id=n``.
    """
    spark = batch.sparkSession
    before = State(spark, state, batch_id)
    new = batch.select(*TICK_COLUMNS, F.lit("new").alias(_KIND))
    stored = before.rows(new.schema)
    last = stored.where(F.col(_KIND) == "last")
    rows = with_late(new.unionByName(stored.where(F.col(_KIND) == "waiting")), last).persist()
    try:
        clock = before.next_clock(newest_micros(rows.where(F.col(_KIND) == "new")), delay_seconds)
        due = F.unix_micros("ts") <= F.lit(clock)
        judged = rows.where(~F.col("_late") & due).select(*TICK_COLUMNS, F.lit(False).alias("_stored")) \
            .unionByName(last.select(*TICK_COLUMNS, F.lit(True).alias("_stored")))
        found = TK.detect_anomalies(judged, carry=["_stored"]).where(~F.col("_stored")).drop("_stored")
        left = (latest_per_key(judged.drop("_stored"), ["symbol"], ["ts", "event_id"]).withColumn(_KIND, F.lit("last"))
                .unionByName(rows.where(~F.col("_late") & ~due).select(*TICK_COLUMNS, F.lit("waiting").alias(_KIND))))
        at_once(spark, lambda: put(found, path, batch_id),
                lambda: put(rows.where("_late").select(*TICK_COLUMNS), late, batch_id),
                lambda: before.save(left, clock))
    finally:
        rows.unpersist()


def fold_candles(batch: DataFrame, batch_id: int, path: str, state: str, late: str, delay_seconds: int,
                 newest: int | None = None) -> None:
    """One-minute candles (X10) as ``path/batch_id=n``: a batch's ticks are folded into the open
    candles of the state, those that the clock has passed are published.  Ticks of a published
    candle go to ``late/batch_id=n``."""
    spark = batch.sparkSession
    before = State(spark, state, batch_id)
    clock = before.next_clock(newest_micros(batch) if newest is None else newest, delay_seconds)
    ticks = batch.select(*TICK_COLUMNS, F.date_trunc("minute", F.col("ts")).alias("start"))
    at = F.struct("ts", "event_id", "price")
    parts = ticks.select("symbol", "start", at.alias("first"), at.alias("last"), F.col("price").alias("high"),
                         F.col("price").alias("low"), "volume", F.lit(1).cast("long").alias("tick_count"))
    published = F.lit(False) if before.clock is None else F.unix_micros("start") + F.lit(CANDLE_MICROS) <= F.lit(before.clock)
    folded = (parts.where(~published).unionByName(before.rows(parts.schema)).groupBy("symbol", "start").agg(
        F.min("first").alias("first"), F.max("last").alias("last"), F.max("high").alias("high"), F.min("low").alias("low"),
        F.sum("volume").alias("volume"), F.sum("tick_count").alias("tick_count")).persist())
    try:
        done = F.unix_micros("start") + F.lit(CANDLE_MICROS) <= F.lit(clock)
        out = folded.where(done).select("symbol", F.col("start").alias("window_start"), F.col("first.price").alias("open"), "high",
                                        "low", F.col("last.price").alias("close"), "volume", "tick_count")
        at_once(spark, lambda: put(out, path, batch_id),
                lambda: put(ticks.where(published).select(*TICK_COLUMNS), late, batch_id),
                lambda: before.save(folded.where(~done).select(*parts.columns), clock))
    finally:
        folded.unpersist()


def watch_silence(batch: DataFrame, batch_id: int, closed: str, open_now: str, state: str,
                  seconds: int = M.SILENCE_SECONDS) -> None:
    """Silences of a symbol (W05, O05): ended ones as ``closed/batch_id=n``, those that last at the
    event-time clock as ``open_now/batch_id=n``.

    The clock is the greatest time of any symbol, so a symbol that sends nothing any more is
    reported by the batches of the others.  The state holds each symbol's last tick; a tick
    that comes behind it does not end a silence that was already judged.
    """
    spark = batch.sparkSession
    before = State(spark, state, batch_id)
    clock = before.next_clock(newest_micros(batch), 0)
    new = batch.select("symbol", "ts", "event_id")
    stored = before.rows(new.schema)
    rows = with_late(new, stored).where(~F.col("_late")).select(*new.columns).unionByName(stored).persist()
    try:
        latest = latest_per_key(rows, ["symbol"], ["ts", "event_id"])
        waited = (F.lit(clock) - F.unix_micros("ts")) / F.lit(1e6)
        still = latest.select("symbol", F.col("ts").alias("gap_start"), F.lit(None).cast("timestamp").alias("gap_end"),
                              waited.alias("gap_seconds")).where(F.col("gap_seconds") >= seconds)
        at_once(spark, lambda: put(M.silence_gaps(rows, seconds=seconds), closed, batch_id),
                lambda: put(still, open_now, batch_id), lambda: before.save(latest, clock))
    finally:
        rows.unpersist()

"""Structured Streaming jobs.

Each job is a function from a streaming DataFrame to a streaming DataFrame, plus a
writer helper.  Stateful operators keep their state in the state store (RocksDB) under
the query's checkpoint, so a restarted query or a lost executor resumes from the last
committed micro-batch (X15).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import round_half_up
from ..functions.timefn import epoch_ms_to_timestamp, parse_timestamp
from ..operators import incremental as inc
from ..operators import ticks as TK
from ..sinks.snapshots import SnapshotTable
from ..sinks.writers import JSON_TS_NTZ_FORMAT
from .sources import drain, stream_source
from .stateful import at_once, fold_candles, judge_ticks, put, watch_silence

RIDE_SCHEMA = T.StructType([
    T.StructField("trip_id", T.LongType()),
    T.StructField("PULocationID", T.IntegerType()),
    T.StructField("DOLocationID", T.IntegerType()),
    T.StructField("trip_distance", T.DoubleType()),
    T.StructField("total_amount", T.DoubleType()),
    T.StructField("tip_amount", T.DoubleType()),
    T.StructField("tpep_pickup_datetime", T.LongType()),      # epoch milliseconds
    T.StructField("lpep_pickup_datetime", T.StringType()),    # 'yyyy-MM-dd HH:mm:ss'
])

TICK_MESSAGE_SCHEMA = T.StructType([
    T.StructField("event_id", T.LongType()),
    T.StructField("key", T.StringType()),
    T.StructField("value", T.StringType()),
    T.StructField("ingest_ts", T.TimestampNTZType()),
])

WATERMARK = "5 seconds"
TICK_WATERMARK = "30 seconds"


# ----------------------------------------------------------------- rides
def ride_events(stream: DataFrame, clock: str = "epoch_ms") -> DataFrame:
    """Event-time column (X02): epoch ms (``TO_TIMESTAMP_LTZ``) or the green string time."""
    if clock == "epoch_ms":
        ts = epoch_ms_to_timestamp("tpep_pickup_datetime")
    else:
        ts = parse_timestamp("lpep_pickup_datetime", "yyyy-MM-dd HH:mm:ss")
    return stream.withColumn("event_timestamp", ts)


def pass_through(stream: DataFrame) -> DataFrame:
    """Stateless projection + epoch-ms conversion."""
    return ride_events(stream).select("trip_id", "PULocationID", "DOLocationID", "trip_distance",
                                      "total_amount", "event_timestamp")


def tumbling(stream: DataFrame, size: str, key: str | None = "PULocationID", clock: str = "epoch_ms",
             watermark: str = WATERMARK) -> DataFrame:
    """Tumbling windows per key (X03-X06, X08): trips, revenue and tips per window."""
    events = ride_events(stream, clock).withWatermark("event_timestamp", watermark)
    groups = [F.window("event_timestamp", size).alias("w")] + ([F.col(key)] if key else [])
    agg = events.groupBy(*groups).agg(F.count(F.lit(1)).alias("num_trips"),
                                      F.sum("total_amount").alias("total_revenue"),
                                      F.sum("tip_amount").alias("total_tips"))
    return agg.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                      *([key] if key else []), "num_trips",
                      round_half_up("total_revenue", 2).alias("total_revenue"),
                      round_half_up("total_tips", 2).alias("total_tips"))


def sessions(stream: DataFrame, gap: str = "5 minutes", key: str = "PULocationID",
             watermark: str = WATERMARK) -> DataFrame:
    """Session windows per key (X07); append mode only and a key is required (V4)."""
    events = ride_events(stream).withWatermark("event_timestamp", watermark)
    agg = events.groupBy(F.session_window("event_timestamp", gap).alias("s"), F.col(key)).agg(
        F.count(F.lit(1)).alias("num_trips"))
    return agg.select(key, F.col("s.start").alias("session_start"), F.col("s.end").alias("session_end"),
                      "num_trips")


# ----------------------------------------------------------------- ticks
def tick_stream(messages: DataFrame) -> DataFrame:
    """Parse -> validate -> drop stale -> normalise (P16-P19) on a message stream; the
    event time becomes an instant for the watermark (V1)."""
    kept, _, _ = TK.clean_ticks(messages)
    return kept.withColumn("ts", F.col("ts").cast("timestamp"))


def dedup_ticks(ticks: DataFrame, watermark: str = TICK_WATERMARK) -> DataFrame:
    """Drop re-delivered ticks on (symbol, timestamp) (X11); state expires with the watermark."""
    return ticks.withWatermark("ts", watermark).dropDuplicatesWithinWatermark(["symbol", "ts"])


def candles(ticks: DataFrame, size: str = "1 minute", watermark: str | None = TICK_WATERMARK) -> DataFrame:
    """OHLC candles by event time, emitted once complete (X10, A17, D6-D8).  ``watermark=None``
    where the ticks carry one already (after ``dedup_ticks``)."""
    order = F.struct(F.col("ts"), F.col("event_id"))
    agg = ((ticks.withWatermark("ts", watermark) if watermark else ticks)
                .groupBy("symbol", F.window("ts", size).alias("w"))
                .agg(F.min_by("price", order).alias("open"), F.max("price").alias("high"),
                     F.min("price").alias("low"), F.max_by("price", order).alias("close"),
                     F.sum("volume").alias("volume"), F.count(F.lit(1)).alias("tick_count")))
    return agg.select("symbol", F.col("w.start").alias("window_start"), "open", "high", "low", "close",
                      "volume", "tick_count")


def to_anomalies(ticks: DataFrame, path: str, state: str, checkpoint: str, delay_seconds: int = 0, late: str | None = None):
    """Previous-tick anomalies of a stream (X12) as Parquet below ``path/batch_id=n``.

    Each micro-batch is the batch operator over its ticks and the state of the batch before
    (``stateful.judge_ticks``).  With ``delay_seconds`` ticks wait that long, in event time, for
    others that come later, and are judged in order; ticks that come behind a judged one of
    their symbol are kept below ``late`` (by default beside the state).  Every kept tick may
    become the stored one (D14).
    """
    def run(batch: DataFrame, batch_id: int) -> None:
        judge_ticks(batch, batch_id, path, state, late or f"{state}_late", delay_seconds)

    return ticks.writeStream.option("checkpointLocation", checkpoint).foreachBatch(run)


def to_silences(ticks: DataFrame, closed: str, open_now: str, state: str, checkpoint: str):
    """Silent symbols of a stream (W05, O05): ended silences, and after each batch the ones that last."""
    def run(batch: DataFrame, batch_id: int) -> None:
        watch_silence(batch, batch_id, closed, open_now, state)

    return ticks.writeStream.option("checkpointLocation", checkpoint).foreachBatch(run)


ANOMALY_SCHEMA = ("symbol string, ts timestamp, event_id long, price double, volume double, "
                  "anomaly_type string, anomaly_detail string")


def latest_per_symbol(ticks: DataFrame) -> DataFrame:
    """Latest price per symbol (X14, T06): an update-mode aggregate."""
    order = F.struct(F.col("ts"), F.col("event_id"))
    return ticks.groupBy("symbol").agg(F.max_by(F.struct("ts", "event_id", "price", "volume"), order).alias("l")) \
                .select("symbol", "l.ts", "l.event_id", "l.price", "l.volume")


# ----------------------------------------------------------------- sinks
def to_files(stream: DataFrame, path: str, checkpoint: str, mode: str = "append", fmt: str = "parquet"):
    """File sink with its own checkpoint (K15, X15): exactly-once via the sink's commit log."""
    return (stream.writeStream.format(fmt).outputMode(mode)
                  .option("path", path).option("checkpointLocation", checkpoint))


def upsert_batches(target: str | SnapshotTable, key: list[str], partition_col: str, order: list[str] | None = None,
                   writer: str = "upsert") -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` body for a keyed upsert sink.

    Re-running a batch after a failure writes the same rows for the same keys.  A snapshot
    table also remembers the last batch of each ``writer`` and takes none twice; a NULL key
    is one key like any other.
    """
    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        table = SnapshotTable(spark, target.path, target.partition_col) if isinstance(target, SnapshotTable) else target
        inc.merge_upsert(spark, batch, table, key, partition_col, order, run=(writer, batch_id))
    return run


def to_upsert(stream: DataFrame, target: str | SnapshotTable, key: list[str], partition_col: str, checkpoint: str,
              mode: str = "update", order: list[str] | None = None, writer: str = "upsert"):
    return (stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint)
                  .foreachBatch(upsert_batches(target, key, partition_col, order, writer)))


def to_jdbc(stream: DataFrame, url: str, table: str, checkpoint: str, properties: dict | None = None):
    """JDBC append sink via ``foreachBatch``."""
    def run(batch: DataFrame, batch_id: int) -> None:
        batch.write.jdbc(url, table, mode="append", properties=properties or {})
    return stream.writeStream.option("checkpointLocation", checkpoint).foreachBatch(run)


def fan_out(stream: DataFrame, outputs: dict[str, str], checkpoint: str):
    """One stream to several stateless sinks in one query (K18): each micro-batch is
    written to every output; the batch is cached once and released.  A batch owns the folder
    ``batch_id=n`` of each output, so a replayed batch replaces what it wrote before."""
    def run(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            for path in outputs.values():
                batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")
        finally:
            batch.unpersist()
    return stream.writeStream.option("checkpointLocation", checkpoint).foreachBatch(run)


def run_to_completion(writer, timeout_s: int | None = None):
    """Drain the input and stop."""
    return drain(writer, timeout_s)


def console(stream: DataFrame, mode: str = "append"):
    """Print rows."""
    return stream.writeStream.format("console").outputMode(mode).option("truncate", False)



LAKE_DAYS = ["yyyy", "MM", "dd"]
LAKE_COLUMNS = ["event_id", "symbol", "ts", "price", "volume", "exchange", "bid", "ask"]


def tick_lake(spark, path: str) -> SnapshotTable:
    """The JSON lake of kept ticks by yyyy/MM/dd (K15), published batch by batch."""
    return SnapshotTable(spark, path, LAKE_DAYS, "json", {"timestampNTZFormat": JSON_TS_NTZ_FORMAT})


def tick_job(messages: DataFrame, paths: dict, state_root: str, checkpoint: str, delay_seconds: int = 30):
    """The composed tick job (X17, K18) as one query: a batch's messages are parsed and
    deduplicated once and feed every output.

    Kept ticks go to the JSON lake, stale ones and rejected messages to side tables (X13),
    anomalies against the previous tick (X12) and one-minute candles (X10) follow from the
    ticks and small states; ticks too late for these are kept aside.  The lake takes each
    batch once; the other outputs own the folder ``batch_id=n``: a batch that runs again
    replaces what it wrote.
    """
    checked = TK.checked_ticks(messages).withColumn("ts", F.col("ts").cast("timestamp"))
    # A rejected or stale message is its own key: only kept ticks are deduplicated (X11).
    tick = F.col("reject_reason").isNull() & ~F.col("is_stale")
    keyed = checked.withColumn("_key", F.when(tick, F.concat_ws("@", "symbol", F.unix_micros("ts")))
                               .otherwise(F.concat(F.lit("#"), F.col("event_id"))))
    # The clock is the time of arrival, which every message has, also one without an event time.
    unique = (keyed.withColumn("_arrived", F.col("ingest_ts").cast("timestamp"))
                   .withWatermark("_arrived", TICK_WATERMARK).dropDuplicatesWithinWatermark(["_key"])
                   .drop("_key", "_arrived"))

    def run(batch: DataFrame, batch_id: int) -> None:
        parsed = batch.persist()
        try:
            kept, stale, rejected = TK.split_ticks(parsed)
            # reads the stream once, before the outputs share the rows; a batch may only move the watermark
            n, newest = parsed.agg(F.count(F.lit(1)), F.max(F.when(tick, F.unix_micros("ts")))).first()
            if not n:
                return
            ntz = F.col("ts").cast("timestamp_ntz").alias("ts")
            lake = tick_lake(batch.sparkSession, paths["lake"])
            days = {c: F.date_format("ts", c) for c in LAKE_DAYS}

            def to_lake():
                if not lake.done("tick_job", batch_id):
                    lake.append(kept.select(*(ntz if c == "ts" else c for c in LAKE_COLUMNS)).withColumns(days), "tick_job", batch_id)

            at_once(
                batch.sparkSession, to_lake,
                lambda: put(stale.select("event_id", "symbol", ntz, "price", "volume"), paths["stale"], batch_id),
                lambda: put(rejected.select("event_id", "key", "reject_reason"), paths["rejects"], batch_id),
                lambda: judge_ticks(kept, batch_id, paths["anomalies"], f"{state_root}/last_ticks",
                                    f"{paths['late']}/anomalies", delay_seconds),
                lambda: fold_candles(kept, batch_id, paths["candles"], f"{state_root}/candles",
                                     f"{paths['late']}/candles", delay_seconds, newest))
        finally:
            parsed.unpersist()

    return unique.writeStream.option("checkpointLocation", checkpoint).foreachBatch(run)


def run_tick_job(spark, source_folder: str, out_root: str, ckpt_root: str, timeout_s: int | None = None) -> dict:
    """Drain the tick job: parse -> stale -> dedup -> normalise, then lake, side tables, anomalies
    and candles.  Everything delivered so far is one micro-batch: a delivery spans several files.
    Days of the lake that were written by more than two batches are compacted."""
    paths = {k: f"{out_root}/{k}" for k in ("lake", "stale", "rejects", "anomalies", "candles", "late")}
    source = stream_source(spark, source_folder, TICK_MESSAGE_SCHEMA, max_files_per_trigger=None)
    drain(tick_job(source, paths, f"{out_root}/state", f"{ckpt_root}/tick_job"), timeout_s)
    tick_lake(spark, paths["lake"]).compact(most=2)
    return paths

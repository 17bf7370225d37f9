"""Tick queries in batch over the ``events`` table replayed as JSON messages
(P16-P19, X10-X14 batch forms, W03-W05, O01-O07)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import monitor as M
from ..operators import ticks as TK
from ..operators.dedup import latest_per_key
from ..operators.union import concat_frames
from ..session import scratch_path
from ..sinks.writers import balanced_for_write, write_json_lake
from . import bindings as B

AS_OF = "2024-01-30 00:00:00"
TICK_RETENTION_DAYS = 7
FOCUS_SYMBOL = "CLICK/USDT"
#: A counter of messages that starts anew after so many, as after a restart of its producer.
COUNTER_RESETS = 500
#: Kinds of the lake: partition columns and days kept.
LAKE_DAYS = ("yyyy", "MM", "dd")
RETENTION = {"ticks": (LAKE_DAYS, 7), "candles": (["candle_date"], 14), "anomalies": (LAKE_DAYS, 21)}


def _cleaned(spark: SparkSession, sf_dir: str):
    return TK.clean_ticks(B.tick_messages(spark, sf_dir))


def clean_ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parsed, validated, fresh and normalised ticks."""
    kept, _, _ = _cleaned(spark, sf_dir)
    return kept.select("event_id", "symbol", "ts", "price", "volume", "exchange", "bid", "ask")


def tick_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rejected messages with the first failed rule."""
    _, _, rejected = _cleaned(spark, sf_dir)
    return rejected.select("event_id", "key", "reject_reason")


def stale_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Kept vs stale ticks per symbol."""
    ok = TK.checked_ticks(B.tick_messages(spark, sf_dir)).filter(F.col("reject_reason").isNull())
    return ok.groupBy("symbol").agg(F.count_if(~F.col("is_stale")).alias("kept"),
                                    F.count_if("is_stale").alias("stale"))


def tick_anomalies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Anomalies against the previous kept tick of the symbol."""
    kept, _, _ = _cleaned(spark, sf_dir)
    return TK.detect_anomalies(kept)


def ohlcv_1m(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One-minute candles."""
    kept, _, _ = _cleaned(spark, sf_dir)
    return TK.ohlcv(kept, "minute")


def ohlcv_1h(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One-hour candles."""
    kept, _, _ = _cleaned(spark, sf_dir)
    return TK.ohlcv(kept, "hour")


def latest_tick(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Latest tick per symbol."""
    kept, _, _ = _cleaned(spark, sf_dir)
    return latest_per_key(kept.select("symbol", "ts", "event_id", "price", "volume"), ["symbol"], ["ts", "event_id"])


def _produced(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every produced message with its outcome: failed when rejected by validation."""
    checked = TK.checked_ticks(B.tick_messages(spark, sf_dir))
    return checked.select(F.col("key").alias("symbol"), "ts", F.col("reject_reason").isNotNull().alias("failed"))


def rate_per_minute(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages per second per symbol over one-minute windows."""
    return M.message_rate(B.tick_records(spark, sf_dir), "symbol", "ts", 60)


def producer_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sent and failed messages per symbol, red when any failed."""
    return M.sent_failed(_produced(spark, sf_dir), "failed")


def error_increase(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly failed count per symbol against the previous hour."""
    return M.error_increase(_produced(spark, sf_dir), "failed")


def silence_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gaps of two minutes or more between a symbol's messages."""
    return M.silence_gaps(B.tick_records(spark, sf_dir))


def silence_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silences of two minutes or more as of a moment: ended ones, and those that still last.

    One producer stopped nine hours before.
    """
    sent = B.tick_records(spark, sf_dir)
    alive = (F.col("symbol") != FOCUS_SYMBOL) | (F.col("ts") <= F.timestamp_add("HOUR", F.lit(-9), F.lit(AS_OF).cast("timestamp_ntz")))
    return M.silence_gaps(sent.filter(alive), as_of=AS_OF)


def _counter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Samples of a counter per symbol that a restart sets back."""
    return B.tick_records(spark, sf_dir).select("symbol", "ts", "event_id", (F.col("event_id") % COUNTER_RESETS).alias("sent"))


def counter_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rate and increase of the counter over two hours, every half hour."""
    return M.counter_increase(_counter(spark, sf_dir), "sent", range_seconds=7200, step_seconds=1800)


def counter_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Steps at which the counter of failures grew within six hours (O04): red ones."""
    failures = _counter(spark, sf_dir).select("symbol", "ts", "event_id", F.floor(F.col("sent") / 7).alias("failed"))
    out = M.counter_increase(failures, "failed", range_seconds=21600, step_seconds=3600)
    return out.filter(F.col("increase") > 0).select("symbol", "step", "increase")


def retention_layouts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Retention by folders (O07): ticks and anomalies by yyyy/MM/dd, candles by date with a NULL
    partition; rows left of each kind."""
    kept, _, _ = _cleaned(spark, sf_dir)
    root = scratch_path(spark, "lake")
    ticks = kept.select("event_id", "symbol", "ts", "price")
    write_json_lake(ticks, root, "ts", "ticks")
    write_json_lake(TK.detect_anomalies(kept).select("event_id", "symbol", "ts", "price"), root, "ts", "anomalies")
    day = F.when(F.col("symbol") != FOCUS_SYMBOL, F.to_date("window_start"))
    candles = TK.ohlcv(kept, "hour").withColumn("candle_date", day)
    balanced_for_write(candles, "candle_date").write.partitionBy("candle_date").parquet(f"{root}/candles")
    M.retain_kinds(spark, root, RETENTION, dt.date.fromisoformat(AS_OF[:10]))

    def count(df: DataFrame, kind: str) -> DataFrame:
        return df.groupBy("symbol").agg(F.count(F.lit(1)).alias("retained")).withColumn("kind", F.lit(kind))

    lake = {kind: spark.read.schema("event_id long, symbol string").json(f"{root}/{kind}") for kind in ("ticks", "anomalies")}
    parts = [count(df, kind) for kind, df in lake.items()] + [count(spark.read.parquet(f"{root}/candles"), "candles")]
    return concat_frames(parts, ["kind", "symbol", "retained"])


def price_drop_5m(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ticks more than 3 % below the 5-minute high."""
    kept, _, _ = _cleaned(spark, sf_dir)
    return M.price_drops(kept.select("symbol", "ts", "event_id", "price"))


def series_last_30m(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every symbol's prices in the 30 minutes before the as-of time."""
    kept, _, _ = _cleaned(spark, sf_dir)
    return M.recent_series(kept.select("symbol", "ts", "event_id", "price"), "ts", AS_OF, 30)


def retention(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ticks kept by a 7-day retention at the as-of time, counted per symbol."""
    kept, _, _ = _cleaned(spark, sf_dir)
    return (M.retain(kept, "ts", TICK_RETENTION_DAYS, AS_OF)
             .groupBy("symbol").agg(F.count(F.lit(1)).alias("retained")))


def latest_five_ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five newest ticks of one symbol (T07): a top-k on a filtered key."""
    kept, _, _ = _cleaned(spark, sf_dir)
    return (kept.filter(F.col("symbol") == FOCUS_SYMBOL)
                .select("symbol", "ts", "event_id", "price")
                .orderBy(F.desc("ts"), F.desc("event_id")).limit(5))


def series_one_symbol(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One symbol's prices in the 30 minutes before the as-of time (O06, single key)."""
    kept, _, _ = _cleaned(spark, sf_dir)
    return M.recent_series(kept.select("symbol", "ts", "event_id", "price"), "ts", AS_OF, 30,
                           key="symbol", value=FOCUS_SYMBOL)


QUERIES = {
    "clean_ticks": clean_ticks,
    "tick_rejects": tick_rejects,
    "stale_split": stale_split,
    "tick_anomalies": tick_anomalies,
    "ohlcv_1m": ohlcv_1m,
    "ohlcv_1h": ohlcv_1h,
    "latest_tick": latest_tick,
    "rate_per_minute": rate_per_minute,
    "producer_counters": producer_counters,
    "error_increase": error_increase,
    "silence_gaps": silence_gaps,
    "silence_alerts": silence_alerts,
    "counter_rate": counter_rate,
    "counter_alerts": counter_alerts,
    "retention_layouts": retention_layouts,
    "price_drop_5m": price_drop_5m,
    "series_last_30m": series_last_30m,
    "retention": retention,
    "latest_five_ticks": latest_five_ticks,
    "series_one_symbol": series_one_symbol,
}

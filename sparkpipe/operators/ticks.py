"""Market-tick cleaning, anomalies and candles.

Every function maps DataFrame -> DataFrame with built-in column expressions, so the same
definitions serve batch jobs and Structured Streaming micro-batches.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import NUMERIC
from .sequence import previous_row

# Fixed values of the tick job: required message fields, thresholds, fallbacks.
REQUIRED_FIELDS = ["symbol", "price", "volume", "timestamp", "exchange"]
STALE_SECONDS = 30
PRICE_JUMP_PCT = 2.0
VOLUME_SPIKE_PCT = 500.0
VOLUME_EPSILON = 1e-9
BID_FALLBACK = 0.9999
ASK_FALLBACK = 1.0001

TICK_SCHEMA = T.StructType([
    T.StructField("symbol", T.StringType()),
    T.StructField("price", T.DoubleType()),
    T.StructField("volume", T.DoubleType()),
    T.StructField("timestamp", T.StringType()),
    T.StructField("exchange", T.StringType()),
    T.StructField("bid", T.DoubleType()),
    T.StructField("ask", T.DoubleType()),
    T.StructField("_corrupt_record", T.StringType()),
])


def parse_ticks(messages: DataFrame, value_col: str = "value") -> DataFrame:
    """Parse JSON messages (P16, F20): all tick fields plus ``reject_reason``.

    Malformed JSON (or no message) gives ``malformed``; a required field that is missing
    *or null* gives ``missing_field`` (D10).  Other columns of ``messages`` are carried
    along.  The parsed struct is emitted through ``inline_outer``: filters on its fields
    (kept / stale / rejected) then stay above the generator, so Catalyst cannot push them
    down by re-inlining ``from_json`` into every predicate — the JSON is parsed once.
    """
    parsed = F.from_json(F.col(value_col), TICK_SCHEMA,
                         {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"})
    out = messages.select(*messages.columns, F.inline_outer(F.array(parsed)))
    missing = None
    for f in REQUIRED_FIELDS:
        term = F.col(f).isNull()
        missing = term if missing is None else missing | term
    reason = (F.when(F.col(value_col).isNull() | F.col("_corrupt_record").isNotNull(), F.lit("malformed"))
               .when(missing, F.lit("missing_field")))
    return out.withColumn("reject_reason", reason).drop("_corrupt_record", value_col)


def validate_ticks(df: DataFrame) -> DataFrame:
    """Record validation (P17, F07): symbol upper/trim with a '/', price > 0, volume
    (rounded to 8, NULL -> 0) > 0.  The first failed rule is written to ``reject_reason``."""
    symbol = F.upper(F.trim(F.col("symbol")))
    volume = F.round(F.coalesce(F.col("volume"), F.lit(0.0)).cast(NUMERIC), 8).cast("double")
    reason = (F.when(F.col("reject_reason").isNotNull(), F.col("reject_reason"))
               .when(~symbol.contains("/"), F.lit("bad_symbol"))
               .when(~(F.col("price") > 0), F.lit("non_positive_price"))
               .when(~(volume > 0), F.lit("non_positive_volume")))
    return df.withColumns({"symbol": symbol, "volume": volume, "reject_reason": reason})


def with_event_time(df: DataFrame, text_col: str = "timestamp", out: str = "ts") -> DataFrame:
    """ISO-8601 text (``Z`` or offset) -> zone-less UTC time (F16); bad text -> NULL."""
    instant = F.expr(f"try_cast(`{text_col}` AS TIMESTAMP)")
    return df.withColumn(out, instant.cast("timestamp_ntz"))


def stale_flag(ts: str | Column, reference: str | Column, max_age_seconds: int = STALE_SECONDS) -> Column:
    """True when the tick is older than ``max_age_seconds`` at ``reference``.

    An unparseable time counts as stale; ticks from the future are kept.
    """
    ts = F.col(ts) if isinstance(ts, str) else ts
    ref = F.col(reference) if isinstance(reference, str) else reference
    return ts.isNull() | (ts < F.timestamp_add("SECOND", F.lit(-max_age_seconds), ref))


def normalize_ticks(df: DataFrame) -> DataFrame:
    """Normalise (P19, F08): price to 2 dp, volume to 8 dp; a missing *or zero* bid/ask
    falls back to price x 0.9999 / x 1.0001 rounded to 2 dp."""
    price = F.round(F.col("price").cast(NUMERIC), 2).cast("double")
    volume = F.round(F.col("volume").cast(NUMERIC), 8).cast("double")

    def side(c: str, factor: float) -> Column:
        fallback = F.round((price * F.lit(factor)).cast(NUMERIC), 2).cast("double")
        return F.when(F.col(c).isNull() | (F.col(c) == 0), fallback).otherwise(F.col(c))

    return df.withColumns({"price": price, "volume": volume,
                           "bid": side("bid", BID_FALLBACK), "ask": side("ask", ASK_FALLBACK)})


def checked_ticks(messages: DataFrame, reference_col: str = "ingest_ts") -> DataFrame:
    """Every message parsed and judged once (P16-P18): ``reject_reason`` is set on rejected
    messages, ``is_stale`` tells old ticks from fresh ones."""
    return (with_event_time(validate_ticks(parse_ticks(messages)))
            .withColumn("is_stale", stale_flag("ts", reference_col)))


def split_ticks(checked: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``(kept, stale, rejected)`` of checked ticks; kept ticks are normalised."""
    rejected = checked.filter(F.col("reject_reason").isNotNull()).drop("is_stale")
    ok = checked.filter(F.col("reject_reason").isNull()).drop("reject_reason")
    return (normalize_ticks(ok.filter(~F.col("is_stale")).drop("is_stale")),
            ok.filter("is_stale").drop("is_stale"), rejected)


def clean_ticks(messages: DataFrame, reference_col: str = "ingest_ts") -> tuple[DataFrame, DataFrame, DataFrame]:
    """Composed cleaning (P16-P19, X13): returns ``(kept, stale, rejected)`` frames.  Each
    frame that is used parses the messages; to parse once, persist ``checked_ticks``."""
    return split_ticks(checked_ticks(messages, reference_col))


def symbol_path(symbol: str, ts: str) -> Column:
    """Lake folder and file stem of a tick: symbol with '-' for '/' (F06), then yyyy/MM/dd/HHmm."""
    return F.concat_ws("/", F.replace(F.col(symbol), F.lit("/"), F.lit("-")), F.date_format(ts, "yyyy/MM/dd/HHmm"))


def pct_change(cur: str | Column, prev: str | Column, epsilon: float = 0.0) -> Column:
    """Absolute percent change (F09); a zero base gives NULL instead of failing."""
    cur = F.col(cur) if isinstance(cur, str) else cur
    prev = F.col(prev) if isinstance(prev, str) else prev
    base = prev + F.lit(epsilon) if epsilon else prev
    return F.abs(F.try_divide(cur - prev, base) * F.lit(100))


def _pct_text(pct: Column) -> Column:
    return F.round(pct.cast(NUMERIC), 2).cast(T.DecimalType(38, 2)).cast("string")


def classify_anomaly(df: DataFrame, prev_price: str = "prev_price", prev_volume: str = "prev_volume") -> DataFrame:
    """PRICE_JUMP (> 2 %) wins over VOLUME_SPIKE (> 500 %), strict thresholds (D13);
    the first tick of a symbol has no previous tick and is silent."""
    p = pct_change("price", prev_price)
    v = pct_change("volume", prev_volume, VOLUME_EPSILON)
    kind = (F.when(p > PRICE_JUMP_PCT, F.lit("PRICE_JUMP"))
              .when(v > VOLUME_SPIKE_PCT, F.lit("VOLUME_SPIKE")))
    detail = (F.when(p > PRICE_JUMP_PCT, F.concat(F.lit("Price changed "), _pct_text(p), F.lit("% in one tick")))
                .when(v > VOLUME_SPIKE_PCT, F.concat(F.lit("Volume changed "), _pct_text(v), F.lit("% in one tick"))))
    return (df.withColumns({"anomaly_type": kind, "anomaly_detail": detail})
              .filter(F.col("anomaly_type").isNotNull()))


def detect_anomalies(ticks: DataFrame, bucket_unit: str = "minute", carry: Sequence[str] = ()) -> DataFrame:
    """Batch anomaly detection against the previous tick of the symbol.

    The previous tick is found per (symbol, minute) with carried boundary rows (see
    ``sequence.previous_row``), so one busy symbol does not serialise on one task.  ``carry`` names further columns to keep.
    """
    with_prev = previous_row(ticks, ["symbol"], ["ts", "event_id"], ["price", "volume"], bucket_unit=bucket_unit)
    return classify_anomaly(with_prev).select("symbol", "ts", "event_id", "price", "volume",
                                              "anomaly_type", "anomaly_detail", *carry)


def ohlcv(ticks: DataFrame, unit: str = "minute", ts: str = "ts") -> DataFrame:
    """Candles per symbol and window (X10, A17, D6, D7): open/close by (event time, id),
    volume summed, tick count.  Grouping by window keeps every group bounded."""
    order = F.struct(F.col(ts), F.col("event_id"))
    start = F.date_trunc(unit, F.col(ts)).cast("timestamp_ntz")
    return ticks.groupBy("symbol", start.alias("window_start")).agg(
        F.min_by("price", order).alias("open"),
        F.max("price").alias("high"),
        F.min("price").alias("low"),
        F.max_by("price", order).alias("close"),
        F.sum("volume").alias("volume"),
        F.count(F.lit(1)).alias("tick_count"),
    )

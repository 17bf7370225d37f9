"""Batch states of the tick streams: order restored, late ticks kept, replays, silences that last."""

import datetime as dt
import random

from pyspark.sql import functions as F

from sparkpipe.operators import ticks as TK
from sparkpipe.session import scratch_path
from sparkpipe.sinks import writers as W
from sparkpipe.streaming import jobs as J
from sparkpipe.streaming import stateful as S

T0 = dt.datetime(2024, 1, 1)
SCHEMA = "symbol string, ts timestamp, event_id long, price double, volume double"


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def ticks(n=120):
    return [(s, T0 + dt.timedelta(seconds=7 * i), 10 * i + j, 100.0 + (i * 37 + j) % 11, 1.0)
            for i in range(n) for j, s in enumerate("AB")]


def folders(spark):
    return [scratch_path(spark, n) for n in ("out", "state", "late")]


def test_shuffled_ticks_are_judged_in_order(spark):
    rows = ticks()
    out, state, late = folders(spark)
    rng = random.Random(1)
    # each tick may come up to 100 s late: with others of its time still to come
    arrival = sorted(rows, key=lambda r: (r[1] + dt.timedelta(seconds=rng.randint(0, 100)), r[2]))
    batches = [arrival[i:i + 40] for i in range(0, len(arrival), 40)]
    for n, batch in enumerate(batches):
        S.judge_ticks(frame(spark, batch), n, out, state, late, delay_seconds=110)
        if n == 2:  # the batch runs again
            S.judge_ticks(frame(spark, batch), n, out, state, late, delay_seconds=110)
    S.judge_ticks(frame(spark, [("Z", T0 + dt.timedelta(days=1), 0, 1.0, 1.0)]), len(batches), out, state, late, delay_seconds=110)
    want = {(r.event_id, r.anomaly_detail) for r in TK.detect_anomalies(frame(spark, rows)).collect()}
    got = [(r.event_id, r.anomaly_detail) for r in spark.read.parquet(out).collect()]
    assert set(got) == want and len(got) == len(want) > 10
    assert spark.read.parquet(late).count() == 0
    assert len(W.list_folders(spark, state)) <= 2


def test_ticks_behind_a_judged_one_are_kept_aside(spark):
    out, state, late = folders(spark)
    rows = ticks(20)
    S.judge_ticks(frame(spark, rows[:10] + rows[20:]), 0, out, state, late)
    S.judge_ticks(frame(spark, []), 1, out, state, late)
    S.judge_ticks(frame(spark, rows[10:20] + [("NEW", T0, 1, 5.0, 1.0)]), 3, out, state, late)
    got = spark.read.schema(SCHEMA).parquet(late)
    assert sorted(r.event_id for r in got.collect()) == sorted(r[2] for r in rows[10:20])


def test_last_ticks_are_broadcast_by_a_long_key(spark):
    at = [T0 + dt.timedelta(seconds=i) for i in range(4)]
    new = frame(spark, [("A", at[0], 1, 1.0, 1.0), ("A", at[2], 2, 1.0, 1.0), ("A", at[1], 9, 1.0, 1.0), ("B", at[0], 3, 1.0, 1.0),
                        (None, at[0], 4, 1.0, 1.0), ("A", None, 5, 1.0, 1.0), ("A", at[0], 1, 1.0, 1.0), ("C", at[3], 6, 1.0, 1.0)])
    last = frame(spark, [("A", at[1], 9, 1.0, 1.0), (None, at[3], 8, 1.0, 1.0), ("C", at[3], 7, 1.0, 1.0)])
    out = S.with_late(new, last)
    assert out.columns == [*new.columns, "_late"]
    rows = sorted((r["event_id"], r["_late"]) for r in out.collect())
    assert rows == [(1, True), (1, True), (2, False), (3, False), (4, False), (5, True), (6, True), (9, False)]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "HashedRelationBroadcastMode(List(input[0, bigint" in plan and "input[0, string" not in plan


def test_candles_fold_over_batches_and_keep_late_ticks(spark):
    out, state, late = folders(spark)
    rows = ticks(60)
    for n, i in enumerate(range(0, len(rows), 17)):
        S.fold_candles(frame(spark, rows[i:i + 17]), n, out, state, late, 30)
    S.fold_candles(frame(spark, [("Z", T0 + dt.timedelta(days=1), 0, 1.0, 1.0)]), 90, out, state, late, 30)
    S.fold_candles(frame(spark, rows[:3]), 91, out, state, late, 30)
    cols = ["symbol", "window_start", "open", "high", "low", "close", "volume", "tick_count"]
    want = TK.ohlcv(frame(spark, rows)).withColumn("window_start", F.col("window_start").cast("timestamp"))
    assert sorted(map(tuple, spark.read.parquet(out).select(*cols).collect())) == sorted(map(tuple, want.select(*cols).collect()))
    assert spark.read.parquet(late).count() == 3


def test_a_stopped_producer_is_reported(spark):
    closed, open_now, state = folders(spark)
    rows = ticks(30)
    gone = [r for r in rows if r[0] == "A" or r[2] < 100]
    for n, i in enumerate(range(0, len(gone), 10)):
        S.watch_silence(frame(spark, gone[i:i + 10]), n, closed, open_now, state)
    S.watch_silence(frame(spark, [("A", T0 + dt.timedelta(hours=9), 999, 1.0, 1.0)]), 50, closed, open_now, state)
    still = spark.read.parquet(f"{open_now}/batch_id=50").collect()
    assert [(r.symbol, r.gap_end, r.gap_seconds) for r in still] == [("B", None, 9 * 3600 - 7.0 * 9)]
    assert [(r.symbol, r.gap_seconds) for r in spark.read.parquet(closed).collect()] == [("A", 9 * 3600 - 7.0 * 29)]


def test_lake_of_the_tick_job_is_compacted(spark):
    lake = J.tick_lake(spark, scratch_path(spark, "lake"))
    df = spark.range(40).select("id", F.timestamp_add("HOUR", F.col("id"), F.lit(T0)).cast("timestamp_ntz").alias("ts"))
    df = df.withColumns({c: F.date_format("ts", c) for c in J.LAKE_DAYS})
    for n in range(4):
        lake.append(df.where(F.col("id") % 4 == n), "w", n)
    before = sorted(map(tuple, lake.read().collect()))
    lake.compact(most=2)
    assert sorted(map(tuple, lake.read().collect())) == before and len(before) == 40
    assert len(lake.snapshot().folders) == 2  # one folder a day

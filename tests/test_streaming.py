import datetime as dt
import json
import os

from pyspark.sql import functions as F

from sparkpipe.session import scratch_path
from sparkpipe.streaming import jobs as J
from sparkpipe.streaming.sources import stream_source
from tests.conftest import SF001

EPOCH = dt.datetime(1970, 1, 1)


def _ride(loc, when, trip_id):
    ms = int((when - EPOCH).total_seconds() * 1000)
    return {"trip_id": trip_id, "PULocationID": loc, "DOLocationID": 1, "trip_distance": 1.0,
            "total_amount": 10.0, "tip_amount": 1.0, "tpep_pickup_datetime": ms,
            "lpep_pickup_datetime": when.strftime("%Y-%m-%d %H:%M:%S")}


def _write_files(folder, batches):
    """One JSON file per batch, modification times strictly increasing (arrival order)."""
    os.makedirs(folder, exist_ok=True)
    for i, rows in enumerate(batches):
        p = os.path.join(folder, f"part-{i:03d}.json")
        with open(p, "w") as f:
            f.write("\n".join(json.dumps(r) for r in rows) + "\n")
        os.utime(p, (1_700_000_000 + i, 1_700_000_000 + i))


def _local(path):
    return path[len("file:"):] if path.startswith("file:") else path


def test_late_rows_dropped_in_append_mode(spark):
    d = dt.datetime(2024, 1, 1)
    folder = _local(scratch_path(spark, "late_in"))
    _write_files(folder, [
        [_ride(1, d.replace(hour=10), 1), _ride(1, d.replace(hour=10, minute=59), 2)],
        [_ride(1, d.replace(hour=12, second=10), 3)],
        [_ride(1, d.replace(hour=13), 4)],
        [_ride(1, d.replace(hour=10, minute=30), 5)],          # far behind the watermark: dropped (X08)
        [_ride(9, dt.datetime(2100, 1, 1), 6)],                # sentinel closes the open windows
    ])
    out, ck = scratch_path(spark, "late_out"), scratch_path(spark, "late_ck")
    J.run_to_completion(J.to_files(J.tumbling(stream_source(spark, "file:" + folder, J.RIDE_SCHEMA), "1 hour"),
                                   out, ck))
    got = {(r.window_start.hour, r.num_trips) for r in spark.read.parquet(out).filter("PULocationID = 1").collect()}
    assert got == {(10, 2), (12, 1), (13, 1)}


def test_late_row_corrects_window_in_update_mode(spark):
    d = dt.datetime(2024, 1, 1)
    folder = _local(scratch_path(spark, "upd_in"))
    _write_files(folder, [
        [_ride(1, d.replace(hour=10), 1)],
        [_ride(1, d.replace(hour=10, minute=20), 2)],          # same window, next batch: correction (X09)
        [_ride(1, d.replace(hour=11, minute=5), 3)],
    ])
    stream = J.tumbling(stream_source(spark, "file:" + folder, J.RIDE_SCHEMA), "1 hour") \
        .withColumn("window_date", F.to_date("window_start"))
    target, ck = scratch_path(spark, "upd_t"), scratch_path(spark, "upd_ck")
    J.run_to_completion(J.to_upsert(stream, target, ["window_start", "PULocationID"], "window_date", ck))
    got = sorted((r.window_start.hour, r.num_trips) for r in spark.read.parquet(target).collect())
    assert got == [(10, 2), (11, 1)]


def test_restart_resumes_from_checkpoint(spark):
    d = dt.datetime(2024, 1, 1)
    folder = _local(scratch_path(spark, "rs_in"))
    _write_files(folder, [[_ride(1, d, 1)], [_ride(2, d, 2)]])
    out, ck = scratch_path(spark, "rs_out"), scratch_path(spark, "rs_ck")

    def run():
        J.run_to_completion(J.to_files(J.pass_through(stream_source(spark, "file:" + folder, J.RIDE_SCHEMA)),
                                       out, ck))

    run()
    _write_files(folder + "_more", [[_ride(3, d, 3)]])
    os.replace(os.path.join(folder + "_more", "part-000.json"), os.path.join(folder, "part-002.json"))
    run()                                                      # X15: only the new file is read
    assert sorted(r.trip_id for r in spark.read.parquet(out).collect()) == [1, 2, 3]


def test_tick_job_matches_batch(spark):
    from sparkpipe.operators import ticks as TK
    from sparkpipe.plans import bindings as B
    from sparkpipe.plans.streams import _tick_folder
    paths = J.run_tick_job(spark, _tick_folder(spark, SF001), scratch_path(spark, "tj"), scratch_path(spark, "tj_ck"))
    kept, _, _ = TK.clean_ticks(B.tick_messages(spark, SF001))
    want_a = {(r.event_id, r.anomaly_type) for r in TK.detect_anomalies(kept).collect()}
    got_a = {(r.event_id, r.anomaly_type) for r in spark.read.parquet(paths["anomalies"]).collect()}
    assert got_a == want_a
    cols = ["symbol", "open", "high", "low", "close", "volume", "tick_count"]
    want_c = {tuple(r) for r in TK.ohlcv(kept).select(*cols).collect()}
    got_c = {tuple(r) for r in spark.read.parquet(paths["candles"]).select(*cols).collect()}
    assert got_c == want_c


def test_latest_start_skips_older_rows(spark):
    d = dt.datetime(2024, 1, 1)
    folder = _local(scratch_path(spark, "lt_in"))
    _write_files(folder, [[_ride(1, d, 1)], [_ride(1, d.replace(hour=5), 2)]])
    src = stream_source(spark, "file:" + folder, J.RIDE_SCHEMA, starting="latest",
                        start_time_col="tpep_pickup_datetime",
                        start_time=int((d.replace(hour=1) - EPOCH).total_seconds() * 1000))   # S14
    out, ck = scratch_path(spark, "lt_out"), scratch_path(spark, "lt_ck")
    J.run_to_completion(J.to_files(J.pass_through(src), out, ck))
    assert [r.trip_id for r in spark.read.parquet(out).collect()] == [2]


def test_late_drain_stops_and_raises(spark):
    import pytest

    from sparkpipe.streaming.sources import drain
    slow = spark.readStream.format("rate-micro-batch").option("rowsPerBatch", 10).load()
    writer = slow.writeStream.foreachBatch(lambda b, i: __import__("time").sleep(30)).option(
        "checkpointLocation", scratch_path(spark, "late"))
    with pytest.raises(TimeoutError):
        drain(writer, timeout_s=1)
    assert not spark.streams.active


def test_stream_dedup_across_batches_within_the_watermark(spark):
    t0 = dt.datetime(2024, 1, 1)
    ticks = [{"event_id": i, "key": "A/B", "ingest_ts": (t0 + dt.timedelta(seconds=i)).isoformat(),
              "value": json.dumps({"symbol": "A/B", "price": 1.0, "volume": 1.0, "exchange": "X",
                                   "timestamp": (t0 + dt.timedelta(seconds=i)).isoformat() + "Z"})}
             for i in range(20)]
    folder = _local(scratch_path(spark, "dd_in"))
    _write_files(folder, [ticks[:10], ticks])                 # the first ten come again, seconds later
    stream = J.dedup_ticks(J.tick_stream(stream_source(spark, "file:" + folder, J.TICK_MESSAGE_SCHEMA)))
    out, ck = scratch_path(spark, "dd_out"), scratch_path(spark, "dd_ck")
    q = J.run_to_completion(J.to_files(stream, out, ck))
    assert sorted(r.event_id for r in spark.read.parquet(out).collect()) == list(range(20))
    state = [s for p in q.recentProgress for s in p["stateOperators"]]
    assert sum(s["numRowsDroppedByWatermark"] for s in state) == 0


def test_fan_out_replays_a_failed_batch(spark, monkeypatch):
    import pytest
    folder = _local(scratch_path(spark, "fo_in"))
    _write_files(folder, [[_ride(1, dt.datetime(2024, 1, 1), i) for i in range(100)]])
    paths = {k: scratch_path(spark, k) for k in ("a", "b")}
    ck = scratch_path(spark, "fo_ck")

    def run(outputs):
        stream = J.pass_through(stream_source(spark, "file:" + folder, J.RIDE_SCHEMA))
        J.run_to_completion(J.fan_out(stream, outputs, ck))

    with pytest.raises(Exception):
        run({"a": paths["a"], "b": "nosuchscheme://x"})       # the first output is written, the second fails
    run(paths)
    assert [spark.read.parquet(p).count() for p in paths.values()] == [100, 100]


def test_stream_anomalies_over_several_batches_and_a_replay(spark):
    from sparkpipe.operators import ticks as TK
    t0 = dt.datetime(2024, 1, 1)
    rows = [(s, t0 + dt.timedelta(seconds=7 * i), 10 * i + j, 100.0 + (i * 37 + j) % 11, 1.0)
            for i in range(60) for j, s in enumerate("AB")]
    df = spark.createDataFrame(rows, "symbol string, ts timestamp, event_id long, price double, volume double")
    folder, out = scratch_path(spark, "an_in"), scratch_path(spark, "an_out")
    state, ck = scratch_path(spark, "an_state"), scratch_path(spark, "an_ck")
    for lo in range(0, 600, 150):
        df.filter((F.col("event_id") >= lo) & (F.col("event_id") < lo + 150)).coalesce(1).write.mode("append").parquet(folder)
        stream = spark.readStream.schema(df.schema).parquet(folder)
        J.run_to_completion(J.to_anomalies(stream, out, state, ck))
    want = {(r.event_id, r.anomaly_detail) for r in TK.detect_anomalies(df).collect()}
    got = [(r.event_id, r.anomaly_detail) for r in spark.read.parquet(out).collect()]
    assert set(got) == want and len(got) == len(want) > 10

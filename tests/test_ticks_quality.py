import datetime as dt

from pyspark.sql import functions as F

from sparkpipe.operators import ticks as TK
from sparkpipe.operators.quality import Check, run_checks

NOW = dt.datetime(2024, 1, 1, 12, 0, 0)


def _msgs(spark, values):
    return spark.createDataFrame([(i, v, NOW) for i, v in enumerate(values)],
                                 "event_id long, value string, ingest_ts timestamp_ntz")


def test_parse_validate_reasons(spark):
    ok = '{"symbol":"btc/usdt ","price":10.0,"volume":1.0,"timestamp":"2024-01-01T11:59:50Z","exchange":"X","bid":0}'
    vals = [
        ok,
        '{"symbol":"BTC/USDT","price":10.0,"volume":1.0,"exchange":"X"}',                       # missing key
        '{"symbol":"BTC/USDT","price":null,"volume":1.0,"timestamp":"2024-01-01T11:59:50Z","exchange":"X"}',
        '{not json',
        '{"symbol":"BTCUSDT","price":10.0,"volume":1.0,"timestamp":"2024-01-01T11:59:50Z","exchange":"X"}',
        '{"symbol":"BTC/USDT","price":0.0,"volume":1.0,"timestamp":"2024-01-01T11:59:50Z","exchange":"X"}',
        '{"symbol":"BTC/USDT","price":10.0,"volume":0.0,"timestamp":"2024-01-01T11:59:50Z","exchange":"X"}',
        '{"symbol":"BTC/USDT","price":10.0,"volume":1.0,"timestamp":"yesterday","exchange":"X"}',   # bad time
        '{"symbol":"BTC/USDT","price":10.0,"volume":1.0,"timestamp":"2024-01-01T11:59:00Z","exchange":"X"}',
    ]
    kept, stale, rejected = TK.clean_ticks(_msgs(spark, vals))
    reasons = {r.event_id: r.reject_reason for r in rejected.collect()}
    assert reasons == {1: "missing_field", 2: "missing_field", 3: "malformed", 4: "bad_symbol",
                       5: "non_positive_price", 6: "non_positive_volume"}
    assert sorted(r.event_id for r in stale.collect()) == [7, 8]      # unparseable and 60 s old
    (k,) = kept.collect()
    assert (k.symbol, k.bid, k.ask) == ("BTC/USDT", 10.0, 10.0)         # zero bid falls back, 2 dp


def test_anomaly_thresholds_and_precedence(spark):
    t0 = dt.datetime(2024, 1, 1)
    prices = [(100.0, 10.0), (102.0, 10.0), (104.0604, 10.0), (104.0604, 60.0), (104.0604, 360.01),
              (200.0, 5000.0)]
    rows = [("S/U", t0 + dt.timedelta(seconds=i), i, p, v) for i, (p, v) in enumerate(prices)]
    df = spark.createDataFrame(rows, "symbol string, ts timestamp_ntz, event_id long, price double, volume double")
    out = {r.event_id: (r.anomaly_type, r.anomaly_detail) for r in TK.detect_anomalies(df).collect()}
    assert 0 not in out and 1 not in out                   # first tick silent; exactly 2 % is not a jump
    assert out[2][0] == "PRICE_JUMP"                        # 2.02 %
    assert 3 not in out                                     # exactly +500 % volume is not a spike
    assert out[4] == ("VOLUME_SPIKE", "Volume changed 500.02% in one tick")
    assert out[5][0] == "PRICE_JUMP"                        # both at once: price wins


def test_candles_by_event_time(spark):
    t0 = dt.datetime(2024, 1, 1, 0, 0)
    rows = [("S/U", t0 + dt.timedelta(seconds=30), 2, 5.0, 1.0), ("S/U", t0 + dt.timedelta(seconds=10), 1, 7.0, 2.0),
            ("S/U", t0 + dt.timedelta(seconds=50), 3, 6.0, 3.0)]
    df = spark.createDataFrame(rows, "symbol string, ts timestamp_ntz, event_id long, price double, volume double")
    (c,) = TK.ohlcv(df).collect()
    assert (c.open, c.high, c.low, c.close, c.volume, c.tick_count) == (7.0, 7.0, 5.0, 6.0, 6.0, 3)


def test_checks_one_failure_each(spark):
    rows = [(1, "a", 5.0, "F"), (1, None, -1.0, "X"), (2, "b", 0.0, "O")]
    df = spark.createDataFrame(rows, "id int, name string, amt double, st string")
    checks = [Check("not_null", ["name"]), Check("non_negative", ["amt"]), Check("positive", ["amt"]),
              Check("accepted_values", ["st"], ["F", "O"]), Check("unique", ["id"]),
              Check("primary_key", ["id", "st"]), Check("min_rows", [], threshold=4)]
    res = {(r.check_name, r.column_name): r.failures for r in run_checks(df, checks).collect()}
    assert res[("not_null", "name")] == 1
    assert res[("non_negative", "amt")] == 1
    assert res[("positive", "amt")] == 2
    assert res[("accepted_values", "st")] == 1
    assert res[("unique", "id")] == 1
    assert res[("primary_key", "id,st")] == 0
    assert res[("min_rows", "*")] == 1

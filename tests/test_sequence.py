import datetime as dt
import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from sparkpipe.operators.sequence import previous_row, session_windows, trailing_range_max


def _frame(spark, n=400, seed=7):
    rnd = random.Random(seed)
    base = dt.datetime(2024, 1, 1)
    rows = [(rnd.choice("AB"), base + dt.timedelta(seconds=rnd.randint(0, 5 * 3600)), i, float(rnd.randint(1, 100)))
            for i in range(n)]
    return spark.createDataFrame(rows, "k string, ts timestamp_ntz, id long, v double")


def test_previous_row_equals_lag(spark):
    df = _frame(spark)
    w = Window.partitionBy("k").orderBy("ts", "id")
    want = {r.id: r.p for r in df.select("id", F.lag("v").over(w).alias("p")).collect()}
    got = {r.id: r.prev_v for r in previous_row(df, ["k"], ["ts", "id"], ["v"], bucket_unit="hour").collect()}
    assert got == want


def test_trailing_range_max_equals_range_window(spark):
    df = _frame(spark)
    w = Window.partitionBy("k").orderBy(F.unix_micros(F.col("ts").cast("timestamp"))).rangeBetween(-300_000_000, 0)
    want = {r.id: r.m for r in df.select("id", F.max("v").over(w).alias("m")).collect()}
    got = {r.id: r.m for r in trailing_range_max(df, ["k"], "ts", "v", 300, "m").collect()}
    assert got == want


def test_session_gap_boundary(spark):
    base = dt.datetime(2024, 1, 1, 10)
    secs = [0, 299, 599, 899, 1200]          # gaps 4:59, 5:00, 5:00, 5:01
    rows = [("A", base + dt.timedelta(seconds=s), i) for i, s in enumerate(secs)]
    df = spark.createDataFrame(rows, "k string, ts timestamp_ntz, id long")
    out = sorted((r.session_start, r.num_trips) for r in session_windows(df, ["k"], ["ts", "id"], 300).collect())
    assert [n for _, n in out] == [4, 1]     # a gap equal to the limit merges (D21)


def test_sessions_equal_gaps_and_islands(spark):
    df = _frame(spark, n=900, seed=3)
    w = Window.partitionBy("k").orderBy("ts", "id")
    new = F.coalesce(F.unix_seconds(F.col("ts").cast("timestamp"))
                     - F.unix_seconds(F.lag("ts").over(w).cast("timestamp")) > 30, F.lit(True)).cast("int")
    want = sorted(tuple(r) for r in df.withColumn("new", new).withColumn("no", F.sum("new").over(w))
                  .groupBy("k", "no").agg(F.min("ts"), F.count("*")).drop("no").collect())
    for unit in ("minute", "hour"):
        out = session_windows(df, ["k"], ["ts", "id"], 30, bucket_unit=unit)
        assert sorted(tuple(r) for r in out.select("k", "session_start", "num_trips").collect()) == want


def test_one_hot_minute_and_null_keys(spark):
    base = dt.datetime(2024, 1, 1)
    rows = [(None if i % 7 == 0 else "HOT", base + dt.timedelta(milliseconds=i), i, float(i)) for i in range(300)]
    rows += [("HOT", base + dt.timedelta(days=9), 300, 300.0), ("HOT", None, -1, -1.0)]
    df = spark.createDataFrame(rows, "k string, ts timestamp_ntz, id long, v double")
    w = Window.partitionBy("k").orderBy("ts", "id")
    want = {r.id: r.p for r in df.select("id", F.lag("v").over(w).alias("p")).collect()}
    assert {r.id: r.prev_v for r in previous_row(df, ["k"], ["ts", "id"], ["v"]).collect()} == want


def _hot_minute(spark, n=60_000):
    """Every row in one minute of one key; half of them at one instant."""
    base = dt.datetime(2024, 1, 1)
    at = F.when(F.col("id") % 2 == 0, 0).otherwise(F.pmod(F.xxhash64("id"), F.lit(59_000)))
    return spark.range(n).repartition(8).select(
        F.lit("HOT").alias("k"), F.timestamp_add("MILLISECOND", at.cast("long"), F.lit(base).cast("timestamp_ntz")).alias("ts"),
        "id", F.col("id").cast("double").alias("v"))


def test_hot_minute_is_cut_by_rows(spark):
    df = _hot_minute(spark)
    w = Window.partitionBy("k").orderBy("ts", "id")
    want = df.select("id", F.lag("v").over(w).alias("p")).collect()
    got = previous_row(df, ["k"], ["ts", "id"], ["v"], max_rows=1000)
    assert {r.id: r.prev_v for r in got.collect()} == {r.id: r.p for r in want}
    assert got.columns == [*df.columns, "prev_v"]


def test_hot_hour_of_sessions_is_cut_by_rows(spark):
    df = _hot_minute(spark, 20_000).where("id % 40 < 2")
    w = Window.partitionBy("k").orderBy("ts", "id")
    new = F.coalesce(F.unix_millis(F.col("ts").cast("timestamp")) - F.unix_millis(F.lag("ts").over(w).cast("timestamp")) > 1000,
                     F.lit(True)).cast("int")
    want = sorted(tuple(r) for r in df.withColumn("new", new).withColumn("no", F.sum("new").over(w))
                  .groupBy("k", "no").agg(F.min("ts"), F.count("*")).drop("no").collect())
    out = session_windows(df, ["k"], ["ts", "id"], 1, max_rows=50)
    assert sorted(tuple(r) for r in out.select("k", "session_start", "num_trips").collect()) == want

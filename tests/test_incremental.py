import datetime as dt

import pytest
from pyspark.sql import functions as F

from sparkpipe.operators import incremental as inc
from sparkpipe.session import scratch_path


def _read(spark, path, cols):
    return sorted(tuple(r) for r in spark.read.parquet(path).select(*cols).collect())


def test_insert_only_keeps_batch_duplicates(spark):
    path = scratch_path(spark, "t")
    tgt = spark.createDataFrame([("h1", 1, dt.date(2024, 1, 1))], "h string, v int, d date")
    inc.full_refresh(tgt, path, "d")
    src = spark.createDataFrame([("h1", 9, dt.date(2024, 1, 1)), ("h2", 2, dt.date(2024, 1, 1)),
                                 ("h2", 2, dt.date(2024, 1, 1))], "h string, v int, d date")
    inc.merge_insert_only(spark, src, path, ["h"], "d")
    assert _read(spark, path, ["h", "v"]) == [("h1", 1), ("h2", 2), ("h2", 2)]   # D2


def test_upsert_and_delete_insert(spark):
    d1, d2 = dt.date(2024, 1, 1), dt.date(2024, 1, 2)
    tgt = spark.createDataFrame([(1, "a", d1), (2, "b", d1), (3, "c", d2)], "k int, v string, d date")
    p1 = scratch_path(spark, "u")
    inc.full_refresh(tgt, p1, "d")
    src = spark.createDataFrame([(2, "B", d1), (4, "D", d1)], "k int, v string, d date")
    inc.merge_upsert(spark, src, p1, ["k"], "d")
    assert _read(spark, p1, ["k", "v"]) == [(1, "a"), (2, "B"), (3, "c"), (4, "D")]
    p2 = scratch_path(spark, "di")
    inc.full_refresh(tgt, p2, "d")
    inc.delete_insert(spark, src.select("k", "v", "d"), p2, ["d"], "d")
    assert _read(spark, p2, ["k", "v"]) == [(2, "B"), (3, "c"), (4, "D")]


def test_interval_mid_day_keeps_edge_rows_and_drops_empty_days(spark):
    rows = [(i, dt.datetime(2024, 1, 1) + dt.timedelta(hours=6 * i), 1.0) for i in range(16)]   # 4 days
    df = spark.createDataFrame(rows, "id int, ts timestamp_ntz, v double").withColumn("d", F.to_date("ts"))
    path = scratch_path(spark, "iv")
    inc.full_refresh(df, path, "d")
    new = df.filter(F.col("id") != 9).withColumn("v", F.lit(2.0))   # day 3 at 06:00 has no new row
    inc.time_interval_refresh(spark, new, path, "ts", "2024-01-02 12:00:00", "2024-01-03 12:00:00", "d")
    got = dict((r.id, r.v) for r in spark.read.parquet(path).collect())
    assert len(got) == 15 and 9 not in got
    assert all(got[i] == (2.0 if 6 <= i <= 9 else 1.0) for i in got)


def test_month_plan_cap_and_guard(spark):
    df = spark.createDataFrame([("x", dt.datetime(2023, 11, 15), dt.datetime(2024, 3, 1))],
                               "g string, s timestamp_ntz, e timestamp_ntz")
    months = [r.month_start for r in inc.month_plan(df, ["g"], "s", "e").orderBy("month_index").collect()]
    assert months == [dt.date(2023, 11, 1), dt.date(2023, 12, 1), dt.date(2024, 1, 1), dt.date(2024, 2, 1)]
    capped = inc.month_plan(df, ["g"], "s", "e", cap="2024-01-15", inclusive_end=True).count()
    assert capped == 3
    with pytest.raises(Exception):
        inc.month_plan(df, ["g"], "s", "e", max_months=2).collect()
    chunks = inc.chunk_plan(inc.month_plan(df, ["g"], "s", "e"), ["g"], 3).orderBy("chunk_no").collect()
    assert [(c.chunk_start, c.chunk_end, c.full_refresh) for c in chunks] == [
        (dt.date(2023, 11, 1), dt.date(2024, 2, 1), True), (dt.date(2024, 2, 1), dt.date(2024, 3, 1), False)]


def test_backfill_dry_run():
    chunks = inc.backfill(dt.date(2024, 1, 20), dt.date(2024, 5, 10), 2, lambda *a: None, dry_run=True)
    assert chunks == [(dt.date(2024, 1, 1), dt.date(2024, 3, 1), True),
                      (dt.date(2024, 3, 1), dt.date(2024, 5, 1), False),
                      (dt.date(2024, 5, 1), dt.date(2024, 5, 11), False)]


def test_backfill_guards_and_inclusive_cap():
    with pytest.raises(ValueError):
        inc.backfill(dt.date(2024, 1, 1), dt.date(2024, 2, 1), 0, lambda *a: None, dry_run=True)
    with pytest.raises(ValueError):
        inc.backfill(dt.date(2024, 2, 1), dt.date(2024, 1, 1), 1, lambda *a: None, dry_run=True)
    assert inc.backfill(dt.date(2025, 11, 3), dt.date(2026, 5, 1), 3, lambda *a: None, cap=dt.date(2025, 11, 30),
                        dry_run=True) == [(dt.date(2025, 11, 1), dt.date(2025, 12, 1), True)]


@pytest.mark.parametrize("merge", [inc.merge_upsert, inc.delete_insert])
def test_moved_keys_and_null_partitions(spark, merge):
    d1, d2 = dt.date(2024, 1, 1), dt.date(2024, 2, 1)
    path = scratch_path(spark, "moved")
    schema = "k int, v string, d date"
    inc.full_refresh(spark.createDataFrame([(1, "a", d1), (2, "b", None), (3, "c", None), (5, "e", d2)], schema), path, "d")
    merge(spark, spark.createDataFrame([(1, "A", d2), (3, "C", d1), (4, "D", None)], schema), path, ["k"], "d")
    got = {(r.k, r.v, r.d) for r in spark.read.parquet(path).collect()}
    assert got == {(1, "A", d2), (2, "b", None), (3, "C", d1), (4, "D", None), (5, "e", d2)}


def test_batch_of_null_partitions_is_inserted_and_double_keys_fail(spark):
    path = scratch_path(spark, "nulls")
    schema = "k int, v string, d date"
    inc.full_refresh(spark.createDataFrame([(1, "a", dt.date(2024, 1, 1))], schema), path, "d")
    inc.merge_insert_only(spark, spark.createDataFrame([(2, "b", None)], schema), path, ["k"], "d", keys_move=False)
    assert _read(spark, path, ["k", "v"]) == [(1, "a"), (2, "b")]
    with pytest.raises(ValueError):
        inc.merge_upsert(spark, spark.createDataFrame([(7, "x", None), (7, "y", None)], schema), path, ["k"], "d")


def test_interval_refresh_keeps_rows_of_a_monthly_target(spark):
    rows = [(i, dt.datetime(2024, 1, 1) + dt.timedelta(days=i), 1.0) for i in range(30)] + [(99, None, 1.0)]
    df = spark.createDataFrame(rows, "id int, ts timestamp_ntz, v double").withColumn("m", F.trunc("ts", "month"))
    path = scratch_path(spark, "monthly")
    inc.full_refresh(df, path, "m")
    inc.time_interval_refresh(spark, df.withColumn("v", F.lit(2.0)), path, "ts", "2024-01-10", "2024-01-13", "m")
    got = {r.id: r.v for r in spark.read.parquet(path).collect()}
    assert got == {i: 2.0 if 9 <= i < 12 else 1.0 for i in [*range(30), 99]}

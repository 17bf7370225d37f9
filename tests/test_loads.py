"""Files of a period, resumable backfills, checks inside a publication, statistics, start positions."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from sparkpipe.operators import incremental as inc
from sparkpipe.operators import quality as Q
from sparkpipe.session import scratch_path
from sparkpipe.sinks import writers as W
from sparkpipe.sinks.snapshots import SnapshotTable
from sparkpipe.sources.files import load_period, period_files, read_csv
from sparkpipe.streaming import jobs as J
from sparkpipe.streaming.sources import stream_source


def test_period_files_come_from_the_listing_and_one_scan(spark):
    root = scratch_path(spark, "period")
    for kind, month, n in (("yellow", "2031-12", 2), ("yellow", "2032-01", 3), ("green", "2032-01", 4), ("fhv", "1890-05", 1)):
        spark.range(n).withColumn("x", F.lit(1.5)).write.parquet(f"{root}/{kind}_tripdata_{month}.parquet")
    spark.range(9).write.parquet(f"{root}/readme.parquet")
    assert sorted(period_files(spark, root).values()) == [("fhv", "1890-05"), ("green", "2032-01"), ("yellow", "2031-12"), ("yellow", "2032-01")]
    df, report = load_period(spark, root, "id long, x double, y string", kinds=["yellow", "green"], first="2032-01",
                             expected=["2032-01", "2032-02"])
    assert sorted((r.kind, r.month, r.y) for r in df.collect()) == [("green", "2032-01", None)] * 4 + [("yellow", "2032-01", None)] * 3
    assert len(report.loaded) == 2 and report.skipped == [("2032-02", "no file")]
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "Union" not in plan
    empty, _ = load_period(spark, root, "id long", first="2040-01")
    assert empty.count() == 0 and empty.columns == ["id", "kind", "month"]


def test_typed_csv_dates_by_the_reader(spark):
    path = scratch_path(spark, "csv")
    spark.createDataFrame([("1", "05/01/2024 10:00")], "id string, at string").write.option("header", True).csv(path)
    row = read_csv(spark, path, "id int, at timestamp_ntz", timestamp_format="dd/MM/yyyy HH:mm").first()
    assert row.at == dt.datetime(2024, 1, 5, 10)


@pytest.mark.parametrize("dies_in", [1, 2, 3])
def test_backfill_that_dies_goes_on_behind_its_last_chunk(spark, dies_in):
    days = spark.range(0, 150).select("id", F.expr("date_add(date'2024-01-01', cast(id as int))").alias("day"))
    table = SnapshotTable(spark, scratch_path(spark, "backfill"))
    table.overwrite(days.limit(3))
    calls = []

    def rows(lo, hi):
        calls.append(lo)
        if len(calls) == dies_in:
            raise RuntimeError("killed")
        return days.filter((F.col("day") >= F.lit(lo)) & (F.col("day") < F.lit(hi)))

    args = (dt.date(2024, 1, 1), dt.date(2024, 5, 10), 2)
    with pytest.raises(RuntimeError, match="killed"):
        inc.backfill_table(table, rows, *args, run="r1")
    published = inc.backfill_table(table, rows, *args, run="r1")
    assert len(published) == 3 - (dies_in - 1)
    assert sorted(r.id for r in table.read().collect()) == list(range(131))
    assert inc.backfill_table(table, rows, *args, run="r1") == []
    assert len(inc.backfill_table(table, rows, *args, run="r2")) == 3 and table.read().count() == 131


def test_checks_run_inside_the_publication(spark):
    df = spark.createDataFrame([(1, -1.0, "a"), (None, 2.0, "b"), (3, 0.0, "z")], "k int, v double, s string")
    path = scratch_path(spark, "checked")
    checks = [Q.Check("not_null", ["k"]), Q.Check("non_negative", ["v"]), Q.Check("positive", ["v"]),
              Q.Check("accepted_values", ["s"], values=["a", "b"]), Q.Check("min_rows", threshold=4)]
    got = Q.publish_checked(df, checks, lambda d: d.write.parquet(path))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, Q.run_checks(df, checks).collect()))
    assert spark.read.parquet(path).count() == 3
    empty = Q.publish_checked(df.limit(0), checks, lambda d: d.write.mode("append").parquet(path))
    assert {r.check_name: r.failures for r in empty.collect()} == {
        "not_null": 0, "non_negative": 0, "positive": 0, "accepted_values": 0, "min_rows": 1}
    with pytest.raises(ValueError):
        Q.publish_checked(df, [Q.Check("unique", ["k"])], lambda d: None)


def test_statistics_add_up_and_only_new_folders_are_scanned(spark):
    df = spark.range(5000).select(F.col("id"), (F.col("id") % 700).alias("v"), F.concat(F.lit("p/"), F.col("id") % 3).alias("part"))
    df = df.withColumn("v", F.when(F.col("id") % 10 != 0, F.col("v")))
    table = SnapshotTable(spark, scratch_path(spark, "stats"), "part")
    assert Q.refresh_statistics(table, ["v"]) == 0
    table.overwrite(df)
    assert Q.refresh_statistics(table, ["v", "part"]) == 3 and Q.refresh_statistics(table, ["v", "part"]) == 0
    table.replace(df.where("part = 'p/1'").withColumn("v", F.col("v") + 10_000), ["p/1"])
    assert Q.refresh_statistics(table, ["v", "part"]) == 1
    got = {r["column"]: r for r in Q.statistics_of(table).collect()}
    exact = table.read().agg(F.count("*"), F.count_if(F.col("v").isNull()), F.min("v"), F.max("v"), F.count_distinct("v")).first()
    v = got["v"]
    assert (v.rows, v.nulls, float(v.least), float(v.greatest)) == tuple(exact[:4])
    assert math.isclose(v.distinct, exact[4], rel_tol=0.05)
    assert (got["part"].least, got["part"].greatest, got["part"].distinct) == ("p/0", "p/2", 3)


def test_a_reader_that_starts_at_the_end(spark):
    folder, out, ck = (scratch_path(spark, n) for n in ("in", "out", "ck"))
    position = scratch_path(spark, "position") + ".json"

    def ride(i):
        return spark.createDataFrame([(i, 1, 1, 1.0, 1.0, 1.0, 1_700_000_000_000 - i, "2024-01-01 00:00:00")], J.RIDE_SCHEMA)

    def read_on():
        source = stream_source(spark, folder, J.RIDE_SCHEMA, max_files_per_trigger=None, starting="latest", position=position)
        J.run_to_completion(J.to_files(J.pass_through(source), out, ck))

    ride(1).write.json(folder)
    read_on()
    ride(2).write.mode("append").json(folder)
    ride(3).write.mode("append").json(folder)
    read_on()
    ride(4).write.mode("append").json(folder)
    read_on()
    assert sorted(r.trip_id for r in spark.read.parquet(out).collect()) == [2, 3, 4]
    assert not W.commit_text(spark, position, "[]") and W.read_text(spark, position) != "[]"

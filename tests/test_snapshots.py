"""Snapshot tables and the merges on them: whole publications, odd partition values, NULL keys."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from sparkpipe.operators import incremental as inc
from sparkpipe.operators import monitor as M
from sparkpipe.session import scratch_path
from sparkpipe.sinks import writers as W
from sparkpipe.sinks.snapshots import PublicationConflict, SnapshotTable, open_table
from sparkpipe.streaming import jobs as J

SCHEMA = "k int, p string, v int"
ODD = ["a/b", "x:y", "q=r", "50%", "two words", "é#", "007", "{z}", None]


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def targets(spark, rows):
    folder = scratch_path(spark, "folder")
    inc.full_refresh(frame(spark, rows), folder, "p")
    table = SnapshotTable(spark, scratch_path(spark, "table"), "p")
    table.overwrite(frame(spark, rows))

    def read_folder():
        return spark.read.schema("k int, v int, p string").parquet(folder).select("k", "p", "v")
    return [(folder, read_folder), (table, lambda: table.read().select("k", "p", "v"))]


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.mark.parametrize("merge", [inc.merge_upsert, inc.delete_insert])
def test_moved_keys_leave_partitions_of_any_name(spark, merge):
    rows = [(i, p, 1) for i, p in enumerate(ODD)]
    moved = [(i, "c d/e", 9) for i in range(0, len(ODD), 2)]
    for target, read in targets(spark, rows):
        merge(spark, frame(spark, moved), target, ["k"], "p")
        assert rows_of(read()) == sorted([r for r in rows if r[0] % 2] + moved, key=str)


@pytest.mark.parametrize("merge", [inc.merge_upsert, inc.delete_insert])
def test_null_keys_match_null(spark, merge):
    rows = [(None, "a", 1), (1, "a", 1), (None, None, 1), (2, None, 1)]
    for target, read in targets(spark, rows):
        merge(spark, frame(spark, [(None, "a", 5), (2, "b", 5)]), target, ["k"], "p")
        assert rows_of(read()) == sorted([(None, "a", 5), (1, "a", 1), (2, "b", 5)], key=str)
        inc.merge_insert_only(spark, frame(spark, [(None, "a", 6), (3, "a", 6)]), target, ["k"], "p")
        assert rows_of(read()) == sorted([(None, "a", 5), (1, "a", 1), (2, "b", 5), (3, "a", 6)], key=str)


def test_interval_refresh_of_timestamp_partitions(spark):
    at = [dt.datetime(2024, 1, 1, h, 30, 0, 500_000) for h in range(6)]
    df = spark.createDataFrame([(i, t, 1.0) for i, t in enumerate(at)], "id int, ts timestamp_ntz, v double") \
        .withColumn("hour", F.col("ts"))
    folder, table = scratch_path(spark, "hours"), SnapshotTable(spark, scratch_path(spark, "hours"), "hour")
    inc.full_refresh(df, folder, "hour")
    table.overwrite(df)
    new = df.where("id <> 2").withColumn("v", F.lit(2.0))
    for target in (folder, table):
        inc.time_interval_refresh(spark, new, target, "ts", "2024-01-01 01:00:00", "2024-01-01 04:00:00", "hour")
        out = table.read() if target is table else spark.read.parquet(folder)
        assert {r["id"]: r["v"] for r in out.collect()} == {0: 1.0, 1: 2.0, 3: 2.0, 4: 1.0, 5: 1.0}


@pytest.mark.parametrize("step", [
    lambda spark, t, f: inc.merge_upsert(spark, f, t, ["k"], "p"),
    lambda spark, t, f: inc.delete_insert(spark, f, t, ["k"], "p"),
    lambda spark, t, f: t.overwrite(f)])
def test_a_job_that_dies_leaves_the_old_rows(spark, monkeypatch, step):
    rows = [(1, "a/b", 1), (2, "c", 1)]
    table = SnapshotTable(spark, scratch_path(spark, "dies"), "p")
    table.overwrite(frame(spark, rows))
    reader = table.read()
    batch = frame(spark, [(1, "c", 9), (3, "d", 9)])
    with monkeypatch.context() as m:
        m.setattr(SnapshotTable, "_commit", lambda self, snapshot: (_ for _ in ()).throw(RuntimeError("killed")))
        with pytest.raises(RuntimeError, match="killed"):
            step(spark, table, batch)
    assert table.versions() == [0] and rows_of(table.read()) == rows_of(reader) == rows
    step(spark, table, batch)
    after = rows_of(table.read())
    assert (1, "c", 9) in after and (1, "a/b", 1) not in after
    assert rows_of(reader) == rows and rows_of(table.read(version=0)) == rows
    # the files that the dead job left are dropped with the versions that go
    assert table.expire(keep=1) == 1 and rows_of(table.read()) == after
    assert len([n for n in W.list_folders(spark, table.path) if n.startswith("_generation")]) <= 2
    with pytest.raises(ValueError):
        table.read(version=0)


def test_two_writers_of_one_version(spark):
    table = SnapshotTable(spark, scratch_path(spark, "race"), "p")
    table.overwrite(frame(spark, [(1, "a", 1)]))
    base = table.snapshot()
    stale = SnapshotTable(spark, table.path, "p")
    stale.snapshot = lambda version=None: base
    table.append(frame(spark, [(2, "b", 1)]))
    with pytest.raises(PublicationConflict):
        stale.append(frame(spark, [(3, "c", 1)]))
    assert rows_of(table.read()) == [(1, "a", 1), (2, "b", 1)]


def test_empty_tables_unpartitioned_tables_and_pruning(spark):
    path = scratch_path(spark, "none")
    assert open_table(spark, path) is None
    table = SnapshotTable(spark, path)
    with pytest.raises(ValueError):
        table.read()
    table.append(frame(spark, []))
    assert table.read().schema.names == ["k", "p", "v"] and table.read().count() == 0
    table.append(frame(spark, [(1, "a", 1)]))
    assert open_table(spark, path).read().count() == 1
    parted = SnapshotTable(spark, scratch_path(spark, "pruned"), "p")
    parted.overwrite(frame(spark, [(i, p, 1) for i, p in enumerate(ODD)]))
    one = parted.read().where(F.col("p") == "a/b")
    assert "PartitionFilters: [isnotnull(p" in one._jdf.queryExecution().executedPlan().toString()
    assert one.count() == 1


def test_compaction_keeps_the_rows(spark):
    table = SnapshotTable(spark, scratch_path(spark, "small"), "p")
    for i in range(4):
        table.append(frame(spark, [(i, "a", i), (i, str(i % 2), i)]))
    before = rows_of(table.read())
    assert table.compact(most=2) == 4 and rows_of(table.read()) == before
    assert sum("/p=a" in f for f in table.snapshot().folders) == 1
    assert table.compact(most=2) is None


def test_a_repeated_batch_is_taken_once(spark):
    table = SnapshotTable(spark, scratch_path(spark, "replay"), "p")
    run = J.upsert_batches(table, ["k"], "p", writer="w")
    run(frame(spark, [(1, "a", 1), (None, "a", 1)]), 0)
    run(frame(spark, [(1, "a", 2), (None, "a", 2)]), 1)
    versions = table.versions()
    run(frame(spark, [(1, "a", 2), (None, "a", 2)]), 1)
    assert table.versions() == versions and rows_of(table.read()) == [(1, "a", 2), (None, "a", 2)]


def test_retention_by_layout_keeps_what_has_no_day(spark):
    root, day = scratch_path(spark, "lake"), dt.datetime(2024, 1, 10)
    df = spark.createDataFrame([(i, day + dt.timedelta(days=i)) for i in range(-5, 6)] + [(99, None)], "id int, ts timestamp_ntz")
    W.write_json_lake(df, root, "ts", "ticks")
    df.withColumn("d", F.to_date("ts")).write.partitionBy("d").parquet(f"{root}/candles")
    df.withColumn("d", F.col("ts")).write.partitionBy("d").parquet(f"{root}/times")
    kinds = {"ticks": (("yyyy", "MM", "dd"), 3), "candles": (["d"], 2), "times": (["d"], 0), "absent": (["d"], 1)}
    assert M.retain_kinds(spark, root, kinds, day.date()) == {"ticks": 2, "candles": 3, "times": 5, "absent": 0}
    left = spark.read.schema("id int").json(f"{root}/ticks")
    assert sorted(r["id"] for r in left.collect()) == [-3, -2, -1, 0, 1, 2, 3, 4, 5, 99]
    assert sorted(r["id"] for r in spark.read.parquet(f"{root}/candles").collect()) == [-2, -1, 0, 1, 2, 3, 4, 5, 99]
    assert M.drop_expired_partitions(spark, f"{root}/candles", "d", 0, day.date()) == 2


def test_open_silence_and_counter_resets(spark):
    t = dt.datetime(2024, 1, 1)
    rows = [("A", t, 1, 5), ("A", t + dt.timedelta(seconds=60), 2, 9), ("A", t + dt.timedelta(seconds=120), 3, 2),
            ("B", t + dt.timedelta(hours=9), 4, 1), ("C", None, 5, 3), ("D", t + dt.timedelta(hours=10), 6, 1)]
    df = spark.createDataFrame(rows, "symbol string, ts timestamp_ntz, event_id long, sent long")
    gaps = M.silence_gaps(df, as_of=t + dt.timedelta(hours=9, seconds=30)).collect()
    assert [(r["symbol"], r["gap_end"], r["gap_seconds"]) for r in gaps] == [("A", None, 9 * 3600 + 30 - 120)]
    inc_ = M.counter_increase(df, "sent", range_seconds=120, step_seconds=60).collect()
    # the sample at t counts for no step after t + 60, the fall from 9 to 2 is a reset
    assert sorted((r["step"], r["increase"]) for r in inc_) == [
        (t + dt.timedelta(seconds=60), 4), (t + dt.timedelta(seconds=120), 2)]

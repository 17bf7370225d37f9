"""Physical-plan properties that matter at scale, asserted with broadcast joins off
(as they would be for fact tables on a cluster)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF001


@pytest.fixture()
def no_broadcast(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield spark
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    spark.conf.set("spark.sql.adaptive.enabled", "true")


def _exchanges(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [l.strip() for l in plan.splitlines() if "Exchange hashpartitioning" in l]


def test_lineitem_is_shuffled_once(no_broadcast):
    from sparkpipe.plans.marts import deduped_trip_records
    ex = _exchanges(deduped_trip_records(no_broadcast, SF001))
    assert sum("l_orderkey" in e for e in ex) == 1        # dedup and join share one exchange
    assert len(ex) == 4                                    # + orders by key, orders/customer by custkey


def test_sequence_ops_split_hot_keys_by_bucket(no_broadcast):
    from sparkpipe.operators.sequence import previous_row, session_windows, trailing_range_max
    base = dt.datetime(2024, 1, 1)
    df = no_broadcast.createDataFrame([("A", base + dt.timedelta(minutes=i), i, float(i)) for i in range(50)],
                                      "k string, ts timestamp_ntz, id long, v double")
    ex = _exchanges(previous_row(df, ["k"], ["ts", "id"], ["v"]))
    assert sum("_bucket" in e for e in ex) == 2            # the rows once, the combined carry rows once
    assert len(ex) == 3                                    # + the carry rows by key
    ex = _exchanges(session_windows(df, ["k"], ["ts", "id"], 300))
    assert len(ex) == 2                                    # the rows by (key, hour), the pieces by key
    ex = _exchanges(trailing_range_max(df, ["k"], "ts", "v", 300, "m"))
    assert len(ex) == 1


def test_one_scan_and_one_parse(spark):
    from sparkpipe.plans import markets as M
    for q in (M.producer_counters, M.error_increase, M.stale_split, M.price_drop_5m):
        plan = q(spark, SF001)._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("parquet") == 1 and plan.count("from_json") == 1, q.__name__


def test_merge_target_scan_is_partition_pruned(spark):
    from sparkpipe.operators.incremental import _in_partitions, _read_target, full_refresh
    from sparkpipe.session import scratch_path
    path = scratch_path(spark, "pp")
    rows = spark.range(30).withColumn("d", F.expr("date_add(date'2024-01-01', cast(id as int))"))
    full_refresh(rows, path, "d")
    sl = _read_target(spark, path, rows, "d").filter(_in_partitions("d", [dt.date(2024, 1, 5), dt.date(2024, 1, 6)]))
    plan = sl._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [d#" in plan or "PartitionFilters: [isnotnull(d" in plan
    scanned = sl.select(F.col("_metadata.file_path")).distinct().count()
    assert scanned == 2                                    # only the two requested day folders


def test_quality_checks_one_expand_one_shuffle(spark):
    from sparkpipe.plans.checks import quality_report
    plan = quality_report(spark, SF001)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Expand") == 1
    assert plan.count("Exchange hashpartitioning") == 1


def test_count_star_reads_only_footers(spark):
    from sparkpipe.operators.quality import metadata_row_count
    df = metadata_row_count(spark, SF001 + "/lineitem.parquet")
    assert "PushedAggregation: [COUNT(*)]" in df._jdf.queryExecution().executedPlan().toString()
    assert df.first()[0] == spark.read.parquet(SF001 + "/lineitem.parquet").count()
    assert spark.conf.get("spark.sql.parquet.aggregatePushdown") == "false"   # the caller's session is left alone


def test_hot_key_is_spread_over_tasks(no_broadcast):
    """One key holds 90 % of the rows; the bucketed lag still spreads it over many tasks."""
    spark = no_broadcast
    from sparkpipe.operators.sequence import previous_row
    rows = spark.range(20_000).select(
        F.when(F.col("id") % 10 == 0, F.lit("COLD")).otherwise(F.lit("HOT")).alias("k"),
        F.timestamp_add("MINUTE", F.col("id"), F.lit(dt.datetime(2024, 1, 1)).cast("timestamp_ntz")).alias("ts"),
        F.col("id"), F.col("id").cast("double").alias("v"))
    out = previous_row(rows, ["k"], ["ts", "id"], ["v"]).withColumn("pid", F.spark_partition_id())
    sizes = [r["count"] for r in out.groupBy("pid").count().collect()]
    assert max(sizes) < 0.5 * 20_000          # a plain partitionBy(k) window would put 90 % in one task
    assert out.filter(F.col("prev_v").isNull()).count() == 2   # only each key's first row lacks a previous row


def test_dedup_combines_map_side(spark):
    from sparkpipe.operators.dedup import dedup
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), F.col("id").alias("v"))
    plan = dedup(df, ["k"], ["v"])._jdf.queryExecution().executedPlan().toString()
    lines = plan.splitlines()
    ex = next(i for i, l in enumerate(lines) if "Exchange hashpartitioning" in l)
    assert any("partial_min" in l for l in lines[ex:])        # partial aggregate below the exchange


def test_partitioned_write_splits_hot_day_and_limits_files(spark):
    import os
    from sparkpipe.operators.incremental import full_refresh
    from sparkpipe.session import scratch_path
    n = 40_000
    df = spark.range(n).repartition(8).select(
        "id", F.when(F.col("id") % 10 == 0, F.expr("date_add(date'2024-01-02', cast(id % 20 as int))"))
               .otherwise(F.lit(dt.date(2024, 1, 1))).alias("d"))        # one day holds 90 % of the rows
    path = scratch_path(spark, "layout")
    # At this size AQE would merge all range partitions into one; large writes are not merged.
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        full_refresh(df, path, "d")
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    local = path[len("file:"):] if path.startswith("file:") else path
    files = {d: [f for f in os.listdir(os.path.join(local, d)) if f.endswith(".parquet")]
             for d in os.listdir(local) if d.startswith("d=")}
    assert len(files["d=2024-01-01"]) > 1                       # the hot day is written by several tasks
    total = sum(len(v) for v in files.values())
    assert total < 8 * len(files)                              # not every task writes into every folder
    assert spark.read.parquet(path).count() == n


def test_one_hot_minute_is_spread_by_rows(no_broadcast):
    """All rows lie in one minute of one key: no task of the ordered scan has more than twice the mean."""
    spark = no_broadcast
    from sparkpipe.operators.sequence import previous_row
    from tests.test_sequence import _hot_minute
    n = 60_000
    out = previous_row(_hot_minute(spark, n), ["k"], ["ts", "id"], ["v"], max_rows=500)
    tasks = [r[1] for r in out.groupBy(F.spark_partition_id()).agg(F.count("*"), F.max("prev_v")).collect()]
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert len(tasks) == parts and sum(tasks) == n
    assert max(tasks) <= 2 * n / parts

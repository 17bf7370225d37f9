import datetime as dt
import math

from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkpipe.functions.columns import (nan_to_null, replace_columns, round_half_up, safe_cast_columns,
                                         to_utc_timestamp_or_null)
from sparkpipe.operators.union import union_aligned
from sparkpipe.session import scratch_path
from sparkpipe.sinks import writers as W
from sparkpipe.sources.files import load_many
from tests.conftest import SF001


def test_round_half_up_on_decimal_value(spark):
    df = spark.createDataFrame([(1.005,), (2.675,), (0.125,)], "x double")
    assert [r.r for r in df.select(round_half_up("x", 2).alias("r")).collect()] == [1.01, 2.68, 0.13]


def test_safe_cast_case_insensitive_and_bad_values_null(spark):
    df = spark.createDataFrame([("12", "x", "2024-01-01 00:00:00"), ("oops", "y", "not a time")],
                               "PULocationID string, other string, t string")
    out = safe_cast_columns(df, {"pulocationid": "int", "missing": "int"})
    assert [r.PULocationID for r in out.collect()] == [12, None]           # P05
    ts = [r.ts for r in df.select(to_utc_timestamp_or_null("t").alias("ts")).collect()]
    assert ts[0] is not None and ts[1] is None                             # P06


def test_nan_to_null_and_replace(spark):
    df = spark.createDataFrame([(float("nan"), 1.0), (2.0, None)], "a double, b double")
    rows = nan_to_null(df).collect()
    assert rows[0].a is None and rows[1].a == 2.0                          # P09
    r = replace_columns(df, {"b": F.lit(0.0)})                             # P22
    assert r.columns == ["a", "b"] and all(x.b == 0.0 for x in r.collect())
    assert math.isnan(df.first().a)


def test_union_aligned_typed_placeholders(spark):
    a = spark.createDataFrame([(1, 2.5)], "id int, fare double")
    b = spark.createDataFrame([("7",)], "id string")
    out = union_aligned([a, b], T.StructType([T.StructField("id", T.LongType()), T.StructField("fare", T.DoubleType())]))
    assert sorted(tuple(r) for r in out.collect()) == [(1, 2.5), (7, None)]  # U01, P07


def test_load_many_skips_and_reports(spark):
    ok = SF001 + "/orders.parquet"
    df, rep = load_many(spark, [ok, SF001 + "/nope.parquet", SF001 + "/region.parquet"],
                        ["o_orderkey"], constants={"taxi_type": "yellow"})
    assert rep.loaded == [ok] and len(rep.skipped) == 2                   # S11, D19
    assert df.columns == ["o_orderkey", "taxi_type"]
    schema = T.StructType([T.StructField("x", T.IntegerType())])
    empty, rep2 = load_many(spark, [SF001 + "/nope.parquet"], ["x"], schema=schema)
    assert empty.count() == 0 and empty.schema == schema                    # S12


def test_csv_to_parquet_skips_existing_and_ddl(spark):
    src = scratch_path(spark, "csv")
    spark.createDataFrame([(1, "a")], "id int, name string").write.option("header", True).csv(src)
    dst = scratch_path(spark, "pq")
    W.convert_csv_to_parquet(spark, src, dst, schema="id int, name string")   # K05
    W.convert_csv_to_parquet(spark, src, dst, schema="id int, name string")   # exists: skipped
    back = spark.read.parquet(dst)
    assert back.count() == 1
    assert W.ddl_of(back) == "id INT,name STRING"                             # K09


def test_create_table_if_not_exists_and_materialize(spark):
    name = "t_" + scratch_path(spark, "x").rsplit("-", 1)[1]
    schema = "id int, d date"
    assert W.create_table_if_not_exists(spark, name, schema, path=scratch_path(spark, "tbl"))   # K11, K08
    assert not W.create_table_if_not_exists(spark, name, schema)
    v = W.materialize(spark.range(3), name + "_v")                                            # K17 view
    assert v.count() == 3
    from sparkpipe.operators.quality import schema_info
    assert "id" in schema_info(v)                                                              # Q10


def test_sample_switch_off_by_default(spark):
    from sparkpipe.plans.marts import staged_trips
    assert staged_trips(spark, SF001, sample=5).count() == 5                                   # M10
    assert staged_trips(spark, SF001).count() > 5


def test_messages_and_time_helpers(spark):
    from sparkpipe.functions.timefn import epoch_ms_to_timestamp, month_start, timestamp_to_epoch_ms
    df = spark.createDataFrame([(dt.datetime(2024, 3, 15, 10, 0, 0, 123000),)], "ts timestamp_ntz")
    r = df.select(timestamp_to_epoch_ms("ts").alias("ms"), month_start("ts").alias("m")).first()
    assert r.m == dt.date(2024, 3, 1)
    back = spark.createDataFrame([(r.ms,)], "ms long").select(epoch_ms_to_timestamp("ms").cast("timestamp_ntz")).first()[0]
    assert back == dt.datetime(2024, 3, 15, 10, 0, 0, 123000)                                 # F13, F14
    msg = W.to_messages(df, key=None).first().value
    assert msg.startswith('{"ts":"2024-03-15T10:00:00.123')                                   # K16, F20


def test_retention_drops_expired_day_folders(spark):
    from sparkpipe.operators.incremental import full_refresh
    from sparkpipe.operators.monitor import drop_expired_partitions, retain
    df = spark.range(10).withColumn("d", F.expr("date_add(date'2024-01-01', cast(id as int))"))
    path = scratch_path(spark, "ret")
    full_refresh(df, path, "d")
    dropped = drop_expired_partitions(spark, path, "d", 3, dt.date(2024, 1, 10))      # O07
    assert dropped == 6 and spark.read.parquet(path).count() == 4
    kept = retain(df.withColumn("ts", F.col("d").cast("timestamp_ntz")), "ts", 3, "2024-01-10 00:00:00")
    assert kept.count() == 4


def test_month_column_and_partition(spark):
    out = W.with_month(spark.range(2), "2024-03")                                     # K06
    path = scratch_path(spark, "mon")
    W.write_parquet(out, path, partition_by=["month"])
    assert W.list_partition_values(spark, path, "month") == ["2024-03"]


def test_a_few_files_are_not_written_from_a_shuffle(spark, tmp_path):
    rows = spark.range(0, 1001, 1, 7).selectExpr("if(id % 10 = 0, null, id) as id", "id % 3 as _piece", "cast(id as string) as `a.b`")
    plans, real = [], W._save
    W._save = lambda df, *rest: (plans.append(df._jdf.queryExecution().executedPlan().toString()), real(df, *rest))
    try:
        for mode, n in (("overwrite", 1001), ("append", 2002), ("overwrite", 1001)):
            path = str(tmp_path / "few")
            W.write_parquet(rows, path, mode, num_files=4)
            back = spark.read.parquet(path)
            assert back.count() == n and back.exceptAll(rows.unionByName(rows)).isEmpty() and back.columns == rows.columns
            assert len(list((tmp_path / "few").glob("part-*"))) == 4 * n // 1001
    finally:
        W._save = real
    assert len(plans) == 3 and not any("Exchange" in p for p in plans)
    sizes = [spark.read.parquet(str(f)).count() for f in (tmp_path / "few").glob("part-*")]
    assert max(sizes) - min(sizes) <= 7
    W.write_parquet(rows.limit(0), str(tmp_path / "none"), num_files=4)
    W.write_parquet(rows, str(tmp_path / "by"), partition_by=["_piece"], num_files=2)
    assert spark.read.parquet(str(tmp_path / "none")).dtypes == rows.dtypes and spark.read.parquet(str(tmp_path / "by")).count() == 1001


def test_csv_declared_schema_reports_malformed_cells(spark):
    from sparkpipe.sources.files import read_csv
    path = scratch_path(spark, "bad_csv")
    spark.createDataFrame([("1", "a", "x"), ("oops", "b", "y")], "id string, name string, extra string") \
         .write.option("header", True).csv(path)
    df = read_csv(spark, path, "id int, name string", keep_corrupt=True)                      # S08
    rows = {r.name: (r.id, r._corrupt_record) for r in df.collect()}
    assert rows["b"][0] is None and rows["b"][1] is not None                                  # bad cell kept
    assert rows["a"][0] == 1                      # surplus column dropped from the values (the line is flagged)

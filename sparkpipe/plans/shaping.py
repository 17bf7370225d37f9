"""Readers, shaping functions, unions and loads, each applied to whole test tables (S03-S05,
S12, S19, K02, K05, K06, K08, K09, K11, K17, M01, M09, P02-P06, P09, P22, U01, U02, F06, F18,
F22, A18, Q05).

Where a query needs a file format or a folder layout, it first writes the table that way
below the shared checkpoint folder and then reads it as a job would.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import (cast_block, nan_to_null, replace_columns, rename_columns, lineage_columns,
                                 round_half_up, safe_cast_columns, to_utc_timestamp_or_null)
from ..functions.timefn import format_timestamp, month_start
from ..operators import incremental as inc
from ..operators.quality import Check, custom_check, publish_checked, refresh_statistics, statistics_of
from ..operators.ticks import symbol_path
from ..operators.union import union_aligned
from ..session import scratch_path
from ..sinks.snapshots import SnapshotTable
from ..sinks.writers import (convert_csv_to_parquet, create_table_if_not_exists, ddl_of, materialize, with_month,
                             write_parquet)
from ..sources.files import load_period, read_csv, read_table
from . import markets

ORDER_COLUMNS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]
ORDER_CSV = ("o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
             "o_orderdate timestamp_ntz, o_orderpriority string")
SERVICES = {"F": "Yellow", "O": "Green"}


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "orders").select(*ORDER_COLUMNS)


def _as_csv(df: DataFrame, spark: SparkSession, **options) -> str:
    path = scratch_path(spark, "csv")
    df.write.options(header=True, timestampNTZFormat="yyyy-MM-dd HH:mm:ss", **options).csv(path)
    return path


def csv_typed_gzip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gzipped CSV with declared types and parsed dates."""
    path = _as_csv(_orders(spark, sf_dir), spark, compression="gzip")
    return read_csv(spark, path, ORDER_CSV, timestamp_format="yyyy-MM-dd HH:mm:ss")


def csv_all_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CSV with a header and no types: every column is text."""
    return read_csv(spark, _as_csv(_orders(spark, sf_dir).drop("o_totalprice"), spark))


def csv_inferred(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CSV with inferred types (S05); the types found are part of the result."""
    c = read_csv(spark, _as_csv(read_table(spark, sf_dir, "customer"), spark), infer=True)
    return c.select("c_custkey", "c_acctbal", "c_mktsegment", F.typeof("c_custkey").alias("key_type"),
                    F.typeof("c_acctbal").alias("balance_type"))


def csv_to_parquet_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CSV to parquet (K05): the second conversion finds the target and leaves it alone."""
    c = read_table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal")
    target = scratch_path(spark, "converted")
    for source in (c, c.withColumn("c_acctbal", F.lit(0.0))):
        convert_csv_to_parquet(spark, _as_csv(source, spark), target, "c_custkey bigint, c_acctbal double")
    return spark.read.parquet(target)


def _month_files(df: DataFrame, spark: SparkSession) -> str:
    root = scratch_path(spark, "by_month")
    month = format_timestamp("o_orderdate", "yyyy-MM")
    inc.full_refresh(df.withColumn("orders_tripdata", month), root, "orders_tripdata")
    return root


def period_files_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files named by a template (S11, S19, F22), found by one listing and read by one scan, then
    counted by the month in their name; orders without a date have a file of their own."""
    root = _month_files(_orders(spark, sf_dir), spark)
    o, _ = load_period(spark, root, "o_orderkey bigint, o_totalprice double", "{kind}_tripdata={month}", kinds=["orders"])
    return o.groupBy("month").agg(F.count(F.lit(1)).alias("orders"), round_half_up(F.sum("o_totalprice"), 2).alias("revenue"))


def month_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Output of a parameterised month (K06): a month column and a file of its own, for three of
    the months; the period reader takes the two it is asked for (S19)."""
    o, root = _orders(spark, sf_dir), scratch_path(spark, "outputs")
    for month in ("1996-12", "1997-01", "1997-02"):
        rows = o.filter(format_timestamp("o_orderdate", "yyyy-MM") == month).drop("o_orderpriority")
        write_parquet(with_month(rows, month), f"{root}/orders_tripdata_{month}.parquet")
    out, _ = load_period(spark, root, o.drop("o_orderpriority").schema, first="1997-01", last="1997-06",
                         expected=[f"1997-{m:02d}" for m in range(1, 7)])
    return out


def order_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders by yyyy-MM text."""
    o = _orders(spark, sf_dir)
    return o.groupBy(format_timestamp("o_orderdate", "yyyy-MM").alias("month")).agg(F.count(F.lit(1)).alias("orders"))


def safe_cast_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Safe casts by case-insensitive name (P05): text that is no number becomes NULL, a column
    that is not there is ignored."""
    p = read_table(spark, sf_dir, "part").withColumn(
        "code", F.when(F.col("p_size") % 2 == 0, F.col("p_size").cast("string")).otherwise(F.col("p_brand")))
    return safe_cast_columns(p, {"CODE": "int", "P_Size": "string", "absent": "int"}).select("p_partkey", "code", "p_size")


def coerce_timestamps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text to timestamps, NULL where it does not parse."""
    o = _orders(spark, sf_dir)
    text = F.when(F.col("o_orderkey") % 5 == 0, F.concat(F.lit("on "), "o_orderpriority")) \
            .otherwise(format_timestamp("o_orderdate"))
    at = to_utc_timestamp_or_null(text, "yyyy-MM-dd HH:mm:ss").cast("timestamp_ntz")
    return o.select("o_orderkey", at.alias("ordered_at"))


def nan_to_null_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """NaN becomes NULL before rows are serialised."""
    e = read_table(spark, sf_dir, "events").select("event_id", F.when(F.col("event_id") % 3 == 0, F.lit(float("nan")))
                                                   .otherwise(F.col("value")).alias("value"))
    return nan_to_null(e)


def replaced_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``SELECT * REPLACE`` (P22) and a typed cast block (P04): same columns, new values."""
    o = replace_columns(_orders(spark, sf_dir), {"o_orderpriority": F.lower("o_orderpriority"),
                                                 "o_totalprice": F.floor("o_totalprice")})
    return cast_block(o, {"o_totalprice": "bigint", "o_custkey": "string"})


def lake_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ticks by lake folder and file stem, symbol/yyyy/MM/dd/HHmm."""
    t = markets.clean_ticks(spark, sf_dir)
    return t.groupBy(symbol_path("symbol", "ts").alias("path")).agg(F.count(F.lit(1)).alias("ticks"))


def sum_of_none(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Global sums with default 0 (A18): one row also where no event qualifies."""
    e = read_table(spark, sf_dir, "events")
    return e.filter(F.col("value") < 0).agg(F.coalesce(F.sum("value"), F.lit(0.0)).alias("total"),
                                            F.count(F.lit(1)).alias("events"))


def custom_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scalar SQL against an expected value (Q05): one check that holds and one that does not."""
    o = _orders(spark, sf_dir)
    none = custom_check(spark, "SELECT count(*) FROM {o} WHERE o_totalprice < 0", 0, "no_negative_price", o=o)
    keys = custom_check(spark, "SELECT count(*) FROM {o}", -1, "impossible_count", o=o)
    return none.unionByName(keys)


def _staged_services(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """Three sources stored apart, with their own column names and columns."""
    o = _orders(spark, sf_dir)
    service = F.coalesce(F.element_at(F.create_map(*[F.lit(x) for kv in SERVICES.items() for x in kv]),
                                      F.col("o_orderstatus")), F.lit("FHV"))
    root = scratch_path(spark, "services")
    write_parquet(o.withColumn("service", service), root, partition_by=["service"])
    yellow, green, fhv = (spark.read.parquet(f"{root}/service={s}") for s in ("Yellow", "Green", "FHV"))
    sources = {"Yellow": yellow.drop("o_orderpriority"), "Green": green, "FHV": fhv.drop("o_totalprice")}
    names = {"o_orderkey": "trip_id", "o_totalprice": "fare_amount", "o_orderdate": "pickup_datetime",
             "o_orderpriority": "trip_type", "o_custkey": "vendor_id"}
    return [lineage_columns(rename_columns(df.drop("o_orderstatus"), names), {"service_type": s})
            for s, df in sources.items()]


SERVICE_SCHEMA = "trip_id bigint, vendor_id bigint, fare_amount double, pickup_datetime timestamp_ntz, " \
                 "trip_type string, service_type string"


def union_services(spark: SparkSession, sf_dir: str) -> DataFrame:
    """UNION ALL of three separately staged services, typed NULL where one lacks a column."""
    return union_aligned(_staged_services(spark, sf_dir), spark.createDataFrame([], SERVICE_SCHEMA).schema)


def union_service_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    """UNION ALL of three aggregates by month; the service without fares has NULL revenue."""
    parts = []
    for df in _staged_services(spark, sf_dir):
        fare = [round_half_up(F.sum("fare_amount"), 2).alias("revenue")] if "fare_amount" in df.columns else []
        parts.append(df.groupBy("service_type", month_start("pickup_datetime").alias("month"))
                     .agg(F.count(F.lit(1)).alias("trips"), *fare))
    return union_aligned(parts, parts[0].schema)


def backfill_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The backfill run in chunks of 18 months (M01, M09): the first replaces an old target, the
    others append; the cap's own day is loaded."""
    o = _orders(spark, sf_dir)
    target = scratch_path(spark, "backfill")
    inc.append(o, target)                                    # what the full refresh must replace
    first, last = o.agg(F.min("o_orderdate"), F.max("o_orderdate")).first()

    def load(start: dt.date, end: dt.date, full: bool) -> None:
        chunk = o.filter((F.to_date("o_orderdate") >= F.lit(start)) & (F.to_date("o_orderdate") < F.lit(end)))
        (inc.full_refresh if full else inc.append)(chunk, target)

    if first is not None:
        inc.backfill(first.date(), last.date(), 18, load, cap=dt.date(2001, 6, 30))
    return spark.read.schema(o.schema).parquet(target)


class _Killed(RuntimeError):
    pass


def backfill_resumed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A backfill that dies in its third chunk and is started again (M09): chunks that were
    published are passed over, each order is there once."""
    o = _orders(spark, sf_dir)
    table = SnapshotTable(spark, scratch_path(spark, "backfill"))
    table.overwrite(o.limit(10))                             # what the full refresh must replace
    first, last = o.agg(F.min("o_orderdate"), F.max("o_orderdate")).first()
    tries = []

    def rows(start: dt.date, end: dt.date) -> DataFrame:
        tries.append(start)
        if len(tries) == 3:
            raise _Killed
        return o.filter((F.to_date("o_orderdate") >= F.lit(start)) & (F.to_date("o_orderdate") < F.lit(end)))

    for _ in range(2):
        try:
            if first is not None:
                inc.backfill_table(table, rows, first.date(), last.date(), 18, run="history")
        except _Killed:
            continue
    return table.read()


def checked_publish(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Checks that run inside the publishing job (Q01, Q03, Q04): one pass writes and counts."""
    li = read_table(spark, sf_dir, "lineitem")
    checks = [Check("not_null", ["l_orderkey"]), Check("non_negative", ["l_tax"]), Check("positive", ["l_discount"]),
              Check("accepted_values", ["l_returnflag"], values=["A", "N"]), Check("min_rows", threshold=1)]
    target = scratch_path(spark, "checked")
    return publish_checked(li, checks, lambda df: df.write.parquet(target))


def table_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics kept beside a table and added up over its partitions (Q08): after an upsert only
    the new folders are scanned."""
    o = _orders(spark, sf_dir).withColumn("order_month", F.trunc(F.to_date("o_orderdate"), "month"))
    table = SnapshotTable(spark, scratch_path(spark, "measured"), "order_month")
    table.overwrite(o.filter(F.col("o_orderkey") % 3 != 0))
    columns = ["o_orderkey", "o_totalprice", "o_orderdate", "o_orderstatus"]
    refresh_statistics(table, columns)
    late = o.filter(F.col("o_orderdate") >= F.lit("2000-07-01").cast("timestamp_ntz"))
    inc.merge_upsert(spark, late.withColumn("o_orderstatus", F.when(F.col("o_orderkey") % 5 != 0, F.col("o_orderstatus"))),
                     table, ["o_orderkey"], "order_month", order=["o_orderdate"])
    refresh_statistics(table, columns)
    return statistics_of(table).select("column", "rows", "nulls", "least", "greatest")


def table_copy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table created from a frame's DDL if it is not there, filled, and copied by CTAS (K02, K08,
    K09, K11, K17).  Both tables are external; their names are dropped, their files are the result."""
    o = _orders(spark, sf_dir)
    name = f"orders_{uuid.uuid4().hex[:10]}"
    paths = {n: scratch_path(spark, n) for n in (name, f"{name}_copy")}
    from pyspark.sql import types as T
    try:
        for _ in range(2):                                   # the second call finds the table
            create_table_if_not_exists(spark, name, T.StructType.fromDDL(ddl_of(o)), paths[name])
        inc.append(o, paths[name])
        spark.catalog.refreshTable(name)
        materialize(spark.table(name), f"{name}_copy", as_table=True, path=paths[f"{name}_copy"])
    finally:
        for n in paths:
            spark.sql(f"DROP TABLE IF EXISTS {n}")
    return spark.read.parquet(paths[f"{name}_copy"])


QUERIES = {
    "csv_typed_gzip": csv_typed_gzip,
    "csv_all_strings": csv_all_strings,
    "csv_inferred": csv_inferred,
    "csv_to_parquet_once": csv_to_parquet_once,
    "period_files_load": period_files_load,
    "order_months": order_months,
    "safe_cast_parts": safe_cast_parts,
    "coerce_timestamps": coerce_timestamps,
    "nan_to_null_events": nan_to_null_events,
    "replaced_columns": replaced_columns,
    "lake_paths": lake_paths,
    "sum_of_none": sum_of_none,
    "custom_checks": custom_checks,
    "union_services": union_services,
    "union_service_months": union_service_months,
    "backfill_run": backfill_run,
    "table_copy": table_copy,
    "month_output": month_output,
    "backfill_resumed": backfill_resumed,
    "checked_publish": checked_publish,
    "table_statistics": table_statistics,
}

"""Bind the reference's roles (trips, zones, payments, ticks) to the test tables.

The bindings are declared in FIXTURES.md §3.  Each function returns a lazy frame over
the given parquet tables, so every query's work grows with those tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import NUMERIC
from ..functions.timefn import add_hours, add_minutes
from ..operators.joins import lookup_join
from ..sources.files import read_table, spread

N_LOCATIONS = 25

# The payment-type seed (id, name), ids 0-6.
PAYMENT_TYPES = [
    (0, "flex_fare"),
    (1, "credit_card"),
    (2, "cash"),
    (3, "no_charge"),
    (4, "dispute"),
    (5, "unknown"),
    (6, "voided_trip"),
]
PAYMENT_SCHEMA = T.StructType([
    T.StructField("payment_type_id", T.IntegerType(), False),
    T.StructField("payment_type_name", T.StringType(), False),
])


def tables(spark: SparkSession, sf_dir: str, *names: str) -> list[DataFrame]:
    return [read_table(spark, sf_dir, n) for n in names]


def zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Zone dimension: location id, borough, zone, service zone (nation ⋈ region)."""
    nation, region = tables(spark, sf_dir, "nation", "region")
    joined = lookup_join(nation, region.withColumnRenamed("r_regionkey", "n_regionkey"), "n_regionkey")
    return joined.select(
        F.col("n_nationkey").alias("location_id"),
        F.col("r_name").alias("borough"),
        F.col("n_name").alias("zone"),
        F.when(F.col("n_regionkey") % 2 == 0, F.lit("Boro Zone")).otherwise(F.lit("Yellow Zone")).alias("service_zone"),
    )


def payment_lookup(spark: SparkSession) -> DataFrame:
    """Payment-type seed (S06): seven rows, a dimension by definition.

    Built as a SQL ``VALUES`` relation: it lives in the JVM plan (no Python worker) and
    carries an exact size estimate, so the broadcast check needs no job.
    """
    rows = ", ".join(f"({i}, '{name}')" for i, name in PAYMENT_TYPES)
    df = spark.sql(f"SELECT * FROM VALUES {rows} AS t(payment_type_id, payment_type_name)")
    return df.select(*[F.col(f.name).cast(f.dataType) for f in PAYMENT_SCHEMA.fields])


def event_k(props: str = "props"):
    return F.get_json_object(F.col(props), "$.k").cast("int")


def trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trip view over ``events``: pickup = ts, dropoff = ts + k minutes, and so on."""
    (ev,) = tables(spark, sf_dir, "events")
    k = event_k()
    return ev.select(
        F.col("event_id").alias("trip_id"),
        F.col("ts").alias("pickup_datetime"),
        add_minutes("ts", k).alias("dropoff_datetime"),
        (F.col("user_id") % N_LOCATIONS).cast("int").alias("pickup_location_id"),
        (k % N_LOCATIONS).alias("dropoff_location_id"),
        (k / F.lit(10)).alias("trip_distance"),
        F.col("value").alias("fare_amount"),
        F.col("value").alias("total_amount"),
        (k % 8).alias("payment_type"),
        F.col("event_type").alias("taxi_type"),
        F.col("user_id").alias("vendor_id"),
    )


def raw_trip_records(spark: SparkSession, sf_dir: str, lineitem: DataFrame | None = None) -> DataFrame:
    """Raw yellow/green/FHV records: lineitem ⋈ (orders ⋈ customer), typed as the sources.

    Both joins are fact-to-fact at scale, so they are left to the planner (sort-merge,
    AQE free to broadcast at runtime).  The join order is written out because Catalyst
    does not reorder joins without cost statistics: orders ⋈ customer first (orders is a
    quarter of lineitem), then lineitem on the order key — so the largest table is
    shuffled once, by ``l_orderkey``, and a lineitem already partitioned by that key
    (see ``marts.deduped_trip_records``) is not shuffled again.
    """
    od, cu = tables(spark, sf_dir, "orders", "customer")
    li = lineitem if lineitem is not None else read_table(spark, sf_dir, "lineitem")
    od = od.select("o_orderkey", "o_custkey", "o_orderstatus")
    cu = cu.select("c_custkey", "c_nationkey")
    oc = od.join(cu, od.o_custkey == cu.c_custkey).select("o_orderkey", "o_orderstatus", "c_nationkey")
    # Fact-to-fact: a sort-merge join on the order key, whose lineitem side reuses the
    # caller's partitioning; the hint keeps AQE from broadcasting the large side.
    j = li.hint("merge").join(oc, li.l_orderkey == oc.o_orderkey)
    price = F.col("l_extendedprice").cast(T.DecimalType(12, 2))
    disc = F.col("l_discount").cast(T.DecimalType(4, 2))
    tax = F.col("l_tax").cast(T.DecimalType(4, 2))
    return j.select(
        "l_orderkey", "l_linenumber",
        F.when(F.col("o_orderstatus") == "F", "Yellow")
         .when(F.col("o_orderstatus") == "O", "Green")
         .otherwise("FHV").alias("service_type"),
        F.col("l_suppkey").alias("vendorid"),
        F.lit(1).alias("ratecodeid"),
        F.col("c_nationkey").alias("pickup_locationid"),
        ((F.col("c_nationkey") + F.col("l_linenumber")) % N_LOCATIONS).cast("int").alias("dropoff_locationid"),
        F.col("l_shipdate").alias("pickup_datetime"),
        add_hours("l_shipdate", F.col("l_linenumber")).alias("dropoff_datetime"),
        F.lit("N").alias("store_and_fwd_flag"),
        F.col("l_quantity").alias("passenger_count"),
        (F.col("l_quantity") / F.lit(4)).alias("trip_distance"),
        F.col("l_linenumber").alias("trip_type"),
        F.col("l_extendedprice").alias("fare_amount"),
        F.col("l_discount").alias("extra"),
        F.col("l_tax").alias("mta_tax"),
        (price * disc).cast(NUMERIC).alias("tip_amount"),
        F.lit(0.0).alias("tolls_amount"),
        F.lit(None).cast("double").alias("ehail_fee"),
        F.lit(0.3).alias("improvement_surcharge"),
        (price * (F.lit(1) - disc) * (F.lit(1) + tax)).cast(NUMERIC).alias("total_amount"),
        (F.col("l_linenumber") % 5).alias("payment_type"),
        F.lit(2.5).alias("congestion_surcharge"),
        "l_partkey", "l_returnflag", "l_linestatus",
    )


def tick_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tick view over ``events`` (columns, before JSON): symbol, price, volume, time, bid/ask.

    ``ingest_ts`` is the processing time of the replay: the event arrives
    ``user_id % 60`` seconds after it happened, so the stale filter has work to do.
    """
    # Ticks carry per-row JSON work downstream: spread a scan that one task would read.
    ev = spread(read_table(spark, sf_dir, "events"))
    mod4 = F.col("event_id") % 4
    side = F.when(mod4 == 0, F.lit(None).cast("double")).when(mod4 == 1, F.lit(0.0))
    return ev.select(
        "event_id",
        F.concat(F.upper("event_type"), F.lit("/USDT")).alias("symbol"),
        F.col("value").alias("price"),
        event_k().cast("double").alias("volume"),
        F.col("ts").alias("ts"),
        F.lit("SIM").alias("exchange"),
        side.otherwise(F.col("value") * F.lit(0.9995)).alias("bid"),
        side.otherwise(F.col("value") * F.lit(1.0005)).alias("ask"),
        F.timestamp_add("SECOND", F.col("user_id") % 60, F.col("ts")).alias("ingest_ts"),
    )


def tick_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ticks as JSON messages keyed by symbol (K16): ``key``, ``value``, ``event_id``, ``ingest_ts``."""
    t = tick_records(spark, sf_dir)
    body = F.to_json(F.struct(
        "symbol", "price", "volume",
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("timestamp"),
        "exchange", "bid", "ask",
    ))
    return t.select("event_id", F.col("symbol").alias("key"), body.alias("value"), "ingest_ts")

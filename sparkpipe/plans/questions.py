"""The workbook's analytic questions.

Each query is a function ``(spark, sf_dir) -> DataFrame`` over the test tables.  Top-k
answers order by the measure and then by a unique key (D5) so ties cannot change the
answer; Spark plans ``orderBy(...).limit(k)`` as ``TakeOrderedAndProject`` (a per-task
top-k followed by a merge of k rows per task, never a global sort).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import keep_columns_with_default, round_half_up
from ..functions.timefn import day_of, hours_between, in_half_open
from ..operators.joins import lookup_join, role_join
from ..sources.files import read_table
from . import bindings as B
from ..operators.sequence import session_windows
from ..operators.windows import reaggregate, top_n, tumbling_totals

# Parameters of the questions (the data covers 2024-01-01 .. 2024-01-30 for events and
# 1995 .. 2001 for lineitem).
REPORT_DAY = "2024-01-15"
MONTH_START, MONTH_END = "2024-01-01", "2024-02-01"
HALF_MONTH_END = "2024-01-15"
PICKUP_ZONE = "NATION_7"
RANGE_START, RANGE_END = "1996-03-01", "1996-03-15"
VENDOR_RANGE_START, VENDOR_RANGE_END = "1996-03-01", "1996-03-31"


def top_zone_revenue_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pickup zone with the largest total on one day."""
    t = B.trips(spark, sf_dir).filter(day_of("pickup_datetime") == F.lit(REPORT_DAY).cast("date"))
    z = B.zones(spark, sf_dir).select("location_id", "zone")
    j = lookup_join(t, z, t.pickup_location_id == z.location_id)
    agg = j.groupBy(F.col("zone").alias("pickup_zone")).agg(
        round_half_up(F.sum("total_amount"), 2).alias("total_amount_sum"),
        F.count(F.lit(1)).alias("trip_count"))
    return agg.orderBy(F.desc("total_amount_sum"), "pickup_zone").limit(1)


def largest_amount_by_dropoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dropoff zone of the largest single amount from one pickup zone."""
    t = B.trips(spark, sf_dir).filter(in_half_open("pickup_datetime", MONTH_START, MONTH_END))
    z = B.zones(spark, sf_dir).select("location_id", "zone")
    j = role_join(t, z, "pickup_location_id", "location_id", "pu_")
    j = role_join(j, z, "dropoff_location_id", "location_id", "do_")
    j = j.filter(F.col("pu_zone") == PICKUP_ZONE)
    return (j.select(F.col("do_zone").alias("dropoff_zone"), F.col("total_amount").alias("amount"))
             .orderBy(F.desc("amount"), "dropoff_zone").limit(1))


def longest_trip_by_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pickup day with the longest trip, trips under 100 excluded as outliers."""
    t = B.trips(spark, sf_dir).filter(in_half_open("pickup_datetime", MONTH_START, MONTH_END)
                                      & (F.col("trip_distance") < 100))
    return (t.groupBy(day_of("pickup_datetime").alias("pickup_date"))
             .agg(F.max("trip_distance").alias("max_distance"))
             .orderBy(F.desc("max_distance"), "pickup_date").limit(1))


def longest_trip_hours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Longest trip duration in hours."""
    t = B.trips(spark, sf_dir)
    return t.agg(F.max(hours_between("pickup_datetime", "dropoff_datetime")).alias("max_hours"))


def short_trips_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trips of at most 1.0 in a half-open range."""
    t = B.trips(spark, sf_dir)
    return t.filter(in_half_open("pickup_datetime", MONTH_START, HALF_MONTH_END)
                    & (F.col("trip_distance") <= 1.0)).agg(F.count(F.lit(1)).alias("trip_count"))


def trips_on_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trips that started on one calendar day."""
    t = B.trips(spark, sf_dir)
    return (t.filter(day_of("pickup_datetime") == F.lit(REPORT_DAY).cast("date"))
             .agg(F.count(F.lit(1)).alias("trip_count")))


def zero_discount_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records with a zero amount (P13 A02): lineitem rows with no discount."""
    li = read_table(spark, sf_dir, "lineitem")
    return li.filter(F.col("l_discount") == 0).agg(F.count(F.lit(1)).alias("zero_fare_count"))


def over_threshold_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Total and long-trip counts in one pass (A03); a NULL distance is not long."""
    t = B.trips(spark, sf_dir)
    return t.agg(F.count(F.lit(1)).alias("total_trips"),
                 F.count_if(F.col("trip_distance") > 5.0).alias("long_trips"))


def rare_zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five least frequent pickup zones (A07 T04), ties broken by zone name."""
    t = B.trips(spark, sf_dir)
    z = B.zones(spark, sf_dir).select(F.col("location_id").cast("string").alias("LocationID"), "zone")
    # The zone lookup read as text (J05): the key is cast explicitly, never implicitly.
    j = lookup_join(t, z, t.pickup_location_id == F.col("LocationID").cast("int"))
    return (j.groupBy("zone").agg(F.count(F.lit(1)).alias("trip_count"))
             .orderBy("trip_count", "zone").limit(5))


def distinct_vendors_in_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct vendors with a dropoff between two midnights, bounds included."""
    li = read_table(spark, sf_dir, "lineitem")
    return (li.filter(F.col("l_shipdate").between(F.lit(RANGE_START).cast("timestamp_ntz"),
                                                  F.lit(RANGE_END).cast("timestamp_ntz")))
              .select(F.col("l_suppkey").alias("vendor_id")).distinct())


def avg_fare_by_vendor(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-vendor trip count and average fare over a date range."""
    li = read_table(spark, sf_dir, "lineitem")
    f = li.filter(F.col("l_shipdate").between(F.lit(VENDOR_RANGE_START).cast("timestamp_ntz"),
                                              F.lit(VENDOR_RANGE_END).cast("timestamp_ntz")))
    return (f.groupBy(F.col("l_suppkey").alias("vendor_id"))
             .agg(F.count(F.lit(1)).alias("trip_count"),
                  round_half_up(F.avg("l_extendedprice"), 2).alias("avg_fare"))
             .orderBy("vendor_id"))


def rows_per_partition_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per dropoff date, the partition column of the optimised table."""
    li = read_table(spark, sf_dir, "lineitem")
    return (li.groupBy(day_of("l_shipdate").alias("partition_date"))
              .agg(F.count(F.lit(1)).alias("row_count")).orderBy("partition_date"))


def brand_avg_price(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Average price per brand, rounded, highest first."""
    p = read_table(spark, sf_dir, "part").select(F.col("p_brand").alias("brand"),
                                                 F.col("p_retailprice").alias("price"))
    products = keep_columns_with_default(p, ["brand", "price"]).withColumn("price", F.col("price").cast("double"))
    return (products.groupBy("brand").agg(round_half_up(F.avg("price"), 2).alias("avg_price"))
                    .orderBy(F.desc("avg_price"), "brand"))


def dim_zones_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Zone dimension with 'Boro' renamed to 'Green' inside the service zone."""
    z = B.zones(spark, sf_dir)
    return z.withColumn("service_zone", F.replace("service_zone", F.lit("Boro"), F.lit("Green")))


def trip_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batch sessions per pickup location, 5-minute gap (X07 in batch, D21), hot-key safe."""
    t = B.trips(spark, sf_dir).select(F.col("pickup_location_id").alias("PULocationID"), "pickup_datetime", "trip_id")
    return session_windows(t, ["PULocationID"], ["pickup_datetime", "trip_id"], 300)


# ------------------------------------------------------------ window results
def _ride_windows(spark: SparkSession, sf_dir: str, size: str, keyed: bool = True) -> DataFrame:
    t = B.trips(spark, sf_dir).select(F.col("pickup_location_id").alias("PULocationID"), "pickup_datetime",
                                      "total_amount",
                                      round_half_up(F.col("total_amount") * F.lit(0.15), 2).alias("tip_amount"))
    return tumbling_totals(t, "pickup_datetime", size, ["PULocationID"] if keyed else [],
                           {"total_amount": "total_revenue", "tip_amount": "total_tip"})


def window_reaggregation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly per-location windows re-aggregated per hour: locations, trips, revenue."""
    w = _ride_windows(spark, sf_dir, "1 hour")
    r = reaggregate(w, ["window_start"], "locations", {"num_trips": "total_trips", "total_revenue": "revenue"})
    return r.withColumn("revenue", round_half_up("revenue", 2)).orderBy("window_start")


def top_locations_5m(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three busiest 5-minute location windows."""
    w = _ride_windows(spark, sf_dir, "5 minutes").select("PULocationID", "window_start", "num_trips")
    return top_n(w, "num_trips", 3, ["window_start", "PULocationID"])


def top_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five longest sessions by trips (T05 over X07)."""
    return top_n(trip_sessions(spark, sf_dir), "num_trips", 5, ["session_start", "PULocationID"])


def top_tip_hours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three hours with the most tips (T05 over X06)."""
    w = _ride_windows(spark, sf_dir, "1 hour", keyed=False)
    w = w.select("window_start", round_half_up("total_tip", 2).alias("total_tip"))
    return top_n(w, "total_tip", 3, ["window_start"])


def preview_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``SELECT * ... LIMIT 10`` preview (P21), in trip order so it is repeatable."""
    return B.trips(spark, sf_dir).orderBy("trip_id").limit(10)


SQL_REPORT = """
SELECT CAST(t.pickup_datetime AS DATE) AS trip_date, t.taxi_type, p.payment_type_name AS payment_type,
       COUNT(*) AS trip_count
FROM trips_v t LEFT JOIN payments_v p ON t.payment_type = p.payment_type_id
WHERE t.pickup_datetime >= :start AND t.pickup_datetime < :end
GROUP BY 1, 2, 3
"""


def sql_daily_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report written in SQL (S07 S17 A13 M11): the events file registered as an
    external parquet view, views by name, GROUP BY ordinal, run parameters bound as named
    arguments (never pasted into the text)."""
    import uuid
    suffix = uuid.uuid4().hex[:8]
    ev_view, trips_view, pay_view = f"events_ext_{suffix}", f"trips_{suffix}", f"payments_{suffix}"
    spark.sql(f"CREATE OR REPLACE TEMPORARY VIEW {ev_view} USING parquet "
              f"OPTIONS (path '{sf_dir.rstrip('/')}/events.parquet')")
    ev = spark.table(ev_view)
    k = B.event_k()
    ev.select(F.col("ts").alias("pickup_datetime"), (k % 8).alias("payment_type"),
              F.col("event_type").alias("taxi_type")).createOrReplaceTempView(trips_view)
    B.payment_lookup(spark).createOrReplaceTempView(pay_view)
    q = SQL_REPORT.replace("trips_v", trips_view).replace("payments_v", pay_view)
    import datetime as dt
    return spark.sql(q, args={"start": dt.datetime(2024, 1, 1), "end": dt.datetime(2024, 2, 1)}).select(
        "trip_date", "taxi_type", "payment_type", "trip_count")


QUERIES = {
    "top_zone_revenue_day": top_zone_revenue_day,
    "largest_amount_by_dropoff": largest_amount_by_dropoff,
    "longest_trip_by_day": longest_trip_by_day,
    "longest_trip_hours": longest_trip_hours,
    "short_trips_count": short_trips_count,
    "trips_on_day": trips_on_day,
    "zero_discount_count": zero_discount_count,
    "over_threshold_counts": over_threshold_counts,
    "rare_zones": rare_zones,
    "distinct_vendors_in_range": distinct_vendors_in_range,
    "avg_fare_by_vendor": avg_fare_by_vendor,
    "rows_per_partition_date": rows_per_partition_date,
    "brand_avg_price": brand_avg_price,
    "dim_zones_clean": dim_zones_clean,
    "trip_sessions": trip_sessions,
    "window_reaggregation": window_reaggregation,
    "top_locations_5m": top_locations_5m,
    "top_sessions": top_sessions,
    "top_tip_hours": top_tip_hours,
    "preview_trips": preview_trips,
    "sql_daily_counts": sql_daily_counts,
}

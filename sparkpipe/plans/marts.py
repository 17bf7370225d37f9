"""Staging, unified fact table and marts.

The three trip services come from one joined source here, so the workbook's three
staged views + ``UNION ALL`` become *one* pass: one dedup, one typed projection with
per-service placeholders (``when(service = 'FHV', NULL)``).  The monthly mart likewise
aggregates once by ``(location, month, service)`` instead of three scans + union; the
measure-less FHV branch is a projection over that aggregate.  ``union_aligned`` serves
sources that really are separate inputs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import NUMERIC, round_half_up, typed_null
from ..functions.keys import surrogate_key
from ..functions.timefn import day_of, in_half_open, month_start
from ..operators.dedup import dedup
from ..operators.joins import lookup_join
from ..sources.files import read_table
from . import bindings as B

TRIP_KEY = ["l_orderkey", "l_linenumber"]
MONEY = ["fare_amount", "extra", "mta_tax", "tip_amount", "tolls_amount", "ehail_fee",
         "improvement_surcharge", "total_amount", "congestion_surcharge"]
REPORT_START, REPORT_END = "2024-01-01", "2024-02-01"


def deduped_trip_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw records, one per (order, line) (W01): survivor = smallest line by all its other
    columns (D1).

    Order and customer attributes are functions of the line's order key, so the dedup runs
    on lineitem *before* the joins: the same survivors, a narrower row to sort, and a
    quarter fewer rows entering the joins.  Lineitem is shuffled exactly once.
    """
    li = read_table(spark, sf_dir, "lineitem").filter(F.col("l_suppkey").isNotNull())
    # One shuffle by order key serves both the dedup (its keys include the order key)
    # and the join to orders.  An order holds a handful of lines, so the key is never hot.
    li = li.repartition("l_orderkey")
    return B.raw_trip_records(spark, sf_dir, lineitem=dedup(li, TRIP_KEY))


def _typed(df: DataFrame) -> DataFrame:
    """Typed cast block of the staged services (P04): ids int, money NUMERIC, times timestamp."""
    fhv = F.col("service_type") == "FHV"

    def measure(c: str, t=NUMERIC):
        return F.when(fhv, typed_null(t)).otherwise(F.col(c).cast(t)).alias(c)

    return df.select(
        surrogate_key(TRIP_KEY).alias("tripid"),
        F.col("vendorid").cast("string").alias("vendorid"),
        F.when(fhv, typed_null("int")).otherwise(F.col("ratecodeid").cast("int")).alias("ratecodeid"),
        F.col("pickup_locationid").cast("int").alias("pickup_locationid"),
        F.col("dropoff_locationid").cast("int").alias("dropoff_locationid"),
        F.col("pickup_datetime").cast("timestamp_ntz").alias("pickup_datetime"),
        F.col("dropoff_datetime").cast("timestamp_ntz").alias("dropoff_datetime"),
        F.when(fhv, typed_null("string")).otherwise(F.col("store_and_fwd_flag")).alias("store_and_fwd_flag"),
        F.when(fhv, typed_null("int")).otherwise(F.col("passenger_count").cast("int")).alias("passenger_count"),
        measure("trip_distance"),
        F.when(F.col("service_type") == "Green", F.col("trip_type").cast("int"))
         .otherwise(typed_null("int")).alias("trip_type"),
        *[measure(c) for c in MONEY[:-1]],
        F.when(fhv, typed_null("int")).otherwise(F.col("payment_type").cast("int")).alias("payment_type"),
        measure("congestion_surcharge"),
        "service_type",
    )


def staged_trips(spark: SparkSession, sf_dir: str, sample: int | None = None) -> DataFrame:
    """Staged green and yellow trips: dedup, surrogate key, typed columns.

    ``sample`` is the test-run switch (M10): the first ``sample`` rows only.  It is off by
    default (D12) — a staging model must not silently publish a sample.
    """
    d = deduped_trip_records(spark, sf_dir).filter(F.col("service_type") != "FHV")
    out = _typed(d)
    return out.limit(sample) if sample else out


def fct_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unified fact of all three services, 22 aligned columns."""
    return _typed(deduped_trip_records(spark, sf_dir))


def monthly_zone_revenue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Monthly revenue per pickup zone and service.

    Aggregate first (groups = locations x months x services), then join the small zone
    dimension: the join sees aggregates, never trips.
    """
    fct = fct_trips(spark, sf_dir).filter(F.col("pickup_datetime").isNotNull())
    fhv = F.col("service_type") == "FHV"
    sums = {
        "fare_amount": "revenue_monthly_fare", "extra": "revenue_monthly_extra",
        "mta_tax": "revenue_monthly_mta_tax", "tip_amount": "revenue_monthly_tip_amount",
        "tolls_amount": "revenue_monthly_tolls_amount", "ehail_fee": "revenue_monthly_ehail_fee",
        "improvement_surcharge": "revenue_monthly_improvement_surcharge",
        "total_amount": "revenue_monthly_total_amount",
        "congestion_surcharge": "revenue_monthly_congestion_surcharge",
    }
    agg = fct.groupBy(
        "pickup_locationid", month_start("pickup_datetime").alias("revenue_month"), "service_type"
    ).agg(
        *[F.sum(c).alias(a) for c, a in sums.items()],
        F.count("tripid").alias("total_monthly_trips"),
        F.avg("passenger_count").alias("_avg_pax"),
        F.avg("trip_distance").alias("_avg_dist"),
    )
    # The measure-less branch (A11): zero sums and NULL averages, real counts.
    shaped = agg.select(
        "pickup_locationid", "revenue_month", "service_type",
        *[F.when(fhv, F.lit(0).cast(NUMERIC)).otherwise(F.col(a)).alias(a) for a in sums.values()],
        "total_monthly_trips",
        F.when(fhv, typed_null("double")).otherwise(round_half_up("_avg_pax", 6)).alias("avg_monthly_passenger_count"),
        F.when(fhv, typed_null("double")).otherwise(round_half_up("_avg_dist", 6)).alias("avg_monthly_trip_distance"),
    )
    z = B.zones(spark, sf_dir).select("location_id", F.col("zone").alias("revenue_zone"))
    j = lookup_join(shaped, z, shaped.pickup_locationid == z.location_id)
    return j.select("revenue_zone", "revenue_month", "service_type", *sums.values(),
                    "total_monthly_trips", "avg_monthly_passenger_count", "avg_monthly_trip_distance")


def staged_report_trips(spark: SparkSession, sf_dir: str, start: str = REPORT_START,
                        end: str = REPORT_END) -> DataFrame:
    """Staging of the report flow (J03 P10 W02): payment names, interval, 5-column dedup."""
    t = B.trips(spark, sf_dir).filter(in_half_open("pickup_datetime", start, end))
    p = B.payment_lookup(spark)
    j = lookup_join(t, p, t.payment_type == p.payment_type_id, how="left")
    staged = j.select("pickup_datetime", "dropoff_datetime", "pickup_location_id", "dropoff_location_id",
                      "fare_amount", "taxi_type", "payment_type_name")
    return dedup(staged, ["pickup_datetime", "dropoff_datetime", "pickup_location_id",
                          "dropoff_location_id", "fare_amount"])


def daily_report(spark: SparkSession, sf_dir: str, start: str = REPORT_START, end: str = REPORT_END) -> DataFrame:
    """Daily report by date x taxi type x payment type."""
    s = staged_report_trips(spark, sf_dir, start, end)
    return (s.groupBy(day_of("pickup_datetime").alias("trip_date"), "taxi_type",
                      F.col("payment_type_name").alias("payment_type"))
             .agg(F.count(F.lit(1)).alias("trip_count"),
                  round_half_up(F.sum("fare_amount"), 2).alias("total_fare"),
                  round_half_up(F.avg("fare_amount"), 2).alias("avg_fare")))


def top_payment_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Top-10 payment types by trips over the report."""
    r = daily_report(spark, sf_dir)
    return (r.groupBy("payment_type").agg(F.sum("trip_count").alias("trips"))
             .orderBy(F.desc("trips"), F.asc_nulls_first("payment_type")).limit(10))


QUERIES = {
    "staged_trips": staged_trips,
    "fct_trips": fct_trips,
    "monthly_zone_revenue": monthly_zone_revenue,
    "daily_report": daily_report,
    "top_payment_types": top_payment_types,
}

"""DuckDB SQL equivalents of the registered queries (the correctness oracle).

The tables ``region nation customer supplier part orders lineitem events ...`` are views
in the oracle's session.  The bindings of ``bindings.py`` are restated here as CTEs, and
every computed column carries the same alias as the Spark query.  Doubles are rounded
through DECIMAL(38, 9) on both sides (``rnd``), sums of integers are cast to BIGINT and
``date_trunc`` results to DATE (DuckDB returns HUGEINT / TIMESTAMP there).
"""

from __future__ import annotations

from .questions import (HALF_MONTH_END, MONTH_END, MONTH_START, PICKUP_ZONE, RANGE_END, RANGE_START,
                        REPORT_DAY, VENDOR_RANGE_END, VENDOR_RANGE_START)


def rnd(expr: str, digits: int) -> str:
    return f"CAST(round(CAST({expr} AS DECIMAL(38,9)), {digits}) AS DOUBLE)"


EV_K = "(SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events)"

TRIPS = f"""trips AS (
  SELECT event_id AS trip_id, ts AS pickup_datetime, ts + to_minutes(k) AS dropoff_datetime,
         CAST(user_id % 25 AS INTEGER) AS pickup_location_id, k % 25 AS dropoff_location_id,
         k / 10 AS trip_distance, value AS fare_amount, value AS total_amount,
         k % 8 AS payment_type, event_type AS taxi_type, user_id AS vendor_id
  FROM {EV_K} ev)"""

ZONES = """zones AS (
  SELECT n.n_nationkey AS location_id, r.r_name AS borough, n.n_name AS zone,
         CASE WHEN n.n_regionkey % 2 = 0 THEN 'Boro Zone' ELSE 'Yellow Zone' END AS service_zone
  FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey)"""

PAYMENTS = """payments(payment_type_id, payment_type_name) AS (
  VALUES (0, 'flex_fare'), (1, 'credit_card'), (2, 'cash'), (3, 'no_charge'),
         (4, 'dispute'), (5, 'unknown'), (6, 'voided_trip'))"""


QUESTIONS = {
    "top_zone_revenue_day": f"""
WITH {TRIPS}, {ZONES}
SELECT z.zone AS pickup_zone, {rnd('sum(t.total_amount)', 2)} AS total_amount_sum, count(*) AS trip_count
FROM trips t JOIN zones z ON t.pickup_location_id = z.location_id
WHERE CAST(t.pickup_datetime AS DATE) = DATE '{REPORT_DAY}'
GROUP BY z.zone ORDER BY total_amount_sum DESC, pickup_zone LIMIT 1""",

    "largest_amount_by_dropoff": f"""
WITH {TRIPS}, {ZONES}
SELECT d.zone AS dropoff_zone, t.total_amount AS amount
FROM trips t JOIN zones p ON t.pickup_location_id = p.location_id
             JOIN zones d ON t.dropoff_location_id = d.location_id
WHERE p.zone = '{PICKUP_ZONE}'
  AND t.pickup_datetime >= TIMESTAMP '{MONTH_START}' AND t.pickup_datetime < TIMESTAMP '{MONTH_END}'
ORDER BY amount DESC, dropoff_zone LIMIT 1""",

    "longest_trip_by_day": f"""
WITH {TRIPS}
SELECT CAST(pickup_datetime AS DATE) AS pickup_date, max(trip_distance) AS max_distance
FROM trips
WHERE pickup_datetime >= TIMESTAMP '{MONTH_START}' AND pickup_datetime < TIMESTAMP '{MONTH_END}'
  AND trip_distance < 100
GROUP BY 1 ORDER BY max_distance DESC, pickup_date LIMIT 1""",

    "longest_trip_hours": f"""
WITH {TRIPS}
SELECT max((floor(epoch(dropoff_datetime)) - floor(epoch(pickup_datetime))) / 3600) AS max_hours FROM trips""",

    "short_trips_count": f"""
WITH {TRIPS}
SELECT count(*) AS trip_count FROM trips
WHERE pickup_datetime >= TIMESTAMP '{MONTH_START}' AND pickup_datetime < TIMESTAMP '{HALF_MONTH_END}'
  AND trip_distance <= 1.0""",

    "trips_on_day": f"""
WITH {TRIPS}
SELECT count(*) AS trip_count FROM trips WHERE CAST(pickup_datetime AS DATE) = DATE '{REPORT_DAY}'""",

    "zero_discount_count": """
SELECT count(*) AS zero_fare_count FROM lineitem WHERE l_discount = 0""",

    "over_threshold_counts": f"""
WITH {TRIPS}
SELECT count(*) AS total_trips, count(*) FILTER (WHERE trip_distance > 5.0) AS long_trips FROM trips""",

    "rare_zones": f"""
WITH {TRIPS}, {ZONES}
SELECT z.zone, count(1) AS trip_count
FROM trips t JOIN zones z ON t.pickup_location_id = z.location_id
GROUP BY z.zone ORDER BY trip_count, z.zone LIMIT 5""",

    "distinct_vendors_in_range": f"""
SELECT DISTINCT l_suppkey AS vendor_id FROM lineitem
WHERE l_shipdate BETWEEN TIMESTAMP '{RANGE_START}' AND TIMESTAMP '{RANGE_END}'""",

    "avg_fare_by_vendor": f"""
SELECT l_suppkey AS vendor_id, count(*) AS trip_count, {rnd('avg(l_extendedprice)', 2)} AS avg_fare
FROM lineitem
WHERE l_shipdate BETWEEN TIMESTAMP '{VENDOR_RANGE_START}' AND TIMESTAMP '{VENDOR_RANGE_END}'
GROUP BY l_suppkey ORDER BY vendor_id""",

    "rows_per_partition_date": """
SELECT CAST(l_shipdate AS DATE) AS partition_date, count(*) AS row_count
FROM lineitem GROUP BY 1 ORDER BY 1""",

    "brand_avg_price": f"""
SELECT coalesce(p_brand, 'N/A') AS brand, {rnd('avg(p_retailprice)', 2)} AS avg_price
FROM part GROUP BY 1 ORDER BY avg_price DESC, brand""",

    "dim_zones_clean": f"""
WITH {ZONES}
SELECT location_id, borough, zone, replace(service_zone, 'Boro', 'Green') AS service_zone FROM zones""",
}

ORACLE: dict[str, str] = {}
ORACLE.update(QUESTIONS)


# ---------------------------------------------------------------- marts
RAW_COLS = ["service_type", "vendorid", "ratecodeid", "pickup_locationid", "dropoff_locationid",
            "pickup_datetime", "dropoff_datetime", "store_and_fwd_flag", "passenger_count",
            "trip_distance", "trip_type", "fare_amount", "extra", "mta_tax", "tip_amount",
            "tolls_amount", "ehail_fee", "improvement_surcharge", "total_amount", "payment_type",
            "congestion_surcharge", "l_partkey", "l_returnflag", "l_linestatus"]

RAW = """raw AS (
  SELECT l.l_orderkey, l.l_linenumber,
         CASE o.o_orderstatus WHEN 'F' THEN 'Yellow' WHEN 'O' THEN 'Green' ELSE 'FHV' END AS service_type,
         l.l_suppkey AS vendorid, 1 AS ratecodeid, c.c_nationkey AS pickup_locationid,
         CAST((c.c_nationkey + l.l_linenumber) % 25 AS INTEGER) AS dropoff_locationid,
         l.l_shipdate AS pickup_datetime, l.l_shipdate + to_hours(l.l_linenumber) AS dropoff_datetime,
         'N' AS store_and_fwd_flag, l.l_quantity AS passenger_count, l.l_quantity / 4 AS trip_distance,
         l.l_linenumber AS trip_type, l.l_extendedprice AS fare_amount, l.l_discount AS extra,
         l.l_tax AS mta_tax,
         CAST(CAST(l.l_extendedprice AS DECIMAL(12,2)) * CAST(l.l_discount AS DECIMAL(4,2)) AS DECIMAL(38,9)) AS tip_amount,
         0.0::DOUBLE AS tolls_amount, CAST(NULL AS DOUBLE) AS ehail_fee, 0.3::DOUBLE AS improvement_surcharge,
         CAST(CAST(l.l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l.l_discount AS DECIMAL(4,2)))
              * (1 + CAST(l.l_tax AS DECIMAL(4,2))) AS DECIMAL(38,9)) AS total_amount,
         l.l_linenumber % 5 AS payment_type, 2.5::DOUBLE AS congestion_surcharge,
         l.l_partkey, l.l_returnflag, l.l_linestatus
  FROM dl l JOIN orders o ON l.l_orderkey = o.o_orderkey JOIN customer c ON o.o_custkey = c.c_custkey)"""

LINE_COLS = ["l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
             "l_returnflag", "l_linestatus", "l_shipdate"]
DEDUP_LINES = f"""dl AS (
  SELECT * FROM lineitem WHERE l_suppkey IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                             ORDER BY {', '.join(c + ' NULLS FIRST' for c in LINE_COLS)}) = 1)"""
DEDUP = "dd AS (SELECT * FROM raw)"


def _measure(c: str) -> str:
    return f"CASE WHEN service_type = 'FHV' THEN NULL ELSE CAST({c} AS DECIMAL(38,9)) END AS {c}"


FCT = f"""fct AS (
  SELECT md5(concat_ws('-', coalesce(CAST(l_orderkey AS VARCHAR), '_dbt_utils_surrogate_key_null_'),
                            coalesce(CAST(l_linenumber AS VARCHAR), '_dbt_utils_surrogate_key_null_'))) AS tripid,
         CAST(vendorid AS VARCHAR) AS vendorid,
         CASE WHEN service_type = 'FHV' THEN NULL ELSE CAST(ratecodeid AS INTEGER) END AS ratecodeid,
         CAST(pickup_locationid AS INTEGER) AS pickup_locationid,
         CAST(dropoff_locationid AS INTEGER) AS dropoff_locationid,
         pickup_datetime, dropoff_datetime,
         CASE WHEN service_type = 'FHV' THEN NULL ELSE store_and_fwd_flag END AS store_and_fwd_flag,
         CASE WHEN service_type = 'FHV' THEN NULL ELSE CAST(passenger_count AS INTEGER) END AS passenger_count,
         {_measure('trip_distance')},
         CASE WHEN service_type = 'Green' THEN CAST(trip_type AS INTEGER) ELSE NULL END AS trip_type,
         {', '.join(_measure(c) for c in ['fare_amount', 'extra', 'mta_tax', 'tip_amount', 'tolls_amount',
                                           'ehail_fee', 'improvement_surcharge', 'total_amount'])},
         CASE WHEN service_type = 'FHV' THEN NULL ELSE CAST(payment_type AS INTEGER) END AS payment_type,
         {_measure('congestion_surcharge')},
         service_type
  FROM dd)"""

_REV_SUMS = [("fare_amount", "revenue_monthly_fare"), ("extra", "revenue_monthly_extra"),
             ("mta_tax", "revenue_monthly_mta_tax"), ("tip_amount", "revenue_monthly_tip_amount"),
             ("tolls_amount", "revenue_monthly_tolls_amount"), ("ehail_fee", "revenue_monthly_ehail_fee"),
             ("improvement_surcharge", "revenue_monthly_improvement_surcharge"),
             ("total_amount", "revenue_monthly_total_amount"),
             ("congestion_surcharge", "revenue_monthly_congestion_surcharge")]


def _service_agg(service: str, measured: bool) -> str:
    if measured:
        sums = ", ".join(f"sum({c}) AS {a}" for c, a in _REV_SUMS)
        avgs = (f"{rnd('avg(passenger_count)', 6)} AS avg_monthly_passenger_count, "
                f"{rnd('avg(trip_distance)', 6)} AS avg_monthly_trip_distance")
    else:
        sums = ", ".join(f"CAST(0 AS DECIMAL(38,9)) AS {a}" for _, a in _REV_SUMS)
        avgs = "CAST(NULL AS DOUBLE) AS avg_monthly_passenger_count, CAST(NULL AS DOUBLE) AS avg_monthly_trip_distance"
    return f"""SELECT pickup_locationid, CAST(date_trunc('month', CAST(pickup_datetime AS DATE)) AS DATE) AS revenue_month,
         service_type, {sums}, count(tripid) AS total_monthly_trips, {avgs}
  FROM fct WHERE service_type = '{service}' AND pickup_datetime IS NOT NULL GROUP BY 1, 2, 3"""


MARTS = {
    "staged_trips": f"WITH {DEDUP_LINES}, {RAW}, {DEDUP}, {FCT} SELECT * FROM fct WHERE service_type <> 'FHV'",
    "fct_trips": f"WITH {DEDUP_LINES}, {RAW}, {DEDUP}, {FCT} SELECT * FROM fct",
    "monthly_zone_revenue": f"""
WITH {DEDUP_LINES}, {RAW}, {DEDUP}, {FCT}, {ZONES},
green AS ({_service_agg('Green', True)}),
yellow AS ({_service_agg('Yellow', True)}),
fhv AS ({_service_agg('FHV', False)}),
all_trips AS (SELECT * FROM green UNION ALL SELECT * FROM yellow UNION ALL SELECT * FROM fhv)
SELECT z.zone AS revenue_zone, a.revenue_month, a.service_type,
       {', '.join('a.' + al for _, al in _REV_SUMS)},
       a.total_monthly_trips, a.avg_monthly_passenger_count, a.avg_monthly_trip_distance
FROM all_trips a JOIN zones z ON a.pickup_locationid = z.location_id""",
}

STAGED_REPORT = f"""staged AS (
  SELECT t.pickup_datetime, t.dropoff_datetime, t.pickup_location_id, t.dropoff_location_id,
         t.fare_amount, t.taxi_type, p.payment_type_name
  FROM trips t LEFT JOIN payments p ON t.payment_type = p.payment_type_id
  WHERE t.pickup_datetime >= TIMESTAMP '2024-01-01' AND t.pickup_datetime < TIMESTAMP '2024-02-01'
  QUALIFY row_number() OVER (PARTITION BY t.pickup_datetime, t.dropoff_datetime, t.pickup_location_id,
                                          t.dropoff_location_id, t.fare_amount
                             ORDER BY t.taxi_type NULLS FIRST, p.payment_type_name NULLS FIRST) = 1)"""

REPORT = """report AS (
  SELECT CAST(pickup_datetime AS DATE) AS trip_date, taxi_type, payment_type_name AS payment_type,
         count(*) AS trip_count, {s} AS total_fare, {a} AS avg_fare
  FROM staged GROUP BY 1, 2, 3)""".format(s=rnd("sum(fare_amount)", 2), a=rnd("avg(fare_amount)", 2))

MARTS["daily_report"] = f"WITH {TRIPS}, {PAYMENTS}, {STAGED_REPORT}, {REPORT} SELECT * FROM report"
MARTS["top_payment_types"] = f"""WITH {TRIPS}, {PAYMENTS}, {STAGED_REPORT}, {REPORT}
SELECT payment_type, CAST(sum(trip_count) AS BIGINT) AS trips FROM report
GROUP BY payment_type ORDER BY trips DESC, payment_type NULLS FIRST LIMIT 10"""

ORACLE.update(MARTS)


# ------------------------------------------------------------ publishing
def _hash_sql(cols: list[str], text: dict[str, str]) -> str:
    return "md5(concat(" + ", ".join(f"coalesce({text.get(c, f'CAST({c} AS VARCHAR)')}, '')" for c in cols) + "))"


_TEXT = {"o_orderstatus": "o_orderstatus", "o_orderpriority": "o_orderpriority",
         "o_totalprice": "CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR)"}
_ORDER_COLS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]
_SHORT = ["o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority"]
_OC = ", ".join(_ORDER_COLS)

HASHED = f"""h AS (SELECT {_OC}, {_hash_sql(_ORDER_COLS, _TEXT)} AS unique_row_id FROM orders),
tgt AS (SELECT * FROM h WHERE o_orderdate < TIMESTAMP '2000-01-01'),
src AS (SELECT * FROM h WHERE o_orderdate >= TIMESTAMP '1999-07-01')"""

_CORRECTED = f"o_orderkey, o_custkey, 'F' AS o_orderstatus, {rnd('o_totalprice * 1.01', 2)} AS o_totalprice, o_orderdate, o_orderpriority"

PUBLISHING = {
    "row_hash": f"""SELECT o_orderkey, {_hash_sql(_ORDER_COLS, _TEXT)} AS unique_row_id,
       {_hash_sql(_SHORT, _TEXT)} AS short_row_id FROM orders""",
    "merge_insert_only": f"""WITH {HASHED}
SELECT {_OC}, unique_row_id FROM tgt
UNION ALL
SELECT {_OC}, unique_row_id FROM src WHERE unique_row_id NOT IN (SELECT unique_row_id FROM tgt)""",
    "merge_upsert": f"""WITH {HASHED}
SELECT {_OC} FROM tgt WHERE o_orderkey NOT IN (SELECT o_orderkey FROM src)
UNION ALL
SELECT {_CORRECTED} FROM src""",
    "snapshot_time_travel": f"""WITH {HASHED}, b AS (SELECT * FROM src WHERE o_orderdate < TIMESTAMP '2000-07-01')
SELECT {_OC} FROM tgt WHERE o_orderkey NOT IN (SELECT o_orderkey FROM b)
UNION ALL
SELECT {_CORRECTED} FROM b""",
    "delete_insert": f"""WITH {HASHED}, b AS (SELECT {_CORRECTED} FROM src WHERE o_orderstatus = 'O')
SELECT {_OC} FROM tgt WHERE o_orderdate NOT IN (SELECT o_orderdate FROM b)
UNION ALL
SELECT {_OC} FROM b""",
    "time_interval_refresh": f"""WITH {TRIPS}
SELECT trip_id, pickup_datetime, dropoff_datetime, pickup_location_id, dropoff_location_id, trip_distance,
       CASE WHEN pickup_datetime >= TIMESTAMP '2024-01-10 12:00:00' AND pickup_datetime < TIMESTAMP '2024-01-13 06:00:00'
            THEN {rnd('fare_amount * 1.08', 2)} ELSE fare_amount END AS fare_amount,
       total_amount, payment_type, taxi_type, vendor_id
FROM trips""",
}

MONTHS = """span AS (SELECT o_orderstatus AS status, min(o_orderdate) AS first_order, max(o_orderdate) AS last_order
                  FROM orders GROUP BY 1),
b AS (SELECT status, CAST(date_trunc('month', first_order) AS DATE) AS f,
             LEAST(CASE WHEN last_order = date_trunc('month', last_order)
                        THEN CAST(date_trunc('month', last_order) - INTERVAL 1 MONTH AS DATE)
                        ELSE CAST(date_trunc('month', last_order) AS DATE) END, DATE '2001-06-01') AS l
      FROM span),
months AS (SELECT status, CAST(datediff('month', f, CAST(m AS DATE)) AS INTEGER) AS month_index,
                  CAST(m AS DATE) AS month_start
           FROM b, unnest(generate_series(CAST(f AS TIMESTAMP), CAST(l AS TIMESTAMP), INTERVAL 1 MONTH)) AS t(m))"""

PUBLISHING["months_to_process"] = f"WITH {MONTHS} SELECT * FROM months"
PUBLISHING["backfill_chunks"] = f"""WITH {MONTHS}
SELECT status, CAST(floor(month_index / 3) AS INTEGER) AS chunk_no, min(month_start) AS chunk_start,
       CAST(max(month_start) + INTERVAL 1 MONTH AS DATE) AS chunk_end,
       CAST(floor(month_index / 3) AS INTEGER) = 0 AS full_refresh
FROM months GROUP BY 1, 2"""
PUBLISHING["distinct_vendors_partitioned"] = QUESTIONS["distinct_vendors_in_range"]
ORACLE.update(PUBLISHING)

# ------------------------------------------------------------ checks
def _row_check(name: str, col: str, cond: str) -> str:
    return f"SELECT '{name}' AS check_name, '{col}' AS column_name, count(*) FILTER (WHERE {cond}) AS failures FROM orders"


CHECKS = {
    "quality_report": "SELECT check_name, column_name, CAST(failures AS BIGINT) AS failures, failures = 0 AS passed FROM (\n"
    + "\nUNION ALL\n".join([
        _row_check("not_null", "o_orderkey", "o_orderkey IS NULL"),
        _row_check("not_null", "o_orderdate", "o_orderdate IS NULL"),
        _row_check("non_negative", "o_totalprice", "o_totalprice < 0"),
        _row_check("positive", "o_totalprice", "o_totalprice <= 0"),
        _row_check("accepted_values", "o_orderstatus",
                   "o_orderstatus IS NOT NULL AND o_orderstatus NOT IN ('F', 'O', 'P')"),
        _row_check("accepted_values", "o_orderpriority",
                   "o_orderpriority IS NOT NULL AND o_orderpriority NOT IN "
                   "('1-URGENT', '2-HIGH', '3-MEDIUM', '4-NOT SPECIFIED', '5-LOW')"),
        "SELECT 'min_rows', '*', CASE WHEN count(*) >= 1 THEN 0 ELSE 1 END FROM orders",
        _row_check("not_null", "o_custkey", "o_custkey IS NULL"),
        _row_check("not_null", "o_orderdate", "o_orderdate IS NULL"),
        "SELECT 'unique', 'o_orderkey', count(*) FROM (SELECT o_orderkey FROM orders GROUP BY 1 HAVING count(*) > 1)",
        "SELECT 'primary_key', 'o_custkey,o_orderdate', count(*) FROM "
        "(SELECT o_custkey, o_orderdate FROM orders GROUP BY 1, 2 HAVING count(*) > 1)",
    ]) + ")",
    "row_reconciliation": """
SELECT 'orders' AS copy, count(*) AS row_count FROM orders
UNION ALL SELECT 'orders_dedup', count(*) FROM (SELECT DISTINCT o_custkey, o_orderdate FROM orders)
UNION ALL SELECT 'lineitem', count(*) FROM lineitem
UNION ALL SELECT 'lineitem_dedup', count(*) FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem)""",
}
ORACLE.update(CHECKS)


# ------------------------------------------------------------ markets
def _pct_text(x: str) -> str:
    return f"CAST(CAST(round(CAST({x} AS DECIMAL(38,9)), 2) AS DECIMAL(38,2)) AS VARCHAR)"


_P2 = rnd("price", 2)
TICKS = f"""tk AS (
  SELECT event_id, upper(event_type) || '/USDT' AS symbol, value AS price, CAST(k AS DOUBLE) AS volume, ts,
         'SIM' AS exchange,
         CASE WHEN event_id % 4 = 0 THEN NULL WHEN event_id % 4 = 1 THEN 0.0::DOUBLE ELSE value * 0.9995 END AS bid,
         CASE WHEN event_id % 4 = 0 THEN NULL WHEN event_id % 4 = 1 THEN 0.0::DOUBLE ELSE value * 1.0005 END AS ask,
         ts + to_seconds(user_id % 60) AS ingest_ts,
         NOT (value > 0) OR NOT (CAST(k AS DOUBLE) > 0) AS failed,
         CASE WHEN NOT (value > 0) THEN 'non_positive_price' ELSE 'non_positive_volume' END AS fail_reason
  FROM {EV_K} ev),
kept AS (
  SELECT event_id, symbol, ts, {_P2} AS price, {rnd('volume', 8)} AS volume, exchange,
         CASE WHEN bid IS NULL OR bid = 0 THEN {rnd(_P2 + ' * 0.9999', 2)} ELSE bid END AS bid,
         CASE WHEN ask IS NULL OR ask = 0 THEN {rnd(_P2 + ' * 1.0001', 2)} ELSE ask END AS ask
  FROM tk WHERE NOT failed AND NOT (ts < ingest_ts - INTERVAL 30 SECOND))"""

_ANOM = f"""an AS (SELECT *, lag(price) OVER w AS prev_price, lag(volume) OVER w AS prev_volume FROM kept
       WINDOW w AS (PARTITION BY symbol ORDER BY ts, event_id)),
pc AS (SELECT *, abs((price - prev_price) / prev_price * 100) AS p,
              abs((volume - prev_volume) / (prev_volume + 1e-9) * 100) AS v FROM an)"""


def _candles(unit: str) -> str:
    return f"""WITH {TICKS}
SELECT symbol, CAST(date_trunc('{unit}', ts) AS TIMESTAMP) AS window_start,
       first(price ORDER BY ts, event_id) AS open, max(price) AS high, min(price) AS low,
       last(price ORDER BY ts, event_id) AS close, sum(volume) AS volume, count(*) AS tick_count
FROM kept GROUP BY 1, 2"""


MARKETS = {
    "clean_ticks": f"WITH {TICKS} SELECT * FROM kept",
    "tick_rejects": f"WITH {TICKS} SELECT event_id, symbol AS key, fail_reason AS reject_reason FROM tk WHERE failed",
    "stale_split": f"""WITH {TICKS}
SELECT symbol, count(*) FILTER (WHERE NOT (ts < ingest_ts - INTERVAL 30 SECOND)) AS kept,
       count(*) FILTER (WHERE ts < ingest_ts - INTERVAL 30 SECOND) AS stale
FROM tk WHERE NOT failed GROUP BY symbol""",
    "tick_anomalies": f"""WITH {TICKS}, {_ANOM}
SELECT symbol, ts, event_id, price, volume,
       CASE WHEN p > 2.0 THEN 'PRICE_JUMP' ELSE 'VOLUME_SPIKE' END AS anomaly_type,
       CASE WHEN p > 2.0 THEN 'Price changed ' || {_pct_text('p')} || '% in one tick'
            ELSE 'Volume changed ' || {_pct_text('v')} || '% in one tick' END AS anomaly_detail
FROM pc WHERE p > 2.0 OR v > 500.0""",
    "ohlcv_1m": _candles("minute"),
    "ohlcv_1h": _candles("hour"),
    "latest_tick": f"""WITH {TICKS}
SELECT symbol, ts, event_id, price, volume FROM kept
QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY ts DESC, event_id DESC) = 1""",
    "rate_per_minute": f"""WITH {TICKS}
SELECT symbol, CAST(date_trunc('minute', ts) AS TIMESTAMP) AS window_start, count(*) AS messages,
       {rnd('count(*) / 60', 6)} AS rate_per_sec
FROM tk GROUP BY 1, 2""",
    "producer_counters": f"""WITH {TICKS}
SELECT symbol, count(*) FILTER (WHERE NOT failed) AS sent, CAST(count(*) FILTER (WHERE failed) AS BIGINT) AS failed,
       CASE WHEN count(*) FILTER (WHERE failed) >= 1 THEN 'red' ELSE 'green' END AS state
FROM tk GROUP BY symbol""",
    "error_increase": f"""WITH {TICKS},
per AS (SELECT symbol, CAST(date_trunc('hour', ts) AS TIMESTAMP) AS period, count(*) FILTER (WHERE failed) AS failed
        FROM tk GROUP BY 1, 2)
SELECT symbol, period, failed, lag(failed) OVER (PARTITION BY symbol ORDER BY period) AS prev_failed,
       coalesce(failed > lag(failed) OVER (PARTITION BY symbol ORDER BY period), false) AS increased
FROM per""",
    "silence_gaps": f"""WITH {TICKS},
g AS (SELECT symbol, ts, lag(ts) OVER (PARTITION BY symbol ORDER BY ts, event_id) AS prev_ts FROM tk)
SELECT symbol, prev_ts AS gap_start, ts AS gap_end, (epoch_us(ts) - epoch_us(prev_ts)) / 1e6 AS gap_seconds
FROM g WHERE (epoch_us(ts) - epoch_us(prev_ts)) / 1e6 >= 120""",
    "price_drop_5m": f"""WITH {TICKS},
m AS (SELECT symbol, ts, event_id, price,
             max(price) OVER (PARTITION BY symbol ORDER BY ts
                              RANGE BETWEEN INTERVAL 5 MINUTE PRECEDING AND CURRENT ROW) AS max_price_window
      FROM kept)
SELECT symbol, ts, event_id, price, max_price_window,
       {rnd('(max_price_window - price) / max_price_window * 100', 4)} AS drop_pct
FROM m WHERE (max_price_window - price) / max_price_window * 100 > 3.0""",
    "series_last_30m": f"""WITH {TICKS}
SELECT symbol, ts, event_id, price FROM kept
WHERE ts >= TIMESTAMP '2024-01-30 00:00:00' - INTERVAL 30 MINUTE AND ts <= TIMESTAMP '2024-01-30 00:00:00'""",
    "retention": f"""WITH {TICKS}
SELECT symbol, count(*) AS retained FROM kept WHERE ts >= TIMESTAMP '2024-01-30 00:00:00' - INTERVAL 7 DAY
GROUP BY symbol""",
}
ORACLE.update(MARKETS)


# ------------------------------------------------------------ streams (batch equivalents)
_RIDES = f"""{TRIPS},
r AS (SELECT trip_id, pickup_location_id AS PULocationID, dropoff_location_id AS DOLocationID, trip_distance,
             total_amount, {rnd('total_amount * 0.15', 2)} AS tip_amount,
             make_timestamp((epoch_us(pickup_datetime) // 1000) * 1000) AS et, pickup_datetime FROM trips)"""


def _tumbling(bucket: str, keyed: bool, cols: str) -> str:
    key = "PULocationID, " if keyed else ""
    return f"""WITH {_RIDES},
w AS (SELECT time_bucket(INTERVAL {bucket}, et) AS window_start, {key}count(*) AS num_trips,
             {rnd('sum(total_amount)', 2)} AS total_revenue, {rnd('sum(tip_amount)', 2)} AS total_tips
      FROM r GROUP BY ALL)
SELECT window_start, window_start + INTERVAL {bucket} AS window_end, {cols} FROM w"""


STREAMS = {
    "stream_pass_through": f"""WITH {_RIDES}
SELECT trip_id, PULocationID, DOLocationID, trip_distance, total_amount, et AS event_timestamp FROM r""",
    "stream_tumbling_1h": _tumbling("1 HOUR", True, "PULocationID, num_trips, total_revenue, total_tips"),
    "stream_tumbling_5m": _tumbling("5 MINUTE", True, "PULocationID, num_trips"),
    "stream_tip_by_hour": _tumbling("1 HOUR", False, "total_tips"),
    "stream_session": f"""WITH {_RIDES},
g AS (SELECT PULocationID, et, lag(et) OVER (PARTITION BY PULocationID ORDER BY et, trip_id) AS prev FROM r),
f AS (SELECT *, sum(CASE WHEN prev IS NULL OR et > prev + INTERVAL 5 MINUTE THEN 1 ELSE 0 END)
                 OVER (PARTITION BY PULocationID ORDER BY et ROWS UNBOUNDED PRECEDING) AS sid FROM g)
SELECT PULocationID, min(et) AS session_start, max(et) + INTERVAL 5 MINUTE AS session_end, count(*) AS num_trips
FROM f GROUP BY PULocationID, sid""",
    "stream_upsert": _tumbling("1 HOUR", True, "PULocationID, num_trips, total_revenue, total_tips"),
    "stream_ohlcv": MARKETS["ohlcv_1m"],
    "stream_dedup": MARKETS["clean_ticks"],
    "stream_anomalies": MARKETS["tick_anomalies"],
    "stream_latest_tick": MARKETS["latest_tick"],
}
ORACLE.update(STREAMS)
ORACLE["trip_sessions"] = f"""WITH {TRIPS},
g AS (SELECT pickup_location_id AS PULocationID, pickup_datetime AS et, trip_id,
             lag(pickup_datetime) OVER (PARTITION BY pickup_location_id ORDER BY pickup_datetime, trip_id) AS prev
      FROM trips),
f AS (SELECT *, sum(CASE WHEN prev IS NULL OR et > prev + INTERVAL 5 MINUTE THEN 1 ELSE 0 END)
                 OVER (PARTITION BY PULocationID ORDER BY et, trip_id ROWS UNBOUNDED PRECEDING) AS sid FROM g)
SELECT PULocationID, min(et) AS session_start, max(et) + INTERVAL 5 MINUTE AS session_end, count(*) AS num_trips
FROM f GROUP BY PULocationID, sid"""

CONNECTORS = {
    "zones_from_csv": f"""WITH {ZONES}
SELECT location_id AS LocationID, borough AS Borough, zone AS Zone, service_zone FROM zones""",
    "products_brand_avg_json": QUESTIONS["brand_avg_price"],
    "orders_multi_file_load": """
SELECT o_orderkey AS order_id, o_custkey AS customer_id, o_totalprice AS amount, o_orderdate AS order_ts,
       CASE o_orderstatus WHEN 'F' THEN 'Yellow' WHEN 'O' THEN 'Green' ELSE 'FHV' END AS service_type
FROM orders""",
}
ORACLE.update(CONNECTORS)

_WIN_TRIPS = f"""{TRIPS},
wr AS (SELECT pickup_location_id AS PULocationID, pickup_datetime, total_amount,
              {rnd('total_amount * 0.15', 2)} AS tip_amount FROM trips)"""

WINDOWS = {
    "window_reaggregation": f"""WITH {_WIN_TRIPS},
w AS (SELECT date_trunc('hour', pickup_datetime) AS window_start, PULocationID, count(*) AS num_trips,
             sum(total_amount) AS total_revenue FROM wr GROUP BY 1, 2)
SELECT window_start, count(*) AS locations, CAST(sum(num_trips) AS BIGINT) AS total_trips,
       {rnd('sum(total_revenue)', 2)} AS revenue
FROM w GROUP BY window_start ORDER BY window_start""",
    "top_locations_5m": f"""WITH {_WIN_TRIPS},
w AS (SELECT time_bucket(INTERVAL 5 MINUTE, pickup_datetime) AS window_start, PULocationID, count(*) AS num_trips
      FROM wr GROUP BY 1, 2)
SELECT PULocationID, window_start, num_trips FROM w ORDER BY num_trips DESC, window_start, PULocationID LIMIT 3""",
    "top_sessions": f"""WITH {ORACLE['trip_sessions'].strip()[5:]}
ORDER BY num_trips DESC, session_start, PULocationID LIMIT 5""",
    "top_tip_hours": f"""WITH {_WIN_TRIPS}
SELECT date_trunc('hour', pickup_datetime) AS window_start, {rnd('sum(tip_amount)', 2)} AS total_tip
FROM wr GROUP BY 1 ORDER BY total_tip DESC, window_start LIMIT 3""",
    "preview_trips": f"WITH {TRIPS} SELECT * FROM trips ORDER BY trip_id LIMIT 10",
    "sql_daily_counts": f"""WITH {TRIPS}, {PAYMENTS}
SELECT CAST(t.pickup_datetime AS DATE) AS trip_date, t.taxi_type, p.payment_type_name AS payment_type,
       count(*) AS trip_count
FROM trips t LEFT JOIN payments p ON t.payment_type = p.payment_type_id
WHERE t.pickup_datetime >= TIMESTAMP '2024-01-01' AND t.pickup_datetime < TIMESTAMP '2024-02-01'
GROUP BY 1, 2, 3""",
}
ORACLE.update(WINDOWS)

MORE = {
    "latest_five_ticks": f"""WITH {TICKS}
SELECT symbol, ts, event_id, price FROM kept WHERE symbol = 'CLICK/USDT'
ORDER BY ts DESC, event_id DESC LIMIT 5""",
    "series_one_symbol": f"""WITH {TICKS}
SELECT symbol, ts, event_id, price FROM kept
WHERE symbol = 'CLICK/USDT' AND ts >= TIMESTAMP '2024-01-30 00:00:00' - INTERVAL 30 MINUTE
  AND ts <= TIMESTAMP '2024-01-30 00:00:00'""",
    "repartition_copy_stats": """
SELECT 'num_files' AS stat, CAST(4 AS BIGINT) AS value
UNION ALL SELECT 'row_count', count(*) FROM lineitem""",
    "chunked_load_orders": "SELECT * FROM orders",
    "tick_lake": MARKETS["clean_ticks"],
}
ORACLE.update(MORE)
ORACLE["stream_tumbling_10s"] = _tumbling("10 SECOND", True, "PULocationID, num_trips")
ORACLE["stream_tick_job"] = MARKETS["clean_ticks"]
ORACLE["stream_tick_job_anomalies"] = MARKETS["tick_anomalies"]
ORACLE["stream_tick_job_candles"] = MARKETS["ohlcv_1m"]
ORACLE["stream_tick_job_rejects"] = MARKETS["tick_rejects"]
ORACLE["stream_tick_job_stale"] = f"""WITH {TICKS}
SELECT event_id, symbol, ts, price, {rnd('volume', 8)} AS volume FROM tk
WHERE NOT failed AND ts < ingest_ts - INTERVAL 30 SECOND"""
ORACLE["stream_late_drop"] = STREAMS["stream_tumbling_1h"]
ORACLE["stream_first_rows"] = STREAMS["stream_pass_through"] + " ORDER BY trip_id LIMIT 10"
ORACLE["stream_from_latest"] = STREAMS["stream_pass_through"] + " WHERE et >= TIMESTAMP '2024-01-15'"
ORACLE["report_checks"] = f"""WITH {TRIPS}, {PAYMENTS}, {STAGED_REPORT}, {REPORT}
SELECT check_name, column_name, CAST(failures AS BIGINT) AS failures, failures = 0 AS passed FROM (
  SELECT 'not_null' AS check_name, 'trip_date' AS column_name, count(*) FILTER (WHERE trip_date IS NULL) AS failures FROM report
  UNION ALL SELECT 'non_negative', 'trip_count', count(*) FILTER (WHERE trip_count < 0) FROM report
  UNION ALL SELECT 'not_null', 'trip_date', count(*) FILTER (WHERE trip_date IS NULL) FROM report
  UNION ALL SELECT 'min_rows', '*', CASE WHEN count(*) >= 1 THEN 0 ELSE 1 END FROM report
  UNION ALL SELECT 'not_null', 'taxi_type', count(*) FILTER (WHERE taxi_type IS NULL) FROM report
  UNION ALL SELECT 'not_null', 'payment_type', count(*) FILTER (WHERE payment_type IS NULL) FROM report
  UNION ALL SELECT 'primary_key', 'trip_date,taxi_type,payment_type', count(*) FROM
      (SELECT trip_date, taxi_type, payment_type FROM report GROUP BY ALL HAVING count(*) > 1))"""
ORACLE["metadata_count"] = "SELECT count(*) AS row_count FROM lineitem"


ORACLE["interval_refresh_monthly"] = ORACLE["time_interval_refresh"]
_ORDERS = "o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority"
ORACLE["merge_upsert_moved_keys"] = f"""
SELECT {_ORDERS.replace("o_orderdate", "CASE WHEN o_orderdate >= TIMESTAMP '1999-07-01' THEN o_orderdate + INTERVAL 31 DAY ELSE o_orderdate END AS o_orderdate")}
FROM orders"""
ORACLE["merge_null_partition"] = f"""
SELECT {_ORDERS.replace("o_orderstatus", "CASE WHEN o_orderkey % 2 = 0 THEN 'F' ELSE o_orderstatus END AS o_orderstatus").replace("o_totalprice", "CASE WHEN o_orderkey % 2 = 0 THEN " + rnd("o_totalprice * 1.01", 2) + " ELSE o_totalprice END AS o_totalprice")}
FROM orders WHERE o_orderkey % 3 <> 0 OR o_orderkey % 2 = 0"""
ORACLE["load_if_empty"] = """
SELECT c_custkey, c_mktsegment, 0 AS batches FROM customer WHERE c_custkey % 2 = 0
UNION ALL SELECT c_custkey, c_mktsegment, 1 FROM customer"""

# ------------------------------------------------------------ shaping
_SERVICE = "CASE o_orderstatus WHEN 'F' THEN 'Yellow' WHEN 'O' THEN 'Green' ELSE 'FHV' END"
SHAPING = {
    "csv_typed_gzip": f"SELECT {_ORDERS} FROM orders",
    "csv_all_strings": """
SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, CAST(o_custkey AS VARCHAR) AS o_custkey, o_orderstatus,
       strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS o_orderdate, o_orderpriority FROM orders""",
    "csv_inferred": """
SELECT CAST(c_custkey AS INTEGER) AS c_custkey, c_acctbal, c_mktsegment, 'int' AS key_type, 'double' AS balance_type
FROM customer""",
    "csv_to_parquet_once": "SELECT c_custkey, c_acctbal FROM customer",
    "period_files_load": f"""
SELECT strftime(o_orderdate, '%Y-%m') AS month, count(*) AS orders, {rnd('sum(o_totalprice)', 2)} AS revenue
FROM orders GROUP BY 1""",
    "order_months": "SELECT strftime(o_orderdate, '%Y-%m') AS month, count(*) AS orders FROM orders GROUP BY 1",
    "safe_cast_parts": """
SELECT p_partkey, CASE WHEN p_size % 2 = 0 THEN p_size END AS code, CAST(p_size AS VARCHAR) AS p_size FROM part""",
    "coerce_timestamps": """
SELECT o_orderkey, CASE WHEN o_orderkey % 5 <> 0 THEN o_orderdate END AS ordered_at FROM orders""",
    "nan_to_null_events": "SELECT event_id, CASE WHEN event_id % 3 <> 0 THEN value END AS value FROM events",
    "replaced_columns": """
SELECT o_orderkey, CAST(o_custkey AS VARCHAR) AS o_custkey, o_orderstatus, CAST(floor(o_totalprice) AS BIGINT) AS o_totalprice,
       o_orderdate, lower(o_orderpriority) AS o_orderpriority FROM orders""",
    "lake_paths": f"""WITH {TICKS}
SELECT replace(symbol, '/', '-') || '/' || strftime(ts, '%Y/%m/%d/%H%M') AS path, count(*) AS ticks FROM kept GROUP BY 1""",
    "sum_of_none": "SELECT coalesce(sum(value), 0.0::DOUBLE) AS total, count(*) AS events FROM events WHERE value < 0",
    "custom_checks": """
SELECT 'no_negative_price' AS check_name, '*' AS column_name, CAST(v <> 0 AS BIGINT) AS failures, v = 0 AS passed
FROM (SELECT count(*) AS v FROM orders WHERE o_totalprice < 0)
UNION ALL SELECT 'impossible_count', '*', CAST(v <> -1 AS BIGINT), v = -1 FROM (SELECT count(*) AS v FROM orders)""",
    "union_services": f"""
SELECT o_orderkey AS trip_id, o_custkey AS vendor_id, CASE WHEN {_SERVICE} <> 'FHV' THEN o_totalprice END AS fare_amount,
       o_orderdate AS pickup_datetime, CASE WHEN {_SERVICE} <> 'Yellow' THEN o_orderpriority END AS trip_type,
       {_SERVICE} AS service_type FROM orders""",
    "union_service_months": f"""
SELECT {_SERVICE} AS service_type, CAST(date_trunc('month', o_orderdate) AS DATE) AS month, count(*) AS trips,
       CASE WHEN {_SERVICE} <> 'FHV' THEN {rnd('sum(o_totalprice)', 2)} END AS revenue
FROM orders GROUP BY {_SERVICE}, 2""",
    "backfill_run": f"SELECT {_ORDERS} FROM orders WHERE o_orderdate < TIMESTAMP '2001-07-01'",
    "table_copy": f"SELECT {_ORDERS} FROM orders",
}
ORACLE.update(SHAPING)


# ------------------------------------------------------------ alerts, counters, retention, snapshots
def _increase(value: str, hours: int, step: str) -> str:
    """Rises of a counter between neighbouring samples, for each step that sees both of them."""
    return f"""WITH {TICKS},
c AS (SELECT symbol, ts, event_id, {value} AS v FROM tk),
d AS (SELECT symbol, ts, v, lag(ts) OVER w AS prev_ts, lag(v) OVER w AS prev_v FROM c
      WINDOW w AS (PARTITION BY symbol ORDER BY ts, event_id)),
steps AS (SELECT unnest(range(TIMESTAMP '2023-12-31', TIMESTAMP '2024-02-03', INTERVAL {step})) AS step),
inc AS (SELECT symbol, step, CAST(sum(CASE WHEN v < prev_v THEN v ELSE v - prev_v END) AS BIGINT) AS increase
        FROM d JOIN steps ON ts <= step AND prev_ts > step - INTERVAL {hours} HOUR GROUP BY 1, 2)"""


ORACLE.update({
    "silence_alerts": f"""WITH {TICKS},
alive AS (SELECT * FROM tk WHERE ts <= TIMESTAMP '2024-01-30 00:00:00'
          AND (symbol <> 'CLICK/USDT' OR ts <= TIMESTAMP '2024-01-29 15:00:00')),
g AS (SELECT symbol, ts, lag(ts) OVER (PARTITION BY symbol ORDER BY ts, event_id) AS prev_ts FROM alive)
SELECT symbol, prev_ts AS gap_start, ts AS gap_end, (epoch_us(ts) - epoch_us(prev_ts)) / 1e6 AS gap_seconds
FROM g WHERE (epoch_us(ts) - epoch_us(prev_ts)) / 1e6 >= 120
UNION ALL
SELECT symbol, max(ts), NULL, (epoch_us(TIMESTAMP '2024-01-30 00:00:00') - epoch_us(max(ts))) / 1e6
FROM alive GROUP BY symbol HAVING (epoch_us(TIMESTAMP '2024-01-30 00:00:00') - epoch_us(max(ts))) / 1e6 >= 120""",
    "counter_rate": _increase("event_id % 500", 2, "30 MINUTE") + f"""
SELECT symbol, step, increase, {rnd('increase / 7200', 6)} AS rate_per_sec FROM inc""",
    "counter_alerts": _increase("(event_id % 500) // 7", 6, "1 HOUR") + """
SELECT symbol, step, increase FROM inc WHERE increase > 0""",
    "retention_layouts": f"""WITH {TICKS}, {_ANOM},
c AS (SELECT DISTINCT symbol, date_trunc('hour', ts) AS h FROM kept)
SELECT 'ticks' AS kind, symbol, count(*) AS retained FROM kept WHERE CAST(ts AS DATE) >= DATE '2024-01-23' GROUP BY 2
UNION ALL
SELECT 'anomalies', symbol, count(*) FROM pc WHERE (p > 2.0 OR v > 500.0) AND CAST(ts AS DATE) >= DATE '2024-01-09' GROUP BY 2
UNION ALL
SELECT 'candles', symbol, count(*) FROM c WHERE symbol = 'CLICK/USDT' OR CAST(h AS DATE) >= DATE '2024-01-16' GROUP BY 2""",
    "merge_upsert_by_symbol": f"""WITH {TICKS},
t AS (SELECT CASE WHEN event_id % 100 <> 7 THEN event_id END AS tick_key, event_id, symbol, price FROM tk),
b AS (SELECT tick_key, event_id, CASE WHEN symbol = 'VIEW/USDT' THEN '50%=VIEW: USDT' ELSE symbol END AS symbol,
             0.0::DOUBLE AS price FROM t WHERE event_id % 2 = 0
      UNION ALL SELECT * FROM t WHERE event_id % 100 = 7),
latest AS (SELECT * FROM b QUALIFY row_number() OVER (PARTITION BY tick_key ORDER BY event_id DESC) = 1)
SELECT * FROM t WHERE event_id % 3 <> 0 AND event_id % 2 <> 0 AND tick_key IS NOT NULL
UNION ALL
SELECT * FROM latest""",
})

ORACLE.update({
    "stream_anomalies_shuffled": MARKETS["tick_anomalies"],
    "stream_silences": f"""WITH {TICKS},
fin AS (SELECT max(ingest_ts) - INTERVAL 9 HOUR AS stopped FROM tk),
alive AS (SELECT kept.symbol, kept.ts, kept.event_id FROM kept JOIN tk USING (event_id), fin
          WHERE kept.symbol <> 'CLICK/USDT' OR tk.ingest_ts <= stopped),
g AS (SELECT symbol, ts, lag(ts) OVER (PARTITION BY symbol ORDER BY ts, event_id) AS prev_ts FROM alive),
clock AS (SELECT max(ts) AS now FROM alive)
SELECT symbol, prev_ts AS gap_start, ts AS gap_end, (epoch_us(ts) - epoch_us(prev_ts)) / 1e6 AS gap_seconds
FROM g WHERE (epoch_us(ts) - epoch_us(prev_ts)) / 1e6 >= 120
UNION ALL
SELECT symbol, max(ts), NULL, (epoch_us(any_value(now)) - epoch_us(max(ts))) / 1e6
FROM alive, clock GROUP BY symbol HAVING (epoch_us(any_value(now)) - epoch_us(max(ts))) / 1e6 >= 120""",
})

ORACLE.update({
    "month_output": """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, 'orders' AS kind, strftime(o_orderdate, '%Y-%m') AS month
FROM orders WHERE strftime(o_orderdate, '%Y-%m') IN ('1997-01', '1997-02')""",
    "backfill_resumed": f"SELECT {_ORDERS} FROM orders WHERE o_orderdate IS NOT NULL",
    "checked_publish": """
SELECT 'not_null' AS check_name, 'l_orderkey' AS column_name, count(*) FILTER (WHERE l_orderkey IS NULL) AS failures,
       count(*) FILTER (WHERE l_orderkey IS NULL) = 0 AS passed FROM lineitem
UNION ALL SELECT 'non_negative', 'l_tax', count(*) FILTER (WHERE l_tax < 0), count(*) FILTER (WHERE l_tax < 0) = 0 FROM lineitem
UNION ALL SELECT 'positive', 'l_discount', count(*) FILTER (WHERE l_discount <= 0), count(*) FILTER (WHERE l_discount <= 0) = 0 FROM lineitem
UNION ALL SELECT 'accepted_values', 'l_returnflag', count(*) FILTER (WHERE l_returnflag NOT IN ('A', 'N')),
       count(*) FILTER (WHERE l_returnflag NOT IN ('A', 'N')) = 0 FROM lineitem
UNION ALL SELECT 'min_rows', '*', CASE WHEN count(*) >= 1 THEN 0 ELSE 1 END, count(*) >= 1 FROM lineitem""",
    "table_statistics": """
WITH t AS (SELECT o_orderkey, o_totalprice, o_orderdate,
                  CASE WHEN o_orderdate < TIMESTAMP '2000-07-01' OR o_orderkey % 5 <> 0 THEN o_orderstatus END AS o_orderstatus
           FROM orders WHERE o_orderkey % 3 <> 0 OR o_orderdate >= TIMESTAMP '2000-07-01')
SELECT 'o_orderkey' AS "column", count(*) AS "rows", count(*) FILTER (WHERE o_orderkey IS NULL) AS nulls,
       CAST(CAST(min(o_orderkey) AS DECIMAL(38,9)) AS VARCHAR) AS least, CAST(CAST(max(o_orderkey) AS DECIMAL(38,9)) AS VARCHAR) AS greatest FROM t
UNION ALL SELECT 'o_totalprice', count(*), count(*) FILTER (WHERE o_totalprice IS NULL),
       CAST(CAST(min(o_totalprice) AS DECIMAL(38,9)) AS VARCHAR), CAST(CAST(max(o_totalprice) AS DECIMAL(38,9)) AS VARCHAR) FROM t
UNION ALL SELECT 'o_orderdate', count(*), count(*) FILTER (WHERE o_orderdate IS NULL),
       strftime(min(o_orderdate), '%Y-%m-%d %H:%M:%S'), strftime(max(o_orderdate), '%Y-%m-%d %H:%M:%S') FROM t
UNION ALL SELECT 'o_orderstatus', count(*), count(*) FILTER (WHERE o_orderstatus IS NULL), min(o_orderstatus), max(o_orderstatus) FROM t""",
})

ORACLE["stream_start_position"] = STREAMS["stream_pass_through"] + " WHERE trip_id % 2 <> 0"

"""Quality checks and table statistics as queries (Q01-Q09)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..operators.dedup import dedup
from ..operators.quality import Check, file_stats, metadata_row_count, reconcile_counts, run_checks, table_stats
from ..sources.files import read_table
from .marts import daily_report

# Accepted order statuses and priorities of the orders table.
ORDER_STATUSES = ["F", "O", "P"]
ORDER_PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]

ORDER_CHECKS = [
    Check("not_null", ["o_orderkey"]),
    Check("not_null", ["o_orderdate"]),
    Check("non_negative", ["o_totalprice"]),
    Check("positive", ["o_totalprice"]),
    Check("accepted_values", ["o_orderstatus"], ORDER_STATUSES),
    Check("accepted_values", ["o_orderpriority"], ORDER_PRIORITIES),
    Check("min_rows", [], threshold=1),
    Check("unique", ["o_orderkey"]),
    Check("primary_key", ["o_custkey", "o_orderdate"]),
]


def quality_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All checks of the orders table in one scan plus one grouping-sets shuffle (Q01-Q06)."""
    return run_checks(read_table(spark, sf_dir, "orders"), ORDER_CHECKS)


def row_reconciliation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Row counts of raw and deduplicated copies side by side (Q07)."""
    o = read_table(spark, sf_dir, "orders")
    li = read_table(spark, sf_dir, "lineitem")
    return reconcile_counts({
        "orders": o,
        "orders_dedup": dedup(o, ["o_custkey", "o_orderdate"], ["o_orderkey"]),
        "lineitem": li,
        "lineitem_dedup": dedup(li.select("l_orderkey", "l_linenumber"), ["l_orderkey", "l_linenumber"]),
    })


def lineitem_file_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """File count and average file size of the lineitem dataset (Q09)."""
    return file_stats(spark, f"{sf_dir.rstrip('/')}/lineitem.parquet")


def orders_table_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Row count and size of the orders table (Q08)."""
    return table_stats(spark, f"{sf_dir.rstrip('/')}/orders.parquet")


REPORT_CHECKS = [
    Check("primary_key", ["trip_date", "taxi_type", "payment_type"]),
    Check("non_negative", ["trip_count"]),
    Check("not_null", ["trip_date"]),
    Check("min_rows", [], threshold=1),
]


def report_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Checks declared on the daily report (Q01 Q03 Q05 Q06): the template run's last step."""
    return run_checks(daily_report(spark, sf_dir), REPORT_CHECKS)


def metadata_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Row count of lineitem from parquet footers, no column data read (§4 metadata count)."""
    return metadata_row_count(spark, f"{sf_dir.rstrip('/')}/lineitem.parquet")


QUERIES = {
    "quality_report": quality_report,
    "row_reconciliation": row_reconciliation,
    "file_stats": lineitem_file_stats,
    "table_stats": orders_table_stats,
    "report_checks": report_checks,
    "metadata_count": metadata_count,
}

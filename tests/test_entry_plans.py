from pyspark.sql import functions as F

import __spark_entry__ as E
from sparkpipe.operators.joins import fits_broadcast
from tests.conftest import SF001


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "revenue_zone" in df.columns


def test_every_oracle_has_a_query():
    assert set(E.oracle_sql()) <= set(E.queries())
    assert len(E.queries()) >= 50
    # Only file-metadata queries lack SQL (file sizes are invisible to SQL), besides training-data ones.
    own = set(E.queries()) - set(E.LLM_QUERIES)
    assert own - set(E.oracle_sql()) == {"file_stats", "table_stats"}


def test_scan_prunes_columns_and_pushes_filters(spark):
    from sparkpipe.plans.questions import short_trips_count
    plan = short_trips_count(spark, SF001)._jdf.queryExecution().sparkPlan().toString()
    assert "PushedFilters: [IsNotNull(ts), GreaterThanOrEqual(ts" in plan
    assert "ReadSchema: struct<ts:timestamp_ntz,props:string>" in plan


def test_zone_lookup_is_broadcast_and_topk_is_take_ordered(spark):
    from sparkpipe.plans.questions import top_zone_revenue_day
    plan = top_zone_revenue_day(spark, SF001)._jdf.queryExecution().sparkPlan().toString()
    assert "BroadcastHashJoin" in plan
    assert "TakeOrderedAndProject" in plan


def test_broadcast_check_is_bounded(spark):
    # The size estimate disabled by an untrusted plan: rows and bytes are measured.
    rows = lambda n: spark.range(1).select(F.explode(F.sequence(F.lit(1), F.lit(n))).alias("x"))
    assert fits_broadcast(rows(10), 10) and not fits_broadcast(rows(11), 10)
    wide = rows(10).select(F.repeat(F.lit("ab"), 1000).alias("t"))
    assert fits_broadcast(wide, 10) and not fits_broadcast(wide, 10, max_bytes=10_000)
    # Byte bound from Catalyst's upper-bound estimate: no job needed for a 25-row dimension.
    from sparkpipe.operators.joins import estimated_bytes
    from sparkpipe.plans.bindings import zones
    assert estimated_bytes(zones(spark, SF001)) < 10 * 1024 * 1024
    big = spark.read.parquet(SF001 + "/lineitem.parquet")
    assert not fits_broadcast(big, 1000, max_bytes=0)

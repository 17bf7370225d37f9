"""Data-quality checks and table statistics (Q01-Q10).

All per-row checks (not_null, non_negative, positive, accepted_values, row count) compile
into one ``agg`` pass of ``count_if`` expressions.  All uniqueness checks (unique,
composite primary key) share one ``GROUPING SETS`` aggregation: a single ``Expand`` and
a single shuffle however many key sets there are, with map-side partial counts so a hot
key is pre-aggregated before the shuffle.  The result is one row per check:
``(check_name, column_name, failures, passed)``.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sinks.snapshots import GENERATION, SnapshotTable

RESULT_SCHEMA = T.StructType([
    T.StructField("check_name", T.StringType(), False),
    T.StructField("column_name", T.StringType(), False),
    T.StructField("failures", T.LongType(), False),
    T.StructField("passed", T.BooleanType(), False),
])


@dataclass
class Check:
    name: str                       # not_null | non_negative | positive | accepted_values | unique | primary_key | min_rows
    columns: Sequence[str] = ()
    values: Sequence[object] = field(default_factory=list)   # accepted_values
    threshold: int = 1              # min_rows


def _row_failure(c: Check) -> Column:
    col = F.col(c.columns[0]) if c.columns else None
    if c.name == "not_null":
        return F.count_if(col.isNull())
    if c.name == "non_negative":
        return F.count_if(col < 0)
    if c.name == "positive":
        return F.count_if(col <= 0)
    if c.name == "accepted_values":
        return F.count_if(col.isNotNull() & ~col.isin(list(c.values)))
    if c.name == "min_rows":
        return F.when(F.count(F.lit(1)) >= c.threshold, F.lit(0)).otherwise(F.lit(1)).cast("long")
    raise ValueError(f"unknown row check {c.name}")


def run_checks(df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """Evaluate ``checks`` over ``df``; one result row per check (per column for primary keys).

    One scan, one shuffle: ``GROUPING SETS ((), key set 1, key set 2, ...)`` computes the
    row checks on the grand-total set and a row count per key on each key set (map-side
    partial aggregation first); a one-row final aggregate then reads the grand-total values
    and counts the keys seen more than once.
    """
    spark = df.sparkSession
    checks = list(checks)
    key_checks = [c for c in checks if c.name in ("unique", "primary_key")]
    row_checks = [c for c in checks if c.name not in ("unique", "primary_key")]
    # Primary keys also require every key column to be non-null (Q06).
    for c in key_checks:
        if c.name == "primary_key":
            row_checks += [Check("not_null", [k]) for k in c.columns]
    if not checks:
        return spark.createDataFrame([], RESULT_SCHEMA)

    labels = ([(c.name, ",".join(c.columns) or "*") for c in row_checks]
              + [(c.name, ",".join(c.columns)) for c in key_checks])
    row_aggs = [_row_failure(c).alias(f"r{i}") for i, c in enumerate(row_checks)]
    if not key_checks:
        totals = df.agg(*row_aggs)
        values = [F.col(f"r{i}") for i in range(len(row_checks))]
    else:
        cols = list(dict.fromkeys(c for ch in key_checks for c in ch.columns))
        full = (1 << len(cols)) - 1
        gids = [sum(1 << (len(cols) - 1 - i) for i, c in enumerate(cols) if c not in ch.columns)
                for ch in key_checks]
        counted = (df.groupingSets([[]] + [[F.col(c) for c in ch.columns] for ch in key_checks],
                                   *[F.col(c) for c in cols])
                     .agg(F.count(F.lit(1)).alias("_n"), F.grouping_id().alias("_gid"), *row_aggs))
        grand = F.col("_gid") == full
        totals = counted.agg(
            *[F.max(F.when(grand, F.col(f"r{i}"))).alias(f"r{i}") for i in range(len(row_checks))],
            *[F.count_if((F.col("_gid") == g) & (F.col("_n") > 1)).alias(f"k{j}") for j, g in enumerate(gids)])
        values = ([F.col(f"r{i}") for i in range(len(row_checks))]
                  + [F.col(f"k{j}") for j in range(len(key_checks))])
    stacked = F.inline(F.array(*[
        F.struct(F.lit(name).alias("check_name"), F.lit(column).alias("column_name"),
                 F.coalesce(v.cast("long"), F.lit(0).cast("long")).alias("failures"))
        for (name, column), v in zip(labels, values)]))
    return totals.select(stacked).withColumn("passed", F.col("failures") == 0)


def publish_checked(df: DataFrame, checks: Sequence[Check], publish: Callable[[DataFrame], object]) -> DataFrame:
    """Publish ``df`` and return the results of row checks that ran inside the publishing job.

    The checks are observed metrics of the job: the input is read once, nothing is shuffled for
    them.  Uniqueness needs a shuffle and belongs to ``run_checks``; here it is an error.
    ``publish`` must write exactly the frame it gets, in one job.
    """
    checks = list(checks)
    if any(c.name in ("unique", "primary_key") for c in checks):
        raise ValueError("uniqueness cannot be observed; use run_checks")
    if not checks:
        publish(df)
        return df.sparkSession.createDataFrame([], RESULT_SCHEMA)
    seen = Observation()
    publish(df.observe(seen, *[_row_failure(c).alias(f"c{i}") for i, c in enumerate(checks)]))
    rows = [(c.name, ",".join(c.columns) or "*", int(seen.get[f"c{i}"] or 0)) for i, c in enumerate(checks)]
    return df.sparkSession.createDataFrame([(*r, r[2] == 0) for r in rows], RESULT_SCHEMA)


def custom_check(spark: SparkSession, query: str, expected, name: str = "custom", **frames: DataFrame) -> DataFrame:
    """Scalar SQL compared to an expected value (Q05); ``{name}`` in the query stands for a frame."""
    q = spark.sql(query, **frames)
    value = q.select(F.col(q.columns[0]).alias("v"))
    return value.select(F.lit(name).alias("check_name"), F.lit("*").alias("column_name"),
                        F.when(F.col("v") == F.lit(expected), 0).otherwise(1).cast("long").alias("failures"),
                        (F.col("v") == F.lit(expected)).alias("passed"))


def reconcile_counts(frames: dict[str, DataFrame]) -> DataFrame:
    """Row-count reconciliation of several copies in one frame (Q07)."""
    out = None
    for name, df in frames.items():
        part = df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("copy"), "row_count")
        out = part if out is None else out.unionByName(part)
    return out


def _listing(spark: SparkSession, path: str) -> DataFrame:
    """One row per parquet file below ``path``: the folder listing, no content."""
    return (spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet")
                 .option("recursiveFileLookup", True).load(path).select("path", "length"))


def file_stats(spark: SparkSession, path: str) -> DataFrame:
    """File count and average file size of a parquet dataset (Q09), from its listing."""
    return _listing(spark, path).agg(F.count(F.lit(1)).alias("num_files"),
                                     F.avg("length").alias("avg_file_size"),
                                     F.sum("length").alias("total_bytes"))


def table_stats(spark: SparkSession, path: str) -> DataFrame:
    """Row count (footers) and bytes (listing) of a parquet table."""
    rows = metadata_row_count(spark, path)
    size = _listing(rows.sparkSession, path).agg(F.sum("length").alias("size_bytes"))
    return (rows.crossJoin(size)  # one row each
                .withColumn("size_gb", F.round(F.col("size_bytes") / F.pow(F.lit(1024), 3), 2)))


def schema_info(df: DataFrame) -> str:
    """Schema print (Q10)."""
    return df._jdf.schema().treeString()


FOOTER_COUNT_CONF = {"spark.sql.parquet.aggregatePushdown": "true", "spark.sql.sources.useV1SourceList": ""}


def metadata_row_count(spark: SparkSession, path: str) -> DataFrame:
    """``COUNT(*)`` of a parquet dataset answered from file footers (§4, A01): ``row_count``.

    The DataSource V2 parquet scan pushes the aggregate down (``PushedAggregation``), so
    no column data is read.  The frame is lazy and planned in a session of its own, so the
    caller's settings stay as they are.
    """
    own = spark.newSession()
    for k, v in FOOTER_COUNT_CONF.items():
        own.conf.set(k, v)
    return own.read.parquet(path).agg(F.count(F.lit(1)).alias("row_count"))


# ------------------------------------------------------------ statistics beside a table
_STATS = ("folder string, column string, rows long, nulls long, least_number decimal(38,9), greatest_number decimal(38,9), "
          "least_text string, greatest_text string, sketch binary")
#: Bits of the distinct-count sketch: an error of about 1.04 / sqrt(2^12), 1.6 %.
SKETCH_BITS = 12


def _statistics_table(table: SnapshotTable) -> SnapshotTable:
    return SnapshotTable(table.spark, f"{table.path}/_statistics")


def refresh_statistics(table: SnapshotTable, columns: Sequence[str]) -> int:
    """Measure the folders of ``table`` that have no statistics of ``columns`` yet (Q08).

    A folder of a snapshot table never changes, so it is scanned once; a publication adds only
    its own folders.  A row per folder and column: rows, nulls, least and greatest value, and a
    mergeable sketch of the distinct values.  Returns the folders measured.
    """
    found = table.snapshot()
    stats = _statistics_table(table)
    known = {r[0] for r in stats.read().where(F.col("column").isin(list(columns))).groupBy("folder")
             .agg(F.count_distinct("column").alias("n")).where(F.col("n") == len(set(columns))).collect()} if stats.exists() else set()
    new = [f for f in found.folders if f not in known] if found else []
    if not new:
        return 0
    rows = table.rows_of(found, new)
    fields = []
    for c in columns:
        number = isinstance(found.schema[c].dataType, T.NumericType)
        value = F.col(c).cast("decimal(38,9)") if number else F.col(c).cast("string")
        none = F.lit(None).cast("string" if number else "decimal(38,9)")
        least, greatest = F.min(value), F.max(value)
        numbers, texts = ((least, greatest), (none, none)) if number else ((none, none), (least, greatest))
        fields.append(F.struct(
            F.lit(c).alias("column"), F.count(F.lit(1)).alias("rows"), F.count_if(F.col(c).isNull()).alias("nulls"),
            numbers[0].alias("least_number"), numbers[1].alias("greatest_number"), texts[0].alias("least_text"),
            texts[1].alias("greatest_text"), F.hll_sketch_agg(F.col(c).cast("string"), SKETCH_BITS).alias("sketch")))
    name = F.col("_metadata.file_path")
    folder = F.regexp_extract(name, f"({GENERATION}=.*)/[^/]*$", 1)
    # the names as Spark writes them: a path shows them encoded once more
    measured = (rows.withColumn("folder", F.url_decode(F.replace(folder, F.lit("+"), F.lit("%2B"))))
                    .groupBy("folder").agg(F.array(*fields).alias("found")).select("folder", F.inline("found")))
    stats.append(measured)
    return len(new)


def statistics_of(table: SnapshotTable) -> DataFrame:
    """column, rows, nulls, least, greatest (as text), distinct (an estimate) of the table, added up
    from its folders' statistics; no data file is read."""
    live = table.spark.createDataFrame([(f,) for f in table.snapshot().folders], "folder string")
    parts = _statistics_table(table).read().dropDuplicates(["folder", "column"]).join(live, "folder", "left_semi")
    text = [F.coalesce(agg(f"{side}_number").cast("string"), agg(f"{side}_text")).alias(side)
            for side, agg in (("least", F.min), ("greatest", F.max))]
    return parts.groupBy("column").agg(F.sum("rows").alias("rows"), F.sum("nulls").alias("nulls"), *text,
                                       F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("distinct"))

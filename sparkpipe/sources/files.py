"""Batch file sources.

Every reader returns a lazy DataFrame: column pruning and predicate pushdown reach the
parquet scan through Catalyst, so callers simply ``select``/``filter`` afterwards.
"""

from __future__ import annotations

import logging
import re
from collections.abc import Iterable, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sinks.writers import NULL_PARTITION, list_names

log = logging.getLogger(__name__)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the test tables: ``{sf_dir}/{name}.parquet``."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def spread(df: DataFrame, min_tasks: int | None = None) -> DataFrame:
    """Spread an input read by fewer tasks than there are cores (one row group, one task)
    over all cores before CPU-heavy per-row work.  Inputs already split into at least
    ``min_tasks`` partitions — any table at cluster scale — are returned untouched, so no
    shuffle is added where parallelism already exists.  The round-robin is made
    deterministic by Spark's local sort, so a retried task gets the same rows."""
    n = min_tasks or df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= n:
        return df
    return df.repartition(n)


def read_parquet(spark: SparkSession, path: str | Sequence[str], columns: Sequence[str] | None = None) -> DataFrame:
    """Parquet scan, optionally of chosen columns (S01, S02, S07 with a glob)."""
    paths = [path] if isinstance(path, str) else list(path)
    df = spark.read.parquet(*paths)
    return df.select(*columns) if columns else df


def read_csv(spark: SparkSession, path: str | Sequence[str], schema: T.StructType | str | None = None,
             header: bool = True, infer: bool = False, timestamp_format: str | None = None,
             keep_corrupt: bool = False) -> DataFrame:
    """CSV(.gz) scan.

    With a declared schema, surplus tokens are dropped and a malformed cell becomes NULL
    (PERMISSIVE); ``keep_corrupt`` adds ``_corrupt_record`` holding the raw text of every
    line that did not fit the schema exactly (a bad cell or surplus tokens), so it can be
    reported while the parsed values are still kept.
    """
    reader = spark.read.option("header", header).option("mode", "PERMISSIVE")
    if timestamp_format:
        reader = reader.option("timestampFormat", timestamp_format).option("timestampNTZFormat", timestamp_format)
    if schema is not None:
        if keep_corrupt:
            st = schema if isinstance(schema, T.StructType) else T.DataType.fromDDL(schema)
            st = T.StructType(list(st.fields) + [T.StructField("_corrupt_record", T.StringType())])
            reader = reader.schema(st).option("columnNameOfCorruptRecord", "_corrupt_record")
        else:
            reader = reader.schema(schema)
    elif infer:
        reader = reader.option("inferSchema", True)
    paths = [path] if isinstance(path, str) else list(path)
    return reader.csv(paths)


def read_json_documents(spark: SparkSession, path: str, array_field: str | None = None,
                        schema: T.StructType | str | None = None, multi_line: bool = True) -> DataFrame:
    """JSON documents; with ``array_field`` the array of records is exploded.

    ``multi_line`` reads whole-file documents; JSON Lines files are split per line
    and parallelise better.
    """
    reader = spark.read.option("multiLine", multi_line)
    if schema is not None:
        reader = reader.schema(schema)
    df = reader.json(path)
    if array_field:
        df = df.select(F.inline(F.col(array_field)))
    return df


def empty_frame(spark: SparkSession, schema: T.StructType) -> DataFrame:
    """Empty result with the declared schema."""
    return spark.createDataFrame([], schema)


def period_paths(base: str, kind: str, months: Iterable[str], template: str = "{kind}_tripdata_{month}.parquet") -> list[str]:
    """File names for a period by template ``{type}_tripdata_{yyyy-MM}``."""
    return [f"{base.rstrip('/')}/" + template.format(kind=kind, month=m) for m in months]


@dataclass
class LoadReport:
    """What a multi-file load read and what it skipped."""
    loaded: list[str] = field(default_factory=list)
    skipped: list[tuple[str, str]] = field(default_factory=list)


def load_many(spark: SparkSession, paths: Sequence[str], required: Sequence[str],
              rename: dict[str, str] | None = None, constants: dict[str, object] | None = None,
              schema: T.StructType | None = None, strict: bool = False) -> tuple[DataFrame, LoadReport]:
    """Multi-file load.

    Each readable file is projected to ``required`` (after ``rename``) and the pieces are
    combined with ``unionByName`` into one plan.  A file that does not exist, or lacks a
    required column, is skipped and listed in the report (``strict`` raises instead).
    When nothing loads, the empty frame carries ``schema``.  Only file metadata is
    touched on the driver; no rows are read here.
    """
    report = LoadReport()
    frames: list[DataFrame] = []
    for p in paths:
        try:
            df = spark.read.parquet(p)
            if rename:
                df = df.withColumnsRenamed({k: v for k, v in rename.items() if k in df.columns})
            missing = [c for c in required if c not in df.columns]
            if missing:
                raise ValueError(f"missing columns {missing}")
            df = df.select(*required)
            if constants:
                df = df.withColumns({k: F.lit(v) for k, v in constants.items()})
            frames.append(df)
            report.loaded.append(p)
        except (AnalysisException, ValueError) as exc:
            missing_file = isinstance(exc, AnalysisException) and exc.getCondition() == "PATH_NOT_FOUND"
            if strict or not (missing_file or isinstance(exc, ValueError)):
                raise  # a transient or unknown error must not drop a file
            log.warning("skipping %s: %s", p, exc)
            report.skipped.append((p, str(exc).splitlines()[0]))
    if not frames:
        if schema is None:
            raise ValueError("nothing loaded and no schema given")
        return empty_frame(spark, schema), report
    return reduce(lambda a, b: a.unionByName(b), frames), report


def period_files(spark: SparkSession, root: str, template: str = "{kind}_tripdata_{month}.parquet", kinds: Sequence[str] | None = None,
                 first: str | None = None, last: str | None = None) -> dict[str, tuple[str, str | None]]:
    """Files (or folders) of ``root`` that the template names, with their kind and month (S19): one listing.

    Months run from ``first`` to ``last`` (``yyyy-MM``, inclusive; open if None).  A partition
    folder without a month (NULL) belongs to no period: it is listed, with month None, only if
    both ends are open.
    """
    pattern = re.compile(_template_pattern(template))
    found = {}
    for name in list_names(spark, root):
        m = pattern.fullmatch(name)
        if m is None or kinds is not None and m["kind"] not in kinds:
            continue
        month = None if m["month"] == NULL_PARTITION else m["month"]
        inside = (first is None or month >= first) and (last is None or month <= last) if month else first is last is None
        if inside:
            found[f"{root.rstrip('/')}/{name}"] = (m["kind"], month)
    return found


def _template_pattern(template: str) -> str:
    month = rf"(?P<month>\d{{4}}-\d{{2}}|{NULL_PARTITION})"
    return re.escape(template).replace(r"\{kind\}", r"(?P<kind>[^/]+?)").replace(r"\{month\}", month)


def load_period(spark: SparkSession, root: str, schema: T.StructType | str, template: str = "{kind}_tripdata_{month}.parquet",
                kinds: Sequence[str] | None = None, first: str | None = None, last: str | None = None,
                expected: Iterable[str] = ()) -> tuple[DataFrame, LoadReport]:
    """All files of a period by one scan (S11, S12, S19): ``schema``, and the file's kind and month.

    The schema is declared, so no file is opened to plan the scan: a column that a file lacks is
    NULL there (``load_many`` looks at each file instead).  ``expected`` months that no file
    has are in the report; without any file the empty frame carries the schema.
    """
    schema = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    files = period_files(spark, root, template, kinds, first, last)
    report = LoadReport(loaded=sorted(files))
    there = {month for _, month in files.values()}
    for month in expected:
        if month not in there:
            log.warning("no file of %s in %s", month, root)
            report.skipped.append((month, "no file"))
    labelled = T.StructType([*schema.fields, T.StructField("kind", T.StringType()), T.StructField("month", T.StringType())])
    if not files:
        return empty_frame(spark, labelled), report
    pattern = _template_pattern(template).replace("?P<kind>", "").replace("?P<month>", "")
    order = sorted((template.index("{kind}"), template.index("{month}")))
    group = {name: order.index(template.index(f"{{{name}}}")) + 1 for name in ("kind", "month")}
    labels = [F.nullif(F.regexp_extract("_metadata.file_path", f"/{pattern}(?:/|$)", group[c]), F.lit(NULL_PARTITION)).alias(c) for c in ("kind", "month")]
    rows = spark.read.schema(schema).parquet(*sorted(files))
    return rows.select(*schema.names, *labels), report

"""Sinks and materialisation (K01-K12, K15-K17, K19) plus partition-folder helpers.

Writes are distributed: each task writes its own files and the job commit publishes
them.  Partition folders are dropped through the Hadoop FileSystem of the session, the
same layer Spark writes through, so the helpers work on HDFS and object stores alike.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Sequence
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite", partition_by: Sequence[str] | None = None,
                  num_files: int | None = None) -> None:
    """Parquet write (K01, K03, K06); ``num_files`` gives that many files, of about equal rows.

    So few writers would each read their share of the rows from a shuffle, several times as
    large as Parquet.  Instead all tasks deal their rows into ``num_files`` pieces below the
    checkpoint folder, and each writer reads one piece.
    """
    if not num_files:
        _save(df, path, mode, partition_by)
        return
    spark, staged = df.sparkSession, scratch_path(df.sparkSession, "pieces")
    piece = "_piece"
    while piece in (c.lower() for c in df.columns):
        piece += "_"
    row = F.monotonically_increasing_id()      # tasks begin with different pieces
    dealt = F.pmod(row + F.shiftright(row, 33), F.lit(num_files))
    df.withColumn(piece, dealt).write.partitionBy(piece).parquet(staged)
    pieces = [spark.read.schema(df.schema).parquet(f"{staged}/{f}").coalesce(1)
              for f in list_folders(spark, staged) if f.startswith(f"{piece}=")]
    # a union of single partitions would become one partition
    union, old = "spark.sql.unionOutputPartitioning", spark.conf.get("spark.sql.unionOutputPartitioning", "true")
    spark.conf.set(union, "false")
    try:
        _save(reduce(DataFrame.union, pieces or [spark.createDataFrame([], df.schema)]), path, mode, partition_by)
    finally:
        spark.conf.set(union, old)
    delete_path(spark, staged)


def _save(df: DataFrame, path: str, mode: str, partition_by: Sequence[str] | None) -> None:
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def balanced_for_write(df: DataFrame, partition_col: str, secondary: Sequence[str] | None = None) -> DataFrame:
    """Lay rows out for a partitioned write: range partitioning on (partition value,
    secondary key).  Each task then covers a narrow slice of partition values — a few
    files per folder instead of one file per task per folder — and a partition value
    holding a third of the data is split over many tasks by the secondary key (a row
    hash when none is given) instead of landing on one writer."""
    second = [F.col(c) for c in secondary] if secondary else [F.xxhash64(*[F.col(c) for c in df.columns])]
    return df.repartitionByRange(F.col(partition_col), *second)


def write_clustered(df: DataFrame, path: str, partition_col: str, cluster_cols: Sequence[str],
                    mode: str = "overwrite") -> None:
    """Date-partitioned, clustered layout.

    Rows are range-partitioned by (partition value, cluster key) — few files per folder,
    hot partition values split across writers — and sorted by the cluster key inside each
    task, so each parquet row group carries a narrow min/max range of the cluster key for
    row-group pruning.
    """
    (balanced_for_write(df, partition_col, cluster_cols)
       .sortWithinPartitions(partition_col, *cluster_cols)
       .write.mode(mode).partitionBy(partition_col).parquet(path))


def convert_csv_to_parquet(spark: SparkSession, csv_path: str, parquet_path: str, schema=None) -> None:
    """CSV -> parquet, skipped when the target exists (K05: ``mode('ignore')``)."""
    reader = spark.read.option("header", True)
    reader = reader.schema(schema) if schema is not None else reader.option("inferSchema", True)
    reader.csv(csv_path).write.mode("ignore").parquet(parquet_path)


def with_month(df: DataFrame, month: str, column: str = "month") -> DataFrame:
    """Parameterised month column."""
    return df.withColumn(column, F.lit(month))


def load_batches(batches: Iterable[DataFrame], path: str, partition_by: Sequence[str] | None = None,
                 skip_if_rows: SparkSession | None = None) -> int:
    """First batch replaces, later batches append (K07, K12). Returns batches written.

    With ``skip_if_rows`` (the session) a target that has rows is left as it is and nothing is
    written; an empty or missing one is made anew (K10).
    """
    if skip_if_rows is not None and path_exists(skip_if_rows, path):
        try:
            if not skip_if_rows.read.parquet(path).isEmpty():
                return 0
        except AnalysisException as exc:  # a folder without any file is empty
            if exc.getCondition() != "UNABLE_TO_INFER_SCHEMA":
                raise
    n = 0
    for i, b in enumerate(batches):
        write_parquet(b, path, mode="overwrite" if i == 0 else "append", partition_by=partition_by)
        n += 1
    return n


def create_table_if_not_exists(spark: SparkSession, name: str, schema, path: str | None = None) -> bool:
    """``CREATE TABLE IF NOT EXISTS`` (K08, K11). Returns True when created."""
    if spark.catalog.tableExists(name):
        return False
    empty = spark.createDataFrame([], schema)
    w = empty.write.format("parquet")
    if path:
        w = w.option("path", path)
    w.saveAsTable(name)
    return True


def ddl_of(df: DataFrame) -> str:
    """DDL of a frame's schema."""
    return df.schema.toDDL()


def materialize(df: DataFrame, name: str, as_table: bool = False, path: str | None = None) -> DataFrame:
    """Materialise as a temp view or a table."""
    if as_table:
        w = df.write.mode("overwrite").format("parquet")
        if path:
            w = w.option("path", path)
        w.saveAsTable(name)
        return df.sparkSession.table(name)
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)


def to_messages(df: DataFrame, key: str | None = None) -> DataFrame:
    """Serialise rows as JSON messages (K16): ``key`` (optional) and ``value``."""
    value = F.to_json(F.struct(*[F.col(c) for c in df.columns])).alias("value")
    return df.select(F.col(key).cast("string").alias("key"), value) if key else df.select(value)


# Lossless JSON time text (the writer's default stops at milliseconds).
JSON_TS_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"
JSON_TS_NTZ_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def write_json_lake(df: DataFrame, root: str, ts_col: str, kind: str, mode: str = "append") -> None:
    """JSON export under ``kind/yyyy/MM/dd`` (K15): derived path columns + ``partitionBy``."""
    out = df.withColumns({
        "yyyy": F.date_format(ts_col, "yyyy"),
        "MM": F.date_format(ts_col, "MM"),
        "dd": F.date_format(ts_col, "dd"),
    })
    (out.write.mode(mode).partitionBy("yyyy", "MM", "dd")
        .option("timestampFormat", JSON_TS_FORMAT).option("timestampNTZFormat", JSON_TS_NTZ_FORMAT)
        .json(f"{root.rstrip('/')}/{kind}"))


def write_jdbc(df: DataFrame, url: str, table: str, mode: str = "append", properties: dict | None = None) -> None:
    """JDBC sink (K13); batched by the JDBC writer, one connection per task."""
    df.write.jdbc(url, table, mode=mode, properties=properties or {})


# ------------------------------------------------------------ partition folders
NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"


def filesystem(spark: SparkSession, path: str):
    """The Hadoop file system of ``path``, the path as its class, and the JVM view."""
    jvm = spark.sparkContext._jvm
    hconf = spark._jsparkSession.sessionState().newHadoopConf()
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(hconf), p, jvm


def read_text(spark: SparkSession, path: str) -> str:
    """A small file as text."""
    fs, p, _ = filesystem(spark, path)
    stream = fs.open(p)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def commit_text(spark: SparkSession, path: str, text: str) -> bool:
    """Write a small file as a whole, by one rename; False (and no change) if it is there already."""
    fs, final, jvm = filesystem(spark, path)
    hadoop = jvm.org.apache.hadoop.fs
    draft = hadoop.Path(final.getParent(), f".{uuid.uuid4().hex}")
    out = fs.create(draft, False)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    unless_there = spark.sparkContext._gateway.new_array(hadoop.Options.Rename, 1)
    unless_there[0] = hadoop.Options.Rename.NONE
    context = hadoop.FileContext.getFileContext(draft.toUri(), fs.getConf())
    try:
        context.rename(fs.makeQualified(draft), fs.makeQualified(final), unless_there)
    except Py4JJavaError as exc:
        fs.delete(draft, False)
        if "FileAlreadyExists" in exc.java_exception.getClass().getName():
            return False
        raise
    return True


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p, _ = filesystem(spark, path)
    return fs.exists(p)


def make_dirs(spark: SparkSession, path: str) -> None:
    """Create a folder (a stream's landing folder must exist before the query starts)."""
    fs, p, _ = filesystem(spark, path)
    fs.mkdirs(p)


def delete_path(spark: SparkSession, path: str) -> bool:
    """Remove a folder this library created (a staging copy)."""
    fs, p, _ = filesystem(spark, path)
    return bool(fs.exists(p) and fs.delete(p, True))


def partition_folder(spark: SparkSession, column: str, value: object) -> str:
    """Folder name of a partition value, written as Spark writes it (``/``, ``:``, ``=``, ``%`` ... escaped)."""
    if value is None or value in ("", NULL_PARTITION):
        return f"{column}={NULL_PARTITION}"
    names = spark.sparkContext._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils
    return f"{names.escapePathName(column)}={names.escapePathName(str(value))}"


def drop_partitions(spark: SparkSession, path: str, column: str, values: Iterable[object]) -> int:
    """Delete the folders of these partition values (partition drop for refresh and retention)."""
    fs, root, jvm = filesystem(spark, path)
    n = 0
    for v in values:
        p = jvm.org.apache.hadoop.fs.Path(root, partition_folder(spark, column, v))
        if fs.exists(p):
            fs.delete(p, True)
            n += 1
    return n


def list_names(spark: SparkSession, path: str) -> list[str]:
    """Names of the files and folders in ``path`` (a listing); none if it does not exist."""
    fs, root, _ = filesystem(spark, path)
    return sorted(st.getPath().getName() for st in fs.listStatus(root)) if fs.exists(root) else []


def list_folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders in ``path`` (a listing, no data read)."""
    fs, root, _ = filesystem(spark, path)
    if not fs.exists(root):
        return []
    return sorted(st.getPath().getName() for st in fs.listStatus(root) if st.isDirectory())


def list_partition_values(spark: SparkSession, path: str, column: str) -> list[str]:
    """Partition values present under ``path`` as text, unescaped; ``NULL_PARTITION`` stands for NULL."""
    prefix = f"{column}="
    unescape = spark.sparkContext._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.unescapePathName
    return [unescape(n[len(prefix):]) for n in list_folders(spark, path) if n.startswith(prefix)]

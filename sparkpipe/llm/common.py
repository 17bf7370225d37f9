"""Helpers of the subpackage: columns, intermediate tables and per-worker memos."""

from __future__ import annotations

import sys
import types
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import configure, scratch_path
from ..sinks.writers import delete_path

#: Rows of a batch that travels to a Python worker; long texts make a row large.
BATCH_ROWS = 256
#: Stands for a null id where ids are ordered: nulls come last.
NO_ID = 2**63 - 1
#: Bytes of the largest method that the JVM compiles; generated code beyond that would run interpreted.
COMPILED_BYTES = 8000


def prepare(spark: SparkSession) -> SparkSession:
    """The library's session settings, and batches small enough for long texts."""
    configure(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(column: str = "text") -> Column:
    """The text, null as empty."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def ordered_id(column: str) -> Column:
    """The id as long; null becomes the largest long, so it sorts last and joins itself."""
    return F.coalesce(F.col(column).cast("long"), F.lit(NO_ID))


def real_id(column: str) -> Column:
    """Undo ``ordered_id``."""
    return F.when(F.col(column) != F.lit(NO_ID), F.col(column))


def doc_key(id_col: str = "doc_id", text_col: str = "text") -> Column:
    """A long that names the document and orders documents: the id, below 2^62.

    A null id gets a number above that from the text, so such rows sort last and equal
    texts without an id count as one document.
    """
    stand_in = F.shiftrightunsigned(F.xxhash64(text_of(text_col)), 2).bitwiseOR(F.lit(1 << 62))
    return F.coalesce(F.col(id_col).cast("long"), stand_in)


def key_id(column: str) -> Column:
    """The id that ``doc_key`` was made of; null for a stand-in."""
    return F.when(F.col(column) < F.lit(1 << 62), F.col(column))


def free_name(df: DataFrame, stem: str) -> str:
    """A column name that ``df`` does not have."""
    taken = {c.lower() for c in df.columns}
    while stem.lower() in taken:
        stem += "_"
    return stem


def materialise(df: DataFrame, name: str, compression: str | None = None) -> DataFrame:
    """Write ``df`` below the shared checkpoint folder and read it back.

    Cuts the lineage with files that survive lost executors.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path, compression=compression)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._scratch = path
    return out


def drop_scratch(*tables: DataFrame) -> None:
    """Delete tables of ``materialise`` that nothing reads any more."""
    for table in tables:
        delete_path(table.sparkSession, table._scratch)


@contextmanager
def lean(spark: SparkSession):
    """Jobs that start in here leave no shuffle files behind, and send large binaries to Python few at a time."""
    names = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
             "spark.sql.execution.arrow.maxRecordsPerBatch": "50000", "spark.sql.execution.arrow.maxBytesPerBatch": "4m"}
    before = {name: spark.conf.get(name) for name in names}
    try:
        for name, value in names.items():
            spark.conf.set(name, value)
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


@contextmanager
def compiled_methods(spark: SparkSession):
    """Jobs that start in here split generated methods that the JVM would not compile."""
    name = "spark.sql.codegen.hugeMethodLimit"
    before = spark.conf.get(name)
    spark.conf.set(name, str(COMPILED_BYTES))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def worker_memo(group: str, name: str, build, key=None):
    """``build()`` once per Python worker process and ``key``; later tasks of the worker reuse it.

    Functions reach the workers by value, so module globals would not outlive a task.  A
    name holds one value, and a worker holds the values of one group (operator) at a time.
    """
    store = sys.modules.setdefault("_sparkpipe_memo", types.ModuleType("_sparkpipe_memo")).__dict__
    if store.get("group") != group:
        store.clear()
        store["group"] = group
    if name not in store or store[name][0] != key:
        store.pop(name, None)
        store[name] = (key, build())
    return store[name][1]

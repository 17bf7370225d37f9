"""Stream sources and the table replay used to feed them.

Production reads a Kafka topic (``readStream.format("kafka")`` + ``from_json``); this
environment has no Kafka jar, so the same ``stream_source`` reads JSON files landing in
a folder.  ``replay`` turns a table into such a folder: one file per time slice, written
slice after slice, so file order is event-time order (the file source takes files by
modification time).  An optional sentinel row far in the future closes every open
window of an append-mode query (its own window stays open and is never emitted).
"""

from __future__ import annotations

import datetime as dt
import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sinks.writers import commit_text, filesystem, path_exists, read_text

SENTINEL_TIME = dt.datetime(2100, 1, 1)


def stream_source(spark: SparkSession, folder: str, schema: T.StructType, fmt: str = "json",
                  max_files_per_trigger: int | None = 1, starting: str = "earliest",
                  start_time_col: str | None = None, start_time=None, position: str | None = None) -> DataFrame:
    """Streaming frame over files with a declared schema.

    ``starting='latest'`` with ``position`` starts at the end of what is there (S14): the first
    start records its place in the file ``position``, and the files of that moment are never
    read, also after a restart; later ones are, whatever their event times.  With
    ``start_time_col`` it keeps the rows at or after ``start_time`` instead.
    """
    reader = spark.readStream.schema(schema).format(fmt)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    df = reader.load(folder)
    if starting == "latest" and position is not None:
        modified, names = start_position(spark, folder, position)
        arrived = F.unix_millis("_metadata.file_modification_time")
        return df.filter((arrived > modified) | ((arrived == modified) & ~F.col("_metadata.file_name").isin(names)))
    if starting == "latest" and start_time_col and start_time is not None:
        df = df.filter(F.col(start_time_col) >= F.lit(start_time))
    return df


def start_position(spark: SparkSession, folder: str, position: str) -> tuple[int, list[str]]:
    """Where a reader of ``folder`` began: the latest modification time (ms) of the files that were
    there at the first start, and the names of the files of that time.

    Recorded once, as a whole; whoever comes second takes the record that is there.  A file
    that is put there later with an older modification time counts as there before.
    """
    if not path_exists(spark, position):
        fs, root, _ = filesystem(spark, folder)
        found = [(st.getModificationTime(), st.getPath().getName()) for st in fs.listStatus(root) if st.isFile()] if fs.exists(root) else []
        modified = max((t for t, _ in found), default=-1)
        commit_text(spark, position, json.dumps([modified, [n for t, n in found if t == modified]]))
    modified, names = json.loads(read_text(spark, position))
    return modified, names


def replay(df: DataFrame, folder: str, ts_col: str, slice_unit: str = "week", copies: int = 1,
           late: bool = False, sentinel: DataFrame | None = None, on_delivery: Callable[[], object] | None = None) -> int:
    """Deliver ``df`` into ``folder`` as JSON, one ``slice_unit`` of ``ts_col`` at a time,
    oldest first (X16, K16).

    Each slice is written by all tasks in parallel (no single writer).  ``on_delivery``
    runs after every delivery — typically draining the stream from its checkpoint, as a
    periodically triggered job would — so each slice is one micro-batch and the watermark
    advances between slices exactly as with data arriving over time.  ``copies > 1``
    writes every slice again before the stream is drained (at-least-once delivery: the
    copies come while the watermark still lets them in).  ``late`` delivers all slices but
    the last a second time after all of them, far behind the watermark.  ``sentinel`` (one
    far-future row) is delivered last to close open windows.  Returns the number of
    deliveries.
    """
    sliced = df.withColumn("_slice", F.date_trunc(slice_unit, F.col(ts_col)))
    # Slice starts are calendar metadata (a few per month of data), not rows.
    starts = [r[0] for r in sliced.select("_slice").distinct().orderBy("_slice").collect()]
    parts = [(sliced.filter(F.col("_slice") == F.lit(s)).drop("_slice"), copies) for s in starts]
    if late and len(starts) > 1:
        parts.append((sliced.filter(F.col("_slice") < F.lit(starts[-1])).drop("_slice"), 1))
    if sentinel is not None:
        parts.append((sentinel, 1))
    for part, times in parts:
        for _ in range(times):
            part.write.mode("append").json(folder)
        if on_delivery is not None:
            on_delivery()
    return len(parts)


def drain(query_writer, timeout_s: int | None = None, state_partitions: int | None = None):
    """Run a stream until its input is exhausted (S15: ``trigger(availableNow=True)``).

    Waits without limit unless ``timeout_s`` is given; a query that is not done by then is
    stopped and ``TimeoutError`` raised, so no caller reads part of a result.  A new query
    fixes its number of state partitions at its first start: ``state_partitions``, else the
    session's ``spark.sql.shuffle.partitions``.  A restarted query keeps the number
    recorded in its checkpoint.
    """
    spark = query_writer._spark
    old = spark.conf.get("spark.sql.shuffle.partitions")
    if state_partitions:
        spark.conf.set("spark.sql.shuffle.partitions", str(state_partitions))
    try:
        q = query_writer.trigger(availableNow=True).start()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    wait_all([q], timeout_s)
    return q


def wait_all(queries, timeout_s: int | None = None) -> None:
    """Wait for every query; if one fails or is late, stop them all and raise."""
    try:
        for q in queries:
            done = q.awaitTermination(timeout_s) if timeout_s is not None else q.awaitTermination() or True
            if not done:
                raise TimeoutError(f"stream {q.name or q.id} was not drained within {timeout_s} s")
            if q.exception() is not None:
                raise RuntimeError(str(q.exception()))
    finally:
        for q in queries:
            if q.isActive:
                q.stop()

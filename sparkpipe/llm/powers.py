"""Packing by powers of two: sequences that never cross documents.

A document's ids are cut into pieces of the capacity and then into the binary digits of what
is left, longest first.  Every piece is a sequence of its own, whose length is a power of two
and needs no padding.  Equal lengths share a bucket; within a bucket and a task sequences are
numbered without gaps, so ``batch_id`` deals them into batches of about equal token counts.
Nothing is shuffled: a document is cut where it is read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import text_of, worker_memo
from .packing import _parts, _together, _WordIds

#: Fixed value: the id that ends each document.
END_ID = 2
CAPACITY = 4096
#: Bits of a sequence id: bucket, then task, then the number within both.
_TASK_BITS, _NUMBER_BITS = 24, 34
_SCHEMA = "doc_id long, start long, length long, ids binary, doc_tokens long, bucket int, sequence_id long, offset long"
_NAMES = ["doc_id", "start", "length", "ids", "doc_tokens", "bucket", "sequence_id", "offset"]


def binary_pieces(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Document number, start and log2 of the length of each piece, in order.

    A document of ``n`` ids gives ``n // capacity`` whole pieces and one for each binary
    digit of the rest.
    """
    top = capacity.bit_length() - 1
    whole, rest = sizes >> top, sizes & (capacity - 1)
    digits = (rest[:, None] >> np.arange(top - 1, -1, -1)) & 1
    times = np.concatenate([whole[:, None], digits], 1).ravel()
    level = np.repeat(np.tile(np.arange(top, -1, -1), len(sizes)), times)
    doc = np.repeat(np.repeat(np.arange(len(sizes)), top + 1), times)
    ends = np.cumsum(np.int64(1) << level)
    first = np.cumsum(sizes) - sizes
    return doc, ends - (np.int64(1) << level) - first[doc], level


def _numbers(level: np.ndarray, used: np.ndarray) -> np.ndarray:
    """Number of each piece among those of its level, after the ``used`` ones, which grow."""
    order = np.argsort(level, kind="stable")
    counts = np.bincount(level, minlength=len(used))
    out = np.empty(len(level), np.int64)
    out[order] = np.arange(len(level)) - np.repeat(np.cumsum(counts) - counts - used, counts)
    used += counts
    return out


def _cut(path: str, capacity: int, end_id: int):
    end = np.array([end_id], "<u4").tobytes()

    def run(batches):
        import os
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        ids = worker_memo("packing", "words", lambda: _WordIds(path), path)
        task = np.int64(TaskContext.get().partitionId())
        used = np.zeros(capacity.bit_length(), np.int64)
        for batch in _together(batches):
            bodies, sizes = [], []
            for texts in _parts(batch.column(1)):
                body, ends = ids.bodies(texts, end)
                bodies.append(body)
                sizes += [(b - a) >> 2 for a, b in zip(ends[:-1], ends[1:], strict=True)]
            sizes = np.array(sizes, np.int64)
            doc, start, level = binary_pieces(sizes, capacity)
            # the pieces lie one after another, as the ids do
            length = np.int64(1) << level
            bounds = np.append(0, np.cumsum(length * 4)).astype(np.int32)
            pieces = pa.Array.from_buffers(pa.binary(), len(level), [None, pa.py_buffer(bounds), pa.py_buffer(b"".join(bodies))])
            sequence = level.astype(np.int64) << (_TASK_BITS + _NUMBER_BITS) | task << _NUMBER_BITS | _numbers(level, used)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(doc)), pa.array(start), pa.array(length), pieces, pa.array(sizes[doc]),
                 pa.array(level.astype(np.int32)), pa.array(sequence), pa.array(np.zeros(len(level), np.int64))], _NAMES)
    return run


def power_sequences(docs: DataFrame, path: str, capacity: int = CAPACITY, end_id: int = END_ID,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, start, length, ids (little-endian unsigned 32-bit), doc_tokens, bucket (log2 of the
    length), sequence_id, offset (always 0): one row per piece, which is a sequence of its own.

    Null or empty text is the end id alone.  Repeated rows are documents of their own, null
    ids are kept, an empty table gives an empty result, other columns play no part.  Texts of
    any length are cut whole.  ``capacity`` is a power of two, else ``ValueError``.  A task
    that runs again gives its pieces the same numbers.
    """
    if capacity < 1 or capacity & (capacity - 1):
        raise ValueError("the capacity must be a power of two")
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_of(text_col).alias("body"))
    return rows.mapInArrow(_cut(path, capacity, end_id), _SCHEMA)


def batch_id(tokens: int) -> Column:
    """Batch of a sequence: sequences of one bucket and task, ``tokens`` ids together (at least one sequence)."""
    number = F.col("sequence_id").bitwiseAND(F.lit((1 << _NUMBER_BITS) - 1))
    each = F.greatest(F.lit(1), F.floor(F.lit(tokens) / F.col("length")))
    return F.col("sequence_id") - number + F.floor(number / each)


def write_buckets(sequences: DataFrame, folder: str) -> None:
    """The sequences as Parquet, a folder for each length, for a loader that draws a bucket at a time."""
    sequences.write.partitionBy("bucket").parquet(folder)

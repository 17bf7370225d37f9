"""Set operations after type alignment."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def align(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Project ``df`` onto ``schema``: cast present columns, typed NULL for absent ones."""
    present = set(df.columns)
    return df.select(*[
        (F.col(f.name).cast(f.dataType) if f.name in present else F.lit(None).cast(f.dataType)).alias(f.name)
        for f in schema.fields
    ])


def union_aligned(frames: Sequence[DataFrame], schema: T.StructType | None = None) -> DataFrame:
    """``UNION ALL`` of frames after aligning each to one schema.

    Without ``schema`` the first frame's schema is the target.  Spark's ``Union`` is a
    narrow operator: the inputs' partitions are concatenated, nothing is shuffled.
    """
    target = schema or frames[0].schema
    return reduce(lambda a, b: a.unionByName(b), [align(f, target) for f in frames])


def concat_frames(frames: Sequence[DataFrame], columns: Sequence[str]) -> DataFrame:
    """Concatenate frames, then reselect a column list."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames).select(*columns)

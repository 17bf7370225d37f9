"""Row hashes and surrogate keys.

Both are plain ``md5`` over a concatenation, so they are computed JVM-side and need
no shuffle.  Doubles are printed through DECIMAL(18, 2) first (D4): the text of a
double differs between engines (``1.0E7`` vs ``10000000.0``), the text of a decimal
does not.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The null token and separator of the public dbt_utils surrogate key.
SURROGATE_NULL_TOKEN = "_dbt_utils_surrogate_key_null_"
SURROGATE_SEPARATOR = "-"


def _as_text(df: DataFrame | None, c: str | Column) -> Column:
    col = F.col(c) if isinstance(c, str) else c
    if df is not None and isinstance(c, str):
        dtype = df.schema[c].dataType
        if isinstance(dtype, (T.DoubleType, T.FloatType)):
            col = col.cast(T.DecimalType(18, 2))
    return col.cast("string")


def row_hash(columns: Sequence[str | Column], df: DataFrame | None = None, sep: str = "") -> Column:
    """md5 over the columns, NULL printed as '' and no separator by default."""
    parts = [F.coalesce(_as_text(df, c), F.lit("")) for c in columns]
    if sep:
        return F.md5(F.concat_ws(sep, *parts))
    return F.md5(F.concat(*parts))


def surrogate_key(columns: Sequence[str | Column], df: DataFrame | None = None) -> Column:
    """Surrogate key over columns (F03): null-token for NULL, '-' between values."""
    parts = [F.coalesce(_as_text(df, c), F.lit(SURROGATE_NULL_TOKEN)) for c in columns]
    return F.md5(F.concat_ws(SURROGATE_SEPARATOR, *parts))

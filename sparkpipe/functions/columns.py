"""Column-level helpers: casts, placeholders, rounding, defaults.

All helpers return ``Column`` expressions built from ``pyspark.sql.functions`` so they stay
inside whole-stage codegen; nothing here runs Python per row.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# NUMERIC of the warehouse is DECIMAL(38, 9); never cast to bare "numeric"
# (Spark reads that as DECIMAL(10, 0)).
NUMERIC = T.DecimalType(38, 9)


def col_of(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def round_half_up(c: str | Column, digits: int) -> Column:
    """Half-up rounding of a double, decided on its decimal value.

    Rounding goes through DECIMAL(38, 9) so ties such as 1.005 round up the same
    way in every engine; the result is a double again.
    """
    return F.round(col_of(c).cast(NUMERIC), digits).cast("double")


def typed_null(dtype: str | T.DataType) -> Column:
    """Typed NULL placeholder used to align schemas before a union."""
    return F.lit(None).cast(dtype)


def cast_block(df: DataFrame, types: Mapping[str, str | T.DataType]) -> DataFrame:
    """Typed cast block (P04): ``{column: type}``; other columns untouched."""
    return df.withColumns({c: F.col(c).cast(t) for c, t in types.items()})


def safe_cast_columns(df: DataFrame, types: Mapping[str, str | T.DataType]) -> DataFrame:
    """Safe cast of listed columns found case-insensitively.

    A column missing from the frame is ignored; a value that cannot be cast becomes
    NULL (``try_cast``) instead of failing the job under ANSI mode.
    """
    actual = {c.lower(): c for c in df.columns}
    exprs = {}
    for name, t in types.items():
        real = actual.get(name.lower())
        if real is not None:
            type_name = t if isinstance(t, str) else t.simpleString()
            exprs[real] = F.expr(f"try_cast(`{real}` AS {type_name})")
    return df.withColumns(exprs) if exprs else df


def to_utc_timestamp_or_null(c: str | Column, fmt: str | None = None) -> Column:
    """Coerce text to a timestamp; unparseable values become NULL."""
    c = col_of(c).cast("string")
    return F.try_to_timestamp(c, F.lit(fmt)) if fmt else F.try_to_timestamp(c)


def keep_columns_with_default(df: DataFrame, columns: Iterable[str], default: str = "N/A") -> DataFrame:
    """Keep requested columns; a missing column or a NULL value becomes ``default``."""
    present = set(df.columns)
    out = []
    for c in columns:
        if c in present:
            out.append(F.coalesce(F.col(c).cast("string"), F.lit(default)).alias(c))
        else:
            out.append(F.lit(default).alias(c))
    return df.select(*out)


def nan_to_null(df: DataFrame, columns: Iterable[str] | None = None) -> DataFrame:
    """Replace NaN by NULL in floating columns before serialising."""
    floating = {f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))}
    targets = [c for c in (columns or floating) if c in floating]
    return df.withColumns({c: F.when(F.isnan(c), None).otherwise(F.col(c)) for c in targets})


def replace_columns(df: DataFrame, exprs: Mapping[str, Column]) -> DataFrame:
    """``SELECT * REPLACE (expr AS c)`` (P22): same column order, new values."""
    return df.withColumns(dict(exprs))


def rename_columns(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Standardise per-source column names (P02); absent names are skipped."""
    present = set(df.columns)
    return df.withColumnsRenamed({k: v for k, v in mapping.items() if k in present})


def lineage_columns(df: DataFrame, constants: Mapping[str, object] | None = None,
                    file_name_as: str | None = None) -> DataFrame:
    """Constant lineage columns (P03) and, optionally, the source file name."""
    out = df.withColumns({k: F.lit(v) for k, v in (constants or {}).items()})
    if file_name_as:
        out = out.withColumn(file_name_as, F.col("_metadata.file_name"))
    return out
